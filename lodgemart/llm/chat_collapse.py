"""Chat formatting: collapse cumulative snapshots of a conversation, then render the rest.

A chat service logs a conversation again after every turn, so the table holds many
conversations that are the beginning of a longer one. Each prefix of a conversation gets a
rolling 128-bit hash of its turns; a conversation whose full hash is a proper prefix of any
other is dropped by an anti-join, equal conversations keep the smallest id. Built-in
expressions only.

Defined cases: turns are ordered by (turn, role, text), nulls first; a null role or text is
an empty one; rows without a conversation id form one conversation of their own, whose id
is null; repeated rows are turns of their own; an empty table gives an empty result. Other
columns of the input are ignored, whatever their names. A conversation becomes one row, so one
task puts it together; its turns are hashed in a stream before.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# The ChatML marks around a turn.
TURN_START, TURN_END = "<|im_start|>", "<|im_end|>"
MARK, ESCAPED_MARK = "<|im_", "<| im_"


def rendered(role: Column, text: Column) -> Column:
    """One turn between marks; marks inside the turn are broken up."""

    def plain(col: Column) -> Column:
        return F.replace(col, F.lit(MARK), F.lit(ESCAPED_MARK))

    return F.concat(
        F.lit(TURN_START), plain(role), F.lit("\n"), plain(text), F.lit(TURN_END + "\n")
    )


def prefix_hashes(
    turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """Each turn with its place from 1 (``at``), the hashes ``h1``, ``h2`` of all turns up to it, ``last``.

    A turn's hash covers its place, so the running XOR depends on the order of the turns.
    """
    rows = turns.select(
        F.col(conv).alias("conv"),
        F.coalesce(F.col(conv).cast("string"), F.lit("")).alias("key"),
        F.col(conv).isNull().alias("no_key"),
        F.col(turn).alias("turn"),
        F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
    )
    order = Window.partitionBy("key", "no_key").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = rows.withColumns(
        {"at": F.row_number().over(order).cast("long"), "last": F.lead(F.lit(1)).over(order).isNull()}
    )
    return placed.withColumns(
        {
            "h1": F.bit_xor(F.xxhash64("at", "role", "text")).over(upto),
            "h2": F.bit_xor(F.xxhash64("text", F.lit(17), "role", "at")).over(upto),
        }
    )


def collapse_and_render(
    turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """One row per maximal conversation: its id, ``n_turns``, ``copies`` logged, and ``chat``."""
    hashed = prefix_hashes(turns, conv, turn, role, text)
    ends = F.col("at").alias("n_turns")
    inner = hashed.where(~F.col("last")).select(ends, "h1", "h2").distinct()
    maximal = (
        hashed.where("last")
        .groupBy(ends, "h1", "h2")
        .agg(F.min("conv").alias("id"), F.count(F.lit(1)).alias("copies"))
        .join(inner, ["n_turns", "h1", "h2"], "left_anti")
        .select(
            F.coalesce(F.col("id").cast("string"), F.lit("")).alias("key"),
            F.col("id").isNull().alias("no_key"),
            "id",
            "n_turns",
            "copies",
        )
    )
    chat = F.array_join(
        F.transform(F.array_sort(F.collect_list(F.struct("at", "line"))), lambda x: x["line"]), ""
    )
    lines = hashed.select("key", "no_key", "at", rendered(F.col("role"), F.col("text")).alias("line"))
    return (
        lines.join(maximal, ["key", "no_key"])
        .groupBy("key", "no_key", "id", "n_turns", "copies")
        .agg(chat.alias("chat"))
        .select(F.col("id").alias(conv), "n_turns", "copies", "chat")
    )


# The same rows in DuckDB SQL, by comparing lists of turns instead of hashes.
COLLAPSE_SQL = """
WITH t AS (
  SELECT conv_id, coalesce(role, '') AS r, coalesce(text, '') AS x,
         row_number() OVER (PARTITION BY conv_id
                            ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS i
  FROM conversations),
c AS (
  SELECT conv_id, count(*) AS n, list(struct_pack(r := r, x := x) ORDER BY i) AS l,
         string_agg('<|im_start|>' || replace(r, '<|im_', '<| im_') || chr(10)
                    || replace(x, '<|im_', '<| im_') || '<|im_end|>' || chr(10), '' ORDER BY i) AS chat
  FROM t GROUP BY conv_id),
d AS (
  SELECT min(conv_id) AS conv_id, count(*) AS copies, n, l, min(chat) AS chat FROM c GROUP BY n, l),
p AS (
  SELECT DISTINCT l[1:k] AS l FROM (SELECT l, unnest(range(1, n)) AS k FROM d))
SELECT conv_id, n AS n_turns, copies, chat FROM d
WHERE NOT EXISTS (SELECT 1 FROM p WHERE p.l = d.l)
"""
