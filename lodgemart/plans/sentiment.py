"""Review scores and the customer table they enrich."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodgemart.functions.sentiment import (
    MAX_CHARS_IN_PLAN,
    MAX_IN_PLAN,
    WHITE,
    WORD_CHARS,
    fits_in_plan,
    normalised,
    sentiment_label,
    sentiment_score,
    tokens,
)
from lodgemart.operators.skew import left_lookup
from lodgemart.schemas import BookingColumns, ReviewColumns, comparable

SCORE = "sentiment_score"
LABEL = "predicted_sentiment"


#: Entries and characters of a lexicon's index that may be sent to all tasks.
BROADCAST_ENTRIES = 300_000
BROADCAST_CHARS = 16_000_000


def score_reviews(
    reviews: DataFrame, lexicon: Mapping[str, float] | DataFrame, cols: ReviewColumns = ReviewColumns()
) -> DataFrame:
    """All review columns plus score and label.

    A lexicon of at most ``MAX_IN_PLAN`` entries, a mapping or a (word, valence) table, becomes
    part of the plan: one narrow pass, no shuffle. A larger one is joined, whatever it comes as.
    The scores are the same.
    """
    if isinstance(lexicon, DataFrame):
        entries = lexicon_entries(lexicon).select("_entry", "_valence")
        n, chars = entries.limit(MAX_IN_PLAN + 1).agg(F.count(F.lit(1)), F.sum(F.length("_entry"))).first()
        if n > MAX_IN_PLAN or (chars or 0) > MAX_CHARS_IN_PLAN:
            return score_by_table(reviews, lexicon, cols)
        lexicon = {r["_entry"]: r["_valence"] for r in entries.collect()}
    elif not fits_in_plan(entries := normalised(lexicon)):
        table = reviews.sparkSession.createDataFrame(list(entries.items()), "word string, valence double")
        return score_by_table(reviews, table, cols)
    scored = reviews.withColumn(SCORE, sentiment_score(cols.text, lexicon))
    return scored.withColumn(LABEL, sentiment_label(SCORE))


def lexicon_entries(lexicon: DataFrame, word: str = "word", valence: str = "valence") -> DataFrame:
    """(_entry, _valence): normalised, of repeats the largest value."""
    entry = F.trim(F.regexp_replace(F.lower(word), r"\s+", " "))
    table = lexicon.select(entry.alias("_entry"), F.col(valence).cast("double").alias("_v"))
    kept = table.filter((F.col("_entry") != "") & F.col("_v").isNotNull())
    return kept.groupBy("_entry").agg(F.max("_v").alias("_valence"))


def _bare(token: Column) -> Column:
    """A token without the white space before it."""
    return F.btrim(token, F.lit(WHITE))


def anchored(entries: DataFrame, splits: int = 1) -> DataFrame:
    """(anchor, entry, valence, offset, size): each entry under its rarest token.

    A token is the rarer the fewer entries hold it; of equally rare ones the longest, then the
    first, is the anchor. ``offset`` tokens stand before it; ``size`` is the entry's number of tokens.
    """
    cut = entries.withColumn("_tokens", tokens(F.col("_entry")))
    held = cut.select(
        "_entry", "_valence", F.size("_tokens").alias("_size"), F.posexplode("_tokens").alias("_offset", "_token")
    ).withColumn("_token", _bare(F.col("_token")))
    common = held.groupBy(F.col("_token").alias("_known")).agg(F.count(F.lit(1)).alias("_held"))
    order = F.struct("_held", -F.length("_token"), "_offset")
    return (
        left_lookup(held, common, "_token", "_known", splits)
        .groupBy("_entry", "_valence", "_size")
        .agg(F.min_by(F.struct("_token", "_offset"), order).alias("_a"))
        .select(
            F.col("_a._token").alias("anchor"),
            F.col("_entry").alias("entry"),
            F.col("_valence").alias("valence"),
            F.col("_a._offset").alias("offset"),
            F.col("_size").alias("size"),
        )
    )


def _stands(found: Column, hit: Column) -> Column:
    """Whether the tokens at a hit's place are those of its entry, and no word goes on behind it.

    A hit without an entry is one whole word, which its anchor has matched.
    """
    end = hit["at"] + hit["size"]
    text = F.array_join(F.slice(found, hit["at"] + 1, hit["size"]), "")
    same = F.btrim(F.regexp_replace(text, r"\s+", " ")) == hit["entry"]
    closed = ~F.coalesce(F.get(found, end), F.lit("")).rlike(f"^{WORD_CHARS}")
    return hit["entry"].isNull() | ((hit["at"] >= 0) & (end <= F.size(found)) & same & closed)


def _taken(found: Column) -> Column:
    """The sum over the entries taken from left to right, the longest first at each place."""
    start = F.struct(F.lit(0).alias("next"), F.lit(0.0).alias("sum"))

    def step(acc: Column, m: Column) -> Column:
        moved = F.struct((m["at"] + m["size"]).alias("next"), (acc["sum"] + m["valence"]).alias("sum"))
        return F.when(m["at"] >= acc["next"], moved).otherwise(acc)

    return F.aggregate(found, start, step, lambda acc: acc["sum"])


def score_by_table(
    reviews: DataFrame,
    lexicon: DataFrame,
    cols: ReviewColumns = ReviewColumns(),
    word: str = "word",
    valence: str = "valence",
    splits: int = 1,
) -> DataFrame:
    """``score_reviews`` for a lexicon table of any size, words and phrases alike.

    Every entry is indexed under its rarest token. The tokens of the reviews are looked up there,
    by a broadcast of the index where its counted size allows it, else by a join that spreads
    common tokens as ``left_lookup`` does. Only places with an anchor go on: they are gathered
    by review, compared with the whole entry there, and taken from left to right. Reviews
    that are equal in all columns share their places.
    """
    entries = lexicon_entries(lexicon, word, valence)
    n, chars = entries.limit(BROADCAST_ENTRIES + 1).agg(F.count(F.lit(1)), F.sum(F.length("_entry"))).first()
    index = anchored(entries, splits)
    hashed = [F.col(f"`{f.name}`") for f in reviews.schema if comparable(f.dataType)]
    key = [F.xxhash64(*hashed).alias("_k1"), F.xxhash64(F.lit(1), *hashed).alias("_k2")]
    places = reviews.select(*key, F.posexplode(tokens(F.col(cols.text))).alias("_i", "_t"))
    places = places.select("_k1", "_k2", "_i", _bare(F.col("_t")).alias("_t"))
    if n <= BROADCAST_ENTRIES and (chars or 0) <= BROADCAST_CHARS:
        hits = places.join(F.broadcast(index), F.col("_t") == F.col("anchor"))
    else:
        known = index.groupBy("anchor").agg(F.count(F.lit(1)).alias("_entries"))
        hits = left_lookup(places, known, "_t", "anchor", splits).filter(F.col("anchor").isNotNull())
        # What is left are places of anchors; each meets the entries under it.
        hits = hits.drop("anchor", "_entries").join(index, F.col("_t") == F.col("anchor"))
    at, back = (F.col("_i") - F.col("offset")).alias("at"), (-F.col("size")).alias("back")
    to_compare = F.when((F.col("size") > 1) | ~F.col("entry").rlike(f"{WORD_CHARS}$"), F.col("entry")).alias("entry")
    hit = F.struct(at, back, "size", to_compare, "valence")
    by_review = hits.groupBy("_k1", "_k2").agg(F.collect_set(hit).alias("_hits"))
    met = reviews.select("*", *key).join(by_review, ["_k1", "_k2"], "left")
    # Longest first at each place: the order by text length is that of the tokens it holds.
    standing = met.withColumn(
        "_hits",
        F.when(
            F.col("_hits").isNotNull(),
            F.transform(F.array(tokens(F.col(cols.text))), lambda found: F.filter("_hits", lambda h: _stands(found, h)))[0],
        ),
    )
    scored = standing.withColumn(SCORE, F.coalesce(_taken(F.array_sort("_hits")), F.lit(0.0)))
    return scored.drop("_k1", "_k2", "_hits").withColumn(LABEL, sentiment_label(SCORE))


# Scores are added as numbers of so many decimal places, whose sum does not depend on their order.
EXACT = "decimal(38,12)"


def sentiment_by_customer(scored: DataFrame, cols: ReviewColumns = ReviewColumns()) -> DataFrame:
    """The mean score of each customer, the same to the last bit however the rows are dealt.

    Scores beyond the range of ``EXACT`` are added as doubles.
    """
    exact = F.col(SCORE).try_cast(EXACT)
    mean = F.sum(exact).cast("double") / F.count(SCORE)
    return scored.groupBy(cols.customer).agg(
        F.when(F.count(exact) == F.count(SCORE), mean).otherwise(F.avg(SCORE)).alias("avg_sentiment_score")
    )


def enrich_sentiment(
    customers: DataFrame,
    scored: DataFrame,
    cols: ReviewColumns = ReviewColumns(),
    owners: BookingColumns = BookingColumns(),
) -> DataFrame:
    """Customer figures plus the mean score of their reviews, 0 without any.

    Both sides hold one row per customer when they meet, so no customer is too large.
    """
    means = sentiment_by_customer(scored, cols).withColumnRenamed(cols.customer, owners.customer)
    return customers.join(means, owners.customer, "left").fillna({"avg_sentiment_score": 0.0})
