import hashlib
import random
import re
import zlib
from collections import defaultdict

import duckdb
import pytest
from llm_cases import sf  # noqa: F401
from pyspark.sql import functions as F

pytest.importorskip("public_tokenizers")

from lodgemart.llm import turn_repair as T  # noqa: E402
from lodgemart.llm.queries import llm_queries  # noqa: E402

TURNS = "conv_id long, turn long, role string, text string"
COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def after_damage(rows):
    """Rows of each conversation after damage, in order."""
    out = {conv: [] for conv, *_ in rows}
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        fate = zlib.crc32(key.encode()) % 20
        if fate:
            text = "" if fate == 1 else re.sub("[.!?]", "", text) if fate == 2 else text
            out[conv] += [(turn, "user" if fate == 4 else role, text)] * (2 if fate == 3 else 1)
    for held in out.values():
        held.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
    return out


def cheapest(rows):
    """(cost, audit, repaired lines) by trying all edits: best whole texts for each role sequence's end."""
    states = {"": (0, "", ())}

    def put(into, roles, found):
        if re.fullmatch("s?(ua)*u?", roles):
            roles = roles[:1] * (roles[:1] == "s") + ("u" if roles.lstrip("s").endswith("u") else "a" if len(roles) > 1 else "")
            roles = roles.replace("sa", "a").replace("su", "u")
            if roles not in into or found[:2] < into[roles][:2]:
                into[roles] = found

    def inserted(states):
        for _ in range(3):
            more = dict(states)
            for roles, (cost, audit, lines) in states.items():
                put(more, ("u" + roles if roles == "a" else roles) + "u", (cost + 3, audit + "I", (*lines, "user:")))
                put(more, ("u" + roles if roles == "a" else roles) + "a", (cost + 3, audit + "I", (*lines, "assistant:")))
            states = more
        return states

    states = inserted(states)
    for initial, doomed, cut, role, text in rows:
        found = {}
        for roles, (cost, audit, lines) in states.items():
            full = "u" + roles if roles == "a" else roles
            put(found, full, (cost + 4, audit + "D", lines))
            if not doomed:
                cost += 3 * cut
                if initial in ("s", "u", "a"):
                    put(found, full + initial, (cost, audit + "K", (*lines, f"{role}:{text}")))
                for new in ("user", "assistant"):
                    put(found, full + new[0], (cost + 3, audit + "R", (*lines, f"{new}:{text}")))
        states = inserted(found)
    return min(states[r] for r in ("", "a") if r in states)


def brute(rows):
    out = []
    for conv, held in after_damage(rows).items():
        if not held:
            out.append((conv, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()))
            continue
        known = [t for t, _, _ in held if t is not None]
        gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
        seen, faults, steps = set(), defaultdict(int), []
        for _, role, text in held:
            body = re.sub(r"[\x20\x09-\x0D]+$", "", text)
            fault = "blank" if not body else "dup" if (role, text) in seen else "cut" if body[-1] not in ".!?" else ""
            seen.add((role, text))
            faults[fault] += 1
            steps.append((role[:1], fault in ("blank", "dup"), fault == "cut", role, text))
        illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(steps, steps[1:]))
        cost, audit, lines = cheapest(steps)
        sha = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        out.append((conv, gaps, faults["blank"], faults["dup"], faults["cut"], illegal, cost, audit, sha))
    return sorted(out, key=repr)


def made(rng, convs, longest):
    texts = ["Fine.", "Yes!", "and so", "", " \n", "Why?", None, "it is."]
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "", None]
    out = []
    for conv in convs:
        for turn in range(rng.randrange(longest)):
            text = rng.choice(texts)
            text = text if rng.random() < 0.3 or not text else f"t{turn} {text}"
            role = ("user", "assistant")[turn % 2] if rng.random() < 0.6 else rng.choice(roles)
            out.append((conv, rng.choice([None, turn, turn, turn, turn // 2]), role, text))
    return out


def test_query_equals_brute_force(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select(*COLUMNS[:1], "turn", "role", "text").collect()]
    found = llm_queries()["op11_turn_repair"](spark, sf)
    assert found.columns == COLUMNS
    assert sorted(map(tuple, found.collect()), key=repr) == brute(rows)


def test_odd_tables_equal_brute_force_and_sql(spark):
    rows = made(random.Random(4), [None, *range(60)], 14)
    rows += [(1, 3, "user", "Same."), (1, 3, "user", "Same."), (1, 3, "user", "Same."), (7, None, None, None)] * 3
    rows += [(77, 0, "user", "very long " * 30_000 + "end."), (77, 1, "assistant", "Fine.")]
    df = spark.createDataFrame(rows, TURNS).withColumns({c: F.lit("own") for c in ("conv", "at", "copies", "edit", "first")})
    found = sorted(map(tuple, T.digest(df.repartition(3)).collect()), key=repr)
    assert found == brute(rows)
    db = duckdb.connect()
    db.sql("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    db.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", rows)
    answer = db.sql(T.REPAIR_SQL)
    assert answer.columns == COLUMNS
    assert sorted(answer.fetchall(), key=repr) == brute(rows)
    assert T.digest(spark.createDataFrame([], TURNS)).count() == 0


def test_one_conversation_over_many_tasks(spark):
    """Most turns belong to one conversation, whose parts are searched apart and chained."""
    rng = random.Random(9)
    for trial in range(3):
        rows = made(rng, [5], 2) + made(rng, [3] * 12, 60) + made(rng, [None, 4], 40)
        before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        spark.conf.set("spark.sql.shuffle.partitions", "23")
        try:
            logged = T.damaged(spark.createDataFrame(rows, TURNS))
            parts = T.placed_turns(logged).select(F.shiftright("at", 33)).distinct().count()
            assert parts > 10
            found = sorted(map(tuple, T.digest(spark.createDataFrame(rows, TURNS)).collect()), key=repr)
        finally:
            spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
            spark.conf.set("spark.sql.shuffle.partitions", "4")
        assert found == brute(rows)


def symbols(rng, n, kinds="suau?"):
    return [(rng.choice(kinds), rng.choice([1, 1, 2]), rng.random() < 0.2, rng.random() < 0.3) for _ in range(n)]


def whole(rows, start=T.BEGIN):
    survivors = T.Survivors(start)
    for initial, copies, doomed, cut in rows:
        survivors.read(T.steps_of(initial, doomed, cut), T.DELETE * (copies - 1))
    return survivors


@pytest.mark.parametrize("look", [1, 3, 10**9])
def test_settled_edits_are_those_of_the_whole_search(monkeypatch, look):
    rng = random.Random(look)
    for _ in range(200):
        rows = symbols(rng, rng.randrange(1, 40))
        expected = whole(rows).ends()
        monkeypatch.setattr(T, "LOOK_EVERY", look)
        found = whole(rows)
        settled = found.take()
        assert {e: (c, settled + p) for e, (c, p) in found.ends().items()} == expected
        monkeypatch.undo()


def test_memory_is_bounded_by_the_unsettled_steps():
    rng = random.Random(1)
    survivors = T.Survivors(T.BEGIN)
    deepest = 0
    for initial, copies, doomed, cut in symbols(rng, 20_000, "uaua"):
        survivors.read(T.steps_of(initial, doomed, cut), 0)
        survivors.take()
        if survivors.unlooked == 0:
            deepest = max(deepest, len(T.path_to(next(iter(survivors.last.values())), survivors.root)))
    assert deepest < 100


def test_chains_of_parts_equal_the_whole_search():
    rng = random.Random(6)
    for trial in range(400):
        rows = symbols(rng, rng.randrange(3, 25), rng.choice(["suau?", "ua", "au", "s?a"]))
        cuts = sorted({0, *rng.sample(range(1, len(rows)), rng.randrange(1, 3))})
        found = []
        for k, cut in enumerate(cuts):
            part = T.Part(1, cut, {s: T.Survivors(s) for s in (range(4) if k else [T.BEGIN])})
            for initial, copies, doomed, truncated in rows[cut : cuts[k + 1] if k + 1 < len(cuts) else None]:
                part.read(initial, copies, T.steps_of(initial, doomed, truncated))
            found += [{"first": cut, **row} for row in part.ends(False) if row["end"] is not None]
        chain = T.cheapest_chain(found)
        ends = whole(rows).ends()
        cost, edits = min((ends[e] for e in (0, 3) if e in ends), key=lambda x: (x[0], "".join(x[1]).translate(T.INITIALS)))
        assert sum(r["cost"] for r in chain) == cost
        assert [e for r in chain for e in r["edits"]] == edits


def test_repaired_turns(spark):
    rows = [(1, 0, "user", "Hello."), (1, 1, "user", "cut off"), (1, 2, "assistant", "Yes."), (2, 0, "assistant", "Late."), (3, 0, "user", "")]
    done = T.repair(spark.createDataFrame(rows, TURNS)).repaired().orderBy("conv", "at", "sub")
    assert [(r["conv"], r["role"], r["text"], r["edit"]) for r in done.collect()] == [
        (1, "user", "Hello.", "K"), (1, "assistant", "Yes.", "K"), (2, "user", "", "I"), (2, "assistant", "Late.", "K"),
    ]
