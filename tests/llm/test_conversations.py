"""Conversation repair against a search over every edit."""

import hashlib
import heapq
import random
import zlib

import pytest
from pyspark.sql import functions as F

from tollgate.llm import catalog, conversations
from tollgate.session import ship_package

SF = "/root/testdata/sf0.01"
WHITE = "\x20\x09\x0a\x0b\x0c\x0d"
KEPT, GIVEN = [{"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2}], (2, 2, 3, 2)


def cheapest(rows):
    """(cost, audit) by shortest paths over (cost, audit) pairs; rows: (initial, fault)."""
    heap, seen = [(0, "", 0, 0)], set()
    while heap:
        cost, audit, i, state = heapq.heappop(heap)
        if (i, state) in seen:
            continue
        seen.add((i, state))
        if i == len(rows) and state in (0, 3):
            return cost, audit
        heapq.heappush(heap, (cost + 3, audit + "I", i, GIVEN[state]))
        if i < len(rows):
            initial, fault = rows[i]
            heapq.heappush(heap, (cost + 4, audit + "D", i + 1, state))
            if fault not in ("blank", "duplicate"):
                more = 3 * (fault == "truncated")
                heapq.heappush(heap, (cost + 3 + more, audit + "R", i + 1, GIVEN[state]))
                if initial in KEPT[state]:
                    heapq.heappush(heap, (cost + more, audit + "K", i + 1, KEPT[state][initial]))


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        h = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        row = (turn, "user" if h == 4 else role, "" if h == 1 else "".join(c for c in text if c not in ".!?") if h == 2 else text)
        out += [row] * (0 if h == 0 else 2 if h == 3 else 1)
    return sorted(out, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.md5(r[2].encode()).digest()))


def want(rows):
    """(gaps, blank, duplicate, truncated, illegal, cost, audit, sha256) of a conversation's damaged rows."""
    seen, faults = set(), []
    for _, role, text in rows:
        core = text.strip(WHITE)
        faults.append("blank" if not core else "duplicate" if (role, text) in seen else "truncated" if core[-1] not in ".!?" else None)
        seen.add((role, text))
    turns = [t for t, _, _ in rows if t is not None]
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    cost, audit = cheapest([(r[1][:1], f) for r, f in zip(rows, faults)])
    out, state, at = [], 0, 0
    for edit in audit:
        if edit in "RI":
            state = GIVEN[state]
            out.append(("user" if state == 2 else "assistant") + ":" + (rows[at][2] if edit == "R" else ""))
        elif edit == "K":
            state = KEPT[state][rows[at][1][0]]
            out.append(rows[at][1] + ":" + rows[at][2])
        at += edit != "I"
    return (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *(faults.count(x) for x in ("blank", "duplicate", "truncated")),
            illegal, cost, audit, hashlib.sha256("\n".join(out).encode()).hexdigest())


def got(df):
    return {r.conv_id: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.repaired_sha256) for r in df.collect()}


def expected(rows):
    by_conv = {}
    for r in rows:
        by_conv.setdefault(r[0], []).append(r)
    return {c: want(damaged(x)) for c, x in by_conv.items()}


def test_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    found = got(catalog.op12_conversations(spark, SF))
    assert found == expected(rows)
    assert len({x[6] for x in found.values()}) > 20


ODD = [
    *((1, t, r, "Well.") for t, r in enumerate(["user", "assistant"] * 4)),  # duplicates over turns
    (2, None, "user", None), (2, None, None, "No turn"), (2, 5, "system", "Late."), (2, 9, "assistant", "later!"), (2, 9, "assistant", "later!"),
    (None, 0, "user", "Whose?"), (None, 1, "assistant", "Nobody's."),
    (3, 0, "tool", "result."), (3, 1, "", "no role?"), (3, 2, "user", " \t\n "), (3, 3, "assistant", "cut short"), (3, 4, "user", "Ünï你."),
    (4, 0, "system", "Be brief."), (4, 1, "system", "Be long."), (4, 2, "user", "Hm. \n\x0b"), (4, 3, "user", "Hm"),
    (5, 0, "user", "x" * 200_000), (5, 1, "assistant", "y " * 100_000 + "."),
]


def random_rows(seed):
    rng = random.Random(seed)
    return [(rng.randrange(40), rng.choice([None, *range(7)]), rng.choice(["user", "assistant", "system", "tool", None, ""]),
             rng.choice(["A.", "B!", "cut", "", " ", None, "C?"])) for _ in range(400)]


@pytest.mark.parametrize("rows", [ODD, random_rows(1), random_rows(2)], ids=["odd", "random1", "random2"])
def test_odd_conversations(spark, rows):
    ship_package(spark)
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    for name in ("conv", "part", "own", "kind", "signature", "key"):  # names used on the way
        df = df.withColumn(name, F.lit("x"))
    assert got(conversations.repair(conversations.damage(df), present_col="present")) == expected(rows)


def test_long_conversation_is_cut_into_ranges(spark):
    """One conversation holds most rows, over several ranges; a third of its rows are equal."""
    ship_package(spark)
    rng = random.Random(5)
    rows = [(7, t, rng.choice(["user", "assistant"]), rng.choice(["Yes.", "Yes.", f"Text {t}.", "cut"])) for t in range(3_000)]
    rows += [(c, t, "user", "Hi.") for c in range(20) for t in range(3)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        entries = conversations._entries(conversations._rows(df, "conv_id", "turn", "role", "text", None))
        assert conversations._pieces(entries).filter("conv = 7").count() > 2
        assert got(conversations.repair(conversations.damage(df), present_col="present")) == expected(rows)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_no_rows_left(spark):
    ship_package(spark)
    dropped = [(c, 0, "user", "Hi.") for c in range(2_000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0]
    df = spark.createDataFrame(dropped, "conv_id long, turn long, role string, text string")
    found = got(conversations.repair(conversations.damage(df), present_col="present"))
    assert len(found) == len(dropped) > 50
    assert set(found.values()) == {(0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}
    empty = df.limit(0)
    assert conversations.repair(empty).collect() == [] == conversations.repaired_rows(empty).collect()


def test_repaired_rows_give_the_digest(spark):
    ship_package(spark)
    df = conversations.damage(spark.createDataFrame(ODD, "conv_id long, turn long, role string, text string"))
    lines = {}
    for r in sorted(conversations.repaired_rows(df, present_col="present").collect(), key=lambda r: r.place):
        lines.setdefault(r.conv_id, []).append(f"{r.role}:{r.text}")
    for conv, x in got(conversations.repair(df, present_col="present")).items():
        assert hashlib.sha256("\n".join(lines.get(conv, [])).encode()).hexdigest() == x[-1]


def test_shared_suffixes_are_computed_once():
    nodes = conversations.Suffixes()
    for s in sorted(["uaua", "sua", "uua", "ua"], key=lambda s: s[::-1]):
        held = nodes.costs[:3]
        nodes.audit(s)
        assert s == "ua" or nodes.costs[:3] == held
