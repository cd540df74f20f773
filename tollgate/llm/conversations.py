"""Conversation structure repair over a suffix-shared automaton.

Every row of a conversation becomes one symbol: what its role starts with and
whether its text is cut short, or that it must go (it is blank, or its role and
text have been seen). A conversation's symbols are its signature. Signatures are
sorted from the end, so that those with a common suffix stand together and share
its nodes: the cheapest cost to go, and the first letter of the best audit, are
computed once for a node and a state of the grammar, and an audit is read off by
following the letters. A node's edits differ in their letter, so the least letter
of the cheapest ones gives the audit that sorts first.

Edits: K keeps a row, R gives it the role that the grammar wants next, D deletes
it, I inserts an empty row of that role. The roles' initials must spell
``(s?(ua)+)?``.

Nothing is gathered by conversation but its signature, a character a row: rows
are ordered by ranges that cut through long conversations, and their pieces are
joined. Texts are shuffled once, to be replayed as a sorted stream with the audit
in front; a digest of one conversation is one stream of bytes, so its rows pass
one task, which holds an Arrow batch of them at a time.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from os.path import commonprefix

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import slices, written

#: Costs of the edits, and of a row that stays though its text is cut short.
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
_WHITE = " \t\n\x0b\x0c\r"
#: States of the grammar: nothing yet, after system, after user, after assistant.
START, SYSTEM, USER, ASSISTANT = range(4)
#: The state after the role that R and I give, and after a kept role.
_GIVEN = (USER, USER, ASSISTANT, USER)
_KEPT = ({"s": SYSTEM, "u": USER}, {"u": USER}, {"a": ASSISTANT}, {"u": USER})
_ROLE = {USER: "user", ASSISTANT: "assistant"}
#: The node after the last row: what it costs to end in each state, and how.
_END = ((0, 2 * INSERT, INSERT, 0), ".II.")
_LEGAL = ("su", "ua", "au")
#: Characters of a reversed signature that deal conversations to tasks.
DEALT_CHARS = 200


# --- the automaton -----------------------------------------------------------------

@lru_cache(maxsize=100_000)
def _node(symbol: str, after: tuple[int, ...]) -> tuple[tuple[int, ...], str]:
    """(cost to go, letter) by state for a row before a node with costs ``after``.
    Symbols: s, u, a, o (another role), in capitals if cut short; d must go."""
    role, extra = symbol.lower(), TRUNCATED * symbol.isupper()
    options = []
    for state in range(4):
        found = {"D": DELETE + after[state]}
        if role != "d":
            found["R"] = REROLE + extra + after[_GIVEN[state]]
            if role in _KEPT[state]:
                found["K"] = extra + after[_KEPT[state][role]]
        options.append(found)
    least = [min(found.values()) for found in options]
    # Two insertions in a row lead back to the same state, so one round is all.
    least[USER], least[ASSISTANT] = (min(least[USER], INSERT + least[ASSISTANT]), min(least[ASSISTANT], INSERT + least[USER]))
    for state in (START, SYSTEM):
        least[state] = min(least[state], INSERT + least[USER])
    for state, found in enumerate(options):
        found["I"] = INSERT + least[_GIVEN[state]]
    return tuple(least), "".join(min((c, x) for x, c in found.items())[1] for found in options)


class Suffixes:
    """The nodes of one signature's suffixes, shortest first. Signatures come
    sorted by their reverse: a suffix shared with the one before is kept."""

    def __init__(self):
        self.reverse, self.costs, self.letters = "", [_END[0]], [_END[1]]

    def audit(self, signature: str) -> tuple[int, str]:
        """(cost, audit) of the cheapest edits; of equal ones the least audit."""
        reverse = signature[::-1]
        shared = len(commonprefix([self.reverse, reverse]))
        del self.costs[shared + 1:], self.letters[shared + 1:]
        cost = self.costs[-1]
        for symbol in reverse[shared:]:
            least = min(cost)
            delta, letters = _node(symbol, tuple(c - least for c in cost))
            cost = tuple(c + least for c in delta)
            self.costs.append(cost)
            self.letters.append(letters)
        self.reverse = reverse
        out, state, at = [], START, len(reverse)
        while (letter := self.letters[at][state]) != ".":
            out.append(letter)
            if letter == "K":
                state = _KEPT[state][reverse[at - 1].lower()]
            elif letter != "D":
                state = _GIVEN[state]
            at -= letter != "I"
        return self.costs[-1][START], "".join(out)


# --- signatures --------------------------------------------------------------------

def _rows(rows: DataFrame, conv: str, turn: str, role: str, text: str, present: str | None) -> DataFrame:
    """conv, turn, role, text and there: whether the row is one, or only names its
    conversation. Null roles and texts are one space."""
    there = F.coalesce(F.col(present).cast("boolean"), F.lit(False)) if present else F.lit(True)
    return rows.select(
        F.col(conv).alias("conv"), there.alias("there"), F.when(there, F.col(turn)).alias("turn"),
        F.when(there, F.coalesce(F.col(role), F.lit(" "))).alias("role"),
        F.when(there, F.coalesce(F.col(text), F.lit(" "))).alias("text"))


def _key(text: str = "text") -> Column:
    """What texts are compared and, after turn and role, ordered by."""
    return F.unhex(F.md5(F.col(text).cast("binary")))


def _entries(rows: DataFrame) -> DataFrame:
    """Equal rows of a turn as one: conv, turn, role, key, n, their symbols, and
    how many are blank, seen before, cut short. Rows that only name their
    conversation have n = 0."""
    end = F.rtrim("text", F.lit(_WHITE))
    initial = F.substring("role", 1, 1)
    flagged = rows.select(
        "conv", "turn", "role", _key().alias("key"), F.col("there").cast("long").alias("n"),
        (end == "").alias("blank"), (~F.substring(end, -1, 1).isin(".", "!", "?")).alias("cut"),
        F.when(initial.isin("s", "u", "a"), initial).otherwise("o").alias("initial"))
    same = ["conv", "turn", "role", "key", "blank", "cut", "initial"]
    counted = written(flagged.groupBy(same).agg(F.sum("n").alias("n")), "conversation-rows")
    # Role and text in several turns: all but the first are seen before.
    again = (counted.filter("n > 0 and not blank").groupBy("conv", "role", "key")
             .agg(F.count("*").alias("turns"), F.max(F.col("turn").isNull()).alias("any_null"), F.min("turn").alias("first"))
             .filter("turns > 1").select(F.col("conv").alias("c"), F.col("role").alias("r"), F.col("key").alias("k"), "any_null", "first"))
    found = counted.join(again, F.col("conv").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r")) & (F.col("key") == F.col("k")), "left")
    first = F.when(F.col("any_null").isNull(), True).when(F.col("any_null"), F.col("turn").isNull()).otherwise(F.col("turn") == F.col("first"))
    found = found.withColumn("new", F.when(F.col("n") > 0, ~F.col("blank") & first).otherwise(False))
    symbol = F.when(F.col("cut"), F.upper("initial")).otherwise(F.col("initial"))
    gone = F.col("n") - F.col("new").cast("long")
    return found.select(
        "conv", "turn", "role", "key", "n", "initial",
        F.concat(F.when(F.col("new"), symbol).otherwise(""), F.expr("repeat('d', cast(n - cast(new as long) as int))")).alias("symbols"),
        F.when(F.col("blank"), F.col("n")).otherwise(0).alias("blank"), F.when(~F.col("blank"), gone).otherwise(0).alias("duplicate"),
        (F.col("new") & F.col("cut")).cast("long").alias("truncated"))


_PIECE = ("part int, n long, symbols string, blank long, duplicate long, truncated long, illegal long, first string, "
          "last string, low {0}, high {0}, turns long, first_turn {0}, last_turn {0}")


def _pieces(entries: DataFrame) -> DataFrame:
    """One row for each conversation and range of ordered rows that holds some of
    it, by a stream over each range."""
    order = ["conv", F.col("turn").asc_nulls_first(), "role", "key"]
    dealt = entries.repartitionByRange(*order).sortWithinPartitions(*order).select(
        "conv", "turn", "n", "initial", "symbols", "blank", "duplicate", "truncated", F.spark_partition_id().alias("part"))
    kinds = {f.name: f.dataType.simpleString() for f in dealt.schema}
    schema = f"conv {kinds['conv']}, " + _PIECE.format(kinds["turn"])
    names = [x.split()[0] for x in schema.split(", ")]

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, done, arrow, parts = None, [], None, []

        def closed() -> None:
            if now is not None:
                done.append({**now, "symbols": "".join(parts)})

        for batch in slices(batches):
            arrow = batch.schema
            for r in batch.to_pylist():
                if now is None or r["conv"] != now["conv"]:
                    closed()
                    parts = []
                    now = {"conv": r["conv"], "part": r["part"], "n": 0, "blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0,
                           "first": None, "last": None, "low": None, "high": None, "turns": 0, "first_turn": None, "last_turn": None}
                if not r["n"]:
                    continue
                initial, turn = r["initial"], r["turn"]
                now["illegal"] += r["n"] - 1 + (now["n"] > 0 and now["last"] + initial not in _LEGAL)
                if not now["n"]:
                    now["first"] = initial
                now["last"] = initial
                if turn is not None and turn != now["last_turn"]:
                    now["turns"] += 1
                    if now["low"] is None:
                        now["low"] = now["first_turn"] = turn
                    now["high"] = now["last_turn"] = turn
                for name in ("n", "blank", "duplicate", "truncated"):
                    now[name] += r[name]
                parts.append(r["symbols"])
            if done:
                yield _batch(done, arrow)
                done = []
        closed()
        if done:
            yield _batch(done, arrow)

    def _batch(rows: list[dict], arrow: pa.Schema) -> pa.RecordBatch:
        turn = arrow.field("turn").type
        kind = {"conv": arrow.field("conv").type, "part": pa.int32(), "symbols": pa.string(), "first": pa.string(), "last": pa.string(),
                "low": turn, "high": turn, "first_turn": turn, "last_turn": turn}
        return pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], kind.get(n, pa.int64())) for n in names], names=names)

    return dealt.mapInArrow(join, schema)


def signatures(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
               text_col: str = "text", *, present_col: str | None = None) -> DataFrame:
    """One row per conversation: conv, signature, n_rows, gaps, blank, duplicate,
    truncated, illegal; see ``repair``."""
    pieces = _pieces(_entries(_rows(rows, conv_col, turn_col, role_col, text_col, present_col)))
    named = F.struct(*(c for c in pieces.columns if c != "conv"))
    # At most one piece for each range, whatever a conversation's length.
    whole = pieces.groupBy("conv").agg(F.sort_array(F.collect_list(named)).alias("all"))
    whole = whole.select("conv", F.filter("all", lambda p: p["n"] > 0).alias("p"))
    timed = F.filter("p", lambda p: p["low"].isNotNull())

    def total(name: str) -> Column:
        return F.aggregate("p", F.lit(0).cast("long"), lambda n, p: n + p[name])

    def borders(pieces: Column, counts) -> Column:
        """How many neighbouring pieces ``counts`` holds for."""
        pairs = F.zip_with(F.slice(pieces, F.lit(1), F.greatest(F.size(pieces) - 1, F.lit(0))),
                           F.slice(pieces, F.lit(2), F.greatest(F.size(pieces) - 1, F.lit(0))), lambda a, b: counts(a, b).cast("int"))
        return F.aggregate(pairs, F.lit(0).cast("long"), lambda n, x: n + x)

    turns = F.aggregate(timed, F.lit(0).cast("long"), lambda n, p: n + p["turns"]) - borders(
        timed, lambda a, b: a["last_turn"] == b["first_turn"])
    low, high = (F.array_min(F.transform(timed, lambda p: p["low"])), F.array_max(F.transform(timed, lambda p: p["high"])))
    gaps = F.when(F.size(timed) > 0, high.cast("decimal(30)") - low.cast("decimal(30)") + 1 - turns).otherwise(0)
    return whole.select(
        "conv", F.array_join(F.transform("p", lambda p: p["symbols"]), "").alias("signature"), total("n").alias("n_rows"),
        gaps.try_cast("long").alias("gaps"), total("blank").alias("blank"), total("duplicate").alias("duplicate"),
        total("truncated").alias("truncated"),
        (total("illegal") + borders(F.col("p"), lambda a, b: ~F.concat(a["last"], b["first"]).isin(*_LEGAL))).alias("illegal"))


def audits(signed: DataFrame) -> DataFrame:
    """``signed`` (with a column signature) with cost and audit. Rows are dealt and
    sorted by their signature from the end; equal signatures, however many, are
    dealt further by conv."""
    names = signed.columns
    back = F.reverse("signature")
    dealt = signed.repartitionByRange(F.substring(back, 1, DEALT_CHARS), "conv").sortWithinPartitions(back, "conv")

    def follow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nodes, last, best = Suffixes(), None, (0, "")
        for batch in slices(batches):
            found = []
            for signature in batch.column("signature").to_pylist():
                if signature != last:
                    last, best = signature, nodes.audit(signature)
                found.append(best)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([c for c, _ in found], pa.int64()), pa.array([a for _, a in found], pa.string())],
                names=[*names, "cost", "audit"])

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in signed.schema)
    return dealt.mapInArrow(follow, f"{kinds}, cost long, audit string")


# --- replay ------------------------------------------------------------------------

class Replay:
    """Applies an audit to a conversation's rows in order."""

    def __init__(self, audit: str):
        self.audit, self.at, self.state = audit, 0, START

    def _given(self) -> str:
        self.state = _GIVEN[self.state]
        return _ROLE[self.state]

    def inserted(self) -> Iterator[tuple[str, str, str]]:
        """(edit, role, text) of the insertions that come next."""
        while self.audit[self.at:self.at + 1] == "I":
            self.at += 1
            yield "I", self._given(), ""

    def row(self, role: str, text: str) -> Iterator[tuple[str, str, str]]:
        yield from self.inserted()
        edit = self.audit[self.at]
        self.at += 1
        if edit == "K":
            self.state = _KEPT[self.state][role[0]]
            yield edit, role, text
        elif edit == "R":
            yield edit, self._given(), text


def _replayed(rows: DataFrame, known: DataFrame) -> DataFrame:
    """Each conversation's summary and audit, then its rows in order."""
    own = F.struct(*(c for c in known.columns if c != "conv"))
    head = known.select("conv", F.lit(0).alias("kind"), own.alias("own"), *(
        F.lit(None).cast(rows.schema[c].dataType).alias(c) for c in ("turn", "role", "text")), F.lit(None).cast("binary").alias("key"))
    body = rows.filter("there").select("conv", F.lit(1).alias("kind"), F.lit(None).cast(head.schema["own"].dataType).alias("own"),
                                       "turn", "role", "text", _key().alias("key"))
    order = ["conv", "kind", F.col("turn").asc_nulls_first(), "role", "key"]
    return head.unionByName(body).repartition("conv").sortWithinPartitions(*order).drop("key")


def _known(rows: DataFrame, columns: tuple[str, str, str, str], present_col: str | None) -> tuple[DataFrame, DataFrame]:
    found = audits(signatures(rows, *columns, present_col=present_col)).drop("signature")
    return _rows(rows, *columns, present_col), written(found, "conversation-audits")


def repair(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
           text_col: str = "text", *, present_col: str | None = None) -> DataFrame:
    """One row per conversation: id, gaps (turns missing between the smallest and
    the largest), rows whose first fault is that they are blank, a duplicate (role
    and text seen earlier) or truncated (the last character that is not white is
    none of ``.!?``), illegal neighbours (role initials other than su, ua, au), the
    cost and audit of the cheapest edits, n_rows, and repaired_sha256 of the repaired
    ``role:text`` lines, joined by line feeds.

    Rows are ordered by turn (nulls first), then role, then the MD5 of the text;
    equal rows stand side by side. Null roles and texts are one space; null turns
    count for no gap; a null id is a conversation of its own. With ``present_col``,
    rows where it is not true only name their conversation; one without other rows
    has zeros and the hash of nothing. Texts and conversations may be of any length
    (an audit is one string); other columns, whatever their names, are ignored; an
    empty table gives an empty result.
    """
    columns = (conv_col, turn_col, role_col, text_col)
    body, known = _known(rows, columns, present_col)
    fields = [c for c in known.columns if c != "conv"]
    kinds = {f.name: f.dataType.simpleString() for f in known.schema}

    def replay(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, conv, kind = None, None, None
        done: list[tuple] = []

        def update(parts: Iterator[tuple[str, str, str]]) -> None:
            for _, role, text in parts:
                now["sha"].update((("\n" if now["any"] else "") + role + ":" + text).encode())
                now["any"] = True

        def closed() -> None:
            if now is not None:
                update(now["replay"].inserted())
                done.append((conv, now["own"], now["sha"].hexdigest()))

        def emitted() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays(
                [pa.array([d[0] for d in done], kind), *(pa.array([d[1][f] for d in done], pa.string() if f == "audit" else pa.int64())
                                                         for f in fields), pa.array([d[2] for d in done], pa.string())],
                names=["conv", *fields, "repaired_sha256"])
            done.clear()
            return out

        for batch in slices(batches):
            kind = batch.schema.field("conv").type
            for c, own, role, text in zip(*(batch.column(x).to_pylist() for x in ("conv", "own", "role", "text")), strict=True):
                if own is not None:
                    closed()
                    now, conv = {"replay": Replay(own["audit"]), "own": own, "sha": hashlib.sha256(), "any": False}, c
                else:
                    update(now["replay"].row(role, text))
            if done:
                yield emitted()
        closed()
        if done:
            yield emitted()

    out = _replayed(body, known).mapInArrow(
        replay, f"conv {kinds['conv']}, " + ", ".join(f"{f} {kinds[f]}" for f in fields) + ", repaired_sha256 string")
    return out.select(F.col("conv").alias(conv_col), "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit",
                      "repaired_sha256", "n_rows")


def repaired_rows(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                  text_col: str = "text", *, present_col: str | None = None) -> DataFrame:
    """The rows of the repaired conversations: id, place (from 0), edit (K, R or
    I), role and text. Input as for ``repair``."""
    body, known = _known(rows, (conv_col, turn_col, role_col, text_col), present_col)
    kind = known.schema["conv"].dataType.simpleString()

    def replay(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, conv, place, arrow = None, None, 0, pa.null()
        for batch in slices(batches):
            arrow = batch.schema.field("conv").type
            out: list[tuple] = []

            def put(parts: Iterator[tuple[str, str, str]], out=out) -> None:
                nonlocal place
                for part in parts:
                    out.append((conv, place, *part))
                    place += 1

            for c, own, role, text in zip(*(batch.column(x).to_pylist() for x in ("conv", "own", "role", "text")), strict=True):
                if own is not None:
                    if now is not None:
                        put(now.inserted())
                    now, conv, place = Replay(own["audit"]), c, 0
                else:
                    put(now.row(role, text))
            yield _rows_batch(out, arrow)
        if now is not None:
            yield _rows_batch([(conv, place + k, *part) for k, part in enumerate(now.inserted())], arrow)

    def _rows_batch(out: list[tuple], arrow: pa.DataType) -> pa.RecordBatch:
        columns = list(zip(*out, strict=True)) or [[]] * 5
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (arrow, pa.int64(), pa.string(), pa.string(), pa.string()),
                                                                       strict=True)], names=["conv", "place", "edit", "role", "text"])

    out = _replayed(body, known).mapInArrow(replay, f"conv {kind}, place long, edit string, role string, text string")
    return out.select(F.col("conv").alias(conv_col), "place", "edit", "role", "text")


def damage(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
           text_col: str = "text") -> DataFrame:
    """(conv, turn, role, text, present): rows damaged by h, the crc32 of
    ``conv:turn`` modulo 20 (null: one space): 0 drops the row (present is false,
    so that it still names its conversation), 1 empties its text, 2 removes its
    ``.!?``, 3 repeats it, 4 gives it the role user."""
    name = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in (conv_col, turn_col)]
    h = F.crc32(F.concat(name[0], F.lit(":"), name[1]).cast("binary")) % 20
    role, text = (F.coalesce(F.col(c), F.lit(" ")) for c in (role_col, text_col))
    out = rows.select(
        F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"), F.when(h == 4, "user").otherwise(role).alias("role"),
        F.when(h == 1, "").when(h == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"), (h != 0).alias("present"),
        F.explode(F.array_repeat(F.lit(0), F.when(h == 3, 2).otherwise(1))).alias("copy"))
    return out.select(F.col("conv").alias(conv_col), F.col("turn").alias(turn_col), F.col("role").alias(role_col),
                      F.col("text").alias(text_col), "present")
