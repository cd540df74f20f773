"""Periodic runs of words, found in grammar-compressed texts.

A run is a stretch of consecutive words with smallest period q, of at least
``LEAST_WORDS`` words and ``LEAST_PERIODS`` periods, that no neighbouring word
extends. Texts are compressed by Re-Pair over their word ids: in rounds, every
pair of neighbouring symbols that occurs three times or more in its text, and
more often than the pairs it overlaps, becomes a nonterminal (a run holds each
of its pairs three times at least, so a rarer pair is a border that no run
crosses, and a text without frequent pairs has no run). What remains of a
stretch between borders is covered by a balanced tree of symbols.

A run lies in the expansion of some lowest nonterminal and crosses the boundary
of its two halves. So the runs that cross each nonterminal's boundary are
computed once for all texts of a slice, translated to every position where the
nonterminal stands, and the maximal intervals of each period are kept. Slices
are Arrow batches of bounded size; no text leaves its task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices, utf8

LEAST_WORDS, LEAST_PERIODS = 6, 4
#: A run of ``LEAST_PERIODS`` periods holds each of its pairs so often at least.
LEAST_PAIRS = LEAST_PERIODS - 1
#: Candidates (boundary, period) that are probed at a time.
PROBED = 2_000_000


# --- Re-Pair ---------------------------------------------------------------------

def _pair_ranks(doc: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """For each neighbouring pair of symbols its rank by how often it occurs in
    its text; -1 where that is too rare."""
    most = int(max(x.max(), y.max())) + 1
    if (int(doc.max()) + 1) * most * most < 2**63:
        key = (doc * most + x) * most + y
    else:  # one very long text: number the pairs first
        _, pair = np.unique(x * most + y, return_inverse=True)
        key = doc * (int(pair.max()) + 1) + pair
    # Few pairs are frequent: most are ruled out by the count of their bucket.
    bits = max(10, len(key).bit_length() + 2)
    bucket = (key * -7046029254386353131) >> (64 - bits) & ((1 << bits) - 1)
    often = np.flatnonzero(np.bincount(bucket, minlength=1 << bits)[bucket] >= LEAST_PAIRS)
    rank = np.full(len(key), -1)
    if len(often):
        pair, inverse, counts = np.unique(key[often], return_inverse=True, return_counts=True)
        place = np.empty(len(counts), dtype=np.int64)  # ties by a hash: neighbours' ranks go up and down
        place[np.lexsort((pair * -7046029254386353131, counts))] = np.arange(len(counts))
        rank[often] = np.where(counts[inverse] >= LEAST_PAIRS, place[inverse], -1)
    return rank


def _chosen(rank: np.ndarray) -> np.ndarray:
    """Which pairs to replace: those that rank over the pairs they overlap; of a
    series of equal pairs (one symbol repeated) every other one."""
    first = np.flatnonzero(np.r_[True, rank[1:] != rank[:-1]])
    value = rank[first]
    before, after = np.r_[-1, value[:-1]], np.r_[value[1:], -1]
    best = (value >= 0) & (value > before) & (value > after)
    series = np.repeat(np.arange(len(first)), np.diff(np.r_[first, len(rank)]))
    return best[series] & ((np.arange(len(rank)) - first[series]) % 2 == 0)


class Grammar:
    """Re-Pair over the texts of a slice. ``word``: word ids of all texts, each
    followed by a separator of its own. ``nodes``: start, middle and end of one
    place of every nonterminal (rules first, then the trees over what remains);
    ``placed``: (rule, position) of every place where a rule's symbol stands."""

    def __init__(self, word: np.ndarray, doc: np.ndarray, n_words: int):
        self.rules: dict[int, int] = {}  # pair of symbols (31 bits each) -> rule
        self.next_symbol = n_words
        placed, nodes = [], []
        real = word < n_words
        joined = real[:-1] & real[1:]
        rank = _pair_ranks(doc[:-1], word[:-1], word[1:])
        rank[~joined] = -1
        # Stretches of frequent pairs; others cannot hold a run.
        inside = np.r_[False, rank >= 0] | np.r_[rank >= 0, False]
        opens = inside & ~np.r_[False, rank >= 0]
        stretch = np.cumsum(opens) - 1
        sizes = np.bincount(stretch[inside], minlength=1)
        keep = inside & (sizes[np.maximum(stretch, 0)] >= LEAST_WORDS)
        at = np.flatnonzero(keep)
        symbol, where, size = word[at].astype(np.int64), doc[at].astype(np.int64), np.ones(len(at), dtype=np.int64)
        stretch = stretch[at]
        done = []
        while len(at) > 1:
            together = stretch[1:] == stretch[:-1]
            rank = _pair_ranks(where[:-1], symbol[:-1], symbol[1:])
            rank[~together] = -1
            live = np.zeros(int(where.max()) + 1, dtype=bool)
            live[where[:-1][rank >= 0]] = True
            finished = ~live[where]
            if finished.any():
                done.append((at[finished], size[finished], stretch[finished]))
                left = ~finished
                rank = np.r_[rank, -1][left][:-1]
                at, symbol, where, size, stretch = at[left], symbol[left], where[left], size[left], stretch[left]
                if len(at) < 2:
                    break
                rank[stretch[1:] != stretch[:-1]] = -1
            chosen = np.flatnonzero(_chosen(rank))
            placed.append(self._replace(chosen, at, symbol, size, nodes))
            gone = np.zeros(len(at), dtype=bool)
            gone[chosen + 1] = True
            size[chosen] += size[chosen + 1]
            at, symbol, where, size, stretch = (a[~gone] for a in (at, symbol, where, size, stretch))
        done.append((at, size, stretch))
        self.n_rules = sum(len(n) for n in nodes)
        nodes.append(_trees(*(np.concatenate(c) for c in zip(*done, strict=True))))
        self.nodes = np.concatenate(nodes)
        self.placed = np.concatenate(placed) if placed else np.empty((0, 2), dtype=np.int64)

    def _replace(self, chosen, at, symbol, size, nodes) -> np.ndarray:
        """Gives the chosen pairs their nonterminals; returns (rule, position)."""
        pairs, inverse = np.unique(symbol[chosen] << 31 | symbol[chosen + 1], return_inverse=True)
        some = np.empty(len(pairs), dtype=np.int64)
        some[inverse] = chosen
        ids, new = np.empty(len(pairs), dtype=np.int64), []
        for k, pair in enumerate(pairs.tolist()):
            rule = self.rules.get(pair)
            if rule is None:
                rule = self.rules[pair] = len(self.rules)
                new.append(k)
            ids[k] = rule
        one = some[new]
        nodes.append(np.stack([at[one], at[one] + size[one], at[one] + size[one] + size[one + 1]], 1))
        symbol[chosen] = self.next_symbol + ids[inverse]
        return np.stack([ids[inverse], at[chosen]], 1)


def _trees(at: np.ndarray, size: np.ndarray, stretch: np.ndarray) -> np.ndarray:
    """Nodes of a balanced tree over the symbols of each stretch."""
    order = np.argsort(at, kind="stable")
    at, size, stretch = at[order], size[order], stretch[order]
    if not len(at):
        return np.empty((0, 3), dtype=np.int64)
    first = np.flatnonzero(np.r_[True, stretch[1:] != stretch[:-1]])
    many = np.diff(np.r_[first, len(at)])
    base, count = np.repeat(first, many), np.repeat(many, many)
    ends = np.repeat((at + size)[first + many - 1], many)
    number = np.arange(len(at)) - base
    out, half = [], 1
    while half < int(many.max()):
        mid = np.flatnonzero(number % (2 * half) == half)
        after = number[mid] + half
        last = np.where(after < count[mid], base[mid] + np.minimum(after, count[mid] - 1), -1)
        out.append(np.stack([at[mid - half], at[mid], np.where(last >= 0, at[last], ends[mid])], 1))
        half *= 2
    return np.concatenate(out) if out else np.empty((0, 3), dtype=np.int64)


# --- runs across a boundary ------------------------------------------------------

class _Equal:
    """Longest equal stretches of a sequence, by prefix hashes and bisection."""

    def __init__(self, word: np.ndarray):
        n = len(word)
        value = (word.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        value ^= value >> np.uint64(29)
        value *= np.uint64(0xBF58476D1CE4E5B9)
        value ^= value >> np.uint64(32)
        power = np.full(n + 1, 0x5851F42D4C957F2D, dtype=np.uint64)
        power[0] = 1
        self.power = np.cumprod(power)
        self.sums = np.r_[np.uint64(0), np.cumsum(value * self.power[:-1])]

    def same(self, i: np.ndarray, q: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Whether the n words from i on equal those from i + q on."""
        a, b = self.sums[i + n] - self.sums[i], self.sums[i + q + n] - self.sums[i + q]
        return a * self.power[q] == b

    def _longest(self, most: np.ndarray, holds) -> np.ndarray:
        low, high = np.zeros_like(most), most.copy()
        while (low < high).any():
            middle = (low + high + 1) // 2
            good = holds(middle)
            low, high = np.where(good, middle, low), np.where(good, high, middle - 1)
        return low

    def extent(self, i: np.ndarray, q: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The largest interval round i within [start, end) that has period q."""
        right = self._longest(end - i - q, lambda n: self.same(i, q, n))
        left = self._longest(i - start, lambda n: self.same(i - n, q, n))
        return i - left, i + q + right


def _ragged(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each k its row and 0, 1, ... counts[k] - 1."""
    row = np.repeat(np.arange(len(counts)), counts)
    return row, np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)


def crossing_runs(word: np.ndarray, nodes: np.ndarray) -> np.ndarray:
    """(node, start, end, period) of the stretches within a node that touch its
    middle and hold ``LEAST_PERIODS`` periods. One half holds two periods of such
    a stretch next to the middle, so a period is a candidate only where these
    two are equal."""
    if not len(nodes):
        return np.empty((0, 4), dtype=np.int64)
    equal, found = _Equal(word), []
    start, mid, end = nodes.T
    longest = (end - start) // LEAST_PERIODS
    before, after = np.minimum((mid - start) // 2, longest), np.minimum((end - mid) // 2, longest)
    work = np.cumsum(before + after)
    if not work[-1]:
        return np.empty((0, 4), dtype=np.int64)
    cuts = np.searchsorted(work, np.arange(PROBED, work[-1] + PROBED, PROBED)) + 1
    low = 0
    for high in np.unique(np.minimum(cuts, len(nodes))).tolist():
        part = np.arange(low, high)
        low = high
        node, q = _ragged(before[part])
        node, q = part[node], q + 1
        m = mid[node]
        ok = np.flatnonzero((word[m - 1] == word[m - 1 - q]) & (word[m - q] == word[m - 2 * q]))
        node, q, m = node[ok], q[ok], m[ok]
        ok = equal.same(m - 2 * q, q, q)
        left = (node[ok], q[ok], m[ok] - q[ok])
        node, q = _ragged(after[part])
        node, q = part[node], q + 1
        m = mid[node]
        ok = np.flatnonzero((word[m] == word[m + q]) & (word[m + q - 1] == word[m + 2 * q - 1]))
        node, q, m = node[ok], q[ok], m[ok]
        ok = equal.same(m, q, q)
        node, q, i = (np.concatenate(c) for c in zip(left, (node[ok], q[ok], m[ok]), strict=True))
        s, e = equal.extent(i, q, start[node], end[node])
        long = e - s >= np.maximum(LEAST_WORDS, LEAST_PERIODS * q)
        found.append(np.stack([node, s, e, q], 1)[long])
    return np.concatenate(found)


def _maximal(runs: np.ndarray) -> np.ndarray:
    """(start, end, period) rows: of each period the stretches that no other one
    of that period holds, and of equal stretches the smallest period."""
    order = np.lexsort((-runs[:, 1], runs[:, 0], runs[:, 2]))
    s, e, q = runs[order].T
    if not len(s):
        return runs
    group = np.cumsum(np.r_[0, q[1:] != q[:-1]]) * (int(e.max()) + 1)
    reach = np.maximum.accumulate(e + group)
    kept = np.r_[True, (e + group)[1:] > reach[:-1]]
    s, e, q = s[kept], e[kept], q[kept]
    order = np.lexsort((q, e, s))
    s, e, q = s[order], e[order], q[order]
    single = np.r_[True, (s[1:] != s[:-1]) | (e[1:] != e[:-1])]
    return np.stack([s, e, q], 1)[single]


def _holds(word: np.ndarray, runs: np.ndarray) -> bool:
    """Every stretch really has its period (hashes are not proof)."""
    for low in range(0, len(runs), 1000):
        s, e, q = runs[low:low + 1000].T
        row, k = _ragged(e - s - q)
        if not (word[s[row] + k] == word[s[row] + k + q[row]]).all():
            return False
    return True


def find_runs(texts: list[np.ndarray], n_words: int) -> list[list[tuple[int, int, int]]]:
    """The runs (start, length, period) of each sequence of word ids under
    ``n_words``, by start, then period."""
    counts = np.array([len(t) + 1 for t in texts], dtype=np.int64)
    if counts.sum() < LEAST_WORDS + 1:
        return [[] for _ in texts]
    starts = np.cumsum(counts) - counts
    word = np.concatenate([x for k, t in enumerate(texts) for x in (t, [n_words + k])]).astype(np.int64)
    doc = np.repeat(np.arange(len(texts)), counts)
    grammar = Grammar(word, doc, n_words)
    runs = _translated(grammar, crossing_runs(word, grammar.nodes))
    if not _holds(word, runs):  # unequal stretches of one hash: a search that needs none
        runs = _plain_runs(word)
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for d, s, e, q in zip(doc[runs[:, 0]].tolist(), *runs.T.tolist(), strict=True):
        out[d].append((s - int(starts[d]), e - s, q))
    return [sorted(r, key=lambda x: (x[0], x[2])) for r in out]


def _translated(grammar: Grammar, crossing: np.ndarray) -> np.ndarray:
    """The nonterminals' runs at every place where these stand, merged."""
    node, s, e, q = crossing.T
    own = crossing[node >= grammar.n_rules][:, 1:]
    of_rule = node < grammar.n_rules
    node, s, e, q = node[of_rule], s[of_rule], e[of_rule], q[of_rule]
    base = grammar.nodes[:grammar.n_rules, 0] if grammar.n_rules else np.empty(0, dtype=np.int64)
    order = np.argsort(node, kind="stable")
    node, s, e, q = node[order], s[order], e[order], q[order]
    rule, position = grammar.placed.T
    low, high = np.searchsorted(node, rule), np.searchsorted(node, rule, side="right")
    place, k = _ragged(high - low)
    run = low[place] + k
    shift = position[place] - base[node[run]] if len(run) else np.empty(0, dtype=np.int64)
    moved = np.stack([s[run] + shift, e[run] + shift, q[run]], 1)
    return _maximal(np.concatenate([own, moved]))


def _plain_runs(word: np.ndarray) -> np.ndarray:
    """Every run by comparing the words at each distance (slow, never wrong)."""
    found = []
    for q in range(1, len(word) // LEAST_PERIODS + 1):
        same = np.r_[0, (word[q:] == word[:-q]).astype(np.int8), 0]
        s, e = np.flatnonzero(np.diff(same) == 1), np.flatnonzero(np.diff(same) == -1) + q
        long = e - s >= max(LEAST_WORDS, LEAST_PERIODS * q)
        found.append(np.stack([s[long], e[long], np.full(long.sum(), q)], 1))
    return _maximal(np.concatenate(found))


# --- texts -----------------------------------------------------------------------

class _Numbers(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


def best(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run with the greatest length/period; ties: smallest start, then period."""
    return min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)


def kept(n: int, runs: list[tuple[int, int, int]]) -> np.ndarray:
    """Which of n words stay: not those of a run after its first q words."""
    edge = np.zeros(n + 1, dtype=np.int64)
    for s, length, q in runs:
        edge[s + q] += 1
        edge[s + length] -= 1
    return np.cumsum(edge[:-1]) == 0


def collapse(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, with_text: bool = False) -> DataFrame:
    """One row per row of ``docs``: id, n_runs, start, length, period and
    exponent_milli of the run with the greatest length/period (null without
    runs), runs_sha256 (of every run's ``start,length,period`` and a line feed),
    collapsed_sha256 (of the words that no run holds after its first period,
    joined by a space), with ``with_text`` also collapsed and runs.

    Words are runs of bytes other than space and tab
    to carriage return. Null and empty texts have no words and no runs; a text
    of any length is searched whole (one over the slice's bound is a slice of
    its own); rows that share an id or are equal are searched one by one; other
    columns, whatever their names, are ignored; an empty table gives an empty
    result.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    schema = (f"id {kind}, n_runs long, start long, length long, period long, exponent_milli long, "
              "runs_sha256 string, collapsed_sha256 string") + ", collapsed string, runs string" * with_text

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            number, words, texts = _Numbers(), [], []
            for text in utf8(batch, "text"):
                words.append(w := text.split())
                texts.append(np.fromiter(map(number.__getitem__, w), dtype=np.int64, count=len(w)))
            out: list[list] = [[] for _ in range(9)]
            for w, runs in zip(words, find_runs(texts, len(number)), strict=True):
                top = best(runs)
                listed = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
                text = b" ".join([x for x, k in zip(w, kept(len(w), runs).tolist(), strict=True) if k] if runs else w)
                row = (len(runs), *(top or (None,) * 3), top and 1000 * top[1] // top[2],
                       hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(text).hexdigest(), text.decode(), listed)
                for column, value in zip(out, row, strict=True):
                    column.append(value)
            kinds = [pa.int64()] * 5 + [pa.string()] * 4
            columns = [pa.array(c, k) for c, k in zip(out, kinds, strict=True)][:9 if with_text else 7]
            yield pa.RecordBatch.from_arrays([batch.column("id"), *columns], names=[
                "id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256",
                "collapsed", "runs"][:len(columns) + 1])

    out = rows.mapInArrow(search, schema)
    return out.select(F.col("id").alias(id_col), *out.columns[1:])


def plant_repetitions(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text) with repetitions planted in about a tenth of the texts: with
    h the crc32 of the id as text and g = floor(h / 10), where h is divisible by
    10, each of the n words from a = g mod n on becomes word a + (i - a) mod p,
    p = 1 + floor((n - a) / (3 + g mod 8)). Other texts, and those of a null id,
    stay as they are."""
    h = F.crc32(F.col(id_col).cast("string").cast("binary"))
    rows = docs.select(F.col(id_col), F.col(text_col).alias("_text"), F.when(h % 10 == 0, F.floor(h / 10)).alias("_g"))
    rows = rows.withColumn("_w", F.when(F.col("_g").isNotNull(), F.array_remove(F.split("_text", r"[\x20\x09-\x0D]+"), "")))
    n = F.size("_w")
    rows = rows.withColumn("_a", F.when(n > 0, (F.col("_g") % n).cast("int")))
    rows = rows.withColumn("_p", 1 + F.floor((n - F.col("_a")) / (3 + F.col("_g") % 8)).cast("int"))
    ids = F.sequence(F.lit(0), n - 1)
    planted = F.array_join(F.transform(ids, lambda i: F.col("_w")[F.when(
        i < F.col("_a"), i).otherwise(F.col("_a") + (i - F.col("_a")) % F.col("_p"))]), " ")
    return rows.select(F.col(id_col), F.when(F.col("_a").isNotNull(), planted).otherwise(F.col("_text")).alias(text_col))
