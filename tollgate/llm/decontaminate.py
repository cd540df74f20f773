"""Benchmark decontamination with a broadcast set of normalised test n-grams.

Words are runs of letters, digits and non-ASCII characters after A-Z is
lower-cased. A window is ``n`` consecutive words of an item (all of a shorter
item). The set holds a 64-bit hash of every window in a sorted array, with the
window's place in the items' words; texts are scanned where they are, every window
of theirs is hashed, and where the hash is in the set the words are compared, so
that nothing but equal words is a hit.

The set is broadcast, so the benchmark is dealt into slices of about
``slice_chars`` characters of text, a few bytes of memory for each; each slice is
one scan over the rows, in a chain without any shuffle that is written out after
every fourth. A benchmark of usual size is one slice.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WORD_BYTES, slices, utf8, worker_cache, written

_WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
_FOUND = "spans array<struct<start:long,end:long>>, items array<string>"
#: What an item takes beside its text, counted as characters of it.
ITEM_CHARS = 64
#: Words whose hashes a worker keeps.
WORKER_ENTRIES = 100_000


def words(text: bytes) -> list[bytes]:
    return text.translate(WORD_BYTES).split()


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > WORKER_ENTRIES:
            self.clear()
        self[word] = h = xxhash.xxh64_intdigest(word)
        return h


def _window_hashes(h: np.ndarray, k: int) -> np.ndarray:
    """A hash of each k neighbouring words, from the hashes of the words."""
    n = len(h) - k + 1
    out = h[:n].copy()
    for j in range(1, k):
        out *= np.uint64(0x9E3779B97F4A7C15)
        out += h[j:j + n]
    out ^= out >> np.uint64(31)
    return out


@dataclass(frozen=True)
class Windows:
    """The windows of a slice of the benchmark. ``words``: all words, a space after
    each; ``at``: where each begins; ``first``: the first word of each item;
    ``grams``: window length -> (sorted hashes, first word of each window, a bitmap
    over the hashes' high bits)."""

    words: bytes
    at: np.ndarray
    first: np.ndarray
    ids: pa.Array
    grams: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]

    def items(self, gram: bytes, k: int, low: int, high: int) -> set[str | None]:
        """The ids of the items that hold ``gram`` (words, a space after each), of
        the windows from low to high."""
        place = self.grams[k][1][low:high]
        same = [p for p in place.tolist() if self.words[self.at[p]:self.at[p + k]] == gram]
        return {self.ids[i].as_py() for i in np.searchsorted(self.first, same, side="right") - 1}


def windows(items: Iterable[tuple[str | None, str | None]], n: int) -> Windows:
    """The set for (id, text) rows; items without an id have windows too."""
    cache, blob, sizes, hashes, first, ids = _Hashes(), [], array("I"), array("Q"), array("q"), []
    for item, text in items:
        w = words((text or "").encode())
        if w:
            first.append(len(hashes))
            ids.append(item)
            blob.append(b" ".join(w))
            sizes.extend(map(len, w))
            hashes.extend(map(cache.__getitem__, w))
    h, starts = np.frombuffer(hashes, dtype=np.uint64), np.frombuffer(first, dtype=np.int64)
    at = np.zeros(len(h) + 1, dtype=np.uint32)
    np.cumsum(np.frombuffer(sizes, dtype=np.uint32) + 1, out=at[1:], dtype=np.uint32)
    counts = np.diff(np.r_[starts, len(h)])
    grams = {}
    for k in np.unique(np.minimum(counts, n)).tolist():
        own = counts == k if k < n else counts >= n
        if k < n:
            place = starts[own]
        else:  # every start that leaves room for a window in its item
            room = np.repeat(starts + counts - k, counts)
            place = np.flatnonzero((np.arange(len(h)) <= room) & np.repeat(own, counts))
        found = _window_hashes(h, k)[place]
        order = np.argsort(found, kind="stable")
        found, place = found[order], place[order].astype(np.uint32)
        bits = min(30, max(10, len(found).bit_length() + 4))
        filled = np.zeros(1 << bits >> 3, dtype=np.uint8)
        high = found >> np.uint64(64 - bits)
        np.bitwise_or.at(filled, (high >> np.uint64(3)).astype(np.int64), np.uint8(1) << (high & np.uint64(7)).astype(np.uint8))
        grams[k] = (found, place, filled)
    return Windows(b"".join(x + b" " for x in blob), at, starts, pa.array(ids, pa.string()), grams)


def scan(texts: list[list[bytes]], known: Windows) -> list[tuple[list[tuple[int, int]], set[str]]]:
    """For each text, as its words: the merged word spans that windows cover, and
    the ids of their items."""
    cache = worker_cache("word hashes", _Hashes)
    every = [x for w in texts for x in w]
    h = np.fromiter(map(cache.__getitem__, every), dtype=np.uint64, count=len(every))
    counts = np.array([len(w) for w in texts], dtype=np.int64)
    ends = np.cumsum(counts)
    covers: list[list[tuple[int, int]]] = [[] for _ in texts]
    items: list[set] = [set() for _ in texts]
    room = np.repeat(ends, counts)
    for k, (hashes, _, filled) in known.grams.items():
        if len(h) < k:
            continue
        found = _window_hashes(h, k)
        bits = (len(filled) * 8).bit_length() - 1
        high = found >> np.uint64(64 - bits)
        maybe = np.flatnonzero((filled[(high >> np.uint64(3)).astype(np.int64)] >> (high & np.uint64(7)).astype(np.uint8) & 1)
                               .astype(bool) & (np.arange(len(found)) + k <= room[:len(found)]))
        low, top = np.searchsorted(hashes, found[maybe]), np.searchsorted(hashes, found[maybe], side="right")
        hit, seen = low < top, {}
        for i, a, b in zip(maybe[hit].tolist(), low[hit].tolist(), top[hit].tolist(), strict=True):
            gram = b"".join(x + b" " for x in every[i:i + k])
            if gram not in seen:
                seen[gram] = known.items(gram, k, a, b)
            if seen[gram]:
                d = int(np.searchsorted(ends, i, side="right"))
                start = i - int(ends[d] - counts[d])
                covers[d].append((start, start + k))
                items[d] |= seen[gram]
    return [(_merged(c), x - {None}) for c, x in zip(covers, items, strict=True)]


def _slices(benchmark: DataFrame, item_col: str, text_col: str, slice_chars: int) -> Iterator[pa.Table]:
    """The benchmark's items, dealt by a hash of the row, slice by slice."""
    rows = benchmark.select(F.col(item_col).cast("string").alias("item"), F.col(text_col).alias("text")).filter("text is not null")
    size = rows.agg(F.sum(F.length("text") + F.lit(ITEM_CHARS))).first()[0] or 0
    n = -(-size // slice_chars) or 1
    for k in range(n):
        yield rows.filter(F.pmod(F.xxhash64("item", "text"), F.lit(n)) == k).toArrow()


def _rows(items: pa.Table) -> Iterator[tuple[str | None, str]]:
    for batch in items.to_batches(max_chunksize=1_000):
        yield from zip(batch.column("item").to_pylist(), batch.column("text").to_pylist(), strict=True)


def find_windows(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", *, item_col: str = "item_id",
                 item_text_col: str = "text", n: int = 13, slice_chars: int = 32_000_000) -> DataFrame:
    """``docs`` with a column ``found``: n_words, the word spans that benchmark
    windows cover (end exclusive, apart from each other), and the ids of the
    items whose windows occur, as strings.

    Null and empty texts have no words; a text of any length is scanned whole;
    repeated rows are scanned one by one; an empty table gives an empty result.
    Items without words are ignored, those without an id have windows but are not
    among the ids; repeated items count once. An existing column ``found`` is
    replaced, others stay.
    """
    spark = docs.sparkSession
    cols = [c for c in docs.columns if c != "found"]
    kinds = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in cols)
    schema = f"{kinds}, found struct<n_words:long, {_FOUND.replace(' array', ':array')}>"
    out = docs.select(*cols, F.lit(None).cast("struct<n_words:long," + _FOUND.replace(" array", ":array") + ">").alias("found"))
    for k, items in enumerate(_slices(benchmark, item_col, item_text_col, slice_chars)):
        out = written(out, "decontaminate") if k and k % 4 == 0 else out
        known = spark.sparkContext.broadcast(windows(_rows(items), n))

        def search(batches: Iterator[pa.RecordBatch], known=known) -> Iterator[pa.RecordBatch]:
            for batch in slices(batches):
                found = []
                texts = [words(t) for t in utf8(batch, text_col)]
                for w, (spans, items), before in zip(texts, scan(texts, known.value), batch.column("found").to_pylist(), strict=True):
                    if before:
                        spans = _merged(spans + [(x["start"], x["end"]) for x in before["spans"]])
                        items.update(before["items"])
                    found.append({"n_words": len(w), "spans": [{"start": a, "end": b} for a, b in spans],
                                  "items": sorted(items)})
                kind = batch.schema.field("found").type
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in cols), pa.array(found, kind)],
                                                 names=[*cols, "found"])

        out = out.mapInArrow(search, schema)
    return out


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  *, share: int = 20, **options) -> DataFrame:
    """One row per row of ``docs``: id, n_words, n_hit, n_items, items_sha256
    (of the sorted ids, comma-joined) and contaminated: some word is hit, and
    at least one word in ``share``."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    found = find_windows(rows, benchmark, "text", **options).select("id", "found.*")
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return found.select(
        F.col("id").alias(id_col), "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        ((n_hit > 0) & (share * n_hit >= F.col("n_words"))).alias("contaminated"))


def _cut(text: str, spans: list[dict]) -> str:
    places = [m.span() for m in _WORD.finditer(text)]
    kept, end = [], 0
    for s in spans:
        kept.append(text[end:places[s["start"]][0]])
        end = places[s["end"] - 1][1]
    return "".join([*kept, text[end:]])


def decontaminate(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", *, remove: str = "documents",
                  share: int = 20, **options) -> DataFrame:
    """``docs`` without its contaminated rows (``remove="documents"``) or with
    the covered spans cut out of every text (``remove="spans"``). Columns stay;
    clean rows stay as they are."""
    if remove not in ("documents", "spans"):
        raise ValueError(f"remove: documents or spans, not {remove!r}")
    cols = docs.columns
    inner = docs.toDF(*(f"c{i}" for i in range(len(cols))))
    found = find_windows(inner, benchmark, f"c{cols.index(text_col)}", **options)
    if remove == "documents":
        n_hit = F.aggregate("found.spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
        kept = found.filter(~((n_hit > 0) & (share * n_hit >= F.col("found.n_words"))))
        return kept.drop("found").toDF(*cols)

    text = f"c{cols.index(text_col)}"

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = [_cut(t, f["spans"]) if f["spans"] else t
                     for t, f in zip(batch.column(text).to_pylist(), batch.column("found").to_pylist(), strict=True)]
            names = [c for c in batch.schema.names if c != "found"]
            yield pa.RecordBatch.from_arrays(
                [pa.array(texts, pa.string()) if c == text else batch.column(c) for c in names], names=names)

    return found.mapInArrow(cut, inner.schema).toDF(*cols)
