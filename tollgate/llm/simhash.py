"""SimHash near-duplicates by anchor-point covering.

Two 23-bit blocks of a fingerprint are covered by the perfect binary Golay
code: every word of a block is within distance 3 of exactly one codeword. An
anchor is a pair of codewords (2**24 in all). Each fingerprint goes once to the
anchor that covers it (its home) and to every anchor within covering radius
plus threshold: a fingerprint that differs from it in e1 and e2 bits of the two
blocks (e1 + e2 <= ``max_bits``) has its home within 3 + e1 and 3 + e2. So each
pair within the threshold meets at the homes of both, and is kept at the home
of the smaller one: no link is lost and none is found twice. For 2 bits that is
61 anchors on average, whatever the corpus.

Equal fingerprints are merged before they are replicated, so exact copies never
meet; links join distinct fingerprints, and components run over these.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import forget_cache, slices, utf8, written
from .components import components

#: Generator x^11+x^9+x^7+x^6+x^5+x+1 of the [23, 12, 7] Golay code (fixed value).
GOLAY = 0b101011100011
BLOCK, RADIUS = 23, 3
#: Fingerprints that one task replicates, about.
TASK_ROWS = 100_000
_MASK = (1 << BLOCK) - 1


def fingerprint(text: bytes, shingle: int = 3) -> int:
    """64-bit SimHash of the text's word shingles (repeats count), unsigned.
    Words: A-Z lower-cased, split at ASCII white space. No words: 0."""
    w = text.lower().split()
    if not w:
        return 0
    grams = map(b" ".join, zip(*(w[i:] for i in range(shingle)), strict=False)) if len(w) >= shingle else [b" ".join(w)]
    hashes = np.array([xxhash.xxh64_intdigest(g, 42) for g in grams], dtype="<u8")
    ones = np.zeros(64, dtype=np.int64)
    for i in range(0, len(hashes), 1 << 16):  # bounded memory for very long texts
        bits = np.unpackbits(hashes[i:i + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def _remainder(v: int) -> int:
    for i in range(v.bit_length() - 1, 10, -1):
        if v >> i & 1:
            v ^= GOLAY << (i - 11)
    return v


@lru_cache(maxsize=4)
def _cosets(max_bits: int) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
    """Syndromes of the three bytes of a block, and for each syndrome the error
    patterns up to weight RADIUS + max_bits with their weight over RADIUS."""
    of_bit = [_remainder(1 << i) for i in range(BLOCK)]
    by_byte = np.zeros((3, 256), dtype=np.int64)
    for k in range(3):
        for x in range(256):
            for i in range(8):
                if x >> i & 1 and 8 * k + i < BLOCK:
                    by_byte[k, x] ^= of_bit[8 * k + i]
    patterns: list[list[tuple[int, int]]] = [[] for _ in range(1 << 11)]
    for weight in range(RADIUS + max_bits + 1):
        for places in combinations(range(BLOCK), weight):
            error = syndrome = 0
            for i in places:
                error |= 1 << i
                syndrome ^= of_bit[i]
            patterns[syndrome].append((error, max(0, weight - RADIUS)))
    return by_byte, [(np.array([e for e, _ in p], dtype=np.int64), np.array([o for _, o in p])) for p in patterns]


def anchors(value: int, max_bits: int) -> np.ndarray:
    """All anchors within covering radius plus ``max_bits`` of a fingerprint;
    for 0 that is its home."""
    by_byte, patterns = _cosets(max_bits)
    words, errors, over = [], [], []
    for shift in (0, BLOCK):
        word = value >> shift & _MASK
        s = by_byte[0, word & 255] ^ by_byte[1, word >> 8 & 255] ^ by_byte[2, word >> 16]
        words.append(word)
        errors.append(patterns[s][0])
        over.append(patterns[s][1])
    grid = ((words[1] ^ errors[1]) << BLOCK)[:, None] | (words[0] ^ errors[0])[None, :]
    return grid[over[1][:, None] + over[0][None, :] <= max_bits]


def with_fingerprints(docs: DataFrame, text_col: str, shingle: int) -> DataFrame:
    """``docs`` with columns _row (an id of the row) and _fp (signed long)."""
    rows = docs.withColumn("_row", F.monotonically_increasing_id())
    cols = rows.columns

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_cache()
        for batch in slices(batches):
            fps = np.array([fingerprint(t, shingle) for t in utf8(batch, text_col)], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(fps, pa.int64())], names=[*cols, "_fp"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema) + ", _fp long"
    return rows.mapInArrow(add, schema)


def links(fingerprints: DataFrame, max_bits: int) -> DataFrame:
    """(u, v), u > v: pairs of the distinct longs in column fp that differ in at
    least one and at most ``max_bits`` bits; each pair once."""

    def replicate(batches: Iterator[pa.RecordBatch], most: int, name: str) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = batch.column("fp").to_numpy()
            for i in range(0, len(fps), 2_000):
                part = fps[i:i + 2_000]
                found = [anchors(int(x), most) for x in part.view(np.uint64)]
                yield pa.RecordBatch.from_pydict(
                    {"anchor": np.concatenate(found), name: np.repeat(part, [len(a) for a in found])})

    # A fingerprint is 8 bytes and becomes 61 rows: dealt by rows, not bytes.
    tasks = max(fingerprints.sparkSession.sparkContext.defaultParallelism, -(-fingerprints.count() // TASK_ROWS))
    fingerprints = fingerprints.repartition(tasks)
    homes = fingerprints.mapInArrow(lambda b: replicate(b, 0, "v"), "anchor long, v long")
    others = fingerprints.mapInArrow(lambda b: replicate(b, max_bits, "u"), "anchor long, u long")
    near = F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= max_bits
    return others.join(homes, (others.anchor == homes.anchor) & (F.col("v") < F.col("u")) & near).select("u", "v")


def _classes(rows: DataFrame, id_col: str, max_bits: int) -> DataFrame:
    """_fp -> component_id (smallest id reachable) and keeper (a _row with it)."""
    first = F.min(F.struct(F.col(id_col).isNull().alias("none"), F.col(id_col).alias("id"), F.col("_row").alias("row")))
    distinct = written(rows.groupBy("_fp").agg(first.alias("first")), "simhash-distinct")
    linked = components(links(distinct.select(F.col("_fp").alias("fp")), max_bits), "simhash-stars")
    rooted = distinct.join(linked, distinct._fp == linked.node, "left").select(
        "_fp", "first", F.coalesce("root", "_fp").alias("root"))
    rooted = written(rooted, "simhash-roots")
    least = written(rooted.groupBy("root").agg(F.min("first").alias("least")), "simhash-least")
    # Both sides are plain shuffles of tables, so a component or a group of
    # copies that holds many rows is split by adaptive execution.
    return written(rooted.join(least, "root").select("_fp", F.col("least.id").alias("component_id"),
                                                     F.col("least.row").alias("keeper")), "simhash-classes")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, shingle: int = 3,
                    max_bits: int = 2) -> DataFrame:
    """One row per row of ``docs``: id, fingerprint (16 hex digits) and
    component_id, the smallest id that links of at most ``max_bits`` differing
    bits reach.

    Null, empty and white texts have fingerprint zero and are linked like any
    other; texts of any length are read whole. Null ids are never a component_id
    unless a component has no other. Repeated rows stay, each with its result, and
    rows that share an id are documents of their own; other columns, whatever their
    names, are ignored; an empty table gives an empty result.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    rows = written(with_fingerprints(rows, "text", shingle).select("id", "_row", "_fp"), "simhash-rows")
    classes = _classes(rows, "id", max_bits)
    return rows.join(classes, "_fp").select(
        F.col("id").alias(id_col), F.lpad(F.lower(F.hex("_fp")), 16, "0").alias("fingerprint"), "component_id")


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, shingle: int = 3,
                max_bits: int = 2) -> DataFrame:
    """``docs`` with one row of each component: that with the smallest id (of
    rows that share it, one). A null id is kept only where a component has no other.
    Of null, empty and white texts one stays, as they are linked; texts of any length
    are read whole, columns stay as they are, an empty table stays empty."""
    cols = docs.columns
    inner = docs.toDF(*(f"c{i}" for i in range(len(cols))))
    rows = written(with_fingerprints(inner, f"c{cols.index(text_col)}", shingle), "simhash-docs")
    keepers = _classes(rows, f"c{cols.index(id_col)}", max_bits).select(F.col("keeper").alias("_row")).distinct()
    return rows.join(keepers, "_row", "left_semi").select(*inner.columns).toDF(*cols)
