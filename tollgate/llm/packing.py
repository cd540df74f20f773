"""Sequence packing: shortest-pack-first over the length histogram.

A document's tokens are cut into full sequences and one rest. The rests are
counted by length; the histogram (at most ``size`` rows) is packed by placing
lengths longest first, each into the pack that is shortest so far and has room,
and keeping counts of equal packs as patterns. The patterns go back to the
documents by rank: the k-th rest of a length takes the k-th place that the
patterns have for that length. Ranks come from counts per salt and a row number
within a salt, so no task holds a whole length.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import bpe
from .common import slices, strings, worker_cache, written

TOKENIZER, RANKS, END = "byte_bpe_50k.json", "byte_bpe_50k.tiktoken", 0
#: Rows that one task ranks, about.
RANKED_ROWS = 200_000
WORKER_ENTRIES = 150_000


def patterns(histogram: dict[int, int], size: int) -> list[tuple[list[int], int]]:
    """Shortest-pack-first histogram packing: (lengths of a pack, how many packs).

    Every length of ``histogram`` (length -> count, 1 to ``size``) is placed as
    often as it is counted.
    """
    open_packs: list[list[tuple[list[int], int]]] = [[] for _ in range(size + 1)]  # by length so far
    for length in sorted(histogram, reverse=True):
        count = histogram[length]
        filled = 0
        while count:
            while filled <= size - length and not open_packs[filled]:
                filled += 1
            if filled == 0 or filled > size - length:  # nothing has room: packs of this length alone
                fit = size // length
                if count >= fit:
                    open_packs[fit * length].append(([length] * fit, count // fit))
                if count % fit:
                    open_packs[count % fit * length].append(([length] * (count % fit), 1))
                count = 0
                continue
            pack, n = open_packs[filled].pop()
            fit = min((size - filled) // length, count)
            used = min(n, count // fit)
            if n > used:
                open_packs[filled].append((pack, n - used))
            open_packs[filled + fit * length].append((pack + [length] * fit, used))
            count -= used * fit
    return [p for packs in open_packs for p in packs]


def places(packs: list[tuple[list[int], int]], first_id: int) -> list[tuple[int, int, int, int, int, int]]:
    """Rows (length, from_rank, to_rank, first sequence, places in each, offset):
    rank r of a length lies in sequence first + (r - from) / places, at offset +
    length * ((r - from) % places) of it."""
    rows, taken, sequence = [], {}, first_id
    for lengths, n in packs:
        offset = 0
        for length in sorted(set(lengths), reverse=True):
            k = lengths.count(length)
            start = taken.get(length, 0)
            taken[length] = start + n * k
            rows.append((length, start, start + n * k, sequence, k, offset))
            offset += k * length
        sequence += n
    return rows


#: Characters above Latin letters: the classes of the two libraries need not agree there.
_WIDE = re.compile("[^\x00-\u024f]")
#: The rank encoder cannot take white space of any length; runs from here on go to the tokenizer.
RUN = 1 << 15
_RUN = re.compile(rf"\s{{{RUN}}}")
#: Characters that the rank encoder takes at a time, about, and those of a stretch
#: in texts that also hold what it does not take.
STRETCH, MIXED_STRETCH = 1 << 20, 256


def _packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


def _ranked(text: str) -> bool:
    """Whether the rank encoder gives this text's ids as the tokenizer does."""
    return (text.isascii() or not _WIDE.search(text)) and (len(text) < RUN or not _RUN.search(text))


def _by_ranks(text: str) -> bytes:
    return _packed(bpe.rank_encoder(RANKS).encode_ordinary(text))


def _by_tokenizer(text: str) -> bytes:
    return _packed(bpe.tokenizer(TOKENIZER).encode(text, add_special_tokens=False).ids)


def _encode(chunk: str) -> bytes:
    if not chunk:
        return b""
    return _by_ranks(chunk) if _ranked(chunk) else _by_tokenizer(chunk)


class _Ids(dict):
    """Chunk (without its leading space) -> its token ids as 32-bit bytes."""

    def __missing__(self, chunk: str) -> bytes:
        if len(self) > WORKER_ENTRIES:
            self.clear()
        ids = _encode(" " + chunk)
        if len(chunk) <= 64:
            self[chunk] = ids
        return ids


def token_bytes(text: str) -> bytes:
    """The ids of a text as the tokenizer gives them, and the end id, as
    little-endian unsigned 32-bit integers. Texts of Latin letters go through the rank
    encoder in long stretches, without a look-up by chunk: where most words are rare
    a look-up misses too often. Others are cut into short stretches, and only those
    that it does not take are looked up by chunk."""
    ids = worker_cache("token ids", _Ids)
    out = []
    for i, part in enumerate(bpe.segments(text, TOKENIZER)):
        if i % 2:
            out.append(_by_tokenizer(part))
            continue
        for stretch in bpe.stretches(part, STRETCH if _ranked(part) else MIXED_STRETCH):
            if _ranked(stretch):
                out.append(_by_ranks(stretch))
            else:
                first, *rest = bpe.chunks(stretch)
                out.append(_encode(first))
                out += map(ids.__getitem__, rest)
    out.append(_packed([END]))
    return b"".join(out)


def cut(docs: DataFrame, id_col: str, text_col: str, size: int, with_ids: bool = False) -> DataFrame:
    """One row per piece: id, start, length, ids_crc32, doc_tokens, no (a number
    that no other piece of this table has), and with ``with_ids`` the ids
    themselves."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.spark_partition_id().alias("part"))
    kind = rows.schema["id"].dataType.simpleString()
    schema = f"id {kind}, start long, length long, ids_crc32 long, doc_tokens long, no long" + ", ids binary" * with_ids

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        no = 0
        for batch in slices(batches):
            out: list[list] = [[] for _ in range(7)]
            part = batch.column("part")[0].as_py() << 36
            at = []
            for row, text in enumerate(strings(batch, "text")):
                data = token_bytes(text)
                n = len(data) // 4
                for start in range(0, n, size):
                    piece = data[4 * start:4 * (start + size)]
                    k = len(piece) // 4
                    at.append(row)
                    out[1].append(start)
                    out[2].append(k)
                    out[3].append(zlib.crc32(piece))
                    out[4].append(n)
                    out[5].append(part + no)
                    no += 1
                    if with_ids:
                        out[6].append(piece)
            columns = [batch.column("id").take(pa.array(at, pa.int64())), *(pa.array(c, pa.int64()) for c in out[1:6])]
            names = ["id", "start", "length", "ids_crc32", "doc_tokens", "no"]
            yield pa.RecordBatch.from_arrays(columns + [pa.array(out[6], pa.binary())] * with_ids, names=names + ["ids"] * with_ids)

    return rows.mapInArrow(pieces, schema)


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, size: int = 1024,
         with_ids: bool = False) -> DataFrame:
    """One row per piece: id, start, length, ids_crc32, doc_tokens, sequence_id,
    offset (and ids with ``with_ids``).

    Null and empty texts are a single end id. Ids may be null or repeat: each
    row is a document. Full pieces fill a sequence of their own, whose id is
    at least 2**62; sequences of rests are numbered from 0. Texts of any length are
    cut whole. Equal rows are dealt by the number of their piece, not by what they
    hold, so that any number of them spreads over all tasks. An empty table gives an
    empty result; other columns, whatever their names, are ignored.
    """
    spark = docs.sparkSession
    cutted = written(cut(docs, id_col, text_col, size, with_ids), "packing-pieces")
    keep = ["id", "start", "length", "ids_crc32", "doc_tokens", *(["ids"] if with_ids else [])]
    full = cutted.filter(F.col("length") == size).select(
        *keep, (F.col("no") + F.lit(1 << 62)).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))

    rests = cutted.filter(F.col("length") < size)
    n = rests.count()
    salts = max(64, -(-n // RANKED_ROWS))
    rests = rests.withColumn("salt", F.pmod(F.xxhash64("no"), F.lit(salts)).cast("int"))
    counts = rests.groupBy("length", "salt").agg(F.count("*").alias("n"))
    by_length = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    bases = written(counts.withColumn("base", F.coalesce(F.sum("n").over(by_length), F.lit(0))), "packing-ranks")
    histogram = {r.length: r.n for r in bases.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    rows = places(patterns(histogram, size), 0)
    names = ["length", "from_rank", "to_rank", "sequence", "k", "place"]
    # From an Arrow table: a list would start Python workers of another kind, which then stay.
    table = spark.createDataFrame(pa.table([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], names)) if rows else None
    ranked = (rests.withColumn("row", F.row_number().over(Window.partitionBy("length", "salt").orderBy("no")))
              .join(bases.select("length", "salt", "base"), ["length", "salt"])
              .withColumn("rank", F.col("base") + F.col("row") - 1))
    if table is None:
        return full.select(F.col("id").alias(id_col), *keep[1:], "sequence_id", "offset")
    # At most a few places for each of the lengths: the broadcast is bounded by
    # ``size`` and the patterns, not by the documents.
    ahead = F.col("rank") - F.col("from_rank")
    placed = (ranked.join(F.broadcast(table), "length").filter("rank >= from_rank and rank < to_rank")
              .select(*keep, (F.col("sequence") + F.floor(ahead / F.col("k"))).cast("long").alias("sequence_id"),
                      (F.col("place") + ahead % F.col("k") * F.col("length")).alias("offset")))
    return full.unionByName(placed).select(F.col("id").alias(id_col), *keep[1:], "sequence_id", "offset")
