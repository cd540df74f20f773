"""Sequence packing by bounded-space online best-fit.

Documents become token ids and an end id; only those longer than a sequence are
cut, into full pieces and one rest. Rests arrive one by one. A fixed number of
sequences is open at a time, kept in a bitset by their free space: a rest goes to
the open sequence with the least space that it fits in (the lowest bit from its
length on); where none has room a new one is opened, and if too many are open the
fullest (the lowest bit) closes first. What a task holds does not depend on the
input: the open sequences, and one Arrow batch.

Rests are dealt to tasks by the hash of their row's number, so neither a hot id nor
equal rows meet. In a task long ones arrive first: the short ones then close the gaps.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bpe
from .common import slices, strings, worker_cache, written

TOKENIZER, END = "word_bpe_49k.json", 0
SIZE, OPEN = 2048, 32_768
#: Rests that one task packs, about; each task leaves its open sequences as they are.
PACKED_ROWS = 100_000
WORKER_ENTRIES, CACHED_CHARS = 400_000, 64


#: Letters whose lower case and composition are the same everywhere, and where marks
#: follow such a letter up to a space: they are a pre-token of their own.
_LETTERS = "A-Za-zÀ-ÖØ-öø-įı-ž"
_WORD, _OTHER = re.compile(f"[{_LETTERS}]+"), re.compile("[^\x00-\u012f\u0131-\u017f]")
_MARKED = re.compile(f"(?<=[{_LETTERS}])(?=[.,;:!?]+(?:[ \\n]|$))")
#: How byte-level vocabularies write bytes: printable ones of Latin-1 as they are,
#: the others in order from 256 on.
_SHOWN = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
_BYTES = {b: 256 + k for k, b in enumerate(sorted(set(range(256)) - set(_SHOWN)))}


def _packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


class _Ids(dict):
    """Stretch between spaces -> its token ids as 32-bit bytes. A word goes to the
    tokenizer's model at once, without what the tokenizer does before."""

    def __init__(self, tokenizer: str):
        super().__init__()
        whole = bpe.tokenizer(tokenizer)
        self.encode, self.tokenize = whole.encode, whole.model.tokenize

    def __missing__(self, stretch: str) -> bytes:
        if _WORD.fullmatch(stretch):
            lower = stretch.lower()
            shown = lower if lower.isascii() else lower.encode().decode("latin-1").translate(_BYTES)
            ids = _packed([t.id for t in self.tokenize(shown)])
        else:
            ids = _packed(self.encode(stretch, add_special_tokens=False).ids)
        if len(stretch) <= CACHED_CHARS:
            if len(self) > WORKER_ENTRIES:
                self.clear()
            self[stretch] = ids
        return ids


def token_bytes(text: str, tokenizer: str = TOKENIZER, end: int = END) -> bytes:
    """The ids of a text as a word-level tokenizer gives them, and the end id, as
    little-endian unsigned 32-bit integers. White space always ends a word and never
    joins a character after it, so the stretches between spaces and line feeds are
    encoded by themselves, and marks at the end of a word too; a text that may hold an
    added token is encoded as a whole."""
    ids = worker_cache(("word ids", tokenizer), lambda: _Ids(tokenizer))
    if "<|" in text:
        return _packed([*bpe.tokenizer(tokenizer).encode(text, add_special_tokens=False).ids, end])
    if not _OTHER.search(text):
        text = text.lower()
    stretches = _MARKED.sub(" ", text).replace("\n", " ").split(" ")
    return b"".join(map(ids.__getitem__, stretches)) + _packed([end])


class OpenSequences:
    """At most ``most`` open sequences of ``size``, by their free space."""

    def __init__(self, size: int, most: int):
        self.size, self.most = size, most
        self.bits, self.count, self.opened = 0, 0, 0
        self.by_free: list[list[int]] = [[] for _ in range(size)]

    def _take(self, free: int) -> int:
        left = self.by_free[free]
        number = left.pop()
        if not left:
            self.bits ^= 1 << free
        return number

    def place(self, length: int) -> tuple[int, int]:
        """(sequence, offset) for an item of 1 to ``size``."""
        roomy = self.bits >> length
        if roomy:
            free = length + (roomy & -roomy).bit_length() - 1
            number = self._take(free)
        else:
            if self.count == self.most:
                self._take((self.bits & -self.bits).bit_length() - 1)
                self.count -= 1
            free, number = self.size, self.opened
            self.opened += 1
            self.count += 1
        if rest := free - length:
            if not self.by_free[rest]:
                self.bits |= 1 << rest
            self.by_free[rest].append(number)
        else:
            self.count -= 1
        return number, self.size - free


def cut(docs: DataFrame, id_col: str, text_col: str, size: int, tokenizer: str, with_ids: bool = False) -> DataFrame:
    """One row per piece: id, piece, start, length, ids_crc32, number (no other
    piece of this table has it) and, with ``with_ids``, the ids."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.spark_partition_id().alias("part"))
    kind = rows.schema["id"].dataType.simpleString()
    names = ["id", "piece", "start", "length", "ids_crc32", "number"] + ["ids"] * with_ids
    schema = f"id {kind}, piece int, start long, length long, ids_crc32 long, number long" + ", ids binary" * with_ids

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = 0
        for batch in slices(batches):
            at, out = [], []
            first = batch.column("part")[0].as_py() << 36
            for row, text in enumerate(strings(batch, "text")):
                data = token_bytes(text, tokenizer)
                for k, low in enumerate(range(0, len(data), 4 * size)):
                    ids = data[low:low + 4 * size]
                    at.append(row)
                    out.append((k, low // 4, len(ids) // 4, zlib.crc32(ids), first + number, ids))
                    number += 1
            columns = list(zip(*out, strict=True))[:len(names) - 1]
            kinds = [pa.int32(), *[pa.int64()] * 4, pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").take(pa.array(at, pa.int64())), *(pa.array(c, k) for c, k in zip(columns, kinds))], names=names)

    return rows.mapInArrow(pieces, schema)


def best_fit(items: DataFrame, size: int = SIZE, most: int = OPEN, *, length_col: str = "length", number_col: str = "number",
             rows_per_task: int = PACKED_ROWS) -> DataFrame:
    """``items`` with sequence_id and offset. Lengths are 1 to ``size``; numbers
    are distinct. ``items`` is read twice: its rows are counted first."""
    cols = items.columns
    tasks = max(1, -(-items.count() // rows_per_task))
    dealt = items.repartition(tasks, number_col).sortWithinPartitions(F.desc(length_col), number_col).withColumn("_part", F.spark_partition_id())

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = OpenSequences(size, most)
        for batch in slices(batches):
            found = [held.place(n) for n in batch.column(length_col).to_pylist()]
            first = batch.column("_part")[0].as_py() << 36
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in cols), pa.array([first + n for n, _ in found], pa.int64()),
                 pa.array([offset for _, offset in found], pa.int64())], names=[*cols, "sequence_id", "offset"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in items.schema)
    return dealt.mapInArrow(place, f"{kinds}, sequence_id long, offset long")


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, size: int = SIZE, most: int = OPEN,
         tokenizer: str = TOKENIZER, rows_per_task: int = PACKED_ROWS, with_ids: bool = False) -> DataFrame:
    """One row per piece: id, piece (from 0), start, length, ids_crc32, sequence_id,
    offset (and ids with ``with_ids``).

    Null and empty texts are a single end id; a text of any length is cut whole.
    Ids may be null or repeat, and rows may be equal: each row is a document, and
    of equal lengths the piece cut first comes first. Full pieces are a sequence of their own, with ids from
    2**62 on. Other columns, whatever their names, are ignored; an empty table
    gives an empty result.
    """
    pieces = written(cut(docs, id_col, text_col, size, tokenizer, with_ids), "best-fit-pieces")
    full = pieces.filter(F.col("length") == size).withColumn("sequence_id", F.col("number") + F.lit(1 << 62)).withColumn(
        "offset", F.lit(0).cast("long"))
    placed = best_fit(pieces.filter(F.col("length") < size), size, most, rows_per_task=rows_per_task)
    return full.unionByName(placed).select(
        F.col("id").alias(id_col), "piece", "start", "length", "ids_crc32", "sequence_id", "offset", *["ids"] * with_ids)
