"""Token counts by a map-side two-tier look-up.

Tier one is a compact hash table of the corpus's frequent pre-tokens (as
space-led chunks, see ``bpe``) and their token counts. Each task sketches the
chunks of its own rows in a bounded counter; only its heaviest entries leave
the task, as one row. Sketches are merged as a tree, each merge keeping the
heaviest ``table_size``, and the last one is broadcast - keys of at most
``MAX_KEY`` characters, whatever the corpus. Tier two is a bounded
cache in each Python worker, where a miss is encoded once by the tokenizer.
No pre-token is a row or a key of any shuffle, and texts never leave their task.
"""

from __future__ import annotations

import uuid
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bpe
from .common import slices, strings, worker_cache

TOKENIZER = "byte_bpe_50k.json"
MAX_KEY = 64
#: Entries a worker's counter or cache may hold before it is pruned or emptied.
WORKER_ENTRIES = 200_000
#: Groups of sketches at each level of the tree. A merge reads its sketches as a
#: stream, so the first level takes those of any number of tasks.
LEVELS = (1_024, 32, 1)
_SKETCH = "part long, chunks array<string>, counts array<long>"


def _sketch_row(part: int, counts: Counter[str], most: int) -> pa.RecordBatch:
    top = sorted(counts.items(), key=lambda kv: (-kv[1], kv[0]))[:most]
    return pa.RecordBatch.from_pydict({
        "part": pa.array([part], pa.int64()), "chunks": pa.array([[k for k, _ in top]], pa.list_(pa.string())),
        "counts": pa.array([[n for _, n in top]], pa.list_(pa.int64()))})


def merged(sketches: DataFrame, groups: int, table_size: int) -> DataFrame:
    """Sketches (part, chunks, counts) whose part is the same modulo ``groups``
    as one of at most ``table_size`` entries, its part the remainder."""

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[str] = Counter()
        part = None
        for batch in batches:
            for i in range(batch.num_rows):  # one sketch as Python objects at a time
                here = batch.column("part")[i].as_py()
                if part is not None and here != part:
                    yield _sketch_row(part, counts, table_size)
                    counts.clear()
                part = here
                for k, n in zip(batch.column("chunks")[i].as_py(), batch.column("counts")[i].as_py(), strict=True):
                    counts[k] += n
                if len(counts) > WORKER_ENTRIES:
                    counts = Counter(dict(counts.most_common(WORKER_ENTRIES // 2)))
        if part is not None:
            yield _sketch_row(part, counts, table_size)

    dealt = sketches.withColumn("part", F.pmod("part", F.lit(groups)))
    return dealt.repartition("part").sortWithinPartitions("part").mapInArrow(merge, _SKETCH)


def frequent_chunks(docs: DataFrame, text_col: str = "text", table_size: int = 32_768,
                    per_task: int = 4_096, tokenizer: str = TOKENIZER) -> dict[str, int]:
    """Token counts of the corpus's frequent chunks (at most ``table_size``).

    Every text is read. A task's counter drops its rarest half when full, so
    counts are lower bounds; they only rank what to broadcast, and a chunk that
    is missing here costs a look-up in the worker, never a wrong count.
    """

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[str] = Counter()
        part = None
        for batch in slices(batches):
            part = batch.column("part")[0].as_py()
            for text in strings(batch, "text"):
                counts.update(bpe.chunks(text)[1:])
                if len(counts) > WORKER_ENTRIES:
                    counts = Counter(dict(counts.most_common(WORKER_ENTRIES // 2)))
        if part is not None:
            yield _sketch_row(part, Counter({k: n for k, n in counts.items() if len(k) <= MAX_KEY}), per_task)

    tree = docs.select(F.spark_partition_id().cast("long").alias("part"), F.col(text_col).alias("text")).mapInArrow(sketch, _SKETCH)
    for groups in LEVELS:
        tree = merged(tree, groups, table_size)
    root = tree.collect()  # a row at most
    keys = root[0].chunks if root else []
    encoded = bpe.tokenizer(tokenizer).encode_batch([" " + k for k in keys], add_special_tokens=False)
    return {k: len(e) for k, e in zip(keys, encoded, strict=True)}


class _Lengths(dict):
    """Chunk -> token count: the broadcast entries, and misses as they come."""

    def __init__(self, frequent: dict[str, int], tokenizer: str):
        super().__init__(frequent)
        self.frequent, self.encode = frequent, bpe.tokenizer(tokenizer).encode

    def __missing__(self, chunk: str) -> int:
        if len(self) > len(self.frequent) + WORKER_ENTRIES:
            self.clear()
            self.update(self.frequent)
        n = len(self.encode(" " + chunk, add_special_tokens=False))
        if len(chunk) <= MAX_KEY:
            self[chunk] = n
        return n


def count_tokens(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, limit: int = 1024,
                 tokenizer: str = TOKENIZER, table_size: int = 32_768) -> DataFrame:
    """One row per row of ``docs``: id, n_bytes (UTF-8), n_tokens, over_limit.

    Null and empty texts have 0 bytes and 0 tokens, texts of any length are counted
    whole; ids may be null or repeat, every row is counted by itself; other columns,
    whatever their names, are ignored; an empty table gives an empty result.
    """
    frequent = frequent_chunks(docs, text_col, table_size, tokenizer=tokenizer)
    shared, key = docs.sparkSession.sparkContext.broadcast(frequent), uuid.uuid4().hex

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengths = worker_cache(("token lengths", key), lambda: _Lengths(shared.value, tokenizer))
        encode = bpe.tokenizer(tokenizer).encode
        for batch in slices(batches):
            n_bytes, n_tokens = [], []
            for text in strings(batch, "text"):
                n_bytes.append(len(text.encode()))
                n = 0
                for i, part in enumerate(bpe.segments(text, tokenizer)):
                    if i % 2:
                        n += 1
                    elif part:
                        first, *rest = bpe.chunks(part)
                        n += len(encode(first, add_special_tokens=False)) + sum(map(lengths.__getitem__, rest))
                n_tokens.append(n)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(n_bytes, pa.int64()), pa.array(n_tokens, pa.int64())],
                names=[id_col, "n_bytes", "n_tokens"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    return (rows.mapInArrow(count, f"`{id_col}` {kind}, n_bytes long, n_tokens long")
            .withColumn("over_limit", F.col("n_tokens") > limit))
