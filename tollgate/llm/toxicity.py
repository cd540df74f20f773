"""Toxicity by gradient-boosted trees over dense features of a text.

Features are densities of a lexicon, the share of its words near a second
person pronoun, capitals, punctuation, digits and obfuscated words. The lexicon
is the seed below plus words and word beginnings that the labelled sample holds
to be toxic in both of its halves. Scores are calibrated by isotonic
regression. Labels enter nowhere but in ``fit``.
"""

from __future__ import annotations

import math
import re
import uuid
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import boosting
from .common import WORD_BYTES, bounded_share, id_text_crc32, slices, utf8, worker_cache

#: Labelled documents that a fit uses at most, about.
SAMPLE = 12_000
#: Learned lexicon entries that a fit takes at most, the most telling first.
LEXICON = 4_000
SEED_LEXICON = ("idiot idiots moron morons stupid dumb loser losers scum trash garbage worthless pathetic "
                "disgusting clown imbecile fool jerk creep freak").split()
SECOND_PERSON = ("you your yours yourself u ur du dich dir dein deine deinen ihr euch euer sie tu te toi ton ta tes "
                 "vous votre vos tú ti usted ustedes vosotros vuestro").split()
NEAR = 5
FEATURES = ("words", "lexicon", "weight", "hits", "heaviest", "distinct", "second_person", "near_second_person",
            "capitals", "exclamations", "questions", "punctuation", "digits", "non_ascii", "obfuscated",
            "obfuscated_hits", "variety", "word_length")
_OBFUSCATED = re.compile(rb"[a-z]+[*@$!0-9]+[a-z]+")
_PLAIN = bytes.maketrans(b"@$!013457", b"asioieast")
_PUNCTUATION = np.array([33 <= c <= 47 or 58 <= c <= 64 or 91 <= c <= 96 or 123 <= c <= 126 for c in range(256)])
_LETTERS = np.array([65 <= c <= 90 or 97 <= c <= 122 for c in range(256)])
#: Words a worker remembers before it starts afresh.
_WORKER_WORDS = 100_000


def terms(word: bytes) -> list[bytes]:
    """What stands for a word in the lexicon: the word, and its beginnings of
    four to six bytes (marked, so that they are not words)."""
    return [word, *(word[:k] + b"~" for k in (4, 5, 6) if len(word) >= k)]


class Lexicon(dict):
    """word -> weight: over 0 in the lexicon, -1 for a second person pronoun."""

    def __init__(self, weights: dict[bytes, float]):
        super().__init__()
        self.weights = weights
        self.people = {w.encode() for w in SECOND_PERSON}

    def __missing__(self, word: bytes) -> float:
        if len(self) > _WORKER_WORDS:
            self.clear()
        known = max((self.weights.get(t, 0.0) for t in terms(word)), default=0.0)
        self[word] = known if known > 0 else -1.0 if word in self.people else 0.0
        return self[word]


def features(text: bytes, lexicon: Lexicon) -> list[float]:
    """The dense features of a text; all 0 for an empty one."""
    counts = np.bincount(np.frombuffer(text, dtype=np.uint8), minlength=256)
    low = text.lower()
    w = low.translate(WORD_BYTES).split()
    n, size = max(1, len(w)), max(1, len(text))
    weight = np.fromiter(map(lexicon.__getitem__, w), dtype=np.float64, count=len(w))
    hits, people = np.flatnonzero(weight > 0), np.flatnonzero(weight < 0)
    near = 0
    if len(hits) and len(people):
        at = np.searchsorted(people, hits)
        before, after = people[np.maximum(at - 1, 0)], people[np.minimum(at, len(people) - 1)]
        near = int((np.minimum(abs(hits - before), abs(after - hits)) <= NEAR).sum())
    odd = _OBFUSCATED.findall(low)
    letters = max(1, int(counts[_LETTERS].sum()))
    total = float(weight[hits].sum())
    return [
        math.log1p(len(w)), len(hits) / n, total / n, math.log1p(len(hits)), float(weight[hits].max()) if len(hits) else 0.0,
        float(len({w[i] for i in hits})), len(people) / n, near / n, counts[65:91].sum() / letters, counts[33] / n,
        counts[63] / n, counts[_PUNCTUATION].sum() / size, counts[48:58].sum() / size, counts[128:].sum() / size,
        len(odd) / n, float(sum(lexicon[x.translate(_PLAIN).replace(b"*", b"")] > 0 for x in odd)),
        len(set(w)) / n, sum(map(len, w)) / n,
    ]


@dataclass(frozen=True)
class Model:
    weights: dict[bytes, float]
    boosted: boosting.Boosted


def _learn_lexicon(sample: DataFrame, entries: int) -> dict[bytes, float]:
    """Terms with log odds of at least log 8 and no fewer than 4 toxic texts in
    each half of the sample; the smaller log odds is the weight."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[tuple[bytes, int, int]] = Counter()
        for batch in slices(batches):
            for text, label, half in zip(utf8(batch, "text"), batch.column("label").to_pylist(),
                                         batch.column("half").to_pylist(), strict=True):
                found = {t for w in set(text.lower().translate(WORD_BYTES).split()) for t in terms(w)}
                seen.update((t, label, half) for t in found)
        by_term: dict[bytes, list[int]] = {}
        for (t, label, half), n in seen.items():
            by_term.setdefault(t, [0, 0, 0, 0])[2 * half + label] += n
        cols = list(zip(*by_term.values(), strict=True)) or [(), (), (), ()]
        yield pa.RecordBatch.from_arrays([pa.array(list(by_term), pa.binary()), *(pa.array(c, pa.int64()) for c in cols)],
                                         names=["term", "c0", "t0", "c1", "t1"])

    sizes = {(r.half, r.label): r["count"] for r in sample.groupBy("half", "label").count().collect()}
    if len(sizes) < 4:
        return {}
    counted = (sample.select("text", "label", "half").mapInArrow(count, "term binary, c0 long, t0 long, c1 long, t1 long")
               .groupBy("term").agg(*(F.sum(c).alias(c) for c in ("c0", "t0", "c1", "t1"))))
    odds = [F.log((F.col(f"t{h}") / sizes[h, 1]) / ((F.col(f"c{h}") + 1) / sizes[h, 0])) for h in (0, 1)]
    telling = (counted.filter("t0 >= 4 and t1 >= 4").withColumn("weight", F.least(*odds))
               .filter(F.col("weight") >= math.log(8)).orderBy(F.desc(F.col("weight") * F.log(F.col("t0") + F.col("t1"))), "term")
               .limit(entries))
    return {bytes(r.term): float(r.weight) for r in telling.collect()}


def _featured(rows: DataFrame, weights: dict[bytes, float], key: str) -> DataFrame:
    """(key, label, features) of rows (key, label, text)."""
    kind = rows.schema["key"].dataType.simpleString()

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = worker_cache(("lexicon", key), lambda: Lexicon(weights))
        for batch in slices(batches):
            found = [features(t, lexicon) for t in utf8(batch, "text")]
            yield pa.RecordBatch.from_arrays([batch.column("key"), batch.column("label"), pa.array(found, pa.list_(pa.float64()))],
                                             names=["key", "label", "features"])

    return rows.select("key", "label", "text").mapInArrow(compute, f"key {kind}, label int, features array<double>")


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
        *, sample: int = SAMPLE, lexicon: int = LEXICON) -> Model:
    """A model from labelled rows whose crc32 of the id is not divisible by 5.

    At most about ``sample`` labelled ids (chosen by their hash) are used, so
    their broadcast is bounded and no text is shuffled. A repeated label counts
    as toxic if one of its rows is; null ids and labels are left out; ids may be
    numbers or texts. Null and empty texts have zero features, texts of any length
    are read whole; without labels nothing is learned, and nothing is rejected.
    """
    whole = all(isinstance(df.schema[id_col].dataType, T.IntegralType) for df in (docs, labels))
    kind = "long" if whole else "string"
    known = (labels.select(F.col(id_col).cast(kind).alias("key"), F.col(label_col).cast("int").alias("label"))
             .filter((id_text_crc32("key") % 5 != 0) & F.col("label").isin(0, 1)).groupBy("key").agg(F.max("label").alias("label")))
    chosen = bounded_share(known, F.col("key"), sample)
    rows = (docs.select(F.col(id_col).cast(kind).alias("key"), F.col(text_col).alias("text"))
            .join(F.broadcast(chosen), "key").withColumn("half", F.pmod(F.xxhash64("key", F.lit(1)), F.lit(2)).cast("int"))
            .persist())
    try:
        weights = _learn_lexicon(rows, lexicon) | {w.encode(): 8.0 for w in SEED_LEXICON}
        return Model(weights, boosting.fit(_featured(rows, weights, uuid.uuid4().hex)))
    finally:
        rows.unpersist()


def _scored(docs: DataFrame, model: Model, text_col: str, use) -> DataFrame:
    shared, key = docs.sparkSession.sparkContext.broadcast(model), uuid.uuid4().hex

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = worker_cache(("lexicon", key), lambda: Lexicon(shared.value.weights))
        for batch in slices(batches):
            x = np.array([features(t, lexicon) for t in utf8(batch, text_col)]).reshape(-1, len(FEATURES))
            yield use(batch, shared.value.boosted.probability(x))

    return score


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, held_out (crc32 of the id divisible by
    5; false for a null id), score and predicted. Null and empty texts are
    scored by their (zero) features, texts of any length whole; equal rows score
    alike; other columns, whatever their names, are ignored; an empty table gives
    an empty result."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    score = _scored(rows, model, "text", lambda batch, p: pa.RecordBatch.from_arrays(
        [batch.column("id"), pa.array(p, pa.float64())], names=["id", "score"]))
    return rows.mapInArrow(score, f"id {kind}, score double").select(
        F.col("id").alias(id_col), F.coalesce(id_text_crc32("id") % 5 == 0, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, model: Model, text_col: str = "text", *, threshold: float = 0.5) -> DataFrame:
    """``docs`` without the rows that score at least ``threshold``; each row is judged
    by itself, nulls and columns stay as they are, an empty table stays empty."""
    cols = docs.columns
    inner = docs.toDF(*(f"c{i}" for i in range(len(cols))))
    keep = _scored(inner, model, f"c{cols.index(text_col)}", lambda batch, p: batch.filter(pa.array(p < threshold)))
    return inner.mapInArrow(keep, inner.schema).toDF(*cols)
