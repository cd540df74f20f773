"""Language identification by compression.

For each language a raw-content zstandard dictionary holds training text. A
text is encoded with every dictionary, in blocks so that the dictionary helps
throughout a long text, and the language of the smallest encoding is chosen. A
narrow margin between the smallest and the next is reported as a rejection.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from heapq import nsmallest
from itertools import islice

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import highest_hash, id_text_crc32, slices, strings, worker_cache

UNKNOWN = "und"
#: Bounds of the training sample: blocks of text for each language (about), their
#: characters, and languages at a time. A dictionary is all of its language's blocks.
SAMPLE_BLOCKS, BLOCK_CHARS, LANGUAGES = 100, 1_000, 200
BLOCK, LEVEL, MIN_MATCH = 4_096, 5, 3
_LETTER_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c > 127 else 32 for c in range(256))


def normalised(text: str) -> bytes:
    """Lower-cased words of letters (and other non-ASCII characters)."""
    return b" ".join(text.lower().encode().translate(_LETTER_BYTES).split())


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", *,
          blocks: int = SAMPLE_BLOCKS, block_chars: int = BLOCK_CHARS) -> dict[str, bytes]:
    """Language -> dictionary, the most frequent language first. Learned from
    rows with a language and a text whose crc32 of the id modulo 4 is not 2;
    rows without an id are left out.

    Texts are cut into blocks of ``block_chars`` characters, and about ``blocks`` of
    each language are taken by a hash of id and place: any part of any text may be
    among them, and a dictionary holds whatever was taken.
    """
    rows = (docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"))
            .filter((id_text_crc32("id") % 4 != 2) & F.col("lang").isNotNull() & (F.length("text") > 0)))
    many = F.ceil(F.length("text") / block_chars)
    counts = [(r.lang, r.n, r.blocks) for r in rows.groupBy("lang").agg(F.count("*").alias("n"), F.sum(many).alias("blocks"))
              .orderBy(F.desc("n"), "lang").collect()]
    out: dict[str, bytes] = {}
    for part in _parts({lang: n for lang, _, n in counts}):
        highest = F.create_map(*(F.lit(x) for lang, n in part.items() for x in (lang, highest_hash(blocks, n))))
        places = F.filter(F.sequence(F.lit(0).cast("long"), many - 1), lambda i: F.xxhash64("id", i) <= highest[F.col("lang")])
        chosen = (rows.select("id", "lang", "text", F.explode(places).alias("place"))
                  .select(F.xxhash64("id", "place").alias("h"), "lang", F.expr(f"substring(text, cast(place * {int(block_chars)} + 1 as int), {int(block_chars)})").alias("text")))
        found: dict[str, list] = {lang: [] for lang in part}
        for r in chosen.collect():
            found[r.lang].append((r.h, normalised(r.text)))
        out |= {k: b"\n".join(t for _, t in sorted(v)) for k, v in found.items() if any(t for _, t in v)}
    return out


def _parts(languages: dict) -> list[dict]:
    """At most ``LANGUAGES`` at a time, in order."""
    rest = iter(languages.items())
    return list(iter(lambda: dict(islice(rest, LANGUAGES)), {}))


def _compressors(dictionaries: dict[str, bytes]) -> dict[str, zstandard.ZstdCompressor]:
    out = {}
    for lang, content in dictionaries.items():
        params = zstandard.ZstdCompressionParameters.from_level(
            LEVEL, min_match=MIN_MATCH, source_size=BLOCK, dict_size=len(content), write_content_size=False, write_dict_id=False)
        d = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        d.precompute_compress(compression_params=params)
        out[lang] = zstandard.ZstdCompressor(compression_params=params, dict_data=d)
    return out


def smallest(text: str, compressors: dict[str, zstandard.ZstdCompressor],
             before: Sequence[tuple[str, int]] = ()) -> list[tuple[str, int]]:
    """The two languages with the smallest encodings (the earlier one of a tie)
    of these and those ``before``; none for a text without a letter."""
    if not any(map(str.isalpha, text)):
        return []
    data = normalised(text)
    blocks = [data[i:i + BLOCK] for i in range(0, len(data), BLOCK)]
    sizes = [(lang, sum(len(c.compress(b)) for b in blocks)) for lang, c in compressors.items()]
    return nsmallest(2, [*before, *sizes], key=lambda x: x[1])


def _chosen(two: list[tuple[str, int]]) -> tuple[str, float]:
    """The language and its margin: the share by which the next smallest is larger."""
    if len(two) < 2:
        return (two[0][0], 1.0) if two else (UNKNOWN, 0.0)
    (best, size), (_, following) = two
    return best, (following - size) / following


def classify(text: str, compressors: dict[str, zstandard.ZstdCompressor]) -> tuple[str, float]:
    """The language with the smallest encoding (the more frequent one of a tie)
    and its margin: the share by which the next smallest is larger."""
    return _chosen(smallest(text, compressors))


def identify(docs: DataFrame, dictionaries: dict[str, bytes], id_col: str = "doc_id", text_col: str = "text",
             *, narrow: float = 0.02) -> DataFrame:
    """One row per row of ``docs``: id, held_out (crc32 of the id modulo 4 is 2;
    false for a null id), lang_pred, score (0 to 1, of the margin) and rejected:
    the margin is under ``narrow``, so that lang_pred is a guess.

    A null text, one without a letter, and any text when nothing was learned is
    ``und`` with score 0 and rejected. A text of any length is encoded whole, and of
    languages with equal encodings the more frequent one is taken. Equal rows have
    equal results; other columns, whatever their names, are ignored; an empty table
    gives an empty result.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    shared, key = docs.sparkSession.sparkContext.broadcast(dictionaries), uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = _parts(shared.value)
        for batch in slices(batches):
            texts = strings(batch, "text")
            two: list[list] = [[] for _ in texts]
            for k, part in enumerate(parts):
                compressors = worker_cache(("compressors", key, k), lambda part=part: _compressors(part))
                two = [smallest(t, compressors, b) for t, b in zip(texts, two, strict=True)]
            found = [_chosen(x) for x in two]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array([x for x, _ in found], pa.string()), pa.array([m for _, m in found], pa.float64())],
                names=["id", "lang_pred", "margin"])

    out = rows.mapInArrow(run, f"id {kind}, lang_pred string, margin double")
    return out.select(
        F.col("id").alias(id_col), F.coalesce(id_text_crc32("id") % 4 == 2, F.lit(False)).alias("held_out"), "lang_pred",
        F.when(F.col("lang_pred") == UNKNOWN, 0.0).otherwise(0.5 + F.least(F.lit(0.5), 2.5 * F.col("margin"))).alias("score"),
        ((F.col("lang_pred") == UNKNOWN) | (F.col("margin") < narrow)).alias("rejected"))
