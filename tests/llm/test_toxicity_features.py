"""Toxicity: features and learned lexicon against plain Python."""

import math
import re
import zlib
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tollgate.llm import toxicity
from tollgate.llm.common import table

from ..conftest import SF01

WEIGHTS = {b"idiot": 8.0, b"scum": 5.0, b"mora~": 3.0, "tú".encode(): 2.0, b"x1": 4.0}
PIECES = ["You", "your", "idiot", "IDIOT!", "sc*m", "scum", "morality", "mor", "tú", "TU", "x1", "1d10t", "id10t", "a", "-", "?!",
          "\n", "ÉCOLE", "你好", "\U0001f600", "abc123def", "s@@d", "100", " ", "it's", "y0u"]


def words(text):
    """Runs of digits, letters and what is not ASCII, lower-cased in A-Z."""
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text)
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def weight(word, weights):
    data = word.encode()
    known = [weights[data]] if data in weights else []
    for k in (4, 5, 6):
        if len(data) >= k and data[:k] + b"~" in weights:
            known.append(weights[data[:k] + b"~"])
    return max(known, default=0.0)


def plain_features(text, weights):
    w = words(text)
    data = text.encode()
    n, size = max(1, len(w)), max(1, len(data))
    hits = [i for i, x in enumerate(w) if weight(x, weights) > 0]
    people = [i for i, x in enumerate(w) if x in toxicity.SECOND_PERSON and i not in hits]
    near = [i for i in hits if any(abs(i - p) <= toxicity.NEAR for p in people)]
    odd = re.findall(r"[a-z]+[*@$!0-9]+[a-z]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
    plain = [x.translate(str.maketrans("@$!013457", "asioieast")).replace("*", "") for x in odd]
    letters = max(1, sum(c.isascii() and c.isalpha() for c in text))
    total = sum(weight(w[i], weights) for i in hits)
    return {
        "words": math.log(1 + len(w)), "lexicon": len(hits) / n, "weight": total / n, "hits": math.log(1 + len(hits)),
        "heaviest": max((weight(w[i], weights) for i in hits), default=0.0), "distinct": len({w[i] for i in hits}),
        "second_person": len(people) / n, "near_second_person": len(near) / n,
        "capitals": sum("A" <= c <= "Z" for c in text) / letters, "exclamations": text.count("!") / n,
        "questions": text.count("?") / n,
        "punctuation": sum(33 <= b <= 126 and not chr(b).isalnum() for b in data) / size,
        "digits": sum(48 <= b <= 57 for b in data) / size, "non_ascii": sum(b > 127 for b in data) / size,
        "obfuscated": len(odd) / n, "obfuscated_hits": sum(weight(x, weights) > 0 for x in plain),
        "variety": len(set(w)) / n, "word_length": sum(len(x.encode()) for x in w) / n,
    }


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.sampled_from(PIECES), st.text(max_size=6)), max_size=40).map(" ".join))
def test_features_in_plain_python(text):
    text = text.encode(errors="ignore").decode()
    got = dict(zip(toxicity.FEATURES, toxicity.features(text.encode(), toxicity.Lexicon(WEIGHTS)), strict=True))
    assert got == pytest.approx(plain_features(text, WEIGHTS))


def test_features_of_whole_documents(spark):
    docs = table(spark, SF01, "documents")
    lexicon = toxicity.Lexicon(WEIGHTS)
    for r in [*docs.limit(100).collect(), *docs.orderBy(F.desc(F.length("text"))).limit(3).collect()]:
        got = dict(zip(toxicity.FEATURES, toxicity.features((r.text or "").encode(), lexicon), strict=True))
        assert got == pytest.approx(plain_features(r.text or "", WEIGHTS))


def test_lexicon_in_plain_python(spark):
    """Document frequencies of all terms, recomputed over every labelled row that may be learned from."""
    docs, labels = table(spark, SF01, "documents"), table(spark, SF01, "labels")
    halves = {r.doc_id: r.half for r in docs.select(
        "doc_id", F.pmod(F.xxhash64(F.col("doc_id").cast("long"), F.lit(1)), F.lit(2)).alias("half")).collect()}
    toxic = {}
    for r in labels.collect():
        if r.doc_id is not None and r.toxic in (0, 1) and zlib.crc32(str(r.doc_id).encode()) % 5:
            toxic[r.doc_id] = max(toxic.get(r.doc_id, 0), r.toxic)
    sizes, seen = Counter(), Counter()
    for r in docs.collect():
        if r.doc_id in toxic:
            group = halves[r.doc_id], toxic[r.doc_id]
            sizes[group] += 1
            terms = set()
            for w in set(words(r.text or "")):
                terms.add(w.encode())
                terms |= {w.encode()[:k] + b"~" for k in (4, 5, 6) if len(w.encode()) >= k}
            seen.update((t, *group) for t in terms)
    wanted = {}
    for term in {t for t, _, _ in seen}:
        if min(seen[term, 0, 1], seen[term, 1, 1]) >= 4:
            odds = min(math.log((seen[term, h, 1] / sizes[h, 1]) / ((seen[term, h, 0] + 1) / sizes[h, 0])) for h in (0, 1))
            if odds >= math.log(8):
                wanted[term] = odds
    seeds = {w.encode() for w in toxicity.SEED_LEXICON}
    got = toxicity.fit(docs, labels).weights
    assert {t: x for t, x in got.items() if t not in seeds} == pytest.approx({t: x for t, x in wanted.items() if t not in seeds})
    assert all(got[t] == 8.0 for t in seeds) and wanted
