"""Periodic runs against a search over every period."""

import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest

from tollgate.llm import catalog, repetition
from tollgate.session import ship_package

from .conftest import TEXTS

SF = "/root/testdata/sf0.001"


def plain_runs(w):
    """Every maximal stretch of each period; of equal ones the smallest period."""
    n, smallest = len(w), {}
    for q in range(n // 4, 0, -1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            if j + q - i >= max(6, 4 * q):
                smallest[(i, j + q)] = q
            i = j + 1
    return sorted(((s, e - s, q) for (s, e), q in smallest.items()), key=lambda r: (r[0], r[2]))


def some_words(rng):
    k, n = rng.choice([1, 2, 3, 5, 30]), rng.randrange(120)
    if rng.random() < 0.4:
        return [rng.randrange(k) for _ in range(n)]
    out = []
    while len(out) < n:
        out += [rng.randrange(k) for _ in range(rng.randrange(1, 9))] * rng.randrange(1, 9)
        del out[len(out) - rng.randrange(3):]
    return out


@pytest.mark.parametrize("seed", range(4))
def test_runs_of_many_texts_at_once(seed):
    rng = random.Random(seed)
    for _ in range(40):
        texts = [some_words(rng) for _ in range(rng.randrange(1, 30))]
        got = repetition.find_runs([np.array(t, dtype=np.int64) for t in texts], 30)
        assert got == [plain_runs(t) for t in texts]


def test_long_runs_and_none():
    find = lambda w: repetition.find_runs([np.array(w, dtype=np.int64)], 1000)[0]
    assert find([3] * 20_000) == [(0, 20_000, 1)]
    assert find([0, 1] * 9_000 + [5]) == [(0, 18_000, 2)]
    assert find(list(range(500)) * 40 + [7]) == [(0, 20_000, 500)]
    a, b = [0], [0, 1]
    while len(b) < 3_000:
        a, b = b, b + a
    assert find(b) == [] == plain_runs(b[:400])  # a Fibonacci word repeats nothing four times
    assert find([]) == find([1]) == find([2] * 5) == []


def test_unequal_stretches_of_one_hash():
    """Thue-Morse words defeat the hash; the plain search takes over."""
    word = [bin(i).count("1") % 2 for i in range(1 << 12)]
    assert repetition.find_runs([np.array(word + [1] * 9)], 2)[0] == plain_runs(word + [1] * 9)


def test_a_text_is_compressed():
    words = np.array((list(range(20)) * 50) + [1000 + 1], dtype=np.int64) % 1001
    grammar = repetition.Grammar(np.r_[words, 1001], np.zeros(len(words) + 1, dtype=np.int64), 1001)
    assert 0 < grammar.n_rules < 60
    assert len(repetition.crossing_runs(np.r_[words, 1001], grammar.nodes[:grammar.n_rules])) < 200


def want(doc_id, text):
    w = (text or "").encode().split()
    n, h = len(w), zlib.crc32(str(doc_id).encode())
    if doc_id is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[a + (i - a) % p] if i >= a else w[i] for i in range(n)]
    runs = plain_runs(w)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    top = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if runs else (None,) * 3
    return (len(runs), *top, 1000 * top[1] // top[2] if runs else None,
            hashlib.sha256("".join(f"{s},{x},{q}\n" for s, x, q in runs).encode()).hexdigest(),
            hashlib.sha256(b" ".join(x for i, x in enumerate(w) if i not in gone)).hexdigest())


def digests(df):
    return [(r.doc_id, (r.n_runs, r.start, r.length, r.period, r.exponent_milli, r.runs_sha256, r.collapsed_sha256)) for r in df.collect()]


def test_query(spark):
    ship_package(spark)
    docs = spark.read.parquet(f"{SF}/documents.parquet").filter("length(text) < 20000").collect()
    texts = {r.doc_id: r.text for r in docs}
    got = {i: x for i, x in digests(catalog.op13_repetition(spark, SF)) if i in texts}
    assert got == {i: want(i, t) for i, t in texts.items()}
    assert sum(x[0] > 0 for x in got.values()) > 5


def test_edge_cases(spark, edge_docs, no_docs):
    got = digests(repetition.collapse(repetition.plant_repetitions(edge_docs)))
    short = [(i, t) for i, t in TEXTS if len(t or "") < 1000]
    assert sorted(map(str, (x for x in got if x[0] != 5))) == sorted(str((i, want(i, t))) for i, t in short)
    (long,) = [x for i, x in got if i == 5]
    assert long[:4] == (1, 0, 180_000, 9)
    assert repetition.collapse(no_docs).collect() == [] == repetition.collapse(repetition.plant_repetitions(no_docs)).collect()
    row = repetition.collapse(spark.createDataFrame([("x", "a b a b a b a b a  c")], "doc_id string, text string"), with_text=True).first()
    assert (row.collapsed, row.runs) == ("a b c", "0,9,2\n")
