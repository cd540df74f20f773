"""Bounded-space best-fit packing against the tokenizer and plain Python."""

import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

import public_tokenizers
from tollgate.llm import best_fit
from tollgate.session import ship_package

from .conftest import TEXTS

SF = "/root/testdata/sf0.001"
TRICKY = ["É é x́", "don't DON'T it's", "<|endoftext|> a<|startoftext|>", "İstanbul ıŸ ŉ ſ Straße ẞ",
          "a\x1cb\x85c d e\t\tf\r\ng", "12 1a2 ²½", "...!!?;: ,a,b. 'x' \"q\"", "ÀÖØöø ÷ ×a", "Σας ΣΑΣ", "", "  ", " \n \n",
          "́ ́a", "K Å Å", "ends.\nNext"]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


def want_bytes(tokenizer, text):
    return np.array([*tokenizer.encode(text, add_special_tokens=False).ids, 0], dtype="<u4").tobytes()


def test_token_bytes(tokenizer):
    rng = random.Random(4)
    some = ["".join(rng.choice("abAé \n.,!'ÉİıŸſ1<|́你") for _ in range(rng.randrange(30))) for _ in range(2000)]
    for t in [*TRICKY, *some, *(t or "" for _, t in TEXTS)]:
        assert best_fit.token_bytes(t) == want_bytes(tokenizer, t), t


def plain_best_fit(lengths, size, most):
    free, out, opened = {}, [], 0
    for n in lengths:
        fits = [f for f in free.values() if f >= n]
        if fits:
            number = next(k for k in reversed(free) if free[k] == min(fits))
        else:
            if len(free) == most:
                fullest = min(free.values())
                del free[next(k for k in reversed(free) if free[k] == fullest)]
            number, opened = opened, opened + 1
            free[number] = size
        out.append((number, size - free[number]))
        left = free.pop(number) - n
        if left:
            free[number] = left
    return out


@pytest.mark.parametrize("most", [1, 3, 50])
def test_open_sequences(most):
    rng = random.Random(most)
    for _ in range(30):
        lengths = [rng.randrange(1, 33) for _ in range(rng.randrange(200))]
        held = best_fit.OpenSequences(32, most)
        got = [held.place(n) for n in lengths]
        assert got == plain_best_fit(lengths, 32, most)
        assert held.count <= most


def check_packed(rows, texts, tokenizer, size):
    by_sequence, by_doc = {}, {}
    for r in rows:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
        by_doc.setdefault(r.doc_id, []).append(r)
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= size
    for i, t in texts.items():
        data, at = want_bytes(tokenizer, t or ""), 0
        for k, r in enumerate(sorted(by_doc[i], key=lambda r: r.start)):
            assert (r.piece, r.start) == (k, at)
            assert r.ids == data[4 * at:4 * (at + r.length)] and r.ids_crc32 == zlib.crc32(r.ids)
            assert at + r.length == len(data) // 4 or r.length == size  # only long documents are cut
            at += r.length
        assert at == len(data) // 4
    return len(by_sequence)


@pytest.mark.parametrize("size", [2048, 64])
def test_every_document_is_packed_once(spark, tokenizer, size):
    ship_package(spark)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    rows = best_fit.pack(docs, size=size, with_ids=True).collect()
    n = check_packed(rows, texts, tokenizer, size)
    assert n <= 1.02 * sum(r.length for r in rows) / size + 2


def test_several_tasks(spark, tokenizer):
    ship_package(spark)
    texts = {i: "word " * (i % 50) for i in range(500)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    rows = best_fit.pack(docs, size=64, rows_per_task=100, with_ids=True).collect()
    assert len({r.sequence_id >> 36 for r in rows}) > 1
    check_packed(rows, texts, tokenizer, 64)


def test_edge_cases(spark, edge_docs, no_docs):
    rows = best_fit.pack(edge_docs).collect()
    whole = [r for r in rows if r.piece == 0]
    assert sorted(r.doc_id or -1 for r in whole) == sorted(i or -1 for i, _ in TEXTS)
    assert {r.length for r in whole if r.doc_id in (1, 2)} == {1}
    assert len({(r.sequence_id, r.offset) for r in rows}) == len(rows)
    assert best_fit.pack(no_docs).collect() == []
