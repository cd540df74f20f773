"""Every operator over nulls, empty and very long texts, ties and repeated rows,
an empty table, and extra columns with clashing names."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tollgate.llm import boosting, decontaminate, language, licenses, packing, pii, simhash, spotsigs, token_counts, toxicity, warc

from .conftest import SCHEMA, TEXTS


def labels(spark, rows=((1, 0, 0), (4, 1, 1), (4, 1, 0), (None, 1, 1), (5, None, None))):
    return spark.createDataFrame(list(rows), "doc_id long, quality int, toxic int")


ITEMS = ((1, "under 12 1 555 0100 the mit of license under 12 1 555 0100"), (2, None), (2, ""), (None, "a"), (3, "one two"))


def benchmark(spark, rows=ITEMS):
    return spark.createDataFrame(list(rows), "item_id long, text string")


OPERATORS = {
    "licenses": lambda s, d: licenses.scan(d),
    "toxicity": lambda s, d: toxicity.predict(d, toxicity.fit(d, labels(s))),
    "language": lambda s, d: language.identify(d, language.train(d)),
    "simhash": lambda s, d: simhash.near_duplicates(d),
    "pii": lambda s, d: pii.find(d, pii.fit(d)),
    "token_counts": lambda s, d: token_counts.count_tokens(d),
    "decontaminate": lambda s, d: decontaminate.contamination(d, benchmark(s)),
    "spotsigs": lambda s, d: spotsigs.fingerprints(d),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_one_row_per_row(spark, edge_docs, name):
    rows = OPERATORS[name](spark, edge_docs).collect()
    assert sorted(r.doc_id or -1 for r in rows) == sorted(i or -1 for i, _ in TEXTS)


@pytest.mark.parametrize("name", [*OPERATORS, "packing", "warc"])
def test_empty_table(spark, no_docs, name):
    run = OPERATORS.get(name) or {"packing": lambda s, d: packing.pack(d),
                                  "warc": lambda s, d: warc.archive_round_trip(d, "doc_id", "source", "text")}[name]
    assert run(spark, no_docs).collect() == []


def test_repeated_rows_have_one_result(spark, edge_docs):
    for name in OPERATORS:
        rows = [r for r in OPERATORS[name](spark, edge_docs.filter("doc_id in (4, 12)")).collect() if r.doc_id == 4]
        assert len(rows) == 2 and rows[0] == rows[1], name


def test_filters_keep_columns_and_rows(spark, edge_docs):
    model = toxicity.Model({}, boosting.fit(spark.createDataFrame([], "features array<double>, label int, key long")))
    kept = {
        "toxicity": toxicity.drop_toxic(edge_docs, model),
        "decontaminate": decontaminate.decontaminate(edge_docs, benchmark(spark, [(1, "no such words in here")])),
        "pii": pii.redact(edge_docs, model.boosted),
    }
    for name, df in kept.items():
        assert df.schema.names == SCHEMA.names, name
        assert df.count() == len(TEXTS), name
    assert simhash.deduplicate(edge_docs).columns == SCHEMA.names


def test_spans_are_cut_or_documents_dropped(spark, edge_docs):
    items = benchmark(spark, [(7, "One TWO!")])
    cut = {r.doc_id: r.text for r in decontaminate.decontaminate(edge_docs, items, remove="spans").collect()}
    assert cut[12] == " three"
    assert cut[9] == dict(TEXTS)[9] and cut[1] is None
    kept = decontaminate.decontaminate(edge_docs, items).select("doc_id").collect()
    assert 12 not in {r.doc_id for r in kept} and len(kept) == len(TEXTS) - 1


def test_benchmark_without_words_hits_nothing(spark, edge_docs):
    got = decontaminate.contamination(edge_docs, benchmark(spark, [(1, ""), (2, None)]))
    assert got.filter("n_hit > 0 or contaminated or n_items > 0").count() == 0
    assert got.filter(F.col("doc_id") == 5).first().n_words > 100_000


def test_packing_edge_cases(spark, edge_docs):
    rows = packing.pack(edge_docs).collect()
    whole = [r for r in rows if r.start == 0]
    assert sorted(r.doc_id or -1 for r in whole) == sorted(i or -1 for i, _ in TEXTS)
    assert {r.doc_tokens for r in whole if r.doc_id in (1, 2)} == {1}  # the end id alone
    assert len({(r.sequence_id, r.offset) for r in rows}) == len(rows)


@pytest.mark.parametrize("kind", ["edge", "edge, every item has an id", "empty"])
def test_pipeline_edge_cases(spark, edge_docs, no_docs, workdir, kind):
    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    (no_docs if kind == "empty" else edge_docs).select(*columns, F.lit("x").alias("_fp")).write.parquet(f"{workdir}/documents.parquet")
    labels(spark).write.parquet(f"{workdir}/labels.parquet")
    benchmark(spark, ITEMS if kind == "edge" else [x for x in ITEMS if x[0]]).write.parquet(f"{workdir}/benchmark.parquet")
    rows = corpus_pipeline.run(spark, workdir).collect()
    left = {r.doc_id for r in rows}
    if kind == "empty":
        assert rows == []
    elif kind == "edge":
        assert not left & {4, 5, 12} and 9 in left  # 4 is the text of an item without an id
    else:
        assert 4 in left and 12 not in left and 5 not in left  # 12 and 5 hold benchmark windows
        assert sum(r.doc_id == 4 and r.start == 0 for r in rows) == 1  # of two equal rows one stays


def test_page_ids_may_be_any_text(spark):
    ids = ["a\r\nb", "100%25", " x: y ", "plain", "ü\t%"]
    pages = spark.createDataFrame([(i, "http://x/", "same") for i in ids] + [("z", None, None)], "page_id string, url string, html string")
    rows = {r.page_id: r for r in warc.archive_round_trip(pages).collect()}
    first = min(ids)
    assert set(rows) == {*ids, "z"}
    assert all((rows[i].record_type, rows[i].refers_to) == (("response", None) if i == first else ("revisit", first)) for i in ids)


def test_toxicity_learns_from_text_ids(spark):
    texts = [("you idiot, awful grumblefax" if i % 2 else "a calm and friendly walk in the park") + f" {i}" for i in range(200)]
    docs = spark.createDataFrame([(f"doc-{i}", t) for i, t in enumerate(texts)], "doc_id string, text string")
    marks = spark.createDataFrame([(f"doc-{i}", i % 2) for i in range(200)], "doc_id string, toxic int")
    rows = toxicity.predict(docs, toxicity.fit(docs, marks)).collect()
    assert all(r.predicted == int(r.doc_id[4:]) % 2 for r in rows)


def test_equal_rows_are_packed_over_all_salts(spark):
    docs = spark.createDataFrame([(None, "same words")] * 600, "doc_id long, text string").repartition(4)
    rows = packing.pack(docs, size=64).collect()
    filled = {}
    for r in rows:
        filled.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert len(rows) == 600 and all(sorted(x)[0][0] == 0 and sum(n for _, n in x) <= 64 for x in filled.values())
    assert all(a + n == b for x in filled.values() for (a, n), (b, _) in zip(sorted(x), sorted(x)[1:]))


def test_sketches_merge_to_the_heaviest(spark):
    rows = [(part, [f"w{part % 7}", "all"], [part, 2]) for part in range(100)]
    sketches = spark.createDataFrame(rows, token_counts._SKETCH).repartition(5)
    for groups in token_counts.LEVELS:
        sketches = token_counts.merged(sketches, groups, 8)
    root, = sketches.collect()
    totals = {f"w{k}": sum(range(k, 100, 7)) for k in range(7)} | {"all": 200}
    assert root.chunks == sorted(totals, key=lambda k: (-totals[k], k)) and root.counts == [totals[k] for k in root.chunks]
    # a table too small for all keeps the heaviest of what reaches it
    small, = token_counts.merged(spark.createDataFrame(rows, token_counts._SKETCH), 1, 3).collect()
    assert small.chunks == sorted(totals, key=lambda k: (-totals[k], k))[:3]
