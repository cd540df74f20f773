"""What prunes, prunes, and loses nothing."""

import random
import time

import pytest
from pyspark.sql import functions as F

from tollgate.llm import licenses, spotsigs


def test_positional_filter_prunes_and_loses_nothing(spark):
    """Words that stand early in the order are no help to a word late in the prefix."""
    template = licenses.Template("t", "a b c d e f g h i j", 0.6)
    (ordered,) = licenses._ordered((template,), {w: k for k, w in enumerate("abcdefghij")})
    assert ordered.need == 6 and ordered.prefix == tuple("abcde")
    rng = random.Random(3)
    rows = [("a b c d e e d c b a",)] + [(" ".join(rng.choice("abcdefghijxyz") for _ in range(rng.randrange(40))),) for _ in range(300)]
    df = spark.createDataFrame(rows, "text string").select(licenses.words(F.col("text")).alias("w")).filter("size(w) > 0")
    w, n = F.col("w"), F.size("w")
    got = df.select("w", *(F.size(licenses._hits(w, ordered, p)).alias(f"hits{p}") for p in (False, True)),
                    *(F.sort_array(F.transform(F.coalesce(licenses._blocks(w, n, ordered, p), F.array()), lambda b: b["start"])).alias(
                        f"starts{p}") for p in (False, True))).collect()
    assert all(r.hitsTrue <= r.hitsFalse for r in got) and sum(r.hitsTrue for r in got) < 0.9 * sum(r.hitsFalse for r in got)
    for r in got:
        plain = [s for s in range(max(1, len(r.w) - 9)) if len(set(r.w[s:s + 10]) & set("abcdefghij")) >= 6]
        assert r.startsTrue == r.startsFalse == plain


def test_templates_of_any_size(spark):
    long = licenses.Template("long", " ".join(f"w{i}" for i in range(2_500)))
    docs = spark.createDataFrame([(1, "see " + long.text.replace("w7 ", "")), (2, "w1 w2 w3")], "doc_id long, text string")
    got = {r.doc_id: r.labels for r in licenses.scan(docs, templates=(long,)).collect()}
    assert got == {1: "long", 2: ""}


@pytest.mark.parametrize("least", [0.0, 0.3, 0.8])
def test_jaccard_by_length_partitions(spark, least):
    rng = random.Random(4)
    rows = [(sorted(rng.sample(range(60), rng.randrange(1, 60))), sorted(rng.sample(range(60), rng.randrange(1, 60)))) for _ in range(200)]
    df = spark.createDataFrame(rows, "a array<int>, b array<int>")
    for r in df.select("a", "b", spotsigs.jaccard(F.col("a"), F.col("b"), least).alias("j")).collect():
        a, b = set(r.a), set(r.b)
        if (j := len(a & b) / len(a | b)) >= least:
            assert r.j == pytest.approx(j)


ANCHORS = set(spotsigs.ANCHORS)


def test_signatures_in_plain_python(spark):
    """Chains of the next content words after common words, hashed by Spark."""
    text = "The quick brown fox, and the lazy dog: is it of any use to the old grey cat?"
    words = "".join(c.lower() if c.isalnum() else " " for c in text).split()
    rare = {r.x for r in spark.createDataFrame([(w,) for w in set(words)], "x string").filter(
        F.pmod(F.hash("x"), F.lit(spotsigs.RARE)) == 0).collect()}
    marked = ["#" + w if w in ANCHORS | rare else w for w in words]
    chains = {(m, tuple([x for x in marked[i + 1:i + 1 + spotsigs.REACH] if x[0] != "#"][:spotsigs.CHAIN]))
              for i, m in enumerate(marked) if m[0] == "#"}
    rows = [(m, list(c)) for m, c in chains if c]
    wanted = {r.h for r in spark.createDataFrame(rows, "m string, c array<string>").select(F.hash("m", "c").alias("h")).collect()}
    got = spotsigs.with_signatures(spark.createDataFrame([(text,)], "t string"), "t", "s").first().s
    assert set(got) == wanted and len(wanted) > 4 and list(got) == sorted(got)


def test_signatures_of_random_texts_in_plain_python(spark):
    """Content words within and beyond an anchor's reach, runs of anchors, and texts without chains."""
    rng, rows = random.Random(5), ["the " * 30, "the " * 8 + "fox", "the " * 9 + "fox", "the fox", "fox the", "fox", "", None, "?!"]
    rows += [" ".join(rng.choice(["the", "und", *(f"w{k}" for k in range(9))][:rng.choice((3, 11))]) for _ in range(rng.randrange(40)))
             for _ in range(200)]
    vocabulary = sorted({w for t in rows for w in (t or "").split() if w != "?!"})
    rare = {r.x for r in spark.createDataFrame([(w,) for w in vocabulary], "x string").filter(
        F.pmod(F.hash("x"), F.lit(spotsigs.RARE)) == 0).collect()}
    wanted = []
    for k, text in enumerate(rows):
        words = [w for w in (text or "").split() if w != "?!"]
        marked = ["#" + w if w in ANCHORS | rare else w for w in words]
        chains = [[x for x in marked[i + 1:i + 1 + spotsigs.REACH] if x[0] != "#"][:spotsigs.CHAIN] for i in range(len(words))]
        found = [[m, *c] for m, c in zip(marked, chains) if m[0] == "#" and c]
        if words and not found:
            found = [words[i:i + 3] for i in range(max(1, len(words) - 2))]
        wanted += [(k, parts) for parts in found or [[text or ""]]]
    hashed = spark.createDataFrame(wanted, "k int, parts array<string>").groupBy("k").agg(
        F.sort_array(F.collect_set(F.hash("parts"))).alias("s")).collect()
    got = spotsigs.with_signatures(spark.createDataFrame(list(enumerate(rows)), "k int, t string"), "t", "s").collect()
    assert {r.k: r.s for r in got} == {r.k: r.s for r in hashed} and len(got) == len(rows)


def test_signatures_cost_little_more_than_words(spark):
    """Each anchor's chain is looked up, not searched for, and each is computed once."""
    rng = random.Random(6)
    rows = [(" ".join(rng.choice(("the", "and", "of", f"w{rng.randrange(99)}")) for _ in range(2_000)),) for _ in range(400)]
    df = spark.createDataFrame(rows, "t string").repartition(4).cache()

    def seconds(run):
        taken = []
        for _ in range(4):
            start = time.perf_counter()
            run.write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - start)
        return min(taken)

    df.count()
    plain, signed = (seconds(run) for run in (df.select(licenses.words(F.col("t"))), spotsigs.with_signatures(df, "t", "s")))
    assert signed < 7 * plain, (signed, plain)
