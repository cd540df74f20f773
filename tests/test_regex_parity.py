"""Spark's Java-regex verdicts vs the oracle's RE2 translation, on generated
strings dense in line terminators, digits, dots and dashes, for every rule."""

import random

import duckdb
from pyspark.sql import functions as F

from tollgate.functions import SILVER_RULES
from tollgate.plans.oracle import java_to_re2

ALPHABET = ["a", "f", "0", "1", "5", "9", "-", "_", ".", " ", "T", "Z", ":", "x", "A",
            "\n", "\r", "\u0085", "\u2028", "\u2029", "\t", "\u00e9", "\u0661"]


def _strings(n, seed=7):
    rnd = random.Random(seed)
    out = ["", "\n", "\r\n", "a\r\n", "5\r\n", "5\n\n", "1.2 ", "2024-01-01T00:00:00Z\n"]
    for _ in range(n):
        out.append("".join(rnd.choice(ALPHABET) for _ in range(rnd.randint(1, 12))))
    # shapes close to the rules, then perturbed at the end
    for base in ["0123456789a", "123.456.789-09", "12345678901", "2024-01-01T00:00:00.5",
                 "abcdef01-2345-6789-abcd-ef0123456789", "1.2.3", "app-1_x"]:
        for tail in ["", "\n", "\r", "\r\n", "\n\n", "\u0085", "\u2028", "\u2029", " ", "x", "\nx"]:
            out.append(base + tail)
    return out


def test_rule_verdicts_agree_with_translated_oracle(spark):
    values = _strings(400)
    patterns = sorted({r.pattern for rules in SILVER_RULES.values() for r in rules if r.pattern})
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    spark_cols = [F.col("v").rlike(p).alias(f"p{j}") for j, p in enumerate(patterns)]
    got = {r["i"]: tuple(r[f"p{j}"] for j in range(len(patterns)))
           for r in df.select("i", *spark_cols).collect()}
    con = duckdb.connect()
    con.execute("create table t(i integer, v varchar)")
    con.executemany("insert into t values (?, ?)", list(enumerate(values)))
    sel = ", ".join(f"regexp_matches(v, ?) as p{j}" for j in range(len(patterns)))
    rows = con.execute(f"select i, {sel} from t", [java_to_re2(p) for p in patterns]).fetchall()
    want = {r[0]: tuple(r[1:]) for r in rows}
    diff = [(values[i], got[i], want[i]) for i in got if got[i] != want[i]]
    assert not diff, diff[:5]


def test_translation_leaves_classes_and_escapes_alone():
    assert java_to_re2(r"^[a-z.\-]+\.x$").startswith(r"^[a-z.\-]+\.x")
    assert "[^\\n" in java_to_re2("^.+$")


def test_translation_edge_cases(spark):
    cases = [r"^a\$b$", r"^[]a]+$", r"^[^]a]+$", r"^[.]+$", r"^a.c$", r"^\d+\.\d+$", r"x$|^y"]
    values = ["a$b", "a$b\n", "]a]", "]a]\n", "bcd", "...", "..\n", "abc", "a\nc", "1.5", "1.5\r\n",
              "x", "x\n", "yz", "\ny", "1x5"]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    got = {r["i"]: tuple(r[f"p{j}"] for j in range(len(cases)))
           for r in df.select("i", *[F.col("v").rlike(p).alias(f"p{j}") for j, p in enumerate(cases)]).collect()}
    con = duckdb.connect()
    con.execute("create table t(i integer, v varchar)")
    con.executemany("insert into t values (?, ?)", list(enumerate(values)))
    sel = ", ".join(f"regexp_matches(v, ?) as p{j}" for j in range(len(cases)))
    want = {r[0]: tuple(r[1:]) for r in
            con.execute(f"select i, {sel} from t", [java_to_re2(p) for p in cases]).fetchall()}
    assert got == want
