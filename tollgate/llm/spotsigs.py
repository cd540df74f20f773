"""Document fingerprints by SpotSigs, with DataFrame expressions only.

A signature starts at a common word (the anchor) and chains the next content
words after it, passing over other common words. One word in sixteen, by its hash, is
an anchor as well, so that texts of other languages and lists of rare words
have signatures too. The set of a text's signatures is its fingerprint. Sets are dealt into partitions by their length: sets more
partitions apart than a likeness allows cannot reach it, so where a least likeness
is asked for, Jaccard is computed only where the lengths leave it possible. The
likeness of stated pairs (a document and its edit, a document and the next one) has
no such bound and is always computed.
"""

from __future__ import annotations

from math import log

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import written
from .licenses import words

# --- fixed values: common words of English, German, French and Spanish -------
ANCHORS = (
    "the and of to in is that it for was on are as with be by at from this or an a not have has had were which "
    "der die das und ist von mit den ein eine auch auf im dem des nicht sich zu für "
    "le la les de des et un une est que qui dans pour avec par au du en sur ou "
    "el los las y una por con para se no su al es lo como más del"
).split()
#: Content words of a chain, and the words after an anchor it looks among.
CHAIN, REACH = 2, 8
#: Of the other words, one in so many is an anchor.
RARE = 16
#: Least likeness that is asked of stated pairs, and the likeness that sets a
#: partition's width.
LEAST, PARTITION = 0.0, 0.05
_SETS = "array<int>"


def _anchor(x: Column) -> Column:
    return x.isin(ANCHORS) | (F.pmod(F.hash(x), F.lit(RARE)) == 0)


def _chains(w: Column, anchors: Column, content: Column) -> Column:
    """The distinct chains of a text's anchors, hashed; empty if no content word is near one.

    ``w``: its words, ``anchors`` and ``content``: the places of the anchors and of
    the other words, ascending. The j-th anchor, at place i, has i - j content words
    before it, so the next ones are looked up by number instead of searched for."""

    def chain(i: Column, j: Column) -> Column:
        following = [F.get(content, i - j + k) for k in range(CHAIN)]
        near = [F.when(at <= i + REACH, F.get(w, at)) for at in following]
        # a null is passed over by the hash
        return F.when(following[0] <= i + REACH, F.hash(F.concat(F.lit("#"), F.get(w, i)), *near))

    return F.array_compact(F.array_distinct(F.transform(anchors, chain)))


def _signatures(text: Column, w: Column, chains: Column) -> Column:
    """The sorted set of a text's signatures (32-bit hashes); never empty.

    ``w``: its words, ``chains``: the chains of its anchors. Without an anchor that a
    content word follows, runs of up to three words stand for chains; without words,
    the text itself (null: empty)."""
    n = F.size(w)
    runs = F.array_distinct(F.transform(F.sequence(F.lit(0), F.greatest(n - 3, F.lit(0))),
                                        lambda i: F.hash(F.slice(w, i + 1, F.lit(3)))))
    whole = F.array(F.hash(F.coalesce(text, F.lit(""))))
    found = F.when(F.size(chains) > 0, chains).when(n > 0, runs).otherwise(whole)
    return F.sort_array(found)


def with_signatures(rows: DataFrame, text_col: str, name: str) -> DataFrame:
    """``rows`` with the signatures of a text column; words, places and chains are
    columns of their own on the way, so that each is computed once."""
    w, places, anchors, content, chains = steps = "_w", "_w_places", "_w_anchors", "_w_content", "_w_chains"
    n = F.size(w)
    return (rows.withColumn(w, words(F.col(text_col)))
            .withColumn(places, F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast(_SETS)))
            .withColumn(anchors, F.filter(places, lambda i: _anchor(F.get(w, i))))
            .withColumn(content, F.array_except(places, anchors))
            .withColumn(chains, _chains(F.col(w), F.col(anchors), F.col(content)))
            .withColumn(name, _signatures(F.col(text_col), F.col(w), F.col(chains))).drop(*steps))


def digest(sigs: Column) -> Column:
    """A set as a string: its length and 128 bits of hash."""
    return F.concat_ws("-", F.size(sigs).cast("string"),
                       F.lower(F.lpad(F.hex(F.xxhash64(sigs)), 16, "0")), F.lower(F.lpad(F.hex(F.xxhash64(F.lit(1), sigs)), 16, "0")))


def length_partition(n: Column, least: float) -> Column:
    """Sets whose Jaccard is at least ``least`` are at most one partition apart."""
    return F.floor(F.log(n.cast("double")) / log(1 / least) + 1e-9).cast("int")


def jaccard(a: Column, b: Column, least: float = LEAST) -> Column:
    """Jaccard of two sets; with a ``least``, 0 where their lengths keep it under that."""
    n, m = F.size(a), F.size(b)
    if least <= 0:
        shared = F.size(F.array_intersect(a, b))
        return shared / (n + m - shared)
    apart = F.abs(length_partition(n, least) - length_partition(m, least)) > 1
    possible = ~apart & (F.least(n, m) >= least * F.greatest(n, m))
    shared = F.size(F.array_intersect(a, b))
    return F.when(possible, shared / (n + m - shared)).otherwise(F.lit(0.0))


def next_ids(ids: DataFrame, rows_per_range: int = 500_000) -> DataFrame:
    """(id, next_id) for the distinct longs of column id: the next smaller one;
    after the smallest, the largest. Ranges are ranked in parallel and joined at
    their ends, so no task holds all ids."""
    spark = ids.sparkSession
    n = ids.count()
    ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n // rows_per_range))
    dealt = written(ids.repartitionByRange(ranges, F.desc("id")).withColumn("part", F.spark_partition_id()).distinct(), "spot-ids")
    ends = dealt.groupBy("part").agg(F.max("id").alias("first"))  # a row for each range
    down = Window.orderBy("part")
    ends = ends.select("part", F.coalesce(F.lead("first").over(down), F.first("first").over(
        down.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))).alias("then"))
    inside = F.lead("id").over(Window.partitionBy("part").orderBy(F.desc("id")))
    return written(dealt.withColumn("inside", inside).join(F.broadcast(ends), "part")
                   .select("id", F.coalesce("inside", "then").alias("next_id")), "spot-next")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next, length_partition, and signatures:
    the set itself, from which any other pair can be compared.

    The edited text has the last third of the code points replaced by the first
    as many of the next document's (next smaller id; after the smallest the
    largest; a null id counts as smallest). Rows that share an id share a next
    document; of several rows with that next id, the text that sorts first is
    taken. Null texts are empty and texts of any length are fingerprinted whole;
    equal rows have equal results; other columns, whatever their names, are ignored;
    an empty table gives an empty result. Ids are integers.
    """
    lowest = F.lit(-(1 << 63))
    # Both joins below deal out exactly these rows by id, so that texts are
    # shuffled once and the exchange is used twice.
    rows = docs.select(F.coalesce(F.col(id_col).cast("long"), lowest).alias("id"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    sizes = rows.groupBy("id").agg(F.max(F.length("text")).alias("n"))
    follow = next_ids(rows.select("id"))
    wanted = (follow.join(sizes, "id").select(F.col("next_id").alias("id"), F.col("id").alias("for_id"),
                                              F.floor(F.col("n") / 3).cast("int").alias("head")))
    wanted = written(wanted, "spot-wanted")
    # Each document sends its predecessor only the head it takes and its set.
    sent = with_signatures(rows.join(wanted, "id"), "text", "next_sigs")
    sent = (sent.select(F.col("for_id").alias("id"), F.struct(F.expr("substring(text, 1, head)").alias("head"), "next_sigs").alias("sent"))
            .groupBy("id").agg(F.min("sent").alias("sent")))
    third = F.floor(F.col("n") / 3).cast("int")
    both = with_signatures(rows.join(sent, "id").withColumn("n", F.length("text")), "text", "sigs")
    both = both.select("id", "n", "sigs", F.col("sent.next_sigs").alias("next_sigs"), F.concat(
        F.substring("text", F.lit(1), F.col("n") - third), F.substring("sent.head", F.lit(1), third)).alias("edited"))
    both = with_signatures(both, "edited", "edited_sigs")
    return both.select(
        F.nullif(F.col("id"), lowest).cast(docs.schema[id_col].dataType).alias(id_col), F.col("n").cast("long").alias("n_chars"),
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"), digest(F.col("sigs")).alias("fingerprint"),
        digest(F.col("edited_sigs")).alias("edited_fingerprint"), jaccard(F.col("sigs"), F.col("edited_sigs")).alias("near_edited"),
        jaccard(F.col("sigs"), F.col("next_sigs")).alias("near_next"),
        length_partition(F.size("sigs"), PARTITION).alias("length_partition"), F.col("sigs").alias("signatures"))
