"""License scans as an exact set-similarity join of text blocks with templates.

A block is a window of as many consecutive words as a template has; it matches
when it holds at least the template's threshold share of its distinct words.
Template words are ordered by the number of documents that hold them, rarest
first. A block that meets the threshold must hold one of the template's first
words in that order (prefix filter), so only blocks around such words are
looked at, and texts with too few words are passed over (length filter). Of a
block's shared words the first in the order is one of them, and all others follow
it there; so around a shared word only the template's words from its place in the
order on are counted, and where there are too few it is passed over (positional
filter). What remains is verified in full, so nothing is missed.

The templates are the caller's, and literals of the plan, so the
join needs no shuffle: every row is joined where it is read, with DataFrame
expressions only. One aggregate counts the template words' documents.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Separators of words after A-Z is lower-cased. lower() changes letters outside
#: ASCII too, but makes no template word of a word that is none.
_SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


@dataclass(frozen=True)
class Template:
    """``base``: a phrase whose words must stand consecutively."""

    label: str
    text: str
    threshold: float = 0.8
    base: bool = False


# --- fixed values: base phrases of the scan, and openings of public license notices
TEMPLATES = (
    Template("mit", "under the mit license", 1.0, True),
    Template("apache-2", "apache license version 2", 1.0, True),
    Template("cc-by-nc", "cc by nc", 1.0, True),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and "
                    "associated documentation files the software to deal in the software without restriction"),
    Template("apache-2", "licensed under the apache license version 2 0 the license you may not use this file except in "
                         "compliance with the license"),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted "
                    "provided that the following conditions are met"),
    Template("gpl", "licensed under the gnu general public license"),
    Template("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu "
                    "general public license as published by the free software foundation"),
    Template("cc-by-nc", "licensed under a creative commons attribution noncommercial license"),
    Template("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    Template("public-domain", "this is free and unencumbered software released into the public domain"),
)


def words(text: Column) -> Column:
    """The words of a text; none for null."""
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), _SEPARATORS), "")


def document_frequencies(docs: DataFrame, vocabulary: list[str], text_col: str = "text") -> dict[str, int]:
    """Documents that hold each word of ``vocabulary``, over all of ``docs``."""
    wanted = F.array(*map(F.lit, vocabulary))
    found = docs.select(F.explode(F.array_intersect(words(F.col(text_col)), wanted)).alias("word"))
    counts = {r.word: r["count"] for r in found.groupBy("word").count().collect()}
    return {w: counts.get(w, 0) for w in vocabulary}


@dataclass(frozen=True)
class _Ordered:
    """A template with its distinct words in global order."""

    template: Template
    sequence: tuple[str, ...]
    tokens: tuple[str, ...]
    need: int

    @property
    def prefix(self) -> tuple[str, ...]:
        return self.tokens[:len(self.tokens) - self.need + 1]


def _ordered(templates: tuple[Template, ...], frequency: dict[str, int]) -> list[_Ordered]:
    out = []
    for t in templates:
        sequence = tuple(t.text.split())
        tokens = tuple(sorted(set(sequence), key=lambda w: (frequency[w], w)))
        out.append(_Ordered(t, sequence, tokens, ceil(t.threshold * len(tokens) - 1e-9)))
    return out


def _literal(values: tuple[str, ...]) -> Column:
    return F.array(*map(F.lit, values))


def _hits(w: Column, t: _Ordered, positional: bool = True) -> Column:
    """Places of the words of ``w`` that are in the template's prefix and have enough
    of its words around them, with ``positional`` only those that can follow them in
    the order."""
    length, tokens, prefix = len(t.sequence), _literal(t.tokens), _literal(t.prefix)

    def reaches(p: Column) -> Column:
        near = F.slice(w, F.greatest(p - length + 2, F.lit(1)), F.lit(2 * length - 1))
        rank = F.array_position(prefix, w[p]).cast("int") if positional else F.lit(1)
        return F.size(F.array_intersect(near, F.slice(tokens, rank, F.lit(len(t.tokens))))) >= t.need

    found = F.filter(F.sequence(F.lit(0), F.size(w) - 1), lambda p: F.array_contains(prefix, w[p]))
    return F.filter(found, reaches)


def _blocks(w: Column, n: Column, t: _Ordered, positional: bool = True) -> Column:
    """Starts and overlaps of the blocks of ``w`` that meet the threshold."""
    length, tokens = len(t.sequence), _literal(t.tokens)

    def around(p: Column) -> Column:  # the blocks that hold word p
        return F.sequence(F.greatest(p - length + 1, F.lit(0)), F.least(p, F.greatest(n - length, F.lit(0))))

    starts = F.array_distinct(F.flatten(F.transform(_hits(w, t, positional), around)))
    scored = F.transform(starts, lambda s: F.struct(
        s.alias("start"), F.size(F.array_intersect(F.slice(w, s + 1, F.lit(length)), tokens)).alias("overlap")))
    possible = F.arrays_overlap(w, _literal(t.prefix)) & (F.least(n, F.lit(length)) >= t.need)
    return F.when(possible, F.filter(scored, lambda b: b["overlap"] >= t.need))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         templates: tuple[Template, ...] = TEMPLATES) -> DataFrame:
    """One row per row of ``docs``: id, n_words, n_base (places of base
    phrases), first_word and last_word (their smallest and largest start; else
    null), base_labels, labels (sorted, comma-joined), score (the best share of
    a template that a matching block holds; 0 without any) and blocks (label,
    start, share of every matching block).

    Null and empty texts have no words; a text of any length is scanned whole;
    repeated rows are scanned one by one; other columns, whatever their names, are
    ignored; an empty table gives an empty result. The templates may be of any number
    and length; the plan grows with their words.
    """
    vocabulary = sorted({w for t in templates for w in t.text.split()})
    order = _ordered(templates, document_frequencies(docs, vocabulary, text_col))
    every_prefix = _literal(tuple(sorted({w for t in order for w in t.prefix})))
    rows = docs.select(F.col(id_col).alias("id"), words(F.col(text_col)).alias("w"))
    rows = rows.withColumn("n", F.size("w"))
    # Rows without any prefix word, nearly all, are done after one look-up.
    found = rows.withColumn("found", F.when(F.arrays_overlap("w", every_prefix), F.array(*(
        F.coalesce(_blocks(F.col("w"), F.col("n"), t), F.array().cast("array<struct<start:int,overlap:int>>")) for t in order))))

    def every(pick, wanted) -> Column:
        """An array over templates: pick(template, its blocks)."""
        parts = [pick(t, F.col("found")[i]) for i, t in enumerate(order) if wanted(t)]
        return F.when(F.col("found").isNotNull(), F.array(*parts))

    def places(t: _Ordered, blocks: Column) -> Column:
        phrase = _literal(t.sequence)
        exact = F.filter(blocks, lambda b: F.slice(F.col("w"), b["start"] + 1, F.lit(len(t.sequence))) == phrase)
        return F.transform(exact, lambda b: b["start"])

    def label(t: _Ordered, hit: Column) -> Column:
        return F.when(hit, F.lit(t.template.label))

    def joined(labels: Column) -> Column:
        return F.coalesce(F.array_join(F.array_sort(F.array_distinct(F.filter(labels, lambda x: x.isNotNull()))), ","), F.lit(""))

    bases = [t for t in order if t.template.base]
    found = found.withColumn("places", every(places, lambda t: t.template.base).cast("array<array<int>>"))
    starts = F.flatten("places")
    base_labels = F.when(F.col("places").isNotNull(), F.array(*(label(t, F.size(F.col("places")[i]) > 0) for i, t in enumerate(bases))).cast("array<string>"))
    # A block with a phrase's words in another order is a match of the method too.
    all_labels = every(lambda t, b: label(t, F.size(b) > 0), lambda t: True)
    blocks = F.flatten(every(lambda t, b: F.transform(b, lambda x: F.struct(
        F.lit(t.template.label).alias("label"), x["start"].cast("long").alias("start"),
        (x["overlap"] / F.lit(len(t.tokens))).alias("share"))), lambda t: True))
    return found.select(
        F.col("id").alias(id_col), F.col("n").cast("long").alias("n_words"),
        F.coalesce(F.size(starts), F.lit(0)).cast("long").alias("n_base"),
        F.array_min(starts).cast("long").alias("first_word"), F.array_max(starts).cast("long").alias("last_word"),
        joined(base_labels).alias("base_labels"), joined(all_labels).alias("labels"),
        F.coalesce(F.array_max(F.transform(blocks, lambda b: b["share"])), F.lit(0.0)).alias("score"),
        F.coalesce(blocks, F.array().cast("array<struct<label:string,start:bigint,share:double>>")).alias("blocks"))
