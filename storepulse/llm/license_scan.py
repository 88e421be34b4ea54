"""License scans by diagonal voting, in DataFrame functions only.

Every word k-gram of a document that occurs in a template votes for the diagonal (place in
the document minus place in the template) on which both would run in step. A copy of a
template is a diagonal with many votes; insertions and deletions move it to a neighbour.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: What lies between words, once A-Z are lower-cased.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

#: Phrases whose every place is reported, and their labels.
PHRASES = [
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
]

#: Phrases that name a license more closely.
NAMES = [
    ("gnu general public license version 2", "gpl-2.0"),
    ("gnu general public license version 3", "gpl-3.0"),
    ("gnu lesser general public license", "lgpl"),
    ("gnu affero general public license", "agpl"),
    ("gnu free documentation license", "gfdl"),
    ("apache license version 2 0", "apache-2.0"),
    ("apache license 2 0", "apache-2.0"),
    ("cc by nc", "cc-by-nc"),
    ("cc by nd", "cc-by-nd"),
    ("cc by sa", "cc-by-sa"),
    ("cc by nc nd", "cc-by-nc-nd"),
    ("cc by nc sa", "cc-by-nc-sa"),
    ("cc0 1 0", "cc0"),
    ("bsd 2 clause", "bsd-2-clause"),
    ("bsd 3 clause", "bsd-3-clause"),
    ("bsd license", "bsd"),
    ("isc license", "isc"),
    ("mozilla public license", "mpl"),
    ("eclipse public license", "epl"),
    ("boost software license", "bsl"),
    ("spdx license identifier mit", "mit"),
]

#: First sentences of licenses and notices, which are often reworded a little.
NOTICES = [
    ("permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
     "documentation files the software to deal in the software without restriction", "mit"),
    ("permission to use copy modify and or distribute this software for any purpose with or without fee is hereby "
     "granted provided that the above copyright notice and this permission notice appear in all copies", "isc"),
    ("redistribution and use in source and binary forms with or without modification are permitted provided that "
     "the following conditions are met", "bsd"),
    ("you may not use this file except in compliance with the license you may obtain a copy of the license at "
     "http www apache org licenses license 2 0", "apache-2.0"),
    ("this program is free software you can redistribute it and or modify it under the terms of the gnu general "
     "public license as published by the free software foundation", "gpl"),
    ("this library is free software you can redistribute it and or modify it under the terms of the gnu lesser "
     "general public license as published by the free software foundation", "lgpl"),
    ("this source code form is subject to the terms of the mozilla public license", "mpl"),
    ("this is free and unencumbered software released into the public domain", "unlicense"),
    ("this work is licensed under a creative commons attribution 4 0 international license", "cc-by"),
    ("this work is licensed under the creative commons attribution noncommercial 4 0 international license", "cc-by-nc"),
    ("this work is licensed under the creative commons attribution sharealike 4 0 international license", "cc-by-sa"),
]

#: Words in a k-gram: all of a phrase's bigrams must vote, notices need longer runs to be told apart.
_SHORT, _LONG = 2, 4
_KEY = ["doc_id", "_hash", "_other", "n_words"]


@dataclass(frozen=True)
class Template:
    """`least`: share of the words that a span must cover. `drift`: how many words two
    neighbouring diagonals of one span may lie apart; 0 keeps diagonals by themselves."""

    words: str
    label: str
    base: bool = False
    least: float = 1.0
    drift: int = 0

    @property
    def k(self) -> int:
        return _LONG if self.drift else _SHORT


def default_templates() -> list[Template]:
    return ([Template(words, label, base=True) for words, label in PHRASES]
            + [Template(words, label) for words, label in NAMES]
            + [Template(words, label, least=0.8, drift=3) for words, label in NOTICES])


def words_of(text: Column) -> Column:
    """The words of a text; null counts as empty. Lower-casing all letters changes no bound
    between words, as all letters beyond A-Z are word characters."""
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), BETWEEN), "")


def _grams(rows: DataFrame) -> DataFrame:
    """`rows` with one row per place of `words` (`pos` from 1, words w0 .. w3 from there on,
    null beyond the end) and one more with `pos` 0 and no words."""
    tail = lambda i: F.slice("words", i + 1, F.greatest(F.size("words") - i, F.lit(0)))
    names = [f"w{i}" for i in range(_LONG)]
    for i, name in enumerate(names):
        rows = rows.withColumn(name, tail(i))
    # The outer form, as a filter on the array's size would make Spark compute it twice.
    nothing = F.array(F.struct(*[F.lit(None).cast("string").alias(n) for n in names]))
    return (rows.withColumn("grams", F.concat(nothing, F.arrays_zip(*names))).drop("words", *names)
            .select(*[c for c in rows.columns if c not in ("words", *names)], F.posexplode_outer("grams").alias("pos", "g"))
            .select("*", "g.*").drop("g"))


def _hash() -> Column:
    return F.xxhash64("w0", "w1")


def _template_grams(spark: SparkSession, templates: list[Template]) -> DataFrame:
    """One row per k-gram of each template: its place as a bit, and its words."""
    rows = F.array(*[F.struct(
        F.lit(i).alias("template"), F.lit(t.k).alias("k"), F.split(F.lit(t.words), " ").alias("words"))
        for i, t in enumerate(templates)])
    grams = _grams(spark.range(1).select(F.inline(rows)))
    return grams.filter((F.col("pos") > 0) & F.col(f"w{_SHORT - 1}").isNotNull()
                        & ((F.col("k") == _SHORT) | F.col(f"w{_LONG - 1}").isNotNull())).select(
        _hash().alias("hash"), "template", (F.col("pos") - 1).alias("at"), "k",
        *[F.col(f"w{i}").alias(f"t{i}") for i in range(_LONG)])


def _votes(docs: DataFrame, templates: list[Template], id_col: str, text_col: str) -> DataFrame:
    """Per document, template and diagonal: `mask`, the template's k-grams found there as
    bits, and the first and last word. One row of each document has no template: `n` is
    then the number of equal rows."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("_hash"),
                       F.xxhash64(F.lit(1), text).alias("_other"), words_of(F.col(text_col)).alias("words"))
    grams = _grams(rows.withColumn("n_words", F.size("words").cast("long")))
    grams = grams.withColumn("hash", F.when(F.col("pos") > 0, _hash()))
    same = (F.col("w0") == F.col("t0")) & (F.col("w1") == F.col("t1")) & (
        (F.col("k") == _SHORT) | ((F.col("w2") == F.col("t2")) & (F.col("w3") == F.col("t3"))))
    met = (grams.join(F.broadcast(_template_grams(docs.sparkSession, templates)), "hash", "left")
           .filter((F.col("pos") == 0) | same))
    first = F.col("pos").cast("long") - 1
    return met.groupBy(*_KEY, "template", (first - F.col("at")).alias("diagonal")).agg(
        F.count("*").alias("n"), F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("at"))).alias("mask"),
        F.min(first).alias("first"), F.max(first + F.col("k") - 1).alias("last"))


def scan_licenses(docs: DataFrame, templates: list[Template] | None = None, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """One row per row of `docs`: `doc_id`, `n_words`, `n_base`, `first_word`, `last_word`,
    `base_labels`, `labels`, `score`, `spans`.

    Base templates are found at every place where all their words stand consecutively:
    `n_base` counts the places, `first_word` and `last_word` are the smallest and largest
    start (words from 0; null without any). Other templates add to `labels`. Names must
    stand whole too; of notices a span must cover 80 percent of the words, in runs of four
    words or more on diagonals at most three words apart, and be no longer than one and a
    half templates. `spans` lists the verified spans (first word, last word, label,
    coverage) in order; `score` is the largest coverage among them, 0 without any. Labels
    are distinct, sorted and comma-joined; none gives an empty string.

    A null or empty text has no words. Rows that repeat an id are scanned by themselves,
    equal rows once and returned as often as they occur. An empty table gives an empty
    result; other columns of `docs` are ignored. Templates have 2 to 60 words, notices 4
    or more; their k-grams, a constant table, are broadcast. Texts are read once and never
    shuffled: a document is one row after the first combination, with one for each
    template's diagonal that it meets.
    """
    templates = default_templates() if templates is None else templates
    for t in templates:
        if not t.k <= len(t.words.split(" ")) <= 60:
            raise ValueError(f"a template of {len(t.words.split(' '))} words: {t.words}")
    column = lambda value: F.get(F.array(*[F.lit(value(t)) for t in templates]), F.col("template"))
    shift = lambda mask, i: F.call_function("shiftleft", mask, F.lit(i))

    def coverage(mask: Column) -> Column:
        """Share of the template's words that lie in a k-gram found."""
        words = mask.bitwiseOR(shift(mask, 1))
        words = F.when(column(lambda t: t.k) == _LONG, words.bitwiseOR(shift(mask, 2)).bitwiseOR(shift(mask, 3))) \
            .otherwise(words)
        return F.bit_count(words) / column(lambda t: len(t.words.split(" ")))

    votes = _votes(docs, templates, id_col, text_col).repartition(*_KEY)
    in_order = Window.partitionBy(*_KEY, "template").orderBy("diagonal")
    apart = F.col("diagonal") - F.lag("diagonal").over(in_order)
    fresh = F.when(apart <= column(lambda t: t.drift), 0).otherwise(1)
    merged = votes.withColumn("fresh", fresh).withColumn("run", F.sum("fresh").over(in_order))
    alone = F.max(F.struct(coverage(F.col("mask")).alias("cover"), (-F.col("first")).alias("back"), "last"))
    runs = merged.groupBy(*_KEY, "template", "run").agg(
        F.sum("n").alias("n"), F.bit_or("mask").alias("mask"), F.min("first").alias("first"),
        F.max("last").alias("last"), alone.alias("alone"))
    # The merged span, if it holds together; else the best of its diagonals by itself.
    length = column(lambda t: len(t.words.split(" ")))
    whole = (F.col("last") - F.col("first") + 1 <= length * 1.5) & (coverage(F.col("mask")) >= F.col("alone.cover"))
    spans = runs.select(
        *_KEY, "template", "n", F.when(whole, F.col("first")).otherwise(-F.col("alone.back")).alias("first"),
        F.when(whole, F.col("last")).otherwise(F.col("alone.last")).alias("last"),
        F.when(whole, coverage(F.col("mask"))).otherwise(F.col("alone.cover")).alias("cover"))
    found = F.col("cover") >= column(lambda t: t.least)
    base = found & column(lambda t: t.base)
    label = column(lambda t: t.label)
    join = lambda labels: F.array_join(F.sort_array(labels), ",")
    told = spans.groupBy(*_KEY).agg(
        F.max(F.when(F.col("template").isNull(), F.col("n"))).alias("copies"),
        F.count_if(base).alias("n_base"), F.min(F.when(base, F.col("first"))).alias("first_word"),
        F.max(F.when(base, F.col("first"))).alias("last_word"),
        join(F.collect_set(F.when(base, label))).alias("base_labels"),
        join(F.collect_set(F.when(found, label))).alias("labels"),
        F.coalesce(F.max(F.when(found, F.col("cover"))), F.lit(0.0)).alias("score"),
        F.sort_array(F.collect_list(F.when(found, F.struct(
            F.col("first"), F.col("last"), label.alias("label"), F.col("cover").alias("coverage"))))).alias("spans"))
    return told.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans",
        F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("_i")).drop("_i")
