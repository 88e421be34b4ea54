import random
import re

import pytest
from pyspark.sql import functions as F

from storepulse.llm import license_scan as L

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
MIT = ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
       "documentation files (the \"Software\"), to deal in the Software without restriction")
TEXTS = [None, "", " .,!", "GNU General Public License", "the gnu general public license, Version 3 or GNU-GENERAL/public license",
         "cc by", "CC BY-NC 4.0. cc by-sa; CC", "MIT_License mit license mit license", "apache\x00license version 2.0",
         "the general public license of gnu", "mitlicense apache licenses", "über MIT License é", "İ apache license İ", "cc by"]


def lowered(text):
    return (text or "").translate({c: c + 32 for c in range(65, 91)})


def base(text):
    words = WORD.findall(lowered(text))
    places = [(i, label) for phrase, label in L.PHRASES for p in [phrase.split()]
              for i in range(len(words)) if words[i:i + len(p)] == p]
    starts = [i for i, _ in places]
    return (len(words), len(places), min(starts, default=None), max(starts, default=None),
            ",".join(sorted({label for _, label in places})))


def scan(spark, texts, **more):
    frame = spark.createDataFrame([(i, t, "kept", 1) for i, t in enumerate(texts)],
                                  "doc_id long, text string, labels string, template int").repartition(3)
    return {r.doc_id: r for r in L.scan_licenses(frame, **more).collect()}


def test_base_equals_brute_force(spark):
    rng = random.Random(4)
    vocabulary = "gnu general public license apache cc by mit nc version 2 0 free software the".split()
    texts = TEXTS + [" ".join(rng.choices(vocabulary, k=rng.randrange(0, 60))) for _ in range(200)]
    found = scan(spark, texts)
    assert len(found) == len(texts)
    for i, text in enumerate(texts):
        r = found[i]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == base(text), text
        assert set(r.base_labels.split(",")) - {""} <= set(r.labels.split(","))
        assert (r.score == 0) == (r.labels == "") and 0 <= r.score <= 1
        assert len(r.spans) >= r.n_base


def test_reworded_notices_are_found(spark):
    words = MIT.split()
    changed = [*words[:12], "natural", "or", *words[12:20], *words[21:]]  # two words more, one less
    far = [w for word in words for w in (word, "x", "y", "z", "u")]
    half = words[:14]
    filler = ["lorem"] * 500
    found = scan(spark, [MIT, " ".join(filler + changed + filler), " ".join(far), " ".join(half), " ".join([MIT] * 3)])
    assert [found[i].labels for i in range(5)] == ["mit", "mit", "", "", "mit"]
    assert found[0].score == 1.0 and 0.8 <= found[1].score < 1
    assert (found[1].spans[0]["first"], found[1].spans[0]["last"]) == (500, 500 + len(WORD.findall(" ".join(changed))) - 1)
    assert [s["first"] for s in found[4].spans] == [0, 29, 58]


def test_names_need_all_their_words(spark):
    found = scan(spark, ["Apache License, Version 2.0", "apache license version 1 0", "CC BY-NC 4.0",
                         "GNU General Public License, version 2", "this program is free", "GNU Lesser General Public License"])
    assert [found[i].labels for i in range(6)] == ["apache,apache-2.0", "apache", "cc-by,cc-by-nc", "gpl,gpl-2.0", "", "lgpl"]


def test_repeated_null_and_long_rows(spark):
    long = "word " * 200_000 + "mit license " * 50_000
    rows = [(7, "mit license"), (7, "mit license"), (7, "cc by"), (None, "cc by"), (None, None), (8, long)]
    found = L.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted((r.doc_id or 0, r.n_words, r.n_base, r.base_labels) for r in found.collect()) == sorted([
        (7, 2, 1, "mit"), (7, 2, 1, "mit"), (7, 2, 1, "cc-by"), (0, 2, 1, "cc-by"), (0, 0, 0, ""),
        (8, 300_000, 50_000, "mit")])


def test_own_templates_and_bounds(spark):
    own = [L.Template("all rights reserved", "own", base=True)]
    assert scan(spark, ["x All rights reserved."], templates=own)[0].base_labels == "own"
    for words, drift in (("one", 0), ("one two three", 3), (" ".join(["w"] * 61), 0)):
        with pytest.raises(ValueError):
            L.scan_licenses(spark.createDataFrame([], "doc_id long, text string"), [L.Template(words, "x", drift=drift)])


def test_empty_and_native(spark):
    none = L.scan_licenses(spark.createDataFrame([], "doc_id long, text string"))
    assert none.count() == 0
    plan = L.scan_licenses(spark.range(3).select(F.col("id").alias("doc_id"), F.lit("mit license").alias("text")))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in text and "ExistingRDD" not in text
