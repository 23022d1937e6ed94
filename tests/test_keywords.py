"""Keywords of large dictionaries against the column function, and both ways against each other."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from quillspark.functions.text import TERMS, extract_keywords
from quillspark.operators import keywords as K


def test_words_equal_the_column_function(spark):
    rng = random.Random(3)
    pieces = [*TERMS, "Soil", "soils", "corn_x", "wéed", "weed,", "(crop)", "crop-soil", "\n", "\u2003", "İnsect", "a"]
    rows = [(k, rng.choice([" ", "  ", "\t"]).join(rng.choice(pieces) for _ in range(rng.randrange(80)))) for k in range(200)] + [(900, None), (901, "")]
    docs = spark.createDataFrame(rows, "id long, text string")
    terms = spark.createDataFrame([(t,) for t in [*TERMS, "abc", "Corn", "corn  soil", "x y", "été"]], "term string")
    want = {r.id: r.k or [] for r in docs.select("id", extract_keywords(F.col("text")).alias("k")).collect()}
    for size in (K.BROADCAST_BYTES, 0):
        assert {r.id: r.keywords for r in K.keywords(docs, terms, broadcast_bytes=size).collect()} == want


def test_phrases(spark):
    docs = spark.createDataFrame([(1, "Corn\n seed. Corn seed, corn, seed; corn seeds acorn seed corn seed"), (2, "soil soil soil"), (3, "soil-water soil water")], "id long, text string")
    terms = spark.createDataFrame([(t,) for t in ("corn seed", "seed", "corn", "seed corn", "soil soil", "soil water", "seed corn seed")], "term string")
    for size in (K.BROADCAST_BYTES, 0):
        got = {r.id: r.keywords for r in K.keywords(docs, terms, broadcast_bytes=size).collect()}
        assert got == {1: ["corn", "seed", "corn seed", "seed corn", "seed corn seed"], 2: ["soil soil"], 3: ["soil water"]}, size


def test_a_million_terms(spark):
    letters = lambda c: F.translate(F.lpad(c.cast("string"), 7, "0"), "0123456789", "abcdefghij")
    terms = spark.range(1_000_000).select(letters(F.col("id")).alias("term"))
    docs = spark.range(200).select("id", F.concat_ws(" ", letters(F.col("id")), letters(F.col("id") * 4999), letters(F.col("id") * 4999), F.lit("zzzzzzz unknown")).alias("text"))
    got = {r.id: r.keywords for r in K.keywords(docs, terms).collect()}
    name = lambda n: f"{n:07d}".translate(str.maketrans("0123456789", "abcdefghij"))
    assert all(got[k] == list(dict.fromkeys([name(k * 4999), name(k)])) for k in range(200))
