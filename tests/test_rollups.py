"""Totals merged from batches against a recount."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from quillspark.jobs import fixtures as X
from quillspark.operators import merge as M
from quillspark.operators import pages as P
from quillspark.operators import rollups as R

SMALL = "/root/testdata/sf0.001"


def test_pages_by_batch(spark, tmp_path):
    pages = X.fx_pages(spark, SMALL)
    rollup = R.Rollup(spark, str(tmp_path / "pages"), R.PAGES)
    with pytest.raises(ValueError, match="no batch"):
        rollup.totals()
    for batch in (0, 1, 2, 1):  # the second batch twice
        rollup.add(pages.filter(F.pmod("doc_id", F.lit(3)) == batch), batch)
    got, want = rollup.totals().first(), P.dataset_totals(pages).first()
    assert (got.pages, got.chars) == (want.pages, want.chars)
    assert got.documents == pytest.approx(want.documents, rel=0.03) and got.sources == P.merge_summary(pages).first().sources


def test_sketches_within_their_bound(spark, tmp_path):
    rollup = R.Rollup(spark, str(tmp_path / "big"), R.PAGES)
    rows = spark.range(60_000).select(F.concat(F.lit("d"), F.col("id") % 50_000).alias("doc"), F.lit("s").alias("source"), F.lit("t").alias("text"), (F.col("id") % 4).alias("part"))
    for batch in range(4):
        rollup.add(rows.filter(F.col("part") == batch), batch)
    assert rollup.totals().first().documents == pytest.approx(50_000, rel=0.03)


def test_starters(spark, tmp_path):
    qa = X.fx_qa(spark, SMALL)
    rollup = R.Rollup(spark, str(tmp_path / "starters"), {"n": ("count", None)}, ["starter"])
    for batch in range(1, 6):
        rollup.add(qa.filter(F.col("batch_id") == batch).withColumn("starter", R.starter()), batch)
    assert sorted(map(tuple, rollup.totals().collect())) == sorted(map(tuple, M.question_starters(qa).collect()))
    with pytest.raises(ValueError, match="median"):
        R.Rollup(spark, "x", {"m": ("median", None)})
