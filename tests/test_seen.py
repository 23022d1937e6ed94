"""The stored index of keys: batch by batch equals all at once."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from quillspark.operators import merge as M
from quillspark.operators.seen import SeenKeys

QA = "chunk_ord long, pair_idx int, batch_id int, question string"


def rows(spark, n=3000, kinds=700):
    made = spark.range(n).select((F.col("id") * 7919 % n).alias("chunk_ord"), F.lit(1).alias("pair_idx"), (F.col("id") % 4 + 1).cast("int").alias("batch_id"), F.concat(F.lit("Question "), (F.xxhash64("id") % kinds).cast("string"), F.lit("?")).alias("question"))
    return made.unionByName(spark.createDataFrame([(n + k, 1, 1 + k % 4, q) for k, q in enumerate([None, None, "", "!?", "Same", "same?", " same "])], QA))


def places(df):
    return sorted((r.batch_id, r.chunk_ord) for r in df.collect())


@pytest.mark.parametrize("expected", [10_000, 1])  # a filter that fits, and one that is far too small
def test_batch_by_batch_equals_all_at_once(spark, tmp_path, expected):
    qa = rows(spark)
    kept = []
    for batch in (1, 2, 3, 4):
        index = SeenKeys(spark, str(tmp_path / "index"), buckets=4, expected=expected)  # opened anew for each batch
        kept += places(index.add(qa.filter(F.col("batch_id") == batch), batch))
        index.close()
    assert sorted(kept) == places(M.keep_first(qa.withColumn("question", F.coalesce("question", F.lit("")))))
    index = SeenKeys(spark, str(tmp_path / "index"))
    again = places(index.add(qa.filter("batch_id = 3"), 3))
    assert again == [p for p in sorted(kept) if p[0] == 3] and index.keys().count() == len(kept)
    index.close()


def test_the_index_is_not_shuffled(spark, tmp_path):
    index = SeenKeys(spark, str(tmp_path / "index"), buckets=4, expected=10_000)
    qa = rows(spark)
    index.add(qa.filter("batch_id = 1"), 1)
    index.add(qa.filter("batch_id = 2"), 2)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        keyed = qa.filter("batch_id = 3").select(F.col("question").alias("_key"))
        plan = index.unseen(keyed, 3)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    lines = plan.split("\n")
    at = next(k for k, x in enumerate(lines) if "Bucketed: true" in x)
    depth = lambda x: re.search(r"[A-Za-z(]", x).start()
    above = lines[at]
    for line in reversed(lines[:at]):  # the operators over the scan, up to the join
        if depth(line) < depth(above):
            above = line
            assert "Exchange" not in line
            if "SortMergeJoin" in line:
                break
    assert "SortMergeJoin" in above
    index.close()


def test_most_new_keys_never_meet_the_index(spark, tmp_path):
    index = SeenKeys(spark, str(tmp_path / "index"), buckets=4, expected=20_000)
    old = spark.range(20_000).select(F.col("id").alias("chunk_ord"), F.lit(1).alias("pair_idx"), F.lit(1).alias("batch_id"), F.concat(F.lit("old "), "id").alias("question"))
    index.add(old, 1)
    new = spark.range(10_000).select(F.concat(F.lit("new "), "id").alias("_key"))
    assert index.flagged(new, 2).filter("_maybe").count() < 1000
    assert index.flagged(old.select(F.col("question").alias("_key")), 2).filter("not _maybe").count() == 0
    index.close()
