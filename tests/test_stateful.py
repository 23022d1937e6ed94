"""Programs over streams against the batch operators."""

from __future__ import annotations

import random
import time

from pyspark.sql import functions as F

from quillspark.operators import quality as Q
from quillspark.operators import usage as U
from quillspark.streaming import monitor as S
from quillspark.streaming import stateful as T

PAIR = "batch_id int, chunk_id long, chunk_ord long, pair_idx int, question string, ts timestamp"
CALL = "event_id long, api_key string, us long, failed boolean, prompt_words int, response_words int"
START = 1_704_067_200


def arriving(spark, tmp_path, df, files, name="in"):
    """df as a stream of files, read one at a time in the order of the column ``file``."""
    for k in range(files):
        df.filter(F.col("file") == k).drop("file").coalesce(1).write.mode("append").json(str(tmp_path / name))
    return spark.readStream.schema(df.drop("file").schema).option("maxFilesPerTrigger", 1).option("latestFirst", False).json(str(tmp_path / name))


def test_first_by_order(spark, tmp_path):
    rng = random.Random(1)
    rows = [(k % 2, k, k, p, rng.choice(["Why?", "How so", "why", f"q {k}"]), k * 60 + p) for k in range(40) for p in range(2)]
    rng.shuffle(rows)  # earlier rows come late, by up to the whole input
    df = spark.createDataFrame([(*r, i * 4 // len(rows)) for i, r in enumerate(rows)], "batch_id int, chunk_id long, chunk_ord long, pair_idx int, question string, s long, file int").withColumn("ts", F.timestamp_seconds(F.lit(START) + F.col("s"))).drop("s")
    stream = arriving(spark, tmp_path, df, 4)
    with T.program_state(spark):
        changes = S.run_to(T.first_by_order(stream, "2 hours", 7200), "append")
    rows = changes.collect()
    assert any(r.change < 0 for r in rows)
    want = Q.first_occurrences(df).select("batch_id", "chunk_ord", "pair_idx")
    got = T.settled(changes).select("batch_id", "chunk_ord", "pair_idx")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_first_by_order_of_many_questions(spark, tmp_path):
    """Many questions, all of them in two files and earlier in the second, cost no call to the state store each."""
    rows = spark.range(80_000).selectExpr("1 batch_id", "if(id < 40000, 100000 - id, id - 40000) chunk_id", "if(id < 40000, 100000 - id, id - 40000) chunk_ord", "1 pair_idx", "concat('q ', id % 40000) question", f"timestamp_seconds({START}) ts", "cast(id div 40000 as int) file")
    stream = arriving(spark, tmp_path, rows, 2)
    began = time.perf_counter()
    with T.program_state(spark):
        changes = S.run_to(T.first_by_order(stream, "2 hours", 7200), "append")
    took = time.perf_counter() - began
    got = T.settled(changes).agg(F.count("*").alias("n"), F.countDistinct("q_norm").alias("questions"), F.max("chunk_ord").alias("last"), F.min("pair_idx").alias("p")).first()
    assert (got.n, got.questions, got.last, got.p) == (40_000, 40_000, 39_999, 1) and changes.filter("change < 0").count() == 40_000
    assert took < 40


def test_state_goes(spark, tmp_path):
    """A question that comes again when its state is gone is a first one anew."""
    rows = [(1, 1, 1, 1, "Why?", 0, 0), (1, 2, 2, 1, "other", 100_000, 1), (1, 3, 3, 1, "why", 100_001, 2), (1, 4, 4, 1, "other", 100_002, 3)]
    df = spark.createDataFrame(rows, "batch_id int, chunk_id long, chunk_ord long, pair_idx int, question string, s long, file int").withColumn("ts", F.timestamp_seconds(F.lit(START) + F.col("s"))).drop("s")
    with T.program_state(spark):
        changes = S.run_to(T.first_by_order(arriving(spark, tmp_path, df, 4), "1 second", 60), "append").collect()
    assert sorted((r.chunk_id, r.change) for r in changes) == [(1, 1), (2, 1), (3, 1)]


def test_request_limit(spark, tmp_path):
    rng = random.Random(2)
    rows = [(i, rng.choice("ab"), START * 10**6 + rng.choice([rng.randrange(400 * 10**6), 10**6 * rng.randrange(400)]), False, 1, 1) for i in range(300)]
    rows.sort(key=lambda r: r[2] + rng.randrange(8 * 10**6))  # out of order by 8 seconds at most
    end = [(-1, "end", START * 10**6 + 10**12, True, 0, 0)]
    df = spark.createDataFrame([(*r, i * 3 // len(rows)) for i, r in enumerate(rows)] + [(*r, 3) for r in end], CALL + ", file int")
    with T.program_state(spark):
        got = S.run_to(T.request_limit(arriving(spark, tmp_path, df, 4), "10 seconds", 5), "append")
    want = U.request_limit(df.filter("event_id >= 0").drop("file"), 5).select("event_id", "earlier", "limited")
    assert sorted(map(tuple, got.select("event_id", "earlier", "limited").collect())) == sorted(map(tuple, want.collect()))


def test_tokens_per_minute(spark, tmp_path):
    rows = [(i, "k", START * 10**6 + i * 7 * 10**6, i % 5 == 0, i, 2 * i, i * 3 // 60) for i in range(60)] + [(99, "end", START * 10**6 + 10**12, False, 0, 0, 3)]
    df = spark.createDataFrame(rows, CALL + ", file int")
    got = S.run_to(T.tokens_per_minute(arriving(spark, tmp_path, df, 4), "10 seconds", 500), "append")
    want = U.tokens_per_minute(df.filter("event_id < 99"), 500)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_a_side_that_lags(spark, tmp_path):
    """All raw rows arrive before the first filtered one."""
    rows = [(k % 3, k, 1, k * 60, k * 4 // 40) for k in range(40)] + [(9, 99, 1, 10**6, 4)]
    schema = "batch_id int, chunk_id long, pair_idx int, s long, file int"
    raw = spark.createDataFrame(rows, schema).withColumn("ts", F.timestamp_seconds(F.lit(START) + F.col("s"))).drop("s")
    filtered = raw.filter("chunk_id % 4 = 1 or chunk_id = 99").withColumn("file", F.when(F.col("chunk_id") == 99, 4).otherwise(3)).withColumn("ts", F.col("ts") + F.expr("interval 5 minutes"))
    a, b = arriving(spark, tmp_path, raw, 5, "raw"), arriving(spark, tmp_path, filtered, 5, "filtered")
    got = S.run_to(T.side_by_side(a, b), "append").filter("chunk_id < 99").collect()
    assert sorted((r.chunk_id, r.accepted) for r in got) == [(k, k % 4 == 1) for k in range(40)]
    want = S.live_counts(raw.filter("chunk_id < 99").withColumn("accepted", F.col("chunk_id") % 4 == 1))
    assert sorted(map(tuple, S.live_counts(spark.createDataFrame(got)).collect())) == sorted(map(tuple, want.collect()))
