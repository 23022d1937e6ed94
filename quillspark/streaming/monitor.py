"""Structured Streaming over growing outputs: live counts, throughput, resume and first-seen questions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import normalize_question
from ..sources.shared import shared_path

SCORED = "batch_id int, chunk_id long, pair_idx int, question string, accepted boolean, ts timestamp"


def read_growing(spark: SparkSession, path: str, schema: str = SCORED, files_per_trigger: int = 2) -> DataFrame:
    """A folder of JSON lines as a stream, a few files at a time."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).json(path)


def live_counts(stream: DataFrame) -> DataFrame:
    """Raw and accepted pairs of each batch so far, and the pass rate in per cent (0 without pairs)."""
    counts = stream.groupBy("batch_id").agg(F.count(F.lit(1)).alias("raw"), F.count_if(F.col("accepted")).alias("filtered"))
    return counts.withColumn("pass_rate", F.when(F.col("raw") > 0, F.bround(F.col("filtered") / F.col("raw") * 100, 1)).otherwise(0.0))


def throughput(stream: DataFrame, late: str = "10 minutes") -> DataFrame:
    """Accepted pairs a minute of event time; a minute's state goes once the watermark has passed it."""
    minutes = stream.filter("accepted").withWatermark("ts", late).groupBy(F.window("ts", "1 minute")).agg(F.count(F.lit(1)).alias("pairs"))
    return minutes.select(F.col("window.start").alias("minute"), "pairs")


def first_seen(stream: DataFrame, within: str | None = None) -> DataFrame:
    """Pairs whose normalised question is new to its batch, by arrival; ``within`` bounds the state by a watermark."""
    keyed = stream.withColumn("q_norm", normalize_question(F.coalesce("question", F.lit(""))))
    if within is None:
        return keyed.dropDuplicates(["batch_id", "q_norm"])
    return keyed.withWatermark("ts", within).dropDuplicatesWithinWatermark(["batch_id", "q_norm"])


def run_to(stream: DataFrame, mode: str, checkpoint: str | None = None) -> DataFrame:
    """Runs a stream over what has arrived and returns what it wrote: the last state in complete mode, all rows in append mode."""
    spark = stream.sparkSession
    out, checkpoint = shared_path(spark, "stream-out"), checkpoint or shared_path(spark, "stream-checkpoint")
    schema = stream.schema
    if mode == "append":
        stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start().awaitTermination()
        return spark.read.schema(schema).parquet(out)

    def keep(batch: DataFrame, batch_no: int) -> None:
        batch.write.mode("overwrite").parquet(out)

    stream.writeStream.foreachBatch(keep).option("checkpointLocation", checkpoint).outputMode(mode).trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(schema).parquet(out)


def new_rows_per_poll(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Appends (poll, batch_id, rows) of each micro-batch to path; a poll that runs twice replaces its own rows."""

    def count(batch: DataFrame, poll: int) -> None:
        batch.groupBy("batch_id").agg(F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(f"{path}/poll={poll}")

    stream.writeStream.foreachBatch(count).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def generate_incrementally(prompts: DataFrame, generate: Callable[[DataFrame], DataFrame], path: str, checkpoint: str) -> None:
    """Generates for chunks as they arrive; a poll that runs twice replaces its own output, so a restart repeats nothing."""

    def run(batch: DataFrame, poll: int) -> None:
        generate(batch).write.mode("overwrite").parquet(f"{path}/poll={poll}")

    prompts.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
