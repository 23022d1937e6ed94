"""Generation batches: contiguous plans, joins with them, resuming and progress."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.shared import written

# Question types and their shares of a chunk's pairs.
SHARES = {"factual": 0.20, "conceptual": 0.20, "procedural": 0.20, "comparative": 0.15, "scenario": 0.15, "analytical": 0.10}


def document_offsets(chunks: DataFrame) -> tuple[DataFrame, int]:
    """(doc, n, before): chunks of each doc, and of all docs before it in order; and the number of all chunks.

    Docs are counted, dealt by range and summed within a range; the driver adds
    up the ranges' totals (one for each partition), so no task sorts all docs.
    """
    counts = chunks.groupBy("doc").agg(F.count(F.lit(1)).alias("n"))
    ranged = written(counts.repartitionByRange("doc").withColumn("part", F.spark_partition_id()), "doc-ranges")
    before, starts = 0, []
    for r in ranged.groupBy("part").agg(F.sum("n").alias("n")).orderBy("part").collect():
        starts.append((r.part, before))
        before += r.n
    starts = chunks.sparkSession.createDataFrame(starts, "part int, start long")
    within = F.sum("n").over(Window.partitionBy("part").orderBy("doc")) - F.col("n")
    return ranged.withColumn("within", within).join(starts, "part").select("doc", "n", (F.col("start") + F.col("within")).alias("before")), before


def contiguous_batches(chunks: DataFrame, n_batches: int = 5) -> DataFrame:
    """chunks (doc, chunk_no, ...) with rank (from 0, by doc and chunk_no) and batch_id; the last batch takes the rest."""
    offsets, total = document_offsets(chunks)
    if total < n_batches:
        raise ValueError(f"{total} chunks cannot fill {n_batches} batches")
    rank = F.col("before") + F.row_number().over(Window.partitionBy("doc").orderBy("chunk_no")) - 1
    ranked = chunks.join(offsets.select("doc", "before"), "doc").withColumn("rank", rank).drop("before")
    return ranked.withColumn("batch_id", F.least(F.floor(F.col("rank") / (total // n_batches)) + 1, F.lit(n_batches)).cast("int"))


def batch_plan(batched: DataFrame, total: int = 50_000, n_batches: int = 5) -> DataFrame:
    """One row for each batch: its target, chunks, pairs a chunk, and how many of each type."""
    target = total // n_batches
    plan = batched.groupBy("batch_id").agg(F.count(F.lit(1)).alias("chunks")).withColumn("target_qa_count", F.lit(target)).withColumn("qa_per_chunk", F.greatest(F.lit(1), F.floor(F.lit(target) / F.col("chunks"))).cast("int"))
    floors = {k: F.floor(F.col("qa_per_chunk") * F.lit(float(s))).cast("int") for k, s in SHARES.items()}
    rest = F.col("qa_per_chunk") - sum(floors.values(), F.lit(0))
    return plan.select("batch_id", "target_qa_count", "chunks", "qa_per_chunk", *[(c + rest if k == "factual" else c).cast("int").alias(k) for k, c in floors.items()])


def plan_chunks(batched: DataFrame, plan: DataFrame) -> DataFrame:
    """Each chunk with its batch's plan. The plan has one row a batch and is left to Spark to broadcast."""
    return batched.join(plan.drop("chunks"), "batch_id")


def pending_chunks(planned: DataFrame, done: DataFrame, key: str = "chunk_id") -> DataFrame:
    """Planned chunks without an entry in done; a rerun neither repeats nor loses one."""
    return planned.join(done.select(key), key, "left_anti")


def batch_progress(plan: DataFrame, raw: DataFrame, filtered: DataFrame) -> DataFrame:
    """Per planned batch its raw and filtered pairs, progress in per cent, chunks done and status."""
    made = raw.groupBy("batch_id").agg(F.count(F.lit(1)).alias("raw"), F.countDistinct("chunk_id").alias("processed"))
    kept = filtered.groupBy("batch_id").agg(F.count(F.lit(1)).alias("kept"))
    zero = F.lit(0)
    rows = plan.join(made, "batch_id", "left").join(kept, "batch_id", "left")
    progress = F.when(F.col("target_qa_count") > 0, F.coalesce("kept", zero) / F.col("target_qa_count") * 100).otherwise(0.0)
    status = F.when(F.col("raw").isNull(), "not_started").when(F.col("processed") >= F.col("chunks"), "completed").otherwise("in_progress")
    return rows.select("batch_id", status.alias("status"), "target_qa_count", F.coalesce("raw", zero).alias("raw_generated"), F.coalesce("kept", zero).alias("filtered_count"), F.bround(progress, 1).alias("progress_percentage"), F.col("chunks").alias("chunks_total"), F.coalesce("processed", zero).alias("chunks_processed"))
