"""Merging batches without duplicates, and statistics of the merged set."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import merge_key, split_words

ORDER = ["batch_id", "chunk_ord", "pair_idx"]


def keep_first(qa: DataFrame) -> DataFrame:
    """The first row of each merge key by batch and place; Spark cuts each key to one row before the shuffle."""
    keyed = qa.withColumn("_key", merge_key(F.col("question")))
    return keyed.withColumn("_n", F.row_number().over(Window.partitionBy("_key").orderBy(*ORDER))).filter("_n = 1").drop("_key", "_n")


def distribution(qa: DataFrame, column: str, missing: str | None = None) -> DataFrame:
    """Rows by a column's value, with their share in per cent; the total is one broadcast row."""
    value = F.col(column) if missing is None else F.coalesce(column, F.lit(missing))
    counts = qa.groupBy(value.alias(column)).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n").alias("total"))
    return counts.crossJoin(F.broadcast(total)).select(column, "n", F.bround(F.col("n") / F.col("total") * 100, 1).alias("pct"))


def most_common(counts: DataFrame, column: str) -> DataFrame:
    """A distribution, most frequent first, ties by value."""
    return counts.orderBy(F.desc("n"), column)


def quality_summary(scored: DataFrame) -> DataFrame:
    """Mean (0 without any), least and greatest overall score."""
    return scored.agg(F.count("overall").alias("scored"), F.coalesce(F.avg("overall"), F.lit(0.0)).alias("avg_overall"), F.min("overall").alias("min_overall"), F.max("overall").alias("max_overall"))


def question_starters(qa: DataFrame) -> DataFrame:
    """Questions by their first word, lower case; 'unknown' where there is none."""
    starter = F.coalesce(F.lower(F.get(split_words(F.coalesce("question", F.lit(""))), 0)), F.lit("unknown"))
    return qa.groupBy(starter.alias("starter")).agg(F.count(F.lit(1)).alias("n"))


def diversity_metrics(qa: DataFrame) -> DataFrame:
    """Pairs, mean lengths and distinct starters; no row for an empty input."""
    starter = F.coalesce(F.lower(F.get(split_words(F.coalesce("question", F.lit(""))), 0)), F.lit("unknown"))
    length = lambda c: F.avg(F.length(F.coalesce(c, F.lit(""))))
    return qa.agg(F.count(F.lit(1)).alias("total_pairs"), length("question").alias("avg_question_length"), length("answer").alias("avg_answer_length"), F.countDistinct(starter).alias("unique_starters")).filter("total_pairs > 0")


def dedup_summary(qa: DataFrame) -> DataFrame:
    """Per batch: pairs loaded, duplicates of an earlier pair of any batch, and unique pairs."""
    kept = keep_first(qa).groupBy("batch_id").agg(F.count(F.lit(1)).alias("kept"))
    loaded = qa.groupBy("batch_id").agg(F.count(F.lit(1)).alias("loaded"))
    unique = F.coalesce("kept", F.lit(0))
    return loaded.join(kept, "batch_id", "left").select("batch_id", "loaded", (F.col("loaded") - unique).alias("duplicates"), unique.alias("unique_pairs"))


def dataset_statistics(scored: DataFrame) -> DataFrame:
    """One row for the merged set: pairs, mean score, and maps of counts by type, difficulty and batch; one aggregate over all of them."""
    by = ["type", "difficulty", "batch_id"]
    values = [F.col(c).cast("string").alias(c) for c in by]
    sets = scored.select(*values, "overall").groupingSets([[F.col(c)] for c in by] + [[]], *by).agg(F.grouping_id().alias("_of"), F.count(F.lit(1)).alias("n"), F.avg("overall").alias("mean"))
    of = dict(zip(by, (3, 5, 6)))  # the bits of the columns that are left out
    maps = [F.map_from_entries(F.array_sort(F.collect_list(F.when((F.col("_of") == of[c]) & F.col(c).isNotNull(), F.struct(c, "n"))))).alias(f"by_{c}") for c in by]
    whole = F.col("_of") == 7
    return sets.agg(F.coalesce(F.max(F.when(whole, F.col("n"))), F.lit(0)).alias("total_pairs"), F.coalesce(F.max(F.when(whole, F.col("mean"))), F.lit(0.0)).alias("avg_quality"), *maps)
