"""Statistics kept up batch by batch: each batch leaves one small row a group, and totals merge these rows instead of recounting all data.

Counts, sums, least and greatest values merge exactly; distinct values as HyperLogLog
sketches, whose estimate has a relative standard error of about ``1.04 / sqrt(2**LG_K)``
(0.8 % here). Where distinct values must be exact, ``seen.SeenKeys`` counts the new keys
of each batch. A batch that is added again replaces its own rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import split_words
from ..sources.io import exists

LG_K = 14
KINDS = ("count", "sum", "min", "max", "distinct")

#: name: (kind, column) of what dataset_totals and merge_summary, chunk_stats and diversity_metrics tell.
PAGES = {"pages": ("count", None), "chars": ("sum", lambda: F.length("text")), "documents": ("distinct", lambda: F.col("doc")), "sources": ("distinct", lambda: F.col("source"))}
CHUNKS = {"chunks": ("count", None), "chars": ("sum", lambda: F.col("char_count")), "min_chars": ("min", lambda: F.col("char_count")), "max_chars": ("max", lambda: F.col("char_count")), "documents": ("distinct", lambda: F.col("doc"))}
PAIRS = {"total_pairs": ("count", None), "question_chars": ("sum", lambda: F.length(F.coalesce("question", F.lit("")))), "answer_chars": ("sum", lambda: F.length(F.coalesce("answer", F.lit(""))))}


def starter() -> Column:
    """A question's first word in lower case, 'unknown' where there is none."""
    return F.coalesce(F.lower(F.get(split_words(F.coalesce("question", F.lit(""))), 0)), F.lit("unknown"))


class Rollup:
    """Measures (name: (kind, column)) by some columns, a part for each batch below a path."""

    def __init__(self, spark: SparkSession, path: str, measures: dict, by: list[str] | None = None):
        unknown = {kind for kind, _ in measures.values()} - {*KINDS}
        if unknown:
            raise ValueError(f"no measures: {sorted(unknown)}")
        self.spark, self.path, self.measures, self.by = spark, path.rstrip("/"), measures, by or []

    def _of(self, name: str) -> Column:
        kind, column = self.measures[name]
        if kind == "count":
            return F.count(F.lit(1))
        made = {"sum": F.sum, "min": F.min, "max": F.max, "distinct": lambda c: F.hll_sketch_agg(c.cast("string"), LG_K)}[kind](column())
        return made

    def add(self, rows: DataFrame, batch: int) -> None:
        """Adds a batch, or puts it in its own place anew."""
        rows.groupBy(*self.by).agg(*[self._of(m).alias(m) for m in self.measures]).write.mode("overwrite").parquet(f"{self.path}/batch={int(batch)}")

    def totals(self) -> DataFrame:
        """One row a group over all batches; distinct values are estimates. No rows before the first batch."""
        if not exists(self.spark, self.path):
            raise ValueError(f"no batch below {self.path}")
        merge = {"count": F.sum, "sum": F.sum, "min": F.min, "max": F.max, "distinct": lambda m: F.hll_sketch_estimate(F.hll_union_agg(m))}
        return self.spark.read.parquet(self.path).groupBy(*self.by).agg(*[merge[kind](m).alias(m) for m, (kind, _) in self.measures.items()])
