"""Deduplication of new batches against all earlier ones, by a stored index of keys.

The index is a table of keys bucketed by key, a partition for each batch, and beside it
a Bloom filter cut in blocks of 32,768 bits: a key has its block and ``HASHES`` bits in
it. A new batch is held against the filter first; what the filter rules out is new, and
only the others are shuffled to the buckets of the index, which itself is never
shuffled. The filter only saves work: a key is new just if no earlier batch has it.

Both are plain files below a path and outlive the session. A batch that is added again
replaces its own part, and is held against the batches before it alone.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import merge_key
from ..sources.io import exists
from ..sources.shared import written
from .merge import ORDER

#: Bits of a block of the filter (what Spark's bitmap functions hold), bits a key, and bits set for each key.
BLOCK_BITS = 32_768
BITS_PER_KEY = 12
HASHES = 4


class SeenKeys:
    """The keys of all batches so far, below a path in a store that all executors reach.

    ``buckets`` and ``expected`` (keys in all, by which the filter is sized) are fixed
    when the index is made; more keys than expected make the filter less sharp, no result wrong.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int = 64, expected: int = 10_000_000):
        self.spark, self.path, self.name = spark, path.rstrip("/"), f"seen_{uuid.uuid4().hex}"
        kept = f"{self.path}/settings"
        if exists(spark, kept):
            buckets, expected = spark.read.schema("buckets int, expected long").json(kept).first()
        else:
            spark.createDataFrame([(buckets, expected)], "buckets int, expected long").coalesce(1).write.json(kept)
        self.blocks = max(1, -(-expected * BITS_PER_KEY // BLOCK_BITS))
        spark.sql(f"create table {self.name} (key string, batch int) using parquet partitioned by (batch) clustered by (key) sorted by (key) into {buckets} buckets location '{self.path}/keys'")
        if exists(spark, f"{self.path}/keys"):
            spark.sql(f"alter table {self.name} recover partitions")

    def close(self) -> None:
        """Forgets the table's name; its files stay."""
        self.spark.sql(f"drop table if exists {self.name}")

    def keys(self, before: int | None = None) -> DataFrame:
        """(key) of all batches, or of those before one; read by bucket."""
        rows = self.spark.table(self.name)
        return (rows if before is None else rows.filter(F.col("batch") < before)).select("key")

    def _block(self, key: Column) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(self.blocks))

    def _bits(self, key: Column) -> list[Column]:
        return [F.pmod(F.xxhash64(key, F.lit(k + 1)), F.lit(BLOCK_BITS)) for k in range(HASHES)]

    def _filter(self, before: int) -> DataFrame:
        """(block, bits) of the batches before one."""
        path = f"{self.path}/filter"
        if not exists(self.spark, path):
            return self.spark.createDataFrame([], "block long, bits binary")
        parts = self.spark.read.schema("block long, bits binary, batch int").parquet(path)
        return parts.filter(F.col("batch") < before).groupBy("block").agg(F.bitmap_or_agg("bits").alias("bits"))

    def flagged(self, rows: DataFrame, before: int, key: str = "_key") -> DataFrame:
        """rows with ``_maybe``: whether the filter lets their key through."""
        told = rows.withColumn("_block", self._block(F.col(key))).join(self._filter(before).withColumnRenamed("block", "_block"), "_block", "left")
        held = F.lit(True)
        for at in self._bits(F.col(key)):
            byte = F.conv(F.hex(F.substring("bits", (F.floor(at / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
            held = held & (F.call_function("shiftright", byte, F.pmod(at, F.lit(8)).cast("int")).bitwiseAND(F.lit(1)) == 1)
        return told.withColumn("_maybe", F.col("bits").isNotNull() & held).drop("_block", "bits")

    def unseen(self, rows: DataFrame, before: int, key: str = "_key") -> DataFrame:
        """The saved rows whose key no batch before has."""
        told = self.flagged(rows, before, key)
        old = self.keys(before)
        maybe = told.filter("_maybe").join(old, told[key] == old["key"], "left_anti")
        return told.filter("not _maybe").unionByName(maybe).drop("_maybe")

    def add(self, qa: DataFrame, batch: int, key: Column | None = None) -> DataFrame:
        """The rows of one batch (ORDER, question, ...) that are the first of their merge key in it and in all batches before; adds their keys."""
        keyed = qa.withColumn("_key", F.coalesce(merge_key(F.col("question")) if key is None else key, F.lit("")))
        first = keyed.withColumn("_n", F.row_number().over(Window.partitionBy("_key").orderBy(*ORDER))).filter("_n = 1").drop("_n")
        new = written(self.unseen(written(first, "first-of-batch"), batch), "unseen")
        self.spark.sql(f"insert overwrite table {self.name} partition (batch = {int(batch)}) select _key from {{keys}}", keys=new.select("_key").repartition("_key"))
        bits = new.select(self._block(F.col("_key")).alias("block"), F.explode(F.array(*self._bits(F.col("_key")))).alias("at"))
        bits.groupBy("block").agg(F.bitmap_construct_agg("at").alias("bits")).write.mode("overwrite").parquet(f"{self.path}/filter/batch={int(batch)}")
        return new.drop("_key")
