"""JSON lines with their malformed records set apart, in one pass over the files.

A record is malformed if its line is not one JSON object of the schema: no JSON, cut
off, followed by something else, another kind of value, or with a field of the wrong
kind. Blank lines are no records. In strict mode the first malformed record that a task
meets fails the job and names its file.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import WS, strip
from .io import exists

_BAD = "_malformed"


class Records(NamedTuple):
    """Good records, rejected lines (file, line, value), and counts of the pass: lines, blank, good, rejected."""

    good: DataFrame
    rejected: DataFrame
    counts: dict[str, int]


def _lines(spark: SparkSession, path: str | list[str], pattern: str) -> DataFrame:
    read = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", pattern).text(path)
    return read.select("value", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_at"))


def _parsed(lines: DataFrame, schema: str) -> DataFrame:
    """lines with ``record`` and ``_malformed``."""
    value = strip(F.col("value"))
    record = F.from_json(value, f"{schema}, {_BAD} string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _BAD})
    made = lines.withColumn("record", record)
    # the parser stops at the object's end, so what follows it is looked for: a text with two values is no element of an array
    whole = F.coalesce(F.json_array_length(F.concat(F.lit("["), value, F.lit("]"))) == 1, F.lit(False))
    return made.withColumn(_BAD, F.col("record").isNull() | F.col(f"record.{_BAD}").isNotNull() | ~F.startswith(value, F.lit("{")) | ~whole)


def _blank():
    return ~F.col("value").rlike(f"[^{WS[1:-1]}]")


def read_strict(spark: SparkSession, path: str | list[str], schema: str, pattern: str = "*") -> DataFrame:
    """The records of JSON lines; a malformed one fails the job that reads it."""
    told = F.concat(F.lit("malformed record in "), F.col("_file"), F.lit(": "), F.left("value", F.lit(80)))
    parsed = _parsed(_lines(spark, path, pattern).filter(~_blank()), schema)
    sound = F.when(F.col(_BAD), F.raise_error(told).cast("boolean")).otherwise(F.lit(True))
    return parsed.filter(sound).select("record.*").drop(_BAD)


def with_line_numbers(rejected: DataFrame, splits: DataFrame) -> DataFrame:
    """Rejected lines with their number in their file, from 1: lines of the file's earlier splits, and those before it in its own."""
    before = F.sum("n").over(Window.partitionBy("_file").orderBy("_block")) - F.col("n")
    at = splits.withColumn("before", before).select("_file", "_block", "before", "first")
    return rejected.join(at, ["_file", "_block"]).withColumn("line", F.col("before") + F.col("_at") - F.col("first") + 1)


def read_records(spark: SparkSession, path: str | list[str], schema: str, out: str, pattern: str = "*") -> Records:
    """Good records and rejected lines of JSON lines below path, written below ``out`` in one pass that also counts them.

    Only files that hold a rejected line are read again, and only their lines counted, for its number.
    """
    if exists(spark, out):
        raise ValueError(f"{out} is there already")
    counts = Observation("records")
    none = F.lit(None)
    lines = _parsed(_lines(spark, path, pattern), schema).withColumn("_blank", _blank())
    seen = lines.observe(counts, F.count(F.lit(1)).alias("lines"), F.count_if("_blank").alias("blank"), F.count_if(~F.col("_blank") & ~F.col(_BAD)).alias("good"), F.count_if(~F.col("_blank") & F.col(_BAD)).alias("rejected"))
    kept = seen.filter(~F.col("_blank"))
    bad = F.struct("value", "_file", "_block", "_at")
    rows = kept.select(F.when(F.col(_BAD), none).otherwise(F.col("record").dropFields(_BAD)).alias("record"), F.when(F.col(_BAD), bad).alias("bad"), F.when(F.col(_BAD), "rejected").otherwise("good").alias("kind"))
    rows.write.partitionBy("kind").parquet(out)
    kinds = spark.read.schema(rows.schema).parquet(out)
    good = kinds.filter("kind = 'good'").select("record.*")
    found = kinds.filter("kind = 'rejected'").select("bad.*")
    names = [r[0] for r in found.select("_file").distinct().collect()]  # the driver has listed them all for the scan
    if names:
        again = _lines(spark, names, "*")
        splits = again.groupBy("_file", "_block").agg(F.count(F.lit(1)).alias("n"), F.min("_at").alias("first"))
        found = with_line_numbers(_parsed(again.filter(~_blank()), schema).filter(_BAD), splits)
    else:
        found = found.withColumn("line", F.lit(0).cast("long"))
    return Records(good, found.select(F.col("_file").alias("file"), "line", "value"), dict(counts.get))
