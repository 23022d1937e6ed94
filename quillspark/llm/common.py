"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.shared import shared_path as shared_dir
from ..sources.shared import written

__all__ = ["WORD", "identity", "join_counted", "least_hashes", "packed", "saved", "shared_dir", "table", "text_of", "word_count"]

#: A word: a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
#: Rows of a table of keys that may be broadcast whole.
BROADCAST_KEYS = 100_000
#: A key that more than one in so many rows have is hot; there are fewer than this of them, whatever the input.
HOT_SHARE = 10_000


#: Rows that Python is sent at a time in place of Spark's 10,000, as each holds a whole text; another number that a user has set stays.
BATCH_ROWS = 2_000
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def _with_small_batches(spark: SparkSession) -> SparkSession:
    if spark.conf.get(_BATCH) == "10000":
        spark.conf.set(_BATCH, BATCH_ROWS)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return _with_small_batches(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def saved(df: DataFrame, name: str) -> DataFrame:
    """df, written to the shared folder and read back: computed once, and safe from lost executors."""
    _with_small_batches(df.sparkSession)
    return written(df, name)


def packed(docs: DataFrame, *columns: str) -> DataFrame:
    """docs as one struct ``row`` beside the columns that are named, so that no name of theirs meets an added one."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), *columns)


def identity(docs: DataFrame) -> list[Column]:
    """k1, k2: 128 bits that tell rows apart by all columns and by which are null."""
    values: list[Column] = []
    for field in docs.schema:
        c = F.col(f"`{field.name}`")
        values += [c.isNull(), F.to_json(F.struct(c)) if "map<" in field.dataType.simpleString() else c]
    return [F.xxhash64(F.lit(k), *values).alias(f"k{k}") for k in (1, 2)]


def join_counted(rows: DataFrame, facts: DataFrame, keys: list[str], how: str = "inner", n: str = "n") -> DataFrame:
    """rows joined with a saved table of facts, one row a key, that says in ``n`` how many rows have it (dropped).

    Few facts are broadcast whole. Else those of hot keys are, fewer than
    ``HOT_SHARE`` by their share of all rows, and only the others are shuffled, so no
    key is a task's burden.
    """
    size, total = facts.agg(F.count(F.lit(1)), F.coalesce(F.sum(n), F.lit(0))).first()
    plain = facts.drop(n)
    if size <= BROADCAST_KEYS:
        return rows.join(F.broadcast(plain), keys, how)
    hot = facts.filter(F.col(n) * HOT_SHARE > F.lit(total)).drop(n)
    cold = rows.join(F.broadcast(hot.select(keys)), keys, "left_anti").join(plain, keys, how)
    return cold.unionByName(rows.join(F.broadcast(hot), keys))


def least_hashes(df: DataFrame, h: str, limit: int, *ties: str, n: int | None = None) -> DataFrame:
    """The rows of df with the least hash, ``limit`` at most; of n rows (counted unless told) all but some twice as many are filtered out where they are read."""
    n = df.count() if n is None else n
    if n > 2 * limit:
        df = df.filter(F.col(h) < F.lit(min((1 << 63) - 1, -(1 << 63) + (1 << 64) * 2 * limit // n)))
    return df.orderBy(h, *ties).limit(limit)


def text_of(column: str = "text") -> Column:
    """The column with null as the empty string."""
    return F.coalesce(F.col(column), F.lit(""))


def word_count(text: Column) -> Column:
    """Number of words of a text as a long: the spaces between them and one, once white space is single spaces."""
    for c in "\t\n\x0b\x0c\r":
        text = F.replace(text, F.lit(c), F.lit(" "))
    text = F.trim(text)
    single = F.when(F.contains(text, F.lit("  ")), F.regexp_replace(text, "  +", " ")).otherwise(text)
    return F.when(text == "", F.lit(0)).otherwise(F.octet_length(single) - F.octet_length(F.replace(single, F.lit(" "), F.lit(""))) + 1).cast("long")
