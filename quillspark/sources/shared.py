"""Tables in the folder that the driver and all executors share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: Paths given out so far, by application.
_given: dict[str, list[str]] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder that the driver and all executors share, the session's ``spark.checkpoint.dir``.

    Only where that is unset and all runs on one machine, as in tests, a local one is made and set.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        base = tempfile.mkdtemp(prefix="spark-shared-")
        spark.conf.set("spark.checkpoint.dir", base)
    return base.rstrip("/")


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder, which ``clear`` removes."""
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    _given.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def written(df: DataFrame, name: str) -> DataFrame:
    """df, written to the shared folder and read back: computed once, and safe from lost executors."""
    path = shared_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop(df: DataFrame) -> None:
    """Removes what ``written`` has stored for df; all that was read from it must be stored by then."""
    spark, paths = df.sparkSession, _given.get(df.sparkSession.sparkContext.applicationId, [])
    files = df.inputFiles()
    for path in [p for p in paths if files and f"/{p.rsplit('/', 1)[-1]}/" in files[0]]:
        _remove(spark, path)
        paths.remove(path)


_BRIEF = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def brief_shuffles(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of queries within go with their query, not when the driver next collects its garbage."""
    own = spark.conf.get(_BRIEF)
    spark.conf.set(_BRIEF, "true")
    try:
        yield
    finally:
        spark.conf.set(_BRIEF, own)


def kept_path(spark: SparkSession, name: str) -> str:
    """The path of this name in the shared folder, the same at every call; ``clear`` leaves it."""
    return f"{shared_folder(spark)}/kept/{name}"


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is such a file or folder, in any store."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def _remove(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def clear(spark: SparkSession) -> int:
    """Removes all that this application has written to the shared folder; what was read from it must be stored by then. Returns the number of paths."""
    paths = _given.pop(spark.sparkContext.applicationId, [])
    for path in paths:
        _remove(spark, path)
    return len(paths)
