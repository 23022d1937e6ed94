"""Readers and writers of the corpus' files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PAGE = "id string, doc string, page int, total_pages int, text string, source string, method string, timestamp string"
CHUNK = "id string, text string, doc string, page_range array<int>, topic string, char_count int, sentence_count int, keywords array<string>, source_pages array<string>"
QA = "question string, answer string, difficulty string, type string, chunk_id string, batch_id int"


def _mode(strict: bool) -> str:
    return "FAILFAST" if strict else "PERMISSIVE"


def read_jsonl(spark: SparkSession, path: str | list[str], schema: str, strict: bool = False) -> DataFrame:
    """One record a line; blank lines are skipped. The schema is given, never inferred.

    A malformed line is a row of nulls, or if ``strict`` an error; ``records.read_records`` sets such lines apart.
    """
    return spark.read.schema(schema).option("mode", _mode(strict)).json(path)


def read_json_array(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A file that is one JSON array of records; a path that ends in .jsonl is read by line."""
    return read_jsonl(spark, path, schema) if path.endswith(".jsonl") else spark.read.schema(schema).option("multiLine", True).json(path)


def merge_jsonl(spark: SparkSession, root: str, schema: str = PAGE, pattern: str = "*.jsonl", strict: bool = False) -> DataFrame:
    """All JSON lines below root as one dataset; write it outside root. Malformed lines as in read_jsonl."""
    return spark.read.schema(schema).option("mode", _mode(strict)).option("recursiveFileLookup", True).option("pathGlobFilter", pattern).json(root)


def read_markdown(spark: SparkSession, root: str, pattern: str = "*.md") -> DataFrame:
    """One row for each markdown file below root: directory, doc (the file's stem), text."""
    files = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", pattern).text(root, wholetext=True)
    place = F.col("_metadata.file_path")
    return files.select(F.regexp_replace(place, "/[^/]*$", "").alias("directory"), F.regexp_replace(F.col("_metadata.file_name"), r"\.[^.]*$", "").alias("doc"), F.col("value").alias("text"))


def with_metadata_file(spark: SparkSession, markdown: DataFrame, root: str) -> DataFrame:
    """Markdown rows that have a ``<doc>_metadata.json`` beside them. Only names are listed, no content is read."""
    beside = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*_metadata.json").load(root).select("path")
    names = beside.select(F.regexp_replace("path", "/[^/]*$", "").alias("directory"), F.regexp_extract("path", r"([^/]*)_metadata\.json$", 1).alias("doc"))
    return collect_ocr(markdown, names)


def collect_ocr(markdown: DataFrame, metadata: DataFrame) -> DataFrame:
    """Markdown rows (directory, doc, ...) with an entry in metadata (directory, doc)."""
    return markdown.join(metadata, ["directory", "doc"], "left_semi")


def list_documents(spark: SparkSession, root: str, pattern: str = "*.pdf") -> DataFrame:
    """name, stem and size_mb of each file; the content column is never read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(root)
    name = F.regexp_extract("path", "([^/]*)$", 1)
    return files.select("path", name.alias("name"), F.regexp_replace(name, r"\.[^.]*$", "").alias("stem"), F.bround(F.col("length") / (1024 * 1024), 2).alias("size_mb"))


def write_jsonl(df: DataFrame, path: str, mode: str = "error", compression: str = "none") -> None:
    """UTF-8 lines with non-ASCII kept and null fields written; all readers here take compressed files by their names."""
    df.write.mode(mode).option("ignoreNullFields", False).option("compression", compression).json(path)


def write_batches(df: DataFrame, path: str, compression: str = "none") -> None:
    """One folder a batch_id; a rerun replaces just the batches it holds."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("ignoreNullFields", False).option("compression", compression).partitionBy("batch_id").json(path)


def read_batches(spark: SparkSession, path: str, schema: str, batches: list[int], strict: bool = False) -> DataFrame:
    """The union of those batches that exist; the others' folders are not read. Malformed lines as in read_jsonl."""
    return read_jsonl(spark, path, schema, strict).filter(F.col("batch_id").isin(batches))


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path is there, in any store that Spark knows."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)
