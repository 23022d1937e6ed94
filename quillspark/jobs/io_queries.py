"""Queries that write files of the corpus' formats and read them back, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.pages import drop_empty_pages, split_pages_rule
from ..operators.responses import extract_pages
from ..sources import io as S
from ..sources.shared import shared_path
from . import fixtures as X
from .fixtures import duck

_QA = "chunk_id long, pair_idx int, batch_id int, question string, answer string, type string"


def _jsonl(s, d):
    path = shared_path(s, "jsonl")
    S.write_jsonl(X.fx_qa(s, d).select("chunk_id", "pair_idx", "batch_id", "question", "answer", "type"), path)
    return S.read_jsonl(s, path, _QA)


def _merged(s, d):
    """Page files, a folder a source, merged to one dataset."""
    root = shared_path(s, "tree")
    pages = X.fx_pages(s, d).select("id", "doc", "page", "text", "source", "method")
    pages.withColumn("folder", F.col("source")).write.partitionBy("folder").json(root)
    return S.merge_jsonl(s, root, pattern="*.json").select("id", "doc", "page", "source", "method", F.length("text").alias("n_chars"))


def _batches(s, d):
    """Batches written one by one, the second one twice; 1, 2, 3 and an absent 9 read together."""
    path = shared_path(s, "batches")
    rows = X.fx_qa(s, d).select("chunk_id", "pair_idx", "batch_id", "question")
    for wanted in ("batch_id < 4", "batch_id = 2", "batch_id >= 4"):
        S.write_batches(rows.filter(wanted), path)
    return S.read_batches(s, path, "chunk_id long, pair_idx int, question string, batch_id int", [1, 2, 3, 9])


def _collected(s, d):
    """Markdown of documents that have a metadata entry: those whose number is not divisible by three."""
    markdown = X.fx_markdown(s, d).withColumn("directory", F.lit("ocr"))
    metadata = markdown.filter(F.substring("doc", 8, 5).cast("int") % 3 != 0).select("directory", "doc")
    return drop_empty_pages(split_pages_rule(S.collect_ocr(markdown, metadata))).select("id", "page")


def _arrays(s, d):
    """Files that are JSON arrays, of a hundred chunks each."""
    path = shared_path(s, "arrays")
    one = F.to_json(F.struct("chunk_id", "pair_idx", "batch_id", "question", "answer", "type"))
    files = X.fx_qa(s, d).groupBy(F.floor(F.col("chunk_id") / 100)).agg(F.concat(F.lit("["), F.array_join(F.collect_list(one), ",\n"), F.lit("]")).alias("value"))
    files.select("value").write.option("maxRecordsPerFile", 1).text(path)
    return S.read_json_array(s, path, _QA)


def _files(s, d):
    """A folder with a text file for each document."""
    root = shared_path(s, "markdown")
    X.fx_markdown(s, d).repartition("doc").write.partitionBy("doc").text(root)
    return root


def _doc_of(path: str):
    return F.regexp_extract(path, "doc=([^/]*)", 1).alias("doc")


def _markdown(s, d):
    return S.read_markdown(s, _files(s, d), "*.txt").select(_doc_of("directory"), F.md5(F.col("text").cast("binary")).alias("digest"))


def _listing(s, d):
    return S.list_documents(s, _files(s, d), "*.txt").select(_doc_of("path"), "size_mb")


def _extracted(s, d):
    """The extractor hook with a function that cuts a file's bytes into pages."""
    files = s.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.txt").load(_files(s, d))
    pages = extract_pages(files, lambda path, content: content.decode().split("\n---\n"))
    return pages.select(_doc_of("path"), "page", "total_pages", F.md5(F.col("text").cast("binary")).alias("digest"))


QUERIES = {"s1_jsonl": _jsonl, "s2_json_array": _arrays, "s4_markdown": _markdown, "s5_listing": _listing, "f3_extract": _extracted, "s3_merge": _merged, "s7_batches": _batches, "j6_collect_ocr": _collected}
_EMPTY = r"regexp_replace(part, '[ \n]+', '', 'g') != ''"
SQL = {
    "s2_json_array": duck('select chunk_id, pair_idx, batch_id, question, answer, "type" from fx_qa', "fx_qa"),
    "s4_markdown": duck("select doc, md5(text || E'\\n') digest from fx_markdown", "fx_markdown"),
    "s5_listing": duck("select doc, round_even((octet_length(encode(text)) + 1) / 1048576, 2) size_mb from fx_markdown", "fx_markdown"),
    "f3_extract": duck("select doc, unnest(range(1, len(p) + 1))::int page, len(p)::int total_pages, md5(unnest(p)) digest from (select doc, string_split(text || E'\\n', E'\\n---\\n') p from fx_markdown)", "fx_markdown"),
    "s1_jsonl": duck('select chunk_id, pair_idx, batch_id, question, answer, "type" from fx_qa', "fx_qa"),
    "s3_merge": duck('select id, doc, page, source, "method", length(text)::int n_chars from fx_pages', "fx_pages"),
    "s7_batches": duck("select chunk_id, pair_idx, question, batch_id from fx_qa where batch_id < 4", "fx_qa"),
    "j6_collect_ocr": duck(
        f"with p as (select doc, unnest(string_split(text, E'\\n---\\n')) part, unnest(range(1, len(string_split(text, E'\\n---\\n')) + 1))::int page from fx_markdown) select doc || '-p' || page id, page from p where doc[8:12]::int % 3 != 0 and {_EMPTY}",
        "fx_markdown",
    ),
}
