"""Page records: splitting, routing, assembling and profiling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import preview, strip

#: Where the default router looks, and the mean length from which a document counts as digital.
SAMPLE_PAGES = 5
MIN_CHARS = 100


def _page_id() -> Column:
    return F.format_string("%s-p%d", F.col("doc"), F.col("page"))


def split_pages_rule(markdown: DataFrame, drop_empty: bool = False) -> DataFrame:
    """Pages of (doc, text) between page rules, numbered from 1; numbers stay where empty pages are dropped."""
    parts = F.split("text", "\n---\n", -1)
    pages = markdown.select(*[c for c in markdown.columns if c != "text"], F.size(parts).alias("total_pages"), F.posexplode(parts).alias("at", "part"))
    pages = pages.select(*[c for c in pages.columns if c not in ("at", "part")], (F.col("at") + 1).alias("page"), strip(F.col("part")).alias("text"))
    pages = pages.withColumn("id", _page_id())
    return drop_empty_pages(pages) if drop_empty else pages


def split_pages_comment(markdown: DataFrame) -> DataFrame:
    """Pages of (doc, text) between page comments, blank parts dropped before they are numbered.

    Dashes at a part's end are cut off; a part that is empty then still counts as
    a page but is not returned. A text without comments is one page.
    """
    parts = F.filter(F.split("text", r"<!-- Page \p{Nd}+ -->", -1), lambda p: F.length(strip(p)) > 0)
    cut = F.transform(parts, lambda p: strip(F.regexp_replace(strip(p), r"(?<!-)-+\z", "")))
    pages = F.when(F.contains("text", F.lit("<!-- Page")), cut).otherwise(F.array(strip(F.col("text"))))
    rows = markdown.select("doc", pages.alias("pages")).select("doc", F.size("pages").alias("total_pages"), F.posexplode("pages").alias("at", "text"))
    return rows.filter(F.length("text") > 0).select("doc", "total_pages", (F.col("at") + 1).alias("page"), "text")


def pages_to_markdown(pages: DataFrame) -> DataFrame:
    """One markdown text for each doc: page comments, texts and rules in page order."""
    part = F.format_string("<!-- Page %d -->\n\n%s\n\n---\n\n", F.col("page"), F.col("text"))
    ordered = F.array_sort(F.collect_list(F.struct("page", part.alias("part"))))
    return pages.groupBy("doc").agg(F.array_join(F.transform(ordered, lambda p: p["part"]), "").alias("text"))


def drop_empty_pages(pages: DataFrame) -> DataFrame:
    """Pages with more than white space; their numbers stay."""
    return pages.filter(F.length(strip(F.col("text"))) > 0)


def route_documents(pages: DataFrame, sample_pages: int = SAMPLE_PAGES, min_chars: float = MIN_CHARS) -> DataFrame:
    """Per doc: total_pages, mean stripped length of its first pages, and whether it is digital or needs OCR.

    Run it before empty pages are dropped; they count as 0 characters.
    """
    first = F.when(F.col("page") <= sample_pages, F.length(strip(F.col("text"))))
    means = pages.groupBy("doc").agg(F.count(F.lit(1)).alias("total_pages"), F.coalesce(F.avg(first), F.lit(0.0)).alias("mean"))
    digital = F.col("mean") >= min_chars
    return means.select("doc", "total_pages", F.bround("mean", 1).alias("avg_chars_per_page"), digital.alias("is_digital"), F.when(digital, "digital").otherwise("ocr").alias("extraction_method"))


def assemble_documents(pages: DataFrame) -> DataFrame:
    """Per doc the page texts in order, a blank line between them."""
    ordered = F.array_sort(F.collect_list(F.struct("page", "text")))
    return pages.groupBy("doc").agg(F.array_join(F.transform(ordered, lambda p: p["text"]), "\n\n").alias("text"))


def dataset_totals(pages: DataFrame) -> DataFrame:
    """Documents, pages, characters and characters a page (0 if there are none)."""
    chars = F.coalesce(F.sum(F.length("text")), F.lit(0))
    return pages.agg(F.countDistinct("doc").alias("documents"), F.count(F.lit(1)).alias("pages"), chars.alias("chars"), F.coalesce(F.avg(F.length("text")), F.lit(0.0)).alias("avg_chars_per_page"))


def method_breakdown(pages: DataFrame) -> DataFrame:
    """Pages by extraction method."""
    return pages.groupBy("method").agg(F.count(F.lit(1)).alias("pages"))


def document_stats(pages: DataFrame) -> DataFrame:
    """Per doc its pages and characters, and the source and method of its last page."""
    return pages.groupBy("doc").agg(F.count(F.lit(1)).alias("pages"), F.sum(F.length("text")).alias("chars"), F.max_by("source", "page").alias("source"), F.max_by("method", "page").alias("method"))


def merge_summary(pages: DataFrame) -> DataFrame:
    """Records and distinct sources."""
    return pages.agg(F.count(F.lit(1)).alias("records"), F.countDistinct("source").alias("sources"))


def preview_pages(pages: DataFrame, n: int = 3, size: int = 500) -> DataFrame:
    """The first records, by doc and page, with the start of their text."""
    return pages.orderBy("doc", "page").limit(n).select("doc", "page", F.length("text").alias("n_chars"), preview(F.col("text"), size).alias("preview"))


def union_methods(digital: DataFrame, ocr: DataFrame) -> DataFrame:
    """Digital and OCR pages as one table."""
    return digital.unionByName(ocr)


def sorted_documents(pages: DataFrame) -> DataFrame:
    """The documents' statistics in the order of their names; sort only where they are shown or written."""
    return document_stats(pages).orderBy("doc")
