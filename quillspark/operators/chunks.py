"""Chunks: overlapping word windows, and sections packed into topic-coherent pieces."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import WS, WS_IN, count_sentences, extract_keywords, extract_topic, let, prefix_sums, split_words, strip

TARGET, SHORTEST, LONGEST = 2000, 1000, 3500

# What a section header looks like (all capitals, numbered, title case before a new paragraph).
HEADERS = (
    rf"\n([A-Z][A-Z{WS_IN}]{{10,}})\n",
    rf"\n(\p{{Nd}}+\.?\p{{Nd}}*{WS}+[A-Z][^\n]{{5,50}})\n",
    rf"\n([A-Z][a-z]+(?:{WS}+[A-Z][a-z]+){{1,5}})\n(?=[A-Z\(])",
)


def word_window_chunks(pages: DataFrame, size: int = 800, overlap: int = 120) -> DataFrame:
    """Windows of words of each page (id, doc, page, source, text), numbered from 1; no page is shuffled."""
    step = max(1, size - overlap)
    words = pages.select(F.col("id").alias("page_id"), "doc", "page", "source", split_words(F.col("text")).alias("words")).filter(F.size("words") > 0)
    windows = F.transform(F.sequence(F.lit(0), F.size("words") - 1, F.lit(step)), lambda s: F.array_join(F.slice("words", s + 1, size), " "))
    rows = words.select("page_id", "doc", "page", "source", F.posexplode(windows).alias("at", "text"))
    return rows.select(F.format_string("%s-c%d", "page_id", F.col("at") + 1).alias("id"), "doc", "page", (F.col("at") + 1).alias("chunk_id"), "text", "source")


def match_starts(text: Column, pattern: str) -> Column:
    """Where each non-overlapping match of a pattern starts, from 0."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    lengths = lambda s: F.zip_with(F.slice(s["gaps"], F.lit(1), F.size(s["found"])), s["found"], lambda gap, hit: (F.length(gap) + F.length(hit)).cast("long"))
    starts = lambda s: F.zip_with(prefix_sums(lengths(s)), s["found"], lambda end, hit: (end - F.length(hit)).cast("int"))
    return let(F.struct(F.split(text, pattern, -1).alias("gaps"), found.alias("found")), starts)


def section_boundaries(text: Column) -> Column:
    """0, the start of every header (its line break) and the text's length: sorted and distinct."""
    starts = [match_starts(text, p) for p in HEADERS]
    return F.array_sort(F.array_distinct(F.concat(F.array(F.lit(0)), *starts, F.array(F.length(text)))))


def _sections(docs: DataFrame, shortest: int) -> tuple[DataFrame, Column]:
    """docs (doc, text, ...) with their boundaries, and the sections that are long enough as a column over them. Short ones are dropped, not merged.

    The column is not added to the rows: an explosion of an added one would bring a
    filter of its own along, for which Spark looks for all sections anew.
    """
    # an empty text has no section; a filter on the boundaries themselves would look for them twice
    found = docs.filter(F.length("text") > 0).withColumn("_at", section_boundaries(F.col("text")))
    cut = F.transform(F.sequence(F.lit(1), F.size("_at") - 1), lambda k: F.substring(F.col("text"), F.get("_at", k - 1) + 1, F.get("_at", k) - F.get("_at", k - 1)))
    return found, F.filter(cut, lambda x: F.length(x) >= shortest)


def sections(docs: DataFrame, shortest: int = SHORTEST) -> DataFrame:
    """Sections of (doc, text): doc, section (their number), text."""
    keep = [c for c in docs.columns if c != "text"]
    found, own = _sections(docs, shortest)
    return found.select(*keep, F.posexplode(own).alias("section", "text"))


def pack_paragraphs(text: Column, target: int = TARGET) -> Column:
    """A text's paragraphs packed greedily into stripped parts under the target; a longer paragraph is a part of its own."""
    start = F.struct(F.lit("").alias("cur"), F.expr("cast(array() as array<string>)").alias("out"))

    def add(state: Column, para: Column) -> Column:
        fits = F.length(state["cur"]) + F.length(para) < target
        flushed = F.when(fits | (state["cur"] == ""), state["out"]).otherwise(F.concat(state["out"], F.array(strip(state["cur"]))))
        return F.struct(F.concat(F.when(fits, state["cur"]).otherwise(F.lit("")), para, F.lit("\n\n")).alias("cur"), flushed.alias("out"))

    # the text after the last flush is a part whenever there was a paragraph, and there always is one
    return F.aggregate(F.split(text, "\n\n", -1), start, add, lambda s: F.concat(s["out"], F.array(strip(s["cur"]))))


def greedy_pack(lengths: Column, target: int = TARGET) -> Column:
    """How many of a text's paragraphs (by their lengths) each packed part takes, in order: linear, for texts of very many paragraphs."""

    @F.pandas_udf("array<int>")
    def pack(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            out = []
            for own in batch:
                counts, chars = [], 0
                for n in own.tolist():
                    if counts and (chars == 0 or chars + n < target):
                        counts[-1] += 1
                    else:
                        counts.append(1)
                    chars = chars + n + 2 if chars + n < target else n + 2
                out.append(counts)
            yield pd.Series(out)

    return pack(lengths)


def pack_many_paragraphs(docs: DataFrame, target: int = TARGET) -> DataFrame:
    """(doc, part, text): the same parts as pack_paragraphs, by greedy_pack on the lengths alone."""
    cut = docs.withColumn("_ps", F.split("text", "\n\n", -1)).withColumn("_n", greedy_pack(F.transform("_ps", lambda p: F.length(p)), target))
    parts = F.zip_with("_n", prefix_sums(F.transform("_n", lambda n: n.cast("long"))), lambda n, end: strip(F.array_join(F.slice("_ps", (end - n + 1).cast("int"), n), "\n\n")))
    return cut.select(*[c for c in docs.columns if c != "text"], F.posexplode(parts).alias("part", "text"))


def page_range(body: Column, pages: Column) -> Column:
    """The pages (an array of page, id, text in order) that hold a chunk's first or last 100 characters, else the first."""
    holds = lambda p: F.contains(p["text"], F.left(body, F.lit(100))) | F.contains(p["text"], F.right(body, F.lit(100)))
    found = F.transform(F.filter(pages, holds), lambda p: p["page"])
    return let(found, lambda f: F.when(F.size(f) > 0, f).otherwise(F.array(F.get(pages, 0)["page"])))


def semantic_chunks(pages: DataFrame, target: int = TARGET, shortest: int = SHORTEST, longest: int = LONGEST, terms: list[str] | None = None) -> DataFrame:
    """Chunks of whole documents from pages (id, doc, page, text).

    The text is stripped; counts, topic, keywords and page range are those of
    the part before stripping. ``chunk_no`` counts the doc's kept chunks. A doc is
    one row from its pages to its chunks, so texts are shuffled once, by doc.
    """
    ordered = F.array_sort(F.collect_list(F.struct("page", "id", "text")))
    docs = pages.groupBy("doc").agg(ordered.alias("pages")).select("doc", "pages", F.array_join(F.transform("pages", lambda x: x["text"]), "\n\n").alias("text"))
    packed = lambda s: F.when(F.length(s) > longest, pack_paragraphs(s, target)).otherwise(F.array(s))
    docs, own = _sections(docs, shortest)
    bodies = F.flatten(F.transform(own, lambda s: F.filter(packed(s), lambda b: F.length(b) >= shortest)))
    found = docs.select("doc", "pages", bodies.alias("bodies"))  # docs without chunks go with the explosion; a filter would pack them twice
    ranged = F.transform("bodies", lambda b: F.struct(b.alias("body"), page_range(b, F.col("pages")).alias("page_range")))
    rows = found.select("doc", F.transform("pages", lambda x: x["id"]).alias("source_pages"), F.posexplode(ranged).alias("at", "chunk"))
    body, number = F.col("chunk.body"), F.col("at") + 1
    return rows.select(
        F.format_string("%s-chunk%03d", "doc", number).alias("id"), strip(body).alias("text"), "doc", number.alias("chunk_no"), "chunk.page_range", extract_topic(body, F.col("doc")).alias("topic"),
        F.length(body).alias("char_count"), count_sentences(body).alias("sentence_count"), extract_keywords(body, terms).alias("keywords"), "source_pages",
    )


def chunk_stats(chunks: DataFrame) -> DataFrame:
    """Totals over chunks (doc, char_count); lengths are null where there is none."""
    n = F.col("char_count")
    return chunks.agg(F.count(F.lit(1)).alias("chunks"), F.coalesce(F.sum(n), F.lit(0)).alias("chars"), F.avg(n).alias("avg_chars"), F.min(n).alias("min_chars"), F.max(n).alias("max_chars"), F.countDistinct("doc").alias("documents"))


def chunks_per_document(chunks: DataFrame, pages: DataFrame) -> DataFrame:
    """Chunks of every doc, 0 for docs without any."""
    counts = chunks.groupBy("doc").agg(F.count(F.lit(1)).alias("n"))
    return pages.select("doc").distinct().join(counts, "doc", "left").select("doc", F.coalesce("n", F.lit(0)).alias("chunks"))
