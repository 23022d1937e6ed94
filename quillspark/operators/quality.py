"""Heuristic checks, scores and the accept/reject split of question-answer pairs."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import let, normalize_question, significant_words, strip

# Bounds of lengths, and forms of vague questions and simple answers (any case).
QUESTION_LENGTH, ANSWER_LENGTH = (10, 300), (20, 1000)
VAGUE = (r"(?iu)^What is [^\n]{1,15}\?\z", r"(?iu)^(Yes|No)\.?\z", r"(?iu)^(True|False)\.?\z")
SIMPLE_LENGTH = 30
GROUNDED_WORDS = 3
ORDER = ["chunk_ord", "pair_idx"]
#: Pairs of a chunk that are looked at together, and as many of them as the words in common are cut down to once more.
LOT, FEW = 64, 8


def first_occurrences(qa: DataFrame) -> DataFrame:
    """(chunk_id, batch_id, chunk_ord, pair_idx) of the first row of each normalised question of a batch.

    Found by a window that Spark cuts to one row a key before it shuffles, so a
    question that a third of all rows share does no harm; no answer is read.
    """
    keyed = qa.select("chunk_id", "batch_id", *ORDER, normalize_question(F.col("question")).alias("_q"))
    return keyed.withColumn("_n", F.row_number().over(Window.partitionBy("batch_id", "_q").orderBy(*ORDER))).filter("_n = 1").select("chunk_id", "batch_id", *ORDER)


def flag_duplicates(qa: DataFrame) -> DataFrame:
    """qa (batch_id, chunk_ord, pair_idx, question) with ``duplicate``: a later row of the batch with the same normalised question.

    The rows that are not a first occurrence are those without a partner by their own unique place.
    """
    first = first_occurrences(qa).select("batch_id", *ORDER, F.lit(False).alias("_later"))
    return qa.join(first, ["batch_id", *ORDER], "left").withColumn("duplicate", F.coalesce("_later", F.lit(True))).drop("_later")


def _lot(place: str = "chunk_id") -> Column:
    """Part of its chunk that a pair is looked at with; pairs without a chunk are dealt out."""
    return F.floor(F.col("pair_idx") / LOT) + F.when(F.col(place).isNull(), F.pmod(F.xxhash64(*ORDER), F.lit(4096)) * (1 << 32)).otherwise(0)


def _overlaps(words: Column, words_of: Column) -> Column:
    """For each array of words how many of them are in words_of.

    A set is built of one side of each intersection, so the words that all arrays share with
    words_of come first, then those of ``FEW`` arrays. Each is bound by ``let``: a column of
    that name would be put into the function of an array, and worked out once an array.
    """
    shared = lambda arrays, within: F.array_intersect(F.array_distinct(F.flatten(arrays)), within)
    of_few = lambda few, within: let(shared(few, within), lambda c: F.transform(few, lambda w: F.size(F.array_intersect(w, c))))
    firsts = lambda ws: F.sequence(F.lit(1), F.greatest(F.size(ws), F.lit(1)), F.lit(FEW))
    return let(words, lambda ws: let(shared(ws, words_of), lambda c: F.flatten(F.transform(firsts(ws), lambda k: let(F.slice(ws, k, FEW), lambda few: of_few(few, c))))))


def _beside_sources(qa: DataFrame, sources: DataFrame, firsts: DataFrame | None = None) -> DataFrame:
    """qa with ``overlap``, and with ``duplicate`` if the places of first occurrences (chunk_id, batch_id, ORDER) are given.

    A chunk's pairs, the places and its text meet in one shuffle, by chunk and up to
    ``LOT`` pairs at a time; each text is searched for words once, before it is dealt to its
    lots, a chunk's words are held against those of all a lot's answers, and each answer's
    against the few that are left.
    """
    place = F.struct("batch_id", *ORDER)
    pairs = qa.select("chunk_id", _lot().alias("lot"), F.struct(*qa.columns).alias("pair"))
    # a text's words are one string on their way, which is shorter than the text and than an array of them
    texts = sources.select("chunk_id", F.array_join(significant_words(F.coalesce("text", F.lit(""))), " ").alias("words_of"))
    more = qa.filter(F.col("pair_idx") >= LOT).filter("chunk_id is not null").groupBy("chunk_id").agg(F.collect_set(_lot()).alias("more"))
    lots = F.concat(F.array(F.lit(0).cast("long")), F.coalesce("more", F.expr("cast(array() as array<bigint>)")))
    texts = texts.join(more, "chunk_id", "left").select("chunk_id", F.explode(lots).alias("lot"), "words_of")
    rows = pairs.unionByName(texts, True)
    if firsts is not None:
        rows = rows.unionByName(firsts.select("chunk_id", _lot().alias("lot"), place.alias("first")), True)
    met = rows.groupBy("chunk_id", "lot").agg(F.collect_list("pair").alias("pairs"), F.max("words_of").alias("words_of"), *([F.collect_list("first").alias("firsts")] if firsts is not None else []))
    # all below the explosion: in one select with it, Spark would look for words anew for each pair; a pair takes a number along, no words
    words = F.transform("pairs", lambda p: significant_words(F.coalesce(p["answer"], F.lit(""))))
    counted = met.filter(F.size("pairs") > 0).withColumn("_overlaps", _overlaps(words, F.split(F.coalesce("words_of", F.lit("")), " ")))
    out = counted.select(*met.columns[4:], F.inline(F.arrays_zip(F.col("pairs").alias("pair"), F.col("_overlaps").alias("overlap")))).select(*met.columns[4:], "pair.*", "overlap")
    if firsts is not None:
        out = out.withColumn("duplicate", ~F.array_contains("firsts", place))
    return out.drop("firsts")


def with_overlap(qa: DataFrame, sources: DataFrame) -> DataFrame:
    """qa with ``overlap``: significant words that the answer shares with its chunk (chunk_id, text; one row a chunk), 0 without a chunk."""
    return _beside_sources(qa, sources)


def _starts(text: Column, *heads: str) -> Column:
    return reduce(Column.__or__, [F.startswith(text, F.lit(h)) for h in heads])


def heuristic_issues() -> Column:
    """The ordered issues of a row (question, answer, their stripped forms _q and _a, duplicate, overlap)."""
    q, a, sq, sa = F.col("question"), F.col("answer"), F.col("_q"), F.col("_a")
    nq, na = F.length(q), F.length(a)
    tests: list[tuple[Column, str | Column]] = [
        (nq < QUESTION_LENGTH[0], F.format_string("Question too short (%d chars)", nq)),
        (nq > QUESTION_LENGTH[1], F.format_string("Question too long (%d chars)", nq)),
        (na < ANSWER_LENGTH[0], F.format_string("Answer too short (%d chars)", na)),
        (na > ANSWER_LENGTH[1], F.format_string("Answer too long (%d chars)", na)),
        (~F.endswith(sq, F.lit("?")), "Question doesn't end with '?'"),
        (_starts(sq, "Answer:", "Q:", "A:"), "Question has formatting artifacts"),
        (_starts(sa, "Question:", "Q:", "A:"), "Answer has formatting artifacts"),
        (F.lower(q) == F.lower(a), "Question and answer are identical"),
    ]
    for form in VAGUE:
        # none of these forms is longer than a line of 30 characters
        tests += [((F.length(sq) <= SIMPLE_LENGTH) & sq.rlike(form), "Question appears too vague"), ((F.length(sa) <= SIMPLE_LENGTH) & sa.rlike(form), "Answer appears too simple")]
    tests += [
        (F.contains(q, F.lit("...")) | F.contains(q, F.lit("[")) | F.contains(q, F.lit("___")), "Question appears incomplete"),
        (F.contains(a, F.lit("...")) | F.contains(a, F.lit("[TBD]")) | F.contains(a, F.lit("[TODO]")), "Answer appears incomplete"),
        (F.col("duplicate"), "Duplicate or very similar question"),
        (F.col("overlap") < GROUNDED_WORDS, "Answer may not be grounded in source text"),
    ]
    return F.filter(F.array(*[F.when(test, issue if isinstance(issue, Column) else F.lit(issue)) for test, issue in tests]), lambda x: x.isNotNull())


def _score(value: Column) -> Column:
    return F.greatest(F.lit(0.0), F.least(F.lit(10.0), value))


def score_quality(rows: DataFrame) -> DataFrame:
    """Adds the five scores, their mean, and the recommendation to rows with ``issues``."""
    q, na, n = F.lower("question"), F.length("answer"), F.size("issues")
    less = F.lit(8.0) - 0.5 * n
    complete = less - F.when(na < 50, 2.0).otherwise(0.0) - F.when(na > 500, 1.0).otherwise(0.0) + F.when(F.startswith(q, F.lit("why")) | F.contains(q, F.lit("explain")), 1.0).otherwise(0.0)
    specific = F.lit(8.0) + F.when(q.rlike("^(what|when|where|who)"), 1.0).otherwise(0.0)
    scored = rows.withColumns({"accuracy": _score(less), "clarity": _score(less), "completeness": _score(complete), "relevance": F.lit(8.0), "specificity": _score(specific)})
    overall = (F.col("accuracy") + F.col("clarity") + F.col("completeness") + F.col("relevance") + F.col("specificity")) / 5
    choice = F.when((F.col("overall") >= 7.5) & (F.size("issues") == 0), "keep").when(F.col("overall") >= 6.0, F.when(F.size("issues") > 0, "revise").otherwise("keep")).otherwise("reject")
    return scored.withColumn("overall", overall).withColumn("recommendation", choice)


def score_with(rows: DataFrame, score: Callable[[str, str], float], keep_at: float = 6.0) -> DataFrame:
    """Rows with an overall score by any function of question and answer in place of score_quality, and the recommendation; a score is held within 0 and 10."""

    @F.pandas_udf("double")
    def run(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for questions, answers in batches:
            yield pd.Series([float(score(q or "", a or "")) for q, a in zip(questions, answers)]).clip(0.0, 10.0)

    scored = rows.withColumn("overall", run("question", "answer"))
    issues = F.size("issues") if "issues" in rows.columns else F.lit(0)
    return scored.withColumn("recommendation", F.when(F.col("overall") < keep_at, "reject").when(issues > 0, "revise").otherwise("keep"))


def validated(qa: DataFrame, sources: DataFrame, scorer: Callable[[DataFrame], DataFrame] = score_quality) -> DataFrame:
    """All checks and scores of qa (chunk_id, batch_id, chunk_ord, pair_idx, question, answer, ...); null texts count as empty.

    Answers are shuffled once, to their sources. ``scorer`` scores rows with ``issues``.
    """
    filled = qa.withColumns({c: F.coalesce(c, F.lit("")) for c in ("question", "answer")})
    checked = _beside_sources(filled, sources, first_occurrences(filled)).withColumns({"_q": strip(F.col("question")), "_a": strip(F.col("answer"))})
    return scorer(checked.withColumn("issues", heuristic_issues()).drop("_q", "_a"))


SCORES = ["accuracy", "clarity", "completeness", "relevance", "specificity", "overall", "issues", "recommendation"]


def filter_batch(scored: DataFrame, min_overall: float = 6.0) -> tuple[DataFrame, DataFrame]:
    """Accepted and rejected rows, with all scores as quality_score.

    A row is held against the bounds as an array of one: a filter on scored rows would be
    put below the scores, with all tests of the issues written out for each score it needs.
    """
    packed = scored.withColumn("quality_score", F.struct(*SCORES)).drop(*SCORES)
    accepted = lambda r: (r["quality_score"]["recommendation"] == "keep") & (r["quality_score"]["overall"] >= min_overall)
    those = lambda test: packed.select(F.inline(F.filter(F.array(F.struct(*packed.columns)), test)))
    return those(accepted), those(lambda r: ~accepted(r))


def batch_run_stats(scored: DataFrame, plan: DataFrame, min_overall: float = 6.0) -> DataFrame:
    """Per planned batch: chunks, pairs generated, kept and rejected, and the rates in per cent."""
    kept = F.count_if((F.col("recommendation") == "keep") & (F.col("overall") >= min_overall))
    made = scored.groupBy("batch_id").agg(F.countDistinct("chunk_id").alias("processed"), F.count(F.lit(1)).alias("made"), kept.alias("kept"))
    zero = F.lit(0)
    made_n, kept_n = F.coalesce("made", zero), F.coalesce("kept", zero)
    return plan.join(made, "batch_id", "left").select(
        "batch_id", F.col("chunks").alias("chunks_total"), F.coalesce("processed", zero).alias("chunks_processed"), made_n.alias("qa_generated"), kept_n.alias("qa_filtered"), (made_n - kept_n).alias("qa_rejected"),
        F.when(made_n > 0, F.bround(kept_n / made_n * 100, 1)).otherwise(0.0).alias("filter_rate"), F.bround(kept_n / F.col("target_qa_count") * 100, 1).alias("completion_rate"),
    )
