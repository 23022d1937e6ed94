"""The flow as one job: pages, chunks, plan, prompts, generator, pairs, checks, batch folders, merged set, training files."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import stamp
from ..operators import chunks as C
from ..operators import export as E
from ..operators import merge as M
from ..operators import plan as L
from ..operators import prompts as T
from ..operators import quality as Q
from ..operators import responses as R
from ..sources import io as S
from ..sources.shared import brief_shuffles, drop, written

RESPONSE = "chunk_id string, batch_id int, response string, error string, generated_at string"
FILTERED = "chunk_id string, chunk_ord long, pair_idx int, question string, answer string, difficulty string, type string, batch_id int"
STARTS = ("What is", "Why does", "How do you", "Compare", "If", "Evaluate")
LEVELS = ("basic", "intermediate", "advanced")
#: Of all JSON lines below ``out``: as plain text they would be some thirty times the input.
PACKED = "gzip"


def extractive(prompt: str) -> str:
    """A generator without a model: a question on each sentence of the prompt's text, answered by that and the next sentence."""
    sentences = prompt.partition("\n\nText:\n")[2].rpartition("\n\nTopic: ")[0].split(". ")
    pairs = [
        {"question": f"{STARTS[k % 6]} {' '.join(own.split(' ')[:6]).lower()}?", "answer": f"{own}. {after}.", "difficulty": LEVELS[k % 3], "type": T.TYPES[k % 6]}
        for k, (own, after) in enumerate(zip(sentences, [*sentences[1:], ""]))
    ]
    return json.dumps(pairs, ensure_ascii=False)


def run(pages: DataFrame, out: str, answer: Callable[[str], str] = extractive, total: int = 50_000, n_batches: int = 5, terms: list[str] | None = None, concurrency: int | None = None) -> DataFrame:
    """From pages (id, doc, page, text) to training files below ``out``; returns the merged set, as read from filtered/.

    ``out`` holds responses/ (what the generator said, with errors), raw/ and
    filtered/ (a folder a batch) and chatml/ (training records), all as compressed JSON
    lines. A rerun asks the generator only for chunks without a response that could be
    parsed, and replaces what follows from the responses, so it repeats and loses nothing.
    What a step leaves for the next one alone goes when that has stored its own.
    """
    with brief_shuffles(pages.sparkSession):
        return _run(pages, out, answer, total, n_batches, terms, concurrency)


def _run(pages: DataFrame, out: str, answer: Callable[[str], str], total: int, n_batches: int, terms: list[str] | None, concurrency: int | None) -> DataFrame:
    spark = pages.sparkSession
    chunks = written(C.semantic_chunks(pages, terms=terms), "chunks")
    batched = written(L.contiguous_batches(chunks, n_batches), "batched-chunks")
    drop(chunks)
    planned = L.plan_chunks(batched, L.batch_plan(batched, total, n_batches))
    prompts = T.build_prompts(planned)
    told = f"{out}/responses"
    if S.exists(spark, told):
        prompts = L.pending_chunks(prompts, written(R.parse_responses(S.read_jsonl(spark, told, RESPONSE)).select("chunk_id").distinct(), "answered"))
    S.write_jsonl(R.generate(prompts, answer, concurrency).withColumn("generated_at", stamp()), told, "append", PACKED)

    pairs = R.parse_responses(S.read_jsonl(spark, told, RESPONSE))
    pairs = written(pairs.join(batched.select(F.col("id").alias("chunk_id"), F.col("rank").alias("chunk_ord")), "chunk_id"), "pairs")
    scored = written(Q.validated(pairs, batched.select(F.col("id").alias("chunk_id"), "text")), "scored")
    drop(batched)
    drop(pairs)
    S.write_batches(scored, f"{out}/raw", PACKED)
    S.write_batches(Q.filter_batch(scored)[0], f"{out}/filtered", PACKED)
    drop(scored)
    merged = merged_set(S.read_batches(spark, f"{out}/filtered", FILTERED, list(range(1, n_batches + 1))))
    E.training_files(merged, f"{out}/chatml", compression=PACKED)
    return merged


def merged_set(filtered: DataFrame) -> DataFrame:
    """The rows of filtered pairs that ``keep_first`` keeps. Only their places are stored, a row a chunk: no answer is shuffled to find them, nor stored again."""
    place = ["batch_id", "chunk_ord"]
    first = M.keep_first(filtered.select(*M.ORDER, "question")).groupBy(*place).agg(F.collect_set("pair_idx").alias("_kept"))
    return filtered.join(written(first, "merged-places"), place).filter(F.array_contains("_kept", F.col("pair_idx"))).drop("_kept").select(*filtered.columns)
