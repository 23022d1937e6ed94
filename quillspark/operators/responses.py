"""Generator hook, response parsing and classification."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import strip

PAIR = "struct<question:string,answer:string,difficulty:string,type:string>"


def generate(prompts: DataFrame, answer: Callable[[str], str], concurrency: int | None = None) -> DataFrame:
    """(chunk_id, batch_id, response, error) from prompts (chunk_id, batch_id, prompt) by any function of a prompt.

    The number of partitions is the number of calls at a time. A call that fails
    leaves its error and no response; the job goes on, and the chunk stays pending.
    """

    def call(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            replies, errors = [], []
            for prompt in batch["prompt"]:
                try:
                    replies.append(answer(prompt))
                    errors.append(None)
                except Exception as error:  # noqa: BLE001 - whatever a service raises is data here
                    replies.append(None)
                    errors.append(f"{type(error).__name__}: {error}")
            yield pd.DataFrame({"chunk_id": batch["chunk_id"], "batch_id": batch["batch_id"], "response": replies, "error": errors})

    rows = prompts.select("chunk_id", "batch_id", "prompt")
    # ids pass as text: beside a null, pandas would round a long
    ids = [(c, t) for c, t in rows.dtypes[:2]]
    sent = rows.select(*[F.col(c).cast("string").alias(c) for c, _ in ids], "prompt")
    told = (sent.repartition(concurrency) if concurrency else sent).mapInPandas(call, "chunk_id string, batch_id string, response string, error string")
    return told.select(*[F.col(c).cast(t).alias(c) for c, t in ids], "response", "error")


def extract_pages(files: DataFrame, extract: Callable[[str, bytes], list[str]]) -> DataFrame:
    """Page rows (path, page, total_pages, text) from binary files (path, content) by any function that gives a file's page texts."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"]):
                pages = extract(path, content)
                yield pd.DataFrame({"path": path, "page": range(1, len(pages) + 1), "total_pages": len(pages), "text": pages})

    return files.select("path", "content").mapInPandas(run, "path string, page int, total_pages int, text string")


def cleaned(response: Column) -> Column:
    """A response without code fences and outer white space."""
    text = strip(F.coalesce(response, F.lit("")))
    text = F.when(F.startswith(text, F.lit("```json")), F.substr(text, F.lit(8))).otherwise(text)
    text = F.when(F.startswith(text, F.lit("```")), F.substr(text, F.lit(4))).otherwise(text)
    text = F.when(F.endswith(text, F.lit("```")), F.left(text, F.length(text) - 3)).otherwise(text)
    return strip(text)


def _pairs(text: Column) -> Column:
    """The pairs of a cleaned response, null unless it is an array of objects."""
    whole = text.rlike(r"(?s)^\[.*\]\z") & F.try_parse_json(text).isNotNull()
    return F.when(whole, F.from_json(text, f"array<{PAIR}>"))


def parse_responses(responses: DataFrame) -> DataFrame:
    """Pairs of (chunk_id, batch_id, response), numbered in their response; other responses give none. Numbers become strings."""
    rows = responses.withColumn("_text", cleaned(F.col("response"))).select("chunk_id", "batch_id", F.posexplode(_pairs(F.col("_text"))).alias("at", "qa"))
    return rows.select("chunk_id", "batch_id", (F.col("at") + 1).alias("pair_idx"), "qa.question", "qa.answer", "qa.difficulty", "qa.type")


def response_status(responses: DataFrame) -> DataFrame:
    """responses with status: ok, empty, not_array or malformed."""
    text = F.col("_text")
    valid = F.try_parse_json(text).isNotNull()
    status = F.when(text == "", "empty").when(_pairs(text).isNotNull(), "ok").when(valid & ~F.startswith(text, F.lit("[")), "not_array").otherwise("malformed")
    return responses.withColumn("_text", cleaned(F.col("response"))).withColumn("status", status).drop("_text")


def status_counts(responses: DataFrame) -> DataFrame:
    """Responses by status."""
    return response_status(responses).groupBy("status").agg(F.count(F.lit(1)).alias("responses"))
