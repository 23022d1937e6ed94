"""Training records: ChatML and Alpaca."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.io import write_jsonl

# Texts of the training records.
SYSTEM = "You are an agricultural expert with extensive knowledge about farming, crop production, soil management, and agricultural practices. Provide accurate, detailed, and helpful answers to questions about agriculture."
CONTEXT_SYSTEM = "You are an agricultural expert. Answer questions based on the provided context."
CONTEXT_QUESTION = "[Add your question here]"
CONTEXT_ANSWER = "[Add your answer here - requires annotation]"
ALPACA_INSTRUCTION = "Answer the following agricultural question based on the context."
ALPACA_QUESTION = "[Add question]"
ALPACA_ANSWER = "[Add answer - requires annotation]"
CONTEXT_CHARS = 3000


def _messages(system: Column, user: Column, assistant: Column) -> Column:
    turns = (("system", system), ("user", user), ("assistant", assistant))
    return F.array(*[F.struct(F.lit(role).alias("role"), content.alias("content")) for role, content in turns]).alias("messages")


def to_chatml(qa: DataFrame, system: str = SYSTEM) -> DataFrame:
    """(question, answer) as system, user and assistant messages; other columns stay."""
    keep = [c for c in qa.columns if c not in ("question", "answer")]
    return qa.select(*keep, _messages(F.lit(system), F.col("question"), F.col("answer")))


def to_chatml_context(pages: DataFrame) -> DataFrame:
    """Pages (doc, page, source, text) as templates with the start of their text in the question."""
    user = F.concat(F.lit("Context from "), F.col("source"), F.lit(" (page "), F.col("page").cast("string"), F.lit("):\n\n"), F.substring("text", 1, CONTEXT_CHARS), F.lit(f"\n\n{CONTEXT_QUESTION}"))
    return pages.select("doc", "page", _messages(F.lit(CONTEXT_SYSTEM), user, F.lit(CONTEXT_ANSWER)))


def to_alpaca(pages: DataFrame) -> DataFrame:
    """Pages as instruction, input and output."""
    body = F.concat(F.lit("Context: "), F.substring("text", 1, CONTEXT_CHARS), F.lit(f"\n\nQuestion: {ALPACA_QUESTION}"))
    return pages.select("doc", "page", F.lit(ALPACA_INSTRUCTION).alias("instruction"), body.alias("input"), F.lit(ALPACA_ANSWER).alias("output"))


def as_json(records: DataFrame, *columns: str) -> DataFrame:
    """Adds the record's JSON text with null fields kept."""
    return records.withColumn("json", F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}))


def training_files(qa: DataFrame, path: str, system: str = SYSTEM, compression: str = "none") -> None:
    """Writes pairs (question, answer) as ChatML records, one a line, in place of what path held."""
    write_jsonl(to_chatml(qa.select("question", "answer"), system), path, "overwrite", compression)
