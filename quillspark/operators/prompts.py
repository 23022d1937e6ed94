"""Prompts for the generator from chunks and their batch's plan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TYPES = ("factual", "conceptual", "procedural", "comparative", "scenario", "analytical")

# The templates. Double braces stand for single ones.
BATCH_TEMPLATE = """You are an expert agricultural educator creating diverse training questions from agricultural textbooks.

Text:
{text}

Topic: {topic}
Keywords: {keywords}

Generate {total_questions} high-quality question-answer pairs with the following distribution:
- {factual_count} Factual questions (What, When, Where, Define)
- {conceptual_count} Conceptual questions (Why, How does, Explain)
- {procedural_count} Procedural questions (How to, Steps)
- {comparative_count} Comparative questions (Compare, Difference)
- {scenario_count} Scenario-based questions (Application, What if)
- {analytical_count} Analytical questions (Evaluate, Assess)

Requirements:
1. All questions must be answerable from the provided text
2. Answers should be comprehensive but concise (2-5 sentences)
3. Use proper agricultural terminology
4. Vary complexity: 30% basic, 50% intermediate, 20% advanced
5. Ensure factual accuracy
6. Make questions practical and relevant

Output ONLY valid JSON array format:
[
  {{"question": "...", "answer": "...", "difficulty": "basic|intermediate|advanced", "type": "factual|conceptual|procedural|comparative|scenario|analytical"}},
  ...
]

Generate exactly {total_questions} question-answer pairs:"""

#: One short template a type; a table of one's own (type, template) with {n} and {text} may be given instead.
TYPE_TEMPLATES = {
    "factual": "Write {n} FACTUAL questions on the text below: what, when, where, who, which, or a definition. Each answer has 1-3 sentences.",
    "conceptual": "Write {n} CONCEPTUAL questions on the text below: why and how things work. Each answer explains the concept in 2-4 sentences.",
    "procedural": "Write {n} PROCEDURAL questions on the text below: how a task is done, step by step. Each answer has 3-5 sentences.",
    "comparative": "Write {n} COMPARATIVE questions on the text below: differences, similarities and trade-offs. Each answer has 2-4 sentences.",
    "scenario": "Write {n} SCENARIO questions on the text below: a situation, and what to do in it. Each answer gives reasons in 3-5 sentences.",
    "analytical": "Write {n} ANALYTICAL questions on the text below: evaluate, assess, decide. Each answer weighs several factors in 3-5 sentences.",
}
TYPE_TAIL = '\n\nText:\n{text}\n\nOutput format (JSON):\n[{{"question": "...", "answer": "...", "difficulty": "basic|intermediate|advanced", "type": "..."}}]\n\nGenerate exactly {n} question-answer pairs:'


def filled(template: str, values: dict[str, Column]) -> Column:
    """A template with its fields put in; text that looks like a field inside a value is left alone."""
    import string

    return F.concat(*[x for literal, field, _, _ in string.Formatter().parse(template) for x in ([F.lit(literal)] if literal else []) + ([values[field]] if field else [])])


def build_prompts(planned: DataFrame, template: str = BATCH_TEMPLATE) -> DataFrame:
    """(chunk_id, batch_id, prompt) from chunks joined with their plan (id, text, topic, keywords, qa_per_chunk, a column a type)."""
    values = {"text": F.col("text"), "topic": F.col("topic"), "keywords": F.array_join("keywords", ", "), "total_questions": F.col("qa_per_chunk").cast("string")}
    values |= {f"{t}_count": F.col(t).cast("string") for t in TYPES}
    return planned.select(F.col("id").alias("chunk_id"), "batch_id", filled(template, values).alias("prompt"))


def build_type_prompts(chunks: DataFrame, n: int, templates: dict[str, str] | None = None) -> DataFrame:
    """(chunk_id, type, prompt): one prompt for each chunk (id, text) and type; no row is joined, each is unfolded in place."""
    templates = templates or {k: v + TYPE_TAIL for k, v in TYPE_TEMPLATES.items()}
    made = F.array(*[F.struct(F.lit(k).alias("type"), filled(t, {"n": F.lit(str(n)), "text": F.col("text")}).alias("prompt")) for k, t in templates.items()])
    return chunks.select(F.col("id").alias("chunk_id"), F.inline(made))
