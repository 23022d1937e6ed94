"""Hand-written rows for plans, responses, checks and usage."""

from __future__ import annotations

import json
import time

import pytest
from pyspark.sql import functions as F

from quillspark.operators import merge as M
from quillspark.operators import plan as L
from quillspark.operators import prompts as T
from quillspark.operators import quality as Q
from quillspark.operators import responses as R
from quillspark.operators import usage as U

QA = "chunk_id long, batch_id int, chunk_ord long, pair_idx int, question string, answer string"
GOOD = "The answer speaks about maize nitrogen fields and harvest in full length."


def issues(spark, question, answer, source=GOOD):
    qa = spark.createDataFrame([(1, 1, 1, 1, question, answer)], QA)
    row = Q.validated(qa, spark.createDataFrame([(1, source)], "chunk_id long, text string")).first()
    return row


@pytest.mark.parametrize(
    ("question", "answer", "want"),
    [
        ("Why does it grow?", GOOD, []),
        ("Why now?", GOOD, ["Question too short (8 chars)"]),
        ("Why " + "x" * 300 + "?", GOOD, ["Question too long (305 chars)"]),
        ("How do the crops grow", GOOD, ["Question doesn't end with '?'"]),
        ("Q: how do they grow?", GOOD, ["Question has formatting artifacts"]),
        ("How do the crops grow?", "A: " + GOOD, ["Answer has formatting artifacts"]),
        ("what is IT now? ", GOOD, ["Question appears too vague"]),
        ("What is [x] about them all?", GOOD, ["Question appears incomplete"]),
        ("How do the crops grow?", GOOD + " [TODO]", ["Answer appears incomplete"]),
        ("How do the crops grow?", "yes.", ["Answer too short (4 chars)", "Answer appears too simple", "Answer may not be grounded in source text"]),
        (None, None, ["Question too short (0 chars)", "Answer too short (0 chars)", "Question doesn't end with '?'", "Question and answer are identical", "Answer may not be grounded in source text"]),
    ],
)
def test_rules(spark, question, answer, want):
    assert issues(spark, question, answer).issues == want


def test_scores(spark):
    row = issues(spark, "Explain why it grows?", GOOD)
    assert (row.accuracy, row.completeness, row.specificity, row.recommendation) == (8.0, 9.0, 8.0, "keep")
    assert issues(spark, "whatever does it grow?", GOOD).specificity == 9.0
    for n, want in ((49, 6.0), (50, 8.0), (500, 8.0), (501, 7.0)):
        assert issues(spark, "How do the crops grow?", ("maize nitrogen harvest " + "x " * 300)[:n], "maize nitrogen harvest").completeness == want, n
    assert issues(spark, "How do the crops grow", GOOD).recommendation == "revise"


def test_first_counts_even_if_rejected(spark):
    qa = spark.createDataFrame([(1, 1, 1, 1, "Q: same", "no"), (2, 1, 2, 1, "q  SAME", GOOD), (3, 2, 3, 1, "q same", GOOD)], QA)
    assert {r.chunk_id: r.duplicate for r in Q.flag_duplicates(qa).collect()} == {1: False, 2: True, 3: False}
    first = M.keep_first(qa)
    assert {r.chunk_id for r in M.keep_first(first).collect()} == {r.chunk_id for r in first.collect()}


def test_accepted_and_rejected_are_all(spark):
    qa = spark.createDataFrame([(i, 1, i, 1, f"How do crops grow {i}?" if i % 2 else "x", GOOD) for i in range(10)], QA)
    scored = Q.validated(qa, spark.createDataFrame([(i, GOOD) for i in range(8)], "chunk_id long, text string"))
    accepted, rejected = Q.filter_batch(scored)
    assert accepted.count() + rejected.count() == 10 and {r.chunk_id for r in accepted.collect()} == {1, 3, 5, 7}


@pytest.mark.parametrize(("n", "sizes"), [(10, [2, 2, 2, 2, 2]), (11, [2, 2, 2, 2, 3]), (14, [2, 2, 2, 2, 6])])
def test_batches(spark, n, sizes):
    chunks = spark.createDataFrame([(f"d{i % 3}", i) for i in range(n)], "doc string, chunk_no int")
    batched = L.contiguous_batches(chunks)
    rows = sorted(batched.collect(), key=lambda r: (r.doc, r.chunk_no))
    assert [r["rank"] for r in rows] == list(range(n))
    plan = L.batch_plan(batched, 100, 5).orderBy("batch_id").collect()
    assert [r.chunks for r in plan] == sizes and all(sum(r[t] for t in T.TYPES) == r.qa_per_chunk for r in plan)


def test_too_few_chunks(spark):
    with pytest.raises(ValueError, match="cannot fill"):
        L.contiguous_batches(spark.createDataFrame([("d", 1)], "doc string, chunk_no int"))


def test_no_single_partition_sort(spark):
    chunks = spark.range(100).selectExpr("concat('d', id % 7) doc", "cast(id as int) chunk_no")
    plan = L.contiguous_batches(chunks)._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan


def test_responses(spark):
    pair = {"question": "q", "answer": "a", "difficulty": "basic", "type": "factual"}
    good = json.dumps([pair])
    texts = [f"```json\n{good}\n```", f"```{good}```", f"  {good} ", "", None, "[]", json.dumps(pair), "[1,2]", f"[{json.dumps(pair)}, 5]", f"{good} trailing", good[:-4], "prose", '[{"question": 1.5}]']
    rows = spark.createDataFrame(list(enumerate(texts)), "chunk_id int, response string").withColumn("batch_id", F.lit(1))
    status = {r.chunk_id: r.status for r in R.response_status(rows).collect()}
    assert [status[i] for i in range(len(texts))] == ["ok", "ok", "ok", "empty", "empty", "ok", "not_array", "malformed", "malformed", "malformed", "malformed", "malformed", "ok"]
    got = sorted((r.chunk_id, r.pair_idx, r.question) for r in R.parse_responses(rows).collect())
    assert got == [(0, 1, "q"), (1, 1, "q"), (2, 1, "q"), (12, 1, "1.5")]


def test_hook_keeps_errors(spark):
    def answer(prompt):
        raise RuntimeError("no") if prompt == "b" else None

    rows = R.generate(spark.createDataFrame([(1, 1, "a"), (2, 1, "b")], "chunk_id long, batch_id int, prompt string"), lambda p: p + "!" if p == "a" else answer(p), 2)
    assert {r.chunk_id: (r.response, r.error) for r in rows.collect()} == {1: ("a!", None), 2: (None, "RuntimeError: no")}


def test_ids_beside_nulls_stay_whole(spark):
    rows = R.generate(spark.createDataFrame([(2**53 + 1, 1, "a"), (None, None, "b"), (2**53 + 3, 2, "c")], "chunk_id long, batch_id int, prompt string"), str.upper, 1)
    assert rows.dtypes[:2] == [("chunk_id", "bigint"), ("batch_id", "int")]
    assert {(r.chunk_id, r.batch_id, r.response) for r in rows.collect()} == {(2**53 + 1, 1, "A"), (None, None, "B"), (2**53 + 3, 2, "C")}


def test_prompt_fields(spark):
    values = spark.createDataFrame([("id", 1, "text {n}", "t", ["a", "b"], 3, 1, 1, 1, 0, 0, 0)], "id string, batch_id int, text string, topic string, keywords array<string>, qa_per_chunk int, " + ", ".join(f"{t} int" for t in T.TYPES))
    prompt = T.build_prompts(values).first().prompt
    assert "text {n}" in prompt and '{"question": "..."' in prompt and "Keywords: a, b" in prompt and "- 1 Factual" in prompt
    assert T.build_type_prompts(values, 2).count() == 6


def test_usage(spark):
    schema = "event_id long, api_key string, us long, failed boolean, prompt_words int, response_words int"
    none = U.usage_stats(spark.createDataFrame([], schema)).first()
    assert (none.total_requests, none.input_tokens, none.success_rate, none.estimated_cost_usd) == (0, 0, 0.0, 0.0)
    rows = spark.createDataFrame([(1, "k", 0, True, 100, 100), (2, "k", 59_999_999, False, 3, 7), (3, "k", 60_000_000, False, 1, 1)], schema)
    got = U.usage_stats(rows).first()
    assert (got.input_tokens, got.output_tokens, got.success_rate) == (4, 10, 66.7)
    assert {r.event_id: (r.earlier, r.limited) for r in U.request_limit(rows, 1).collect()} == {1: (0, False), 2: (1, True), 3: (1, True)}


def test_many_calls_in_a_minute(spark):
    """One key, 120,000 calls in three minutes, many at the same moment: a window is passed once, and counts are those of a plain search."""
    from bisect import bisect_left, bisect_right

    calls = spark.range(120_000).selectExpr("id event_id", "'k' api_key", "(id * 7919 % 120000) div 3 * 4500 us").cache()
    calls.count()
    began = time.perf_counter()
    got = {r.event_id: r.earlier for r in U.request_limit(calls).collect()}
    assert time.perf_counter() - began < 20
    at = sorted(r.us for r in calls.collect())
    assert got == {r.event_id: bisect_right(at, r.us) - bisect_left(at, r.us - 59_999_999) - 1 for r in calls.collect()}
    calls.unpersist()


def test_calls_without_a_time(spark):
    rows = spark.createDataFrame([(1, "k", None), (2, "k", None), (3, "k", 5), (4, None, 5), (5, None, 6)], "event_id long, api_key string, us long")
    assert {r.event_id: (r.earlier, r.limited) for r in U.request_limit(rows, 1).collect()} == {1: (1, True), 2: (1, True), 3: (0, False), 4: (0, False), 5: (1, True)}


def test_first_seen_within_watermark(spark, tmp_path):
    from quillspark.streaming import monitor as S

    rows = spark.createDataFrame([(1, 1, i, "Same?", True) for i in range(4)], "batch_id int, chunk_id long, pair_idx int, question string, accepted boolean").withColumn("ts", F.timestamp_seconds(F.lit(1_704_067_200)))
    rows.write.json(str(tmp_path / "in"))
    assert S.run_to(S.first_seen(S.read_growing(spark, str(tmp_path / "in")), "1 hour"), "append").count() == 1
