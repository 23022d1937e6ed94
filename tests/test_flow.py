"""The flow as one job, and the plans of what it rests on."""

from __future__ import annotations

import json
import re
import time

from pyspark.sql import functions as F

from quillspark.functions.text import prefix_sums
from quillspark.jobs import fixtures, flow, qa_queries
from quillspark.operators import chunks as C
from quillspark.operators import merge as M
from quillspark.operators import quality as Q
from quillspark.operators import responses as R
from quillspark.sources import io as S
from quillspark.sources import shared

SMALL = "/root/testdata/sf0.001"


def test_a_rerun_asks_only_for_what_is_missing(spark, tmp_path):
    """A generator that fails on some chunks at first: the second run asks for these alone, and all is as if it had never failed."""
    out, log = str(tmp_path / "out"), tmp_path / "log"
    log.mkdir()
    pages = fixtures.fx_pages(spark, SMALL)

    def failing(prompt):
        if len(prompt) % 2:
            raise TimeoutError("busy")
        return flow.extractive(prompt)

    def counting(prompt):
        (log / str(time.time_ns())).write_text("")
        return flow.extractive(prompt)

    first = flow.run(pages, out, failing, terms=fixtures.TERMS).count()
    told = S.read_jsonl(spark, f"{out}/responses", flow.RESPONSE)
    errors = told.filter("error is not null").count()
    second = sorted((r.chunk_id, r.pair_idx, r.question) for r in flow.run(pages, out, counting, terms=fixtures.TERMS).collect())
    assert 0 < errors == len(list(log.iterdir())) and first < len(second)
    flow.run(pages, out, counting, terms=fixtures.TERMS)
    assert len(list(log.iterdir())) == errors
    whole = flow.run(pages, str(tmp_path / "whole"), terms=fixtures.TERMS)
    assert second == sorted((r.chunk_id, r.pair_idx, r.question) for r in whole.collect())
    lines = [json.loads(r.value) for r in spark.read.text(f"{out}/chatml").collect()]
    assert len(lines) == len(second) and all([m["role"] for m in x["messages"]] == ["system", "user", "assistant"] for x in lines)
    assert all(re.fullmatch(r"\d{4}-\d\d-\d\dT\d\d:\d\d:\d\dZ", r.generated_at) for r in told.limit(3).collect())


def test_the_flow_leaves_its_files_alone(spark, tmp_path):
    """JSON lines are compressed, what one step left for the next is gone, and so are shuffles."""
    shared.clear(spark)
    merged = flow.run(fixtures.fx_pages(spark, SMALL), str(tmp_path / "out"), terms=fixtures.TERMS)
    files = [f for f in (tmp_path / "out").rglob("part-*") if f.is_file()]
    assert {f.relative_to(tmp_path / "out").parts[0] for f in files} == {"responses", "raw", "filtered", "chatml"} and all(f.name.endswith(".json.gz") for f in files)
    left = {p.rsplit("/", 1)[-1].rsplit("-", 1)[0] for p in shared._given[spark.sparkContext.applicationId]}
    assert left == {"doc-ranges", "merged-places"} and spark.conf.get(shared._BRIEF) == "false"
    filtered = S.read_batches(spark, str(tmp_path / "out" / "filtered"), flow.FILTERED, [1, 2, 3, 4, 5])
    assert sorted(map(tuple, merged.collect())) == sorted(map(tuple, M.keep_first(filtered).collect())) and merged.columns == filtered.columns
    assert spark.read.text(str(tmp_path / "out" / "chatml")).count() == merged.count() > 0


def test_answers_are_shuffled_once(spark, tmp_path):
    """Two reads of the pairs, of which one reads no answer; one exchange carries answers, none a source's text twice."""
    fixtures.fx_qa(spark, SMALL).write.parquet(str(tmp_path / "qa"))
    qa, sources = spark.read.parquet(str(tmp_path / "qa")), fixtures.fx_sources(spark, SMALL)
    plan = Q.validated(qa, sources)._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    reads = re.findall(r"ReadSchema: struct<([^\n]*)", plan)
    assert sum("answer" in x for x in reads) == 1 and sum("question" in x for x in reads) == 2
    assert "CartesianProduct" not in plan and "SortMergeJoin" not in plan.split("AdaptiveSparkPlan")[0]


def test_words_are_found_once_a_chunk(spark):
    """No search for words of a source or of a chunk's answers stands above the explosion into pairs."""
    qa, sources = fixtures.fx_qa(spark, SMALL), fixtures.fx_sources(spark, SMALL)
    plan = Q.validated(qa, sources)._jdf.queryExecution().optimizedPlan().toString().split("\n")
    at = next(k for k, line in enumerate(plan) if "Generate inline(arrays_zip(pairs" in line)
    words = "regexp_extract_all(lower("
    assert not any(words in line for line in plan[:at]) and sum(line.count(words) for line in plan[at:]) == 2  # of answers, of a source


def test_words_in_common_are_found_once_a_lot(spark):
    """A long chunk with many answers: its text is searched once for 64 of them, not once for each, and the numbers are those of Python's sets."""
    text = " ".join(f"maize{k} field{k % 700} of grain{k % 90}." for k in range(6000))
    answers = [" ".join(f"maize{(k * j) % 9000} grain{j % 200} Other{j}" for j in range(1, 2 + k % 23)) for k in range(1500)]
    qa = spark.createDataFrame([(1, 1, 1, k, f"How {k}?", a) for k, a in enumerate(answers)], "chunk_id long, batch_id int, chunk_ord long, pair_idx int, question string, answer string")
    began = time.perf_counter()
    got = {r.pair_idx: r.overlap for r in Q.with_overlap(qa, spark.createDataFrame([(1, text)], "chunk_id long, text string")).collect()}
    assert time.perf_counter() - began < 20
    words = lambda x: set(re.findall(r"\w{5,}", x.lower()))
    assert got == {k: len(words(a) & words(text)) for k, a in enumerate(answers)}


def test_issues_are_tested_once_a_row(spark):
    """Neither accepted nor rejected rows are filtered by tests written out anew."""
    for rows in Q.filter_batch(Q.validated(fixtures.fx_qa(spark, SMALL), fixtures.fx_sources(spark, SMALL))):
        assert rows._jdf.queryExecution().optimizedPlan().toString().count("Question appears incomplete") == 1


def test_pairs_without_a_chunk(spark):
    rows = [(None, 1, k, 1, f"How does it grow {k}?", "maize nitrogen harvest water and fields of grain") for k in range(200)] + [(7, 1, 500 + k, k, f"Why is it so {k % 3}?", "maize nitrogen harvest water") for k in range(200)]
    qa = spark.createDataFrame(rows, "chunk_id long, batch_id int, chunk_ord long, pair_idx int, question string, answer string")
    got = Q.validated(qa, spark.createDataFrame([(7, "maize nitrogen harvest water"), (9, "other")], "chunk_id long, text string")).collect()
    assert len(got) == 400 and {r.overlap for r in got if r.chunk_id is None} == {0}
    assert {r.overlap for r in got if r.chunk_id == 7} == {4} and sum(not r.duplicate for r in got) == 203


def test_prefix_sums(spark):
    rows = [([],), ([5],), ([1, 2, 3],), (list(range(1, 1001)),)]
    got = spark.createDataFrame(rows, "n array<long>").select("n", prefix_sums(F.col("n")).alias("s")).collect()
    for r in got:
        assert r.s == [sum(r.n[: k + 1]) for k in range(len(r.n))]
    began = time.perf_counter()
    many = spark.range(1).select(F.repeat(F.lit("\nTITLE OF ALL\nx"), 60_000).alias("text"))
    assert many.select(F.size(C.match_starts(F.col("text"), C.HEADERS[0])).alias("n")).first().n == 60_000
    assert time.perf_counter() - began < 60


def test_both_packings_agree(spark):
    texts = ["", "a", "\n\n", "x" * 3000, "\n\n".join(["y" * n for n in (900, 1097, 1, 1998, 1999, 2000, 5, 0, 0, 7)]), "\n\n".join(["z" * 10] * 5000)]
    docs = spark.createDataFrame([(str(k), t) for k, t in enumerate(texts)], "doc string, text string")
    one = docs.select("doc", F.posexplode(C.pack_paragraphs(F.col("text"))).alias("part", "text"))
    assert sorted(map(tuple, one.collect())) == sorted((r.doc, r.part, r.text) for r in C.pack_many_paragraphs(docs).collect())


def test_hooks(spark):
    files = spark.createDataFrame([("a", b"one\n---\ntwo"), ("b", b"")], "path string, content binary")
    got = R.extract_pages(files, lambda path, content: content.decode().split("\n---\n")).collect()
    assert sorted((r.path, r.page, r.total_pages, r.text) for r in got) == [("a", 1, 2, "one"), ("a", 2, 2, "two"), ("b", 1, 1, "")]
    rows = spark.createDataFrame([("q", "x" * 400, []), ("q", None, []), ("q", "x" * 900, ["i"])], "question string, answer string, issues array<string>")
    assert [(r.overall, r.recommendation) for r in Q.score_with(rows, lambda q, a: len(a) / 50).collect()] == [(8.0, "keep"), (0.0, "reject"), (10.0, "revise")]
    scored = Q.validated(spark.createDataFrame([(1, 1, 1, 1, "Why so?", "y" * 100)], "chunk_id long, batch_id int, chunk_ord long, pair_idx int, question string, answer string"), spark.createDataFrame([(1, "t")], "chunk_id long, text string"), lambda rows: Q.score_with(rows, lambda q, a: 9.0))
    assert scored.first().recommendation == "revise"


def test_closed_minutes_are_given_out_once(spark):
    """Append mode: a minute comes out when the watermark has passed it, and its state goes."""
    got = qa_queries.QUERIES["st2_throughput"](spark, SMALL)
    assert got.count() == got.select("minute").distinct().count() > 0


def test_shared_folder(spark, monkeypatch):
    df = shared.written(spark.range(3).toDF("x"), "kept")
    path = df.inputFiles()[0]
    assert S.exists(spark, path) and shared.clear(spark) > 0 and not S.exists(spark, path)
