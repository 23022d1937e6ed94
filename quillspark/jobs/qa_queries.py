"""Queries over plans, pairs, calls and streams, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.text import WS, WS_IN
from ..operators import chunks as C
from ..operators import export as E
from ..operators import merge as M
from ..operators import plan as L
from ..operators import prompts as T
from ..operators import quality as Q
from ..operators import responses as R
from ..operators import usage as U
from ..sources.shared import shared_path, written
from ..streaming import monitor as S
from . import fixtures as X
from . import flow
from .fixtures import TERMS, duck
from .page_queries import _CHUNKED, _ID, _strip, _words

TARGET = 50_000
NOW = "timestamp '2024-01-01 00:00:00'"


def _chunks(s, d):
    return C.semantic_chunks(X.fx_pages(s, d), terms=TERMS)


def _batched(s, d):
    """Word windows as chunks, in contiguous batches."""
    windows = written(C.word_window_chunks(X.fx_pages(s, d), 80, 12).select("id", "doc", "page", "chunk_id"), "windows")
    return L.contiguous_batches(windows.withColumn("chunk_no", F.col("page") * 100_000 + F.col("chunk_id")), 5)


def _planned_chunks(s, d):
    batched = _batched(s, d)
    return L.plan_chunks(batched, L.batch_plan(batched, TARGET, 5)).select("id", "batch_id", "qa_per_chunk", "factual")


def _plan(s, d):
    return L.batch_plan(X.fx_sources(s, d).select((F.col("chunk_id") % 5 + 1).cast("int").alias("batch_id")), TARGET, 5)


def _scored(s, d):
    return Q.validated(X.fx_qa(s, d), X.fx_sources(s, d))


def _kept(s, d):
    return Q.filter_batch(_scored(s, d))[0]


def _stream(s, d):
    """Scored pairs as a growing folder of JSON lines, with an event time."""
    path = shared_path(s, "growing")
    rows = X.fx_qa(s, d).select("batch_id", "chunk_id", "pair_idx", "question", (F.length("answer") % 3 > 0).alias("accepted"), F.timestamp_seconds(F.lit(1_704_067_200) + F.col("chunk_id") * 7 + F.col("pair_idx")).alias("ts"))
    rows.repartition(6).write.json(path)
    return S.read_growing(s, path)


def _polls(s, d):
    path = shared_path(s, "polls")
    S.new_rows_per_poll(_stream(s, d), path, shared_path(s, "polls-checkpoint"))
    return s.read.parquet(path).groupBy("batch_id").agg(F.sum("rows").alias("rows"))


def _incremental(s, d):
    """Parsed pairs of responses generated as chunks arrive."""
    src, out = shared_path(s, "prompts"), shared_path(s, "generated")
    X.fx_responses(s, d).repartition(4).write.json(src)
    arriving = s.readStream.schema("chunk_id long, batch_id int, response string").option("maxFilesPerTrigger", 1).json(src)
    S.generate_incrementally(arriving, R.parse_responses, out, shared_path(s, "generated-checkpoint"))
    return s.read.parquet(out).select("chunk_id", "batch_id", "pair_idx", "question")


def _generated(s, d):
    """The generator hook with a function that answers from the prompt."""
    prompts = X.fx_sources(s, d).select("chunk_id", (F.col("chunk_id") % 5 + 1).cast("int").alias("batch_id"), F.col("text").alias("prompt"))

    def answer(prompt: str) -> str:
        if len(prompt) % 10 == 0:
            raise ValueError("refused")
        return prompt[:20][::-1]

    return R.generate(prompts, answer, 8).select("chunk_id", "batch_id", F.length("response").alias("n_chars"), "error")


def _statistics(s, d):
    """The merged set's statistics, its maps as text."""
    stats = M.dataset_statistics(M.keep_first(_scored(s, d)))
    listed = [F.array_join(F.transform(F.map_entries(f"by_{c}"), lambda e: F.concat_ws(":", e["key"], e["value"].cast("string"))), ",").alias(f"by_{c}") for c in ("type", "difficulty", "batch_id")]
    return stats.select("total_pairs", F.bround("avg_quality", 6).alias("avg_quality"), *listed)


def _scored_by_length(s, d):
    """The scorer hook with a score of one's own."""
    return Q.score_with(X.fx_qa(s, d), lambda question, answer: len(answer) / 50).select("chunk_id", "pair_idx", "overall", "recommendation")


def _plan_with_waiting(s, d):
    """The plan with a sixth batch, of chunks made of conversations, that nobody has worked on."""
    chunks = X.fx_sources(s, d).select((F.col("chunk_id") % 5 + 1).cast("int").alias("batch_id"))
    waiting = s.read.parquet(f"{d}/conversations.parquet").select("conv_id").distinct().select(F.lit(6).alias("batch_id"))
    return L.batch_plan(chunks.unionByName(waiting), TARGET, 5)


def _throughput(s, d):
    """Minutes that the watermark has closed, as append mode gives them out."""
    path = shared_path(s, "arrived")
    rows = X.fx_qa(s, d).select("batch_id", "chunk_id", "pair_idx", "question", (F.length("answer") % 3 > 0).alias("accepted"), F.timestamp_seconds(F.lit(1_704_067_200) + F.col("chunk_id") * 7 + F.col("pair_idx")).alias("ts"))
    rows.write.json(path)
    return S.run_to(S.throughput(S.read_growing(s, path, files_per_trigger=10_000)), "append")


def flagship(s, d):
    """The whole flow, from pages to training files; the merged set by type."""
    return M.distribution(flow.run(X.fx_pages(s, d), shared_path(s, "flow"), terms=TERMS), "type")


def _training_files(s, d):
    """The flow's training files, line by line."""
    out = shared_path(s, "flow")
    flow.run(X.fx_pages(s, d), out, terms=TERMS)
    return s.read.text(f"{out}/chatml").select(F.md5(F.col("value").cast("binary")).alias("digest"))


QUERIES = {
    "w4_batches": lambda s, d: _batched(s, d).select("id", "rank", "batch_id"),
    "w1_chunk_numbers": lambda s, d: _chunks(s, d).groupBy("doc").agg(F.max("chunk_no").alias("last_no"), F.count(F.lit(1)).alias("n")),
    "a17_plan": lambda s, d: L.batch_plan(_batched(s, d), TARGET, 5),
    "j2_plan_join": _planned_chunks,
    "j3_pending": lambda s, d: L.pending_chunks(X.fx_responses(s, d), R.parse_responses(X.fx_responses(s, d))).select("chunk_id", "batch_id"),
    "p11_prompts": lambda s, d: T.build_prompts(
        X.fx_sources(s, d).select(F.col("chunk_id").alias("id"), (F.col("chunk_id") % 5 + 1).cast("int").alias("batch_id"), "text", F.lit("a topic").alias("topic"), F.array(F.lit("k1"), F.lit("k2")).alias("keywords")).join(_plan(s, d).drop("chunks"), "batch_id")
    ).select("chunk_id", "batch_id", F.md5(F.col("prompt").cast("binary")).alias("digest")),
    "p12_type_prompts": lambda s, d: T.build_type_prompts(X.fx_sources(s, d).withColumnRenamed("chunk_id", "id"), 3).select("chunk_id", "type", F.md5(F.col("prompt").cast("binary")).alias("digest")),
    "p13_parse": lambda s, d: R.parse_responses(X.fx_responses(s, d)),
    "p14_status": lambda s, d: R.status_counts(X.fx_responses(s, d)),
    "f1_generate": _generated,
    "w2_duplicates": lambda s, d: Q.flag_duplicates(X.fx_qa(s, d)).select("chunk_id", "pair_idx", "duplicate"),
    "j4_grounding": lambda s, d: Q.with_overlap(X.fx_qa(s, d), X.fx_sources(s, d)).select("chunk_id", "pair_idx", "overlap"),
    "p15_issues": lambda s, d: _scored(s, d).select("chunk_id", "pair_idx", F.array_join("issues", "|").alias("issues")),
    "p16_scores": lambda s, d: _scored(s, d).select("chunk_id", "pair_idx", "accuracy", "completeness", "specificity", F.bround("overall", 6).alias("overall"), "recommendation"),
    "p18_accepted": lambda s, d: _kept(s, d).select("chunk_id", "pair_idx", F.col("quality_score.recommendation").alias("recommendation")),
    "w3_keep_first": lambda s, d: M.keep_first(X.fx_qa(s, d)).select("chunk_id", "pair_idx", "batch_id", "question"),
    "a7_types": lambda s, d: M.distribution(X.fx_qa(s, d), "type"),
    "a8_difficulty": lambda s, d: M.distribution(X.fx_qa(s, d), "difficulty", "unknown"),
    "a9_batches": lambda s, d: M.distribution(X.fx_qa(s, d), "batch_id"),
    "t3_most_common": lambda s, d: M.most_common(M.distribution(X.fx_qa(s, d), "type"), "type"),
    "a10_quality": lambda s, d: M.quality_summary(_scored(s, d)),
    "a11_starters": lambda s, d: M.question_starters(X.fx_qa(s, d)),
    "a12_diversity": lambda s, d: M.diversity_metrics(X.fx_qa(s, d)),
    "a13_dedup": lambda s, d: M.dedup_summary(X.fx_qa(s, d)),
    "dataset_statistics": _statistics,
    "a14_run_stats": lambda s, d: Q.batch_run_stats(_scored(s, d), _plan(s, d)),
    "a15_progress": lambda s, d: L.batch_progress(_plan_with_waiting(s, d), X.fx_qa(s, d), _kept(s, d)),
    "f4_scorer": _scored_by_length,
    "p19_chatml": lambda s, d: E.as_json(E.to_chatml(X.fx_chat(s, d)), "messages").select("conv_id", "turn", "json"),
    "p20_chatml_context": lambda s, d: E.to_chatml_context(X.fx_pages(s, d)).select("doc", "page", F.element_at("messages", 2)["content"].alias("content")),
    "p21_alpaca": lambda s, d: E.to_alpaca(X.fx_pages(s, d)),
    "a16_usage": lambda s, d: U.usage_stats(X.fx_calls(s, d)),
    "w5_request_limit": lambda s, d: U.request_limit(X.fx_calls(s, d)).select("event_id", "earlier", "limited"),
    "st6_tokens_per_minute": lambda s, d: U.tokens_per_minute(X.fx_calls(s, d), 5000),
    "st1_live_counts": lambda s, d: S.run_to(S.live_counts(_stream(s, d)), "complete"),
    "st2_throughput": _throughput,
    "st3_polls": _polls,
    "st4_incremental": _incremental,
    "st5_first_seen": lambda s, d: S.run_to(S.first_seen(_stream(s, d)), "append").select("batch_id", "q_norm"),
    "flagship": flagship,
    "flow_training_files": _training_files,
}

_WINDOWS = f"""select id || '-c' || (k + 1) id, doc, page * 100000 + k + 1 chunk_no from (select *, unnest(range(0, (len(w) + 67) // 68)) k from (select id, doc, page, {_words("text")} w from fx_pages))"""
_RANKED = f"with cw as ({_WINDOWS}), rk as (select id, row_number() over (order by doc, chunk_no) - 1 rank, count(*) over () n from cw), bt as (select id, rank, least(rank // (n // 5) + 1, 5)::int batch_id from rk)"
_SHARE = {"factual": "0.2", "conceptual": "0.2", "procedural": "0.2", "comparative": "0.15", "scenario": "0.15", "analytical": "0.1"}


def _planned(counts: str) -> str:
    floors = {k: f"floor(q * {v}::double)::int" for k, v in _SHARE.items()}
    rest = f"q - ({' + '.join(floors.values())})"
    return f"select batch_id, {TARGET // 5} target_qa_count, chunks, q qa_per_chunk, " + ", ".join(f"({v} + {rest})::int {k}" if k == "factual" else f"{v} {k}" for k, v in floors.items()) + f" from (select batch_id, count(*) chunks, greatest(1, {TARGET // 5} // count(*))::int q from {counts} group by batch_id)"


_PLAN = _planned("(select (chunk_id % 5 + 1)::int batch_id from fx_sources)")
_CLEAN = f"""select *, {_strip("case when right(c, 3) = '```' then left(c, length(c) - 3) else c end")} t from (select *, case when starts_with(b, '```') then substr(b, 4) else b end c from (
 select *, case when starts_with(a, '```json') then substr(a, 8) else a end b from (select *, {_strip("coalesce(response, '')")} a from fx_responses)))"""
_PARSED = f"""with cl as ({_CLEAN}), ok as (select * from cl where t like '[%]' and json_valid(t)),
 pr as (select chunk_id, batch_id, unnest(range(1, json_array_length(t)::bigint + 1))::int pair_idx, t from ok)
select chunk_id, batch_id, pair_idx, json_extract_string(t, '$[' || (pair_idx - 1) || '].question') question, json_extract_string(t, '$[' || (pair_idx - 1) || '].answer') answer,
 json_extract_string(t, '$[' || (pair_idx - 1) || '].difficulty') difficulty, json_extract_string(t, '$[' || (pair_idx - 1) || '].type') "type" from pr"""
_NORM = _strip(f"regexp_replace(regexp_replace(lower(question), '[^\\p{{L}}\\p{{N}}_{WS_IN}]', '', 'g'), '{WS}+', ' ', 'g')")
_KEY = f"regexp_replace({_strip('lower(question)')}, '[^\\p{{L}}\\p{{N}}{WS_IN}]', '', 'g')"
_DUP = f"select *, row_number() over (partition by batch_id, {_NORM} order by chunk_ord, pair_idx) > 1 duplicate from fx_qa"
_SIG = "list_distinct(regexp_extract_all(lower({0}), '[\\p{{L}}\\p{{N}}_]{{5,}}'))"
_LAP = f"select d.*, len(list_intersect({_SIG.format('answer')}, coalesce({_SIG.format('text')}, [])))::int overlap from du d left join fx_sources using (chunk_id)"
_SQ, _SA = _strip("question"), _strip("answer")
_TESTS = [
    ("nq < 10", "'Question too short (' || nq || ' chars)'"),
    ("nq > 300", "'Question too long (' || nq || ' chars)'"),
    ("na < 20", "'Answer too short (' || na || ' chars)'"),
    ("na > 1000", "'Answer too long (' || na || ' chars)'"),
    ("sq not like '%?'", "'Question doesn''t end with ''?'''"),
    ("regexp_matches(sq, '^(Answer:|Q:|A:)')", "'Question has formatting artifacts'"),
    ("regexp_matches(sa, '^(Question:|Q:|A:)')", "'Answer has formatting artifacts'"),
    ("lower(question) = lower(answer)", "'Question and answer are identical'"),
    *[
        (f"regexp_matches({c}, '{p}')", m)
        for p in ("(?i)^What is [^\\n]{1,15}\\?\\z", "(?i)^(Yes|No)\\.?\\z", "(?i)^(True|False)\\.?\\z")
        for c, m in (("sq", "'Question appears too vague'"), ("sa", "'Answer appears too simple'"))
    ],
    ("contains(question, '...') or contains(question, '[') or contains(question, '___')", "'Question appears incomplete'"),
    ("contains(answer, '...') or contains(answer, '[TBD]') or contains(answer, '[TODO]')", "'Answer appears incomplete'"),
    ("duplicate", "'Duplicate or very similar question'"),
    ("overlap < 3", "'Answer may not be grounded in source text'"),
]
_ISSUES = "list_filter([" + ", ".join(f"case when {t} then {m} end" for t, m in _TESTS) + "], lambda x: x is not null)"
_CTE = f"""with du as ({_DUP}), lp as ({_LAP}), tx as (select *, length(question) nq, length(answer) na, {_SQ} sq, {_SA} sa from lp), iss as (select *, {_ISSUES} issues from tx),
 s1 as (select *, greatest(0.0, least(10.0, 8.0 - 0.5 * len(issues)))::double accuracy,
  greatest(0.0, least(10.0, 8.0 - 0.5 * len(issues) - case when na < 50 then 2 else 0 end - case when na > 500 then 1 else 0 end + case when starts_with(lower(question), 'why') or contains(lower(question), 'explain') then 1 else 0 end))::double completeness,
  (case when regexp_matches(lower(question), '^(what|when|where|who)') then 9.0 else 8.0 end)::double specificity from iss),
 s2 as (select *, (accuracy + accuracy + completeness + 8.0::double + specificity) / 5 overall from s1),
 sc as (select *, case when overall >= 7.5 and len(issues) = 0 then 'keep' when overall >= 6.0 then case when len(issues) > 0 then 'revise' else 'keep' end else 'reject' end recommendation from s2)"""


def _first(table: str) -> str:
    return f"(select * from {table} qualify row_number() over (partition by {_KEY} order by batch_id, chunk_ord, pair_idx) = 1)"


def _dist(table: str, column: str) -> str:
    return f"select {column}, count(*) n, round_even(count(*) / sum(count(*)) over () * 100, 1) pct from {table} group by {column}"


_STARTER = f"coalesce(lower({_words('question')}[1]), 'unknown')"
_ARRIVED = "select batch_id, chunk_id, pair_idx, question, length(answer) % 3 > 0 accepted, to_timestamp(1704067200 + chunk_id * 7 + pair_idx)::timestamp ts from fx_qa"
_GOOD = "with g as (select count(*) total_requests, count(*) filter (not failed) successful_requests, count(*) filter (failed) failed_requests, coalesce(sum(floor(prompt_words * 1.3::double)) filter (not failed), 0)::bigint input_tokens, coalesce(sum(floor(response_words * 1.3::double)) filter (not failed), 0)::bigint output_tokens from fx_calls)"

_LIST = lambda names: ", ".join(f"'{n}'" for n in names)
#: The flow with the generator that extracts: chunks in place of the sources, a pair for each of their sentences.
_FLOW = (
    _CHUNKED
    + f""", rk as (select {_ID} chunk_id, {_strip("body")} text, row_number() over (order by doc, chunk_no) - 1 rank, count(*) over () n from ck), fx_sources as (select chunk_id, text from rk),
 sn as (select chunk_id, rank chunk_ord, least(rank // (n // 5) + 1, 5)::int batch_id, string_split(text, '. ') a from rk), ex as (select *, unnest(range(1, len(a) + 1))::int pair_idx from sn),
 fx_qa as (select chunk_id, chunk_ord, batch_id, pair_idx, ([{_LIST(T.TYPES)}])[(pair_idx - 1) % 6 + 1] "type", ([{_LIST(flow.LEVELS)}])[(pair_idx - 1) % 3 + 1] difficulty,
  ([{_LIST(flow.STARTS)}])[(pair_idx - 1) % 6 + 1] || ' ' || lower(array_to_string(list_slice(string_split(a[pair_idx], ' '), 1, 6), ' ')) || '?' question, a[pair_idx] || '. ' || coalesce(a[pair_idx + 1], '') || '.' answer from ex),
 """
    + _CTE.removeprefix("with ")
    + ", kp as (select * from sc where recommendation = 'keep' and overall >= 6) "
)

SQL = {
    "w4_batches": duck(_RANKED + " select id, rank, batch_id from bt", "fx_pages"),
    "w1_chunk_numbers": duck(_CHUNKED + " select doc, max(chunk_no)::int last_no, count(*) n from ck group by doc", "fx_pages"),
    "a17_plan": duck(_RANKED + " " + _planned("bt"), "fx_pages"),
    "j2_plan_join": duck(_RANKED + f", pl as ({_planned('bt')}) select id, batch_id, qa_per_chunk, factual from bt join pl using (batch_id)", "fx_pages"),
    "j3_pending": duck(f"with pp as ({_PARSED}) select chunk_id, batch_id from fx_responses where chunk_id not in (select chunk_id from pp)", "fx_responses"),
    "p11_prompts": duck(
        f"with pl as ({_PLAN}) select chunk_id, batch_id, md5("
        + " || ".join({"text": "text", "topic": "'a topic'", "keywords": "'k1, k2'", "total_questions": "qa_per_chunk::varchar"}.get(f, f"{f[:-6]}::varchar") if k % 2 else "'" + f.replace("'", "''").replace("{{", "{").replace("}}", "}") + "'" for k, f in enumerate(__import__("re").split(r"(?<!\{)\{([a-z_]+)\}(?!\})", T.BATCH_TEMPLATE)))
        + ") digest from (select *, (chunk_id % 5 + 1)::int batch_id from fx_sources) join pl using (batch_id)",
        "fx_sources",
    ),
    "p12_type_prompts": duck("select chunk_id, t.k \"type\", md5(replace(replace(t.v, '{n}', '3'), '{text}', text)) digest from fx_sources, (values " + ", ".join("('{}', '{}')".format(k, (v + T.TYPE_TAIL).replace("{{", "{").replace("}}", "}").replace("'", "''")) for k, v in T.TYPE_TEMPLATES.items()) + ") t(k, v)", "fx_sources"),
    "p13_parse": duck(_PARSED, "fx_responses"),
    "p14_status": duck(f"with cl as ({_CLEAN}) select case when t = '' then 'empty' when not json_valid(t) then 'malformed' when json_type(t) = 'ARRAY' then 'ok' else 'not_array' end status, count(*) responses from cl group by 1", "fx_responses"),
    "f1_generate": duck("select chunk_id, (chunk_id % 5 + 1)::int batch_id, case when length(text) % 10 != 0 then length(left(text, 20))::int end n_chars, case when length(text) % 10 = 0 then 'ValueError: refused' end error from fx_sources", "fx_sources"),
    "w2_duplicates": duck(f"with du as ({_DUP}) select chunk_id, pair_idx, duplicate from du", "fx_qa"),
    "j4_grounding": duck(f"with du as ({_DUP}), lp as ({_LAP}) select chunk_id, pair_idx, overlap from lp", "fx_qa", "fx_sources"),
    "p15_issues": duck(_CTE + " select chunk_id, pair_idx, array_to_string(issues, '|') issues from sc", "fx_qa", "fx_sources"),
    "p16_scores": duck(_CTE + " select chunk_id, pair_idx, accuracy, completeness, specificity, round_even(overall, 6) overall, recommendation from sc", "fx_qa", "fx_sources"),
    "p18_accepted": duck(_CTE + " select chunk_id, pair_idx, recommendation from sc where recommendation = 'keep' and overall >= 6", "fx_qa", "fx_sources"),
    "w3_keep_first": duck("select chunk_id, pair_idx, batch_id, question from " + _first("fx_qa"), "fx_qa"),
    "a7_types": duck(_dist("fx_qa", '"type"'), "fx_qa"),
    "a8_difficulty": duck(_dist("fx_qa", "difficulty"), "fx_qa"),
    "a9_batches": duck(_dist("fx_qa", "batch_id"), "fx_qa"),
    "t3_most_common": duck(_dist("fx_qa", '"type"') + ' order by n desc, "type"', "fx_qa"),
    "a10_quality": duck(_CTE + " select count(overall) scored, coalesce(avg(overall), 0.0) avg_overall, min(overall) min_overall, max(overall) max_overall from sc", "fx_qa", "fx_sources"),
    "a11_starters": duck(f"select {_STARTER} starter, count(*) n from fx_qa group by 1", "fx_qa"),
    "a12_diversity": duck(f"select count(*) total_pairs, avg(length(question)) avg_question_length, avg(length(answer)) avg_answer_length, count(distinct {_STARTER}) unique_starters from fx_qa", "fx_qa"),
    "a13_dedup": duck(f"select batch_id, count(*) loaded, count(*) - count(f.chunk_id) duplicates, count(f.chunk_id) unique_pairs from fx_qa q left join {_first('fx_qa')} f using (batch_id, chunk_id, pair_idx) group by batch_id", "fx_qa"),
    "dataset_statistics": duck(
        _CTE
        + ", kp as (select * from "
        + _first("sc")
        + ") select count(*) total_pairs, round_even(avg(overall), 6) avg_quality, "
        + ", ".join(f"(select string_agg(v || ':' || n, ',' order by v) from (select \"{c}\"::varchar v, count(*) n from kp group by 1)) by_{c}" for c in ("type", "difficulty", "batch_id"))
        + " from kp",
        "fx_qa", "fx_sources",
    ),
    "a14_run_stats": duck(
        _CTE + f""", pl as ({_PLAN}), m as (select batch_id, count(distinct chunk_id) p, count(*) m, count(*) filter (recommendation = 'keep' and overall >= 6) k from sc group by batch_id)
 select batch_id, chunks chunks_total, coalesce(p, 0) chunks_processed, coalesce(m, 0) qa_generated, coalesce(k, 0) qa_filtered, coalesce(m, 0) - coalesce(k, 0) qa_rejected, case when m > 0 then round_even(k / m * 100, 1) else 0.0 end filter_rate, round_even(coalesce(k, 0) / target_qa_count * 100, 1) completion_rate from pl left join m using (batch_id)""",
        "fx_qa", "fx_sources",
    ),
    "a15_progress": duck(
        _CTE + f""", pl as ({_planned("(select (chunk_id % 5 + 1)::int batch_id from fx_sources union all select 6 from (select distinct conv_id from conversations))")}), r as (select batch_id, count(*) r, count(distinct chunk_id) p from fx_qa group by batch_id), f as (select batch_id, count(*) k from sc where recommendation = 'keep' and overall >= 6 group by batch_id)
 select batch_id, case when r is null then 'not_started' when p >= chunks then 'completed' else 'in_progress' end status, target_qa_count, coalesce(r, 0) raw_generated, coalesce(k, 0) filtered_count, round_even(coalesce(k, 0) / target_qa_count * 100, 1) progress_percentage, chunks chunks_total, coalesce(p, 0) chunks_processed from pl left join r using (batch_id) left join f using (batch_id)""",
        "fx_qa", "fx_sources",
    ),
    "f4_scorer": duck("select chunk_id, pair_idx, o overall, case when o < 6 then 'reject' else 'keep' end recommendation from (select chunk_id, pair_idx, least(10.0::double, length(answer) / 50.0::double) o from fx_qa)", "fx_qa"),
    "p19_chatml": duck(f"""select conv_id, turn, '{{"messages":[{{"role":"system","content":' || to_json('{E.SYSTEM}') || '}},{{"role":"user","content":' || to_json(question) || '}},{{"role":"assistant","content":' || to_json(answer) || '}}]}}' "json" from fx_chat""", "fx_chat"),
    "p20_chatml_context": duck(f"select doc, page, 'Context from ' || source || ' (page ' || page || E'):\\n\\n' || left(text, 3000) || E'\\n\\n{E.CONTEXT_QUESTION}' content from fx_pages", "fx_pages"),
    "p21_alpaca": duck(f"select doc, page, '{E.ALPACA_INSTRUCTION}' instruction, 'Context: ' || left(text, 3000) || E'\\n\\nQuestion: {E.ALPACA_QUESTION}' \"input\", '{E.ALPACA_ANSWER}' \"output\" from fx_pages", "fx_pages"),
    "a16_usage": duck(_GOOD + " select *, round_even(input_tokens / 1000000 * 0.075::double + output_tokens / 1000000 * 0.3::double, 4) estimated_cost_usd, case when total_requests > 0 then round_even(successful_requests / total_requests * 100, 1) else 0.0 end success_rate from g", "fx_calls"),
    "w5_request_limit": duck("select event_id, n - 1 earlier, n - 1 >= 15 limited from (select event_id, count(*) over (partition by api_key order by us range between 59999999 preceding and current row) n from fx_calls)", "fx_calls"),
    "st6_tokens_per_minute": duck("select us // 60000000 \"minute\", count(*) calls, sum(floor(prompt_words * 1.3::double + response_words * 1.3::double))::bigint tokens, sum(floor(prompt_words * 1.3::double + response_words * 1.3::double)) > 5000 over_limit from fx_calls where not failed group by 1", "fx_calls"),
    "st1_live_counts": duck(f"with ar as ({_ARRIVED}) select batch_id, count(*) raw, count(*) filter (accepted) filtered, round_even(count(*) filter (accepted) / count(*) * 100, 1) pass_rate from ar group by batch_id", "fx_qa"),
    "st2_throughput": duck(f"with ar as ({_ARRIVED}) select date_trunc('minute', ts) \"minute\", count(*) pairs from ar where accepted group by 1 having date_trunc('minute', ts) + interval 1 minute <= (select max(ts) from ar where accepted) - interval 10 minute", "fx_qa"),
    "st3_polls": duck('select batch_id, count(*) "rows" from fx_qa group by batch_id', "fx_qa"),
    "st4_incremental": duck(f"with pp as ({_PARSED}) select chunk_id, batch_id, pair_idx, question from pp", "fx_responses"),
    "st5_first_seen": duck(f"select distinct batch_id, {_NORM} q_norm from fx_qa", "fx_qa"),
    "flagship": duck(_FLOW + _dist(_first("kp"), '"type"'), "fx_pages"),
    "flow_training_files": duck(_FLOW + "select md5('{" + '"messages":[{"role":"system","content":' + f"' || to_json('{E.SYSTEM}') || '" + '},{"role":"user","content":' + "' || to_json(question) || '" + '},{"role":"assistant","content":' + "' || to_json(answer) || '" + "}]}') digest from " + _first("kp"), "fx_pages"),
}
