"""Queries of the operators for what is larger than a row, arrives bit by bit or is kept between runs, with their SQL."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import sql
from ..operators import keywords as K
from ..operators import quality as Q
from ..operators import rollups as RU
from ..operators import segments as G
from ..operators.seen import SeenKeys
from ..sources import records as R
from ..sources.shared import shared_path
from ..streaming import monitor as S
from ..streaming import stateful as P
from . import fixtures as X
from . import page_queries, qa_queries
from .fixtures import TERMS, duck


def _pages(s, d):
    return X.fx_pages(s, d).select("id", "doc", "page", "text")


def _page_index(s, d):
    """Page ranges by the index of least gram hashes, of the chunks that segments give."""
    chunks = G.semantic_chunks(_pages(s, d), terms=TERMS)
    return chunks.select("id", F.array_join(F.transform("page_range", lambda p: p.cast("string")), ",").alias("pages"))


def _batch_by_batch(s, d):
    """Five batches, one after the other, each held against the stored keys of those before it."""
    index = SeenKeys(s, shared_path(s, "seen-keys"), buckets=16)
    qa = X.fx_qa(s, d)
    kept = [index.add(qa.filter(F.col("batch_id") == batch), batch).select("chunk_id", "pair_idx", "batch_id", "question") for batch in range(1, 6)]
    index.close()
    return reduce(DataFrame.unionByName, kept)


#: Event time of the first pair, and a moment after all others.
_FIRST, _LAST = 1_704_067_200, 1_900_000_000


def _as_stream(s, rows, name):
    """Rows as JSON files that a stream reads."""
    path = shared_path(s, name)
    rows.write.json(path)
    return s.readStream.schema(rows.schema).option("maxFilesPerTrigger", 10_000).json(path)


def _timed_pairs(s, d):
    return X.fx_qa(s, d).select("batch_id", "chunk_id", "chunk_ord", "pair_idx", "question", (F.length("answer") % 3 > 0).alias("accepted"), F.timestamp_seconds(F.lit(_FIRST) + F.col("chunk_id") * 7 + F.col("pair_idx")).alias("ts"))


def _two_outputs(s, d):
    """Raw and filtered pairs as two growing folders, held side by side; a last row in each moves the watermark past all others."""
    last = s.range(1).select(F.lit(0).alias("batch_id"), F.lit(0).cast("long").alias("chunk_id"), F.lit(0).alias("pair_idx"), F.timestamp_seconds(F.lit(_LAST)).alias("ts"))
    pairs = _timed_pairs(s, d)
    raw, filtered = (x.select("batch_id", "chunk_id", "pair_idx", "ts").unionByName(last) for x in (pairs, pairs.filter("accepted")))
    told = S.run_to(P.side_by_side(_as_stream(s, raw, "raw"), _as_stream(s, filtered, "filtered")), "append")
    return S.live_counts(told.filter("batch_id > 0"))


def _by_order(s, d):
    """First occurrences by order, from a stream in which pairs arrive as they fall."""
    with P.program_state(s):
        changes = S.run_to(P.first_by_order(_as_stream(s, _timed_pairs(s, d).drop("accepted"), "pairs"), "30 days", 10**8), "append")
    return P.settled(changes).select("batch_id", "chunk_id", "pair_idx")


def _calls(s, d):
    """The call log, and a last call that moves the watermark past all others."""
    last = s.range(1).select(F.lit(-1).cast("long").alias("event_id"), F.lit("end").alias("api_key"), F.lit(_LAST * 1_000_000).alias("us"), F.lit(False).alias("failed"), F.lit(0).alias("prompt_words"), F.lit(0).alias("response_words"))
    return _as_stream(s, X.fx_calls(s, d).unionByName(last), "calls")


def _limit_over_stream(s, d):
    with P.program_state(s):
        told = S.run_to(P.request_limit(_calls(s, d), "1 day"), "append")
    return told.filter("event_id >= 0").select("event_id", "earlier", "limited")


def _rejected(s, d):
    """Pairs as JSON lines, among them for each chunk a line that is cut off, and what is read of them: good pairs, and rejected lines."""
    root, out = shared_path(s, "mixed"), shared_path(s, "records")
    qa = X.fx_qa(s, d)
    good = qa.select(F.to_json(F.struct("chunk_id", "pair_idx", "question")).alias("value"))
    broken = qa.filter("pair_idx = 1").select(F.concat(F.lit('{"chunk_id": '), "chunk_id", F.lit(', "pair_idx": 1, "question": "cut')).alias("value"))
    good.unionByName(broken).repartition(6).write.text(root)
    read = R.read_records(s, root, "chunk_id long, pair_idx int, question string", out)
    return read.good.select("chunk_id", "pair_idx", "question").unionByName(read.rejected.select(F.lit(None).alias("chunk_id"), F.lit(None).alias("pair_idx"), F.col("value").alias("question")))


def _large_dictionary(s, d):
    """Keywords of every page by a dictionary of all words of the benchmark."""
    words = F.explode(F.regexp_extract_all(F.lower("text"), F.lit("[a-z]{4,}"), F.lit(0)))
    terms = s.read.parquet(f"{d}/benchmark.parquet").select(words.alias("term"))
    return K.keywords(X.fx_pages(s, d).select("id", "text"), terms).select("id", F.array_join("keywords", ",").alias("keywords"))


def _rolled_up(spark, name, rows, measures, by):
    """Totals of five batches, each added on its own."""
    rollup = RU.Rollup(spark, shared_path(spark, name), measures, by)
    for batch in range(1, 6):
        rollup.add(rows.filter(F.col("batch_id") == batch), batch)
    return rollup.totals()


def _in_sql(text, *views):
    """A query written in Spark's SQL over views and the library's functions for SQL."""

    def run(s, d):
        sql.register(s)
        return s.sql(text, **{v: getattr(X, v)(s, d) for v in views})

    return run


_PACKED = "select * from ql_pack(table(select doc, n, paragraph from (select doc, array_join(transform(array_sort(collect_list(struct(page, text))), x -> x.text), '\\n\\n') text from {fx_pages} group by doc), lateral posexplode(split(text, '\\n\\n', -1)) as x(n, paragraph)), 2000)"

QUERIES = {
    "p10_large_documents": lambda s, d: G.semantic_chunks(_pages(s, d), terms=TERMS).select("id", "text", "doc", "chunk_no", "char_count", "sentence_count"),
    "p10_large_metadata": lambda s, d: G.with_source_pages(G.semantic_chunks(_pages(s, d), terms=TERMS), _pages(s, d)).select("id", "topic", F.array_join("keywords", ",").alias("keywords"), F.array_join("source_pages", ",").alias("source_pages")),
    "p7_large_boundaries": lambda s, d: G.boundaries(_pages(s, d)).select("doc", F.col("boundary").cast("int").alias("boundary")),
    "a1_page_offsets": lambda s, d: G.page_offsets(_pages(s, d)).select("id", "start"),
    "j1_page_index": _page_index,
    "w3_batch_by_batch": _batch_by_batch,
    "s1_rejected": _rejected,
    "p6_windows_in_sql": _in_sql("select format_string('%s-c%d', id, w.chunk_id) id, doc, page, w.chunk_id, w.text, source from {fx_pages}, lateral ql_word_windows(text, 80, 12) w", "fx_pages"),
    "p9_packing_in_sql": _in_sql(_PACKED, "fx_pages"),
    "c5_normalized_in_sql": _in_sql("select chunk_id, pair_idx, ql_normalized(question) key from {fx_qa}", "fx_qa"),
    "a11_starters_by_batch": lambda s, d: _rolled_up(s, "starters", X.fx_qa(s, d).withColumn("starter", RU.starter()), {"n": ("count", None)}, ["starter"]),
    "a12_lengths_by_batch": lambda s, d: _rolled_up(s, "lengths", X.fx_qa(s, d), RU.PAIRS, ["type"]),
    "c1_large_dictionary": _large_dictionary,
    "p18_rejected": lambda s, d: Q.filter_batch(Q.validated(X.fx_qa(s, d), X.fx_sources(s, d)))[1].select("chunk_id", "pair_idx", F.col("quality_score.recommendation").alias("recommendation"), F.array_join("quality_score.issues", "; ").alias("issues")),
    "st5_within_watermark": lambda s, d: S.run_to(S.first_seen(_as_stream(s, _timed_pairs(s, d), "bounded"), "30 days"), "append").select("batch_id", "q_norm"),
    "st1_two_outputs": _two_outputs,
    "st5_first_by_order": _by_order,
    "w5_limit_over_stream": _limit_over_stream,
    "st6_tokens_over_stream": lambda s, d: S.run_to(P.tokens_per_minute(_calls(s, d), "1 day", 5000), "append"),
}
SQL = {
    "p10_large_documents": page_queries.SQL["p10_semantic_chunks"],
    "p10_large_metadata": page_queries.SQL["p10_chunk_metadata"],
    "p7_large_boundaries": page_queries.SQL["p7_boundaries"],
    "a1_page_offsets": duck('select id, (sum(length(text) + 2) over (partition by doc order by page) - length(text) - 2)::bigint "start" from fx_pages', "fx_pages"),
    "j1_page_index": page_queries.SQL["j1_page_range"],
    "w3_batch_by_batch": qa_queries.SQL["w3_keep_first"],
    "c1_large_dictionary": page_queries.SQL["c1_keywords"].replace(page_queries._KEY_TERMS, "(select unnest(regexp_extract_all(lower(text), '[a-z]{4,}')) from benchmark)"),
    "a11_starters_by_batch": qa_queries.SQL["a11_starters"],
    "a12_lengths_by_batch": duck('select "type", count(*) total_pairs, sum(length(question))::bigint question_chars, sum(length(answer))::bigint answer_chars from fx_qa group by "type"', "fx_qa"),
    "p6_windows_in_sql": page_queries.SQL["p6_word_windows"],
    "p9_packing_in_sql": page_queries.SQL["p9_packing"],
    "c5_normalized_in_sql": page_queries.SQL["c5_normalized"],
    "s1_rejected": duck("select chunk_id, pair_idx, question from fx_qa union all select null, null, '{\"chunk_id\": ' || chunk_id || ', \"pair_idx\": 1, \"question\": \"cut' from fx_qa where pair_idx = 1", "fx_qa"),
    "p18_rejected": duck(qa_queries._CTE + " select chunk_id, pair_idx, recommendation, array_to_string(issues, '; ') issues from sc where not (recommendation = 'keep' and overall >= 6)", "fx_qa", "fx_sources"),
    "st5_within_watermark": qa_queries.SQL["st5_first_seen"],
    "st1_two_outputs": qa_queries.SQL["st1_live_counts"],
    "st5_first_by_order": duck(f"select batch_id, chunk_id, pair_idx from fx_qa qualify row_number() over (partition by batch_id, {qa_queries._NORM} order by chunk_ord, pair_idx) = 1", "fx_qa"),
    "w5_limit_over_stream": qa_queries.SQL["w5_request_limit"],
    "st6_tokens_over_stream": qa_queries.SQL["st6_tokens_per_minute"],
}
