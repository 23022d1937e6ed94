"""Queries over pages, markdown and chunks, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.text import WS, WS_IN, count_sentences, estimated_tokens, extract_keywords, extract_topic, merge_key, normalize_question, preview, significant_words, split_words, strip, title_case
from ..operators import chunks as C
from ..operators import pages as P
from . import fixtures as X
from .fixtures import TERMS, duck



def _strip(x: str) -> str:
    return rf"regexp_replace({x}, '^{WS}+|{WS}+\z', '', 'g')"


def _words(x: str) -> str:
    return f"list_filter(regexp_split_to_array({x}, '{WS}+'), lambda w: w != '')"


def _markdown_of_comments(spark, sf_dir):
    """Markdown with page comments, as written from pages; every tenth document has none."""
    md = P.pages_to_markdown(X.fx_pages(spark, sf_dir))
    return md.withColumn("text", F.when(F.col("doc").endswith("0"), F.regexp_replace("text", "<!-- Page [0-9]+ -->", "")).otherwise(F.col("text")))


def _chunks(spark, sf_dir):
    return C.semantic_chunks(X.fx_pages(spark, sf_dir), terms=TERMS)


def _by_doc(text: str) -> str:
    return f"select doc, string_agg(text, E'\\n\\n' order by page) text from fx_pages group by doc{text}"


QUERIES = {
    "p1_split_rule": lambda s, d: P.split_pages_rule(X.fx_markdown(s, d)).select("id", "doc", "page", "total_pages", "text"),
    "p1_split_rule_nonempty": lambda s, d: P.split_pages_rule(X.fx_markdown(s, d), drop_empty=True).select("id", "doc", "page", "total_pages", "text"),
    "p2_split_comments": lambda s, d: P.split_pages_comment(_markdown_of_comments(s, d)),
    "p4_drop_empty": lambda s, d: P.drop_empty_pages(X.fx_pages(s, d)).select("id", "page"),
    "p5_route": lambda s, d: P.route_documents(X.fx_pages(s, d)),
    "s8_to_markdown": lambda s, d: P.pages_to_markdown(X.fx_pages(s, d)),
    "a1_assemble": lambda s, d: P.assemble_documents(X.fx_pages(s, d)),
    "a2_totals": lambda s, d: P.dataset_totals(X.fx_pages(s, d)),
    "a3_methods": lambda s, d: P.method_breakdown(X.fx_pages(s, d)),
    "a4_documents": lambda s, d: P.document_stats(X.fx_pages(s, d)),
    "a6_merge_summary": lambda s, d: P.merge_summary(X.fx_pages(s, d)),
    "t4_preview": lambda s, d: P.preview_pages(X.fx_pages(s, d)),
    "u1_union_methods": lambda s, d: P.union_methods(*[P.drop_empty_pages(X.fx_pages(s, d).filter(f"method = '{m}'")) for m in ("digital", "ocr")]).select("id", "method", "source"),
    "p6_word_windows": lambda s, d: C.word_window_chunks(X.fx_pages(s, d), 80, 12),
    "p6_word_windows_default": lambda s, d: C.word_window_chunks(X.fx_pages(s, d)),
    "t2_sorted": lambda s, d: P.sorted_documents(X.fx_pages(s, d)),
    "f2_greedy_pack": lambda s, d: C.pack_many_paragraphs(P.assemble_documents(X.fx_pages(s, d)).select("doc", "text")),
    "p10_chunk_metadata": lambda s, d: _chunks(s, d).select("id", "topic", F.array_join("keywords", ",").alias("keywords"), F.array_join("source_pages", ",").alias("source_pages")),
    "p7_boundaries": lambda s, d: P.assemble_documents(X.fx_pages(s, d)).select("doc", F.explode(C.section_boundaries(F.col("text"))).alias("boundary")),
    "p8_sections": lambda s, d: C.sections(P.assemble_documents(X.fx_pages(s, d))).select("doc", F.length("text").alias("n_chars"), F.md5(F.col("text").cast("binary")).alias("digest")),
    "p9_packing": lambda s, d: P.assemble_documents(X.fx_pages(s, d)).select("doc", F.posexplode(C.pack_paragraphs(F.col("text"))).alias("part", "text")),
    "p10_semantic_chunks": lambda s, d: _chunks(s, d).select("id", "text", "doc", "chunk_no", "char_count", "sentence_count"),
    "c1_keywords": lambda s, d: X.fx_pages(s, d).select("id", F.array_join(extract_keywords(F.col("text"), TERMS), ",").alias("keywords")),
    "c2_topic": lambda s, d: X.fx_pages(s, d).select("id", extract_topic(F.col("text"), F.concat(F.col("doc"), F.lit("_2019web-part"))).alias("topic")),
    "c3_sentences": lambda s, d: X.fx_pages(s, d).select("id", count_sentences(F.col("text")).alias("sentences")),
    "c5_normalized": lambda s, d: X.fx_qa(s, d).select("chunk_id", "pair_idx", normalize_question(F.col("question")).alias("key")),
    "c6_merge_key": lambda s, d: X.fx_qa(s, d).select("chunk_id", "pair_idx", merge_key(F.col("question")).alias("key")),
    "c7_significant_words": lambda s, d: X.fx_sources(s, d).select("chunk_id", F.size(significant_words(F.col("text"))).alias("words")),
    "c8_tokens": lambda s, d: X.fx_pages(s, d).select("id", estimated_tokens(F.col("text")).alias("tokens")),
    "c9_strip_split": lambda s, d: X.fx_pages(s, d).select("id", F.length(strip(F.col("text"))).alias("stripped"), F.size(split_words(F.col("text"))).alias("words")),
    "c13_preview": lambda s, d: X.fx_pages(s, d).select("id", preview(F.col("text"), 500).alias("preview")),
    "c2_title_case": lambda s, d: X.fx_pages(s, d).select("id", title_case(F.col("text")).alias("title")),
    "j1_page_range": lambda s, d: _chunks(s, d).select("id", F.array_join(F.transform("page_range", lambda p: p.cast("string")), ",").alias("pages")),
    "a5_chunk_stats": lambda s, d: C.chunk_stats(_chunks(s, d)),
    "j5_chunks_per_doc": lambda s, d: C.chunks_per_document(_chunks(s, d), X.fx_pages(s, d)),
}

_PATTERNS = [p.replace("(?=[A-Z\\(])", "[A-Z(]") for p in C.HEADERS]
_TAILS = (0, 0, 1)  # characters that stand for the look-ahead, which this engine lacks
_STARTS = "\nunion all ".join(
    # gaps and matches in turn, added up
    f"""select doc, t, sum(gap + coalesce(hit, 0)) over (partition by doc order by k rows between unbounded preceding and current row) - hit as pos from (
  select doc, t, k, length(gaps[k]) + case when k > 1 then {tail} else 0 end gap, length(hits[k]) - {tail} hit from (
   select doc, text t, unnest(range(1, len(gaps) + 1)) k, gaps, hits from (select doc, text, regexp_split_to_array(text, E'{p}') gaps, regexp_extract_all(text, E'{p}') hits from asm)))"""
    for p, tail in zip([x.replace("\\", "\\\\") for x in _PATTERNS], _TAILS)
)
_SECTIONS = f"""with asm as ({_by_doc("")}), st as ({_STARTS}),
 bd as (select doc, 0 b from asm union select doc, length(text) from asm union select doc, pos::int from st where pos is not null),
 sec as (select bd.doc, b, substr(text, b + 1, lead(b) over (partition by bd.doc order by b) - b) body from bd join asm using (doc)),
 secs as (select doc, b, body from sec where length(body) >= 1000)"""
_PACK = """, recursive pk as (
 select doc, b, string_split(body, E'\\n\\n') ps, 1 k, ''::varchar cur, null::varchar done, 0 part from long
 union all
 select doc, b, ps, k + 1,
  case when k > len(ps) then '' when length(cur) + length(ps[k]) < 2000 then cur || ps[k] || E'\\n\\n' else ps[k] || E'\\n\\n' end,
  case when k > len(ps) then cur when length(cur) + length(ps[k]) < 2000 or cur = '' then null else cur end,
  part + case when k > len(ps) or not (length(cur) + length(ps[k]) < 2000 or cur = '') then 1 else 0 end
 from pk where k <= len(ps) + 1)"""


def _recursive(ctes: str) -> str:
    return ctes.replace("with asm", "with recursive asm", 1).replace(", recursive pk", ", pk")


_CHUNKED = _recursive(_SECTIONS + ", long as (select * from secs where length(body) > 3500)" + _PACK) + f""",
 parts as (select doc, b, 0 part, body from secs where length(body) <= 3500 union all select doc, b, part, {_strip("done")} from pk where done is not null),
 ck as (select doc, row_number() over (partition by doc order by b, part) chunk_no, body from parts where length(body) >= 1000)"""
_ID = "doc || '-chunk' || case when chunk_no < 1000 then lpad(chunk_no::varchar, 3, '0') else chunk_no::varchar end"
_TITLE = r"""array_to_string(list_transform(regexp_extract_all({0}, '\p{{L}}+|[^\p{{L}}]+'), lambda r: replace(upper(r[1]), 'ẞ', 'Ss') || lower(r[2:])), '')"""
_RULE = "select doc, unnest(string_split(text, E'\\n---\\n')) part, unnest(range(1, len(string_split(text, E'\\n---\\n')) + 1))::int page, len(string_split(text, E'\\n---\\n'))::int total_pages from fx_markdown"
_MD = "select doc, string_agg('<!-- Page ' || page || E' -->\\n\\n' || text || E'\\n\\n---\\n\\n', '' order by page) text from fx_pages group by doc"
_LEN = f"length({_strip('text')})"
_KEY_TERMS = "(" + ", ".join(f"'{t}'" for t in TERMS) + ")"

SQL = {
    "p1_split_rule": duck(f"select doc || '-p' || page id, doc, page, total_pages, {_strip('part')} text from ({_RULE})", "fx_markdown"),
    "p1_split_rule_nonempty": duck(f"select * from (select doc || '-p' || page id, doc, page, total_pages, {_strip('part')} text from ({_RULE})) where text != ''", "fx_markdown"),
    "p2_split_comments": duck(
        f"""with md as ({_MD}), cm as (select doc, case when doc like '%0' then regexp_replace(text, '<!-- Page [0-9]+ -->', '', 'g') else text end text from md),
 ps as (select doc, case when contains(text, '<!-- Page') then list_transform(list_filter(regexp_split_to_array(text, '<!-- Page \\d+ -->'), lambda p: {_strip("p")} != ''), lambda p: {_strip("regexp_replace(" + _strip("p") + ", '-+\\z', '')")}) else [{_strip("text")}] end p from cm)
select * from (select doc, len(p)::int total_pages, unnest(range(1, len(p) + 1))::int page, unnest(p) text from ps) where text != ''""",
        "fx_pages",
    ),
    "p4_drop_empty": duck(f"select id, page from fx_pages where {_LEN} > 0", "fx_pages"),
    "p5_route": duck(
        f"""select doc, total_pages, round_even(m, 1) avg_chars_per_page, m >= 100 is_digital, case when m >= 100 then 'digital' else 'ocr' end extraction_method
from (select doc, count(*) total_pages, coalesce(avg(case when page <= 5 then {_LEN} end), 0.0) m from fx_pages group by doc)""",
        "fx_pages",
    ),
    "s8_to_markdown": duck(_MD, "fx_pages"),
    "a1_assemble": duck(_by_doc(""), "fx_pages"),
    "a2_totals": duck("select count(distinct doc) documents, count(*) pages, coalesce(sum(length(text)), 0)::bigint chars, coalesce(avg(length(text)), 0.0) avg_chars_per_page from fx_pages", "fx_pages"),
    "a3_methods": duck("select method, count(*) pages from fx_pages group by method", "fx_pages"),
    "a4_documents": duck("select doc, count(*) pages, sum(length(text))::bigint chars, arg_max(source, page) source, arg_max(method, page) \"method\" from fx_pages group by doc", "fx_pages"),
    "a6_merge_summary": duck("select count(*) records, count(distinct source) sources from fx_pages", "fx_pages"),
    "t4_preview": duck("select doc, page, length(text)::int n_chars, left(text, 500) || case when length(text) > 500 then '...' else '' end preview from fx_pages order by doc, page limit 3", "fx_pages"),
    "u1_union_methods": duck(f"select id, \"method\", source from fx_pages where {_LEN} > 0", "fx_pages"),
    "p6_word_windows": duck(
        f"""with w as (select id, doc, page, source, {_words("text")} w from fx_pages)
select id || '-c' || (k + 1) id, doc, page, (k + 1)::int chunk_id, array_to_string(list_slice(w, k * 68 + 1, k * 68 + 80), ' ') text, source from (select *, unnest(range(0, (len(w) + 67) // 68)) k from w)""",
        "fx_pages",
    ),
    "p6_word_windows_default": duck(
        f"""with w as (select id, doc, page, source, {_words("text")} w from fx_pages)
select id || '-c' || (k + 1) id, doc, page, (k + 1)::int chunk_id, array_to_string(list_slice(w, k * 680 + 1, k * 680 + 800), ' ') text, source from (select *, unnest(range(0, (len(w) + 679) // 680)) k from w)""",
        "fx_pages",
    ),
    "t2_sorted": duck("select doc, count(*) pages, sum(length(text))::bigint chars, arg_max(source, page) source, arg_max(method, page) \"method\" from fx_pages group by doc order by doc", "fx_pages"),
    "f2_greedy_pack": duck(_recursive(f"with asm as ({_by_doc('')}), long as (select doc, 0 b, text body from asm)" + _PACK) + f" select doc, part - 1 part, {_strip('done')} text from pk where done is not null", "fx_pages"),
    "p10_chunk_metadata": duck(
        _CHUNKED + f""", tk as (select doc, chunk_no, unnest(regexp_extract_all(lower(body), '[\\p{{L}}\\p{{N}}_]+')) w, unnest(range(0, len(regexp_extract_all(lower(body), '[\\p{{L}}\\p{{N}}_]+')))) i from ck),
 kw as (select doc, chunk_no, w, count(*) n, min(i) first from tk where w in {_KEY_TERMS} group by doc, chunk_no, w qualify row_number() over (partition by doc, chunk_no order by count(*) desc, min(i)) <= 10),
 kl as (select doc, chunk_no, string_agg(w, ',' order by n desc, first) keywords from kw group by all), sp as (select doc, string_agg(doc || '-p' || page, ',' order by page) source_pages from fx_pages group by doc)
select {_ID} id, coalesce(list_filter(list_transform(string_split(left(body, 200), E'\\n'), lambda l: {_strip("l")}), lambda l: length(l) > 10 and length(l) < 80 and regexp_matches(l, '^\\p{{Lu}}'))[1],
 {_TITLE.format("regexp_replace(regexp_replace(translate(doc, '_-', '  '), '\\d{4}web', '', 'g'), 'chapter\\d+', 'Agricultural Chapter', 'g')")}) topic, coalesce(keywords, '') keywords, source_pages
 from ck left join kl using (doc, chunk_no) join sp using (doc)""",
        "fx_pages",
    ),
    "p7_boundaries": duck(_SECTIONS + " select doc, b::int boundary from bd", "fx_pages"),
    "p8_sections": duck(_SECTIONS + " select doc, length(body)::int n_chars, md5(body) digest from secs", "fx_pages"),
    "p9_packing": duck(_recursive(f"with asm as ({_by_doc('')}), long as (select doc, 0 b, text body from asm)" + _PACK) + f" select doc, part - 1 part, {_strip('done')} text from pk where done is not null", "fx_pages"),
    "p10_semantic_chunks": duck(_CHUNKED + f" select {_ID} id, {_strip('body')} text, doc, chunk_no::int chunk_no, length(body)::int char_count, greatest(1, length(body) - length(translate(body, '.!?', '')))::int sentence_count from ck", "fx_pages"),
    "c1_keywords": duck(
        f"""with t as (select id, unnest(regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}_]+')) w, unnest(range(0, len(regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}_]+')))) i from fx_pages),
 k as (select id, w, count(*) n, min(i) first from t where w in {_KEY_TERMS} group by id, w qualify row_number() over (partition by id order by count(*) desc, min(i)) <= 10)
select p.id, coalesce(string_agg(w, ',' order by n desc, first), '') keywords from fx_pages p left join k on k.id = p.id group by p.id""",
        "fx_pages",
    ),
    "c2_topic": duck(
        f"""select id, coalesce(list_filter(list_transform(string_split(left(text, 200), E'\\n'), lambda l: {_strip("l")}), lambda l: length(l) > 10 and length(l) < 80 and regexp_matches(l, '^\\p{{Lu}}'))[1],
 {_TITLE.format("regexp_replace(regexp_replace(translate(doc || '_2019web-part', '_-', '  '), '\\d{4}web', '', 'g'), 'chapter\\d+', 'Agricultural Chapter', 'g')")}) topic from fx_pages""",
        "fx_pages",
    ),
    "c3_sentences": duck("select id, greatest(1, length(text) - length(translate(text, '.!?', '')))::int sentences from fx_pages", "fx_pages"),
    "c5_normalized": duck(f"select chunk_id, pair_idx, {_strip(f"regexp_replace(regexp_replace(lower(question), '[^\\p{{L}}\\p{{N}}_{WS_IN}]', '', 'g'), '{WS}+', ' ', 'g')")} \"key\" from fx_qa", "fx_qa"),
    "c6_merge_key": duck(f"select chunk_id, pair_idx, regexp_replace({_strip('lower(question)')}, '[^\\p{{L}}\\p{{N}}{WS_IN}]', '', 'g') \"key\" from fx_qa", "fx_qa"),
    "c7_significant_words": duck("select chunk_id, len(list_distinct(regexp_extract_all(lower(text), '[\\p{L}\\p{N}_]{5,}')))::int words from fx_sources", "fx_sources"),
    "c8_tokens": duck(f"select id, floor(len({_words('text')}) * 1.3::double)::int tokens from fx_pages", "fx_pages"),
    "c9_strip_split": duck(f"select id, {_LEN}::int stripped, len({_words('text')})::int words from fx_pages", "fx_pages"),
    "c13_preview": duck("select id, left(text, 500) || case when length(text) > 500 then '...' else '' end preview from fx_pages", "fx_pages"),
    "c2_title_case": duck(f"select id, {_TITLE.format('text')} title from fx_pages", "fx_pages"),
    "j1_page_range": duck(
        _CHUNKED + f""" select {_ID} id, coalesce(string_agg(case when h then page end::varchar, ',' order by page), min(page)::varchar) pages
 from (select doc, chunk_no, page, contains(text, left(body, 100)) or contains(text, right(body, 100)) h from ck join fx_pages using (doc)) group by doc, chunk_no""",
        "fx_pages",
    ),
    "a5_chunk_stats": duck(_CHUNKED + " select count(*) chunks, coalesce(sum(length(body)), 0)::bigint chars, avg(length(body)) avg_chars, min(length(body))::int min_chars, max(length(body))::int max_chars, count(distinct doc) documents from ck", "fx_pages"),
    "j5_chunks_per_doc": duck(_CHUNKED + " select a.doc, count(ck.doc) chunks from asm a left join ck on ck.doc = a.doc group by a.doc", "fx_pages"),
}
