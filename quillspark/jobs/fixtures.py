"""Views over the given tables in the shape of the corpus, in Spark's SQL and in DuckDB's."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TERMS = ["that", "with", "this", "from", "rewh", "orre", "thatin", "ononst", "inoran", "hehely", "orantion", "tion"]
TYPES = "'factual','conceptual','procedural','comparative','scenario','analytical'"
STARTS = "'What is','Why does','How do you','Compare','If','Evaluate'"

_HEAD = """case when doc_id % 3 = 0 then {e}'\\nFIELD MANAGEMENT NOTES\\n' when doc_id % 7 = 1 then {e}'\\n4.2 Hybrid Selection Basics\\n'
  when doc_id % 5 = 2 then {e}'\\nWeed Control Strategies\\n' else '' end"""
_PAGES = """select doc_id, concat('chapter', lpad(cast(doc_id {div} 10 as {string}), 5, '0')) doc, cast(doc_id % 10 + 1 as int) page, source,
  case when doc_id % 11 = 3 then 'ocr' else 'digital' end method, concat({head}, replace(text, {e}'.\\n', {e}'.\\n\\n')) text from {documents}
 union all
 select doc_id, concat('chapter', lpad(cast(doc_id {div} 10 as {string}), 5, '0')), cast(doc_id % 10 + 11 as int), source, 'digital', {e}'  \\n' from {documents} where doc_id % 37 = 5
 union all
 select doc_id, concat('scan', lpad(cast(doc_id {div} 10 as {string}), 5, '0')), cast(doc_id % 10 + 1 as int), source, 'ocr', split_part(text, ' ', 1) from {documents} where (doc_id {div} 10) % 9 = 4"""
_QUESTION = """case when (doc_id + i) % 41 = 0 then concat('Q: ', st, ' ', lower(w), '?') when (doc_id + i) % 43 = 0 then concat(st, ' ___ ', lower(w), '?')
  when (doc_id + i) % 47 = 0 then 'What is it now?' when (doc_id + i) % 53 = 0 then concat(st, ' ', lower(w)) else concat(st, ' ', lower(w), '?') end"""


def _spark(sql: str, spark: SparkSession, **tables: DataFrame) -> DataFrame:
    return spark.sql(sql, **tables)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fx_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as pages of ten-page documents, with headers; beside them blank pages, and documents of a word a page as a poor scan gives. id is added."""
    sql = _PAGES.format(div="div", string="string", e="", head=_HEAD.format(e=""), documents="{documents}")
    return _spark(sql, spark, documents=_table(spark, sf_dir, "documents")).selectExpr("*", "format_string('%s-p%d', doc, page) id")


def fx_markdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One text for each document, pages between rules."""
    return _spark("select doc, array_join(transform(array_sort(collect_list(struct(page, text))), x -> x.text), '\\n---\\n') text from {pages} group by doc", spark, pages=fx_pages(spark, sf_dir))


def fx_qa(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A pair for each sentence of each document, some with faults; beside them pairs whose chunk has no source."""
    sql = f"""with a as (select doc_id, split(text, '\\\\. ') a from {{documents}}),
 e as (select doc_id, a, i from a lateral view explode(sequence(1, size(a))) x as i),
 b as (select doc_id, i, element_at(array({TYPES}), cast((doc_id + i) % 6 + 1 as int)) type, element_at(array('basic','intermediate','advanced'), cast((doc_id + 2 * i) % 3 + 1 as int)) difficulty,
  cast(doc_id % 5 + 1 as int) batch_id, element_at(array({STARTS}), cast((doc_id + i) % 6 + 1 as int)) st, array_join(slice(split(a[i - 1], ' '), 1, 6), ' ') w,
  concat(a[i - 1], '. ', coalesce(try_element_at(a, i + 1), ''), '.') answer from e),
 q as (select doc_id chunk_id, doc_id chunk_ord, i pair_idx, type, difficulty, batch_id, answer, {_QUESTION} question from b)
select * from q union all select -1 - chunk_id, -1 - chunk_id, pair_idx, type, difficulty, batch_id, answer, question from q where chunk_id % 97 = 0"""
    return _spark(sql, spark, documents=_table(spark, sf_dir, "documents"))


def fx_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The chunks' texts."""
    return _spark("select doc_id chunk_id, text from {documents}", spark, documents=_table(spark, sf_dir, "documents"))


def fx_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A generator's replies, one a chunk, in all wrappings."""
    sql = """with j as (select chunk_id, batch_id, to_json(transform(array_sort(collect_list(struct(pair_idx, question, answer, difficulty, type))),
   x -> struct(x.question, x.answer, x.difficulty, x.type))) j from {qa} group by chunk_id, batch_id)
select chunk_id, batch_id, case abs(chunk_id) % 7 when 0 then concat('```json\\n', j, '\\n```') when 1 then concat('```\\n', j, '\\n```') when 2 then concat('  ', j, '  ')
  when 4 then left(j, length(j) - 5) when 5 then case abs(chunk_id) div 7 % 4 when 0 then '{"question": "alone"}' when 1 then '' when 2 then '[]' else 'I cannot do that.' end else j end response from j"""
    return _spark(sql.replace('{"question": "alone"}', '{{"question": "alone"}}'), spark, qa=fx_qa(spark, sf_dir))


def fx_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A user's turn and the assistant's after it."""
    sql = """select conv_id, turn, text question, next_text answer from (select *, lead(text) over w next_text, lead(role) over w next_role from {conversations}
 window w as (partition by conv_id order by turn)) where role = 'user' and next_role = 'assistant'"""
    return _spark(sql, spark, conversations=_table(spark, sf_dir, "conversations"))


def fx_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A call log."""
    sql = """select event_id, event_type api_key, unix_micros(cast(ts as timestamp)) div 300 us, event_type = 'error' failed,
 cast(300 + event_id % 700 as int) prompt_words, cast(value * 10 as int) response_words from {events}"""
    return _spark(sql, spark, events=_table(spark, sf_dir, "events"))


#: The same views for DuckDB, by name.
DUCK = {
    "fx_pages": "select *, doc || '-p' || page id from (" + _PAGES.format(div="//", string="varchar", e="E", head=_HEAD.format(e="E"), documents="documents") + ")",
    "fx_markdown": "select doc, string_agg(text, E'\\n---\\n' order by page) text from fx_pages group by doc",
    "fx_qa": f"""with a as (select doc_id, string_split(text, '. ') a from documents), e as (select doc_id, a, unnest(range(1, len(a) + 1))::int i from a),
 b as (select doc_id, i, ([{TYPES}])[(doc_id + i) % 6 + 1] type, (['basic','intermediate','advanced'])[(doc_id + 2 * i) % 3 + 1] difficulty, (doc_id % 5 + 1)::int batch_id,
  ([{STARTS}])[(doc_id + i) % 6 + 1] st, array_to_string(list_slice(string_split(a[i], ' '), 1, 6), ' ') w, a[i] || '. ' || coalesce(a[i + 1], '') || '.' answer from e),
 q as (select doc_id chunk_id, doc_id chunk_ord, i pair_idx, type, difficulty, batch_id, answer, {_QUESTION} question from b)
 select * from q union all select -1 - chunk_id, -1 - chunk_id, pair_idx, type, difficulty, batch_id, answer, question from q where chunk_id % 97 = 0""",
    "fx_sources": "select doc_id chunk_id, text from documents",
    "fx_responses": """with j as (select chunk_id, batch_id, '[' || string_agg(to_json({'question': question, 'answer': answer, 'difficulty': difficulty, 'type': type})::varchar, ',' order by pair_idx) || ']' j from fx_qa group by all)
 select chunk_id, batch_id, case abs(chunk_id) % 7 when 0 then E'```json\\n' || j || E'\\n```' when 1 then E'```\\n' || j || E'\\n```' when 2 then '  ' || j || '  ' when 4 then left(j, length(j) - 5)
  when 5 then case abs(chunk_id) // 7 % 4 when 0 then '{"question": "alone"}' when 1 then '' when 2 then '[]' else 'I cannot do that.' end else j end response from j""",
    "fx_chat": """select conv_id, turn, text question, next_text answer from (select *, lead(text) over w next_text, lead(role) over w next_role from conversations
 window w as (partition by conv_id order by turn)) where role = 'user' and next_role = 'assistant'""",
    "fx_calls": """select event_id, event_type api_key, epoch_us(ts) // 300 us, event_type = 'error' failed, (300 + event_id % 700)::int prompt_words, trunc(value * 10)::int response_words from events""",
}
_NEEDS = {"fx_markdown": ["fx_pages"], "fx_responses": ["fx_qa"]}


def duck(query: str, *views: str) -> str:
    """A DuckDB query over some of the views."""
    names: list[str] = []
    for view in views:
        for v in [*_NEEDS.get(view, []), view]:
            if v not in names:
                names.append(v)
    listed = ",\n".join(f"{v} as ({DUCK[v]})" for v in names)
    rest = query.lstrip()
    for head in ("with recursive ", "with "):
        if rest.startswith(head):
            return f"{head}{listed},\n{rest[len(head):]}"
    return f"with {listed}\n{rest}"
