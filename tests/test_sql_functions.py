"""The functions for SQL against the column functions and operators."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from quillspark.functions import sql, text
from quillspark.jobs import fixtures as X
from quillspark.operators import chunks as C
from quillspark.operators import pages as P

SMALL = "/root/testdata/sf0.001"
ODD = ["", " a\t", "What_is  X?", " é È. ok!\n", "soil Soil crops corn corn seed", "it's 3abc", "\x1c x \x85"]


@pytest.fixture(scope="module")
def session(spark):
    sql.register(spark)
    return spark


def test_scalars(session):
    rows = session.createDataFrame([(k, t) for k, t in enumerate(ODD)], "id int, text string").union(X.fx_pages(session, SMALL).selectExpr("100 + doc_id", "text"))
    t = F.col("text")
    want = rows.select("id", text.strip(t), text.split_words(t), text.count_sentences(t), text.normalize_question(t), text.merge_key(t), F.size(text.significant_words(t)), text.estimated_tokens(t), text.preview(t, 20), text.extract_keywords(t, ["corn", "soil", "that", "with"], 3))
    got = session.sql("select id, ql_strip(text), ql_words(text), ql_sentences(text), ql_normalized(text), ql_merge_key(text), size(ql_significant_words(text)), ql_tokens(text), ql_preview(text, 20), ql_keywords(text, array('corn', 'soil', 'that', 'with'), 3) from {rows}", rows=rows)
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, map(tuple, want.collect())))


def test_table_functions(session):
    pages = X.fx_pages(session, SMALL)
    got = session.sql("select id, w.chunk_id, w.text from {pages} p, lateral ql_word_windows(p.text, 80, 12) w", pages=pages)
    want = C.word_window_chunks(pages, 80, 12).select(F.regexp_replace("id", "-c[0-9]+$", ""), "chunk_id", "text")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    markdown = X.fx_markdown(session, SMALL)
    got = session.sql("select doc, x.page, x.total_pages, x.text from {m} m, lateral ql_pages(m.text) x", m=markdown)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, P.split_pages_rule(markdown).select("doc", "page", "total_pages", "text").collect()))


def test_packing(session):
    docs = P.assemble_documents(X.fx_pages(session, SMALL))
    got = session.sql("select * from ql_pack(table(select doc, n, paragraph from {docs}, lateral posexplode(split(text, '\\n\\n', -1)) as x(n, paragraph)), 2000)", docs=docs)
    assert got.columns == ["doc", "part", "text"]
    want = docs.select("doc", F.posexplode(C.pack_paragraphs(F.col("text"))).alias("part", "text"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    with pytest.raises(Exception, match="one character or more"):
        session.sql("select * from ql_pack(table(select 'd' doc, 1 n, 'x' t), 0)").collect()
