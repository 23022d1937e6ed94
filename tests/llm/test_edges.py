"""Rows and pages that operators once got wrong."""

from __future__ import annotations

from pyspark.sql import functions as F

from quillspark.llm import html_template, pii, token_counts


def test_long_ids_beside_nulls(spark):
    rows = [(2**53 + 1, "write to a.b@c.org now"), (None, "none"), (2**53 + 3, None), (2**63 - 1, "x")]
    got = pii.find_personal_data(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)).select("doc_id", F.size("base").alias("n")).collect()
    assert {(r.doc_id, r.n) for r in got} == {(2**53 + 1, 1), (None, 0), (2**53 + 3, 0), (2**63 - 1, 0)}


def told(spark, html):
    return html_template.main_text(spark.createDataFrame([(1, "http://a.com/x", html)], "page_id long, url string, html string")).first().text


def test_a_form_around_the_page(spark):
    """As some servers write them: the whole body in one form."""
    fields = '<input type="hidden" name="v"><label>Name</label><select><option>one</option></select><button>Go</button>'
    page = f'<html><body><form id="aspnetForm" action="x">{fields}<div class="menu"><a href="/">home</a></div>%s<div id="footer">imprint</div></form></body></html>'
    assert told(spark, page % "<article><h1>Title</h1><p>All of it.</p></article>") == "Title\nAll of it."
    assert told(spark, page % "<div><h1>Title</h1><p>All of it.</p></div>") == "Title\nAll of it."
    small = "<body><article><p>A long enough story of it all.</p><form><p>Mail us</p></form></article><form class=search><p>Find it</p></form></body>"
    assert told(spark, small) == "A long enough story of it all."


def test_an_article_keeps_its_blocks(spark):
    blocks = ['<div class="search-results"><p>results of the search party</p></div>', '<div class="header-image"><p>what the image shows</p></div>', '<section id="discussion"><p>the discussion of it</p></section>', "<p>plain</p>"]
    page = f'<body><div class="search-results"><p>outside</p></div><article>{"".join(blocks)}<div class="comments"><p>first!</p></div><div class="ad box"><p>buy</p></div></article></body>'
    assert told(spark, page) == "results of the search party\nwhat the image shows\nthe discussion of it\nplain"


def test_classes_do_not_empty_a_page(spark):
    assert told(spark, '<body class="x"><div class="page-header"><p>all there is</p></div><nav>menu</nav></body>') == "all there is"
    assert told(spark, "<body><nav>menu</nav><footer>f</footer></body>") == ""


def test_columns_of_edited_rows(spark):
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.json")
    docs = spark.createDataFrame([(1, "call 555 1234 now", "t", "e", "r")], "doc_id long, text string, _t string, _e string, row string")
    got = token_counts.apply_edits(token_counts.build_trees(docs, path), path, token_counts.redactions("[0-9]+", "#")).first()
    assert (got._t, got._e, got["row"], got.text, got.n_edits) == ("t", "e", "r", "call # # now", 2)


def test_short_items_inside_long_texts(spark):
    from quillspark.llm import decontaminate

    rows = [(1, "word " * 50 + "Three short words, here " + "more " * 50), (2, "three short words"), (3, "three short x words"), (4, "alone"), (5, "it stands alone here now and on"), (6, None), (7, "a b c d e f g")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    items = spark.createDataFrame([(10, "three short words"), (11, "Alone"), (12, "a b c d e"), (13, "")], "item_id long, text string")
    for size in (decontaminate.BROADCAST_SHINGLES, 0):
        got = decontaminate.search_benchmark(docs, items, size).select("doc_id", F.inline("hits")).collect()
        assert sorted((r.doc_id, r.item_id) for r in got) == [(1, 10), (2, 10), (4, 11), (5, 11), (7, 12)], size
