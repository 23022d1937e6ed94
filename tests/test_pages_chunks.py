"""Hand-written rows for pages and chunks."""

from __future__ import annotations

from pyspark.sql import functions as F

from quillspark.functions.text import estimated_tokens, extract_keywords, extract_topic, merge_key, normalize_question, strip, title_case
from quillspark.operators import chunks as C
from quillspark.operators import pages as P
from quillspark.sources import io as S


def one(spark, text, make, **more):
    row = {"text": text, **more}
    return spark.createDataFrame([row], ", ".join(f"{k} string" for k in row)).select(make(F.col("text")).alias("x")).first().x


def test_page_rule(spark):
    md = spark.createDataFrame([("d", "a\n---\n\n---\nb")], "doc string, text string")
    assert [(r.page, r.text, r.total_pages) for r in P.split_pages_rule(md).orderBy("page").collect()] == [(1, "a", 3), (2, "", 3), (3, "b", 3)]
    assert [(r.id, r.page) for r in P.split_pages_rule(md, drop_empty=True).orderBy("page").collect()] == [("d-p1", 1), ("d-p3", 3)]


def test_page_comments(spark):
    text = "<!-- Page 1 -->\n\none ---\n<!-- Page 2 -->\n ----- \n<!-- Page 7 -->two"
    md = spark.createDataFrame([("d", text), ("e", " plain --- "), ("f", " ")], "doc string, text string")
    assert sorted((r.doc, r.page, r.text, r.total_pages) for r in P.split_pages_comment(md).collect()) == [("d", 1, "one", 3), ("d", 3, "two", 3), ("e", 1, "plain ---", 1)]


def test_routing(spark):
    rows = [("a", p, "x" * 100) for p in range(1, 4)] + [("b", 1, "x" * 99)] + [("c", p, "x" * (1 if p < 6 else 900)) for p in range(1, 9)] + [("d", 1, "x" * 250), ("d", 2, " \n")]
    got = {r.doc: (r.avg_chars_per_page, r.is_digital) for r in P.route_documents(spark.createDataFrame(rows, "doc string, page int, text string")).collect()}
    assert got == {"a": (100.0, True), "b": (99.0, False), "c": (1.0, False), "d": (125.0, True)}


def test_markdown_round_trip(spark):
    pages = spark.createDataFrame([("d", 2, "b"), ("d", 1, "a")], "doc string, page int, text string")
    md = P.pages_to_markdown(pages)
    assert md.first().text == "<!-- Page 1 -->\n\na\n\n---\n\n<!-- Page 2 -->\n\nb\n\n---\n\n"
    assert sorted((r.page, r.text) for r in P.split_pages_comment(md).collect()) == [(1, "a"), (2, "b")]


def test_word_windows(spark):
    rows = [(str(n), "d", 1, "s", " ".join(f"w{i}" for i in range(n))) for n in (0, 1, 680, 681, 800, 801, 1480)]
    got: dict = {}
    for r in C.word_window_chunks(spark.createDataFrame(rows, "id string, doc string, page int, source string, text string")).collect():
        got.setdefault(r.id.split("-c")[0], {})[r.chunk_id] = len(r.text.split())
    assert got == {"1": {1: 1}, "680": {1: 680}, "681": {1: 681, 2: 1}, "800": {1: 800, 2: 120}, "801": {1: 800, 2: 121}, "1480": {1: 800, 2: 800, 3: 120}}


def test_boundaries(spark):
    text = "\nALL CAPS HEADER\nSECOND CAPS HEADER\nbody\n2.1 Numbered Title here\nmore\nTitle Case Line\nNext one\nTitle Case Line\nlower"
    got = one(spark, text, C.section_boundaries)
    assert got == [0, text.index("\n2.1"), text.index("\nTitle Case Line\nNext"), len(text)]


def test_packing(spark):
    long = "z" * 2500
    parts = one(spark, "\n\n".join(["a" * 900, "b" * 900, "c" * 300, long, "", "d"]), C.pack_paragraphs)
    assert [len(p) for p in parts] == [1802, 300, 2500, 1]
    assert parts[0] == "a" * 900 + "\n\n" + "b" * 900


def test_section_lengths(spark):
    def kept(n):
        pages = spark.createDataFrame([("p", "d", 1, "s", "x" * n)], "id string, doc string, page int, source string, text string")
        return [(r.id, r.char_count, r.page_range, r.source_pages) for r in C.semantic_chunks(pages).collect()]

    assert kept(999) == []
    assert kept(1000) == [("d-chunk001", 1000, [1], ["p"])]
    assert kept(3500)[0][1] == 3500
    assert kept(3501)[0][1] == 3501  # one long paragraph stays whole
    assert C.chunk_stats(C.semantic_chunks(spark.createDataFrame([], "id string, doc string, page int, source string, text string"))).first().avg_chars is None


def test_topic(spark):
    topic = lambda text, doc: one(spark, text, lambda t: extract_topic(t, F.col("doc")), doc=doc)
    assert topic("short\nA Title Of Eleven\n", "d") == "A Title Of Eleven"
    assert topic("A" * 10 + "\n" + "b" * 20, "chapter02_2019web") == "Agricultural Chapter "
    assert topic("A" * 80, "it's-3abc") == "It'S 3Abc"
    assert topic("A" * 79, "x") == "A" * 79


def test_text_functions(spark):
    assert one(spark, "What_is  X?", normalize_question) == "what_is x" and one(spark, "What_is  X?", merge_key) == "whatis  x"
    assert one(spark, "?!", merge_key) == "" and one(spark, " \n a\t", strip) == "a"
    assert one(spark, "soil Soil corn crops é corn seed", lambda t: extract_keywords(t, top_k=3)) == ["soil", "corn", "seed"]
    assert one(spark, "it's 3abc", title_case) == "It'S 3Abc" and one(spark, "a b c", estimated_tokens) == 3


def test_files(spark, tmp_path):
    (tmp_path / "in" / "sub").mkdir(parents=True)
    (tmp_path / "in" / "a.md").write_text("text of a\nline")
    (tmp_path / "in" / "sub" / "b.md").write_text("b")
    (tmp_path / "in" / "sub" / "b_metadata.json").write_text("{}")
    (tmp_path / "in" / "x.jsonl").write_text('{"id": "1", "text": "é"}\n\n{"id": "2"}\n')
    (tmp_path / "in" / "x.json").write_text('[{"id": "1"},\n {"id": "2"}]')
    (tmp_path / "in" / "my.file.pdf").write_bytes(b"0" * 3145728)
    root = str(tmp_path / "in")
    md = S.read_markdown(spark, root)
    assert sorted((r.doc, r.text) for r in md.collect()) == [("a", "text of a\nline"), ("b", "b")]
    assert [r.doc for r in S.with_metadata_file(spark, md, root).collect()] == ["b"]
    assert S.read_jsonl(spark, f"{root}/x.jsonl", "id string, text string").count() == 2 == S.read_json_array(spark, f"{root}/x.json", "id string").count()
    assert S.merge_jsonl(spark, root).count() == 2
    assert [(r.name, r.stem, r.size_mb) for r in S.list_documents(spark, root).collect()] == [("my.file.pdf", "my.file", 3.0)]
    out = str(tmp_path / "out")
    S.write_jsonl(spark.createDataFrame([("é", None)], "a string, b string").coalesce(1), out)
    assert [p.read_text() for p in (tmp_path / "out").glob("part*")] == ['{"a":"é","b":null}\n']


def test_sections_are_looked_for_once(spark):
    """Each form of header is searched for once a document: the explosion brings no filter along that would look for all sections anew."""
    docs = spark.createDataFrame([("d", "a\nA LONG HEADER LINE\n" + "x" * 1200), ("e", ""), ("f", "short")], "doc string, text string")
    found = C.sections(docs.groupBy("doc").agg(F.max("text").alias("text")))
    assert found._jdf.queryExecution().optimizedPlan().toString().count("regexp_extract_all(") == len(C.HEADERS)
    assert [(r.doc, r.section, len(r.text)) for r in found.collect()] == [("d", 0, 1220)]
