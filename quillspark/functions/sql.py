"""The text functions, word windows, response parsing and paragraph packing for queries written in SQL.

``register`` makes them temporary functions of a session. Scalars and the first two
table functions are SQL themselves and stay in the JVM; packing keeps a state from row
to row, so it is a Python table function over a table that is partitioned by document
and ordered by paragraph, one row a paragraph.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Row, SparkSession
from pyspark.sql.functions import udtf
from pyspark.sql.types import IntegerType, StringType, StructField, StructType
from pyspark.sql.udtf import AnalyzeArgument, AnalyzeResult, OrderingColumn, PartitioningColumn

from .text import WS, WS_IN



def _strip(x: str) -> str:
    return rf"regexp_replace({x}, r'^{WS}+|(?<!{WS}){WS}+\z', '')"


def _words(x: str) -> str:
    return f"filter(split({x}, r'{WS}+', -1), w -> w != '')"



#: name(arguments) and result of the scalar functions.
SCALARS = {
    "ql_strip(t string)": ("string", _strip("t")),
    "ql_words(t string)": ("array<string>", _words("t")),
    "ql_sentences(t string)": ("int", "greatest(1, length(t) - length(translate(t, '.!?', '')))"),
    "ql_normalized(t string)": ("string", _strip(rf"regexp_replace(regexp_replace(lower(t), r'[^\p{{L}}\p{{N}}_{WS_IN}]', ''), r'{WS}+', ' ')")),
    "ql_merge_key(t string)": ("string", rf"regexp_replace({_strip('lower(t)')}, r'[^\p{{L}}\p{{N}}{WS_IN}]', '')"),
    "ql_significant_words(t string)": ("array<string>", r"array_distinct(regexp_extract_all(lower(t), r'[\p{L}\p{N}_]{5,}', 0))"),
    "ql_tokens(t string)": ("int", f"cast(floor(size({_words('t')}) * 1.3D) as int)"),
    "ql_preview(t string, n int)": ("string", "concat(substring(t, 1, n), case when length(t) > n then '...' else '' end)"),
    "ql_keywords(t string, terms array<string>, k int)": (
        "array<string>",
        r"""transform(slice(array_sort(transform(array_distinct(filter(regexp_extract_all(lower(t), r'[\p{L}\p{N}_]+', 0), w -> array_contains(terms, w))),
  x -> named_struct('n', -size(filter(regexp_extract_all(lower(t), r'[\p{L}\p{N}_]+', 0), w -> w = x)), 'at', array_position(regexp_extract_all(lower(t), r'[\p{L}\p{N}_]+', 0), x), 'term', x))), 1, k), y -> y.term)""",
    ),
}
#: name(arguments), columns and query of the table functions; used as ``lateral``.
TABLES = {
    "ql_word_windows(t string, n int, overlap int)": (
        "chunk_id int, text string",
        f"""select cast(place + 1 as int), own from posexplode(element_at(transform(array({_words("t")}),
  ws -> case when size(ws) > 0 then transform(sequence(0, size(ws) - 1, greatest(1, n - overlap)), s -> array_join(slice(ws, s + 1, n), ' ')) end), 1)) as w(place, own)""",
    ),
    "ql_pages(t string)": ("page int, total_pages int, text string", rf"select cast(place + 1 as int), size(split(t, '\\n---\\n', -1)), {_strip('part')} from posexplode(split(t, '\\n---\\n', -1)) as p(place, part)"),
}


@udtf
class PackParagraphs:
    """ql_pack(table(select doc, n, text ...), target): a document's paragraphs (by n) packed greedily into parts under the target.

    Partitioned by the table's first column and ordered by its second, whatever their names; the third is the text.
    """

    @staticmethod
    def analyze(rows: AnalyzeArgument, target: AnalyzeArgument) -> AnalyzeResult:
        if not rows.isTable or len(rows.dataType.fields) != 3:
            raise ValueError("ql_pack takes a table of document, number and text")
        if not isinstance(target.value, int) or target.value < 1:
            raise ValueError("ql_pack takes a target of one character or more")
        doc, n, _ = rows.dataType.fields
        schema = StructType([StructField(doc.name, doc.dataType), StructField("part", IntegerType()), StructField("text", StringType())])
        return AnalyzeResult(schema=schema, partitionBy=[PartitioningColumn(doc.name)], orderBy=[OrderingColumn(n.name)])

    def __init__(self) -> None:
        self.doc, self.part, self.held, self.chars = None, 0, None, 0

    def eval(self, row: Row, target: int) -> Iterator[tuple]:
        self.doc, text = row[0], row[2] or ""
        if self.held is not None and self.chars + len(text) >= target:
            yield self._given()
        if self.held is None:
            self.held, self.chars = [], 0
        self.held.append(text)
        self.chars += len(text) + 2

    def _given(self) -> tuple:
        out = (self.doc, self.part, "\n\n".join(self.held).strip())
        self.part, self.held = self.part + 1, None
        return out

    def terminate(self) -> Iterator[tuple]:
        if self.held is not None:
            yield self._given()


def register(spark: SparkSession) -> list[str]:
    """Makes all functions of this module temporary functions of the session; returns their names."""
    for head, (kind, body) in SCALARS.items():
        spark.sql(f"create or replace temporary function {head} returns {kind} return {body}")
    for head, (columns, query) in TABLES.items():
        spark.sql(f"create or replace temporary function {head} returns table ({columns}) return {query}")
    spark.udtf.register("ql_pack", PackParagraphs)
    return [head.split("(")[0] for head in (*SCALARS, *TABLES)] + ["ql_pack"]
