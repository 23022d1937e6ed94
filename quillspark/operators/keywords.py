"""Keywords from large dictionaries of words and phrases: one pass a text, however many terms.

A term is one or more lower-case ASCII words of four letters or more with single spaces
between them; others can match nothing and are left out, as in ``extract_keywords``,
whose result for words this equals. In a text a term stands between characters that are
no word's, in any case, its words apart by white space of any kind; every occurrence
counts, also inside a longer term. Ties go by first appearance, then by the shorter term.

A dictionary of at most ``BROADCAST_BYTES`` is given to every task as an Aho-Corasick
automaton. A larger one stays a table, and the texts' words and word sequences of the
lengths that its terms have are joined with it; the result is the same.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import WS_IN

#: Bytes of all terms up to which their automaton is broadcast.
BROADCAST_BYTES = 64 << 20
TERM = "^[a-z]{4,}( [a-z]{4,})*$"
_space = re.compile("[" + re.sub(r"\\x\{([0-9a-f]+)\}", lambda m: chr(int(m[1], 16)), WS_IN) + "]+")


def _is_word(c: str) -> bool:
    return c.isalnum() or c == "_"


def plain_text(text: str | None) -> str:
    """Lower case, single spaces."""
    return _space.sub(" ", (text or "").lower())


def occurrences(automaton, text: str) -> dict[str, list[int]]:
    """term: [times, first place] in a plain text."""
    found: dict[str, list[int]] = {}
    for end, term in automaton.iter(text):
        start = end + 1 - len(term)
        if (start == 0 or not _is_word(text[start - 1])) and (end + 1 == len(text) or not _is_word(text[end + 1])):
            own = found.setdefault(term, [0, start])
            own[0] += 1
            own[1] = min(own[1], start)
    return found


def sequences(text: str, lengths: list[int]) -> list[tuple[str, int]]:
    """(words, place) of all sequences of so many ASCII words of four letters or more in a plain text."""
    out = []
    for n in lengths:
        form = re.compile(rf"(?<![\w])(?=([a-z]{{4,}}(?: [a-z]{{4,}}){{{n - 1}}})(?![\w]))")
        out += [(m[1], m.start()) for m in form.finditer(text)]
    return out


def usable(terms: DataFrame) -> DataFrame:
    """The distinct terms that can match."""
    return terms.select("term").filter(F.col("term").rlike(TERM)).distinct()


def _automaton(terms: list[str]):
    import ahocorasick

    made = ahocorasick.Automaton()
    for t in terms:
        made.add_word(t, t)
    made.make_automaton()
    return made


def keywords(docs: DataFrame, terms: DataFrame, key: str = "id", top_k: int = 10, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """(key, keywords): the most frequent terms (term) in each text of docs (key, text), key being unique."""
    own = usable(terms)
    size, words = own.agg(F.coalesce(F.sum(F.octet_length("term")), F.lit(0)), F.collect_set(F.size(F.split("term", " ")))).first()
    rows = docs.select(F.col(key).alias("key"), "text")
    if size <= broadcast_bytes:
        held = docs.sparkSession.sparkContext.broadcast([r.term for r in own.collect()])

        @F.pandas_udf("array<string>")
        def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            automaton = _automaton(held.value)
            for texts in batches:
                out = []
                for text in texts:
                    found = occurrences(automaton, plain_text(text)) if held.value else {}
                    out.append([t for t, _ in sorted(found.items(), key=lambda x: (-x[1][0], x[1][1], len(x[0])))[:top_k]])
                yield pd.Series(out)

        return rows.select(F.col("key").alias(key), run("text").alias("keywords"))

    lengths = sorted(words)

    @F.pandas_udf("array<struct<term:string,place:int>>")
    def cut(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([[{"term": t, "place": p} for t, p in sequences(plain_text(text), lengths)] for text in texts])

    # counted in its text before anything moves
    each = rows.select("key", F.inline(cut("text"))).groupBy("key", "term").agg(F.count(F.lit(1)).alias("n"), F.min("place").alias("place"))
    met = each.join(own, "term")
    rank = F.row_number().over(Window.partitionBy("key").orderBy(F.desc("n"), "place", F.length("term")))
    best = met.withColumn("rank", rank).filter(F.col("rank") <= top_k).groupBy("key").agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", "term"))), lambda x: x["term"]).alias("keywords"))
    none = F.expr("cast(array() as array<string>)")
    return rows.select("key").join(best, "key", "left").select(F.col("key").alias(key), F.coalesce("keywords", none).alias("keywords"))
