"""Quality rules: base counts, and divergence from language references.

A language's reference holds two histograms over all its documents that pass the
base rules: characters by class, and common words (lower case, edge punctuation off),
a bin for each of the ``RANKS[-1]`` most frequent words with a letter and one for all
others. A document is rejected if its own histogram of characters lies over
``MAX_CHAR_DISTANCE`` from its language's by Jensen-Shannon distance (base 2, 0 to
1), or if its common words do, which are looked at twice. First by rank, bins up to
``RANKS[0]``, up to ``RANKS[1]`` and the others pooled, as a text of some dozens of words
has each single word too seldom: over ``MAX_WORD_SHARE`` of the distance at which a
text without any common word lies. Then word by word: the divergence (the distance's
square) less what chance alone gives a text of as many words drawn from the
reference, over ``MAX_WORD_EXCESS`` of the divergence of a text without any common
word. So the right share of the wrong common words does not pass in a text long
enough to tell. Documents under ``MIN_WORDS`` words are left to the base rules, as are
languages whose reference has under ``MIN_REFERENCE`` words.

References are counted over the whole table: words are added up in a task, up to
``HELD`` at a time, then by Spark. They are a table of one short row for each
language. Up to ``MOST_LANGUAGES`` of them are held by every task; any more are
joined to the documents.

Defined cases: a null or empty text has no words and fails the base rules; a null
language is a language of its own; ties in word frequency go by code point;
repeated rows are judged alike and count each time in the references; a long text is
judged by the same shares as a short one; an empty table gives no rows; columns of
the input may have any name, those named like an added one are replaced.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import join_counted, packed, saved, table

#: Common words by rank: up to the first, up to the second; the last is their number.
RANKS = (10, 40)
#: References held by every task, at most, and words that a task counts at a time.
MOST_LANGUAGES = 10_000
HELD = 50_000
#: Words that a task sends at a time.
SENT = 20_000
#: Guards: words of a document, and of a language, from which histograms are compared.
MIN_WORDS = 30
MIN_REFERENCE = 1000
#: Jensen-Shannon distance of characters above which a document is rejected; of words by rank that distance, and word by word
#: the divergence beyond chance, as shares of those of a text without common words.
MAX_CHAR_DISTANCE = 0.30
MAX_WORD_SHARE = 0.70
MAX_WORD_EXCESS = 0.60
#: Base rules: fewest words, and most words in repeated windows (in a hundred).
FEWEST_WORDS = 10
MOST_REPEATED = 20
WINDOW = 5

SPACE, SYMBOLS, EDGE = b" \t\n\x0b\x0c\r", b"#*$%&|<>", b".,;:!?'\"()-"
#: Character classes: a-z, A-Z, digits, white space, punctuation, other ASCII, all beyond ASCII.
CLASSES = 7
_CLASS = np.full(256, 6, "u1")
_CLASS[:128] = 5
_CLASS[ord("a") : ord("z") + 1], _CLASS[ord("A") : ord("Z") + 1], _CLASS[ord("0") : ord("9") + 1] = 0, 1, 2
_CLASS[list(SPACE)], _CLASS[list(EDGE)] = 3, 4
_CLASS[128:192] = 7  # later bytes of a character

FEATURES = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, char_distance double, word_distance double, word_excess double"


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a window of WINDOW words found twice or more."""
    n = len(words) - WINDOW + 1
    order = dict.fromkeys(words)
    if n < 2 or len(order) == len(words):
        return 0
    order = dict(zip(order, range(len(order))))
    ids = np.fromiter(map(order.__getitem__, words), "int64", len(words))
    _, pair, counts = np.unique(ids[:-1] * len(order) + ids[1:], return_inverse=True, return_counts=True)
    again = counts[pair] > 1
    at = np.flatnonzero(again[:n] & again[1 : n + 1] & again[2 : n + 2] & again[3 : n + 3])
    if len(at) < 2:
        return 0
    _, four = np.unique(pair[at] * len(counts) + pair[at + 2], return_inverse=True)
    _, five, counts = np.unique(four * len(order) + ids[at + 4], return_inverse=True, return_counts=True)
    steps = np.zeros(len(words) + 1, "int64")
    hit = at[counts[five] > 1]
    steps[hit] += 1
    steps[hit + WINDOW] -= 1
    return int(np.count_nonzero(np.cumsum(steps)))


def base(text: str | None) -> tuple[list[bytes], bytes, tuple[int, int, int, int, int, bool]]:
    """Words, bytes and base counts of a text."""
    text = text or ""
    data = text.encode("utf-8", "surrogatepass")
    words = data.split()
    lines = [x for x in data.split(b"\n") if x.strip()]
    repeat = repeated_words(words)
    spaces, symbols = len(data) - len(data.translate(None, SPACE)), len(data) - len(data.translate(None, SYMBOLS))
    failed = len(words) < FEWEST_WORDS or 100 * repeat > MOST_REPEATED * len(words)
    return words, data, (len(words), len(text) - spaces, symbols, len(lines) - len(set(lines)), repeat, failed)


def char_classes(data: bytes) -> np.ndarray:
    return np.bincount(_CLASS[np.frombuffer(data, "u1")], minlength=CLASSES + 1)[:CLASSES]


def _has_letter(word: bytes) -> bool:
    return any(c >= 128 or 97 <= c <= 122 for c in word)


def js_distance(p: np.ndarray, q: np.ndarray) -> float:
    """Jensen-Shannon distance, base 2, of two histograms."""
    p, q = p / p.sum(), q / q.sum()
    m = (p + q) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        total = np.where(p > 0, p * np.log2(p / m), 0).sum() + np.where(q > 0, q * np.log2(q / m), 0).sum()
    return float(np.sqrt(max(0.0, total / 2)))


LANGUAGE = ["coalesce(cast(lang as string), '') lang", "lang is not null known"]


class Reference:
    """What documents of a language are held against."""

    def __init__(self, chars, words, counts, total: int):
        self.chars, self.total = np.asarray(chars, float), total
        self.bins = {w: k for k, w in enumerate(words)}
        self.words = np.array([*counts, total - sum(counts)], float)
        self.pools = np.append(np.searchsorted(RANKS, np.arange(1, len(words) + 1)), len(RANKS))
        self.furthest = js_distance(np.eye(len(words) + 1)[-1], self.words) if total else 0.0

    def binned(self, data: bytes) -> np.ndarray:
        """How often a text has each common word, and others."""
        own = np.zeros(len(self.words))
        for word, n in Counter(data.lower().split()).items():
            own[self.bins.get(word.strip(EDGE), -1)] += n
        return own

    def by_rank(self, own: np.ndarray) -> float:
        """Distance of common words, bins pooled by rank."""
        return js_distance(*(np.bincount(self.pools, x, len(RANKS) + 1) for x in (own, self.words)))

    def excess(self, own: np.ndarray) -> float:
        """Divergence of common words, less what chance gives so many words: a bin's share of a chi-square's mean, or all of a bin that is likely empty."""
        q = self.words / self.words.sum()
        return js_distance(own, self.words) ** 2 - float(np.minimum((1 - q) / (8 * np.log(2) * own.sum()), q / 2).sum())


def references(docs: DataFrame) -> DataFrame:
    """One row for each language: its documents, characters by class, common words with their counts, and the number of all words."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words: dict = defaultdict(Counter)
        chars: dict = defaultdict(lambda: np.zeros(CLASSES, "int64"))
        seen: Counter = Counter()

        def counted() -> Iterator[pd.DataFrame]:
            for lang in seen:
                bare: Counter = Counter()
                for word, n in words[lang].items():
                    bare[word.strip(EDGE)] += n
                kept = [(w.decode("utf-8", "replace"), n) for w, n in bare.items() if _has_letter(w)]
                rest = bare.total() - sum(n for _, n in kept)
                rows = [("rest", "", rest), ("docs", "", seen[lang])] + [("c", str(k), n) for k, n in enumerate(chars[lang].tolist())]
                yield pd.DataFrame(rows, columns=["kind", "item", "n"]).assign(lang=lang)
                for k in range(0, len(kept), SENT):
                    yield pd.DataFrame(kept[k : k + SENT], columns=["item", "n"]).assign(kind="w", lang=lang)[["kind", "item", "n", "lang"]]
            words.clear(), chars.clear(), seen.clear()

        for batch in batches:
            held = 0
            for text, lang in zip(batch["text"], batch["lang"]):
                own, data, counts = base(text)
                seen[lang] += 1
                if not counts[-1]:
                    held += len(own)
                    words[lang].update(data.lower().split())
                    chars[lang] += char_classes(data)
                if held > HELD:
                    held = 0
                    if sum(map(len, words.values())) > HELD:
                        yield from counted()
        yield from counted()

    counted = docs.select("text", F.col("lang").cast("string").alias("lang")).mapInPandas(count, "kind string, item string, n long, lang string")
    counted = saved(counted.groupBy("lang", "kind", "item").agg(F.sum("n").alias("n")), "counts")
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "item")
    top = counted.filter("kind = 'w'").withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= RANKS[-1])
    top = top.groupBy(*map(F.expr, LANGUAGE)).agg(F.array_sort(F.collect_list(F.struct("rank", "item", "n"))).alias("top"))
    sums = counted.groupBy(*map(F.expr, LANGUAGE)).agg(
        F.sum(F.when(F.col("kind") == "docs", F.col("n"))).alias("n"),
        F.array(*[F.coalesce(F.sum(F.when((F.col("kind") == "c") & (F.col("item") == str(k)), F.col("n"))), F.lit(0)) for k in range(CLASSES)]).alias("chars"),
        F.coalesce(F.sum(F.when(F.col("kind").isin("w", "rest"), F.col("n"))), F.lit(0)).alias("total"),
    )
    none = F.expr("cast(array() as array<struct<rank:int,item:string,n:long>>)")
    rows = sums.join(top, ["lang", "known"], "left").withColumn("top", F.coalesce("top", none))
    return saved(rows.select("lang", "known", "n", "chars", F.col("top.item").alias("words"), F.col("top.n").alias("counts"), "total"), "references")


def judge(text: str | None, reference: Reference | None) -> tuple:
    """A text's base counts, base_failed, kept, its two distances and the excess (null where a guard holds)."""
    words, data, counts = base(text)
    if counts[-1] or len(words) < MIN_WORDS or reference is None or reference.total < MIN_REFERENCE:
        return *counts, not counts[-1], None, None, None
    own, far = reference.binned(data), reference.furthest
    by_char, by_word, excess = js_distance(char_classes(data), reference.chars), reference.by_rank(own), reference.excess(own)
    return *counts, by_char <= MAX_CHAR_DISTANCE and by_word <= MAX_WORD_SHARE * far and excess <= MAX_WORD_EXCESS * far**2, by_char, by_word, excess


def with_verdict(docs: DataFrame, known: DataFrame | None = None, most_languages: int = MOST_LANGUAGES) -> DataFrame:
    """(row, verdict): docs, each row packed, with the verdict's fields. known: references(), those of docs unless told."""
    known = references(docs) if known is None else known
    added = [x.split()[0] for x in FEATURES.split(", ")]
    kind = f"struct<{FEATURES.replace(' ', ':').replace(',:', ',')}>"
    rows = packed(docs)  # the text is in the row alone, for rows wait in memory while Python looks at them
    text, lang = F.col("row.text"), F.col("row.lang").cast("string")

    if known.count() <= most_languages:
        held = {r.lang if r.known else None: (r.chars, [w.encode() for w in r.words], r.counts, r.total) for r in known.collect()}

        @F.pandas_udf(kind)
        def verdict(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.DataFrame]:
            made = {k: Reference(*v) for k, v in held.items()}
            for columns in batches:
                yield pd.DataFrame([judge(t, made.get(x)) for t, x in zip(*columns)], columns=added)

        return rows.select("row", verdict(text, lang).alias("verdict"))

    @F.pandas_udf(kind)
    def by_row(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.DataFrame]:
        for columns in batches:
            out = []
            for text, chars, words, counts, total in zip(*columns):
                out.append(judge(text, None if chars is None else Reference(chars, [w.encode() for w in words], counts, int(total))))
            yield pd.DataFrame(out, columns=added)

    met = join_counted(rows.select("row", F.coalesce(lang, F.lit("")).alias("lang"), lang.isNotNull().alias("known")), known, ["lang", "known"], "left")
    return met.select("row", by_row(text, "chars", "words", "counts", "total").alias("verdict"))


def judged(docs: DataFrame, known: DataFrame | None = None, most_languages: int = MOST_LANGUAGES) -> DataFrame:
    """docs with the verdict's fields as columns, in place of any of their names."""
    added = {x.split()[0] for x in FEATURES.split(", ")}
    plain = docs.drop(*[c for c in docs.columns if c.lower() in added])
    return with_verdict(plain, known, most_languages).select("row.*", "verdict.*")


def passing(docs: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """The rows of docs that are kept, as they are."""
    return with_verdict(docs, known).filter("verdict.kept").select("row.*")


def op6_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts and verdict of every document."""
    return judged(table(spark, sf_dir, "documents").select("doc_id", "text", "lang")).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


_HISTOGRAM = """list_value(
  length(regexp_replace({t}, '[^a-z]', '', 'g')), length(regexp_replace({t}, '[^A-Z]', '', 'g')), length(regexp_replace({t}, '[^0-9]', '', 'g')),
  length(regexp_replace({t}, '[^\\x09-\\x0D\\x20]', '', 'g')), length(regexp_replace({t}, '[^.,;:!?''"()-]', '', 'g')),
  length(regexp_replace({t}, '[^\\x00-\\x08\\x0E-\\x1F#$%&*+/<=>@\\[\\\\\\]^_`{{|}}~\\x7F]', '', 'g')), length(regexp_replace({t}, '[\\x00-\\x7F]', '', 'g')))"""
_SQL = f"""
with d as (select row_number() over () rid, doc_id, coalesce(text, '') t, coalesce(lang, chr(1)) lang from documents),
 w as (select rid, lang, unnest(ws) word, unnest(range(len(ws))) i from (select rid, lang, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') ws from d)),
 five as (select rid, i, word || ' ' || lead(word, 1) over p || ' ' || lead(word, 2) over p || ' ' || lead(word, 3) over p || ' ' || lead(word, 4) over p win from w window p as (partition by rid order by i)),
 hit as (select rid, i from five where win is not null qualify count(*) over (partition by rid, win) > 1),
 rep as (select rid, count(distinct i + k) n from hit, range({WINDOW}) r(k) group by rid),
 ln as (select rid, count(*) - count(distinct line) n from (select rid, unnest(string_split(t, chr(10))) line from d) where regexp_matches(line, '[^\\x20\\x09-\\x0D]') group by rid),
 b as (select d.rid, doc_id, lang, {_HISTOGRAM.format(t="t")} chars, coalesce(c.n, 0) n_words, coalesce(c.chars, 0) word_chars, length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) n_symbols, coalesce(ln.n, 0) n_dup_lines, coalesce(rep.n, 0) n_repeat_words
   from d left join (select rid, count(*) n, sum(length(word)) chars from w group by rid) c using (rid) left join ln using (rid) left join rep using (rid)),
 base as (select *, n_words < {FEWEST_WORDS} or 100 * n_repeat_words > {MOST_REPEATED} * n_words base_failed from b),
 bare as (select rid, lang, trim(translate(word, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '.,;:!?''"()-') word from w),
 good as (select lang, word, count(*) n from bare where rid in (select rid from base where not base_failed) group by all),
 top as (select lang, word, n, row_number() over (partition by lang order by n desc, word) r from good where regexp_matches(word, '[a-z]|[^\\x00-\\x7F]') qualify r <= {RANKS[1]}),
 total as (select lang, sum(n) n from good group by lang),
 wref as (select t.lang, g, coalesce(sum(top.n), 0) n from (select lang, unnest([1, 2]) g from total) t left join top on top.lang = t.lang and g = case when r <= {RANKS[0]} then 1 else 2 end group by all
   union all select lang, 3, total.n - coalesce((select sum(n) from top where top.lang = total.lang), 0) from total),
 cref as (select lang, k, sum(c) n from (select lang, unnest(chars) c, unnest(range({CLASSES})) k from base where not base_failed) group by all),
 far as (select lang, sqrt(sum(case when g < 3 then q else log2(2 / (1 + q)) + case when q > 0 then q * log2(2 * q / (1 + q)) else 0 end end) / 2) furthest
   from (select lang, g, wref.n / total.n q from wref join total using (lang)) group by lang),
 judged as (select rid, lang, n_words, chars from base join total using (lang) where not base_failed and n_words >= {MIN_WORDS} and total.n >= {MIN_REFERENCE}),
 own as (select rid, case when r <= {RANKS[0]} then 1 when r is not null then 2 else 3 end g, count(*) n from bare left join top using (lang, word) group by all),
 pq as (
  select rid, lang, 'c' kind, c / sum(c) over (partition by rid) p, cref.n / sum(cref.n) over (partition by rid) q
   from (select rid, lang, unnest(chars) c, unnest(range({CLASSES})) k from judged) join cref using (lang, k)
  union all
  select rid, lang, 'w', coalesce(own.n, 0) / n_words, wref.n / total.n from judged join wref using (lang) join total using (lang) left join own using (rid, g)),
 js as (select rid, lang, kind, sqrt(greatest(0, sum(case when p > 0 then p * log2(2 * p / (p + q)) else 0 end + case when q > 0 then q * log2(2 * q / (p + q)) else 0 end) / 2)) d from pq group by all),
 wbin as (select lang, r, n from top union all select lang, {RANKS[1]} + 1, n from wref where g = 3),
 ownbin as (select rid, coalesce(r, {RANKS[1]} + 1) r, count(*) n from bare left join top using (lang, word) group by all),
 bins as (select rid, lang, n_words, coalesce(ownbin.n, 0) / n_words p, wbin.n / total.n q from judged join wbin using (lang) join total using (lang) left join ownbin using (rid, r)),
 excess as (select rid, lang, sum(case when p > 0 then p * log2(2 * p / (p + q)) else 0 end + case when q > 0 then q * log2(2 * q / (p + q)) else 0 end) / 2
   - sum(least((1 - q) / (8 * ln(2) * n_words), q / 2)) e from bins group by all),
 bad as (select rid from excess join far using (lang) where e > {MAX_WORD_EXCESS} * furthest * furthest union
  select distinct rid from js join far using (lang) where d > case kind when 'c' then {MAX_CHAR_DISTANCE} else {MAX_WORD_SHARE} * furthest end)
select doc_id, n_words, word_chars::bigint word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, not base_failed and rid not in (select rid from bad) kept from base
"""

QUERIES = {"op6_divergence": op6_divergence}
SQL = {"op6_divergence": _SQL}
