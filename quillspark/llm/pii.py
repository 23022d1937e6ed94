"""Personal data: rules for four kinds, and bootstrapped contextual extraction of what the rules miss.

The rules find e-mail addresses, IP addresses, card numbers and phone numbers in
whole texts. What they find seeds a bootstrap: each seed and each candidate
(something with an @, or a run of digits that no rule accepted) is seen in lexical
patterns. These are the one or two words before it, after it, or on both sides, as
they stand; and the shapes of these words (their classes of characters in order)
beside the form of the candidate's own end (its last two or three groups of digits
with what parts them, or the shape of its host). Patterns and instances form a
bipartite graph that Spark scores in turns: a pattern's score for a kind is the mean
score of those instances seen in it that have one, an unseen instance's the mean
score of those of its patterns that have one; seeds keep score 1 for their own kind
and 0 for others, and what a rule's check refutes (a card number of the wrong check
digit, an address part over 255) keeps 0 for that kind. A pattern that scores ``MIN_SCORE`` on ``MIN_SEEDS`` distinct
seeds or more is trusted, and a candidate in it that looks like its kind, unless
refuted, becomes a span of that kind. Spans found that way never overlap those of
the rules, which all stay.

Only identifiers and their neighbouring words go into the graph, so it is far
smaller than the texts, and every step is a partial aggregate or an equi-join in
which hot patterns (shapes are) are broadcast and the rest are shuffled.

Defined cases: a null or empty text has no spans; repeated rows each get their
spans (an instance counts once in a pattern however often it is repeated); of
patterns that disagree on a candidate the best score decides, then the seeds, then
the order of kinds; a text is scanned in time linear in its length, however long a
run of digits in it; a neighbour that does not end within ``CONTEXT`` characters is
no context; an empty table gives no rows; added columns replace those of the same name.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import join_counted, saved, table

KINDS = ("email", "ip", "card", "phone")
ROUNDS = 3
MIN_SCORE = 0.8
MIN_SEEDS = 10
CONTEXT = 80

SPAN = "struct<start:int,kind:int,end:int>"
SEEN = "struct<start:int,end:int,value:string,seed:int,looks:array<int>,refuted:array<int>,patterns:array<string>>"
FOUND = f"row long, doc_id string, base array<{SPAN}>, seen array<{SEEN}>"

_local = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_domain = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_ip = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_card = re.compile(r"[0-9]([\x20-]?[0-9])+")
_phone = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_candidate = re.compile(r"(?<![^\x09-\x0D\x20@])[^\x09-\x0D\x20@]+@[^\x09-\x0D\x20@]+|[+(]?[0-9](?:[\x20().+-]{0,2}[0-9])+")
_word = re.compile(r"[^\x20\x09-\x0D]+")
_not_digit = re.compile(r"[^0-9]+")
_digits = re.compile(r"([^0-9]*)([0-9]+)")
_dotted = re.compile(r"[0-9]+(\.[0-9]+){3}")
_host = re.compile(r"[^\W_]@[A-Za-z0-9]")
_run = re.compile(r"(.)\1+", re.S)


def _emails(text: str) -> Iterator[tuple[int, int]]:
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _local:
            start -= 1
        if start < at and (m := _domain.match(text, at + 1)):
            yield start, m.end()
            done = m.end()
        at = text.find("@", max(at + 1, done))


def _luhn(digits: str) -> bool:
    odd, even = digits[::-2], digits[-2::-2]
    return (sum(map(int, odd)) + sum(sum(divmod(2 * int(c), 10)) for c in even)) % 10 == 0


def _octet(part: str) -> bool:
    """Whether a run of digits, leading zeros or not, is 255 at most."""
    part = part.lstrip("0") or "0"
    return len(part) <= 3 and int(part) <= 255


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind's place, end) of what the rules find, in order."""
    out = [(s, 0, e) for s, e in _emails(text)] if "@" in text else []
    if not any(c in text for c in "0123456789"):
        return out
    for m in _ip.finditer(text):
        if all(map(_octet, m[0].split("."))):
            out.append((m.start(), 1, m.end()))
    for m in _card.finditer(text):
        if 14 <= len(digits := _not_digit.sub("", m[0])) <= 19 and _luhn(digits):
            out.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in _phone.finditer(text):
            if 10 <= len(_not_digit.sub("", m[0])) <= 15:
                out.append((m.start(), 3, m.end()))
    return sorted(out)


def _looks(value: str) -> tuple[list[int], list[int]]:
    """The kinds whose form a value has, loosely, and the kinds that a rule's check refutes."""
    if "@" in value:
        return ([0] if _host.search(value) else []), []
    digits = _not_digit.sub("", value)
    if _dotted.fullmatch(value):
        return [1], [] if all(map(_octet, value.split("."))) else [1]
    looks = [k for k, least, most in ((2, 12, 19), (3, 7, 15)) if least <= len(digits) <= most]
    return looks, [2] if 14 <= len(digits) <= 19 and not _luhn(digits) else []


def _shape(word: str) -> str:
    """Classes of a word's characters in order: a, A, 9, and others as they are; runs count once."""
    return _run.sub(r"\1", "".join("a" if c.islower() else "A" if c.isupper() else "9" if c.isdigit() else c for c in word))


def _forms(value: str) -> list[str]:
    """The form of a value's end: its last two and three groups of digits by length and what parts them, or its host's shape."""
    if "@" in value:
        return ["@" + _shape(value.rpartition("@")[2])]
    groups = _digits.findall(value)
    ends = ["".join(f"{'(' if k == 0 and gap[-1:] == '(' else gap if k else ''}{len(own)}" for k, (gap, own) in enumerate(groups[-n:])) for n in (2, 3)]
    return ends if len(groups) > 2 else ends[:1]


def _context(text: str, start: int, end: int) -> tuple[list[str], list[str], bool, bool]:
    """Up to two words before and after a span, whole ones only, and whether they touch it."""
    low, high = max(0, start - CONTEXT), min(len(text), end + CONTEXT)
    before, after = _word.findall(text, low, start), _word.findall(text, end, high)
    if before and low and not text[low - 1].isspace() and not text[low].isspace():
        del before[0]
    if after and high < len(text) and not text[high - 1].isspace() and not text[high].isspace():
        del after[-1]
    return before[-2:], after[:2], start > 0 and not text[start - 1].isspace(), end < len(text) and not text[end].isspace()


def _patterns(text: str, start: int, end: int) -> list[str]:
    """What stands about a span as patterns: words before, after and on both sides, and their shapes with the span's form."""
    before, after, left, right = _context(text, start, end)
    here = f"{'+' if left else ' '}_{'+' if right else ' '}"
    shapes = [_shape(w) for w in (before[-1:] or ["^"]) + (after[:1] or ["$"])]
    out = [f"{b}{here}{a} ~{form}" for form in _forms(text[start:end]) for b, a in ((shapes[0], ""), ("", shapes[1]), shapes)]
    before, after = [w.lower() for w in before], [w.lower() for w in after]
    if before:
        out.append(f"{before[-1]}{here}")
    if len(before) == 2:
        out.append(f"{before[0]} {before[1]}{here}")
    if len(after) == 2:
        out.append(f"{here}{after[0]} {after[1]}")
    if before and after:
        out.append(f"{before[-1]}{here}{after[0]}")
    return out


def _scan(text: str) -> tuple[list[tuple], list[tuple]]:
    base = base_spans(text)
    seen = [(s, e, text[s:e], k, [k], [], _patterns(text, s, e)) for s, k, e in base]
    if "@" in text or any(c in text for c in "0123456789"):
        spans = sorted((s, e) for s, _, e in base)
        i = 0
        for m in _candidate.finditer(text):
            start, end = m.span()
            if "@" in m[0]:  # without brackets, quotes and what ends a sentence
                start += len(m[0]) - len(m[0].lstrip("(<[{\"'"))
                end -= len(m[0]) - len(m[0].rstrip(".,;:!?)>]}\"'"))
            while i < len(spans) and spans[i][1] <= start:
                i += 1
            if i < len(spans) and spans[i][0] < end:
                continue
            looks, refuted = _looks(text[start:end])
            if looks:
                seen.append((start, end, text[start:end], None, looks, refuted, _patterns(text, start, end)))
    return base, seen


def scan(docs: DataFrame) -> DataFrame:
    """One row for each document: its key, base spans, and all seeds and candidates with their patterns."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            out = []
            for doc_id, text in zip(batch["doc_id"], batch["text"]):
                base, seen = _scan(text or "")
                out.append((row, doc_id, base, seen))
                row += 1
            spans = [[{"start": s, "kind": k, "end": e} for s, k, e in b] for _, _, b, _ in out]
            seen = [[dict(zip(("start", "end", "value", "seed", "looks", "refuted", "patterns"), x)) for x in s] for *_, s in out]
            yield pd.DataFrame({"row": [r for r, *_ in out], "doc_id": [d for _, d, *_ in out], "base": spans, "seen": seen})

    # ids pass as text: beside a null, pandas would round a long
    found = docs.select(F.col("doc_id").cast("long").cast("string").alias("doc_id"), "text").mapInPandas(run, FOUND)
    return found.withColumn("doc_id", F.col("doc_id").cast("long"))


def trusted_patterns(found: DataFrame) -> DataFrame:
    """(pattern, kind, score, seeds, n): what the bootstrap trusts, and how many distinct instances are seen in it."""
    edges = found.select(F.inline("seen")).select("value", "seed", "refuted", F.explode("patterns").alias("pattern")).groupBy("pattern", "value").agg(F.min("seed").alias("seed"), F.first("refuted").alias("refuted"))
    edges = saved(edges, "pattern-graph")
    kinds = F.explode(F.array(*[F.lit(k) for k in range(len(KINDS))])).alias("kind")
    fixed = F.when(F.col("seed").isNotNull(), (F.col("seed") == F.col("kind")).cast("double")).when(F.array_contains("refuted", F.col("kind")), 0.0)
    graph = edges.select("pattern", "value", "seed", "refuted", kinds).withColumn("fixed", fixed).drop("refuted")
    degrees = saved(edges.filter("seed is null").groupBy("value").agg(F.count(F.lit(1)).alias("n")), "degrees")
    scored = graph.withColumn("score", F.col("fixed"))
    for turn in range(ROUNDS):
        patterns = scored.groupBy("pattern", "kind").agg(F.avg("score").alias("p"), F.count_if(F.col("seed") == F.col("kind")).alias("seeds"), F.count(F.lit(1)).alias("n")).filter("p is not null")
        patterns = saved(patterns, f"patterns-{turn}")
        if turn + 1 < ROUNDS:
            open_ = graph.filter("fixed is null").select("pattern", "value", "kind")
            means = join_counted(open_, patterns.select("pattern", "kind", "p", "n"), ["pattern", "kind"]).groupBy("value", "kind").agg(F.avg("p").alias("r"))
            own = saved(means.join(degrees, "value"), f"instances-{turn}")
            scored = join_counted(graph, own, ["value", "kind"], "left").withColumn("score", F.coalesce("fixed", "r"))
    return saved(patterns.filter((F.col("p") >= MIN_SCORE) & (F.col("seeds") >= MIN_SEEDS)).withColumnRenamed("p", "score"), "trusted")


def _listed(spans: Column) -> Column:
    """kind:start:end, joined by commas, by start and kind."""
    names = F.array(*[F.lit(k) for k in KINDS])
    line = lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))
    return F.array_join(F.transform(F.array_sort(spans), line), ",")


def find_personal_data(docs: DataFrame) -> DataFrame:
    """(doc_id, base, more): the spans of the rules, and those that trusted patterns add, of each row of docs."""
    found = saved(scan(docs), "scanned")
    # a pattern's instances, not its rows: what repeats most is hot either way
    trusted = trusted_patterns(found).groupBy("pattern").agg(F.collect_list(F.struct("kind", "score", "seeds")).alias("kinds"), F.max("n").alias("n"))
    open_ = found.select("row", F.inline("seen")).filter("seed is null").select("row", "start", "end", "looks", "refuted", F.explode("patterns").alias("pattern"))
    hits = join_counted(open_, saved(trusted, "trusted-patterns"), ["pattern"]).select("row", "start", "end", "looks", "refuted", F.inline("kinds"))
    hits = hits.filter(F.array_contains("looks", F.col("kind")) & ~F.array_contains("refuted", F.col("kind")))
    best = hits.groupBy("row", "start", "end").agg(F.max_by("kind", F.struct("score", "seeds", -F.col("kind"))).alias("kind"))
    more = saved(best.groupBy("row").agg(F.collect_list(F.struct("start", "kind", "end")).alias("more")), "more-spans")
    return found.join(more, "row", "left").select("doc_id", "base", F.coalesce("more", F.expr(f"cast(array() as array<{SPAN}>)")).alias("more"))


def _of_kind(k: int) -> Column:
    return F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long")


def op3_bootstrapped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of every document."""
    found = find_personal_data(table(spark, sf_dir, "documents"))
    counts = [_of_kind(k).alias(f"n_{name}") for k, name in enumerate(KINDS)]
    return found.select("doc_id", *counts, F.sha2(_listed(F.col("base")).cast("binary"), 256).alias("base_sha256"), _listed(F.concat("base", "more")).alias("spans"))


QUERIES = {"op3_bootstrapped": op3_bootstrapped}
SQL: dict[str, str] = {}
