"""The audit of sources against whole-number arithmetic, term by term."""

from __future__ import annotations

import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from quillspark.llm import divergence_audit as A

DOCS = "doc_id long, text string, lang string, source string, value string, rank string"
TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def expected(rows):
    docs = [(lang or "", source or "", TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))) for text, lang, source in rows]
    found = defaultdict(Counter)
    for lang, _, terms in docs:
        found[lang].update(set(terms))
    kept = {lang: {t for t, n in own.items() if n >= A.MIN_DOCS} for lang, own in found.items()}
    counts, whole = defaultdict(Counter), defaultdict(Counter)
    for lang, source, terms in docs:
        own = [t for t in terms if t in kept[lang]]
        counts[lang, source].update(own)
        whole[lang].update(own)
    share = lambda c, t, lang: 1 + 10**9 * (c[t] + 2) // (c.total() + 2 * len(kept[lang]))
    apart = lambda p, q: (p - q) ** 2 // (p + q)
    out = []
    for (lang, source), own in counts.items():
        pairs = [(sum(apart(share(own, t, lang), share(other, t, lang)) for t in kept[lang]), s) for (x, s), other in counts.items() if x == lang and s != source]
        terms = [(apart(share(own, t, lang), share(whole[lang], t, lang)), t) for t in own if own[t] and share(own, t, lang) > share(whole[lang], t, lang)]
        for part, items, most in (("pair", pairs, None), ("term", terms, A.TOP)):
            order = sorted(items, key=lambda x: (-x[0], x[1].encode()))[:most]
            out += [(lang, source, part, item, value, k + 1) for k, (value, item) in enumerate(order)]
    return sorted(out)


def made(spark, rows):
    return spark.createDataFrame([(k, t, la, s, "mine", "mine") for k, (t, la, s) in enumerate(rows)], DOCS)


WORDS = ["The", "of", "é", "Éa", "zß", "x1y", "don't", "\U0001f600", "naïve", "a", "rare"]


def some(n=300, sources=7):
    rng = np.random.default_rng(5)
    rows = [(" ".join(rng.choice(WORDS, rng.integers(0, 30))), f"l{k % 2}", f"s{rng.integers(sources)}") for k in range(n)]
    return rows + [(None, None, None), ("", "l0", None), ("1 2 3", "l1", "no terms"), ("the " * 5000, "l0", "s1"), ("lonely", "l9", "one"), ("few", "l8", "a"), ("few", "l8", "b")] + [("same same text", "l0", "twin")] * 12


@pytest.mark.parametrize("chunk", [A.CHUNK, 2])
def test_brute_force(spark, chunk):
    rows = some()
    assert sorted(map(tuple, A.audit(made(spark, rows), chunk=chunk).collect())) == expected(rows)


def test_blocks_of_sources(spark):
    rows = some(400, 15)
    assert sorted(map(tuple, A.audit(made(spark, rows), cells=20, block=2).collect())) == expected(rows)


def test_counts_sent_in_parts(spark):
    rows = some(150)
    assert sorted(map(tuple, A.audit(made(spark, rows), held=3).collect())) == expected(rows)


def test_nothing(spark):
    assert A.audit(spark.createDataFrame([], DOCS)).count() == 0
    rows = [(None, None, None), ("", None, "s"), ("a b", "en", "s")]  # no kept term anywhere
    assert sorted(map(tuple, A.audit(made(spark, rows)).collect())) == expected(rows) == [("", "", "pair", "s", 0, 1), ("", "s", "pair", "", 0, 1)]


def test_shares_are_exact():
    rng = np.random.default_rng(1)
    for n, v in ((0, 1), (10, 3), (10**15, 10**6), (9 * 10**15 - 10, 5)):
        counts = np.append(rng.integers(0, max(n, 1), 50), [0, n])
        assert A.shares(counts, n, v).tolist() == [1 + 10**9 * (c + 2) // (n + 2 * v) for c in counts.tolist()]
