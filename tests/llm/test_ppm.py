"""PPM scores against a trie built symbol by symbol."""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from quillspark.llm import ppm

SMALL = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, score string"


def framed(text):
    return [ppm.START] * ppm.ORDER + list((text or "").encode()) + [ppm.END]


def trie(texts):
    nodes = defaultdict(Counter)
    for text in texts:
        data = framed(text)
        for i in range(ppm.ORDER, len(data)):
            for k in range(ppm.ORDER + 1):
                nodes[tuple(data[i - k : i])][data[i]] += 1
    return nodes


def chance(nodes, context, symbol):
    p, excluded = 1.0, set()
    for k in range(len(context), -1, -1):
        node = nodes.get(tuple(context[len(context) - k :]), {})
        live = {s: c for s, c in node.items() if s not in excluded}
        if live:
            total = sum(live.values()) + len(live)
            if symbol in live:
                return p * live[symbol] / total
            p *= len(live) / total
            excluded |= set(live)
    return p / (256 - len(excluded))


def expected(rows):
    train = [(d, t) for d, t in rows if not held(d)]
    nodes = trie([t for _, t in train])
    words = lambda t: re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) + [None]
    counts = Counter(w for _, t in train for w in words(t))
    n, v = counts.total(), len(counts)
    out = []
    for d, t in rows:
        data, own = framed(t), words(t)
        score = sum(math.log10(chance(nodes, data[i - ppm.ORDER : i], data[i])) for i in range(ppm.ORDER, len(data)))
        base = sum(math.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in own)
        out.append((d, held(d), len(own), sum(counts[w] > 0 for w in own), n, base, score))
    return out


def held(d):
    return zlib.crc32(b"" if d is None else str(d).encode()) % 10 == 0


def check(got, want):
    key = lambda r: (str(r[0]), r[2], round(r[5], 4))
    got, want = sorted(map(tuple, got), key=key), sorted(want, key=key)
    assert [r[:5] for r in got] == [r[:5] for r in want]
    np.testing.assert_allclose([r[5:] for r in got], [r[5:] for r in want], rtol=1e-9)


def test_all_documents(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    got = ppm.op13_ppm(spark, SMALL)
    assert got.columns == ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    rows = got.collect()
    check(rows, expected([(r.doc_id, r.text) for r in docs.collect()]))
    size = {r.doc_id: len(r.text.encode()) + 1 for r in docs.collect()}
    out = [r for r in rows if r.held_out]
    bits = -sum(r.score for r in out) / math.log10(2) / sum(size[r.doc_id] for r in out)
    assert 1 < bits < 2.9  # bits a byte on texts that it has not seen; bytes alone have 4.3


@pytest.mark.parametrize("rows", [
    [(1, "a b c"), (1, "a b c"), (2, ""), (3, None), (None, "é " * 300), (4, "Q w\n\n e"), (4, "other Text"), (2**53 + 1, "abracadabra abracadabra"), (5, "\U0001f600 x\x00y"), (26, "unseen zß"), (30, "abrac")],
    [(None, "ab"), (None, None)],  # nothing to learn from
])
def test_edges(spark, rows):
    got = ppm.scored(spark.createDataFrame([(d, t, "mine") for d, t in rows], DOCS))
    assert got.columns == ["doc_id", "text", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    check(got.drop("text").collect(), expected(rows))


def test_no_documents(spark):
    assert ppm.scored(spark.createDataFrame([], DOCS)).count() == 0


def test_pieces_are_the_whole():
    texts = [b"", b"abc", bytes(range(1, 200)) * 3, b"z"]
    whole = [np.concatenate(x) for x in zip(*ppm.pieces(texts))]
    for size in (1, 5, 64):
        cut = [np.concatenate(x) for x in zip(*ppm.pieces(texts, size=size))]
        assert all((a == b).all() for a, b in zip(whole, cut))
    assert np.bincount(whole[1]).tolist() == [len(t) + 1 for t in texts]


def test_chances_add_up_to_one():
    """After any context, seen or not, over all 256 symbols."""
    rng = np.random.default_rng(3)
    texts = [bytes(rng.choice(list(b"abcd "), 40)) for _ in range(30)]
    grams, counts = np.unique(np.concatenate([g for g, _ in ppm.pieces(texts)]), return_counts=True)
    pairs = np.zeros(65536, "i8")
    np.add.at(pairs, (grams >> 8 * ppm.ORDER) * 256 + (grams & 255), counts)
    contexts = np.concatenate([np.unique(grams >> 8)[::17], [0, ord("a") << 24, (ord("b") << 24) + 7]])
    wanted = np.unique(np.concatenate([grams, (contexts[:, None] * 256 + np.arange(256)).ravel()]))
    n = np.zeros(len(wanted), "i8")
    n[np.searchsorted(wanted, grams)] = counts
    p = 10 ** ppm.log_chances(wanted, n, pairs)
    for c in contexts:
        assert p[wanted >> 8 == c].sum() == pytest.approx(1)
