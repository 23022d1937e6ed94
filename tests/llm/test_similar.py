"""Near-duplicates of the pipeline against brute-force shingle similarity."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from quillspark.llm import graph, similar

from .test_operators import DOCS, EDGES, SMALL


def least_of_classes(texts: dict) -> list:
    """The least id of each class that pairs of similarity 0.8 or more make."""
    sets, ids = {}, sorted(texts)
    for i, text in texts.items():
        words = (text or "").encode().lower().split()
        sets[i] = {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            if 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return sorted({find(i) for i in ids})


def kept(spark, docs):
    return sorted(r.doc_id for r in corpus_pipeline.near_duplicates(spark, docs, SMALL).collect())


@pytest.mark.parametrize("block", [2, 48])
def test_near_duplicates_by_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(similar, "BLOCK", block)
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    assert kept(spark, docs) == least_of_classes({r.doc_id: r.text for r in docs.collect()})


@pytest.mark.parametrize("frequent", [0, 200_000])
def test_edited_copies_in_a_crowd(spark, monkeypatch, frequent):
    monkeypatch.setattr(similar, "BLOCK", 8)
    monkeypatch.setattr(similar, "FREQUENT", max(frequent, 1))
    rng = np.random.default_rng(1)
    base, texts = [f"w{k}" for k in range(150)], {}
    for i in range(120):
        words = list(base)
        for k in rng.integers(0, 150, rng.integers(0, 6)):
            words[k] = f"x{rng.integers(0, 9)}"
        texts[i] = " ".join(words)
    want = least_of_classes(texts)
    assert 1 < len(want) < 100
    assert kept(spark, spark.createDataFrame([(i, t, "en", "x", len(t)) for i, t in texts.items()], DOCS)) == want


def test_near_duplicate_edges(spark):
    docs = spark.createDataFrame(EDGES, DOCS)
    rows = corpus_pipeline.near_duplicates(spark, docs, SMALL).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, (r.text or "")[:2]) for r in rows) == [(False, 1, "a "), (False, 2, ""), (False, 4, "Q "), (False, 4, "ot"), (True, 0, "e ")]
    assert kept(spark, docs.limit(0)) == []


def counted(monkeypatch) -> dict:
    """Rows of the intermediate tables from now on, by name."""
    rows: dict = {}
    write = similar.saved

    def saved(df, name):
        out = write(df, name)
        rows[name] = out.count()
        return out

    monkeypatch.setattr(similar, "saved", saved)
    return rows


def documents(spark, texts: dict):
    return spark.createDataFrame([(i, t, "en", "x", len(t)) for i, t in texts.items()], DOCS)


def test_fingerprints_bear_on_what_follows(spark, monkeypatch):
    """What fingerprints link is one class, of which the second search sees nothing; without them it finds the same links."""
    texts = {10 * f + i: " ".join([*(f"f{f}w{k}" for k in range(1500)), f"end{i}"]) for f in range(4) for i in range(5)}
    rows = counted(monkeypatch)
    assert kept(spark, documents(spark, texts)) == [0, 10, 20, 30]
    assert rows["met"] == 0
    assert rows["print-links"] > 0 and rows["prefixes"] == rows["pairs"] == 0
    found = similar.simhash_pairs
    monkeypatch.setattr(similar, "simhash_pairs", lambda nodes: found(nodes).limit(0))
    assert kept(spark, documents(spark, texts)) == [0, 10, 20, 30]
    assert rows["print-links"] == 0 and rows["prefixes"] > 0 and rows["pairs"] > 0


def test_phrases_shared_by_chance_make_no_pairs(spark, monkeypatch):
    """Texts with a sixth of their shingles from phrases that no sample knows: only copies meet."""
    monkeypatch.setattr(similar, "FREQUENT", 1)
    rng = np.random.default_rng(3)
    phrases, texts = [" ".join(f"p{k}q{j}" for j in range(12)) for k in range(60)], {}
    for i in range(100):
        texts[i] = " ".join(f"{phrases[k]} " + " ".join(f"t{i}n{n}m{j}" for j in range(40)) for n, k in enumerate(rng.integers(0, 60, 15)))
    for i in range(100, 110):
        words = texts[i - 100].split()
        for k in rng.integers(0, len(words), 10):
            words[k] = f"x{i}"
        texts[i] = " ".join(words)
    want = least_of_classes(texts)
    assert want == list(range(100))
    rows = counted(monkeypatch)
    assert kept(spark, documents(spark, texts)) == want
    assert rows["pairs"] <= 20


def family(copies: int, edits: int) -> dict:
    """Copies of one text, each with words of its own in so many places: alike by some 3/4, so each is a class."""
    rng, texts = np.random.default_rng(5), {}
    for i in range(copies):
        words = [f"w{k}" for k in range(400)]
        for k in rng.choice(400, edits, replace=False):
            words[k] = f"x{i}y{k}"
        texts[i] = " ".join(words)
    return texts


@pytest.mark.parametrize("block", [8, 48])
def test_sets_that_share_many_shingles_make_one_pair(spark, monkeypatch, block):
    """Two sets make a pair where they first meet, in a block or between blocks, and not again at each shingle that they share."""
    monkeypatch.setattr(similar, "BLOCK", block)
    counts, find = [], similar.meetings

    def meetings(met):
        every = find(met.withColumn("before", F.array().cast("array<bigint>")))
        counts.append((find(met).count(), find(met).distinct().count(), every.count(), every.distinct().count()))
        return find(met)

    monkeypatch.setattr(similar, "meetings", meetings)
    texts = family(40, 6)
    want = least_of_classes(texts)
    assert len(want) > 20
    assert kept(spark, documents(spark, texts)) == want
    rows, pairs, before, all_pairs = counts[0]
    assert pairs == all_pairs > 200
    assert before > 5 * pairs and rows < 2 * pairs


def test_small_graphs_in_few_files(spark, monkeypatch):
    """The steps that connect a small graph write a file each, however many partitions a shuffle has."""
    files, write = {}, graph.saved

    def saved(df, name):
        out = write(df, name)
        files[name] = max(files.get(name, 0), len(out.inputFiles()))
        return out

    monkeypatch.setattr(graph, "saved", saved)
    held = {"spark.sql.shuffle.partitions": "50", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    was = {k: spark.conf.get(k) for k in held}
    try:
        for k, v in held.items():
            spark.conf.set(k, v)
        edges = spark.createDataFrame([(k, k + 1) for k in range(300) if k % 10 != 9], "a long, b long")
        found = {r.node: r.root for r in graph.components(edges).collect()}
    finally:
        for k, v in was.items():
            spark.conf.set(k, v)
    assert found == {k: k - k % 10 for k in range(300)}
    assert {files[k] for k in ("least", "large-star", "low", "small-star")} == {1}
