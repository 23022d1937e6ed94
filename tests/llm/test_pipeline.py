"""The pipeline, stage by stage, against brute force on its own input."""

from __future__ import annotations

import re

import corpus_pipeline
import pytest
from quillspark.llm import decontaminate, quality
from quillspark.llm.common import saved

from .test_operators import CLASH, DOCS, EDGES, SMALL, WORD, clashing, targets
from .test_similar import least_of_classes


def test_stages(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id: r for r in docs.collect()}
        after = saved(stage(spark, docs, SMALL), "stage")
        seen[name] = (before, after.collect())
        assert after.columns[: len(docs.columns)] == docs.columns
        docs = after
    assert list(seen) == ["quality", "near duplicates", "decontamination", "mixing", "sharding"]

    before, rows = seen["quality"]
    failed = {i for i, r in before.items() if quality.base(r.text)[2][-1]}
    kept = {r.doc_id for r in rows}
    assert not kept & failed and len(kept) > 0.75 * len(before)

    before, rows = seen["near duplicates"]
    assert sorted(r.doc_id for r in rows) == least_of_classes({i: r.text for i, r in before.items()})

    before, rows = seen["decontamination"]
    sets = [set(decontaminate.shingles(decontaminate.words_of(t))) for _, t in items]
    bad = {i for i, r in before.items() if any(len(s & set(decontaminate.shingles(decontaminate.words_of(r.text)))) >= 0.8 * len(s) for s in sets)}
    assert {r.doc_id for r in rows} == before.keys() - bad

    before, rows = seen["mixing"]
    sizes: dict = {}
    for r in before.values():
        sizes[r.source] = sizes.get(r.source, 0) + len(WORD.findall(r.text))
    names = sorted(sizes)
    want = dict(zip(names, targets([sizes[s] for s in names], [k % 3 + 1 for k in range(len(names))])))
    taken = dict.fromkeys(names, 0)
    for r in rows:
        taken[r.source] += len(WORD.findall(r.text))
        assert re.sub(r"\s", "", r.text) in re.sub(r"\s", "", before[r.doc_id].text) or len(r.text) < len(before[r.doc_id].text)
    assert all(abs(taken[s] - want[s]) <= 1 for s in names)

    _, rows = seen["sharding"]
    loads = [sum(len(r.text.encode()) + 1 for r in rows if r.shard == k) for k in range(8)]
    assert len(rows) == len(seen["mixing"][1]) and max(loads) < 1.1 * min(loads)


@pytest.mark.parametrize(("name", "stage"), corpus_pipeline.STAGES)
def test_stage_edges(spark, name, stage):
    """Nulls in any column, empty and long texts, ties, repeated rows, clashing names and an empty table: what each stage keeps of them."""
    long = " ".join(f"w{k}x{k % 7}" for k in range(3000))
    docs = clashing(spark.createDataFrame([*EDGES, (9, long, "en", "z", len(long)), (9, long, "en", "z", len(long)), (None, long + " end", None, None, None)], DOCS))
    out = stage(spark, docs, SMALL)
    rows = out.collect()
    assert out.columns == [*docs.columns, *(["shard"] if name == "sharding" else [])]
    assert all(r[c] == "own" for r in rows for c in CLASH)
    texts = sorted((r.text or "")[:3] for r in rows)
    want = {
        "quality": ["w0x"] * 3,  # under ten words, or all repeated, go; of no language is enough known
        "near duplicates": ["", "Q w", "a b", "e e", "oth", "w0x"],  # of equal texts one stays, that of the least known doc_id
        "decontamination": sorted((t or "")[:3] for t in [*(r[1] for r in EDGES), long, long, long]),
        "sharding": sorted((t or "")[:3] for t in [*(r[1] for r in EDGES), long, long, long]),
    }
    if name in want:
        assert texts == want[name]
    else:  # mixing: each source's words by its target
        sizes: dict = {}
        for r in docs.collect():
            sizes[r.source] = sizes.get(r.source, 0) + len(WORD.findall(r.text or ""))
        names = sorted(sizes, key=lambda s: (s is None, s or ""))
        goal = dict(zip(names, targets([sizes[s] for s in names], [k % 3 + 1 for k in range(len(names))])))
        taken = dict.fromkeys(names, 0)
        for r in rows:
            taken[r.source] += len(WORD.findall(r.text))
        assert all(abs(taken[s] - goal[s]) <= 1 for s in names)
    assert stage(spark, docs.limit(0), SMALL).count() == 0
