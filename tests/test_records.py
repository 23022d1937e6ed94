"""Malformed lines are set apart, counted and named; strict mode fails on them."""

from __future__ import annotations

import json

import pytest

from quillspark.sources import io as S
from quillspark.sources import records as R

SCHEMA = "id long, text string"
BROKEN = ['{"id": 1', '{"id": 2} x', '{"id": 3}{"id": 4}', "[1]", "7", '"text"', "null", '{"id": "word"}', '{"id": 5}, {"id": 6}', "prose"]


@pytest.fixture
def files(tmp_path):
    """Three files: one sound, one with blank lines, one with a broken line after every tenth."""
    (tmp_path / "in" / "sub").mkdir(parents=True)
    sound = [json.dumps({"id": k, "text": "é" * (k % 7)}, ensure_ascii=False) for k in range(500)]
    (tmp_path / "in" / "a.jsonl").write_text("\n".join(sound) + "\n")
    (tmp_path / "in" / "b.jsonl").write_text("\n\n  \n".join(sound[:5]) + '\n{"id": null, "other": [1, {"x": "]"}]}\n{}')
    mixed, bad = [], {}
    for k, line in enumerate(sound):
        mixed.append(line)
        if k % 10 == 9:
            mixed.append(BROKEN[k // 10 % len(BROKEN)])
            bad[len(mixed)] = mixed[-1]
    (tmp_path / "in" / "sub" / "c.jsonl").write_text("\n".join(mixed))
    (tmp_path / "in" / "notes.txt").write_text("no record")
    return tmp_path, bad


def test_rejected_lines(spark, files):
    root, bad = files
    spark.conf.set("spark.sql.files.maxPartitionBytes", 2000)  # many splits a file
    try:
        got = R.read_records(spark, str(root / "in"), SCHEMA, str(root / "out"), "*.jsonl")
        rejected = got.rejected.collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert {r.line: r.value for r in rejected} == bad and {r.file.rsplit("/", 1)[1] for r in rejected} == {"c.jsonl"}
    assert got.counts == {"lines": 500 + 15 + 550, "blank": 8, "good": 500 + 7 + 500, "rejected": 50}
    rows = got.good.collect()
    assert len(rows) == 1007 and sum(r.id is None for r in rows) == 2 and {r.text for r in rows if r.id == 6} == {"é" * 6}
    with pytest.raises(ValueError, match="already"):
        R.read_records(spark, str(root / "in"), SCHEMA, str(root / "out"))


def test_nothing_is_rejected(spark, files):
    root, _ = files
    got = R.read_records(spark, str(root / "in" / "a.jsonl"), SCHEMA, str(root / "out"))
    assert got.rejected.count() == 0 and got.good.count() == 500 == got.counts["good"]


def test_strict(spark, files):
    root, _ = files
    assert R.read_strict(spark, [str(root / "in" / "a.jsonl"), str(root / "in" / "b.jsonl")], SCHEMA).count() == 507
    with pytest.raises(Exception, match=r"malformed record in file:.*c\.jsonl"):
        R.read_strict(spark, str(root / "in"), SCHEMA, "*.jsonl").collect()
    for read in (lambda: S.read_jsonl(spark, str(root / "in" / "sub"), SCHEMA, strict=True), lambda: S.merge_jsonl(spark, str(root / "in"), SCHEMA, strict=True)):
        with pytest.raises(Exception, match="(?i)malformed"):
            read().collect()
    assert S.merge_jsonl(spark, str(root / "in" / "sub"), SCHEMA).filter("id is null").count() > 0
