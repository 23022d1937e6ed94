"""Benchmark decontamination by size-partitioned MinHash containment search.

Items and documents are sets of five-word shingles (words: runs of letters and
digits, lower case). A document is contaminated by an item if it holds at least
``CONTAINMENT`` of the item's distinct shingles, be the document ever so long.

Items are partitioned by size (powers of two of their shingles). An item's sketch
is the bottom-k MinHash of its shingles, with k one more than the shingles that
a contaminated document may lack; such a document must hold one of these k, so
the search loses nothing. A partition's largest sketch hash bounds what a document
sends to the search, and a document too small to hold the least item of a
partition skips it. Every candidate is verified by exact shingle containment, on
the shingles themselves.

Small benchmarks (``BROADCAST_SHINGLES`` shingles in all, at most) are broadcast and
searched where the documents are read. Beyond that, sketches and the documents'
hashes below the bounds meet in a shuffled join, and a text is sent once for every
``TOGETHER`` of its candidates to be held against them.

Defined cases: a null or empty text has no shingles; a text of one to four words
is one shingle, and an item of so few is found wherever these words stand in a row;
a long text is searched whole, once; an item without words contaminates
nothing; a null item_id is kept; repeated items, and items that tie, are found each;
repeated rows are found each; an empty table gives no rows; columns of the documents
may have any name, only ``hits`` is replaced.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import join_counted, packed, saved, table, text_of

SHINGLE = 5
CONTAINMENT = 0.8
#: Shingles of all items up to which the benchmark is broadcast.
BROADCAST_SHINGLES = 2_000_000
#: Candidates of a text that are verified together.
TOGETHER = 256
#: Distinct words whose hash a worker remembers, at most.
REMEMBERED = 200_000

_words = re.compile(r"[^\W_]+").findall
_P = np.uint64(0x9E3779B97F4A7C15)


class _Hashes(dict):
    """XXH64 of words, remembered."""

    def __missing__(self, word: str) -> int:
        import xxhash

        value = xxhash.xxh64_intdigest(word)
        if len(self) < REMEMBERED:
            self[word] = value
        return value


_hash_of = _Hashes()


def words_of(text: str | None) -> list[str]:
    return _words((text or "").lower())


def shingles(words: list[str], size: int = SHINGLE) -> list[str]:
    """The shingles in order, joined by a space."""
    return [" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1))] if words else []


def _shorter(words: list[str], short: list[int]) -> list[int]:
    """Lengths of short items that the shingles of these words do not tell."""
    return [n for n in short if n < min(SHINGLE, len(words))]


def all_shingles(words: list[str], short: list[int]) -> set[str]:
    """The distinct shingles, and the sequences as long as the short items, each of which is one shingle."""
    return set(shingles(words)).union(*[shingles(words, n) for n in _shorter(words, short)])


def all_hashes(words: list[str], short: list[int]) -> np.ndarray:
    """Hashes of all_shingles, repeats included."""
    return np.concatenate([shingle_hashes(words), *[shingle_hashes(words, n) for n in _shorter(words, short)]])


def shingle_hashes(words: list[str], size: int = SHINGLE) -> np.ndarray:
    """A 63-bit hash of each shingle, in order."""
    if not words:
        return np.zeros(0, "u8")
    h = np.fromiter(map(_hash_of.__getitem__, words), "u8", len(words))
    n = min(size, len(words))
    last = len(words) - n + 1
    out = np.full(last, n, "u8")
    for k in range(n):
        out = out * _P + h[k : k + last]
    out ^= out >> np.uint64(31)  # so that low and high hashes are alike likely
    out *= np.uint64(0xBF58476D1CE4E5B9)
    return (out ^ (out >> np.uint64(29))) >> np.uint64(1)


def needed(size: int, containment: float = CONTAINMENT) -> int:
    """Shingles of an item of this size that a contaminated document holds at least."""
    return max(1, int(np.ceil(containment * size - 1e-9)))


def short_lengths(texts) -> list[int]:
    """The numbers of words, below a shingle's, that some items have."""
    return sorted({n for n in (len(words_of(t)) for t in texts) if 0 < n < SHINGLE})


class Sketches:
    """The sketches of a broadcast benchmark, partitioned by size."""

    def __init__(self, items: list[tuple[int, str]]):
        self.sets = [frozenset(shingles(words_of(text))) for _, text in items]
        self.ids = [i for i, _ in items]
        self.short = short_lengths(text for _, text in items)
        groups: dict[int, list[int]] = {}
        for k, own in enumerate(self.sets):
            if own:
                groups.setdefault(len(own).bit_length(), []).append(k)
        self.parts = []
        for _, members in sorted(groups.items()):
            hashes, owner = [], []
            for k in members:
                sketch = np.unique(shingle_hashes(words_of(items[k][1])))[: len(self.sets[k]) - needed(len(self.sets[k])) + 1]
                hashes.append(sketch)
                owner.append(np.full(len(sketch), k))
            order = np.argsort(flat := np.concatenate(hashes), kind="stable")
            keys, first = np.unique(flat[order], return_index=True)
            self.parts.append((min(needed(len(self.sets[k])) for k in members), keys[-1], keys, np.append(first, len(flat)), np.concatenate(owner)[order]))

    def search(self, text: str | None) -> list[tuple[int, int]]:
        """(item's place, shingles held) of each item that contaminates the text."""
        words = words_of(text)
        hashes = all_hashes(words, self.short)
        found: set[int] = set()
        for least, bound, keys, first, owner in self.parts:
            if len(hashes) >= least:
                low = hashes[hashes <= bound]
                at = np.searchsorted(keys, low)
                for k in set(at[keys[at] == low].tolist()):
                    found.update(owner[first[k] : first[k + 1]].tolist())
        if not found:
            return []
        own = all_shingles(words, self.short)
        held = ((k, len(self.sets[k] & own)) for k in sorted(found))
        return [(k, n) for k, n in held if n >= needed(len(self.sets[k]))]


HITS = "array<struct<item_id:long,held:int,size:int>>"


def _broadcast_search(rows: DataFrame, items: list[tuple[int, str]]) -> DataFrame:
    """rows (row) with hits."""
    sketches = rows.sparkSession.sparkContext.broadcast(items)

    @F.pandas_udf(HITS)
    def search(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        known = Sketches(sketches.value)
        for texts in batches:
            yield pd.Series([[{"item_id": known.ids[k], "held": n, "size": len(known.sets[k])} for k, n in known.search(t)] for t in texts])

    return rows.withColumn("hits", search(F.col("row.text")))


def _hashed(rows: DataFrame, keep: str, bounds: list[tuple[int, int]] | None = None, short: tuple[int, ...] | list[int] = ()) -> DataFrame:
    """Distinct shingle hashes of (keep, text): all, with the size, or those below the bounds (fewest shingles, greatest hash)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for key, text in zip(batch[keep], batch["text"]):
                words = words_of(text)
                hashes = np.unique(all_hashes(words, short))
                size = len(set(shingles(words))) if bounds is None else len(hashes)
                if bounds is None:
                    hashes = hashes[: size - needed(size) + 1] if size else hashes
                else:
                    top = max((b for least, b in bounds if size >= least), default=None)
                    hashes = hashes[hashes <= np.uint64(top)] if top is not None else hashes[:0]
                if len(hashes):
                    yield pd.DataFrame({keep: key, "size": size, "hash": hashes.view("i8")})

    kind = rows.schema[keep].dataType.simpleString()
    return rows.select(keep, "text").mapInPandas(run, f"{keep} {kind}, size int, hash long")


def _shuffled_search(rows: DataFrame, items: DataFrame) -> DataFrame:
    """The same by joins: texts are named by their digest, so repeated texts are searched once."""
    docs = rows.select("row.text")
    items = saved(items.withColumn("place", F.monotonically_increasing_id()), "items")
    sketch = saved(_hashed(items, "place").withColumn("part", F.floor(F.log2("size"))), "sketch")
    # one row for each power of two
    bounds = [(needed(r.size), r.bound) for r in sketch.groupBy("part").agg(F.min("size").alias("size"), F.max("hash").alias("bound")).collect()]

    @F.pandas_udf("int")
    def lengths(texts: pd.Series) -> pd.Series:
        return pd.Series([min(len(words_of(t)), SHINGLE) for t in texts])

    short = [r.n for r in items.select(lengths("text").alias("n")).distinct().collect() if 0 < r.n < SHINGLE]  # four at most
    named = rows.select("row", F.md5(text_of("row.text").cast("binary")).alias("digest"))
    texts = saved(docs.select(F.md5(text_of().cast("binary")).alias("digest"), "text").groupBy("digest").agg(F.first("text").alias("text"), F.count(F.lit(1)).alias("n")), "texts")
    pairs = saved(_hashed(texts, "digest", bounds, short).select("digest", "hash").join(sketch.select("place", "hash"), "hash").select("digest", "place").distinct(), "candidates")
    lots = pairs.groupBy("digest").agg(F.ceil(F.count(F.lit(1)) / TOGETHER).alias("lots"))
    listed = pairs.join(lots, "digest").join(items.select("place", "item_id", F.col("text").alias("item")), "place")
    listed = listed.groupBy("digest", F.pmod(F.xxhash64("place"), "lots").alias("lot")).agg(F.collect_list(F.struct("item_id", "item")).alias("items"))

    @F.pandas_udf(HITS)
    def verify(texts: pd.Series, candidates: pd.Series) -> pd.Series:
        out = []
        for text, own in zip(texts, candidates):
            held, hits = all_shingles(words_of(text), short), []
            for x in own:
                item = set(shingles(words_of(x["item"])))
                if len(item & held) >= needed(len(item)):
                    hits.append({"item_id": x["item_id"], "held": len(item & held), "size": len(item)})
            out.append(hits)
        return pd.Series(out)

    found = listed.join(texts, "digest").select("digest", "n", verify("text", "items").alias("hits"))
    hits = saved(found.groupBy("digest").agg(F.flatten(F.collect_list("hits")).alias("hits"), F.first("n").alias("n")), "hits")
    return join_counted(named, hits, ["digest"], "left").select("row", F.coalesce("hits", F.expr(f"cast(array() as {HITS})")).alias("hits"))


def _searched(rows: DataFrame, items: DataFrame, broadcast_shingles: int) -> DataFrame:
    """rows (row) with ``hits``."""
    items = items.select(F.col("item_id").cast("long").alias("item_id"), "text")
    # an item has no more shingles than half its characters
    size = items.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    if size / 2 <= broadcast_shingles:
        return _broadcast_search(rows, [(r.item_id, r.text) for r in items.collect()])
    return _shuffled_search(rows, items)


def search_benchmark(docs: DataFrame, items: DataFrame, broadcast_shingles: int = BROADCAST_SHINGLES) -> DataFrame:
    """docs with ``hits``: the items (item_id, held, size) that contaminate the row's text, empty if none."""
    return _searched(packed(docs.drop("hits")), items, broadcast_shingles).select("row.*", "hits")


def clean_documents(docs: DataFrame, items: DataFrame, broadcast_shingles: int = BROADCAST_SHINGLES) -> DataFrame:
    """The rows of docs that no item contaminates."""
    return _searched(packed(docs), items, broadcast_shingles).filter(F.size("hits") == 0).select("row.*")


def op5_contained_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each document and benchmark item that contaminates it."""
    found = search_benchmark(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", F.inline("hits")).select("doc_id", "item_id", F.col("held").cast("long").alias("held"), F.col("size").cast("long").alias("item_size"))


_SHINGLED = """select {k} id, unnest(case when len(w) = 0 then [] when len(w) < 5 then [array_to_string(w, ' ')]
  else list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) end) s from (select {k}, regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}]+') w from {t})"""
_SQL = f"""
with i as (select distinct * from ({_SHINGLED.format(k="item_id", t="benchmark")})),
 d as (select distinct * from ({_SHINGLED.format(k="doc_id", t="documents")})),
 n as (select id, count(*) n from i group by id),
 short as (select distinct len(regexp_extract_all(s, '[^ ]+')) k from i where len(regexp_extract_all(s, '[^ ]+')) < 5),
 e as (select * from d union select id, unnest(list_transform(range(1, len(w) - k + 2), lambda j: array_to_string(w[j:j + k - 1], ' '))) from (select doc_id id, regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}]+') w, k from documents, short) where len(w) > k)
select d.id doc_id, i.id item_id, count(*) held, n.n item_size from e d join i using (s) join n on n.id = i.id group by all having count(*) >= {CONTAINMENT} * n.n
"""

QUERIES = {"op5_contained_items": op5_contained_items}
SQL = {"op5_contained_items": _SQL}
