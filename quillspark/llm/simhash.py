"""SimHash near-duplicates, found by pigeonring filtering.

A fingerprint's 64 bits are a ring of 16 segments of 4 bits. Two fingerprints
that differ in at most 2 bits have, by the pigeonring principle, a segment from
which every chain of l consecutive segments differs in at most ``l * 2 / 16``
bits. Chains up to length 7 must therefore be equal: 28 bits, the key on which
candidates meet, once for each of the 16 starting segments. Chains of 8 to 15
segments may differ in one bit and the whole ring in two; that prunes a
candidate before its full Hamming distance counts as a link.

Work is done on distinct fingerprints, so exact copies never meet one another.
A key that at most ``BUCKET`` fingerprints share is compared pair by pair. The members
of more crowded ones are linked exactly without pairs: each sends itself and its 64
one-bit changes to a pivot; two of them differ in two bits or fewer just when they
share a pivot, a pivot has 65 members at most, and each links its members to its
least one. So a fingerprint costs 65 rows at most, be there ever so many.

Defined cases: a null or empty text has fingerprint zero and is linked like any
other; a long text is read once, in pieces; a null doc_id gets its component's least
known id, or null if it has none; repeated rows and ties share a component; an empty
table gives no rows; columns of the input may have any name.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import identity, join_counted, packed, saved, table, text_of
from .graph import components

#: Words of a shingle, and the XXH64 seed.
SHINGLE = 3
SEED = 42
#: Shingles of a text that are looked at together.
PIECE = 1 << 15
#: Bits in which linked fingerprints may differ; segments of the ring; segments of the longest chain that must be equal.
MOST_BITS = 2
SEGMENTS = 16
WIDTH = 64 // SEGMENTS
EQUAL = -(-SEGMENTS // MOST_BITS) - 1
#: Fingerprints that share a key and are still compared pair by pair.
BUCKET = 48


def shingle_hashes(text: str | None, shingle: int) -> np.ndarray:
    """XXH64 of each shingle of a text, in order, repeats included; fewer words are one shingle, none have none."""
    import xxhash

    joined = b" ".join((text or "").encode("utf-8", "surrogatepass").lower().split())  # of bytes: ASCII letters and ASCII white space only
    if not joined:
        return np.zeros(0, "<u8")
    spaces = np.flatnonzero(np.frombuffer(joined, "u1") == 32)
    begin, end = np.concatenate([[0], spaces + 1]), np.append(spaces, len(joined))
    last = min(shingle, len(begin))
    begin, end = begin[: len(begin) - last + 1], end[last - 1 :]
    out, digest = np.empty(len(begin), "<u8"), xxhash.xxh64_intdigest
    for k in range(0, len(begin), PIECE):
        out[k : k + PIECE] = [digest(joined[a:b], SEED) for a, b in zip(begin[k : k + PIECE].tolist(), end[k : k + PIECE].tolist())]
    return out


def majority(hashes: np.ndarray) -> int:
    """Which of 64 bits are set in over half of the hashes."""
    counts = np.zeros(64, "int64")
    for k in range(0, len(hashes), PIECE):
        counts += np.unpackbits(hashes[k : k + PIECE].view("u1").reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype="int64")
    return int(np.packbits(counts * 2 > len(hashes), bitorder="little").view("<u8")[0])


def fingerprint(text: str | None) -> int:
    """The unsigned fingerprint of one text."""
    return majority(shingle_hashes(text, SHINGLE))


def fingerprints(docs: DataFrame, name: str = "fp") -> DataFrame:
    """Adds the fingerprint's 64 bits as a long."""

    @F.pandas_udf("long")
    def fp(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(np.array([fingerprint(x) for x in texts], "u8").view("i8"))

    return docs.withColumn(name, fp("text"))


def _turned(bits: Column, by: int) -> Column:
    """The bits turned right around the ring."""
    return bits if by % 64 == 0 else F.shiftrightunsigned(bits, by).bitwiseOR(F.shiftleft(bits, 64 - by))


def _chain(start: int, segments: int) -> int:
    """A mask, as a signed long, of so many segments of the ring from the one at start."""
    mask = sum(((1 << WIDTH) - 1) << (WIDTH * ((start + k) % SEGMENTS)) for k in range(segments))
    return mask - (1 << 64) if mask >> 63 else mask


def chain_keys(fps: DataFrame) -> DataFrame:
    """(start, chain, fp): the longest equal chain from each segment of each distinct fingerprint."""
    chains = [F.struct(F.lit(k).cast("byte").alias("start"), _turned(F.col("fp"), WIDTH * k).bitwiseAND(F.lit((1 << (WIDTH * EQUAL)) - 1)).cast("int").alias("chain")) for k in range(SEGMENTS)]
    return fps.select("fp", F.inline(F.array(*chains)))


def links(fps: DataFrame) -> DataFrame:
    """(a, b) that connect just those distinct fingerprints within MOST_BITS of each other, directly or by steps."""
    keys = chain_keys(fps)
    shared = saved(keys.groupBy("start", "chain").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").withColumn("times", F.col("n")), "shared-chains")
    met = saved(join_counted(keys, shared, ["start", "chain"]), "chains")
    few, many = met.filter(F.col("times") <= BUCKET), met.filter(F.col("times") > BUCKET)

    # the longest chain that may differ in one bit, from each start
    nearly = F.element_at(F.array(*[F.lit(_chain(k, SEGMENTS - 1)) for k in range(SEGMENTS)]), F.col("start") + 1)

    def pairs(members: Column) -> Column:
        def with_later(x: Column, i: Column) -> Column:
            later = F.slice(members, i + 2, F.size(members))
            near = F.filter(later, lambda y: (F.bit_count(x.bitwiseXOR(y).bitwiseAND(F.col("nearly"))) <= 1) & (F.bit_count(x.bitwiseXOR(y)) <= MOST_BITS))
            return F.transform(near, lambda y: F.struct(x.alias("a"), y.alias("b")))

        return F.flatten(F.transform(members, with_later))

    by_pair = few.groupBy("start", "chain").agg(F.collect_list("fp").alias("fps")).withColumn("nearly", nearly).select(F.inline(pairs(F.col("fps"))))
    changes = [F.lit(0).cast("long"), *[F.lit((1 << b) - (1 << 64 if b == 63 else 0)).cast("long") for b in range(64)]]
    pivots = many.select("fp").distinct().select("fp", F.explode(F.array(*changes)).alias("change")).select("fp", F.col("fp").bitwiseXOR(F.col("change")).alias("pivot"))
    centre = pivots.groupBy("pivot").agg(F.min("fp").alias("b"), F.count(F.lit(1)).alias("members")).filter("members > 1")
    by_pivot = pivots.join(centre, "pivot").select(F.col("fp").alias("a"), "b").filter("a != b")
    return by_pair.unionByName(by_pivot)


def classes(prints: DataFrame, link: Callable[[DataFrame], DataFrame] = links) -> DataFrame:
    """(fp, root, component_id, n) for each distinct fp of (doc_id, fp); root names the class by its least fingerprint, n rows have the fp."""
    nodes = saved(prints.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("n")), "fingerprints")
    roots = components(link(nodes.select("fp"))).withColumnRenamed("node", "fp")
    rooted = saved(nodes.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp")), "rooted")
    least = saved(rooted.groupBy("root").agg(F.min("least").alias("component_id"), F.count(F.lit(1)).alias("members")), "components")
    return saved(join_counted(rooted, least, ["root"], n="members").select("fp", "root", "component_id", "n"), "classes")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, fp, root, component_id) for each row of docs."""
    prints = saved(fingerprints(docs.select("doc_id", "text")).select("doc_id", "fp"), "prints")
    return join_counted(prints, classes(prints), ["fp"]).select("doc_id", "fp", "root", "component_id")


def one_of_each(docs: DataFrame, find: Callable[[DataFrame], DataFrame] = near_duplicates, prints: Callable[[DataFrame, str], DataFrame] = fingerprints) -> DataFrame:
    """The rows of docs, one of each class of near-duplicates: that with the least doc_id.

    ``find`` gives the classes and ``prints`` the fp on which they rest.

    Rows without a doc_id go unless the class has no other. Where the kept doc_id
    stands in several rows, the one whose text is least stays.
    """
    found = saved(find(docs), "found")
    often = found.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"))
    kept = found.filter(F.col("doc_id").eqNullSafe(F.col("component_id"))).select("doc_id", "fp", "root").distinct()
    kept = saved(kept.alias("k").join(often.alias("o"), F.col("k.doc_id").eqNullSafe(F.col("o.doc_id"))).select("k.*", "n"), "kept")
    sure, doubtful = (F.col("doc_id").isNotNull() & (F.col("n") == 1)), kept.filter("doc_id is null or n > 1")
    rows = packed(docs, "doc_id", "text", *identity(docs))
    single = rows.join(kept.filter(sure).select("doc_id"), "doc_id", "left_semi").select("row.*")
    if doubtful.isEmpty():
        return single
    ids = doubtful.select(F.col("doc_id").alias("id"), F.col("fp").alias("id_fp"), F.col("root"))
    own = prints(rows.join(ids, rows["doc_id"].eqNullSafe(ids["id"]), "left_semi"), "fp")
    own = own.join(ids, own["doc_id"].eqNullSafe(ids["id"]) & (own["fp"] == ids["id_fp"]))
    one = own.groupBy("root").agg(F.min_by("row", F.struct(text_of(), "k1", "k2")).alias("row"))
    return single.unionByName(one.select("row.*"))


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and class of every document."""
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


QUERIES = {"op2_simhash": op2_simhash}
SQL: dict[str, str] = {}
