"""Near-duplicates by the Jaccard similarity of five-word shingles, found by SimHash and completed exactly.

Texts are sets of shingles (words as in simhash: lower case ASCII letters, cut at
ASCII white space), each a 64-bit hash. Two texts are near-duplicates if their sets
have a similarity of ``4/5`` or more, directly or by steps.

SimHash comes first: sets of equal fingerprints, and those that pigeonring filtering
finds within two bits, are candidates, and the shingles themselves decide. That links
most copies at the cost of one fingerprint each, and what follows is a search between
the classes it leaves, not between sets: a shingle that only one class holds is asked
no more. But a similarity of 4/5 leaves some 10 of 64 bits to differ, and no budget of
bits that wide would tell copies from others, so that second search completes the
classes: two sets of that similarity share a shingle among the first
``n - ceil(4n/5) + 1`` of each, in any order of all shingles, so only these prefixes
meet and no pair is lost.

The order of shingles bears on speed, never on results. Those frequent in a sample come
last. Of the others, those in a fixed share of the hash range come first and are
counted over all sets: first those that one class holds, then the rarer ones. That
share is wider than a prefix, so the prefix of a set without a partner is mostly made
of its own shingles, and it meets none, however many texts there are.

Pairs that meet are pruned by size and by parity maps of 256 bits, then of 1,024:
maps never differ in more bits than the sets in shingles. The shingles decide the rest. Sets that share
a crowded shingle are first held against a few pivots; after that, only pairs not yet
known to be of one class are looked at, block by block. Two sets that share many
shingles of their prefixes would meet at each; as each set knows which of its own
come shortly before, the rarest first, they make a pair where they first meet and hardly ever again.

Defined cases: texts without words are alike; a text of one to four words is one
shingle; a long text is a larger set; equal sets are one node, so exact copies and
repeated rows never meet one another; ties in frequency go by hash; a null doc_id is a
row like any other; an empty table gives no rows; columns may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import simhash
from .common import join_counted, saved
from .graph import components

SHINGLE = 5
#: Longs of a parity map.
MAPS = 4
#: Bits of the wide parity map that a pair is held against before its texts are: 256 bits are all alike to sets of over 600 shingles.
WIDE = 1024
#: Documents of the sample that orders shingles, and shingles known as frequent, at most.
SAMPLE = 5_000
FREQUENT = 50_000
#: Shingles below this hash are counted: three tenths of all, where a prefix takes two.
COUNTED = 3 * (1 << 64) // 10
#: Sets of a block; pivots that sets of a shingle with more than a block are held against.
BLOCK = 48
PIVOTS = 8
#: Shingles of its prefix that a set brings along to the next one, so that two sets do not make a pair at each that they share.
BEFORE = 8


def shingles(text: str | None) -> np.ndarray:
    """The distinct shingles of a text by hash, in order."""
    return np.unique(simhash.shingle_hashes(text, SHINGLE))


def _digest(own: np.ndarray) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(own.astype("<u8").tobytes(), simhash.SEED)


def digests(docs: DataFrame, name: str = "fp") -> DataFrame:
    """Adds the digest of the text's set of shingles as a long."""

    @F.pandas_udf("long")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(np.array([_digest(shingles(x)) for x in texts], "u8").view("i8"))

    return docs.withColumn(name, run("text"))


def frequent(docs: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Shingles that texts of a sample share, in order, and in how many of its texts they stand."""
    n = docs.count()
    texts = docs.select("text").filter(F.pmod(F.xxhash64("text"), F.lit(1 << 20)) < F.lit((1 << 20) * min(1.0, SAMPLE / max(n, 1)))).distinct()

    @F.pandas_udf("array<long>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([shingles(x).view("i8") for x in batch])

    counts = texts.select(F.explode(run("text")).alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    rows = counts.orderBy(F.desc("n"), "token").limit(FREQUENT).collect()
    tokens, times = np.array([r.token for r in rows], "i8").view("u8"), np.array([r.n for r in rows], "int64")
    order = np.argsort(tokens)
    return tokens[order], times[order]


def prepared(docs: DataFrame) -> DataFrame:
    """(doc_id, row, text, fp, sim, n, spare, wide, map0.., tokens, common) of each row: its text, and its set's digest, SimHash, size, parity maps and first shingles.

    ``common`` are those of the first shingles that are known as frequent, ``spare`` is by
    how many the others outnumber the prefix. The text is kept and not the set, which has twice its bytes and none to spare: the few that are compared are made again.
    """
    known, times = frequent(docs)
    maps = [f"map{k}" for k in range(MAPS)]

    @F.pandas_udf(f"struct<fp:long,sim:long,n:int,spare:int,wide:array<long>,{','.join(f'{m}:long' for m in maps)},tokens:array<long>,common:array<long>>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            out = []
            for text in texts:
                own = shingles(text)
                n = len(own)
                wide = (np.bincount((own % np.uint64(WIDE)).astype("int64"), minlength=WIDE) & 1).astype("u1")
                parity = np.packbits(np.bitwise_xor.reduce(wide.reshape(-1, 64 * MAPS)), bitorder="little").view("<i8")
                often = np.zeros(n, "int64")
                if len(known):
                    at = np.minimum(np.searchsorted(known, own), len(known) - 1)
                    often = np.where(known[at] == own, times[at], 0)
                prefix = n - -(-4 * n // 5) + 1
                spare = max(0, int(np.searchsorted(own[often == 0], np.uint64(COUNTED))) - prefix)
                first = np.argsort(often, kind="stable")[: prefix + spare]
                tokens, common = (own[first[told]].view("i8") for told in (often[first] == 0, often[first] > 0))
                out.append((int(np.uint64(_digest(own)).view("i8")), int(np.uint64(simhash.majority(own.astype("<u8"))).view("i8")), n, spare, np.packbits(wide, bitorder="little").view("<i8"), *parity.tolist(), tokens, common))
            yield pd.DataFrame(out, columns=["fp", "sim", "n", "spare", "wide", *maps, "tokens", "common"])

    return docs.select("doc_id", F.monotonically_increasing_id().alias("row"), "text", run("text").alias("s")).select("doc_id", "row", "text", "s.*")


def _near(x, y) -> Column:
    """Whether sizes and parity maps allow a similarity of 4/5."""
    apart = sum((F.bit_count(x[f"map{k}"].bitwiseXOR(y[f"map{k}"])) for k in range(1, MAPS)), F.bit_count(x["map0"].bitwiseXOR(y["map0"])))
    return (5 * x["n"] >= 4 * y["n"]) & (5 * y["n"] >= 4 * x["n"]) & (9 * apart <= x["n"] + y["n"])


def _verified(pairs: DataFrame, found: DataFrame, nodes: DataFrame) -> DataFrame:
    """Those of the saved pairs (a, b) that share 4/5 of their shingles. Only texts that are in a pair are read."""
    need = saved(nodes.select("fp", "row").join(pairs.select(F.explode(F.array("a", "b")).alias("fp")).distinct(), "fp", "left_semi").select("row"), "need")
    texts = found.select("row", "fp", "text").join(need, "row", "left_semi")
    a, b = (texts.select(F.col("fp").alias(k), F.col("text").alias(f"text_{k}")) for k in "ab")

    @F.pandas_udf("boolean")
    def alike(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        own = lru_cache(256)(shingles)  # pairs come by their second text
        for columns in batches:
            out = []
            for x, y in zip(*columns):
                x, y = own(x), own(y)
                out.append(9 * len(np.intersect1d(x, y, assume_unique=True)) >= 4 * (len(x) + len(y)))
            yield pd.Series(out)

    return pairs.join(a, "a").join(b, "b").filter(alike("text_a", "text_b")).select("a", "b")


def _allowed(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Those of the pairs (a, b) whose wide parity maps allow a similarity of 4/5, with ``near``, the greater the nearer by these maps."""
    a, b = (nodes.select(F.col("fp").alias(k), F.col("n").alias(f"n_{k}"), F.col("wide").alias(f"wide_{k}")) for k in "ab")
    apart = F.aggregate(F.zip_with("wide_a", "wide_b", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda t, n: t + n)
    both = pairs.join(a, "a").join(b, "b").select("a", "b", (F.col("n_a") + F.col("n_b")).alias("size"), apart.alias("apart"))
    return both.filter(9 * F.col("apart") <= F.col("size")).select("a", "b", (1 - F.col("apart") / F.greatest("size", F.lit(1))).cast("float").alias("near"))


def _linked(pairs: DataFrame, before: DataFrame, found: DataFrame, nodes: DataFrame, name: str) -> DataFrame:
    """Those of the saved pairs (a, b) that are similar, but for pairs whose sets the links before and the other pairs here make one class.

    A pair's sets move to be compared, so each set is first held against one partner, the
    nearest by their parity maps; of its other pairs only those are left whose sets are not yet of one class.
    """
    pairs = saved(_allowed(pairs, nodes), f"{name}-allowed")
    best = pairs.groupBy("a").agg(F.max_by("b", F.struct("near", "b")).alias("b"))
    best = saved(best, f"{name}-best")
    links = saved(_verified(best, found, nodes), f"{name}-best-links")
    known = components(links.unionByName(before))
    root = lambda k: known.select(F.col("node").alias(k), F.col("root").alias(f"root_{k}"))
    open_ = pairs.select("a", "b").join(best, ["a", "b"], "left_anti").join(root("a"), "a", "left").join(root("b"), "b", "left")
    open_ = saved(open_.filter(F.coalesce("root_a", "a") != F.coalesce("root_b", "b")).select("a", "b"), f"{name}-open")
    return links.unionByName(_verified(open_, found, nodes))


def simhash_pairs(nodes: DataFrame) -> DataFrame:
    """(a, b), distinct: each set and the least set of its fingerprint, and the least sets of fingerprints that pigeonring filtering links."""
    least = saved(nodes.groupBy("sim").agg(F.min("fp").alias("first"), F.count(F.lit(1)).alias("n")), "sims")
    own = join_counted(nodes.select("sim", "fp"), least, ["sim"]).select(F.col("fp").alias("a"), F.col("first").alias("b"))
    a, b = (least.select(F.col("sim").alias(k), F.col("first").alias(f"first_{k}")) for k in "ab")
    near = simhash.links(least.select(F.col("sim").alias("fp"))).distinct().join(a, "a").join(b, "b").select(F.col("first_a").alias("a"), F.col("first_b").alias("b"))
    return own.unionByName(near).filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def prefixes(found: DataFrame, firsts: DataFrame, nodes: DataFrame, known: DataFrame) -> DataFrame:
    """(token, fp) of each set's prefix, without shingles that only one of the classes known (fp, root) holds."""
    at = lambda k, row: nodes.select(F.col("fp").alias(k), F.col("row").alias(row))
    linked = known.join(at("fp", "row"), "fp").join(at("root", "class"), "root").select("row", "class", F.lit(False).alias("copy"))
    copies = found.select("row").join(firsts, "row", "left_anti").select("row", F.lit(None).cast("long").alias("class"), F.lit(True).alias("copy"))
    told = saved(linked.unionByName(copies).withColumn("rows", F.lit(1)), "linked-and-copies")
    sets = join_counted(found.select("row", "tokens", "common"), told, ["row"], "left", n="rows").filter(~F.coalesce("copy", F.lit(False)))
    sets = sets.withColumn("class", F.coalesce("class", "row"))

    # shingles that are not frequent: counted where they meet, and the most crowded beyond the prefix left out
    own = Window.partitionBy("token")
    rare = sets.select("row", "class", F.explode("tokens").alias("token"))
    rare = rare.select("token", "row", F.count(F.lit(1)).over(own).alias("times"), F.min("class").over(own).alias("low"), F.max("class").over(own).alias("high"))
    rare = rare.filter("low != high").select("token", "row", "times").join(nodes.select("row", "fp", "spare"), "row")
    place = F.row_number().over(Window.partitionBy("row").orderBy(F.desc("times"), F.desc("token")))
    rare = rare.withColumn("place", place).filter(F.col("place") > F.col("spare")).select("token", "fp")

    # frequent ones may be in any number of sets, so these are never gathered
    common = sets.select("row", "class", F.explode("common").alias("token"))
    shared = common.groupBy("token").agg(F.count(F.lit(1)).alias("rows"), F.min("class").alias("low"), F.max("class").alias("high"))
    shared = saved(shared.filter("low != high").select("token", "rows"), "shared-frequent")
    common = join_counted(common.select("token", "row"), shared, ["token"], n="rows").join(nodes.select("row", "fp"), "row").select("token", "fp")
    return saved(rare.unionByName(common), "prefixes")


def meetings(met: DataFrame) -> DataFrame:
    """(a, b), few of them twice: all pairs of sets that share a shingle, are not of one class and may be similar. met: (token, fp, times, before, root, n, map0..).

    A pair is made where the last ``BEFORE`` shingles of both, in one order of all shingles, have none in common. That
    holds where they first meet, so no pair is lost, and seldom after that.
    """
    facts = ["fp", "n", *[f"map{k}" for k in range(MAPS)], "root", "before"]
    block = F.when(F.col("times") > BLOCK, F.pmod(F.xxhash64("fp"), F.ceil(F.col("times") / BLOCK))).otherwise(0).cast("int").alias("block")
    blocks = saved(met.select("token", "times", block, F.struct(*facts).alias("x")).groupBy("token", "times", "block").agg(F.collect_list("x").alias("xs"), F.min("x.root").alias("low"), F.max("x.root").alias("high")), "blocks")

    def pairs(xs: Column, ys: Column, later: bool) -> Column:
        def with_others(x: Column, i: Column) -> Column:
            others = F.slice(ys, i + 2, F.size(ys)) if later else ys
            new = F.filter(others, lambda y: (x["root"] != y["root"]) & _near(x, y) & ~F.arrays_overlap(x["before"], y["before"]))
            return F.transform(new, lambda y: F.struct(F.greatest(x["fp"], y["fp"]).alias("a"), F.least(x["fp"], y["fp"]).alias("b")))

        return F.flatten(F.transform(xs, with_others))

    # two blocks of a crowded shingle meet by shingle and both their numbers, so a hot shingle is dealt out before its blocks are joined
    crowded = blocks.filter(F.col("times") > BLOCK)
    mixed = crowded.groupBy("token").agg(F.min("low").alias("low"), F.max("high").alias("high")).filter("low != high").select("token")
    crowded = crowded.drop("low", "high").join(saved(mixed, "mixed-shingles"), "token", "left_semi").withColumn("of", F.ceil(F.col("times") / BLOCK).cast("int"))
    early = crowded.filter(F.col("block") + 1 < F.col("of")).select("token", F.col("block").alias("i"), F.explode(F.sequence(F.col("block") + 1, F.col("of") - 1)).alias("j"), "xs")
    late = crowded.filter("block > 0").select("token", F.explode(F.sequence(F.lit(0), F.col("block") - 1)).alias("i"), F.col("block").alias("j"), F.col("xs").alias("ys"))
    across = early.join(late, ["token", "i", "j"])
    return blocks.select(F.inline(pairs(F.col("xs"), F.col("xs"), True))).unionByName(across.select(F.inline(pairs(F.col("xs"), F.col("ys"), False))))


def links(found: DataFrame) -> DataFrame:
    """(a, b) that connect just those digests whose sets are similar by 4/5, directly or by steps. found: prepared(docs), saved."""
    facts = ["fp", "n", *[f"map{k}" for k in range(MAPS)]]
    firsts = saved(found.groupBy("fp").agg(F.min("row").alias("row")).select("row"), "first-rows")
    nodes = saved(found.drop("doc_id", "text", "tokens", "common").join(firsts, "row", "left_semi"), "sets")

    # fingerprints: what they link is one class to all that follows
    near = saved(_allowed(simhash_pairs(nodes), nodes), "print-pairs")
    printed = saved(_verified(near.select("a", "b"), found, nodes), "print-links")
    tokens = prefixes(found, firsts, nodes, components(printed).withColumnRenamed("node", "fp"))
    shared = saved(tokens.groupBy("token").agg(F.count(F.lit(1)).alias("times")).filter("times > 1").withColumn("rows", F.col("times")), "shared-shingles")
    order = Window.partitionBy("fp").orderBy("times", "token")
    before = F.array_compact(F.array(*[F.lag("token", k).over(order) for k in range(1, BEFORE + 1)])).alias("before")
    met = join_counted(tokens, shared, ["token"], n="rows").select("token", "fp", "times", before)
    met = saved(met.join(nodes.select(facts), "fp"), "met")

    # crowded shingles: all against a few pivots
    many = met.filter(F.col("times") > BLOCK)
    pivots = [F.min_by("fp", F.xxhash64(F.lit(k), "fp")) for k in range(PIVOTS)]
    centres = many.groupBy("token").agg(*[p.alias(f"c{k}") for k, p in enumerate(pivots)], F.count(F.lit(1)).alias("rows"))
    centres = centres.select("token", "rows", F.explode(F.array_distinct(F.array(*[f"c{k}" for k in range(PIVOTS)]))).alias("fp")).join(nodes.select(facts), "fp")
    centres = saved(centres.groupBy("token", "rows").agg(F.collect_list(F.struct(*facts)).alias("centres")), "centres")
    near = F.filter("centres", lambda c: (c["fp"] != F.col("fp")) & _near(c, {k: F.col(k) for k in facts}))
    stars = join_counted(many, centres, ["token"], n="rows").select("fp", F.explode(near).alias("c")).select(F.greatest("fp", "c.fp").alias("a"), F.least("fp", "c.fp").alias("b"))
    first = saved(printed.unionByName(_linked(saved(stars.distinct(), "first-pairs"), printed, found, nodes, "first")), "first-links")
    known = components(first).select(F.col("node").alias("fp"), "root")
    met = met.join(known, "fp", "left").withColumn("root", F.coalesce("root", "fp"))

    rest = saved(meetings(met).distinct(), "pairs")
    return first.unionByName(_linked(rest, first, found, nodes, "rest"))


def similar_documents(docs: DataFrame) -> DataFrame:
    """(doc_id, fp, root, component_id) for each row of docs; fp is the digest of the row's shingles."""
    prints = saved(prepared(docs.select("doc_id", "text")), "prints")
    rows = prints.select("doc_id", "fp")
    return join_counted(rows, simhash.classes(rows, lambda _: links(prints)), ["fp"]).select("doc_id", "fp", "root", "component_id")
