"""Mixing sources to target weights by fixed-length blocks.

Words of a source are laid end to end in a fixed pseudorandom order of its
documents and cut into blocks of ``block_words`` (a source's last block may be
short). The mixture is a row of slots, dealt into output shards: the numbers of
slots that a source has in the shards are one multinomial draw, so each shard's
numbers of slots per source are multinomial draws too, conditioned on the sources'
totals; the whole mixture meets its targets instead of wandering about them. A
source's j-th slot takes the block to which a keyed permutation of its block
numbers sends ``j mod blocks``, so a source is used up before it repeats; slots and
blocks then join on (source, block). The last slot of a source is cut where its
target is reached.

Targets: sources in code point order, null last, weigh 1, 2, 3, repeating, or as a
table says; they share all words, but none gets over ``most`` times its own size:
what it cannot take is shared by weight among the rest until none is above. That
level is found by a few sums over the table of sources.

The plan is a table of one row for each source, however many there are, and is
never on the driver. Sources are ranked by ranges; a source is dealt over many
buckets for the prefix sums of document sizes, so one that holds a third of all
rows is no task's burden.

Defined cases: a null or empty text has size 0 and is never taken; a long text runs
through as many blocks as it fills; a null source is a source of its own; rows are
told apart by all their columns, nulls included, and rows alike in all are documents
of their own, each taken; an empty table, or one without any word, gives targets of
0 and an empty mixture; columns of the input may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import WORD, identity, join_counted, packed, saved, table, text_of, word_count

BLOCK_WORDS = 1024
N_SHARDS = 64
SEED = 17
MOST_TIMES = 3.0
#: Documents for each bucket, about, and buckets at least and at most.
BUCKET_ROWS = 4096
BUCKETS = 64, 1 << 20
#: Slots that a task makes at a time.
RUN = 1 << 16
MASK = (1 << 32) - 1

FACTS = "blocks long, full long, rest long, lack long, short long"


def _round(x: np.ndarray, key: np.ndarray) -> np.ndarray:
    """A 32-bit mixing function (the multiply-xorshift kind)."""
    x = ((x ^ (key & np.uint64(MASK))) * np.uint64(0x9E3779B1)) & np.uint64(MASK)
    x ^= x >> np.uint64(15)
    x = (x * np.uint64(0x85EBCA77)) & np.uint64(MASK)
    return x ^ (x >> np.uint64(13))


def permute(index: np.ndarray, n: np.ndarray | int, key: np.ndarray | int, back: bool = False) -> np.ndarray:
    """Keyed permutations of 0..n-1: 4-round Feistel networks over the next even power of two, walked until inside.

    n and key may differ by element; ``back`` gives the inverse.
    """
    x = np.asarray(index, "uint64").copy()
    n, key = np.broadcast_to(np.asarray(n, "uint64"), x.shape), np.broadcast_to(np.asarray(key, "uint64"), x.shape)
    top, inverse = np.unique(n, return_inverse=True)
    half = np.array([max(1, (max(int(m) - 1, 1).bit_length() + 1) // 2) for m in top], "uint64")[inverse]
    todo = np.arange(len(x))
    while len(todo):
        width, own = half[todo], key[todo] * np.uint64(4)
        low = (np.uint64(1) << width) - np.uint64(1)
        a, b = x[todo] >> width, x[todo] & low
        for k in range(4):
            if back:
                a, b = b ^ (_round(a, own + np.uint64(3 - k)) & low), a
            else:
                a, b = b, a ^ (_round(b, own + np.uint64(k)) & low)
        x[todo] = (a << width) | b
        todo = todo[x[todo] >= n[todo]]
    return x.astype("int64")


@dataclass
class Mixture:
    """``docs``: rows (doc_id, size, source_id, bucket, nth, start, k1, k2); ``sources``: the plan, one row each; ``slots``: (shard, position, source_id, pass_no, block, take)."""

    docs: DataFrame
    sources: DataFrame
    slots: DataFrame
    block_words: int

    def pieces(self) -> DataFrame:
        """The mixture: for each slot the documents' pieces in it (from_word, n_words of the document)."""
        length = self.block_words
        first, last = F.floor(F.col("start") / length), F.floor((F.col("start") + F.col("size") - 1) / length)
        parts = self.docs.filter("size > 0").withColumn("block", F.explode(F.sequence(first, last)))
        parts = parts.withColumn("begin", F.greatest("start", F.col("block") * length))
        # Spark takes the slots for as few as the runs they unfold from; they grow with the words and are never to be broadcast
        met = parts.join(self.slots.hint("merge"), ["source_id", "block"])
        end = F.least(F.col("start") + F.col("size"), F.col("block") * length + F.col("take"))
        return met.select("shard", "position", "source_id", "block", "pass_no", "doc_id", "bucket", "nth", (F.col("begin") - F.col("start")).alias("from_word"), (end - F.col("begin")).alias("n_words")).filter("n_words > 0")


def ranked(sources: DataFrame) -> DataFrame:
    """sources (src, known, ...) with ``source_id``, their place from 0 in code point order, unknown last; ranges are counted, so no task sorts all."""
    order = F.desc("known"), F.col("src")
    ranged = saved(sources.repartitionByRange(*order).withColumn("part", F.spark_partition_id()), "source-ranges")
    before, starts = 0, []
    for r in ranged.groupBy("part").agg(F.count(F.lit(1)).alias("n")).orderBy("part").collect():
        starts.append((r.part, before))
        before += r.n
    starts = sources.sparkSession.createDataFrame(starts, "part int, first long")
    within = F.row_number().over(Window.partitionBy("part").orderBy(*order)) - 1
    return ranged.withColumn("within", within).join(F.broadcast(starts), "part").withColumn("source_id", F.col("first") + F.col("within")).drop("part", "first", "within")


def with_targets(sources: DataFrame, most: float = MOST_TIMES) -> DataFrame:
    """sources (size, weight, ...) with ``target``: the sum of all sizes by weight, held at most times a source's size."""
    exact = F.col("weight").cast("decimal(30,9)")  # so that the order of adding up bears on nothing
    cap = F.col("size") * F.lit(most)
    total, weight = sources.agg(F.coalesce(F.sum("size"), F.lit(0)), F.sum(exact)).first()
    level, closed = total / float(weight) if weight else 0.0, 0
    while True:  # words a unit of weight; each turn closes one source or more, or ends
        over = F.col("weight") * F.lit(level) > cap
        taken, weight, n = sources.agg(F.coalesce(F.sum(F.when(over, F.col("size"))), F.lit(0)), F.sum(F.when(~over, exact)), F.count_if(over)).first()
        if n == closed or not weight:
            return sources.withColumn("target", F.when(over, cap).otherwise(F.col("weight") * F.lit(level)))
        level, closed = (total - taken * most) / float(weight), n


def deal(n_slots: int, source_id: int, n_shards: int, seed: int) -> np.ndarray:
    """A source's slots in each shard: one multinomial draw."""
    return np.random.default_rng([seed, source_id]).multinomial(n_slots, np.full(n_shards, 1 / n_shards))


def _planned(sources: DataFrame, block_words: int, n_shards: int, seed: int) -> DataFrame:
    """Adds each source's blocks, where its last pass ends, and its slots by shard."""

    @F.pandas_udf(f"struct<{FACTS.replace(' ', ':').replace(',:', ',')},n_slots:long,dealt:array<bigint>>")
    def plan(ids: pd.Series, sizes: pd.Series, targets: pd.Series) -> pd.DataFrame:
        rows = []
        for sid, size, target in zip(ids.tolist(), sizes.tolist(), targets.tolist()):
            blocks = -(-size // block_words)
            full, rest = divmod(round(target), size) if size else (0, 0)
            lack = blocks * block_words - size
            # the short last block's turn in a pass
            short = int(permute(np.array([blocks - 1]), blocks, seed + sid, back=True)[0]) if blocks else 0
            turns = -(-rest // block_words)
            if turns > short:
                turns = -(-(rest + lack) // block_words)
            n = full * blocks + turns
            rows.append((blocks, full, rest, lack, short, n, deal(n, sid, n_shards, seed)))
        return pd.DataFrame(rows, columns=["blocks", "full", "rest", "lack", "short", "n_slots", "dealt"])

    return sources.withColumn("facts", plan("source_id", "size", "target")).select("*", "facts.*").drop("facts")


def slots(plan: DataFrame, block_words: int = BLOCK_WORDS, seed: int = SEED) -> DataFrame:
    """(shard, position, source_id, pass_no, block, take) of every slot of a plan, made where they are used, so many runs at a time."""
    spark = plan.sparkSession
    dealt = plan.select("source_id", *[x.split()[0] for x in FACTS.split(", ")], "dealt", F.posexplode("dealt").alias("shard", "n")).filter("n > 0")
    first = F.aggregate(F.slice("dealt", F.lit(1), F.col("shard")), F.lit(0).cast("long"), lambda a, n: a + n)
    before = F.sum("n").over(Window.partitionBy("shard").orderBy("source_id").rowsBetween(Window.unboundedPreceding, 0)) - F.col("n")
    runs = dealt.withColumn("first", first).withColumn("at", before).drop("dealt")
    shards = dealt.groupBy("shard").agg(F.sum("n").alias("in_shard"))  # one row for each shard
    runs = runs.join(F.broadcast(shards), "shard").withColumn("lo", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1, F.lit(RUN).cast("long"))))

    def fill(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            columns = {c: batch[c].to_numpy("int64") for c in batch.columns}
            sizes = np.minimum(columns["n"] - columns["lo"], RUN)
            ends = np.cumsum(sizes)
            start = 0
            while start < len(sizes):
                stop = max(start + 1, int(np.searchsorted(ends, ends[start] - sizes[start] + 4 * RUN, "right")))
                here = np.repeat(np.arange(start, stop), sizes[start:stop])
                k = np.arange(len(here)) - np.repeat(ends[start:stop] - sizes[start:stop] - (ends[start] - sizes[start]), sizes[start:stop])
                source, shard, at, first, lo, total, blocks, full, rest, lack, short = (columns[c][here] for c in ("source_id", "shard", "at", "first", "lo", "in_shard", "blocks", "full", "rest", "lack", "short"))
                turns, turn = np.divmod(first + lo + k, blocks)
                block = permute(turn, blocks, seed + source)
                take = np.where(block == blocks - 1, block_words - lack, block_words)
                used = turn * block_words - np.where(turn > short, lack, 0)
                take = np.where(turns >= full, np.minimum(take, rest - used), take)
                place = permute(at + lo + k, total, seed + 7 + shard)  # sources alternate within a shard
                yield pd.DataFrame({"shard": shard, "position": place, "source_id": source, "pass_no": turns, "block": block, "take": take})
                start = stop

    # as many partitions as told: the runs are few and short, what they unfold to is not
    dealt_out = runs.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "shard", "source_id", "lo")
    return dealt_out.mapInPandas(fill, "shard int, position long, source_id long, pass_no long, block long, take long")


def mix(docs: DataFrame, weights: DataFrame | None = None, block_words: int = BLOCK_WORDS, n_shards: int = N_SHARDS, most: float = MOST_TIMES, seed: int = SEED) -> Mixture:
    """Plans the mixture of docs (doc_id, text, source). ``weights`` is a table (source, weight), 0 where it has none; without it sources weigh 1, 2, 3, repeating."""
    named = [F.coalesce(F.col("source").cast("string"), F.lit("")).alias("src"), F.col("source").isNotNull().alias("known")]
    narrow = saved(docs.select("doc_id", word_count(text_of()).alias("size"), *named, *identity(docs)), "sizes")
    sources = ranked(narrow.groupBy("src", "known").agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("rows")))
    if weights is None:
        sources = sources.withColumn("weight", (F.col("source_id") % 3 + 1).cast("double"))
    else:
        sources = sources.join(weights.select(*named, F.col("weight").cast("double").alias("weight")), ["src", "known"], "left").fillna(0.0, "weight")
    plan = saved(_planned(with_targets(saved(sources, "sources"), most), block_words, n_shards, seed), "plan")

    # where each document begins in its source: buckets' sums, then sums within a bucket
    buckets = min(BUCKETS[1], max(BUCKETS[0], -(-narrow.count() // BUCKET_ROWS)))
    placed = join_counted(narrow, plan.select("src", "known", "source_id", F.col("rows").alias("n")), ["src", "known"])
    placed = placed.drop("src", "known").withColumn("bucket", F.pmod(F.xxhash64(F.lit(seed), "k1", "k2"), F.lit(buckets)).cast("int"))
    sums = placed.groupBy("source_id", "bucket").agg(F.sum("size").alias("words"))
    before = sums.select("source_id", "bucket", (F.sum("words").over(Window.partitionBy("source_id").orderBy("bucket")) - F.col("words")).alias("before"))
    order = Window.partitionBy("source_id", "bucket").orderBy("k1", "k2")
    rows = placed.withColumn("nth", F.row_number().over(order)).withColumn("within", F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size"))
    laid = rows.join(before, ["source_id", "bucket"]).select("doc_id", "size", "source_id", "bucket", "nth", (F.col("before") + F.col("within")).alias("start"), "k1", "k2")
    return Mixture(saved(laid, "laid"), plan, slots(plan, block_words, seed), block_words)


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mixture as documents: for each time a document is taken a row with the words taken, in order.

    All columns of docs stay; ``text`` and ``n_chars`` (where there is one) are
    those of the taken words, white space between neighbours as it stood. A
    document that is taken whole keeps its text as it is.
    """
    mixture = mix(docs, **options)
    place, key = ["source_id", "bucket", "nth"], ["k1", "k2"]
    taken = mixture.pieces().groupBy(*place, "pass_no").agg(F.sum("n_words").alias("words"), F.array_sort(F.collect_list(F.struct("from_word", "n_words"))).alias("spans"))
    taken = saved(taken.join(mixture.docs.select(*place, *key, "size"), place).select(*key, "size", "words", "spans"), "taken")
    texts = packed(docs, *identity(docs))
    often = mixture.docs.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(*key)
    if not often.isEmpty():  # rows alike in all columns: any of them stands for all, each of which was taken
        often = saved(often, "repeated-rows")
        texts = texts.join(often, key, "left_anti").unionByName(texts.join(often, key, "left_semi").dropDuplicates(key))
    text = F.col("row.text")
    words = F.regexp_extract_all(text, F.lit(rf"[\x20\x09-\x0D]*{WORD}"), F.lit(0))
    cut = F.array_join(F.flatten(F.transform("spans", lambda s: F.slice(words, (s["from_word"] + 1).cast("int"), s["n_words"].cast("int")))), "")
    mixed = texts.join(taken, key).withColumn("cut", F.when(F.col("words") == F.col("size"), text).otherwise(cut))
    own = {"text": F.col("cut")}
    if "n_chars" in docs.columns:
        own["n_chars"] = F.length("cut").cast(docs.schema["n_chars"].dataType)
    return mixed.select(*[own[c].alias(c) if c in own else F.col(f"row.`{c}`") for c in docs.columns])


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mixture takes of each document."""
    mixture = mix(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    place = ["source_id", "bucket", "nth"]
    taken = mixture.pieces().groupBy(*place).agg(F.sum("n_words").alias("taken"))
    rows = mixture.docs.join(taken, place, "left")
    rows = join_counted(rows, mixture.sources.select("source_id", F.col("size").alias("source_size"), "target", F.col("rows").alias("n")), ["source_id"])
    return rows.select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).alias("taken"))


QUERIES = {"op1_mix_sources": op1_mix_sources}
SQL: dict[str, str] = {}
