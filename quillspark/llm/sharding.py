"""Sharding by fixed virtual slots and a versioned slot-to-shard map.

Records hash by their whole text into ``n_slots`` virtual slots; a slot is cut into
``n_parts`` parts by a second hash of the text, so equal texts share slot and part.
One pass adds up rows and bytes of each part. That table has at most ``n_slots *
n_parts`` rows whatever the input, so the driver may plan on it: whole slots go to
the lightest shard, heaviest slot first. Only a slot that alone outweighs a shard's
fair share is dealt part by part. A group of equal texts is never parted, even
where it outweighs a share by itself; its shard is then the heavier one.

The map is a table (version, slot, part, shard, rows, bytes, first_row, splits);
growing or evening out the shards edits it under the next version and moves few
slots. Maps are kept at a path that the caller names: where one is stored there, the
newest is edited for the new counts, and stored as the next version if that changes
it. Rows are numbered within a part by up to ``splits`` sub-parts (by a hash of
doc_id), so that a group with a third of all rows is numbered by many tasks.

Defined cases: a null text counts as empty; an empty table gives an empty map
and no rows; repeated rows are rows of their own; ties in weight go by slot
number; a long text counts by its bytes and is hashed whole; columns of the input
may have any name, only ``shard`` is replaced.
"""

from __future__ import annotations

import hashlib
import heapq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..sources.shared import exists, kept_path
from .common import packed, saved, table, text_of

N_SLOTS = 4096
N_PARTS = 4
MAP_SCHEMA = "version long, slot int, part int, shard int, rows long, bytes long, first_row long, splits int"
MAP = [x.split()[0] for x in MAP_SCHEMA.split(", ")]


def slot_columns(key: Column, n_slots: int = N_SLOTS, n_parts: int = N_PARTS) -> list[Column]:
    """Virtual slot of a key, and the slot's part that it belongs to."""
    return [F.pmod(F.xxhash64(key), F.lit(n_slots)).cast("int").alias("vslot"), F.pmod(F.xxhash64(F.lit(1), key), F.lit(n_parts)).cast("int").alias("vpart")]


def slot_stats(slotted: DataFrame, size: str = "size") -> pd.DataFrame:
    """Rows and bytes of each part of each slot: at most n_slots * n_parts lines."""
    stats = slotted.groupBy("vslot", "vpart").agg(F.count(F.lit(1)).alias("rows"), F.sum(size).alias("bytes"))
    got = stats.toPandas().astype("int64")
    return got.rename(columns={"vslot": "slot", "vpart": "part"}).sort_values(["slot", "part"]).reset_index(drop=True)


def _units(stats: pd.DataFrame, n_shards: int) -> pd.Series:
    """What moves as one: a whole slot, or a part of a slot that outweighs a shard's fair share."""
    weight = stats.groupby("slot")["bytes"].transform("sum")
    heavy = weight * n_shards > stats["bytes"].sum()
    most = int(stats["part"].max()) + 2 if len(stats) else 2
    return stats["slot"] * most + np.where(heavy, stats["part"] + 1, 0)


def _numbered(plan: pd.DataFrame, version: int) -> pd.DataFrame:
    """Adds the row number within the shard at which each part begins, and in how many sub-parts its rows are numbered."""
    plan = plan.sort_values(["shard", "slot", "part"]).reset_index(drop=True)
    plan["first_row"] = plan.groupby("shard")["rows"].cumsum() - plan["rows"] if len(plan) else pd.Series(dtype="int64")
    # a sub-part holds about one row in N_SLOTS, so there are N_SLOTS more of them than parts at most
    plan["splits"] = -(-plan["rows"] * N_SLOTS // max(1, plan["rows"].sum())) if len(plan) else pd.Series(dtype="int64")
    plan["version"] = version
    return plan[MAP]


def build_map(stats: pd.DataFrame, n_shards: int, version: int = 1) -> pd.DataFrame:
    """A map from scratch: heaviest unit first, each to the lightest shard."""
    units = stats.assign(unit=_units(stats, n_shards))
    loads = [(0, s) for s in range(n_shards)]
    heapq.heapify(loads)
    home: dict[int, int] = {}
    weights = units.groupby("unit")["bytes"].sum()
    for unit, weight in sorted(weights.items(), key=lambda x: (-x[1], x[0])):
        load, shard = heapq.heappop(loads)
        home[unit] = shard
        heapq.heappush(loads, (load + int(weight), shard))
    plan = units.assign(shard=units["unit"].map(home).astype("int64")).drop(columns="unit")
    return _numbered(plan, version)


def edit_map(old: pd.DataFrame, stats: pd.DataFrame, n_shards: int, tolerance: float = 0.02) -> pd.DataFrame:
    """The next version of a map for new counts or another number of shards.

    Units keep their shard; new ones go to the lightest. Then, while a shard is
    above the mean by more than the tolerance, its largest unit that fits the
    lightest shard's gap moves there. Shards beyond n_shards are emptied.
    """
    units = stats.assign(unit=_units(stats, n_shards)).merge(old[["slot", "part", "shard"]], on=["slot", "part"], how="left")
    by_unit = units.groupby("unit").agg(bytes=("bytes", "sum"), shard=("shard", "first"))
    load = np.zeros(n_shards, dtype="int64")
    home: dict[int, int] = {}
    members: list[list[tuple[int, int]]] = [[] for _ in range(n_shards)]
    loose = []
    for unit, (weight, shard) in zip(by_unit.index, by_unit.itertuples(index=False)):
        if shard == shard and shard < n_shards:
            home[unit] = int(shard)
            load[int(shard)] += weight
            members[int(shard)].append((int(weight), unit))
        else:
            loose.append((int(weight), unit))
    for weight, unit in sorted(loose, key=lambda x: (-x[0], x[1])):
        shard = int(load.argmin())
        home[unit] = shard
        load[shard] += weight
        members[shard].append((weight, unit))
    for own in members:
        own.sort()
    mean = load.sum() / n_shards
    while (high := int(load.argmax())) != (low := int(load.argmin())) and load[high] > mean * (1 + tolerance):
        gap = min(load[high] - mean, mean - load[low])
        fits = [i for i, (w, _) in enumerate(members[high]) if 0 < w <= max(gap, 0)]
        if not fits:
            break
        weight, unit = members[high].pop(fits[-1])
        home[unit] = low
        load[high] -= weight
        load[low] += weight
        members[low].append((weight, unit))
        members[low].sort()
    plan = units.assign(shard=units["unit"].map(home).astype("int64")).drop(columns="unit")
    version = int(old["version"].max()) + 1 if len(old) else 1
    return _numbered(plan, version)


def save_map(spark: SparkSession, plan: pd.DataFrame, path: str) -> None:
    """Adds one version to the stored maps, as one file, so that no version is seen half."""
    map_frame(spark, plan).coalesce(1).write.mode("append").partitionBy("version").parquet(path)


def load_map(spark: SparkSession, path: str, version: int | None = None) -> pd.DataFrame:
    """The newest stored version, or the one asked for."""
    maps = spark.read.schema(MAP_SCHEMA).parquet(path)
    version = maps.agg(F.max("version")).first()[0] if version is None else version
    return maps.filter(F.col("version") == version).toPandas().sort_values(["slot", "part"]).reset_index(drop=True)


def next_map(spark: SparkSession, stats: pd.DataFrame, n_shards: int, path: str | None = None) -> pd.DataFrame:
    """The map for these counts: the newest at the path, edited, or one from scratch; what is new is stored there."""
    old = load_map(spark, path) if path and exists(spark, path) else None
    if old is None or not len(old):
        plan = build_map(stats, n_shards)
    else:
        plan, same = edit_map(old, stats, n_shards), [c for c in MAP if c != "version"]
        if plan[same].sort_values(["slot", "part"]).reset_index(drop=True).astype("int64").equals(old[same].astype("int64")):
            return plan.assign(version=old["version"].max())
    if path and len(plan):
        save_map(spark, plan, path)
    return plan


def map_frame(spark: SparkSession, plan: pd.DataFrame) -> DataFrame:
    return spark.createDataFrame(plan[MAP] if len(plan) else [], MAP_SCHEMA)


def slotted(docs: DataFrame, n_slots: int = N_SLOTS, n_parts: int = N_PARTS) -> DataFrame:
    """(doc_id, size, text_crc32, vslot, vpart) of each row; a size is the text's UTF-8 bytes plus 1."""
    text = text_of()
    return docs.select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"), *slot_columns(text, n_slots, n_parts))


def assign(docs: DataFrame, plan: pd.DataFrame, n_slots: int = N_SLOTS, n_parts: int = N_PARTS) -> DataFrame:
    """docs with ``shard``. The map has n_slots * n_parts rows at most and is broadcast; no row is shuffled."""
    where = map_frame(docs.sparkSession, plan).select(F.col("slot").alias("vslot"), F.col("part").alias("vpart"), "shard")
    rows = packed(docs.drop("shard"), *slot_columns(text_of(), n_slots, n_parts))
    return rows.join(F.broadcast(where), ["vslot", "vpart"]).select("row.*", "shard")


def sharded(docs: DataFrame, n_shards: int = 8) -> DataFrame:
    """docs with ``shard``, by a map made for them."""
    return assign(docs, build_map(slot_stats(slotted(docs)), n_shards))


def shard_documents(docs: DataFrame, n_shards: int = 8, maps: str | None = None) -> tuple[DataFrame, pd.DataFrame]:
    """Every row's place (doc_id, size, text_crc32, shard, slot), and the map behind it, from the maps stored at a path if one is named.

    The text is read once; what is counted and numbered afterwards is narrow.
    ``slot`` numbers the rows of a shard from 0: the part's first row, the rows of the
    sub-parts before its own, and its number within that, so no shard, slot or
    group of copies is sorted in one task.
    """
    spark = docs.sparkSession
    narrow = saved(slotted(docs), "shard-rows")
    plan = next_map(spark, slot_stats(narrow), n_shards, maps)
    where = map_frame(spark, plan).select(F.col("slot").alias("vslot"), F.col("part").alias("vpart"), "shard", "first_row", "splits")
    split = F.pmod(F.xxhash64(F.lit(2), "doc_id"), "splits").cast("int").alias("split")
    keys = ["vslot", "vpart", "split"]
    rows = narrow.join(F.broadcast(where), ["vslot", "vpart"]).select("*", split)
    counts = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    before = counts.select(*keys, (F.sum("n").over(Window.partitionBy("vslot", "vpart").orderBy("split")) - F.col("n")).alias("before"))
    nth = F.row_number().over(Window.partitionBy(*keys).orderBy("doc_id", "text_crc32", "size"))
    placed = rows.withColumn("nth", nth).join(before, keys)
    return placed.select("doc_id", "size", "text_crc32", "shard", (F.col("first_row") + F.col("before") + F.col("nth") - 1).alias("slot")), plan


def write_shards(docs: DataFrame, plan: pd.DataFrame, path: str) -> None:
    """The documents themselves, one folder a shard."""
    assign(docs, plan).write.partitionBy("shard").parquet(path)


def stored_maps(spark: SparkSession, sf_dir: str) -> str:
    """Where the maps for a folder's documents are kept."""
    return kept_path(spark, f"slot-maps-{hashlib.sha256(sf_dir.encode()).hexdigest()[:16]}")


def op7_virtual_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in shards 0 to 7 of near equal bytes, by the map kept for these tables, which a later call finds and edits."""
    rows, _ = shard_documents(table(spark, sf_dir, "documents"), 8, stored_maps(spark, sf_dir))
    return rows.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


QUERIES = {"op7_virtual_slots": op7_virtual_slots}
SQL: dict[str, str] = {}
