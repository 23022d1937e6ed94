"""Audit of sources: how far each source of a language lies from the others, and the terms that set it apart.

Terms are runs of letters and of all beyond ASCII, A-Z in lower case. A language keeps
the terms that at least ``MIN_DOCS`` of its documents hold. Each group (language and
source) and each language as a whole gives each kept term a smoothed share
``p = 1 + floor(SCALE * (count + 2) / (N + 2 * V))`` in whole numbers, and two shares
differ by ``floor((p - q)**2 / (p + q))``.

Counts are dictionary-coded. A task counts the terms of its documents for each group;
Spark adds them up and deals them by ranges of (language, term), so that the terms of a
range are a sorted array, a term's id is its place there by ``searchsorted``, and ids
keep the order of UTF-8. Ranges are cut into chunks of ``CHUNK`` kept terms, or of
``CELLS`` counts of terms by sources, and a group's counts of a chunk are one dense
vector, a ``bincount`` by id. Vectors of a chunk then meet: each pair of groups gives
the sum over the chunk, and each group its first ``TOP`` terms, which ties take in the
order of ids. Where a language has more than ``BLOCK`` sources, blocks of them meet two
by two. Sums over chunks are added up by Spark; nothing passes the driver.

All arithmetic is on 64-bit whole numbers and exact up to N + 2 * V = 9 * 10**15; the
scaled quotient is divided out three digits at a time.

Defined cases: a null text, language or source is the empty one; a group without terms
has counts of zero; a language without kept terms gives its pairs the value 0, in the
order of sources; repeated rows count each time; ties go by UTF-8; a source alone in its
language has no pairs; an empty table gives no rows; other columns do not matter.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import saved, table, text_of

MIN_DOCS = 10
SCALE_STEPS = 3  # of a factor of 1,000 each
TOP = 10
#: Kept terms of a chunk, and counts (terms by sources) of a chunk, at most.
CHUNK = 8192
CELLS = 4_000_000
#: Sources that meet in one task, about.
BLOCK = 32
#: Distinct (group, term) that a task counts before it sends them; rows sent at a time.
HELD = 500_000
SENT = 50_000

#: A byte of a term is itself, A-Z in lower case; any other is a space.
_BARE = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))

VECTORS = "lang string, chunk long, source string, whole boolean, counts array<long>, terms array<string>"
FOUND = "lang string, source string, part string, item string, value long"


def terms_of(text: bytes) -> list[bytes]:
    """The terms of a text in UTF-8, in order."""
    return text.translate(_BARE).split()


def shares(counts: np.ndarray, n: int, v: int) -> np.ndarray:
    """1 + floor(10**9 * (count + 2) / (n + 2 * v)), exactly."""
    total = n + 2 * v
    out, rest = np.divmod(counts + 2, total)
    for _ in range(SCALE_STEPS):
        more, rest = np.divmod(rest * 1000, total)
        out = out * 1000 + more
    return out + 1


def apart(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """floor((p - q)**2 / (p + q))."""
    return (p - q) ** 2 // (p + q)


def _counts(batches: Iterator[pa.RecordBatch], held: int) -> Iterator[pa.RecordBatch]:
    """Per group and term: times and documents, as a task has counted them."""
    times: dict = defaultdict(Counter)
    docs: dict = defaultdict(Counter)

    def sent() -> Iterator[pa.RecordBatch]:
        for (lang, source), own in times.items():
            known, rows = docs[lang, source], list(own.items())
            for k in range(0, len(rows), SENT):
                part = rows[k : k + SENT]
                columns = [pa.array([lang] * len(part)), pa.array([source] * len(part)), pa.array([w.decode() for w, _ in part]), pa.array([n for _, n in part], pa.int64()), pa.array([known[w] for w, _ in part], pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=["lang", "source", "term", "n", "docs"])
        times.clear(), docs.clear()

    for batch in batches:
        texts = batch.column("text")
        for i, key in enumerate(zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist())):
            own = terms_of(texts[i].as_buffer().to_pybytes())
            times[key].update(own)
            docs[key].update(set(own))
            if i % 64 == 0 and sum(map(len, times.values())) > held:
                yield from sent()
    yield from sent()


def _vectors(batches: Iterator[pd.DataFrame], most_terms: int, most_cells: int) -> Iterator[pd.DataFrame]:
    """Dense vectors of the chunks of kept terms, from rows (lang, term, source, n, docs) in order of language and term."""
    from pyspark import TaskContext

    chunk = TaskContext.get().partitionId() << 32
    lang, kept, sources = None, [], set()  # of the chunk: parts (terms, sources, n) of kept terms, and all of their sources
    n_terms = 0

    def closed() -> Iterator[pd.DataFrame]:
        nonlocal chunk, kept, sources, n_terms
        if kept:
            terms, own, n = (np.concatenate(x) for x in zip(*kept))
            dictionary = np.unique(terms)
            ids = np.searchsorted(dictionary, terms)
            names, of = np.unique(own, return_inverse=True)
            rows = []
            for k, name in enumerate(names):
                here = of == k
                dense = np.zeros(len(dictionary), "i8")
                np.add.at(dense, ids[here], n[here])  # an exact bincount by id
                rows.append((name, False, dense, None))
            whole = np.zeros(len(dictionary), "i8")
            np.add.at(whole, ids, n)
            rows.append(("", True, whole, [t.decode() for t in dictionary]))
            yield pd.DataFrame(rows, columns=["source", "whole", "counts", "terms"]).assign(lang=lang, chunk=chunk)[["lang", "chunk", "source", "whole", "counts", "terms"]]
            chunk += 1
        kept, sources, n_terms = [], set(), 0

    def add(rows: pd.DataFrame) -> Iterator[pd.DataFrame]:
        """Whole terms of one language."""
        nonlocal n_terms
        terms = np.array([t.encode() for t in rows["term"]], object)
        starts = np.append(np.flatnonzero(np.append(True, terms[1:] != terms[:-1])), len(terms))
        enough = np.add.reduceat(rows["docs"].to_numpy("i8"), starts[:-1]) >= MIN_DOCS
        own, n = rows["source"].to_numpy(object), rows["n"].to_numpy("i8")
        for a, b in zip(starts[:-1][enough].tolist(), starts[1:][enough].tolist()):
            sources.update(own[a:b])
            if n_terms and (n_terms == most_terms or (n_terms + 1) * len(sources) > most_cells):
                yield from closed()
                sources.update(own[a:b])
            kept.append((terms[a:b], own[a:b], n[a:b]))
            n_terms += 1

    rest = None
    for batch in batches:
        if batch.empty:
            continue
        rows = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
        last = (rows["lang"] == rows["lang"].iloc[-1]) & (rows["term"] == rows["term"].iloc[-1])
        whole, rest = rows[~last], rows[last]
        for name, part in whole.groupby("lang", sort=True):
            if name != lang:
                yield from closed()
                lang = name
            yield from add(part)
    if rest is not None:
        if rest["lang"].iloc[0] != lang:
            yield from closed()
            lang = rest["lang"].iloc[0]
        yield from add(rest)
    yield from closed()


def _compared(rows: pd.DataFrame) -> pd.DataFrame:
    """Sums over one chunk for pairs of two blocks of groups; and within a block each group's first terms."""
    lang, i, j = rows["lang"].iloc[0], rows["i"].iloc[0], rows["j"].iloc[0]
    groups = rows[~rows["whole"]]
    zeros = np.zeros(rows["length"].iloc[0], "i8")
    names, blocks = groups["source"].tolist(), groups["block"].tolist()
    own = [zeros if c is None else np.asarray(c, "i8") for c in groups["counts"]]
    p = [shares(c, int(n), int(v)) for c, n, v in zip(own, groups["n"], groups["v"])]
    out = []
    for a in range(len(p)):
        for b in range(a + 1, len(p)):
            if i == j or blocks[a] != blocks[b]:
                out.append((lang, names[a], "pair", names[b], int(apart(p[a], p[b]).sum())))
    for r in rows[rows["whole"]].itertuples():
        q = shares(np.asarray(r.counts, "i8"), int(r.n), int(r.v))
        for name, counts, share in zip(names, own, p):
            at = np.flatnonzero((counts > 0) & (share > q))
            value = apart(share[at], q[at])
            for k in np.argsort(-value, kind="stable")[:TOP]:
                out.append((lang, name, "term", r.terms[at[k]], int(value[k])))
    return pd.DataFrame(out, columns=["lang", "source", "part", "item", "value"])


def audit(docs: DataFrame, chunk: int = CHUNK, cells: int = CELLS, block: int = BLOCK, held: int = HELD) -> DataFrame:
    """(lang, source, part, item, value, rank) over docs (text, lang, source)."""
    read = docs.select(*[text_of(c).cast("string").alias(c) for c in ("lang", "source", "text")])
    counted = saved(read.mapInArrow(lambda batches: _counts(batches, held), "lang string, source string, term string, n long, docs long"), "counts")
    counts = saved(counted.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")), "terms")
    ordered = counts.select("lang", "term", "source", "n", "docs").repartitionByRange("lang", "term").sortWithinPartitions("lang", "term")
    vectors = saved(ordered.mapInPandas(lambda batches: _vectors(batches, chunk, cells), VECTORS), "vectors")

    # every group with the sum of its counts, and its language's kept terms
    size = F.aggregate("counts", F.lit(0).cast("long"), lambda a, n: a + n)
    sums = vectors.groupBy("lang", "source", "whole").agg(F.sum(size).alias("n"), F.sum(F.when(F.col("whole"), F.size("counts"))).alias("v"))
    kept = saved(sums.filter("whole").select("lang", F.col("v").cast("long").alias("v"), F.col("n").alias("all")), "kept")
    groups = read.select("lang", "source").distinct().join(sums.filter("not whole").select("lang", "source", "n"), ["lang", "source"], "left").join(kept, "lang", "left")
    groups = saved(groups.select("lang", "source", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("v", F.lit(0)).alias("v"), F.coalesce("all", F.lit(0)).alias("all")), "groups")

    # a dense table: each chunk with all groups of its language, by pairs of blocks
    sources = groups.groupBy("lang").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("blocks"))
    facts = groups.filter("v > 0").join(sources, "lang").withColumn("block", F.pmod(F.xxhash64("source"), F.col("blocks")).cast("int"))
    chunks = vectors.filter("whole").select("lang", "chunk", F.size("counts").alias("length"))
    dense = chunks.join(facts, "lang").join(vectors.filter("not whole").select("lang", "chunk", "source", "counts"), ["lang", "chunk", "source"], "left")
    dense = dense.select("lang", "chunk", "source", "length", F.lit(False).alias("whole"), "counts", F.lit(None).cast("array<string>").alias("terms"), "n", "v", "block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    dense = dense.select("*", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j")).drop("other")
    totals = vectors.filter("whole").join(kept, "lang").join(sources, "lang").select("lang", "chunk", "source", F.size("counts").alias("length"), "whole", "counts", "terms", F.col("all").alias("n"), "v", F.lit(0).alias("block"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("i"))
    met = dense.unionByName(totals.withColumn("j", F.col("i")))
    found = saved(met.groupBy("lang", "chunk", "i", "j").applyInPandas(_compared, FOUND), "found")

    pairs = found.filter("part = 'pair'").select(F.least("source", "item").alias("a"), F.greatest("source", "item").alias("b"), "lang", "value").groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    both = F.inline(F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item")), F.struct(F.col("b").alias("source"), F.col("a").alias("item"))))
    pairs = pairs.select("lang", "value", both)
    empty = groups.filter("v = 0").select("lang", "source")
    alone = empty.join(empty.withColumnRenamed("source", "item"), "lang").filter("source != item").select("lang", F.lit(0).cast("long").alias("value"), "source", "item")
    rows = pairs.unionByName(alone).withColumn("part", F.lit("pair")).unionByName(found.filter("part = 'term'").select("lang", "value", "source", "item", "part"))
    rank = F.row_number().over(Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item"))
    of = lambda part: rows.filter(F.col("part") == part).select("lang", "source", "part", "item", "value", rank.alias("rank"))
    return of("pair").unionByName(of("term").filter(F.col("rank") <= TOP))


def op11_source_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The audit of all documents."""
    return audit(table(spark, sf_dir, "documents"))


_SQL = f"""
with d as (select row_number() over () rid, coalesce(lang, '') lang, coalesce(source, '') source,
   regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') ws from documents),
 t as (select rid, lang, source, unnest(ws) term from d),
 kept as (select lang, term, count(*) n from t group by all having count(distinct rid) >= {MIN_DOCS}),
 g as (select distinct lang, source from d),
 c as (select lang, source, term, count(*) n from t join kept using (lang, term) group by all),
 v as (select lang, count(*) v, sum(n) n from kept group by all),
 gn as (select lang, source, coalesce(sum(n), 0) n from g left join c using (lang, source) group by all),
 p as (select lang, source, term, coalesce(c.n, 0) n, 1 + (1000000000::hugeint * (coalesce(c.n, 0) + 2)) // (gn.n + 2 * v.v) p
   from gn join v using (lang) join kept using (lang) left join c using (lang, source, term)),
 q as (select lang, term, 1 + (1000000000::hugeint * (kept.n + 2)) // (v.n + 2 * v.v) q from kept join v using (lang)),
 pair as (select lang, a.source, 'pair' part, b.source item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p))::bigint "value" from p a join p b using (lang, term) where a.source != b.source group by all
   union all select lang, a.source, 'pair', b.source, 0 from g a join g b using (lang) where a.source != b.source and lang not in (select lang from v)),
 term as (select lang, source, 'term' part, term item, ((p - q) * (p - q) // (p + q))::bigint "value" from p join q using (lang, term) where n > 0 and p > q),
 ranked as (select *, (row_number() over (partition by lang, source, part order by "value" desc, item))::int "rank" from (select * from pair union all select * from term))
select lang, source, part, item, "value", "rank" from ranked where part = 'pair' or "rank" <= {TOP}
"""

QUERIES = {"op11_source_audit": op11_source_audit}
SQL = {"op11_source_audit": _SQL}
