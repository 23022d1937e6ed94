"""Language-model scores: prediction by partial matching over bytes.

The model is a trie of byte contexts, up to ``ORDER`` bytes before a symbol, with the
counts of all training documents. A symbol is a byte of the text as it stands, or the
end of the text. In a context that training has seen, a symbol seen there c times has
the share c / (t + q) of what is left, t being the symbols seen there and q the
distinct ones; the share q / (t + q) escapes to the context one byte shorter, where all
symbols of the longer one are excluded. Contexts that were never seen, and those whose
symbols are all excluded, are passed by; after the empty context what is left is dealt
evenly to the symbols not excluded, of 256. So the chances of all symbols add up to one
after any context, and a document's score is the sum of their logarithms.

The trained model does not change while it scores, so a symbol's chance is a matter of
the ``ORDER`` bytes before it alone. Documents are scored in lots of ``LOT`` rows: a
lot names the distinct grams (context and symbol) of its texts; Spark adds their counts
up; each gram's chance is worked out once, beside the grams that end in the same two
bytes, for these are all that its longer contexts hold (counts of one byte and of none
have 65,536 entries at most and are given to every task); and the chances go back to
the lots that named them, where the texts meet them. No table of the whole model is
held anywhere, nothing is left out, and what moves is in proportion to the texts. The
word counts of the base score go the same way.

Defined cases: a null or empty text is its end alone; a null doc_id is held out, as the
checksum of nothing is 0; a long text is read in pieces; repeated rows are scored alike
and each is learned; without training documents every symbol has 1/256 and base counts
are zero; an empty table gives no rows; columns of the input may have any name, those
named like an added one are replaced.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import packed, saved, table, text_of

#: Bytes of the longest context.
ORDER = 4
#: Bytes that stand before a text and after it; UTF-8 has neither.
START, END = 0xFE, 0xFF
SYMBOLS = 256
#: Rows of a lot, as a power of two.
LOT = 14
#: Bytes of texts that are looked at together, and distinct grams that a lot holds before it sends some.
PIECE = 1 << 22
HELD = 2_000_000
#: Rows sent at a time.
SENT = 50_000
#: Distinct grams that a task works out together, about.
TOGETHER = 200_000
#: Of doc_id's checksums by this number, those with remainder 0 are held out.
FOLDS = 10

COUNTED = "lot long, gram long, word string, n long"
SCORES = "at long, n_tokens long, n_known long, base double, score double"


def windows(data: np.ndarray, order: int = ORDER) -> np.ndarray:
    """The gram of every symbol from the byte at ``order`` on: the nearest byte before it first, the symbol last."""
    n = len(data) - order
    wide = data.astype("i8")
    out = wide[order:].copy()
    for k in range(1, order + 1):
        out |= wide[order - k : order - k + n] << (8 * (order + 1 - k))
    return out


def pieces(texts: list[bytes], order: int = ORDER, size: int = PIECE) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(grams, which): all grams of the texts, and the number of the text of each, some texts or a part of one at a time."""
    held, which, total = [], [], 0

    def joined():
        data = np.frombuffer(b"".join(held), "u1")
        grams = windows(data, order)
        own = np.repeat(np.array(which), [len(x) for x in held])[order:]
        real = (data[order:] != START) & (own >= 0)
        return grams[real], own[real]

    for k, text in enumerate(texts):
        framed = bytes([START]) * order + text + bytes([END])
        for at in range(0, len(framed) - order, size):
            part = framed[at : at + size + order]
            if at:  # its first bytes are the context of what follows only
                held += [part[:order], part[order:]]
                which += [-1, k]
            else:
                held.append(part)
                which.append(k)
            total += len(part)
            if total >= size:
                yield joined()
                held, which, total = [], [], 0
    if held:
        yield joined()


def _added(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order with their counts added up."""
    own, at = np.unique(np.concatenate(keys), return_inverse=True)
    total = np.zeros(len(own), "i8")
    np.add.at(total, at, np.concatenate(counts))
    return own, total


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per lot: distinct grams and words of all its texts, with their times in training texts."""
    schema = pa.schema([("lot", pa.int64()), ("gram", pa.int64()), ("word", pa.string()), ("n", pa.int64())])
    keys: list[np.ndarray] = []
    counts: list[np.ndarray] = []
    words: Counter = Counter()
    met: set = set()
    now, size = None, 0

    def sent() -> Iterator[pa.RecordBatch]:
        nonlocal size
        if keys:
            own, n = _added(keys, counts)
            for k in range(0, len(own), SENT):
                part = pa.array(own[k : k + SENT])
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(part), now)), part, pa.nulls(len(part), pa.string()), pa.array(n[k : k + SENT])], schema=schema)
        rows = [(w, n) for w, n in words.items()] + [(w, 0) for w in met if w not in words]
        for k in range(0, len(rows), SENT):
            part = rows[k : k + SENT]
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(part), now)), pa.nulls(len(part), pa.int64()), pa.array([w.decode() for w, _ in part]), pa.array([n for _, n in part], pa.int64())], schema=schema)
        keys.clear(), counts.clear(), words.clear(), met.clear()
        size = 0

    def taken(texts: list[bytes], train: bool) -> None:
        nonlocal size
        for grams, _ in pieces(texts):
            own, n = np.unique(grams, return_counts=True)
            keys.append(own)
            counts.append(n if train else np.zeros(len(own), "i8"))
            size += len(own)
            if size > HELD:
                both = _added(keys, counts)
                keys[:], counts[:] = [both[0]], [both[1]]
                size = len(both[0])
        for text in texts:
            own = text.lower().split()
            words.update(own) if train else met.update(own)

    for batch in batches:
        lots = batch.column("lot").to_numpy()
        held_out = batch.column("held_out").to_numpy(zero_copy_only=False)
        texts = batch.column("text")
        for lot in np.unique(lots):
            if lot != now:
                yield from sent()
                now = lot
            for out in (False, True):
                rows = np.flatnonzero((lots == lot) & (held_out == out))
                for k in range(0, len(rows), 1000):
                    taken([texts[int(i)].as_buffer().to_pybytes() for i in rows[k : k + 1000]], not out)
                    if size + len(words) + len(met) > HELD:
                        yield from sent()
    yield from sent()


def _index(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each wanted key is in the sorted keys, and whether it is."""
    if not len(keys):
        return np.zeros(len(wanted), "i8"), np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return at, keys[at] == wanted


class _Level:
    """The contexts of one length, their symbols, and what a longer context's symbols leave of them."""

    def __init__(self, entries: np.ndarray, counts: np.ndarray):
        self.entries, self.counts = entries, counts
        self.nodes, of = np.unique(entries >> 8, return_inverse=True)
        self.total = np.zeros(len(self.nodes), "i8")
        np.add.at(self.total, of, counts)
        self.kinds = np.bincount(of, minlength=len(self.nodes))
        self.of = of

    def shorter(self, below: _Level) -> None:
        """Of each context: the times that its symbols have in the context one byte shorter."""
        at, _ = _index(below.entries, (self.entries >> 16 << 8) | (self.entries & 255))
        self.excluded = np.zeros(len(self.nodes), "i8")
        np.add.at(self.excluded, self.of, below.counts[at])


def _levels(grams: np.ndarray, counts: np.ndarray, pairs: np.ndarray, order: int) -> list[_Level]:
    """Levels 0 to order, from the sorted grams of some two-byte endings, and all counts of (byte, symbol)."""
    seen = counts > 0
    entries, own = grams[seen], counts[seen]
    deep = [_Level(entries, own)] if order > 1 else []
    for _ in range(order - 2):
        entries, own = _added([(entries >> 16 << 8) | (entries & 255)], [own])
        deep.append(_Level(entries, own))
    first = np.flatnonzero(pairs)
    none = pairs.reshape(SYMBOLS, SYMBOLS).sum(0)
    levels = [_Level(np.flatnonzero(none), none[none > 0]), _Level(first, pairs[first]), *reversed(deep)][: order + 1]
    for below, level in zip(levels, levels[1:]):
        level.shorter(below)
    return levels


def log_chances(grams: np.ndarray, counts: np.ndarray, pairs: np.ndarray, order: int = ORDER) -> np.ndarray:
    """log10 of each sorted gram's chance under the model; counts are those of training, and all grams of an ending are given together."""
    levels = _levels(grams, counts, pairs, order)
    out = np.zeros(len(grams))
    left = np.arange(len(grams))
    less, fewer = np.zeros(len(grams), "i8"), np.zeros(len(grams), "i8")  # times and kinds that are excluded, for each of left
    for k in range(order, -1, -1):
        level = levels[k]
        own = grams[left]
        node = own >> (8 * (order + 1 - k))
        at, known = _index(level.nodes, node)
        entry, found = _index(level.entries, (node << 8) | (own & 255))
        if not len(level.nodes):
            continue
        total, kinds = level.total[at] - less, level.kinds[at] - fewer
        live = known & (kinds > 0)
        with np.errstate(divide="ignore", invalid="ignore"):
            hit = np.log10(level.counts[entry] / (total + kinds)) if len(level.entries) else np.zeros(len(left))
            miss = np.log10(kinds / (total + kinds))
        out[left] += np.where(found, hit, np.where(live, miss, 0.0))
        stay = ~found
        less = np.where(known, level.excluded[at] if k else 0, 0)[stay]
        fewer = np.where(known, level.kinds[at], 0)[stay]
        left = left[stay]
    out[left] -= np.log10(SYMBOLS - fewer)
    return out


def _with_chances(grams: DataFrame, n: int, pairs: np.ndarray) -> DataFrame:
    """(gram, chance) of n distinct (gram, n)."""
    bins = n // TOGETHER + 1

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("gram")
        return pd.DataFrame({"gram": rows["gram"], "chance": log_chances(rows["gram"].to_numpy("i8"), rows["n"].to_numpy("i8"), pairs)})

    ending = F.pmod(F.xxhash64(F.shiftright("gram", 8 * (ORDER - 1))), F.lit(bins))
    return grams.groupBy(ending.alias("ending")).applyInPandas(run, "gram long, chance double")


def _scores(denominator: float):
    """Scores rows that are dealt by lot, a lot's chances and word counts before its texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, known, grams, chances = None, {}, [], []

        def scored(ats: np.ndarray, texts: list[bytes]) -> pa.RecordBatch:
            rows = []
            for text in texts:
                words = text.lower().split()
                counts = np.fromiter(map(known.__getitem__, words), "i8", len(words))
                end = known[None]
                n_known = np.count_nonzero(counts) + (end > 0)
                rows.append((len(words) + 1, n_known, np.log10(counts + 0.1).sum() + np.log10(end + 0.1) - (len(words) + 1) * np.log10(denominator)))
            score = np.zeros(len(texts))
            for own, which in pieces(texts):
                score += np.bincount(which, chances[np.searchsorted(grams, own)], len(texts))
            tokens, n_known, base = zip(*rows)
            return pa.RecordBatch.from_arrays([pa.array(ats), pa.array(tokens, pa.int64()), pa.array(n_known, pa.int64()), pa.array(base, pa.float64()), pa.array(score)], names=["at", "n_tokens", "n_known", "base", "score"])

        for batch in batches:
            lots, kinds = batch.column("lot").to_numpy(), batch.column("kind").to_numpy()
            edges = [0, *(np.flatnonzero((np.diff(lots) != 0) | (np.diff(kinds) != 0)) + 1).tolist(), len(lots)]
            for a, b in zip(edges, edges[1:]):
                if lots[a] != now:
                    now, known, grams, chances = lots[a], {None: 0}, [], []
                part = batch.slice(a, b - a)
                if kinds[a] == 0:
                    grams.append(part.column("gram").to_numpy())
                    chances.append(part.column("chance").to_numpy())
                elif kinds[a] == 1:
                    words = part.column("text").to_pylist()
                    known.update(zip([w.encode() for w in words], part.column("gram").to_pylist()))
                elif kinds[a] == 2:
                    known[None] = part.column("gram")[0].as_py()
                else:
                    if isinstance(grams, list):
                        grams, chances = np.concatenate(grams), np.concatenate(chances)
                        order = np.argsort(grams)
                        grams, chances = grams[order], chances[order]
                    texts = part.column("text")
                    for k in range(0, len(part), 1000):
                        yield scored(part.column("gram").to_numpy()[k : k + 1000], [texts[i].as_buffer().to_pybytes() for i in range(k, min(len(part), k + 1000))])

    return run


def scored(docs: DataFrame) -> DataFrame:
    """docs (doc_id, text, ...) with held_out, n_tokens, n_known, train_tokens, base_score and score."""
    added = ("held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")
    plain = docs.drop(*[c for c in docs.columns if c.lower() in added])
    held_out = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % FOLDS == 0
    rows = packed(plain, held_out.alias("held_out")).withColumn("at", F.monotonically_increasing_id())
    kept = saved(rows.withColumn("lot", F.shiftright("at", LOT)), "lots")
    texts = kept.select("lot", "at", "held_out", text_of("row.text").alias("text"))

    counted = saved(texts.select("lot", "held_out", "text").mapInArrow(_counts, COUNTED), "counts")
    grams, words = counted.filter("word is null"), counted.filter("word is not null")
    own = saved(grams.groupBy("gram").agg(F.sum("n").alias("n")), "grams")
    known = saved(words.groupBy("word").agg(F.sum("n").alias("n")), "words")

    pairs = np.zeros(SYMBOLS * SYMBOLS, "i8")
    pair = F.shiftright("gram", 8 * ORDER) * 256 + F.col("gram").bitwiseAND(F.lit(255))
    for r in own.filter("n > 0").groupBy(pair.alias("pair")).agg(F.sum("n").alias("n")).collect():  # 65,536 at most
        pairs[r.pair] = r.n
    n_words, kinds = known.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count_if(F.col("n") > 0)).first()
    ends = kept.filter("not held_out").count()
    total, kinds = n_words + ends, kinds + (ends > 0)

    chances = saved(_with_chances(own, own.count(), pairs), "chances")
    columns = lambda kind, gram, chance, text: ["lot", F.lit(kind).cast("byte").alias("kind"), F.col(gram).alias("gram") if isinstance(gram, str) else gram.alias("gram"), chance.alias("chance"), text.alias("text")]
    none, zero = F.lit(""), F.lit(0.0)
    slices = grams.select("lot", "gram").join(chances, "gram").select(*columns(0, "gram", F.col("chance"), none))
    slices = slices.unionByName(words.select("lot", "word").join(known, "word").select(*columns(1, "n", zero, F.col("word"))))
    slices = slices.unionByName(texts.select("lot").distinct().select(*columns(2, F.lit(ends).cast("long"), zero, none)))
    dealt = slices.unionByName(texts.select(*columns(3, "at", zero, F.col("text")))).repartition("lot").sortWithinPartitions("lot", "kind")
    scores = dealt.mapInArrow(_scores(total + 0.1 * (kinds + 1)), SCORES)
    met = kept.select("at", "row", "held_out").join(scores, "at")
    return met.select("row.*", "held_out", "n_tokens", "n_known", F.lit(total).cast("long").alias("train_tokens"), F.col("base").alias("base_score"), "score")


def op13_ppm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base score and PPM score of every document."""
    return scored(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")


QUERIES = {"op13_ppm": op13_ppm}
SQL: dict[str, str] = {}
