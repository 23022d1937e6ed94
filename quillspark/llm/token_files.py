"""Token-id files: each document compressed alone against one shared zstandard dictionary.

Layout under ``path``:

* ``dictionary/`` - one row (dict_hash, dictionary, id_bytes): the zstandard
  dictionary, trained on the serialized id arrays of a bounded sample of
  documents, its SHA-256, and the bytes of one id (2 or 4, little-endian).
* ``blocks/`` - Parquet rows in ascending doc_id order. A row is a block of
  neighbouring documents: part, block, first_doc, last_doc, dict_hash, payload
  (the documents' compressed frames end to end) and three parallel arrays:
  doc_ids, n_ids and offsets (where each frame begins; one more for the end).

A short document is read by its block's id range (pushed down to Parquet) and
its frame's offset; no other frame is touched. Spark writes and reads the files,
so any store that Spark knows will do, and a task that runs twice leaves one copy.

Encoding: a word that follows a single space has the same ids wherever it
stands, so each distinct word is encoded once by the tokenizer and its ids
are looked up after that, in caches of a bounded number of bytes. Texts where spaces
meet other white space, or that hold the special token's string, are encoded whole,
as all are by a tokenizer file of another kind than that holds for.

Defined cases: a null or empty text is the end id alone; null doc_ids come
first; repeated doc_ids are documents of their own, ordered by the text's hash;
a long text is a block of its own; an empty table gives empty files; where the sample
is too small to train on, the dictionary is empty and frames are plain; only doc_id
and text are read, whatever other columns are called.
"""

from __future__ import annotations

import hashlib
import json
import os
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import least_hashes, shared_dir, table, text_of

#: The dictionary's size in bytes; documents it is trained on, at most, and their length in characters, at most.
DICT_BYTES = 65_536
SAMPLE_DOCS = 512
SAMPLE_CHARS = 16_384
#: A block ends at so many documents or bytes of text.
BLOCK_DOCS = 512
BLOCK_BYTES = 4 << 20
#: Blocks' worth of texts that are encoded together, so that a word common to them is looked up once.
TOGETHER = 4
#: Bytes of words and their ids that a worker remembers, at most, what Python adds to each entry included, and characters of such a word.
REMEMBERED = 320 << 20
ENTRY = 250
LONGEST = 64
#: New words that are encoded at a time.
CHUNK = 1 << 15

BLOCKS = "part int, block int, first_doc long, last_doc long, dict_hash string, doc_ids array<long>, n_ids array<int>, offsets array<long>, payload binary"
#: Where words cannot be looked up one by one.
ODD = r"  |[\s\p{Z}\x{1c}-\x{1f}\x{85}] [\s\p{Z}\x{1c}-\x{1f}\x{85}]|<\|"
#: The parts of a word that a byte-level tokenizer never joins.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _is_byte_level(path: str) -> bool:
    """Whether a tokenizer file cuts texts as PIECES does: byte-level pieces, no normalizer, special tokens that begin with ``<|``."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    cut = spec.get("pre_tokenizer") or {}
    level = cut.get("type") == "ByteLevel" and not cut.get("add_prefix_space") and cut.get("use_regex", True)
    return level and spec.get("normalizer") is None and spec["model"].get("type") == "BPE" and not spec["model"].get("dropout") and all(t["content"].startswith("<|") for t in spec.get("added_tokens") or [])


class Encoder:
    """Ids of many texts as bytes, by one tokenizer file."""

    _made: dict[str, Encoder] = {}

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import regex
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.by_word = _is_byte_level(path)
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 65_536 else "<u4")
        self.pieces = regex.compile(PIECES).findall
        self.known: dict[str, bytes] = {}  # of words and of their pieces
        self.room = REMEMBERED

    @classmethod
    def of(cls, path: str) -> Encoder:
        if path not in cls._made:
            cls._made[path] = cls(path)
        return cls._made[path]

    def _plain(self, texts: list[str]) -> list[bytes]:
        ids = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        ends = (np.cumsum(list(map(len, ids)), dtype="int64") * self.dtype.itemsize).tolist()
        flat = np.fromiter(chain.from_iterable(ids), self.dtype).tobytes()
        return [flat[a:b] for a, b in zip([0, *ends], ends)]

    def _remember(self, fresh: dict[str, bytes]) -> None:
        if self.room > 0 and fresh:
            if max(map(len, fresh)) > LONGEST:
                fresh = {k: v for k, v in fresh.items() if len(k) <= LONGEST}
            self.known.update(fresh)
            self.room -= sum(map(len, fresh)) + sum(map(len, fresh.values())) + ENTRY * len(fresh)

    def _words(self, words: list[str]) -> list[bytes]:
        """Each word's ids; what is new is encoded by distinct pieces, a word of letters as one."""
        known = self.known
        got = list(map(known.get, words))
        new = [i for i, g in enumerate(got) if g is None]
        for k in range(0, len(new), CHUNK):
            own = new[k : k + CHUNK]
            single, several = [], []
            for i in own:
                if words[i][1:].isalpha():
                    single.append(i)
                else:
                    several.append((i, self.pieces(words[i])))
            missing = {p for _, ps in several for p in ps if p not in known}
            missing.update([words[i] for i in single])
            todo = list(missing)
            fresh = dict(zip(todo, self._plain(todo)))
            for i in single:
                got[i] = fresh[words[i]]
            for i, ps in several:
                got[i] = b"".join([fresh[p] if p in fresh else known[p] for p in ps])
            self._remember(fresh)
            self._remember({words[i]: got[i] for i, ps in several if len(ps) > 1})
        return got

    def encode(self, texts: pa.Array) -> list[bytes | memoryview]:
        texts = texts.cast(pa.string()).fill_null("")
        if not self.by_word:
            return self._plain(texts.to_pylist())
        odd = pc.match_substring_regex(texts, ODD)
        cut = pc.split_pattern(pc.if_else(odd, "", texts), " ")
        bounds = cut.offsets.to_numpy()
        flat = cut.flatten().dictionary_encode()
        at, words = flat.indices.to_numpy(zero_copy_only=False).copy(), flat.dictionary.to_pylist()
        firsts = at[bounds[:-1]]
        own, place = np.unique(firsts, return_inverse=True)
        at[bounds[:-1]] = len(words) + place
        ids = self._words([" " + w for w in words]) + self._words([words[i] for i in own])
        joined = pa.array(ids, pa.large_binary()).take(pa.array(at))
        data = memoryview(joined.buffers()[2] or b"")
        ends = np.frombuffer(joined.buffers()[1], "<i8")[bounds].tolist()
        out: list[bytes | memoryview] = [data[a:b] for a, b in zip(ends, ends[1:])]
        whole = np.flatnonzero(odd.to_numpy(zero_copy_only=False))
        for i, encoded in zip(whole, self._plain(texts.take(pa.array(whole)).to_pylist())):
            out[i] = encoded
        return out


def _slices(batches: Iterator[pa.RecordBatch], times: int = 1) -> Iterator[pa.RecordBatch]:
    """The batches in pieces of a block's size, or so many times that; one long document is a piece of its own."""
    for batch in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False).astype("int64"))
        start = 0
        while start < batch.num_rows:
            base = ends[start - 1] if start else 0
            stop = max(start + 1, min(start + times * BLOCK_DOCS, int(np.searchsorted(ends, base + times * BLOCK_BYTES, "right"))))
            yield batch.slice(start, stop - start)
            start = stop


def _placed(pieces: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.RecordBatch]]:
    """Each piece with the number of rows before it."""
    at = 0
    for piece in pieces:
        yield at, piece
        at += piece.num_rows


def train_dictionary(docs: DataFrame, tokenizer: str, end_id: int) -> bytes:
    """A zstandard dictionary from the serialized ids of at most SAMPLE_DOCS documents, those whose hash is least."""
    import zstandard

    short = docs.select(text_of().alias("text"), F.xxhash64("doc_id", text_of()).alias("h")).filter(F.length("text").between(1, SAMPLE_CHARS))
    rows = least_hashes(short, "h", SAMPLE_DOCS, "text", n=docs.count()).collect()
    if len(rows) < SAMPLE_DOCS:  # that bound counts long and empty documents too
        rows = least_hashes(short, "h", SAMPLE_DOCS, "text").collect()
    texts = [r.text for r in rows]
    encoder = Encoder.of(tokenizer)
    end = np.array([end_id], encoder.dtype).tobytes()
    samples = [bytes(x) + end for x in encoder.encode(pa.array(texts, pa.string()))] if texts else []
    try:
        return zstandard.train_dictionary(min(DICT_BYTES, sum(map(len, samples)) // 8), samples).as_bytes()
    except zstandard.ZstdError:  # too few samples
        return b""


def _codec(kind: str, dictionary: bytes):
    import zstandard

    held = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
    if held and kind == "ZstdCompressor":
        held.precompute_compress(level=3)  # else each frame digests the dictionary anew
    return getattr(zstandard, kind)(dict_data=held)


def write_token_files(docs: DataFrame, path: str, tokenizer: str, end_id: int = 0) -> None:
    """Encodes every whole text of (doc_id, text), appends the end id and writes the files in ascending doc_id order."""
    spark = docs.sparkSession
    dictionary = train_dictionary(docs, tokenizer, end_id)
    dict_hash = hashlib.sha256(dictionary).hexdigest()
    id_bytes = Encoder.of(tokenizer).dtype.itemsize
    spark.createDataFrame([(dict_hash, dictionary, id_bytes)], "dict_hash string, dictionary binary, id_bytes int").coalesce(1).write.parquet(f"{path}/dictionary")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encoder, compress, part = Encoder.of(tokenizer), _codec("ZstdCompressor", dictionary).compress, TaskContext.get().partitionId()
        end = np.array([end_id], encoder.dtype).tobytes()
        encoded = ((piece, whole[at : at + piece.num_rows]) for large in _slices(batches, TOGETHER) for whole in [encoder.encode(large.column("text"))] for at, piece in _placed(_slices(iter([large]))))
        for k, (piece, own) in enumerate(encoded):
            ids = [bytes(x) + end for x in own]
            frames = [compress(x) for x in ids]
            offsets = np.concatenate([[0], np.cumsum([len(x) for x in frames])])
            doc_ids = piece.column("doc_id").to_pylist()
            known = [d for d in doc_ids if d is not None]
            row = {
                "part": [part], "block": [k], "first_doc": [min(known, default=None)], "last_doc": [max(known, default=None)], "dict_hash": [dict_hash], "doc_ids": [doc_ids],
                "n_ids": [[len(x) // id_bytes for x in ids]], "offsets": [offsets], "payload": [b"".join(frames)],
            }
            yield pa.RecordBatch.from_pydict(row, schema)

    schema = pa.schema(
        [("part", pa.int32()), ("block", pa.int32()), ("first_doc", pa.int64()), ("last_doc", pa.int64()), ("dict_hash", pa.string()), ("doc_ids", pa.list_(pa.int64())), ("n_ids", pa.list_(pa.int32())), ("offsets", pa.list_(pa.int64())), ("payload", pa.binary())]
    )
    ordered = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").withColumn("h", F.xxhash64("text")).repartitionByRange("doc_id", "h").sortWithinPartitions("doc_id", "h")
    ordered.select("doc_id", "text").mapInArrow(pack, BLOCKS).write.option("compression", "none").parquet(f"{path}/blocks")


def _dictionary(spark: SparkSession, path: str) -> tuple[bytes, int]:
    row = spark.read.parquet(f"{path}/dictionary").first()
    return bytes(row.dictionary), row.id_bytes


def read_token_stats(spark: SparkSession, path: str) -> DataFrame:
    """Per document of the files: doc_id, start (ids of all before it), n_tokens, ids_crc32."""
    dictionary, id_bytes = _dictionary(spark, path)
    blocks = spark.read.schema(BLOCKS).parquet(f"{path}/blocks")
    total = F.aggregate("n_ids", F.lit(0).cast("long"), lambda a, n: a + n)
    counts = blocks.select("part", "block", total.alias("ids"))
    # one row for each written part, so the driver adds them up
    before, sums = 0, []
    for r in sorted(counts.groupBy("part").agg(F.sum("ids").alias("ids")).collect()):
        sums.append((r.part, before))
        before += r.ids
    parts = spark.createDataFrame(sums, "part int, part_start long")
    within = Window.partitionBy("part").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.withColumn("in_part", F.coalesce(F.sum("ids").over(within), F.lit(0))).join(parts, "part").select("part", "block", (F.col("part_start") + F.col("in_part")).alias("start"))

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decompress = _codec("ZstdDecompressor", dictionary).decompress
        for batch in batches:
            for row in range(batch.num_rows):
                part, block, doc_ids, n_ids, offsets, payload = (batch.column(c)[row] for c in ("part", "block", "doc_ids", "n_ids", "offsets", "payload"))
                n = n_ids.values.to_numpy().astype("int64")
                at, data = offsets.values.to_pylist(), memoryview(payload.as_buffer())
                crcs = [zlib.crc32(np.frombuffer(decompress(data[a:b]), f"<u{id_bytes}").astype("<u4")) for a, b in zip(at, at[1:])]
                same = [pa.array(np.full(len(n), x.as_py(), "int32")) for x in (part, block)]
                yield pa.RecordBatch.from_arrays([*same, doc_ids.values, pa.array(np.cumsum(n) - n), pa.array(n), pa.array(crcs, pa.int64())], ["part", "block", "doc_id", "before", "n_tokens", "ids_crc32"])

    # the payloads stay where they are read; only the counts meet the blocks' starts
    read = blocks.select("part", "block", "doc_ids", "n_ids", "offsets", "payload").mapInArrow(unpack, "part int, block int, doc_id long, before long, n_tokens long, ids_crc32 long")
    return read.join(starts, ["part", "block"]).select("doc_id", (F.col("start") + F.col("before")).alias("start"), "n_tokens", "ids_crc32")


def read_documents(spark: SparkSession, path: str, doc_ids: list[int]) -> DataFrame:
    """(doc_id, ids) of a few documents: only their blocks' rows are read, only their frames decompressed."""
    dictionary, id_bytes = _dictionary(spark, path)
    wanted = set(doc_ids)
    near = F.lit(False)
    for d in wanted:
        near |= (F.col("first_doc") <= d) & (F.col("last_doc") >= d)

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decompress = _codec("ZstdDecompressor", dictionary).decompress
        for batch in batches:
            for row in batch.to_pylist():
                for i, d in enumerate(row["doc_ids"]):
                    if d in wanted:
                        frame = row["payload"][row["offsets"][i] : row["offsets"][i + 1]]
                        yield pa.RecordBatch.from_arrays([pa.array([d]), pa.array([np.frombuffer(decompress(frame), f"<u{id_bytes}").astype("int32")], pa.list_(pa.int32()))], ["doc_id", "ids"])

    return spark.read.schema(BLOCKS).parquet(f"{path}/blocks").filter(near).mapInArrow(pick, "doc_id long, ids array<int>")


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document through the 50k byte-level tokenizer into the files, and back."""
    import public_tokenizers

    path = shared_dir(spark, "token-files")
    write_token_files(table(spark, sf_dir, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"))
    return read_token_stats(spark, path)


QUERIES = {"op4_token_files": op4_token_files}
SQL: dict[str, str] = {}
