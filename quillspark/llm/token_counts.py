"""Edit-aware token counts: a segment tree for each document, re-encoded only where edits touch.

A text is cut into leaves of about ``LEAF`` characters where no pre-token of a
byte-level tokenizer runs across: before white space that follows anything else, and
between letters, digits and punctuation. So the leaves' token counts add up to the
text's. ``sums`` holds the tree over them: node i is the sum of nodes 2i and 2i + 1,
the leaves' own counts are its second half, and node 1 is the document's count.

An edit replaces a span of characters. The leaves it touches, and as many
neighbours as it takes until both borders are clean cuts again, are encoded anew, cut
into leaves of the usual length; their leaves take the new counts and the sums above
them change. Only where more leaves come out than went in is the tree laid out anew,
from the counts it has. Nothing else of the document is encoded.

Defined cases: a null or empty text has one empty leaf and no tokens; a text that
cannot be cut (one endless word) is one leaf, however long, and is read in linear time;
edits are applied by their place in the text before any edit, must not overlap, and
are cut off at the text's end; a null replacement deletes; null or no edits leave the
counts alone; repeated rows are counted each; an empty table gives no rows; columns
named like an added one are replaced.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import packed, saved, table, text_of
from .token_files import Encoder

LEAF = 512
#: Leaves that are encoded at a time.
BATCH = 16_384
TREE = "leaf_chars array<int>, sums array<long>"
EDITS = "array<struct<start:int,end:int,text:string>>"


_SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_MARK = r"!-#%-&(-/:;=?@\[-`{}~"  # no quote that may begin a contraction, nothing that may be of a special token
_LETTER, _STOP = r"A-Za-zぁ-ゖァ-ヺ一-龥", r"、。！，：；？"
#: A place where a pre-token ends whatever stands before and after the two characters about it.
CLEAN = re.compile(rf"(?<=[^{_SPACE}])(?=[{_SPACE}])|(?<=[{_LETTER}])(?=[0-9{_MARK}{_STOP}])|(?<=[0-9])(?=[{_LETTER}{_MARK}{_STOP}])|(?<=[{_MARK}{_STOP}])(?=[{_LETTER}0-9])")


def cut(text: str) -> list[int]:
    """Where the leaves begin, and the text's end."""
    bounds = [0]
    while m := CLEAN.search(text, bounds[-1] + LEAF):
        bounds.append(m.start())
    return [*bounds, len(text)]


def count_all(encoder: Encoder, texts: list[str]) -> list[int]:
    out: list[int] = []
    for k in range(0, len(texts), BATCH):
        out += [len(x) // encoder.dtype.itemsize for x in encoder.encode(pa.array(texts[k : k + BATCH], pa.string()))]
    return out


def tree(counts: list[int]) -> np.ndarray:
    """The sums over the leaves' counts; the leaves are padded to a power of two."""
    width = 1 << max(0, len(counts) - 1).bit_length()
    sums = np.zeros(2 * width, "int64")
    sums[width : width + len(counts)] = counts
    while width > 1:
        width //= 2
        sums[width : 2 * width] = sums[2 * width : 4 * width].reshape(-1, 2).sum(1)
    return sums


def build_trees(docs: DataFrame, tokenizer: str) -> DataFrame:
    """docs with ``leaf_chars`` and ``sums``."""

    @F.pandas_udf("struct<leaf_chars:array<int>,sums:array<bigint>>")
    def build(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        encoder = Encoder.of(tokenizer)
        for batch in batches:
            texts = [t or "" for t in batch]
            bounds = [cut(t) for t in texts]
            counts = count_all(encoder, [t[a:b] for t, cuts in zip(texts, bounds) for a, b in zip(cuts, cuts[1:])])
            rows, at = [], 0
            for cuts in bounds:
                rows.append((np.diff(cuts).astype("int32"), tree(counts[at : at + len(cuts) - 1])))
                at += len(cuts) - 1
            yield pd.DataFrame(rows, columns=["leaf_chars", "sums"])

    plain = docs.drop("leaf_chars", "sums")
    return packed(plain).select("row", build("row.text").alias("built")).select("row.*", "built.*")


def edit(text: str, edits: list[tuple[int, int, str]], leaf_chars: np.ndarray, sums: np.ndarray, encode) -> tuple[str, np.ndarray, np.ndarray, int]:
    """The edited text, its leaves and sums, and the characters that were encoded anew; encode counts the tokens of a list of texts."""
    begins = np.concatenate([[0], np.cumsum(leaf_chars)])
    n, width = len(leaf_chars), len(sums) // 2
    leaf_chars, sums = leaf_chars.copy(), sums.copy()
    edits = sorted((min(a, len(text)), min(max(a, b), len(text)), r) for a, b, r in edits)
    # neighbouring edits whose leaves meet are one region
    regions: list[list] = []
    for a, b, r in edits:
        first = int(np.searchsorted(begins[1:], a, "right")) if a < len(text) else n - 1
        last = max(first, int(np.searchsorted(begins[1:], b, "left")))
        if regions and first <= regions[-1][1]:
            regions[-1][1] = max(regions[-1][1], last)
            regions[-1][2].append((a, b, r))
        else:
            regions.append([first, min(last, n - 1), [(a, b, r)]])

    def rewritten(first: int, last: int, own: list) -> str:
        parts, at = [], int(begins[first])
        for a, b, r in own:
            parts += [text[at:a], r]
            at = b
        return "".join([*parts, text[at : int(begins[last + 1])]])

    done: list[list] = []  # grown until both borders are clean; regions that meet while growing become one
    for region in regions:
        while True:
            first, last, own = region
            new = rewritten(first, last, own)
            if done and first <= done[-1][1]:
                before = done.pop()
                region = [before[0], max(last, before[1]), before[2] + own]
                continue
            at, end = int(begins[first]), int(begins[last + 1])
            left = at == 0 or bool(CLEAN.match(text[at - 1] + new[:1], 1))
            right = end == len(text) or bool(CLEAN.match(new[-1:] + text[end : end + 1], 1))
            if left and right:
                done.append([first, last, own, new])
                break
            region = [first - (not left), last + (not right), own]
    pieces = [[new[a:b] for cuts in [cut(new)] for a, b in zip(cuts, cuts[1:])] for *_, new in done]
    counts = iter(encode([x for own in pieces for x in own]))
    out, at, touched, fresh, grown = [], 0, 0, [], False
    for (first, last, _, new), own in zip(done, pieces):
        out += [text[at : int(begins[first])], new]
        at, touched, room = int(begins[last + 1]), touched + len(new), last + 1 - first
        chars, tokens = [len(x) for x in own], [next(counts) for _ in own]
        grown |= len(own) > room
        fresh.append((first, last, chars + [0] * (room - len(own)), tokens + [0] * (room - len(own))))
    if grown:
        chars, tokens, k = [], [], 0
        for first, last, new_chars, new_tokens in [*fresh, (n, n, [], [])]:
            chars += [*leaf_chars[k:first].tolist(), *new_chars]
            tokens += [*sums[width + k : width + first].tolist(), *new_tokens]
            k = last + 1
        leaf_chars, sums = np.array(chars, leaf_chars.dtype), tree(tokens)
    else:
        for first, last, new_chars, new_tokens in fresh:
            leaf_chars[first : last + 1] = new_chars
            for k, tokens in zip(range(first, last + 1), new_tokens):
                change, node = tokens - sums[width + k], width + k
                while node:
                    sums[node] += change
                    node //= 2
    return "".join([*out, text[at:]]), leaf_chars, sums, touched


def apply_edits(trees: DataFrame, tokenizer: str, find: Callable[[str], list[tuple[int, int, str]]] | None = None) -> DataFrame:
    """Rows of build_trees after edits: text, leaf_chars and sums anew, ``n_edits`` and ``encoded_chars``.

    The edits are those of the column ``edits`` (structs of start, end, text), or those that ``find`` gives for a text.
    """
    added = ["text", "leaf_chars", "sums", "n_edits", "encoded_chars"]

    @F.pandas_udf("struct<text:string,leaf_chars:array<int>,sums:array<bigint>,n_edits:int,encoded_chars:bigint>")
    def run(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.DataFrame]:
        encoder = Encoder.of(tokenizer)
        for texts, leaves, sums, *edits in batches:
            rows = []
            for k, (text, own, total) in enumerate(zip(texts, leaves, sums)):
                if find is None:
                    changes = [(c["start"], c["end"], c["text"] or "") for c in (edits[0][k] if edits[0][k] is not None else [])]
                else:
                    changes = find(text or "")
                if changes:
                    text, own, total, touched = edit(text or "", changes, np.asarray(own), np.asarray(total), lambda x: count_all(encoder, x))
                    rows.append((text, own, total, len(changes), touched))
                else:
                    rows.append((text, own, total, 0, 0))
            yield pd.DataFrame(rows, columns=added)

    keep = [F.col(f"row.`{c}`") for c in trees.columns if c not in (*added, *(["edits"] if find is None else []))]
    told = packed(trees).select("row", run("row.text", "row.leaf_chars", "row.sums", *(["row.edits"] if find is None else [])).alias("edited"))
    return told.select(*keep, "edited.*")


def n_tokens(sums: str = "sums") -> Column:
    """A document's count: its tree's root."""
    return F.element_at(sums, 2)


def redactions(pattern: str, replacement: str) -> Callable[[str], list[tuple[int, int, str]]]:
    """Edits that put a replacement for each match of a pattern (Python's ``re``) in a text."""
    matches = re.compile(pattern).finditer
    return lambda text: [(*m.span(), replacement) for m in matches(text)]


#: What the query redacts: e-mail addresses and runs of three digits or more, with what stands between them.
REDACTED = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9.-]+|[+(]?[0-9]{3}[0-9().+-]*"


def op8_edit_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of every document before and after its identifiers are redacted, counted anew only around them."""
    import public_tokenizers

    tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    trees = saved(build_trees(table(spark, sf_dir, "documents").select("doc_id", "text"), tokenizer), "token-trees")
    edited = apply_edits(trees.withColumn("n_before", n_tokens()), tokenizer, redactions(REDACTED, "[redacted]"))
    return edited.select("doc_id", F.length(text_of()).cast("long").alias("n_chars"), "n_before", n_tokens().alias("n_tokens"), F.col("n_edits").cast("long").alias("n_edits"), "encoded_chars")


QUERIES = {"op8_edit_counts": op8_edit_counts}
SQL: dict[str, str] = {}
