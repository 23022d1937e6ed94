"""Chunks of documents that are larger than a row: the same chunks as ``chunks``, from page rows that are never gathered.

Three steps. Each page alone is reduced to an outline: its length, its runs of line
breaks, the section headers that lie inside it, and the text at its two ends where a
header could reach over the page's border. Outlines, some hundredths of the text, are
read in order, a document's in one task, by a scan that carries the header matcher and
the paragraph packer from page to page and gives out places: which characters of which
page belong to which chunk. By these places pages are cut where they lie, and pieces
meet by chunk. So no row holds more than a page or a chunk, be a document of any length.

A header's match never reaches over a line that cannot be part of one (a *barrier*):
one with a character that headers lack, as nearly every line of prose has. So headers
between two barriers of a page are matched in its own task, and only what lies between
a page's last barrier and the next page's first is matched by the scan.

A page without text (null) takes no part, as in the row form. Pages of one document with
equal numbers and ids are in any order.
"""

from __future__ import annotations

import re
from collections import deque
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import WS, WS_IN, count_sentences, extract_keywords, extract_topic, strip
from ..sources.shared import written
from .chunks import HEADERS, LONGEST, SHORTEST, TARGET

OUTLINE = "at long, doc string, page int, id string, n int, open boolean, head string, tail string, starts array<int>, runs array<int>, lengths array<int>"
PIECE = "doc string, section int, part int, packed boolean, seq int, at long, begin int, size int"
BOUNDARY = "doc string, boundary long"
OFFSET = "doc string, at long, start long"
#: Characters of the probes that a chunk's pages are found by, and of the grams whose least hash is a probe's key.
PROBE, GRAM = 100, 16


def _python(pattern: str) -> str:
    """A pattern of the JVM's in Python's form."""
    return re.sub(r"\\x\{([0-9a-f]+)\}", lambda m: re.escape(chr(int(m[1], 16))), pattern).replace(r"\p{Nd}", r"\d")


_HEADERS = [re.compile(_python(p)) for p in HEADERS]
_PLAIN = re.compile(_python(rf"[A-Za-z{WS_IN}]*\Z"))
_BLANK = re.compile(_python(rf"{WS}*\Z"))
_NUMBER = re.compile(_python(rf"\p{{Nd}}+\.?\p{{Nd}}*{WS}*\Z"))
_TITLE = re.compile(_python(rf"{WS}*[A-Z][^\n]{{5,50}}\Z"))
_DIGIT = re.compile(r"\d")


def header_starts(text: str) -> list[int]:
    """Where headers of any form start, in order."""
    return sorted({m.start() for p in _HEADERS for m in p.finditer(text)})


def barriers(text: str) -> list[tuple[int, int]]:
    """(start, end) of the lines that no header can hold. The page before may end in a number, so the first line with text is no title's barrier."""
    out, at, numbered = [], 0, True  # numbered: the last line with text is a number alone, or not known
    for line in text.split("\n"):
        end = at + len(line)
        if not _BLANK.match(line):
            if not (_PLAIN.match(line) or _DIGIT.match(line) or (numbered and _TITLE.match(line))):
                out.append((at, end))
            numbered = bool(_NUMBER.match(line))
        at = end + 1
    return out


def outline(text: str) -> tuple:
    """(n, open, head, tail, starts, runs, lengths) of a page; tail is null in a page without a barrier, whose head is all of it."""
    runs = [(m.start(), m.end() - m.start()) for m in re.finditer("\n+", text)]
    runs = [(p, k) for p, k in runs if k > 1 or p == 0 or p + k == len(text)]
    walls = barriers(text)
    starts: list[int] = []
    for (_, end), (begin, _) in zip(walls, walls[1:]):
        if begin > end + 1:  # lines in between, from the line break after one barrier to the first character of the next
            starts += [end + k for k in header_starts(text[end : begin + 1])]
    head = text[: walls[0][0] + 1] if walls else text
    return len(text), bool(walls), head, text[walls[-1][1] :] if walls else None, starts, [p for p, _ in runs], [k for _, k in runs]


class Scan:
    """The state of one document from page to page; places count characters of the document from 0."""

    def __init__(self, target: int, shortest: int, longest: int):
        self.target, self.shortest, self.longest = target, shortest, longest
        self.end = 0  # of all pages so far, without the line breaks that join the next
        self.pages: deque = deque()  # (at, offset, n) of pages whose characters are still to be given out
        self.zone, self.zone_at = [], 0  # text that is not matched yet, and its place
        self.bounds: deque = deque()
        self.runs: deque = deque()
        self.edge: tuple | None = None  # a run of line breaks at the end so far
        self.section, self.start = 0, 0
        self.cut: list = []  # places of paragraph ends of a section that may still be short
        self._fresh()
        self.found: list = []  # pieces
        self.headers: list = []  # section starts

    def _fresh(self) -> None:
        self.packing, self.part, self.filled = False, 0, 0
        self.part_at = self.para_at = self.start
        self.cut = []

    def page(self, at: int, n: int, open_: bool, head: str, tail: str | None, starts, runs, lengths) -> int:
        """Takes the next page's outline; returns its place."""
        joined = 2 if self.pages_seen else 0
        base = self.end + joined
        self.pages_seen = True
        if joined:
            self.edge = (self.edge[0], self.edge[1] + 2) if self.edge else (self.end, 2)
            self.zone.append("\n\n")
        for p, k in zip(runs, lengths):
            if p == 0:
                self.edge = (self.edge[0], self.edge[1] + k) if self.edge else (base, k)
                if k == n:
                    break
            if self.edge:
                self._run(*self.edge)
                self.edge = None
            if p and p + k == n:
                self.edge = (base + p, k)
            elif p:
                self._run(base + p, k)
        if self.edge and n and not (len(runs) and runs[-1] + lengths[-1] == n):
            self._run(*self.edge)
            self.edge = None
        self.zone.append(head)
        self.pages.append((at, base, n))
        self.end = base + n
        if open_:
            self._match()
            self.bounds.extend(base + int(s) for s in starts)
            self.zone, self.zone_at = [tail], base + n - len(tail)
            self._advance(self.zone_at)
        return base

    pages_seen = False

    def close(self) -> None:
        """The document's end."""
        if self.edge:
            self._run(*self.edge)
            self.edge = None
        self._match()
        self._advance(self.end)
        if self.end:
            self._end_section(self.end)

    def _run(self, place: int, k: int) -> None:
        if k > 1:
            self.runs.append((place, k))

    def _match(self) -> None:
        self.bounds.extend(self.zone_at + k for k in header_starts("".join(self.zone)))

    def _advance(self, ready: int) -> None:
        """Takes all section starts and paragraph ends before a place up to which they are known."""
        while self.runs or self.bounds:
            bound = self.bounds[0] if self.bounds else None
            if self.runs and (bound is None or self.runs[0][0] < bound):
                place, k = self.runs[0]
                if place + k > ready:
                    break
                self.runs.popleft()
                k -= bound == place + k - 1  # a header takes the last line break for itself
                for d in range(place, place + k - 1, 2):
                    self._paragraph(d)
            else:
                self.bounds.popleft()
                self.headers.append(bound)
                if bound:
                    self._end_section(bound)
        if not self.packing and ready - self.start > self.longest:
            self._pack()
        needed = self.part_at if self.packing else self.start
        while self.pages and self.pages[0][1] + self.pages[0][2] + 2 <= needed:
            self.pages.popleft()

    def _pack(self) -> None:
        self.packing = True
        for d in self.cut:
            self._add(d)
        self.cut = []

    def _paragraph(self, end: int) -> None:
        self._add(end) if self.packing else self.cut.append(end)

    def _add(self, end: int) -> None:
        n = end - self.para_at
        if self.filled + n < self.target:
            self.filled += n + 2
        else:
            if self.filled:
                self._give(self.part_at, self.para_at - 2)
            self.part_at, self.filled = self.para_at, n + 2
        self.para_at = end + 2

    def _end_section(self, end: int) -> None:
        if end - self.start > self.longest:
            if not self.packing:
                self._pack()
            self._add(end)
            self._give(self.part_at, end)
        else:
            self._give(self.start, end)
        self.section, self.start = self.section + 1, end
        self._fresh()

    def _give(self, begin: int, end: int) -> None:
        if end - begin >= self.shortest:
            for seq, (at, base, n) in enumerate(p for p in self.pages if p[1] < end and p[1] + p[2] + 2 > begin):
                a, b = max(begin, base) - base, min(end, base + n + 2) - base
                self.found.append((self.section, self.part, self.packing, seq, at, a, b - a))
        self.part += 1


def numbered_pages(pages: DataFrame) -> DataFrame:
    """pages (id, doc, page, text) with ``at``, a number of each row, written to the shared folder."""
    return written(pages.select("id", "doc", "page", "text").withColumn("at", F.monotonically_increasing_id()), "pages")


def outlines(numbered: DataFrame) -> DataFrame:
    """The outline of each page with text, in order within its document, a document in one partition."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            made = pd.DataFrame([outline(t) for t in batch["text"]], columns=["n", "open", "head", "tail", "starts", "runs", "lengths"], index=batch.index)
            yield pd.concat([batch[["at", "doc", "page", "id"]], made], axis=1)

    made = numbered.filter("text is not null").select("at", "doc", F.col("page").cast("int").alias("page"), "id", "text").mapInPandas(run, OUTLINE)
    return made.repartition("doc").sortWithinPartitions("doc", "page", "id", "at")


def _scanned(ordered: DataFrame, schema: str, take, sizes: tuple[int, int, int]) -> DataFrame:
    """What ``take`` gives of each document's scan: after a page (place given), and at the end."""
    columns = [c.split()[0] for c in schema.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        doc, scan = None, None
        for batch in batches:
            rows: list = []
            for r in batch.itertuples(index=False):
                if scan is None or not (r.doc == doc or (r.doc is None and doc is None)):
                    if scan is not None:
                        scan.close()
                        rows += [(doc, *x) for x in take(scan, None, None)]
                    doc, scan = r.doc, Scan(*sizes)
                place = scan.page(int(r.at), int(r.n), r.open, r.head, r.tail, r.starts, r.runs, r.lengths)
                rows += [(doc, *x) for x in take(scan, int(r.at), place)]
            yield pd.DataFrame(rows, columns=columns)
        if scan is not None:
            scan.close()
            yield pd.DataFrame([(doc, *x) for x in take(scan, None, None)], columns=columns)

    return ordered.mapInPandas(run, schema)


def _pieces_of(scan: Scan, at: int | None, place: int | None) -> list:
    out, scan.found = scan.found, []
    return out


def _bounds_of(scan: Scan, at: int | None, place: int | None) -> list:
    out, scan.headers = [(b,) for b in scan.headers if b], []
    return out + ([(0,)] if place == 0 else []) + ([(scan.end,)] if at is None and scan.end else [])


def _offsets_of(scan: Scan, at: int | None, place: int | None) -> list:
    return [] if at is None else [(at, place)]


def boundaries(pages: DataFrame) -> DataFrame:
    """(doc, boundary): 0, every header's start and the length, of documents as their pages joined by a blank line."""
    return _scanned(outlines(numbered_pages(pages)), BOUNDARY, _bounds_of, (TARGET, SHORTEST, LONGEST)).distinct()


def page_offsets(pages: DataFrame) -> DataFrame:
    """(doc, page, id, start): where each page with text starts in its document."""
    numbered = numbered_pages(pages)
    found = _scanned(outlines(numbered), OFFSET, _offsets_of, (TARGET, SHORTEST, LONGEST)).select("at", "start")
    return numbered.select("at", "doc", "page", "id").join(found, "at").drop("at")


def gram_keys(text: str | None) -> np.ndarray:
    """For every stretch of PROBE characters of a text the least hash of its grams; each once. Equal stretches have equal keys."""
    codes = np.frombuffer((text or "").encode("utf-32-le", "surrogatepass"), "<u4").astype("u8")
    n = len(codes) - PROBE + 1
    if n < 1:
        return np.zeros(0, "i8")
    m = len(codes) - GRAM + 1
    h = np.zeros(m, "u8")
    for k in range(GRAM):
        h = h * np.uint64(0x100000001B3) + codes[k : k + m]
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    # least of each window: of the part in its block, from the right, and of the part in the next, from the left
    w = PROBE - GRAM + 1
    blocks = np.concatenate([h, np.full(-m % w, np.iinfo("u8").max, "u8")]).reshape(-1, w)
    left, right = np.minimum.accumulate(blocks, 1).ravel(), np.minimum.accumulate(blocks[:, ::-1], 1)[:, ::-1].ravel()
    return np.unique(np.minimum(right[:n], left[w - 1 : w - 1 + n])).view("i8")


def _keys(text: Column) -> Column:
    @F.pandas_udf("array<long>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([gram_keys(t) for t in texts])

    return run(text)


def page_ranges(chunks: DataFrame, numbered: DataFrame) -> DataFrame:
    """(key, page_range) of chunks (key, doc, body): the pages of the document that hold the body's first or last PROBE characters, else its first page.

    Distinct probes meet pages (numbered_pages) by document and least gram hash, and
    the characters decide; bodies shorter than a probe are looked for in each page of
    their document.
    """
    ends = F.array_distinct(F.array(F.left("body", F.lit(PROBE)), F.right("body", F.lit(PROBE))))
    wanted = chunks.select("key", "doc", F.explode(ends).alias("probe"))
    probes = wanted.select("doc", "probe").distinct()
    long = F.length("probe") == PROBE
    texts = numbered.select("at", "doc", "page", "id", "text")
    keyed = texts.select("at", F.col("doc").alias("of"), F.explode(_keys(F.col("text"))).alias("own"))
    met = probes.filter(long).withColumn("gram", F.explode(_keys(F.col("probe")))).join(keyed, F.col("doc").eqNullSafe(F.col("of")) & (F.col("gram") == F.col("own"))).select("doc", "probe", "at")
    held = met.join(texts.select("at", "page", "id", "text"), "at").filter(F.contains("text", F.col("probe"))).select("doc", "probe", "page", "id", "at")
    short = probes.filter(~long).join(texts.withColumnRenamed("doc", "of"), F.col("doc").eqNullSafe(F.col("of")) & F.contains("text", F.col("probe"))).select("doc", "probe", "page", "id", "at")
    held = held.unionByName(short)
    a, b = wanted.alias("a"), held.alias("b")
    own = a.join(b, F.col("a.doc").eqNullSafe(F.col("b.doc")) & (F.col("a.probe") == F.col("b.probe"))).groupBy("a.key").agg(F.array_sort(F.collect_set(F.struct("b.page", "b.id", "b.at"))).alias("held"))
    first = texts.groupBy(F.col("doc").alias("of")).agg(F.min_by("page", F.struct("page", "id")).alias("first"))
    rows = chunks.select("key", "doc").join(own, "key", "left").join(first, F.col("doc").eqNullSafe(F.col("of")), "left")
    return rows.select("key", F.coalesce(F.col("held.page"), F.array("first")).alias("page_range"))


def bodies(numbered: DataFrame, target: int = TARGET, shortest: int = SHORTEST, longest: int = LONGEST) -> DataFrame:
    """(doc, section, part, body): the parts that chunks are made of, cut from the pages where they lie."""
    pieces = _scanned(outlines(numbered), PIECE, _pieces_of, (target, shortest, longest))
    cut = pieces.join(numbered.select("at", "text"), "at").select("doc", "section", "part", "packed", F.struct("seq", F.substring(F.concat("text", F.lit("\n\n")), F.col("begin") + 1, F.col("size")).alias("text")).alias("piece"))
    whole = cut.groupBy("doc", "section", "part", "packed").agg(F.array_join(F.transform(F.array_sort(F.collect_list("piece")), lambda p: p["text"]), "").alias("text"))
    return whole.select("doc", "section", "part", F.when(F.col("packed"), strip(F.col("text"))).otherwise(F.col("text")).alias("body")).filter(F.length("body") >= shortest)


def semantic_chunks(pages: DataFrame, target: int = TARGET, shortest: int = SHORTEST, longest: int = LONGEST, terms: list[str] | None = None) -> DataFrame:
    """The chunks of pages (id, doc, page, text) as ``chunks.semantic_chunks`` has them, but for source_pages, which is as long as a document has pages."""
    numbered = numbered_pages(pages)
    kept = bodies(numbered, target, shortest, longest)
    kept = written(kept.withColumn("key", F.monotonically_increasing_id()), "bodies")
    order = Window.partitionBy("doc").orderBy("section", "part")
    numbers = kept.select("key", "doc", "section", "part").withColumn("chunk_no", F.row_number().over(order)).select("key", "chunk_no")
    rows = kept.join(numbers, "key").join(page_ranges(kept.select("key", "doc", "body"), numbered), "key")
    body = F.col("body")
    return rows.select(
        F.format_string("%s-chunk%03d", "doc", "chunk_no").alias("id"), strip(body).alias("text"), "doc", "chunk_no", "page_range", extract_topic(body, F.col("doc")).alias("topic"),
        F.length(body).alias("char_count"), count_sentences(body).alias("sentence_count"), extract_keywords(body, terms).alias("keywords"),
    )


def with_source_pages(chunks: DataFrame, pages: DataFrame) -> DataFrame:
    """Chunks with the ids of all pages of their document, for documents whose ids fit a row."""
    ids = pages.groupBy(F.col("doc").alias("of")).agg(F.transform(F.array_sort(F.collect_list(F.struct("page", "id"))), lambda p: p["id"]).alias("source_pages"))
    return chunks.join(ids, F.col("doc").eqNullSafe(F.col("of")), "left").drop("of")
