"""Main text of web pages by deducing each host's template from equivalence classes of tokens.

A page is a sequence of tokens: tags, told apart by their path of enclosing tags
(with classes), and text runs, told apart by path and text. Over the distinct pages
of one host a token has an occurrence vector: how often it stands in each page.
Tokens with the same vector form an equivalence class. A class is valid if it is
large (``MIN_TOKENS`` tokens) and frequent (``MIN_PAGES`` pages and ``MIN_SHARE`` of
the host's), and a text run of it nests if a tag about it is of a valid class that is
at least as frequent. The valid classes, so nested, are the host's template.

What stands between the template's tokens are its slots, each named by the innermost
template tag about it. Over all of the host's pages a slot is dull if at least half
of its characters are links, or if, outside of an article, its text runs repeat
``REPEATS`` times on average (adverts in rotation, notices); a slot with half of the
host's text is never dull. The main text is what the slots hold that are not dull,
without the template's own text.

Tags, roles, class and id words and ``hidden`` tell further which parts are no
article: menus, headers, footers, sidebars, notices, adverts, forms and comments are
left out on every page, and where a page has an article (``article``, ``main`` or role
main) only its runs are looked at. Hosts with too few pages have these alone.

The template never takes a page's last text, nor over half of an article's: such
a page keeps what its tags tell.

Vectors are compared by their length and a sum of hashes over pages, so neither a
host's pages nor a token's are ever gathered; a host with a third of all pages
is counted by partial sums. A host's template is one row: its tokens stand in 90 %
of the pages, so it is little longer than a page.

Defined cases: null or empty html has an empty text; a null url is a host of its
own; copies of a page on one host count as one page and each get its text; tokens
of equal frequency are told apart by their vectors alone; tags that are never closed
end with what encloses them; broken tags are text; a page is read in time linear in
its length; an empty table gives no rows; columns of the input may have any name,
only ``text`` is replaced.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import join_counted, saved, table

MIN_TOKENS = 3
MIN_PAGES = 8
MIN_SHARE = 0.9
#: Average times that a dull slot's text runs repeat.
REPEATS = 4

MAIN, PLAIN, BOILER = 0, 1, 2

# HTML's elements by kind, and words that name boilerplate in roles, classes and ids.
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre search section summary table tbody td tfoot th thead title tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BOILER_TAGS = frozenset("head nav header footer aside menu dialog button select option label input svg canvas iframe object audio video map search".split())
BOILER_ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar status".split())
BOILER_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense sponsor sponsored sponsors promo promos promotion banner nav navbar navigation menu menus submenu breadcrumb breadcrumbs sidebar sidebars aside rail header masthead topbar footer foot colophon cookie cookies consent gdpr notice notices alert alerts popup modal overlay newsletter subscribe subscription signup login form forms search comment comments commentlist respond reply replies disqus discussion share sharing social related recommended widget widgets pagination pager toolbar skip".split()
)
#: Those that name boilerplate inside an article as well, where they are a whole class or id.
INNER_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising adsense sponsor sponsored sponsors promo promos promotion nav navbar navigation menu breadcrumb breadcrumbs sidebar sidebars cookie cookies consent popup modal overlay newsletter signup login comments commentlist disqus share sharing social widget widgets pagination pager toolbar".split()
)
CLOSES_P = BLOCK - {"body", "html", "head", "td", "th", "tr", "tbody", "thead", "tfoot", "legend", "summary", "title"}
SAME = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
KEEPS = frozenset("article aside blockquote body div dl fieldset figure footer form header html main menu nav ol section table td th ul".split())

_QUOTED = r"""(?:[^<>"']|"[^"]*"|'[^']*')*+"""
_raw = re.compile(rf"<!--.*?(?:-->|\Z)|<(script|style|noscript|template|textarea|title|iframe|noframes)\b{_QUOTED}>.*?(?:</\1\s*>|\Z)|<[!?][^<>]*>", re.S | re.I)
_tag = re.compile(rf"""(</?[A-Za-z][^<>"'\s/]*+{_QUOTED}>)""")
_name = re.compile(r"</?([A-Za-z][^\s/>]*)")
_attribute = re.compile(r"""(?<![^\s"'<>/=])([^\s"'<>/=]++)\s*+=\s*+(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))|(?<=\s)(hidden)(?=[\s/>])""")
_parts = re.compile(r"[a-z0-9]+")

PARSED = "struct<row:bigint,main:boolean,tokens:array<bigint>,parents:array<int>,times:array<int>,texts:array<string>,text_tokens:array<bigint>,at:array<int>,chars:array<int>,links:array<int>>"
FIELDS = ["row", "main", "tokens", "parents", "times", "texts", "text_tokens", "at", "chars", "links"]


def _words(value: str) -> list[str]:
    """Words of a class or id: cut at anything but letters and digits, and where camel case turns."""
    return _parts.findall(re.sub(r"([a-z0-9])([A-Z])", r"\1 \2", value).lower())


def _dull(value: str, around: int) -> bool:
    """Whether a class or id names boilerplate: by any of its words, but inside an article only by a whole name of few."""
    return not BOILER_WORDS.isdisjoint(_words(value)) if around != MAIN else not INNER_WORDS.isdisjoint(value.lower().split())


def _opened(tag: str, name: str, around: int = PLAIN, lenient: bool = False) -> tuple[str, int]:
    """A start tag's label and the role it gives to what it holds (PLAIN: its parent's, which is ``around``); lenient: classes and ids tell nothing."""
    label, role = name, BOILER if name in BOILER_TAGS else MAIN if name in ("article", "main") else PLAIN
    if len(tag) > len(name) + 2:
        for m in _attribute.finditer(tag, len(name) + 1):
            key, value = (m[1] or m[5]).lower(), m[2] or m[3] or m[4] or ""
            if key == "class":
                label = f"{name}.{'.'.join(sorted(value.split()))}"
            if key == "role":
                role = BOILER if value.lower() in BOILER_ROLES else MAIN if value.lower() == "main" and role != BOILER else role
            elif key in ("class", "id") and not lenient and name not in ("html", "body", "main", "form") and _dull(value, around):
                role = BOILER
            elif key == "hidden" or key == "aria-hidden" and value == "true" or key == "style" and re.search(r"display\s*+:\s*none|visibility\s*+:\s*hidden", value):
                role = BOILER
    return label, role


class _Stack:
    """The open tags, with the places of each name and of those that end an implied close."""

    def __init__(self) -> None:
        self.tags: list[tuple[str, int, int, int]] = [("", 0, PLAIN, -1)]  # name, node, role, form
        self.places: dict[str, list[int]] = {}
        self.keeps = [0]

    def push(self, name: str, node: int, role: int, form: int) -> None:
        self.places.setdefault(name, []).append(len(self.tags))
        if name in KEEPS:
            self.keeps.append(len(self.tags))
        self.tags.append((name, node, role, form))

    def cut(self, k: int) -> None:
        """Closes the k-th tag and all in it."""
        while len(self.tags) > k:
            self.places[self.tags.pop()[0]].pop()
        while self.keeps[-1] >= k:
            self.keeps.pop()

    def last(self, names) -> int:
        """The innermost open tag of these names that no other kept tag shuts in, or 0."""
        k = max((self.places[n][-1] for n in names if self.places.get(n)), default=0)
        return k if k >= self.keeps[-1] else 0


def parse(page: str | None, lenient: bool = False) -> tuple[list[tuple[int, int, int]], list[tuple[str, int, int, int]]]:
    """A page's distinct tag paths (hash, parent's place, times) and its text runs outside boilerplate (text, role, path's place, characters in links).

    A form is boilerplate unless it frames the page: an article begins in it, or half of the text is its own.
    """
    import xxhash

    stack = _Stack()
    nodes, place = [[0, -1, 1]], {0: 0}
    runs: list[tuple[str, int, int, int]] = []
    run: list[str] = []
    home, links = (0, PLAIN, -1), 0
    forms: list[int] = []  # the role around each form
    within: list[int] = []  # the form of each run

    def flush() -> None:
        nonlocal links
        if run:
            text = " ".join(entities.unescape("".join(run)).split())
            if text:
                runs.append((text, home[1], home[0], min(links, len(text))))
                within.append(home[2])
            run.clear()
        links = 0

    def close(k: int) -> None:
        _, node, role, _ = stack.tags[-1]
        stack.cut(k)
        if role != BOILER and stack.tags[-1][1] != node:
            flush()

    for piece in _tag.split(_raw.sub("", page or "")):
        if not piece:
            continue
        if piece[0] != "<" or not (m := _name.match(piece)) or piece[-1] != ">":
            _, node, role, form = stack.tags[-1]
            if role != BOILER:
                if not run:
                    home = node, role, form
                run.append(piece)
                if stack.places.get("a"):
                    links += len(piece.strip())
            continue
        name = m[1].lower()
        if piece[1] == "/":
            if name in BLOCK:
                flush()
            if name in KEEPS:
                if stack.places.get(name):
                    close(stack.places[name][-1])
            elif k := stack.last((name,)):
                close(k)
            continue
        parent = stack.tags[-1]
        if name == "br":
            if parent[2] != BOILER:
                run.append(" ")
            continue
        if name in BLOCK:
            flush()
            ends = SAME.get(name, frozenset()) | ({"p"} if name in CLOSES_P else frozenset())
            if k := stack.last(ends):
                close(k)
                parent = stack.tags[-1]
        label, role = _opened(piece, name, parent[2], lenient)
        role = MAIN if name == "main" and role == MAIN else BOILER if parent[2] == BOILER or role == BOILER else MAIN if parent[2] == MAIN or role == MAIN else PLAIN
        node = parent[1]
        if name in BLOCK or role != parent[2]:  # inline tags that only dress the text leave the path as it is
            if role not in (parent[2], BOILER):
                flush()
            path = xxhash.xxh64_intdigest(label.encode("utf-8", "surrogatepass"), nodes[node][0])
            if path not in place:
                place[path] = len(nodes)
                nodes.append([path, node, 0])
            node = place[path]
            nodes[node][2] += 1
        if name not in VOID:
            form = parent[3]
            if name == "form":
                form = len(forms)
                forms.append(parent[2])
            stack.push(name, node, role, form)
    flush()
    if forms:
        own, held, total = [0] * len(forms), [False] * len(forms), sum(len(r[0]) for r in runs)
        for r, form in zip(runs, within):
            if form >= 0:
                own[form] += len(r[0])
                held[form] |= r[1] == MAIN and forms[form] != MAIN
        runs = [r for r, form in zip(runs, within) if form < 0 or held[form] or 2 * own[form] >= total]
    return [tuple(n) for n in nodes], runs


def parsed(html: Column) -> Column:
    """A page's key, and flat arrays: its paths (token, parent, times), and the text runs of its article, or of its body where it has none."""

    @F.pandas_udf(PARSED)
    def read(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        import xxhash
        from pyspark import TaskContext

        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            out = []
            for page in batch:
                nodes, runs = parse(page)
                if not runs:  # classes and ids must not empty a page
                    nodes, runs = parse(page, lenient=True)
                main = any(r[1] == MAIN for r in runs)
                runs = [r for r in runs if r[1] == (MAIN if main else PLAIN)]
                tokens = np.array([n[0] for n in nodes], "u8")
                texts = [r[0] for r in runs]
                text_tokens = [xxhash.xxh64_intdigest(r[0].encode("utf-8", "surrogatepass"), nodes[r[2]][0]) for r in runs]
                out.append((row, main, tokens.view("i8"), [n[1] for n in nodes], [n[2] for n in nodes], texts, np.array(text_tokens, "u8").view("i8"), [r[2] for r in runs], list(map(len, texts)), [r[3] for r in runs]))
                row += 1
            yield pd.DataFrame(out, columns=FIELDS)

    return read.asNondeterministic()(html)


def valid_classes(pages: DataFrame) -> DataFrame:
    """(host, is_text, token, pages): tokens of valid classes. pages: host, row, tokens, times, text_tokens, each content of a host once."""
    tags = pages.select("host", "row", F.inline(F.arrays_zip("tokens", "times"))).select("host", "row", F.lit(False).alias("is_text"), F.col("tokens").alias("token"), F.col("times").cast("long").alias("n"))
    texts = pages.select("host", "row", F.explode("text_tokens").alias("token")).groupBy("host", "row", "token").agg(F.count(F.lit(1)).alias("n"))
    tokens = texts.select("host", "row", F.lit(True).alias("is_text"), "token", "n").unionByName(tags)
    # a token's vector over the host's pages, by its length and a sum of hashes that fits a long
    part = F.shiftrightunsigned(F.xxhash64("row", "n"), 24)
    vectors = tokens.groupBy("host", "is_text", "token").agg(F.count(F.lit(1)).alias("pages"), F.sum("n").alias("times"), F.sum(part).alias("vector")).filter(F.col("pages") >= MIN_PAGES)
    sizes = pages.groupBy("host").agg(F.count(F.lit(1)).alias("host_pages")).filter(F.col("host_pages") >= MIN_PAGES)
    frequent = saved(vectors.join(sizes, "host").filter(F.col("pages") >= MIN_SHARE * F.col("host_pages")), "frequent-tokens")
    classes = frequent.groupBy("host", "pages", "times", "vector").agg(F.count(F.lit(1)).alias("tokens")).filter(F.col("tokens") >= MIN_TOKENS)
    return saved(frequent.join(classes, ["host", "pages", "times", "vector"]).select("host", "is_text", "token", "pages"), "valid-classes")


TEMPLATE = ["tag_tokens", "tag_pages", "fixed_tokens", "fixed_pages"]


def host_templates(valid: DataFrame) -> DataFrame:
    """One row for each host: its template's tags and texts with the pages they stand in."""
    lists = valid.groupBy("host").agg(*[F.collect_list(F.when(F.col("is_text") == kind, F.struct("token", "pages"))).alias(k) for k, kind in (("tags", False), ("fixed", True))])
    return lists.select("host", *[F.col(f"{x}.{field}").alias(name) for name, x, field in zip(TEMPLATE, ("tags", "tags", "fixed", "fixed"), ("token", "pages") * 2)])


def slots_of(tokens, parents, at, text_tokens, tag_tokens, tag_pages, fixed_tokens, fixed_pages) -> tuple[list[int], list[bool]]:
    """For each text run of a page its slot (0: of no template tag), and whether it is the template's own text."""
    tags, fixed = dict(zip(tag_tokens.tolist(), tag_pages.tolist())), dict(zip(fixed_tokens.tolist(), fixed_pages.tolist()))
    slot, about = [0] * len(tokens), [0] * len(tokens)
    for i, (token, parent) in enumerate(zip(tokens.tolist(), parents.tolist())):
        own = tags.get(token, 0)
        slot[i] = token if own else slot[parent] if parent >= 0 else 0
        about[i] = max(own, about[parent] if parent >= 0 else 0)
    at = at.tolist()
    return [slot[k] for k in at], [t in fixed and about[k] >= fixed[t] for t, k in zip(text_tokens.tolist(), at)]


def dull_slots(pages: DataFrame, templates: DataFrame) -> DataFrame:
    """(host, dull): the slots of each host that hold links or repeat themselves. pages as for valid_classes, with parents, at, chars, links and main; templates with n, the host's rows."""

    @F.pandas_udf("struct<slot:array<bigint>,fixed:array<boolean>>")
    def place(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.DataFrame]:
        for columns in batches:
            yield pd.DataFrame([slots_of(*row) for row in zip(*columns)], columns=["slot", "fixed"])

    met = join_counted(pages, templates, ["host"])
    met = met.select("host", "main", "text_tokens", "chars", "links", place("tokens", "parents", "at", "text_tokens", *TEMPLATE).alias("p"))
    runs = met.select("host", "main", F.inline(F.arrays_zip(F.col("p.slot").alias("slot"), F.col("p.fixed").alias("fixed"), "text_tokens", "chars", "links"))).filter("not fixed")
    texts = runs.groupBy("host", "slot", "text_tokens").agg(F.count(F.lit(1)).alias("n"), F.sum("chars").alias("chars"), F.sum("links").alias("links"), F.bool_or("main").alias("main"))
    slots = texts.groupBy("host", "slot").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("texts"), F.sum("chars").alias("chars"), F.sum("links").alias("links"), F.bool_or("main").alias("main"))
    slots = slots.withColumn("all_chars", F.sum("chars").over(Window.partitionBy("host")))  # a host has few slots
    linked, repeated = 2 * F.col("links") >= F.col("chars"), ~F.col("main") & (F.col("n") >= MIN_PAGES) & (F.col("n") >= REPEATS * F.col("texts"))
    return slots.filter((linked | repeated) & (2 * F.col("chars") < F.col("all_chars")) & (F.col("slot") != 0)).groupBy("host").agg(F.collect_list("slot").alias("dull"))


def article(texts, main: bool, slots: list[int], fixed: list[bool], dull: set[int]) -> str:
    """A page's main text from its runs."""
    kept = [t for t, s, f in zip(texts, slots, fixed) if not f and s not in dull]
    if not kept or main and 2 * sum(map(len, kept)) < sum(map(len, texts)):
        kept = texts
    return "\n".join(kept)


def main_text(pages: DataFrame) -> DataFrame:
    """pages (url, html, ...) with ``text``, the main text of each row."""
    plain = pages.drop("text")
    host = F.coalesce(F.lower(F.regexp_extract("url", r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1)), F.lit(""))
    keep = [c for c in plain.columns if c != "html"]
    content = F.unhex(F.md5(F.encode(F.coalesce("html", F.lit("")), "utf-8")))
    own = F.struct(*[F.col(f"`{c}`") for c in keep]) if keep else F.struct(F.lit(0))
    read = saved(plain.select(own.alias("own"), host.alias("host"), content.alias("content"), parsed(F.col("html")).alias("p")), "parsed-pages")
    once = read.select("host", "content", *[f"p.{f}" for f in FIELDS if f != "texts"])
    firsts = saved(once.groupBy("host", "content").agg(F.min("row").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1"), "copied-pages")
    if not firsts.isEmpty():
        copies = saved(join_counted(once.select("host", "content", "row"), firsts, ["host", "content"]).filter("row != first").select("row"), "copies")
        once = saved(once.join(copies, "row", "left_anti"), "distinct-pages")
    templates = host_templates(valid_classes(once.select("host", "row", "tokens", "times", "text_tokens")))
    rows = read.groupBy("host").agg(F.count(F.lit(1)).alias("n"))
    templates = saved(templates.join(rows, "host"), "templates")
    templates = saved(templates.join(dull_slots(once, templates), "host", "left"), "templates-and-slots")

    @F.pandas_udf("string")
    def told(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        for columns in batches:
            out = []
            for texts, main, *page, dull in zip(*columns):
                if page[-1] is None:  # no template
                    out.append("\n".join(texts))
                else:
                    out.append(article(texts, main, *slots_of(*page), set() if dull is None else set(dull.tolist())))
            yield pd.Series(out)

    whole = join_counted(read, templates, ["host"], "left")
    arguments = ["p.texts", "p.main", "p.tokens", "p.parents", "p.at", "p.text_tokens", *TEMPLATE, "dull"]
    return whole.select("own", told(*map(F.col, arguments)).alias("text")).select(*[F.col(f"own.`{c}`") for c in keep], "text")


def op10_template_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    found = main_text(table(spark, sf_dir, "pages"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


QUERIES = {"op10_template_slots": op10_template_slots}
SQL: dict[str, str] = {}
