"""Text functions as columns: white space, words and keys.

White space and word characters are classes written out, so that Spark, DuckDB
and Python agree on them; no function here leaves the JVM.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space, as Python's str.strip() and split() have it.
WS = r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
#: The same without its brackets, for use inside another class.
WS_IN = WS[1:-1]
#: A word character.
WORD = r"[\p{L}\p{N}_]"

# The default dictionary of keywords.
TERMS = (
    "corn soybean wheat nitrogen phosphorus potassium herbicide pesticide insect disease weed crop soil water yield plant seed hybrid variety "
    "fertilizer management control pest tillage planting harvest acre field farmer growing season"
).split()


def strip(text: Column) -> Column:
    """Without white space at either end; only a text that has some there is searched."""
    ends = F.concat(F.left(text, F.lit(1)), F.right(text, F.lit(1)))
    return F.when(ends.rlike(WS), F.regexp_replace(text, rf"^{WS}+|(?<!{WS}){WS}+\z", "")).otherwise(text)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body of a value that is worked out once, however often body names it."""
    return F.get(F.transform(F.array(value), body), 0)


def prefix_sums(numbers: Column) -> Column:
    """For each number the sum up to it: sums of blocks first, then within a block, so no array grows as it is made."""
    add = lambda a, n: a + n
    zero = F.lit(0).cast("long")

    def by_block(s: Column) -> Column:
        sums = F.transform(s["blocks"], lambda b: F.aggregate(b, zero, add))
        return let(F.struct(s["blocks"].alias("blocks"), sums.alias("sums")), lambda t: F.flatten(F.transform(t["blocks"], lambda b, i: let(F.aggregate(F.slice(t["sums"], F.lit(1), i), zero, add), lambda before: F.transform(b, lambda x, k: before + F.aggregate(F.slice(b, F.lit(1), k + 1), zero, add))))))

    def blocks(s: Column) -> Column:
        width = F.greatest(F.lit(1), F.ceil(F.sqrt(F.size(s))).cast("int"))
        firsts = F.sequence(F.lit(1), F.greatest(F.size(s), F.lit(1)), width)
        return F.struct(F.transform(firsts, lambda k: F.slice(s, k, width)).alias("blocks"))

    return let(numbers, lambda s: let(blocks(s), by_block))


def split_words(text: Column) -> Column:
    """The words between white space."""
    return F.filter(F.split(text, f"{WS}+", -1), lambda w: w != "")


def count_sentences(text: Column) -> Column:
    """Full stops, exclamation and question marks; one at least."""
    return F.greatest(F.lit(1), F.length(text) - F.length(F.translate(text, ".!?", "")))


def normalize_question(text: Column) -> Column:
    """Lower case, word characters only, single spaces: the key of duplicates within a batch."""
    bare = F.regexp_replace(F.lower(text), rf"[^\p{{L}}\p{{N}}_{WS_IN}]", "")
    return strip(F.regexp_replace(bare, f"{WS}+", " "))


def merge_key(text: Column) -> Column:
    """Lower case, stripped, letters, digits and white space only: the key of duplicates across batches."""
    return F.regexp_replace(strip(F.lower(text)), rf"[^\p{{L}}\p{{N}}{WS_IN}]", "")


def significant_words(text: Column) -> Column:
    """Distinct lower-case words of five characters or more."""
    return F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(rf"{WORD}{{5,}}"), F.lit(0)))


def estimated_tokens(text: Column) -> Column:
    """1.3 tokens a word, cut to a whole number."""
    return F.floor(F.size(split_words(text)) * F.lit(1.3)).cast("int")


def title_case(text: Column) -> Column:
    """A capital at the start of each run of letters, lower case after it."""
    runs = F.regexp_extract_all(text, F.lit(r"\p{L}+|[^\p{L}]+"), F.lit(0))
    return F.array_join(F.transform(runs, F.initcap), "")


def extract_topic(text: Column, doc: Column) -> Column:
    """The first title-like line among the first 200 characters, else a title made of the document's name."""
    lines = F.transform(F.split(F.left(text, F.lit(200)), "\n", -1), strip)
    fits = F.filter(lines, lambda s: (F.length(s) > 10) & (F.length(s) < 80) & F.left(s, F.lit(1)).rlike(r"^\p{Lu}"))
    name = F.regexp_replace(F.translate(doc, "_-", "  "), r"\p{Nd}{4}web", "")
    return F.coalesce(F.get(fits, 0), title_case(F.regexp_replace(name, r"chapter\p{Nd}+", "Agricultural Chapter")))


def extract_keywords(text: Column, terms: list[str] | None = None, top_k: int = 10) -> Column:
    """The dictionary's most frequent terms in the text, ties by first appearance.

    Only lower-case ASCII words of four letters or more can be terms.
    """
    terms = sorted(t for t in set(TERMS if terms is None else terms) if len(t) >= 4 and t.isascii() and t.isalpha() and t.islower())
    if not terms:
        return F.expr("cast(array() as array<string>)")
    words = F.filter(F.regexp_extract_all(F.lower(text), F.lit(rf"{WORD}+"), F.lit(0)), lambda w: w.isin(terms))
    counted = F.transform(F.array_distinct(words), lambda t: F.struct((-F.size(F.filter(words, lambda w: w == t))).alias("n"), F.array_position(words, t).alias("at"), t.alias("term")))
    return F.transform(F.slice(F.array_sort(counted), 1, top_k), lambda k: k["term"])


def preview(text: Column, size: int) -> Column:
    """The text's start, with dots where it goes on."""
    return F.concat(F.substring(text, 1, size), F.when(F.length(text) > size, F.lit("...")).otherwise(""))


def stamp() -> Column:
    """Now, in UTC, as ISO text; never part of compared output."""
    return F.date_format(F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'Z'")
