"""Secret scanning with a random forest that removes false positives.

Candidates are runs of ``[A-Za-z0-9+/_-]`` in whole texts: of 8 characters or more
with a letter and a digit, of 12 digits or more, of 20 or more without a digit.
Each has features of the value (length, classes of characters and the transitions
between them, distinct characters, how much of it dictionary words cover), of its
neighbouring words (their length, how much dictionary words cover them, words that go
with checksums) and of its path. A random forest fitted on labelled findings scores
them; a candidate that scores under ``KEEP`` is a false positive.

All of it is DataFrame functions and Spark's own forest; no Python runs on the
executors. Findings that come without labels may be labelled by ``label_by_context``,
which looks at nothing that is a feature: what is assigned to a secret's name is a
secret, what is part of an e-mail address or a plain word of a sentence is not, all
else is unknown. The assignment itself is taken off before neighbours become
features, so the forest learns what secrets look like instead of the rule, and finds
those that no rule names.

The forest is fitted on at most ``MOST_LABELLED`` distinct labelled findings, of each
label those whose hash is least; everything else covers all rows.

Defined cases: a null or empty text has no candidates; a null path is empty; a long
text is read once, its candidates are numbered by a window over their own rows;
repeated rows yield their findings each; findings alike in all features and label
count once in the fit; without labelled findings of both kinds no forest is fitted,
scores are null and only what the context calls a secret is kept; an empty table gives
no rows; only (doc_id, source, text) are read, whatever other columns are called.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import least_hashes, saved, table, text_of

MOST_LABELLED = 20_000
KEEP = 0.5
TREES, DEPTH, SEED = 20, 6, 11
CONTEXT = 40

#: A candidate; it begins where its run begins.
CANDIDATE = r"(?<![A-Za-z0-9+/_-])(?:(?=[A-Za-z+/_-]*[0-9])(?=[0-9+/_-]*[A-Za-z])[A-Za-z0-9+/_-]{8,}|[0-9]{12,}|[A-Za-z+/_-]{20,})={0,2}"
#: A text without this has no candidate.
MAY_HOLD = r"[0-9]|[A-Za-z+/_-]{20}"
# Names that secrets are assigned to, providers' prefixes, and words that placeholders and plain text are made of.
NAMES = r"(?i)(passw(or)?d|passwd|pwd|secret|token|api[_-]?key|access[_-]?key|private[_-]?key|credential|auth)[A-Za-z_-]{0,12}[\"']?\s*[=:]\s*[\"']?$"
PREFIX = r"^(AKIA[0-9A-Z]{16}|ASIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{20,}|xox[abprs]-[A-Za-z0-9-]{10,}|sk_live_[A-Za-z0-9]{16,}|AIza[A-Za-z0-9_-]{30,}|glpat-[A-Za-z0-9_-]{16,})$"
DICTIONARY = (
    "access account admin android apple article author backup blog book build cache changeme city class client cloud code color config content country data date default demo desktop device docs domain dummy email error event example export facebook false file first foo font form free game google group guide header height help home host hotel house html http icon image index info input item java june label language last layout level license link linux list local login logo mail main media menu message mobile model module month music name network news note null object online option order package page panel part password path phone photo pixel placeholder place plan play plugin point post price print product profile project public query release report review sample school script search section secret server service session shop site size sport start state status store style summer super system table tag team temp test text theme thumb time title token tool top travel true type update upload user value version video view virtual web week width windows wireless word work world your"
).split()

#: Neighbouring words that go with checksums and identifiers.
CHECKSUM = r"(?i)\b(commit|sha\d*|md5|checksum|digest|hash|etag|revision|uuid|guid|integrity)\b"

FEATURES = ("n_chars", "letters", "digits", "uppers", "others", "transitions", "distinct", "longest_digits", "hex", "coverage", "before_chars", "before_coverage", "after_chars", "after_coverage", "checksum", "path_parts", "test_path")


def candidates(docs: DataFrame) -> DataFrame:
    """One row for each candidate of (doc_id, source, text): doc_id, path, start, end, value, before, after."""
    text = text_of()
    found = F.when(text.rlike(MAY_HOLD), F.regexp_extract_all(text, F.lit(CANDIDATE), F.lit(0)))
    with_any = docs.select("doc_id", F.coalesce(F.col("source").cast("string"), F.lit("")).alias("path"), "text", found.alias("values")).filter(F.size("values") > 0)
    parts = with_any.select(F.monotonically_increasing_id().alias("row"), "doc_id", "path", "values", F.split(text, CANDIDATE, -1).alias("gaps"))
    listed = F.transform("values", lambda v, i: F.struct(v.alias("value"), F.length(F.get("gaps", i)).alias("gap"), F.right(F.get("gaps", i), F.lit(CONTEXT)).alias("before"), F.left(F.get("gaps", i + 1), F.lit(CONTEXT)).alias("after")))
    rows = parts.select("row", "doc_id", "path", F.posexplode(listed).alias("at", "c")).select("row", "doc_id", "path", "at", "c.*")
    end = F.sum(F.col("gap") + F.length("value")).over(Window.partitionBy("row").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)).cast("int")
    return rows.withColumn("end", end).select("doc_id", "path", (F.col("end") - F.length("value")).alias("start"), "end", "value", "before", "after")


def _count(value: Column, pattern: str) -> Column:
    return F.regexp_count(value, F.lit(pattern)).cast("double")


def _coverage(text: Column) -> Column:
    """How much of a text dictionary words cover; 0 of an empty one."""
    left = F.length(F.regexp_replace(F.lower(text), "|".join(sorted(DICTIONARY, key=lambda w: (-len(w), w))), ""))
    return F.when(text == "", 0.0).otherwise(1 - left / F.greatest(F.length(text), F.lit(1)))


def featured(found: DataFrame) -> DataFrame:
    """Adds the features, all doubles."""
    value, path = F.col("value"), F.col("path")
    size = F.length(value).cast("double")
    runs = F.transform(F.split(value, "[^0-9]+"), lambda r: F.length(r))
    # the words beside it, without an assignment to a secret's name
    before = F.regexp_extract(F.regexp_replace("before", NAMES, ""), r"([^\s\"'=:]+)[\s\"'=:]*$", 1)
    after = F.regexp_extract("after", r"^[\s\"',;]*([^\s\"',;]+)", 1)
    return found.withColumns(
        {
            "n_chars": size,
            "letters": _count(value, "[A-Za-z]") / size,
            "digits": _count(value, "[0-9]") / size,
            "uppers": _count(value, "[A-Z]") / size,
            "others": _count(value, "[^A-Za-z0-9]") / size,
            "transitions": _count(value, "(?<=[a-z])(?=[^a-z])|(?<=[A-Z])(?=[^A-Z])|(?<=[0-9])(?=[^0-9])|(?<=[+/_-])(?=[A-Za-z0-9])") / size,
            "distinct": F.size(F.array_distinct(F.split(value, ""))) / size,
            "longest_digits": F.array_max(runs).cast("double"),
            "hex": value.rlike("^[0-9a-f]+$|^[0-9A-F]+$").cast("double"),
            "coverage": _coverage(value),
            "before_chars": F.length(before).cast("double"),
            "before_coverage": _coverage(before),
            "after_chars": F.length(after).cast("double"),
            "after_coverage": _coverage(after),
            "checksum": (F.col("before").rlike(CHECKSUM) | F.col("after").rlike(CHECKSUM)).cast("double"),
            "path_parts": F.size(F.split(path, "[/\\\\]")).cast("double"),
            "test_path": F.lower(path).rlike("test|example|sample|fixture|mock|doc|demo").cast("double"),
        }
    )


def label_by_context(found: DataFrame) -> DataFrame:
    """Adds ``label`` by what stands beside a finding: 1 for a secret, 0 for a false positive, null where that does not tell."""
    before, after = F.col("before"), F.col("after")
    secret = before.rlike(NAMES) | F.col("value").rlike(PREFIX)
    mail = before.rlike("@[A-Za-z0-9.-]*$") | after.rlike("^[A-Za-z0-9._%+-]*@")
    prose = before.rlike(r"(^|\p{L}[,.]?)\s+$") & after.rlike(r"^[,.]?(\s+\p{L}|\s*$)")
    return found.withColumn("label", F.when(secret, 1.0).when(mail | prose, 0.0))


def fit(labelled: DataFrame) -> PipelineModel | None:
    """The forest, from distinct featured findings with a label; None unless both labels occur."""
    known = labelled.filter("label is not null").withColumn("_h", F.xxhash64("value", "before", "after", "path"))
    known = known.groupBy("label", "_h").agg(F.min(F.struct(*FEATURES)).alias("_f"))
    counts = {r.label: r.n for r in known.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(counts) < 2:
        return None
    # each label has half of the sample, and what the other leaves
    parts = [least_hashes(known.filter(F.col("label") == k), "_h", max(MOST_LABELLED // 2, MOST_LABELLED - sum(counts.values()) + n), n=n) for k, n in sorted(counts.items())]
    sample = saved(reduce(DataFrame.unionByName, parts).select("_f.*", "label"), "labelled-sample")
    vectors = VectorAssembler(inputCols=list(FEATURES), outputCol="features")
    forest = RandomForestClassifier(featuresCol="features", labelCol="label", numTrees=TREES, maxDepth=DEPTH, seed=SEED)
    return PipelineModel([vectors, forest.fit(vectors.transform(sample))])


def scored(found: DataFrame, model: PipelineModel | None) -> DataFrame:
    """Adds ``score``, the forest's probability of a secret, and ``is_secret``."""
    if model is None:
        return found.withColumn("score", F.lit(None).cast("double")).withColumn("is_secret", F.coalesce(F.col("label") == 1.0, F.lit(False)))
    out = model.transform(found).withColumn("score", F.element_at(vector_to_array("probability"), 2))
    return out.withColumn("is_secret", F.col("score") >= KEEP).drop("features", "rawPrediction", "probability", "prediction")


def scan_secrets(docs: DataFrame, labelled: DataFrame | None = None) -> DataFrame:
    """Every candidate of docs (doc_id, path, start, end, value, score, is_secret).

    ``labelled`` holds findings (path, value, before, after, label); without it the
    candidates that their context labels are used.
    """
    found = saved(label_by_context(featured(candidates(docs))), "findings")
    model = fit(found if labelled is None else featured(labelled))
    return scored(found, model).select("doc_id", "path", "start", "end", "value", "score", "is_secret")


def op9_secret_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every candidate in the documents, with its score and verdict."""
    found = scan_secrets(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.col("start").cast("long").alias("start"), F.col("end").cast("long").alias("end"), "value", F.round("score", 6).alias("score"), "is_secret")


QUERIES = {"op9_secret_forest": op9_secret_forest}
SQL: dict[str, str] = {}
