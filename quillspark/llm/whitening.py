"""Whitened embeddings by hierarchical merging of singular value decompositions.

Entries become whole numbers, ``x = floor(256 * c)``. The fit rests on the distinct x
vectors, each once. A task turns each lot of its vectors into a summary: how many there
are, their exact sums, and all singular values and right vectors of the lot less its
mean. Two summaries merge without loss: the rows ``s * v`` of both, and one more row,
``sqrt(a * b / (a + b))`` times the difference of the means, have together the scatter
of the union about its own mean, and are decomposed anew, all dimensions kept. Tasks
merge what they read; their summaries meet ``FAN`` at a time, by Spark, until there is
one, so no task sees more than that many summaries of a dimension times itself.

Components are the right vectors by falling singular value, with the sign by which
their largest entry is positive. ``whitened`` is the projection of ``x - S / n`` over
the root of the eigenvalue; its covariance over the fit is then measured, by Spark, and
its largest distance from the identity is ``identity_error``.

Defined cases: a null vector, one with a null or non-finite entry and an empty one have
no rows; other lengths than the usual one are a fit of their own; where a vector has
fewer dimensions than components, there are as many as dimensions; a component without
variance (such as all of a single distinct vector) has a null ``whitened``, and
``explained`` 0, or null where nothing varies at all; repeated vectors count once in the
fit and each get their rows; a null vec_id is an id like any other; an entry beyond a
long is held at its end, and a deviation beyond a long is null; an empty table gives no
rows; columns of the input may have any name, those named like an added one are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import join_counted, packed, saved, table

SCALE = 256
COMPONENTS = 4
#: Summaries that one task merges.
FAN = 8
#: Vectors that are decomposed together.
LOT = 4096

SUMMARY = "dim int, at long, n long, sums array<long>, spread array<double>, axes array<double>"
FIT = "dim int, n long, sums array<long>, axes array<double>, roots array<double>, explained array<double>"


class Summary:
    """Number, sums, singular values and right vectors of some vectors of whole numbers, less their mean."""

    def __init__(self, n: int, sums: np.ndarray, spread: np.ndarray, axes: np.ndarray):
        self.n, self.sums, self.spread, self.axes = n, sums, spread, axes

    @classmethod
    def of(cls, x: np.ndarray) -> Summary:
        sums = x.sum(0)
        _, spread, axes = np.linalg.svd(x - sums / len(x), full_matrices=False)
        return cls(len(x), sums, spread, axes)

    def merged(self, other: Summary) -> Summary:
        n = self.n + other.n
        between = np.sqrt(self.n * other.n / n) * (self.sums / self.n - other.sums / other.n)
        _, spread, axes = np.linalg.svd(np.vstack([self.spread[:, None] * self.axes, other.spread[:, None] * other.axes, between]), full_matrices=False)
        return Summary(n, self.sums + other.sums, spread, axes)

    def row(self, dim: int, at: int) -> tuple:
        return dim, at, self.n, self.sums, self.spread, self.axes.ravel()


def _read(r) -> Summary:
    return Summary(int(r.n), np.asarray(r.sums), np.asarray(r.spread), np.asarray(r.axes).reshape(-1, r.dim))


def _merged(parts: list[Summary]) -> Summary:
    """One summary of all, merged two by two."""
    while len(parts) > 1:
        parts = [a.merged(b) for a, b in zip(parts[::2], parts[1::2])] + parts[len(parts) & ~1 :]
    return parts[0]


def _summaries(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One summary of each dimension of a task's vectors."""
    from pyspark import TaskContext

    at = TaskContext.get().partitionId()
    found: dict[int, Summary] = {}
    waiting: dict[int, list] = {}

    def take(dim: int) -> None:
        own = Summary.of(np.stack(waiting.pop(dim)))
        found[dim] = found[dim].merged(own) if dim in found else own

    for batch in batches:
        for x in batch["x"]:
            own = waiting.setdefault(len(x), [])
            own.append(x)
            if len(own) == LOT:
                take(len(x))
    for dim in list(waiting):
        take(dim)
    for dim, own in found.items():
        yield pd.DataFrame([own.row(dim, at)], columns=["dim", "at", "n", "sums", "spread", "axes"])


def _together(rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values("at")
    one = _merged([_read(r) for r in rows.itertuples()])
    return pd.DataFrame([one.row(int(rows["dim"].iloc[0]), int(rows["at"].iloc[0]) // FAN)], columns=["dim", "at", "n", "sums", "spread", "axes"])


def summaries(fit: DataFrame) -> DataFrame:
    """One summary for each length of the vectors (x)."""
    now = saved(fit.select("x").mapInPandas(_summaries, SUMMARY), "summaries")
    while now.groupBy("dim").count().filter("count > 1").limit(1).count():
        now = saved(now.groupBy("dim", F.floor(F.col("at") / FAN).alias("group")).applyInPandas(_together, SUMMARY), "merged")
    return now


def _fit_of(k: int):
    """The first k components of each summary."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for r in batch.itertuples():
                own, most = _read(r), min(k, r.dim)
                spread = np.zeros(most)
                spread[: len(own.spread)] = own.spread[:most]
                axes = np.zeros((most, r.dim))
                axes[: len(own.axes)] = own.axes[:most]
                axes *= np.where(np.take_along_axis(axes, np.abs(axes).argmax(1)[:, None], 1) < 0, -1.0, 1.0)
                total = (own.spread**2).sum()
                none = spread <= spread[0] * max(own.n, r.dim) * np.finfo(float).eps
                spread[none] = 0
                rows.append((r.dim, own.n, own.sums, axes.ravel(), spread / np.sqrt(own.n), spread**2 / total if total > 0 else np.full(most, np.nan)))
            yield pd.DataFrame(rows, columns=["dim", "n", "sums", "axes", "roots", "explained"])

    return run


def deviations(x: np.ndarray, n: int, sums: np.ndarray) -> list[int | None]:
    """The sum of (n * x - S)**2 of each row of x, exactly; none where it is beyond a long."""
    most = n * int(np.abs(x).max(initial=0)) + int(np.abs(sums).max(initial=0))
    if most**2 * x.shape[1] < 1 << 63:
        return ((n * x - sums) ** 2).sum(1).tolist()
    exact = ((n * x.astype(object) - sums.astype(object)) ** 2).sum(1)
    return [v if v < 1 << 63 else None for v in exact.tolist()]


def _whitened(x: pd.Series, n: pd.Series, sums: pd.Series, axes: pd.Series, roots: pd.Series) -> pd.DataFrame:
    lengths = x.map(len).to_numpy()
    deviation, whitened = np.full(len(x), None, object), np.full(len(x), None, object)
    for dim in np.unique(lengths):
        at = np.flatnonzero(lengths == dim)
        first, own = at[0], np.stack(x.iloc[at].to_list())
        total, root = sums.iloc[first], roots.iloc[first]
        deviation[at] = deviations(own, int(n.iloc[first]), total)
        with np.errstate(divide="ignore", invalid="ignore"):
            values = (own - total / n.iloc[first]) @ axes.iloc[first].reshape(-1, dim).T / root
        for i, row in zip(at, values):
            whitened[i] = [float(v) if r > 0 else None for v, r in zip(row, root)]
    return pd.DataFrame({"deviation": pd.array(deviation.tolist(), "Int64"), "whitened": whitened})


def whiten(vectors: DataFrame, column: str = "embedding", k: int = COMPONENTS) -> DataFrame:
    """Rows of vectors with a usable vector, once for each component up to k: component, n, deviation, whitened, explained, identity_error."""
    added = ("component", "n", "deviation", "whitened", "explained", "identity_error")
    plain = vectors.drop(*[c for c in vectors.columns if c.lower() in added and c != column])
    entry = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))
    usable = packed(plain).select("row", F.col("row")[column].cast("array<double>").alias("c")).filter(F.col("c").isNotNull() & (F.size("c") > 0)).filter(F.forall("c", entry))
    rows = usable.select("row", F.transform("c", lambda c: F.floor(c * SCALE)).alias("x"))
    fit = saved(rows.select("x").distinct(), "distinct-vectors")
    found = summaries(fit).select("dim", "n", "sums", "spread", "axes").withColumn("at", F.lit(0).cast("long")).mapInPandas(_fit_of(k), FIT)
    found = saved(found, "components")

    whitened = F.pandas_udf(_whitened, "struct<deviation:long,whitened:array<double>>")

    # the covariance of what is whitened, over the fit; sizes say how many rows meet each length's facts
    met = lambda df, times: join_counted(df.withColumn("dim", F.size("x")), found.join(times, "dim"), ["dim"], n="times").withColumn("own", whitened("x", "n", "sums", "axes", "roots"))
    sizes = lambda df: df.groupBy(F.size("x").alias("dim")).agg(F.count(F.lit(1)).alias("times"))
    ws = [F.get("own.whitened", i) for i in range(k)]
    covariance = [F.abs(F.covar_pop(ws[i], ws[j]) - (1.0 if i == j else 0.0)) for i in range(k) for j in range(i, k)]
    errors = met(fit, sizes(fit)).groupBy("dim").agg(F.array_max(F.array(*covariance)).alias("identity_error"))
    found = saved(found.join(errors, "dim"), "fit")

    each = F.explode(F.transform(F.arrays_zip(F.col("own.whitened").alias("whitened"), F.col("explained").alias("explained")), lambda z, i: F.struct((i + 1).alias("component"), z["whitened"].alias("whitened"), F.nanvl(z["explained"], F.lit(None)).alias("explained")))).alias("one")
    out = met(rows, sizes(rows)).select("row", "n", "own.deviation", "identity_error", each)
    return out.select("row.*", "one.component", "n", "deviation", "one.whitened", "one.explained", "identity_error")


def op12_whitened(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first four whitened components of every usable embedding."""
    return whiten(table(spark, sf_dir, "embeddings").select("vec_id", "embedding")).drop("embedding")


QUERIES = {"op12_whitened": op12_whitened}
SQL: dict[str, str] = {}
