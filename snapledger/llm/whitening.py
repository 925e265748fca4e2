"""Whitening of vectors by the covariance of their different values.

Equal vectors are one vector with a multiplicity. Sums and centred products are
taken in every task over that list, weighted by multiplicity or by one, and
added up by Spark; only a matrix as wide as a vector reaches the driver. Every
different vector is whitened once and joined back to its rows.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from decimal import Decimal
from fractions import Fraction
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from snapledger.llm.vectors import floored, lengths, matrix
from snapledger.session import stage

_HOT_SHARE = 200  # a vector of at least a 200th of all rows is hot, so at most 200 are


@dataclass(frozen=True)
class Fit:
    """What whitening needs of one length of vector: exact sums and the leading components."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float

    @property
    def base(self) -> np.ndarray:
        return np.array([s // self.n for s in self.sums], np.int64)

    @property
    def rest(self) -> np.ndarray:
        """The mean less its whole part."""
        return np.array([float(Fraction(s % self.n, self.n)) for s in self.sums])

    @property
    def scaling(self) -> np.ndarray:
        """Components over the root of their eigenvalue; a component without variance has no such scaling."""
        varied = self.values > self.trace * len(self.sums) * np.finfo(float).eps
        with np.errstate(divide="ignore", invalid="ignore"):
            return self.vectors * np.where(varied, 1 / np.sqrt(np.maximum(self.values, 0)), np.nan)


def _whole_sums(batches):
    """Exact weighted sums of whole numbers, one row a dimension and task."""
    total: list[int] = []
    for batch in batches:
        m, w = matrix(batch.column("x")), batch.column("weight").to_numpy()
        if not len(m):
            continue
        if float(np.abs(m).max()) * float(w.sum()) >= 2.0**62:
            m, w = m.astype(object), w.astype(object)
        part = [int(s) for s in w @ m]
        total = [a + b for a, b in zip(total, part)] if total else part
    yield pa.RecordBatch.from_arrays(
        [pa.array(range(len(total)), pa.int32()), pa.array([Decimal(s) for s in total], pa.decimal128(38, 0))],
        ["i", "s"],
    )


def _products(centred):
    """Weighted products of centred vectors, one row a dimension and task."""

    def run(batches):
        total = None
        for batch in batches:
            z = centred(batch)
            if len(z):
                part = (z * batch.column("weight").to_numpy()[:, None]).T @ z
                total = part if total is None else total + part
        rows = [] if total is None else list(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(len(rows)), pa.int32()), pa.array(rows, pa.list_(pa.float64()))], ["i", "row"]
        )

    return run


def _covariance(weighted: DataFrame, centred, n: int) -> np.ndarray:
    rows = (
        weighted.mapInArrow(_products(centred), "i int, row array<double>")
        .select("i", F.posexplode("row").alias("j", "g"))
        .groupBy("i", "j")
        .agg(F.sum("g").alias("g"))
        .groupBy("i")
        .agg(F.sort_array(F.collect_list(F.struct("j", "g")))["g"].alias("row"))
        .orderBy("i")
        .collect()
    )
    return np.array([r.row for r in rows]) / n


def fit(distinct: DataFrame, components: int) -> Fit:
    """The fit of a table ``x, weight`` of different vectors of one length."""
    n = int(distinct.agg(F.sum("weight")).first()[0])
    sums = [
        int(r.s)
        for r in distinct.mapInArrow(_whole_sums, "i int, s decimal(38,0)")
        .groupBy("i").agg(F.sum("s").alias("s")).orderBy("i").collect()
    ]
    own = Fit(n, sums, np.zeros(0), np.zeros((0, 0)), 0.0)
    base, rest = own.base, own.rest
    v = _covariance(distinct, lambda batch: (matrix(batch.column("x")) - base) - rest, n)
    values, vectors = np.linalg.eigh((v + v.T) / 2)
    order = np.argsort(-values, kind="stable")[:components]
    values, vectors = values[order], vectors[:, order]
    # The sign is free; the greatest entry is made positive.
    vectors = vectors * np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(len(order))])
    return Fit(n, sums, values, vectors, float(np.trace(v)))


def _whiten(model: Fit):
    base, rest, scaling, n = model.base, model.rest, model.scaling, model.n
    off = [s - n * int(b) for s, b in zip(model.sums, base)]

    def run(batches):
        for batch in batches:
            x = matrix(batch.column("x"))
            gap = x - base if len(x) else x
            z = (gap - rest) @ scaling if len(x) else np.zeros((0, scaling.shape[1]))
            if len(x) and (n * (float(np.abs(gap).max()) + 1)) ** 2 * gap.shape[1] >= 2.0**63:
                wide = ((gap.astype(object) * n - off) ** 2).sum(axis=1)
                deviation = [int(d) if d < 2**63 else None for d in wide]
            else:
                deviation = ((gap * n - np.array(off, np.int64)) ** 2).sum(axis=1) if len(x) else []
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("x"),
                    batch.column("copies"),
                    batch.column("weight"),
                    pa.array(list(z), pa.list_(pa.float64())),
                    pa.array(deviation, pa.int64()),
                ],
                ["x", "copies", "weight", "z", "deviation"],
            )

    return run


def _identity_error(whitened: DataFrame, model: Fit) -> float | None:
    """How far the covariance of the whitened list is from the identity, over components with variance."""
    varied = np.flatnonzero(~np.isnan(model.scaling).any(axis=0))
    if not len(varied):
        return None
    sums = (
        whitened.select(F.posexplode("z").alias("i", "z"), "weight")
        .groupBy("i").agg(F.sum(F.col("z") * F.col("weight")).alias("s")).orderBy("i").collect()
    )
    mean = np.array([r.s for r in sums])[varied] / model.n
    cov = _covariance(whitened, lambda b: matrix(b.column("z"), np.float64).reshape(len(b), -1)[:, varied] - mean, model.n)
    return float(np.abs(cov - np.eye(len(varied))).max())


def whiten(
    rows: DataFrame,
    components: int = 16,
    scale: int = 64,
    offset: int = 1_000_000,
    weights: str = "one",
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """id, x, n, deviation, z, explained, identity_error: one row per usable row.

    ``x`` is ``floor(scale * c) + offset`` of each component. The fit list is each
    different x once, weighted by ``weights``: "one", or "counts" for the number
    of its rows; n is the sum of the weights. ``deviation`` is the exact sum of
    (n x - S)^2, null where it does not fit a long. ``z`` holds x less the mean on
    the leading components over the root of their eigenvalue, NaN for a component
    without variance; ``explained`` their shares of the trace, null if that is 0.

    Left out: vectors that are null, empty, hold a null or non-finite component,
    or a component whose product does not fit a long. Vectors of each length are
    fitted by themselves; more than 64 lengths are an error. Rows with null or
    repeated ids are whitened as any other. An empty table gives no rows; other
    columns are ignored.
    """
    if weights not in ("one", "counts"):
        raise ValueError('weights must be "one" or "counts"')
    schema = "id long, x array<long>, n long, deviation long, z array<double>, explained array<double>, identity_error double"
    spark = rows.sparkSession
    whole = rows.select(
        F.col(id_col).cast("long").alias("id"), floored(vector_col, scale, offset).alias("x")
    ).where("x is not null")
    weight = F.lit(1).cast("long") if weights == "one" else F.count("*")
    distinct = stage(whole.groupBy("x").agg(F.count("*").alias("copies"), weight.alias("weight")), "different-vectors")
    out = []
    for length, _ in lengths(distinct, "x"):
        of_length = distinct.where(F.size("x") == length)
        model = fit(of_length.select("x", "weight"), components)
        whitened = stage(
            of_length.mapInArrow(
                _whiten(model), "x array<long>, copies long, weight long, z array<double>, deviation long"
            ),
            "whitened",
        )
        error = _identity_error(whitened, model)
        shares = [float(v) / model.trace if model.trace > 0 else None for v in model.values]
        joined = _join_back(whole.where(F.size("x") == length), whitened)
        out.append(
            joined.select(
                "id", "x", F.lit(model.n).cast("long").alias("n"), "deviation", "z",
                F.array(*[F.lit(s).cast("double") for s in shares]).alias("explained"),
                F.lit(error).cast("double").alias("identity_error"),
            )
        )
    return reduce(DataFrame.unionByName, out) if out else spark.createDataFrame([], schema)


def _join_back(whole: DataFrame, whitened: DataFrame) -> DataFrame:
    """Each row with its vector's result. The few vectors that many rows share are
    broadcast, a number bounded by their share; all others are joined by a shuffle."""
    rows = whitened.agg(F.sum("copies")).first()[0]
    hot = F.col("copies") >= math.ceil(rows / _HOT_SHARE)
    several = hot & (F.col("copies") > 1)
    few = whitened.where(several).select("x", "z", "deviation", F.lit(True).alias("found"))
    met = whole.join(F.broadcast(few), "x", "left")
    rest = whitened.where(~several).select("x", "z", "deviation")
    return (
        met.where("found").drop("found")
        .unionByName(met.where("found is null").select("id", "x").join(rest, "x"), allowMissingColumns=False)
    )
