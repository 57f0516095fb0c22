"""Whitening of embeddings: blockwise TSQR of the centred rows, one-sided Jacobi SVD of what is left."""

from __future__ import annotations

import dataclasses
import math
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Stored, fresh, quoted, table

#: Entries become floor(SCALE * entry) + SHIFT.
SCALE = 1024
SHIFT = 100_000
#: Entries beyond this many units count as this many, so that sums of a batch are exact in 64 bits.
MOST = 1 << 50
COMPONENTS = 8
#: Rows that a task compresses at a time, and triangles that are compressed to one in a round.
BLOCK = 4096
FAN = 32


@dataclasses.dataclass
class Whitening:
    """A fit over ``n`` vectors: exact ``sums`` of their units, unit eigenvectors as rows of ``components`` by falling
    eigenvalue, standard ``deviations`` along them and the share of the variance that each explains (nan without
    any variance). Its size depends on the number of dimensions alone."""

    n: int
    sums: list[int]
    components: np.ndarray
    deviations: np.ndarray
    explained: np.ndarray


def _doubles(vector: str) -> Column:
    return quoted([vector])[0].cast("array<double>")


def _sound(v: Column) -> Column:
    """Not null nor empty, and all entries are finite numbers."""
    return F.coalesce(F.size(v) > 0, F.lit(False)) & F.coalesce(F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False))


def units(vectors: pa.Array, dims: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the vectors that are sound and ``dims`` long, and their entries in units, a row each."""
    vectors = vectors.combine_chunks() if isinstance(vectors, pa.ChunkedArray) else vectors
    lengths = vectors.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    flat = vectors.flatten()
    entries, there = flat.to_numpy(zero_copy_only=False).astype(np.float64), flat.is_valid().to_numpy(zero_copy_only=False)
    at = np.flatnonzero(lengths == dims)
    starts = (np.cumsum(lengths) - lengths)[at]
    places = starts[:, None] + np.arange(dims)
    rows = entries[places] if len(at) else np.zeros((0, dims))
    sound = (there[places] & np.isfinite(rows)).all(axis=1) if len(at) else np.zeros(0, dtype=bool)
    return at[sound], np.clip(np.floor(np.clip(rows[sound], -float(MOST), float(MOST)) * SCALE), -MOST, MOST).astype(np.int64) + SHIFT


def _from_mean(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n * x - sums, exact: in 64 bits where they suffice, in Python's integers elsewhere."""
    most = max(1, int(np.abs(x).max(initial=0)))
    if n * most + max(map(abs, sums)) < 1 << 62:
        return n * x - np.array(sums, dtype=np.int64)
    return n * x.astype(object) - np.array(sums, dtype=object)


def _squares(d: np.ndarray) -> list[int | None]:
    """Sum of the squares of each row; None where it does not fit a long."""
    if d.dtype != object and int(np.abs(d).max(initial=0)) ** 2 * d.shape[1] < 1 << 63:
        return (d * d).sum(axis=1).tolist()
    sums = [sum(int(v) ** 2 for v in row) for row in d]
    return [s if s < 1 << 63 else None for s in sums]


def _per_batch(rows: DataFrame, dims: int, run, schema: str) -> DataFrame:
    """``run(batches of units)`` gives a task's columns by their names, once a task."""

    def task(batches):
        def blocks():
            for batch in batches:
                _, x = units(batch.column(0), dims)
                for k in range(0, len(x), BLOCK):
                    yield x[k : k + BLOCK]

        found = run(blocks())
        if found is not None:
            yield pa.RecordBatch.from_pydict(found)

    return rows.mapInArrow(task, schema)


def _triangle(top: np.ndarray | None, rows: np.ndarray) -> np.ndarray:
    return np.linalg.qr(rows if top is None else np.concatenate([top, rows]), mode="r")


def _compressed(rows: DataFrame, n: int, sums: list[int]) -> np.ndarray:
    """R of the centred rows (R'R is n times their covariance): a triangle a task, then ``FAN`` triangles at a time."""
    dims = len(sums)

    def run(blocks):
        top = None
        for x in blocks:
            top = _triangle(top, _from_mean(x, n, sums).astype(np.float64) / n)
        if top is None:
            return None
        return {"block": pa.array([TaskContext.get().partitionId()], pa.int64()), "r": pa.array([top.tobytes()], pa.binary())}

    def merge(group: pa.Table) -> pa.Table:
        order, top = np.argsort(group.column("block").to_numpy()), None
        for k in order:
            top = _triangle(top, np.frombuffer(group.column("r")[int(k)].as_py()).reshape(-1, dims))
        return pa.table({"block": pa.array([int(group.column("block")[0].as_py()) // FAN], pa.int64()), "r": pa.array([top.tobytes()], pa.binary())})

    stored = Stored(_per_batch(rows, dims, run, "block long, r binary"))
    now, left = stored.df, stored.df.agg(F.max("block")).first()[0] + 1
    while left > 1:
        now, left = now.groupBy((F.col("block") / FAN).cast("long")).applyInArrow(merge, "block long, r binary"), -(-left // FAN)
    r = np.frombuffer(now.first()["r"]).reshape(-1, dims)
    stored.drop()
    return r


def _rounds(d: int):
    """Every two of ``d`` columns once, as rounds of pairs that have no column in common."""
    seats = list(range(d + d % 2))
    for _ in range(len(seats) - 1):
        pairs = [(a, b) for a, b in zip(seats[: len(seats) // 2], seats[::-1], strict=False) if a < d and b < d]
        yield np.array([min(p) for p in pairs]), np.array([max(p) for p in pairs])
        seats = [seats[0], seats[-1], *seats[1:-1]]


def one_sided_jacobi(r: np.ndarray, sweeps: int = 60) -> tuple[np.ndarray, np.ndarray]:
    """Right singular vectors (as rows) and singular values of ``r``, by falling value.

    Plane rotations make the columns of ``r`` orthogonal to each other; accumulated they are the vectors, and the lengths of the
    columns are the values, each accurate relative to itself. The largest entry of a vector is positive."""
    u, d = np.array(r, dtype=np.float64), r.shape[1]
    v, eps = np.eye(d), np.finfo(np.float64).eps
    rounds = list(_rounds(d)) if d > 1 else []
    for _ in range(sweeps):
        turned = False
        for p, q in rounds:
            a, b = u[:, p], u[:, q]
            alpha, beta, gamma = (a * a).sum(axis=0), (b * b).sum(axis=0), (a * b).sum(axis=0)
            on = np.abs(gamma) > eps * np.sqrt(alpha * beta)
            if not on.any():
                continue
            turned = True
            p, q, a, b = p[on], q[on], a[:, on], b[:, on]
            zeta = (beta[on] - alpha[on]) / (2 * gamma[on])
            t = np.where(zeta < 0, -1.0, 1.0) / (np.abs(zeta) + np.hypot(1, zeta))
            c = 1 / np.hypot(1, t)
            s = c * t
            u[:, p], u[:, q] = c * a - s * b, s * a + c * b
            a, b = v[:, p], v[:, q]
            v[:, p], v[:, q] = c * a - s * b, s * a + c * b
        if not turned:
            break
    lengths = np.sqrt((u * u).sum(axis=0))
    order = np.argsort(-lengths, kind="stable")
    v = v[:, order].T
    return v * np.where(v[np.arange(d), np.abs(v).argmax(axis=1)] < 0, -1.0, 1.0)[:, None], lengths[order]


def fit(vectors: DataFrame, vector: str = "embedding", components: int = COMPONENTS) -> Whitening | None:
    """Principal components of all sound vectors of the most frequent length (of two the longer); None without any.

    Entries are taken in units (``SCALE``, ``SHIFT``), sums are exact, and rows are centred before they are multiplied. What
    comes to the driver is a sum and a row of R for each dimension. Null and empty vectors, vectors with null or non-finite
    entries and those of another length take no part; repeated rows count each time. Components of equal eigenvalues
    are some orthonormal directions of their space.
    """
    rows = vectors.select(_doubles(vector).alias("v"))
    most = rows.where(_sound(F.col("v"))).groupBy(F.size("v").alias("dims")).count().orderBy(F.desc("count"), F.desc("dims")).first()
    if most is None:
        return None
    dims, n = most["dims"], most["count"]

    def run(blocks):
        total = [0] * dims
        for x in blocks:
            total = [a + b for a, b in zip(total, x.sum(axis=0).tolist(), strict=True)]
        return {"place": pa.array(range(dims), pa.int32()), "s": pa.array(map(Decimal, total), pa.decimal128(38, 0))}

    found = _per_batch(rows, dims, run, "place int, s decimal(38,0)").groupBy("place").agg(F.sum("s").alias("s")).collect()
    sums = [int(r["s"]) for r in sorted(found, key=lambda r: r["place"])]
    axes, lengths = one_sided_jacobi(_compressed(rows, n, sums))
    total = math.fsum(lengths**2)
    kept = min(components, dims)
    # a column that rounding alone has made has no direction
    deviations = np.where(lengths > lengths[0] * dims * np.finfo(np.float64).eps, lengths, 0)[:kept] / math.sqrt(n)
    return Whitening(n, sums, axes[:kept], deviations, lengths[:kept] ** 2 / total if total else np.full(kept, np.nan))


def _whitened(x: np.ndarray, model: Whitening) -> tuple[np.ndarray, np.ndarray]:
    """n * x - sums, and the coordinates in standard deviations; nan along components without variance."""
    d = _from_mean(x, model.n, model.sums)
    along = (d.astype(np.float64) / model.n) @ model.components.T
    return d, np.divide(along, model.deviations, out=np.full_like(along, np.nan), where=model.deviations > 0)


def transform(vectors: DataFrame, model: Whitening, vector: str = "embedding", into: str = "whitening") -> DataFrame:
    """``vectors`` with a struct more: ``deviation`` (sum over dimensions of (n * x - S)^2, null beyond a long) and
    ``whitened`` (a coordinate for each component, null along one without variance). The struct is null for vectors that
    could take no part in the fit. ``into`` must not be the name of another column."""
    dims = len(model.sums)

    @F.arrow_udf("struct<deviation: bigint, whitened: array<double>>")
    def apply(v: pa.Array) -> pa.Array:
        at, x = units(v, dims)
        deviation, whitened = [None] * len(v), [None] * len(v)
        for k in range(0, len(at), BLOCK):
            d, w = _whitened(x[k : k + BLOCK], model)
            for i, s, row in zip(at[k : k + BLOCK], _squares(d), w.tolist(), strict=True):
                deviation[i], whitened[i] = s, [None if c != c else c for c in row]
        mask = np.ones(len(v), dtype=bool)
        mask[at] = False
        return pa.StructArray.from_arrays([pa.array(deviation, pa.int64()), pa.array(whitened, pa.list_(pa.float64()))], ["deviation", "whitened"], mask=pa.array(mask))

    return vectors.select(*quoted(vectors.columns), apply(_doubles(vector)).alias(into))


def identity_error(vectors: DataFrame, model: Whitening, vector: str = "embedding") -> float | None:
    """Largest absolute entry of the whitened vectors' covariance minus the identity, along the components that
    have variance; None without any."""
    live = model.deviations > 0
    k, dims = int(live.sum()), len(model.sums)
    if not k:
        return None

    def run(blocks):
        total = np.zeros((k + 1, k))
        for x in blocks:
            w = _whitened(x, model)[1][:, live]
            total += np.concatenate([w.sum(axis=0)[None], w.T @ w])
        return {"place": pa.array(range(total.size), pa.int32()), "s": pa.array(total.ravel())}

    found = _per_batch(vectors.select(_doubles(vector).alias("v")), dims, run, "place int, s double").groupBy("place").agg(F.sum("s").alias("s")).collect()
    total = np.array([r["s"] for r in sorted(found, key=lambda r: r["place"])]).reshape(k + 1, k) / model.n
    return float(np.abs(total[1:] - np.outer(total[0], total[0]) - np.eye(k)).max())


def op11_whitening(spark, sf_dir: str) -> DataFrame:
    """Each sound vector's coordinates along the first components. Vectors of another length than the most frequent are
    left out with the unsound ones; without any variance ``whitened``, ``explained`` and ``identity_error`` are null; an empty
    table gives no rows."""
    vectors = table(spark, sf_dir, "embeddings")
    vectors = vectors.select("vec_id", "embedding")
    model = fit(vectors)
    if model is None:
        return spark.createDataFrame([], "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double")
    error = identity_error(vectors, model)
    to = fresh(vectors.columns, "_w")
    rows = transform(vectors, model, into=to).where(F.col(to).isNotNull())
    explained = F.array(*[F.lit(None if e != e else float(e)).cast("double") for e in model.explained])
    return rows.select("vec_id", F.col(f"{to}.deviation").alias("deviation"), F.posexplode(f"{to}.whitened").alias("k", "whitened")).select(
        "vec_id",
        (F.col("k") + 1).alias("component"),
        F.lit(model.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.get(explained, F.col("k")).alias("explained"),
        F.lit(error).cast("double").alias("identity_error"),
    )
