"""Whitening of embeddings: pivoted Cholesky of the centred scatter, then one-sided Jacobi on the triangular factor."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tempoflow.llm.common import staged
from tempoflow.llm.vectors import matrix
from tempoflow.session import shuffle_partitions

# The grid on which entries are counted.
SCALE = 64.0
OFFSET = 1_000_000
#: Entries beyond +-2^40 steps of the grid count as that.
BOUND = 1 << 40
COMPONENTS = 16
ROWS = 4096


class Model(NamedTuple):
    """What the fit list gives: its length, its sums, all eigenvalues and the first components (columns)."""

    n: int
    sums: np.ndarray  # exact integers (Python's, where 64 bits may not do)
    values: np.ndarray
    components: np.ndarray
    trace: float


def on_grid(vectors: DataFrame, row_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``vec_id, x`` with x = floor(64 * c) + 1000000 of each entry c.

    Left out are vectors that are null or hold a null or non-finite entry. Empty ones, and those of another length than the
    most frequent one (of equally frequent ones the longest), have no common dimensions and are left out too.
    """
    c = F.col(vector).cast("array<double>")
    finite = F.forall("c", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    steps = F.transform("c", lambda v: F.floor(F.greatest(F.least(v * SCALE, F.lit(float(BOUND))), F.lit(-float(BOUND)))) + OFFSET)
    rows = vectors.select(F.col(row_id).cast("long").alias("vec_id"), c.alias("c")).where(F.col("c").isNotNull() & (F.size("c") > 0) & finite)
    rows = rows.select("vec_id", steps.alias("x"))
    lengths = rows.groupBy(F.size("x").alias("d")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.desc("d")).first()
    return rows.where(F.size("x") == (lengths["d"] if lengths else 0))


def pivoted_cholesky(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(l, order)`` with v[order][:, order] = l @ l.T; l is lower triangular with as many columns as ``v`` has rank.

    Each step takes the largest remaining diagonal entry and ends when that is rounding noise.
    """
    d = len(v)
    rest, l, order = np.array(v, float), np.zeros((d, d)), np.arange(d)
    least = d * np.finfo(float).eps * max(float(rest.diagonal().max(initial=0.0)), 0.0)
    for k in range(d):
        at = k + int(np.argmax(rest.diagonal()[k:]))
        if not rest[at, at] > least:
            return l[:, :k], order
        swap = [at, k]
        rest[[k, at]], l[[k, at]], order[[k, at]] = rest[swap], l[swap], order[swap]
        rest[:, [k, at]] = rest[:, swap]
        l[k, k] = np.sqrt(rest[k, k])
        l[k + 1 :, k] = rest[k + 1 :, k] / l[k, k]
        rest[k + 1 :, k + 1 :] -= np.outer(l[k + 1 :, k], l[k + 1 :, k])
    return l, order


def _rounds(n: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs of ``n`` columns in rounds of pairs that share none, as in a tournament."""
    seats = np.append(np.arange(n), np.full(n % 2, -1))
    half = len(seats) // 2
    for _ in range(len(seats) - 1):
        a, b = seats[:half], seats[half:][::-1]
        real = (a >= 0) & (b >= 0)
        yield a[real], b[real]
        seats = np.concatenate((seats[:1], seats[-1:], seats[1:-1]))


def one_sided_jacobi(l: np.ndarray, sweeps: int = 60) -> tuple[np.ndarray, np.ndarray]:
    """``(values, vectors)`` of l @ l.T, largest first: columns are rotated in pairs until all are orthogonal.

    Their squared norms are then the eigenvalues, and the normalised columns the eigenvectors.
    """
    g = np.array(l, float)
    for _ in range(sweeps):
        worst = 0.0
        for a, b in _rounds(g.shape[1]):
            p, q = g[:, a], g[:, b]
            pp, qq, pq = (p * p).sum(0), (q * q).sum(0), (p * q).sum(0)
            far = np.abs(pq) / np.sqrt(pp * qq)
            worst = max(worst, float(far.max(initial=0.0)))
            turn = far > 1e-16
            zeta = (qq - pp) / np.where(turn, 2 * pq, 1.0)
            t = np.where(turn, np.where(zeta < 0, -1.0, 1.0) / (np.abs(zeta) + np.hypot(1.0, zeta)), 0.0)
            c = 1 / np.hypot(1.0, t)
            g[:, a], g[:, b] = c * (p - t * q), c * (q + t * p)
        if worst < 4 * len(l) * np.finfo(float).eps:
            break
    values = (g * g).sum(0)
    order = np.argsort(-values, kind="stable")
    return values[order], g[:, order] / np.sqrt(values[order])


# ---- centred moments over partitions ----------------------------------------------------------------------------


def _merged(a: tuple | None, b: tuple) -> tuple:
    """Count, means and centred scatter of two sets of rows together."""
    if a is None:
        return b
    n, shift = a[0] + b[0], b[1] - a[1]
    return n, a[1] + shift * (b[0] / n), a[2] + b[2] + np.outer(shift, shift) * (a[0] * b[0] / n)


def _moments(rows: np.ndarray) -> tuple:
    mean = rows.mean(axis=0)
    centred = rows - mean
    return len(rows), mean, centred.T @ centred


MOMENTS = "n long, mean array<double>, scatter array<double>"


def _packed(moments: tuple | None) -> Iterator[pa.RecordBatch]:
    if moments is not None:
        n, mean, scatter = moments
        yield pa.RecordBatch.from_pydict({"n": pa.array([n], pa.int64()), "mean": pa.array([mean.tolist()]), "scatter": pa.array([scatter.ravel().tolist()])})


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    found = None
    for batch in batches:
        for n, mean, scatter in zip(batch.column(0).to_pylist(), matrix(batch.column(1)), matrix(batch.column(2)), strict=True):
            found = _merged(found, (n, mean, scatter.reshape(len(mean), len(mean))))
    yield from _packed(found)


def moments(rows: DataFrame, project) -> tuple | None:
    """Count, means and centred scatter of ``project(x)`` over ``x`` of all rows.

    Each task sends one matrix; they are merged in a second, smaller round of tasks, of which at most 32 matrices reach the driver.
    """

    def of_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = None
        for batch in batches:
            for k in range(0, batch.num_rows, ROWS):
                found = _merged(found, _moments(project(integers(batch.column(0).slice(k, ROWS)))))
        yield from _packed(found)

    parts = rows.select("x").mapInArrow(of_task, MOMENTS)
    merged = parts.repartition(min(32, shuffle_partitions(rows.sparkSession))).mapInArrow(_joined, MOMENTS)
    found = None
    for row in merged.collect():
        found = _merged(found, (row["n"], np.array(row["mean"]), np.array(row["scatter"]).reshape(len(row["mean"]), -1)))
    return found


# ---- the operator -----------------------------------------------------------------------------------------------


def integers(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else np.empty((0, 0), np.int64)


def _differences(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """n * x - sums, exact: in 64 bits where they surely do."""
    if n * 2 * (BOUND if len(x) == 0 else int(np.abs(x).max()) + 1) < 1 << 62 and all(abs(int(s)) < 1 << 62 for s in sums):
        return n * x - sums.astype(np.int64)
    return n * x.astype(object) - sums


def _squares(differences: np.ndarray) -> list[int | None]:
    """Exact sums of squares of each row; null where 64 bits do not hold them."""
    if differences.dtype != object and (not differences.size or differences.shape[1] * (int(np.abs(differences).max()) ** 2) < 1 << 63):
        return (differences * differences).sum(axis=1).tolist()
    sums = (differences.astype(object) ** 2).sum(axis=1)
    return [int(s) if s < 1 << 63 else None for s in sums]


def centred(n: int, sums: np.ndarray):
    """x - sums / n from the exact integer n * x - sums."""
    return lambda x: _differences(x, n, sums).astype(float) / n


def distinct_vectors(rows: DataFrame) -> DataFrame:
    """Each different ``x`` once; copies combine before the shuffle, so a hot vector moves once a task."""
    return rows.select("x").distinct()


def fit(rows: DataFrame, components: int = COMPONENTS) -> Model:
    """The model of a fit list of ``x`` vectors, all of one length.

    Counts and sums are exact, the scatter is centred row by row before it is multiplied. Only the number of dimensions
    squared reaches the driver. Components whose eigenvalue is rounding noise do not exist: a list of equal vectors has none.
    """
    d = rows.select(F.size("x")).first()
    if d is None:
        return Model(0, np.zeros(0, object), np.zeros(0), np.zeros((0, 0)), 0.0)
    total = [F.sum(F.get("x", F.lit(k)).cast("decimal(28,0)")).alias(f"s{k}") for k in range(d[0])]
    count, *sums = rows.agg(F.count(F.lit(1)), *total).first()
    sums = np.array([int(s) for s in sums], object)
    scatter = moments(rows, centred(count, sums))[2] / count
    l, order = pivoted_cholesky((scatter + scatter.T) / 2)
    values, turned = one_sided_jacobi(l)
    vectors = np.zeros_like(turned)
    vectors[order] = turned
    return Model(count, sums, values, vectors[:, :components], float(scatter.trace()))


def _projection(model: Model):
    centre, scaled = centred(model.n, model.sums), model.components / np.sqrt(model.values[: model.components.shape[1]])
    return lambda x: centre(x) @ scaled


def identity_error(rows: DataFrame, model: Model) -> float:
    """Largest absolute entry of the covariance of the whitened rows minus the identity."""
    found = moments(rows, _projection(model))
    return float(np.abs(found[2] / found[0] - np.eye(len(found[1]))).max())


WHITENED = "vec_id long, deviation long, whitened array<double>"


def transform(rows: DataFrame, model: Model) -> DataFrame:
    """``vec_id, deviation, whitened`` of every row of ``vec_id, x``.

    ``deviation`` is the exact sum over dimensions of (n * x - sums)^2, null where a long does not hold it.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        project = _projection(model)
        for batch in batches:
            for part in (batch.slice(k, ROWS) for k in range(0, batch.num_rows, ROWS)):
                x = integers(part.column(1))
                white = project(x)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * white.shape[1]), pa.array(white.ravel()))
                squares = pa.array(_squares(_differences(x, model.n, model.sums)), pa.int64())
                yield pa.RecordBatch.from_arrays([part.column(0), squares, lists], names=["vec_id", "deviation", "whitened"])

    return rows.select("vec_id", "x").mapInArrow(run, WHITENED)


def whiten(vectors: DataFrame, components: int = COMPONENTS, row_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """One row per vector and component: ``vec_id, component, n, deviation, whitened, explained, identity_error``.

    The fit list is each different grid vector once, so copies weigh nothing. Rows that :func:`on_grid` leaves out have no output; null
    ids are kept, repeated rows repeated, other columns ignored. Where the rank is below ``components`` there are fewer components; an
    empty table, a single vector or nothing but copies of one give no rows. The number of dimensions is what a driver must
    hold squared.
    """
    rows = staged(on_grid(vectors, row_id, vector), "grid")
    fit_list = staged(distinct_vectors(rows), "fit")
    model = fit(fit_list, components)
    if not model.components.shape[1]:
        return rows.sparkSession.createDataFrame([], "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double")
    shares = F.array(*[F.lit(float(v / model.trace)) for v in model.values[: model.components.shape[1]]])
    exploded = transform(rows, model).select("vec_id", "deviation", F.posexplode("whitened").alias("k", "whitened"))
    return exploded.select(
        "vec_id",
        (F.col("k") + 1).cast("int").alias("component"),
        F.lit(model.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.get(shares, F.col("k")).alias("explained"),
        F.lit(identity_error(fit_list, model)).alias("identity_error"),
    )
