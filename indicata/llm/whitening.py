"""Whitening of embeddings by principal components found with Jacobi-Davidson.

Entries become whole numbers, x = floor(64 * c) + 1000000, and the distinct x
vectors are the fit list: n of them with sums S per dimension.  Their
covariance V is never formed.  A pass over the written fit list, in which every
task multiplies its centred rows ((n*x - S) / n, the numerator exact) with a few
directions and adds up, gives V times these directions; one row per dimension
reaches the driver.  On that product runs a block Jacobi-Davidson iteration:

* Rayleigh-Ritz on the subspace gives the wanted pairs and their residuals;
* pairs whose residual, measured with a product of their own, is at rounding
  level (``dimension * eps`` times the largest eigenvalue) are locked;
* for the others the correction equation, projected against the locked and the
  wanted vectors, is solved by some steps of MINRES, all equations in the same
  passes; the corrections extend the subspace, which is cut back to its best
  part when it has grown to ``SUBSPACE`` times its wanted size.

The passes grow with the accuracy asked for and the gaps between eigenvalues,
not with the rows.  The driver holds a few vectors per component.  All tables
the passes read are written; a lost executor costs the re-read of its part.

Defined cases: rows with a null vector, or with null or non-finite entries (or
entries too large for x to be a long), are left out; of vectors of different lengths those of the
most frequent length (of equally frequent ones the longest) count and the
others are left out; equal vectors enter the fit list once and are all returned, repeated and null ids
too; components whose eigenvalue is zero (at rounding level) do not exist, so
a single distinct vector, an empty vector or an empty table gives an empty result; a
deviation that does not fit a long is null; columns other than the two named are
ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from indicata.llm.store import small_batches, written

SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 16
SPARE = 4  # vectors of the first subspace beyond the wanted ones
INNER_STEPS = 4  # of MINRES per correction
SUBSPACE = 4  # times the wanted vectors, at most, in the subspace
MAX_ROUNDS = 200
LARGEST = 2.0 ** 62

Product = Callable[[np.ndarray], np.ndarray]


@dataclass
class Basis:
    """Unit eigenvectors (columns) by falling eigenvalue, with what was measured."""

    values: np.ndarray
    vectors: np.ndarray
    residuals: np.ndarray
    rounds: int
    products: int  # passes over the fit list


def _orthonormal(new: np.ndarray, against: np.ndarray) -> np.ndarray:
    """``new`` made orthonormal to ``against`` and in itself; what vanishes is left out."""
    out = against
    for w in new.T:
        size = np.linalg.norm(w)
        for _ in range(3):
            w = w - out @ (out.T @ w)
        left = np.linalg.norm(w)
        if size > 0 and left > 1e-10 * size:
            w = w / left
            w = w - out @ (out.T @ w)
            out = np.column_stack([out, w / np.linalg.norm(w)])
    return out[:, against.shape[1]:]


def minres(apply: Product, b: np.ndarray, shifts: np.ndarray, fixed: np.ndarray, steps: int) -> np.ndarray:
    """Approximate solutions t (a column per shift) of (I-QQ')(A - shift)(I-QQ') t = b
    for the fixed directions Q, by ``steps`` of MINRES; ``b`` is orthogonal to Q.
    All columns share each product with A."""
    project = lambda w: w - fixed @ (fixed.T @ w)
    zero = np.zeros_like(b)
    solution, v_old, w_old, w_older = zero, zero, zero, zero
    beta = np.linalg.norm(b, axis=0)
    v = np.divide(b, beta, out=np.zeros_like(b), where=beta > 0)
    eta = beta.copy()
    cos_old = cos = np.ones(len(shifts))
    sin_old = sin = np.zeros(len(shifts))
    going = beta > 0
    before = np.zeros_like(beta)  # the off-diagonal entry above the current one; none above the first
    for _ in range(steps):
        if not going.any():
            break
        z = project(apply(v) - v * shifts) - v_old * before
        alpha = np.einsum("ij,ij->j", v, z)
        z = project(z - v * alpha)
        after = np.linalg.norm(z, axis=0)
        # The new column of the tridiagonal matrix under the rotations so far.
        r3, r2, r0 = sin_old * before, cos * cos_old * before + sin * alpha, cos * alpha - sin * cos_old * before
        r1 = np.hypot(r0, after)
        going = going & (r1 > 0)
        safe = np.where(r1 > 0, r1, 1)
        w = np.where(going, (v - w_older * r3 - w_old * r2) / safe, 0)
        cos_old, sin_old = cos, sin
        cos, sin = np.where(going, r0 / safe, 1), np.where(going, after / safe, 0)
        solution = solution + w * (cos * eta) * going
        eta = -sin * eta
        w_older, w_old, v_old, before = w_old, w, v, after
        going = going & (after > 1e-14 * np.abs(alpha))
        v = np.divide(z, after, out=np.zeros_like(z), where=going & (after > 0))
    return solution


def jacobi_davidson(apply: Product, dimension: int, wanted: int, inner: int = INNER_STEPS, seed: int = 7) -> Basis:
    """The ``wanted`` largest eigenpairs of the symmetric matrix behind ``apply``
    (a product with a block of columns)."""
    passes = 0

    def product(block: np.ndarray) -> np.ndarray:
        nonlocal passes
        passes += 1
        return apply(block)

    rng = np.random.default_rng(seed)
    wanted = min(wanted, dimension)
    locked, values, sizes = np.empty((dimension, 0)), [], []
    space = _orthonormal(rng.standard_normal((dimension, min(dimension, wanted + SPARE))), locked)
    image = product(space)
    largest = 0.0
    for round_ in range(1, MAX_ROUNDS + 1):
        ritz, turn = np.linalg.eigh((lambda h: (h + h.T) / 2)(space.T @ image))
        ritz, turn = ritz[::-1], turn[:, ::-1]
        space, image = space @ turn, image @ turn
        largest = max([largest, *np.abs(ritz[:1])])
        tolerance = dimension * np.finfo(float).eps * largest
        open_ = wanted - len(values)
        residual = image[:, :open_] - space[:, :open_] * ritz[:open_]
        residual -= locked @ (locked.T @ residual)
        small = np.linalg.norm(residual, axis=0) <= tolerance
        done = int(np.argmin(small)) if not small.all() else len(small)  # locked from the top, in order
        if done or space.shape[1] + len(values) == dimension:
            # A product of their own, not one carried through the turns of the space.
            done = done or open_
            own = product(space[:, :done])
            theta = np.einsum("ij,ij->j", space[:, :done], own)
            norm = np.linalg.norm(own - space[:, :done] * theta - locked @ (locked.T @ own), axis=0)
            image = np.column_stack([own, image[:, done:]])
            whole = space.shape[1] + len(values) == dimension and len(values) + done == wanted and round_ > 2
            good = norm <= (4 * tolerance if whole else tolerance)
            done = int(np.argmin(good)) if not good.all() else done
            if whole and done < open_ and norm.max() <= 64 * tolerance:
                done = open_  # the whole space is searched: this is what rounding leaves
            values += list(theta[:done])
            sizes += list(norm[:done])
            locked = np.column_stack([locked, space[:, :done]])
            space, image = space[:, done:], image[:, done:]
            if len(values) == wanted:
                break
            open_ = wanted - len(values)
            residual = image[:, :open_] - space[:, :open_] * np.einsum("ij,ij->j", space[:, :open_], image[:, :open_])
        if space.shape[1] > SUBSPACE * wanted:
            space, image = space[:, :wanted + SPARE], image[:, :wanted + SPARE]
        target = np.linalg.norm(residual, axis=0) > tolerance
        shifts = np.einsum("ij,ij->j", space[:, :open_], image[:, :open_])
        fixed = np.column_stack([locked, space[:, :open_]])
        right = -(residual - fixed @ (fixed.T @ residual))[:, target]
        steps = minres(product, right, shifts[target], fixed, inner)
        new = _orthonormal(np.column_stack([steps, right]) if not steps.any() else steps, np.column_stack([locked, space]))
        if not new.shape[1]:  # nothing left to search in these directions
            new = _orthonormal(rng.standard_normal((dimension, max(1, open_))), np.column_stack([locked, space]))
        if new.shape[1]:
            space, image = np.column_stack([space, new]), np.column_stack([image, product(new)])
    order = np.argsort(values, kind="stable")[::-1]
    return Basis(np.array(values)[order], locked[:, order], np.array(sizes)[order], round_, passes)


# -- on Spark ---------------------------------------------------------------


def whole_numbers(embeddings: DataFrame, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(vec_id, x) of the rows that have an x, of one length, written."""
    c = F.col("c")
    rows = embeddings.select(F.col(vec_id).alias("vec_id"), F.col(vector).cast("array<double>").alias("c")).where(
        c.isNotNull() & F.forall(c, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) * SCALE < LARGEST)))
    rows = written(rows.select("vec_id", F.transform(c, lambda e: F.floor(e * SCALE).cast("long") + SHIFT).alias("x")),
                   "whole-numbers")
    length = rows.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    return rows.where(F.size("x") == (length.d if length else 0))


@dataclass
class FitList:
    """The distinct x vectors, their number and their sums per dimension."""

    rows: DataFrame
    n: int
    sums: list[int]

    def added(self, parts: Callable[[np.ndarray], np.ndarray], columns: int) -> np.ndarray:
        """The sum of ``parts(centred rows)`` (a fixed number of rows of
        ``columns`` numbers) over the whole list: each task adds up its own."""
        n, sums = self.n, self.sums

        def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = None
            for b in batches:
                if b.num_rows:
                    part = parts(_centred(b, n, sums)[1])
                    total = part if total is None else total + part
            if total is not None:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(len(total), dtype=np.int32)),
                     pa.ListArray.from_arrays(np.arange(0, total.size + 1, columns, dtype=np.int32), total.ravel())],
                    names=["i", "v"])

        got = self.rows.mapInArrow(task, "i int, v array<double>").groupBy("i").agg(
            F.array(*(F.sum(F.col("v")[j]) for j in range(columns))).alias("v")).collect()
        return np.array([r.v for r in sorted(got, key=lambda r: r.i)])


def fit_list(rows: DataFrame) -> FitList:
    distinct = written(rows.select("x").distinct(), "fit-list")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, total = 0, []
        for b in batches:
            if b.num_rows:
                x = _matrix(b)
                total = [a + t for a, t in zip(_sum(x), total or [0] * x.shape[1])]
                count += len(x)
        if count:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(-1, len(total)), pa.int32()),
                 pa.array([Decimal(v) for v in [count, *total]], pa.decimal128(38, 0))], names=["i", "v"])

    got = dict(distinct.mapInArrow(task, "i int, v decimal(38,0)").groupBy("i").agg(F.sum("v")).collect())
    return FitList(distinct, int(got.get(-1, 0)), [int(got[i]) for i in range(len(got) - 1)])


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    return batch["x"].flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)


def _largest(x: np.ndarray) -> int:
    return max(int(x.max(initial=0)), -int(x.min(initial=0)))


def _sum(x: np.ndarray) -> list[int]:
    return [int(v) for v in (x if _largest(x) * len(x) < 1 << 62 else x.astype(object)).sum(axis=0)]


def _centred(batch: pa.RecordBatch, n: int, sums: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """n * x - S, exact (as Python integers where a long is too small), and that over n."""
    x = _matrix(batch)
    small = max(_largest(x) * n, *map(abs, sums)) < 1 << 62
    top = (x if small else x.astype(object)) * n - np.array(sums, dtype=np.int64 if small else object)
    return top, top.astype(np.float64) / n


def _deviations(top: np.ndarray) -> list[int | None]:
    exact = top.dtype != object and _largest(top) ** 2 * top.shape[1] < 1 << 63
    found = [int(v) for v in (top * top if exact else top.astype(object) ** 2).sum(axis=1)]
    return [v if v < 1 << 63 else None for v in found]


def basis_of(fit: FitList, components: int = COMPONENTS) -> Basis:
    """Unit eigenvectors of the fit list's covariance with positive eigenvalues."""
    d = len(fit.sums)
    found = jacobi_davidson(
        lambda w: fit.added(lambda c: c.T @ (c @ w), w.shape[1]) / fit.n, d, min(components, d))
    real = found.values > 4 * d * np.finfo(float).eps * max([0.0, *found.values])
    return Basis(found.values[real], found.vectors[:, real], found.residuals[real], found.rounds, found.products)


def whiten(embeddings: DataFrame, components: int = COMPONENTS, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """One row per remaining row of ``embeddings`` and component: vec_id,
    component, n, deviation, whitened, explained, identity_error, eigenvalue and residual."""
    spark = embeddings.sparkSession
    small_batches(spark)
    rows = whole_numbers(embeddings, vec_id, vector)
    kind = rows.schema["vec_id"].dataType.simpleString()
    schema = (f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, "
              "identity_error double, eigenvalue double, residual double")
    fit = fit_list(rows)
    if not fit.sums:
        return spark.createDataFrame([], schema)
    basis = basis_of(fit, components)
    if not len(basis.values):
        return spark.createDataFrame([], schema)
    k, n, sums = len(basis.values), fit.n, fit.sums
    turn = basis.vectors / np.sqrt(basis.values)
    trace = fit.added(lambda c: np.array([[np.einsum("ij,ij->", c, c)]]), 1)[0, 0] / n

    def moments(c: np.ndarray) -> np.ndarray:
        z = c @ turn
        return np.vstack([z.sum(axis=0), z.T @ z])

    m = fit.added(moments, k) / n
    error = float(np.abs(m[1:] - np.outer(m[0], m[0]) - np.eye(k)).max())
    per_component = (basis.values / trace, np.full(k, error), basis.values, basis.residuals)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            top, c = _centred(b, n, sums)
            size = b.num_rows
            each = pa.array(np.repeat(np.arange(size), k))
            columns = [b["vec_id"].take(each), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), size)),
                       pa.array(np.full(size * k, n, dtype=np.int64)), pa.array(_deviations(top), pa.int64()).take(each),
                       pa.array((c @ turn).ravel()), *(pa.array(np.tile(v, size)) for v in per_component)]
            yield pa.RecordBatch.from_arrays(columns, names=[f.split()[0] for f in schema.split(", ")])

    return rows.mapInArrow(task, schema)
