"""Whitening of embeddings: leading eigenpairs of their covariance by Jacobi-Davidson, without forming the covariance.

Entries become integers (``floor(1024 * c) + 100000``), so that number and sums of the vectors are exact. The covariance V is
known only by its product with a few vectors: every task centres its rows, projects them and sums up, and Spark adds the
tasks' sums entry by entry. All wanted pairs are sought at once:

* Rayleigh-Ritz within the subspace searched so far gives the best approximations u with values t;
* for each unfinished one, in order, the correction equation (I - QQ')(V - tI)(I - QQ')s = -r is solved roughly by
  ``INNER`` steps of MINRES, where Q holds u and the finished vectors. A step of all equations is one distributed product;
* the corrections, made orthogonal, extend the subspace; a full one is cut back to the best approximations;
* a pair is locked, from the first one on, once its residual is at the rounding of a product (``ROUNDING`` times the first
  value), and the search ends when all pairs are.

What the driver holds is the subspace: at most ``WIDTH`` vectors for each wanted component, of one entry per dimension.

Edge cases: vectors that are null, or hold null or non-finite entries, or an entry beyond 64 bits, are left out. The
dimension is that of most vectors (the greater one of a tie); vectors of any other length are left out too, as they have no
covariance with them. Without vectors the result is empty. Directions without variance cannot be whitened: ``whitened`` is
null there, ``explained`` 0 (null if nothing varies). Repeated vectors and ids count and are answered row by row, a null id
like any other. Other columns are not read. A ``deviation`` beyond 64 bits is null.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salescast.session import materialize

SCALE, SHIFT = 1024.0, 100_000
#: Steps of MINRES for a correction, vectors of the subspace for each component, and rounds before giving up.
INNER, WIDTH, ROUNDS = 6, 8, 200
#: Residuals, in parts of the first eigenvalue, that the rounding of a product explains.
ROUNDING = 64 * np.finfo(float).eps
#: Rows that a task turns into floating-point numbers at a time.
ROWS = 4096


@dataclass(frozen=True)
class Fit:
    """Number and sums of the vectors, trace of the covariance, and the leading eigenpairs, one column each."""

    n: int
    sums: list[int]
    trace: float
    values: np.ndarray
    vectors: np.ndarray
    residuals: np.ndarray

    @property
    def mean(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums])  # quotients of whole numbers, rounded once

    @property
    def varying(self) -> np.ndarray:
        """Which components have variance beyond rounding."""
        top = self.values[0] if len(self.values) else 0.0
        return self.values > max(top, 1e-300) * len(self.sums) * np.finfo(float).eps


def whole_vectors(embeddings: DataFrame, column: str = "embedding") -> DataFrame:
    """(vec_id, x): the usable vectors as whole numbers, written; all have the same length."""
    finite = F.forall(column, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) < 9e15))
    x = F.transform(column, lambda c: F.floor(c.cast("double") * SCALE) + SHIFT)
    rows = materialize(
        embeddings.where(F.col(column).isNotNull() & F.coalesce(finite, F.lit(False))).select("vec_id", x.alias("x")), "vectors")
    size = rows.groupBy(F.size("x").alias("d")).agg(F.count(F.lit(1)).alias("n")).agg(F.max_by("d", F.struct("n", "d"))).first()[0]
    return rows.where(F.size("x") == (size or 0))


def _matrix(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
    """The vectors of a batch, a few thousand at a time, as rows of whole numbers."""
    for at in range(0, batch.num_rows, ROWS):
        part = batch["x"].slice(at, ROWS)
        yield part.flatten().to_numpy().reshape(len(part), -1)


def _summed(rows: DataFrame, shape: tuple[int, ...], part: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """The sum over all vectors of ``part``, which maps some of them to an array of ``shape``.

    A task sends one row per entry, and entries are added by a combinable aggregate; the driver gets one number each.
    """
    size = int(np.prod(shape))

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(shape)
        for batch in batches:
            for x in _matrix(batch):
                total += part(x)
        yield pa.RecordBatch.from_pydict({"entry": pa.array(np.arange(size, dtype=np.int32)), "value": pa.array(total.ravel())})

    entries = rows.select("x").mapInArrow(add, "entry int, value double").groupBy("entry").agg(F.sum("value").alias("value"))
    out = np.zeros(size)
    for r in entries.toArrow().to_pylist():
        out[r["entry"]] = r["value"]
    return out.reshape(shape)


def _minres(apply: Callable[[np.ndarray], np.ndarray], right: np.ndarray, steps: int) -> np.ndarray:
    """Approximate solutions of as many symmetric systems as ``right`` has columns, by the Lanczos process and rotations.

    ``apply`` maps one vector of each system at once. A system that is solved earlier stays as it is.
    """
    k = right.shape[1]
    beta = np.linalg.norm(right, axis=0)
    alive = beta > 0
    v = np.divide(right, beta, out=np.zeros_like(right), where=alive)
    before, out = np.zeros_like(right), np.zeros_like(right)
    w1, w2 = np.zeros_like(right), np.zeros_like(right)
    c1, s1, c2, s2 = np.ones(k), np.zeros(k), np.ones(k), np.zeros(k)
    phi, b, scale = beta.copy(), np.zeros(k), np.zeros(k)
    for _ in range(steps):
        if not alive.any():
            break
        p = apply(v)
        a = np.sum(v * p, axis=0)
        p = p - a * v - b * before
        after = np.linalg.norm(p, axis=0)
        # The new column (b, a, after) of the tridiagonal matrix meets the last two rotations and gets one of its own.
        e, rest = s2 * b, c2 * b
        d, g = c1 * rest + s1 * a, c1 * a - s1 * rest
        r = np.hypot(g, after)
        scale = np.maximum(scale, np.abs(a) + b + after)
        alive &= r > 1e-14 * scale
        safe = np.where(alive, r, 1.0)
        c, s = np.where(alive, g / safe, 1.0), np.where(alive, after / safe, 0.0)
        w = np.where(alive, (v - e * w2 - d * w1) / safe, 0.0)
        out += np.where(alive, c * phi, 0.0) * w
        phi = np.where(alive, -s * phi, phi)
        w1, w2, c1, s1, c2, s2 = w, w1, c, s, c1, s1
        alive &= after > 1e-14 * scale
        before, v = v, np.divide(p, after, out=np.zeros_like(p), where=alive)
        b = after
    return out


def _orthogonal(new: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """The columns of ``new`` made orthonormal and orthogonal to ``basis``; those that add nothing are left out."""
    kept = []
    for column in new.T:
        size = np.linalg.norm(column)
        if not size:
            continue
        column = column / size
        known = np.column_stack([basis, *kept])
        for _ in range(3):
            column = column - known @ (known.T @ column)
        size = np.linalg.norm(column)
        if size > 1e-10:
            column = column / size
            kept.append(column - known @ (known.T @ column))
            kept[-1] /= np.linalg.norm(kept[-1])
    return np.column_stack([np.zeros((len(new), 0)), *kept])


def jacobi_davidson(product: Callable[[np.ndarray], np.ndarray], d: int, wanted: int, inner: int = INNER,
                    rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Leading eigenvalues (falling), eigenvectors and residuals of a symmetric matrix of ``d`` rows given by its products."""
    wanted = min(wanted, d)
    most = min(d, max(WIDTH * wanted, wanted + 2))
    basis = _orthogonal(np.random.default_rng(13).standard_normal((d, min(d, wanted + 2))), np.zeros((d, 0)))
    images, least, stalled = product(basis), np.inf, 0
    for _ in range(rounds):
        small = basis.T @ images
        t, y = np.linalg.eigh((small + small.T) / 2)
        t, y = t[::-1], y[:, ::-1]
        values, u = t[:wanted], basis @ y[:, :wanted]
        residual = images @ y[:, :wanted] - u * values
        size = np.linalg.norm(residual, axis=0)
        ready = size <= ROUNDING * abs(values[0])
        # Products of long sums may round more: then residuals stay where they are, close to that.
        stalled = stalled + 1 if size.max() > 0.5 * least and size.max() <= 64 * ROUNDING * abs(values[0]) else 0
        least = min(least, size.max())
        if ready.all() or basis.shape[1] == d or stalled == 3:
            return values, u, size
        locked = int(np.argmin(ready))  # pairs are finished in order
        if basis.shape[1] + wanted - locked > most:
            keep = min(wanted + 2, basis.shape[1])
            basis, images = basis @ y[:, :keep], images @ y[:, :keep]
        active = np.flatnonzero(~ready)
        q, shift = u[:, :locked], values[active]

        def project(x: np.ndarray) -> np.ndarray:
            x = x - q @ (q.T @ x)
            return x - u[:, active] * np.sum(u[:, active] * x, axis=0)

        s = _minres(lambda x: project(product(project(x)) - shift * x), project(-residual[:, active]), inner)
        new = _orthogonal(s, basis)
        if not new.shape[1]:  # no correction adds anything: the rounding of products is reached
            return values, u, size
        basis, images = np.column_stack([basis, new]), np.column_stack([images, product(new)])
        if basis.shape[1] == d:
            images = product(basis)  # the whole space, with images free of what rounds added up
    raise ArithmeticError(f"residuals {size} after {rounds} rounds")


def fit(rows: DataFrame, components: int = 8) -> Fit | None:
    """Learn from the vectors (vec_id, x) of one length; None if there are none."""
    sums = (rows.select(F.posexplode("x").alias("i", "v")).groupBy("i")
            .agg(F.sum(F.col("v").cast("decimal(38,0)")).alias("s"), F.count(F.lit(1)).alias("n")).toArrow().to_pylist())
    if not sums:
        return None
    n = sums[0]["n"]
    exact = [int(r["s"]) for r in sorted(sums, key=lambda r: r["i"])]
    mean = np.array([s / n for s in exact])
    trace = float(_summed(rows, (1,), lambda x: np.array([np.square(x - mean).sum()]))[0]) / n

    def product(u: np.ndarray) -> np.ndarray:
        def part(x: np.ndarray) -> np.ndarray:
            x = x - mean
            return x.T @ (x @ u)

        return _summed(rows, u.shape, part) / n

    if trace == 0:
        k = min(components, len(exact))
        return Fit(n, exact, 0.0, np.zeros(k), np.eye(len(exact))[:, :k], np.zeros(k))
    values, vectors, residuals = jacobi_davidson(product, len(exact), components)
    sign = np.sign(vectors[np.argmax(np.abs(vectors), axis=0), np.arange(vectors.shape[1])])
    return Fit(n, exact, trace, np.maximum(values, 0.0), vectors * sign, residuals)


def project(rows: DataFrame, fitted: Fit) -> DataFrame:
    """(vec_id, deviation, whitened): the exact squared distance from the mean in n-fold units, and an array of projections."""
    n, sums, mean, varying = fitted.n, np.array(fitted.sums, dtype=object), fitted.mean, fitted.varying
    scaled = fitted.vectors / np.sqrt(np.where(varying, fitted.values, 1.0))

    def deviations(x: np.ndarray) -> list[int | None]:
        # Whole numbers of any size; 64 bits where they are known to suffice.
        far = max(abs(n * int(x.max()) - min(fitted.sums)), abs(n * int(x.min()) - max(fitted.sums)))
        far = max(far, abs(n * int(x.max())), abs(max(fitted.sums, key=abs)))
        if far < 2**62 and (wide := np.abs(n * x - sums.astype(np.int64)).max()) ** 2 * x.shape[1] < 2**62 and wide < 2**31:
            return np.square(n * x - sums.astype(np.int64)).sum(axis=1).tolist()
        exact = np.square(x.astype(object) * n - sums).sum(axis=1)
        return [v if v < 2**63 else None for v in exact.tolist()]

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k, x in enumerate(_matrix(batch)):
                found = pa.array(((x - mean) @ scaled).ravel())
                if not varying.all():
                    found = pa.array(found.to_pylist(), mask=np.tile(~varying, len(x)))
                at = pa.array(np.arange(len(x) + 1, dtype=np.int32) * len(varying))
                yield pa.RecordBatch.from_arrays(
                    [batch["vec_id"].slice(k * ROWS, ROWS), pa.array(deviations(x), pa.int64()), pa.ListArray.from_arrays(at, found)],
                    ["vec_id", "deviation", "whitened"])

    kind = rows.schema["vec_id"].dataType.simpleString()
    return rows.mapInArrow(each, f"vec_id {kind}, deviation bigint, whitened array<double>")


def identity_error(rows: DataFrame, fitted: Fit) -> float:
    """The largest absolute entry of the whitened vectors' covariance minus the identity, over the components that vary."""
    kept = fitted.varying
    if not kept.any():
        return 0.0
    scaled, mean, k = (fitted.vectors / np.sqrt(np.where(kept, fitted.values, 1.0)))[:, kept], fitted.mean, int(kept.sum())
    middle = _summed(rows, (k,), lambda x: ((x - mean) @ scaled).sum(axis=0)) / fitted.n

    def part(x: np.ndarray) -> np.ndarray:
        y = (x - mean) @ scaled - middle
        return y.T @ y

    return float(np.abs(_summed(rows, (k, k), part) / fitted.n - np.eye(k)).max())


def whiten(embeddings: DataFrame, components: int = 8, column: str = "embedding") -> DataFrame:
    """A row per usable vector and component: vec_id, component, n, deviation, whitened, explained, identity_error."""
    rows = whole_vectors(embeddings, column)
    fitted = fit(rows, components)
    if fitted is None:
        return rows.select("vec_id", F.lit(0).alias("component"), F.lit(0).cast("long").alias("n"),
                           F.lit(0).cast("long").alias("deviation"),
                           *(F.lit(0.0).alias(c) for c in ("whitened", "explained", "identity_error"))).where("false")
    shares = [float(v) / fitted.trace if fitted.trace else None for v in fitted.values]
    shares = [s if ok or s is None else 0.0 for s, ok in zip(shares, fitted.varying)]
    error = identity_error(rows, fitted)
    long = project(rows, fitted).select("vec_id", "deviation", F.posexplode("whitened").alias("place", "whitened"))
    explained = F.array(*(F.lit(s).cast("double") for s in shares))
    return long.select("vec_id", (F.col("place") + 1).alias("component"), F.lit(fitted.n).cast("long").alias("n"), "deviation",
                       "whitened", F.get(explained, F.col("place")).alias("explained"), F.lit(error).alias("identity_error"))
