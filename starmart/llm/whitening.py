"""Embedding whitening by an incremental eigendecomposition.

Each partition keeps the spectrum (count, mean, eigenvectors, eigenvalues) of the scatter of its vectors. Updates are
centred and of rank one: the secular equation of the diagonal plus the rank-one term is solved for all eigenvalues at
once, after deflation of parts that the update does not touch or that share an eigenvalue, and the eigenvectors follow
from the corrected update vector, which keeps them orthogonal. A block of more vectors than dimensions is centred on its
own mean and enters as the rows of its triangular factor, which have the same scatter, and the difference of the two
means; so most vectors cost a share of an update. Spectra of partitions are merged in groups of bounded
size, level by level, by the same updates with the scaled eigenvectors of one side and the difference of the two means.
The basis of the last spectrum is refined by Rayleigh-Ritz: all vectors are projected on it where they lie, only the
small products are summed, and their eigenvectors rotate the basis. The identity error is measured on the whitened
vectors themselves in a further pass.

Data that passes through the driver has the size of the square of the dimension, whatever the number of rows. No rows are
shuffled. Sums of the vectors are exact integers, and so is the deviation.

Defined cases: vectors that are null, or hold null or non-finite entries or entries of which 64 times is 2**53 or more,
are dropped; so are vectors whose length is not that of most vectors (ties: the longer) and those without entries. Rows
without an id and repeated rows are rows as all others. Components without variance (under 1e-12 of the largest) have a
null ``whitened`` and an explained share of their own and take no part in the identity error. A deviation beyond a long
is null. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from starmart.llm.tables import Stored

#: Grid on which vectors are whole numbers, and the largest number of components returned.
GRID, OFFSET, COMPONENTS = 64, 1_000_000, 32
#: Vectors that enter together.
BLOCK = 1024
#: Spectra that one task merges, and the share of the largest eigenvalue below which one counts as none.
FAN_IN, NO_VARIANCE = 16, 1e-12
_EPS = np.finfo(float).eps


def secular_roots(d: np.ndarray, z: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Roots of ``1 + sum(z**2 / (d - x))`` for ascending distinct ``d`` and nonzero ``z``.

    Returns the index of the pole nearest to each root and the root's distance from it, so that differences between poles
    and roots keep their digits. Each step replaces the sums over the poles on both sides of a root by one pole each and
    solves the quadratic; a step out of the known bracket is halved instead.
    """
    m = len(d)
    z2 = z * z
    if m == 1:
        return np.zeros(1, np.int64), z2
    top = d[-1] + z2.sum() * (1 + 1e-10)
    upper = np.append(d[1:], top)
    middle = (d + upper) / 2
    value = 1 + (z2 / (d - middle[:, None])).sum(axis=1)
    at_left = value >= 0
    at_left[-1] = True
    pole = np.where(at_left, np.arange(m), np.minimum(np.arange(m) + 1, m - 1))
    delta = d[None, :] - d[pole][:, None]
    left, right = d - d[pole], upper - d[pole]
    half = (right - left) / 2
    low = np.where(at_left, left, left + half)
    high = np.where(at_left, left + half, right)
    high[-1], low[-1] = right[-1], left[-1]
    x = (low + high) / 2
    below, done = np.tri(m, dtype=bool), np.zeros(m, bool)
    for _ in range(60):
        gap = delta - x[:, None]
        term = z2 / gap
        slope = term / gap
        psi, psi1 = (term * below).sum(axis=1), (slope * below).sum(axis=1)
        phi, phi1 = term.sum(axis=1) - psi, slope.sum(axis=1) - psi1
        f = 1 + psi + phi
        high, low = np.where(f > 0, x, high), np.where(f > 0, low, x)
        done |= np.abs(f) <= 8 * _EPS * (1 + np.abs(psi) + np.abs(phi) + np.abs(x) * (psi1 + phi1))
        if done.all():
            break
        # psi ~ a + b / (left - x), phi ~ c + e / (right - x), equal in value and slope at x
        u, v = left - x, right - x
        b, e = psi1 * u * u, phi1 * v * v
        k = 1 + psi - psi1 * u + phi - phi1 * v
        # k (u - t)(v - t) + b (v - t) + e (u - t) = 0 for the step t
        p = k * (u + v) + b + e
        q = k * u * v + b * v + e * u
        root = np.sqrt(np.maximum(p * p - 4 * k * q, 0))
        with np.errstate(divide="ignore", invalid="ignore"):
            t = np.where(p > 0, 2 * q / (p + root), (p - root) / (2 * k))
            t[-1] = u[-1] + b[-1] / k[-1]  # the last root has no pole above it
        new = x + t
        bad = ~np.isfinite(new) | (new <= low) | (new >= high)
        x = np.where(done, x, np.where(bad, (low + high) / 2, new))
    return pole, x


def rank_one(values: np.ndarray, vectors: np.ndarray, update: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (ascending) and eigenvectors of ``vectors diag(values) vectors' + update update'``."""
    z = vectors.T @ update
    scale = max(float(np.abs(values).max(initial=0.0)), float(z @ z))
    if scale == 0:
        return values, vectors
    tolerance = 8 * _EPS * scale
    alive = np.abs(z) * np.sqrt(scale) > tolerance
    # Equal eigenvalues: a rotation gathers their share of the update in the last of them.
    order = np.flatnonzero(alive)
    vectors = vectors.copy() if len(order) else vectors
    for i, j in zip(order[:-1], order[1:]):
        if values[j] - values[i] <= tolerance:
            r = float(np.hypot(z[i], z[j]))
            c, s = z[j] / r, z[i] / r
            vi, vj = vectors[:, i].copy(), vectors[:, j].copy()
            vectors[:, i], vectors[:, j] = c * vi - s * vj, s * vi + c * vj
            z[i], z[j] = 0.0, r
            alive[i] = False
    active = np.flatnonzero(alive)
    if len(active) == 0:
        return values, vectors
    d, w = values[active], z[active]
    pole, x = secular_roots(d, w)
    # gap[i, j]: pole j less root i, without cancellation
    gap = (d[None, :] - d[pole][:, None]) - x[:, None]
    gap[gap == 0] = -_EPS * scale
    # The update vector for which the computed roots are exact: root i pairs with pole i before the pole asked for, and
    # with pole i + 1 from there on; the last root stands alone.
    m = len(d)
    product = np.abs(gap[-1])
    if m > 1:
        roots, poles = np.arange(m - 1)[:, None], np.arange(m)[None, :]
        partner = np.where(roots < poles, roots, roots + 1)
        product = product * np.prod(np.abs(gap[:-1]) / np.abs(d[partner] - d[poles]), axis=0)
    corrected = np.sqrt(product) * np.where(w < 0, -1.0, 1.0)
    inner = corrected[None, :] / gap
    inner /= np.sqrt((inner * inner).sum(axis=1))[:, None]
    values = values.copy()
    values[active] = d[pole] + x
    vectors[:, active] = vectors[:, active] @ inner.T
    order = np.argsort(values, kind="stable")
    return values[order], vectors[:, order]


class Spectrum:
    """Count, exact sums, and eigenvalues and eigenvectors of the scatter of whole-number vectors."""

    def __init__(self, dimension: int):
        self.n, self.sums = 0, np.zeros(dimension, object)
        self.values, self.vectors = np.zeros(dimension), np.eye(dimension)

    def add(self, block: np.ndarray) -> None:
        """Take in whole-number vectors, one per row."""
        sums = block.astype(object).sum(axis=0) if _wide(block) else block.sum(axis=0).astype(object)
        rows = _centred(block, len(block), sums) / len(block)
        if len(rows) > block.shape[1]:
            rows = np.linalg.qr(rows, mode="r")
        for row in rows:
            self.values, self.vectors = rank_one(self.values, self.vectors, row)
        self._join(len(block), sums)

    def _join(self, n: int, sums: np.ndarray) -> None:
        """The update for the difference of the means, and the new count and sums."""
        if self.n and n:
            apart = np.array([float(a) for a in sums * self.n - self.sums * n]) / (float(self.n) * float(n))
            weight = float(self.n) * float(n) / float(self.n + n)
            self.values, self.vectors = rank_one(self.values, self.vectors, apart * np.sqrt(weight))
        self.n, self.sums = self.n + n, self.sums + sums

    def merge(self, n: int, sums: np.ndarray, values: np.ndarray, vectors: np.ndarray) -> None:
        """Take in another spectrum, one eigenvector after the other."""
        for value, vector in zip(values, vectors.T):
            if value > 0:
                self.values, self.vectors = rank_one(self.values, self.vectors, vector * np.sqrt(value))
        self._join(n, sums)

    def row(self) -> dict:
        return {"n": self.n, "sums": [str(s) for s in self.sums], "values": self.values.tolist(), "vectors": self.vectors.ravel().tolist()}


SPECTRUM = "part int, n long, sums array<string>, values array<double>, vectors array<double>"


def _wide(block: np.ndarray) -> bool:
    return bool(len(block)) and float(np.abs(block).max()) * len(block) >= 2**62


def _centred(block: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """``n * block - sums`` as doubles, subtracted as whole numbers first."""
    return _exact(block, n, sums).astype(float)


def _exact(block: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """``n * block - sums``, in 64 bits where they are enough and else as Python's whole numbers."""
    if float(np.abs(block).max(initial=0)) * n < 2**61 and max((abs(int(s)) for s in sums), default=0) < 2**61:
        return block * np.int64(n) - sums.astype(np.int64)
    return block.astype(object) * int(n) - sums


def _whole(batch: pa.RecordBatch, column: str, dimension: int) -> np.ndarray:
    flat = batch.column(column).flatten().to_numpy(zero_copy_only=False)
    scaled = np.floor(flat.astype(float) * GRID).astype(np.int64) + OFFSET
    return scaled.reshape(-1, dimension)


def usable(vectors: DataFrame, dimension: int | None = None) -> DataFrame:
    """(vec_id, v) of the vectors that take part, as doubles."""
    whole = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("v")).where(
        f"v is not null and size(v) > 0 and forall(v, c -> c is not null and not isnan(c) and abs(c) * {GRID} < {2**53})")
    return whole if dimension is None else whole.where(F.size("v") == dimension)


def _summed(parts: DataFrame) -> np.ndarray:
    """Sum of equally long arrays by position, one row per position on the driver."""
    rows = parts.select(F.posexplode("v").alias("k", "x")).groupBy("k").agg(F.sum("x").alias("x")).orderBy("k").collect()
    return np.array([r.x for r in rows])


class Whitening:
    """Fitted whitening: count, exact sums, eigenvalues by falling size, and their eigenvectors in columns."""

    def __init__(self, n: int, sums: np.ndarray, values: np.ndarray, vectors: np.ndarray, components: int):
        self.n, self.sums, self.dimension = n, sums, len(sums)
        self.explained = values / values.sum() if values.sum() > 0 else np.zeros(len(values))
        k = min(components, len(values))
        self.values, self.vectors = values[:k], vectors[:, :k]
        self.varies = self.values > NO_VARIANCE * max(float(values[0]), 0.0) if len(values) else np.zeros(0, bool)

    def project(self, block: np.ndarray) -> np.ndarray:
        """Whitened rows; NaN for components without variance."""
        with np.errstate(divide="ignore", invalid="ignore"):
            scale = np.where(self.varies, 1 / np.sqrt(np.where(self.varies, self.values, 1.0)), np.nan)
        return (_centred(block, self.n, self.sums) / self.n) @ self.vectors * scale


def _spectra(rows: DataFrame, dimension: int) -> DataFrame:
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        own = Spectrum(dimension)
        for batch in batches:
            block = _whole(batch, "v", dimension)
            for at in range(0, len(block), BLOCK):
                own.add(block[at:at + BLOCK])
        if own.n:
            yield pa.RecordBatch.from_pylist([{"part": TaskContext.get().partitionId()} | own.row()], _arrow(SPECTRUM))

    return rows.select("v").mapInArrow(task, SPECTRUM)


def _arrow(schema: str) -> pa.Schema:
    kinds = {"int": pa.int32(), "long": pa.int64(), "double": pa.float64(), "array<string>": pa.list_(pa.string()),
             "array<double>": pa.list_(pa.float64())}
    return pa.schema([(name, kinds[kind]) for name, kind in (c.split() for c in schema.split(", "))])


def _merged(stored: Stored, spectra: DataFrame, dimension: int) -> Spectrum | None:
    """The spectrum of all partitions, merged in groups of ``FAN_IN`` until one is left."""

    def task(table: pa.Table) -> pa.Table:
        own = Spectrum(dimension)
        rows = sorted(table.to_pylist(), key=lambda r: r["part"])
        for r in rows:
            own.merge(r["n"], np.array([int(s) for s in r["sums"]], object), np.array(r["values"]),
                      np.array(r["vectors"]).reshape(dimension, dimension))
        return pa.Table.from_pylist([{"part": rows[0]["part"] // FAN_IN} | own.row()], _arrow(SPECTRUM))

    level = stored.keep(spectra, "spectra")
    while (last := level.agg(F.max("part")).first()[0]) is not None and last > 0:
        above = stored.keep(level.groupBy(F.floor(F.col("part") / FAN_IN).alias("merged")).applyInArrow(task, SPECTRUM), "spectra")
        stored.drop(level)
        level = above
    row = level.first()
    stored.drop(level)
    if row is None:
        return None
    one = Spectrum(dimension)
    one.n, one.sums = row.n, np.array([int(s) for s in row.sums], object)
    one.values, one.vectors = np.array(row["values"]), np.array(row.vectors).reshape(dimension, dimension)
    return one


def _products(rows: DataFrame, dimension: int, project) -> np.ndarray:
    """Sum over all rows of the products of their projected entries, pair by pair."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            y = project(_whole(batch, "v", dimension))
            own = y.T @ y
            total = own if total is None else total + own
        if total is not None:
            yield pa.RecordBatch.from_pylist([{"v": total.ravel().tolist()}], _arrow("v array<double>"))

    found = _summed(rows.select("v").mapInArrow(task, "v array<double>"))
    side = int(round(len(found) ** 0.5))
    return found.reshape(side, side)


def fit(vectors: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """Whitening of all usable vectors; None if there are none."""
    sizes = usable(vectors).groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).limit(1).collect()
    if not sizes:
        return None
    dimension = sizes[0].d
    rows = usable(vectors, dimension)
    spectrum = _merged(Stored(vectors.sparkSession, "whitening"), _spectra(rows, dimension), dimension)
    n, sums = spectrum.n, spectrum.sums
    basis = np.linalg.qr(spectrum.vectors[:, ::-1])[0]
    small = _products(rows, dimension, lambda block: (_centred(block, n, sums) / n) @ basis) / n
    values, turn = np.linalg.eigh((small + small.T) / 2)
    values = np.maximum(values[::-1], 0.0)
    return Whitening(n, sums, values, basis @ turn[:, ::-1], components)


def identity_error(vectors: DataFrame, model: Whitening) -> float:
    """Largest absolute entry of the covariance of the whitened vectors minus the identity."""
    live = model.varies
    if not live.any():
        return 0.0
    project = lambda block: model.project(block)[:, live]
    covariance = _products(usable(vectors, model.dimension), model.dimension, project) / model.n
    return float(np.abs(covariance - np.eye(len(covariance))).max())


def whitened(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """One row per usable vector and component: vec_id, component, n, deviation, whitened, explained, identity_error."""
    model = fit(vectors, components)
    key = vectors.schema["vec_id"].dataType.simpleString()
    if model is None:
        return vectors.sparkSession.createDataFrame([], (
            f"vec_id {key}, component int, n long, deviation long, whitened double, explained double, identity_error double"))
    error, dimension = identity_error(vectors, model), model.dimension

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            block = _whole(batch, "v", dimension)
            apart = _exact(block, model.n, model.sums)
            if apart.dtype != object and float(np.abs(apart).max(initial=0)) ** 2 * dimension < 2**62:
                deviation = (apart * apart).sum(axis=1).tolist()
            else:
                exact = [sum(int(a) * int(a) for a in row) for row in apart]
                deviation = [x if x < 2**63 else None for x in exact]
            y = model.project(block)
            k = y.shape[1]
            flat = pa.array(y.ravel(), pa.float64(), from_pandas=True)
            lists = pa.ListArray.from_arrays(np.arange(0, k * len(y) + 1, k, dtype=np.int32), flat)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), pa.array(deviation, pa.int64()), lists], names=["vec_id", "deviation", "y"])

    rows = usable(vectors, dimension).mapInArrow(task, f"vec_id {key}, deviation long, y array<double>")
    shares = F.array(*(F.lit(float(x)) for x in model.explained[:len(model.values)]))
    return rows.select("vec_id", "deviation", F.posexplode("y").alias("at", "whitened")).select(
        "vec_id", (F.col("at") + 1).cast("int").alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation",
        "whitened", shares[F.col("at")].alias("explained"), F.lit(error).alias("identity_error"))
