"""Operator 13, embedding whitening by Golub-Kahan-Lanczos bidiagonalisation.

Entries are read as whole numbers x = floor(256 c). The fit list holds every distinct x vector
once. With A the centred fit list (rows x - S/n), the right vectors v_1, v_2, ... and left
vectors u_1, u_2, ... satisfy A v_k = beta_{k-1} u_{k-1} + alpha_k u_k and
A' u_k = alpha_k v_k + beta_k v_{k+1}; alpha and beta are the bidiagonal matrix, whose small SVD
gives the components (right singular vectors) and deviations (singular values over sqrt(n)).

Left vectors are as long as the table and never leave it: u_k lies in the span of A v_1 ... A v_k,
so it is A g_k for a vector g_k of the vectors' dimension. One pass over the fit list per step
computes, for the candidate p = A q, its products with all earlier left vectors (full
reorthogonalisation), its length and A'p; the tasks add up and only these dimension + steps + 1
sums reach the driver. Right vectors are reorthogonalised there. Where the iteration breaks down
(an invariant subspace, as with equal eigenvalues) it goes on with a fresh vector orthogonal to
all earlier ones. It ends when the wanted components have converged and nothing larger can be
left: with theta the squared singular values, r the rest of the trace and c the coupling
alpha_k beta_k, the part not yet seen has no eigenvalue over max(theta_{w+1}, r) + c; at the
latest it ends after as many steps as there are dimensions.

The fit list is written once, as blocks of ``BLOCK_ROWS`` vectors in the narrowest whole-number
type, so a pass reads few large values. A vector given a third of the times is one row after a
map-side distinct.

Defined cases: a vector that is null, or holds a null, NaN or infinite entry, takes no part and
gives no rows; vectors are compared up to the longest dimension, missing entries at the end
count as zero; components without variance (eigenvalue at most ``NO_VARIANCE`` of the trace) are
left out, so equal vectors only, or a single one, give no rows; entries beyond a long's range
stop at its ends; a deviation beyond a long's range is null; a null vec_id and repeated rows are
rows like any others; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollwise.llm.common import stage

COMPONENTS = 4
SCALE = 256
BLOCK_ROWS = 2048
NO_VARIANCE = 1e-13
CONVERGED = 1e-15
LOST = 1e-2
SEED = 12


def _trimmed(x: str) -> str:
    """SQL: a vector without the zeros at its end, so that vectors equal but for those are one."""
    last = f"array_max(transform({x}, (v, i) -> CASE WHEN v <> 0 THEN i + 1 ELSE 0 END))"
    return f"CASE WHEN size({x}) = 0 OR element_at({x}, -1) <> 0 THEN {x} ELSE slice({x}, 1, {last}) END"


def whole_vectors(rows: DataFrame) -> DataFrame:
    """vec_id and ``x``, the entries as whole numbers without zeros at the end, of every row whose vector takes part."""
    c = F.col("embedding")
    odd = F.exists(c, lambda v: v.isNull() | F.isnan(v) | (F.abs(v.cast("double")) == float("inf")))
    kept = rows.filter(c.isNotNull() & ~odd)
    # floor gives no negative zero once it is a long
    whole = kept.select(F.col("vec_id").cast("long").alias("vec_id"), F.transform(c, lambda v: F.floor(v.cast("double") * SCALE).cast("long")).alias("x"))
    return whole.select("vec_id", F.expr(_trimmed("x")).alias("x"))


def _matrix(lists: pa.Array, dim: int) -> np.ndarray:
    """Rows of an array of whole-number lists, zeros after shorter ones."""
    sizes = np.diff(lists.offsets.to_numpy())
    flat = lists.values.to_numpy(zero_copy_only=False)[lists.offsets[0].as_py() : lists.offsets[-1].as_py()]
    if len(sizes) and (sizes == dim).all():
        return flat.reshape(-1, dim)
    out = np.zeros((len(sizes), dim), np.int64)
    out[np.arange(dim) < sizes[:, None]] = flat
    return out


class FitList:
    """The distinct vectors as written blocks, with their number n, dimension and exact sums."""

    def __init__(self, vectors: DataFrame) -> None:
        distinct = stage(vectors.select("x").distinct(), "whitening-distinct")
        self.n, self.dim = (v or 0 for v in distinct.agg(F.count("*"), F.max(F.size("x"))).first())
        dim = self.dim

        def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            kept: list[np.ndarray] = []

            def block() -> pa.RecordBatch:
                m = np.concatenate(kept)
                kept.clear()
                # Exact sums: float estimates tell where whole numbers of 64 bits could overflow.
                big = np.abs(m.astype(float)).max(initial=0.0) * len(m) > 2**62
                sums = [Decimal(int(v)) for v in (m.astype(object) if big else m).sum(axis=0)]
                for t in (np.int8, np.int16, np.int32, np.int64):
                    if not m.size or (m.min() >= np.iinfo(t).min and m.max() <= np.iinfo(t).max):
                        break
                data = m.astype(t)
                return pa.RecordBatch.from_arrays(
                    [pa.array([data.itemsize], pa.int32()), pa.array([data.tobytes()], pa.binary()), pa.array([sums], pa.list_(pa.decimal128(38, 0)))],
                    names=["width", "data", "sums"],
                )

            for b in batches:
                m = _matrix(b.column(0), dim)
                for lo in range(0, len(m), BLOCK_ROWS):
                    kept.append(m[lo : lo + BLOCK_ROWS])
                    if sum(map(len, kept)) >= BLOCK_ROWS:
                        yield block()
            if kept:
                yield block()

        packed = distinct.select("x").mapInArrow(blocks, "width int, data binary, sums array<decimal(38,0)>") if dim else distinct.limit(0).selectExpr("0 AS width", "CAST('' AS BINARY) AS data", "array(CAST(0 AS DECIMAL(38,0))) AS sums")
        self.blocks = stage(packed, "whitening-blocks")
        each = self.blocks.select(F.posexplode("sums").alias("i", "s")).groupBy("i").agg(F.sum("s").alias("s")).collect()  # a row per dimension
        self.sums = [0] * dim
        for r in each:
            self.sums[r["i"]] = int(r["s"])
        self.mean = np.array([s / self.n for s in self.sums]) if self.n else np.zeros(dim)

    def products(self, left: np.ndarray, q: np.ndarray) -> tuple[np.ndarray, np.ndarray, float, float]:
        """One pass: U'p (U = A left), A'p, p'p for p = A q, and the sum of all squared entries of A."""
        dim, mean = self.dim, self.mean

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(left.shape[1] + dim + 2)
            for b in batches:
                for width, data in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                    a = np.frombuffer(data.as_buffer(), f"<i{width}").reshape(-1, dim) - mean
                    p = a @ q
                    total += np.concatenate([(a @ left).T @ p, a.T @ p, [p @ p, np.einsum("ij,ij->", a, a)]])
            yield pa.RecordBatch.from_arrays([pa.array([total], pa.list_(pa.float64()))], names=["sums"])

        parts = self.blocks.select("width", "data").mapInArrow(run, "sums array<double>")
        each = parts.select(F.posexplode("sums").alias("i", "s")).groupBy("i").agg(F.sum("s").alias("s")).collect()
        out = np.zeros(left.shape[1] + dim + 2)
        for r in each:
            out[r["i"]] = r["s"]
        k = left.shape[1]
        return out[:k], out[k : k + dim], float(out[-2]), float(out[-1])


def _orthogonal(x: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """``x`` without its part in the basis (columns), taken off twice."""
    for _ in range(2):
        x = x - basis @ (basis.T @ x)
    return x


def _fresh(basis: np.ndarray, number: int) -> np.ndarray | None:
    """A unit vector orthogonal to the basis; None when the basis is whole."""
    if basis.shape[1] >= len(basis):
        return None
    x = _orthogonal(np.random.default_rng([SEED, number]).standard_normal(len(basis)), basis)
    return x / np.linalg.norm(x)


class Components:
    """Unit components (columns), eigenvalues of the covariance, its trace, and the steps taken."""

    def __init__(self, fit: FitList, wanted: int = COMPONENTS) -> None:
        dim, n = fit.dim, max(fit.n, 1)
        right, left = np.zeros((dim, 0)), np.zeros((dim, 0))  # u_k = A left[:, k]
        images = np.zeros((dim, 0))  # A'u_k
        small = np.zeros((dim + 1, dim + 1))  # the projected matrix U'AV, bidiagonal
        self.steps, self.trace = 0, 0.0
        self.vectors, self.values = np.zeros((dim, 0)), np.zeros(0)
        v = _fresh(right, 0)
        while v is not None:
            right = np.column_stack([right, v])
            # p minus its part in the earlier left vectors; again where little of it is left, as
            # differences would then lose digits. The coefficients also give A'p and its length.
            g = v
            for _ in range(3):
                inner, image, length, square = fit.products(left, g)
                small[: left.shape[1], self.steps] += inner
                g, image, length_left = g - left @ inner, image - images @ inner, max(length - inner @ inner, 0.0)
                if length_left >= LOST * length:
                    break
            self.trace = square / n
            if square == 0:
                break
            alpha = np.sqrt(length_left)
            self.steps += 1
            tiny = 1e-14 * np.sqrt(square)
            if alpha > tiny:
                small[left.shape[1], self.steps - 1] = alpha
                left, images = np.column_stack([left, g / alpha]), np.column_stack([images, image / alpha])
                rest = _orthogonal(image / alpha, right)
            else:
                rest = np.zeros(dim)
            beta = float(np.linalg.norm(rest))
            u, s, vt = np.linalg.svd(small[: left.shape[1], : self.steps], full_matrices=True)
            theta = np.zeros(self.steps)
            theta[: len(s)] = s**2
            last = np.abs(u[-1, :wanted]) if len(u) else np.zeros(0)
            if self.steps > wanted:
                coupled = alpha * beta
                left_over = max(theta[wanted], square - theta.sum(), 0.0) + coupled
                if left_over <= theta[wanted - 1] and (beta * last <= CONVERGED * np.sqrt(theta[0])).all():
                    v = None
            self.vectors, self.values = (right @ vt.T)[:, :wanted], theta[:wanted] / n
            if v is not None:
                v = rest / beta if beta > tiny else _fresh(right, self.steps)
        keep = self.values > NO_VARIANCE * self.trace
        self.vectors, self.values = self.vectors[:, keep], self.values[keep]


def _identity_error(fit: FitList, c: Components) -> float:
    """Largest absolute entry of the whitened fit list's covariance minus the identity, by one pass per component."""
    k = len(c.values)
    scaled = c.vectors / np.sqrt(c.values)
    cov = np.zeros((k, k))
    for j in range(k):
        cov[:, j] = fit.products(scaled, scaled[:, j])[0] / fit.n
    return float(np.abs(cov - np.eye(k)).max(initial=0.0))


SCHEMA = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def whiten(rows: DataFrame, wanted: int = COMPONENTS) -> DataFrame:
    """Every row that takes part, whitened on up to ``wanted`` components: a row per vector and component.

    Columns vec_id, component (from 1), n, deviation (sum over dimensions of (n x - S)^2),
    whitened, explained (eigenvalue over trace), identity_error (one value for all rows).
    """
    vectors = whole_vectors(rows)
    fit = FitList(vectors)
    c = Components(fit, wanted)
    error = _identity_error(fit, c)
    n, dim, k = fit.n, fit.dim, len(c.values)
    sums, mean = fit.sums, fit.mean
    scaled = c.vectors / np.sqrt(c.values)
    explained = c.values / c.trace if c.trace else c.values

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        exact = np.array(sums, dtype=object)
        short = all(abs(s) < 2**62 for s in sums)
        for b in batches:
            for lo in range(0, b.num_rows, BLOCK_ROWS):
                part = b.slice(lo, BLOCK_ROWS)
                x = _matrix(part.column(1), dim)
                far = n * x.astype(float) - np.array(sums, float)
                square = np.einsum("ij,ij->i", far, far)
                safe = (square < 2.0**62) & short
                whole = np.zeros(len(x), object)
                if safe.any():
                    d = n * x[safe] - np.array(sums, np.int64)
                    whole[safe] = (d * d).sum(axis=1)
                for i in np.flatnonzero(~safe):
                    value = sum(int(v) ** 2 for v in n * x[i].astype(object) - exact)
                    whole[i] = value if value < 2**63 else None
                white = (x - mean) @ scaled
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(part.column(0)).take(pa.array(np.repeat(np.arange(len(x)), k))),
                        pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                        pa.array(np.full(len(x) * k, n, np.int64)),
                        pa.array([v for v in whole.tolist() for _ in range(k)], pa.int64()),
                        pa.array(white.ravel()),
                        pa.array(np.tile(explained, len(x))),
                        pa.array(np.full(len(x) * k, error)),
                    ],
                    names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
                )

    if not k:
        return vectors.sparkSession.createDataFrame([], SCHEMA)
    return vectors.mapInArrow(run, SCHEMA)
