"""Whitening of vectors by refined eigenvectors of their covariance.

Entries c become whole numbers ``x = floor(64 c) + 1000000``. Four scans, all of
them bounded by the square of the vector length on the driver and in each task:

1. n, exact sums and ranges of every dimension.
2. The covariance: x less the whole number next to its mean is multiplied as
   matrices of whole numbers that doubles hold exactly (in limbs of ``LIMB`` bits
   where they are large). Sums are exact, the offset of under one half is taken
   off exactly, so the covariance is the same however the rows are spread.
3. Eigenvectors in float32, then Ogita-Aishima steps in extended precision: from
   ``R = I - X'X`` and ``S = X'VX`` follows a correction of X by matrix products
   alone, which squares the error each time. Eigenvalues closer than the step
   can tell apart are clusters; each is solved anew in its own few dimensions,
   shifted by its mean, before the next step. Columns are made orthonormal in
   between, as a shift by the mean would else magnify what they lack. Then the
   covariance of the whitened rows is measured.
4. The rows.

Vectors that are NULL or hold NULL or non-finite entries are dropped. Vectors of
each length are a fit of their own; empty ones have no components. A component
without variance (equal rows, fewer rows than dimensions) has whitened 0 and
explained 0, and is left out of the identity error. Entries beyond 2 ** 50 are
held there; a deviation beyond a long stops at its end. Repeated rows and ids
count as rows of their own; a NULL vec_id stays NULL. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal
from fractions import Fraction
from functools import partial
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weir.llm.common import map_batches

SCALE, SHIFT = 64, 1_000_000
HELD = 2.0**50
LIMB = 20  # bits; products of two limbs over CHUNK rows are whole numbers below 2 ** 53
CHUNK = 1 << 13
ROUNDS = 20
WIDE = np.longdouble
LONGEST = np.iinfo(np.int64).max


class Fit(NamedTuple):
    """What is known of the vectors of one length; sums are exact, about ``centre``."""

    n: int
    centre: np.ndarray  # whole numbers next to the means
    offset: list[int]  # sum of x - centre
    spread: int  # largest |x - centre|
    vectors: np.ndarray  # unit eigenvectors as columns, by falling eigenvalue
    values: np.ndarray
    error: float = 0.0


def usable(embeddings: DataFrame) -> DataFrame:
    vec = F.col("embedding").cast("array<double>")
    finite = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return embeddings.select("vec_id", vec.alias("vec")).filter(F.col("vec").isNotNull() & F.coalesce(finite, F.lit(False)))


def whole(vectors: np.ndarray) -> np.ndarray:
    scaled = np.clip(vectors, -HELD / SCALE, HELD / SCALE) * SCALE
    return np.floor(scaled).astype(np.int64) + SHIFT


def _by_length(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, places, x) of the rows of a batch."""
    lists = batch.column("vec")
    lengths = np.diff(lists.offsets.to_numpy())
    for dim in np.unique(lengths[lengths > 0]):
        rows = np.flatnonzero(lengths == dim)
        yield int(dim), rows, whole(lists.take(pa.array(rows)).flatten().to_numpy(zero_copy_only=False).reshape(len(rows), dim))


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    found: dict[int, list] = {}
    for batch in batches:
        for dim, _, x in _by_length(batch):
            n, total, low, high = found.get(dim, (0, [0] * dim, x[0], x[0]))
            above = (x - SHIFT).astype(object).sum(axis=0) if np.abs(x).max() > 2**40 else (x - SHIFT).sum(axis=0)
            total = [t + int(a) + SHIFT * len(x) for t, a in zip(total, above)]
            found[dim] = [n + len(x), total, np.minimum(low, x.min(axis=0)), np.maximum(high, x.max(axis=0))]
    for dim, (n, total, low, high) in found.items():
        yield pa.RecordBatch.from_arrays(
            [pa.array([dim] * dim, pa.int32()), pa.array(range(dim), pa.int32()), pa.array([n] * dim, pa.int64()),
             pa.array(map(Decimal, total), pa.decimal128(38, 0)), pa.array(low), pa.array(high)],
            ["dim", "i", "n", "s", "low", "high"],
        )


def limbs(y: np.ndarray, spread: int) -> list[np.ndarray]:
    """``y`` as a sum of whole numbers times 2 ** (LIMB * place), each held exactly by products of doubles."""
    out = []
    while spread >> LIMB:
        out.append((y & ((1 << LIMB) - 1)).astype(np.float64))
        y, spread = y >> LIMB, spread >> LIMB
    return [*out, y.astype(np.float64)]


def products(y: np.ndarray, spread: int) -> np.ndarray:
    """Exact ``y' y`` as Python integers, or longs where they fit."""
    total: np.ndarray | int = 0
    for at in range(0, len(y), CHUNK):
        parts = limbs(y[at : at + CHUNK], spread)
        for i, a in enumerate(parts):
            for j, b in enumerate(parts):
                exact = (a.T @ b).astype(np.int64)
                total = total + (exact if len(parts) == 1 else exact.astype(object) << (LIMB * (i + j)))
    return total


def _second(fits: dict[int, Fit], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    found: dict[int, np.ndarray] = {}
    for batch in batches:
        for dim, _, x in _by_length(batch):
            found[dim] = found.get(dim, 0) + products(x - fits[dim].centre, fits[dim].spread)
    for dim, total in found.items():
        i, j = np.triu_indices(dim)
        sums = pa.array([Decimal(int(v)) for v in total[i, j]], pa.decimal128(38, 0))
        columns = [pa.array(np.full(len(i), dim, np.int32)), pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), sums]
        yield pa.RecordBatch.from_arrays(columns, ["dim", "i", "j", "s"])


def rounded(top: int, bottom: int) -> np.longdouble:
    """``top / bottom`` in extended precision."""
    first = top / bottom
    rest = Fraction(top, bottom) - Fraction(first)
    return WIDE(first) + WIDE(float(rest))


def corrected(a: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.longdouble]:
    """One Ogita-Aishima step: better eigenvectors, their values, and the gap below which values count as one cluster."""
    r = np.eye(len(a), dtype=WIDE) - x.T @ x
    s = x.T @ (a @ x)
    values = np.diag(s) / (1 - np.diag(r))
    norm = lambda m: np.sqrt((m * m).sum())
    gap = 2 * (norm(s - np.diag(values)) + norm(a) * norm(r))
    apart = values[None, :] - values[:, None]
    far = np.abs(apart) > gap
    step = np.where(far, (s + values[None, :] * r) / np.where(far, apart, 1), r / 2)
    return x + x @ step, values, gap


def orthonormal(x: np.ndarray) -> np.ndarray:
    """Nearly orthonormal columns made so to full precision, by products alone (Newton-Schulz)."""
    for _ in range(3):
        x = x + x @ (np.eye(x.shape[1], dtype=WIDE) - x.T @ x) / 2
    return x


def refined(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors of a symmetric extended-precision matrix."""
    size = np.abs(a).max()
    if not size:
        return np.zeros(len(a)), np.eye(len(a))
    a = a / size
    x = np.linalg.eigh(a.astype(np.float32))[1].astype(WIDE)
    least = np.inf
    for _ in range(ROUNDS):
        x, values, gap = corrected(a, x)
        if gap >= least / 2:  # no longer getting better
            break
        least = gap
        order = np.argsort(values)
        x, values = orthonormal(x[:, order]), values[order]
        ends = np.flatnonzero(np.diff(values) > gap) + 1
        for cluster in np.split(np.arange(len(a)), ends):
            if len(cluster) > 1:
                own = x[:, cluster]
                small = own.T @ (a @ own - values[cluster].mean() * own)
                small = (small + small.T) / 2
                if scale := np.abs(small).max():
                    x[:, cluster] = own @ np.linalg.eigh((small / scale).astype(np.float64))[1].astype(WIDE)
    x = orthonormal(x)
    values = np.einsum("ij,ij->j", x, a @ x) * size
    order = np.argsort(-values, kind="stable")
    return values[order].astype(np.float64), x[:, order].astype(np.float64)


def covariance(n: int, offset: list[int], second: dict[tuple[int, int], int]) -> np.ndarray:
    v = np.zeros((len(offset), len(offset)), WIDE)
    for (i, j), s in second.items():
        v[i, j] = v[j, i] = rounded(n * s - offset[i] * offset[j], n * n)
    return v


def whitened(fit: Fit, x: np.ndarray, components: int) -> np.ndarray:
    """Rows by components; components without variance are 0."""
    mean = np.array([t / fit.n for t in fit.offset])
    shown = fit.vectors[:, :components]
    scale = np.where(_varies(fit)[:components], np.sqrt(np.maximum(fit.values[:components], 0)), np.inf)
    return ((x - fit.centre) - mean) @ shown / scale


def _varies(fit: Fit) -> np.ndarray:
    return fit.values > len(fit.values) * np.finfo(np.float64).eps * max(fit.values.max(initial=0), 0)


def _spread(fits: dict[int, Fit], components: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums and products of the whitened rows of a task."""
    found: dict[int, list] = {}
    for batch in batches:
        for dim, _, x in _by_length(batch):
            w = whitened(fits[dim], x, components)
            sums, squares = found.get(dim, (0, 0))
            found[dim] = [sums + w.sum(axis=0), squares + w.T @ w]
    for dim, (sums, squares) in found.items():
        i, j = np.triu_indices(len(sums))
        i, j = np.r_[np.full(len(sums), -1), i], np.r_[np.arange(len(sums)), j]
        values = np.r_[sums, squares[np.triu_indices(len(sums))]]
        columns = [pa.array(np.full(len(i), dim, np.int32)), pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(values)]
        yield pa.RecordBatch.from_arrays(columns, ["dim", "i", "j", "s"])


def fit(embeddings: DataFrame, components: int = 32) -> dict[int, Fit]:
    """The whitening of each vector length; holds the square of a length on the driver."""
    rows = usable(embeddings).select("vec")
    sums = rows.mapInArrow(_sums, "dim int, i int, n long, s decimal(38,0), low long, high long").groupBy("dim", "i")
    first: dict[int, dict] = {}
    for r in sums.agg(F.sum("n").alias("n"), F.sum("s").alias("s"), F.min("low").alias("low"), F.max("high").alias("high")).collect():
        first.setdefault(r.dim, {})[r.i] = r
    fits = {}
    for dim, found in first.items():
        each = [found[i] for i in range(dim)]
        n = each[0].n
        centre = [(2 * int(r.s) + n) // (2 * n) for r in each]
        spread = max(max(r.high - c, c - r.low) for r, c in zip(each, centre))
        offset = [int(r.s) - n * c for r, c in zip(each, centre)]
        fits[dim] = Fit(n, np.array(centre, np.int64), offset, spread, np.zeros((dim, 0)), np.zeros(0))
    second: dict[int, dict] = {dim: {} for dim in fits}
    parts = rows.mapInArrow(partial(_second, fits), "dim int, i int, j int, s decimal(38,0)")
    for r in parts.groupBy("dim", "i", "j").agg(F.sum("s").alias("s")).collect():
        second[r.dim][r.i, r.j] = int(r.s)
    for dim, f in fits.items():
        values, vectors = refined(covariance(f.n, f.offset, second[dim]))
        fits[dim] = f._replace(values=np.maximum(values, 0), vectors=vectors)
    spreads: dict[int, dict] = {dim: {} for dim in fits}
    measured = rows.mapInArrow(partial(_spread, fits, components), "dim int, i int, j int, s double")
    for r in measured.groupBy("dim", "i", "j").agg(F.sum("s").alias("s")).collect():
        spreads[r.dim][r.i, r.j] = r.s
    return {dim: f._replace(error=_identity_error(f, spreads[dim])) for dim, f in fits.items()}


def _identity_error(f: Fit, sums: dict[tuple[int, int], float]) -> float:
    """Largest entry of the whitened rows' covariance minus the identity."""
    varies = _varies(f)
    own = lambda i, j: sums[i, j] / f.n - sums[-1, i] / f.n * sums[-1, j] / f.n - (i == j)
    return max((abs(own(i, j)) for i, j in sums if i >= 0 and varies[i] and varies[j]), default=0.0)


def deviations(f: Fit, x: np.ndarray) -> np.ndarray:
    """Exact sums of ``(n x - S) ** 2``, up to the largest long."""
    y, offset = x - f.centre, f.offset
    if x.shape[1] * (f.n * f.spread + max(map(abs, offset))) ** 2 > LONGEST:
        y = y.astype(object)
        return np.array([min(int(v), LONGEST) for v in ((f.n * y - np.array(offset, object)) ** 2).sum(axis=1)], np.int64)
    return ((f.n * y - np.array(offset, np.int64)) ** 2).sum(axis=1)


def _components(fits: dict[int, Fit], components: int, batch: pa.RecordBatch) -> dict:
    out: dict[str, list] = {k: [] for k in ("at", "component", "n", "deviation", "whitened", "explained", "identity_error")}
    for dim, rows, x in _by_length(batch):
        f = fits[dim]
        k = min(components, dim)
        share = np.where(_varies(f), f.values, 0)[:k] / (f.values.sum() or 1.0)
        out["at"].append(np.repeat(rows, k))
        out["component"].append(np.tile(np.arange(1, k + 1, dtype=np.int32), len(rows)))
        out["n"].append(np.full(len(rows) * k, f.n))
        out["deviation"].append(np.repeat(deviations(f, x), k))
        out["whitened"].append(whitened(f, x, k).ravel())
        out["explained"].append(np.tile(share, len(rows)))
        out["identity_error"].append(np.full(len(rows) * k, f.error))
    kinds = {"component": np.int32, "whitened": float, "explained": float, "identity_error": float}
    columns = {k: pa.array(np.concatenate([*v, np.zeros(0, kinds.get(k, np.int64))])) for k, v in out.items()}
    return columns | {"vec_id": batch.column("vec_id").take(columns["at"])}


def _whole_rows(fits: dict[int, Fit], components: int, batch: pa.RecordBatch) -> dict:
    found = [np.zeros(0)] * batch.num_rows
    for dim, rows, x in _by_length(batch):
        for at, w in zip(rows, whitened(fits[dim], x, components)):
            found[at] = w
    return {"vec_id": batch.column("vec_id"), "whitened": pa.array(found, pa.list_(pa.float64()))}


def whiten(embeddings: DataFrame, components: int = 32) -> DataFrame:
    """(vec_id, whitened): the first ``components`` whitened components of every usable row."""
    rows = usable(embeddings)
    return map_batches(rows, partial(_whole_rows, fit(embeddings, components), components), f"vec_id {_id_type(rows)}, whitened array<double>")


def whitened_components(embeddings: DataFrame, components: int = 32) -> DataFrame:
    """One row per usable row and component: vec_id, component, n, deviation, whitened, explained, identity_error."""
    rows = usable(embeddings)
    schema = f"vec_id {_id_type(rows)}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    return map_batches(rows, partial(_components, fit(embeddings, components), components), schema)


def _id_type(rows: DataFrame) -> str:
    return rows.schema["vec_id"].dataType.simpleString()
