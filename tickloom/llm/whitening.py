"""Embedding whitening by mixed-precision refinement of eigenvectors.

The covariance is gathered in one distributed pass: entries become whole numbers,
are centred on the whole number next to their mean and multiplied, so every sum
is exact and nothing cancels. Its eigenvectors are first found in float32 and
then corrected in extended precision by Ogita and Aishima's iteration, which is
a few matrix products a round and doubles the number of right digits. Where
eigenvalues lie closer together than the present error, the iteration cannot
tell their vectors apart; such a cluster is rotated by the eigenvectors of its
own small, shifted problem before the next correction.

Only sums of products, one number for each pair of dimensions, reach the driver.
"""

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal
from fractions import Fraction

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.session import settle

SCALE = 64
SHIFT = 1_000_000
#: Entries of larger size would have no exact whole number in a long.
LARGEST = 2.0**53
#: Facts of components that are sent to every task; with more of them rows are shuffled to meet them.
BROADCAST_ROWS = 20_000
_WIDE = np.longdouble
#: Gaps of eigenvalues, as multiples of the present error, from which on vectors are corrected one by one.
_APART = 1000
_SUMS = "dim int, i int, j int, value decimal(38, 0)"


@dataclass(frozen=True)
class Whitening:
    """What is learnt of the vectors of one length.

    ``vectors`` holds unit eigenvectors as columns, by falling eigenvalue;
    ``values`` their eigenvalues, zero where the covariance has no rank left.
    """

    dim: int
    count: int
    centre: tuple[int, ...]
    rest: tuple[int, ...]
    trace: float
    values: np.ndarray
    vectors: np.ndarray

    @property
    def components(self) -> int:
        return len(self.values)

    def project(self, x: np.ndarray) -> np.ndarray:
        """Whitened coordinates of rows of whole numbers; NaN for components without variance."""
        mean = np.array([r / self.count for r in self.rest])
        centred = (x - np.array(self.centre, dtype=np.int64)).astype(np.float64) - mean
        with np.errstate(divide="ignore", invalid="ignore"):
            return np.where(self.values > 0, centred @ self.vectors / np.sqrt(self.values), np.nan)

    def deviations(self, x: np.ndarray) -> list[Decimal]:
        """Per row the exact sum over dimensions of (count * x - sum) squared."""
        near = x - np.array(self.centre, dtype=np.int64)
        bound = self.count * int(np.abs(near).max(initial=0)) + max(map(abs, self.rest), default=0)
        if bound * bound * self.dim < 2**63:
            off = self.count * near - np.array(self.rest, dtype=np.int64)
        else:
            off = self.count * near.astype(object) - np.array(self.rest, dtype=object)
        return [Decimal(int(v)) for v in (off * off).sum(axis=1)]


def whole_numbers(vectors: DataFrame) -> DataFrame:
    """vec_id, dim, x of every vector without null or non-finite entries; x is ``floor(SCALE * c) + SHIFT``.

    Entries of 2**53 and more in size count as non-finite. Empty vectors have
    nothing to whiten and are left out.
    """
    bad = F.exists("embedding", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) >= LARGEST))
    wide = vectors.select(F.col("vec_id").cast("long").alias("vec_id"),
                          F.col("embedding").cast("array<double>").alias("embedding"))
    return wide.where(F.col("embedding").isNotNull() & ~bad & (F.size("embedding") > 0)).select(
        "vec_id", F.size("embedding").alias("dim"),
        F.transform("embedding", lambda c: F.floor(c * SCALE) + F.lit(SHIFT)).alias("x"))


def _by_length(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[int, np.ndarray]]:
    for batch in batches:
        for dim, rows in batch.groupby("dim")["x"]:
            yield int(dim), np.stack(rows.to_numpy())


def _sum_rows(sums: dict[int, np.ndarray]) -> Iterator[pd.DataFrame]:
    """Rows of ``_SUMS`` for arrays of Python integers; those of one dimension lie along ``i``."""
    for dim, total in sums.items():
        at = np.argwhere(np.triu(np.ones(total.shape, dtype=bool))) if total.ndim == 2 else np.arange(len(total))[:, None]
        yield pd.DataFrame({
            "dim": dim, "i": at[:, 0], "j": at[:, -1],
            "value": [Decimal(int(v)) for v in total[tuple(at.T)]],
        })


def _gathered(rows: DataFrame, partial) -> dict[int, dict[tuple[int, int], int]]:
    """Sums of what ``partial`` yields in every task."""
    total = rows.select("dim", "x").mapInPandas(partial, _SUMS).groupBy("dim", "i", "j").agg(F.sum("value").alias("value"))
    out: dict[int, dict[tuple[int, int], int]] = {}
    for row in total.collect():
        out.setdefault(row["dim"], {})[row["i"], row["j"]] = int(row["value"])
    return out


def _column_sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The number of rows and then the sum of every dimension."""
    sums: dict[int, np.ndarray] = {}
    for dim, x in _by_length(batches):
        own = np.concatenate([[len(x)], x.astype(object).sum(axis=0) if np.abs(x).max() > 2**40 else x.sum(axis=0)])
        sums[dim] = sums.get(dim, 0) + own.astype(object)
    yield from _sum_rows(sums)


def _products(centres: dict[int, tuple[int, ...]]):
    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[int, np.ndarray] = {}
        for dim, x in _by_length(batches):
            near = x - np.array(centres[dim], dtype=np.int64)
            # Products and sums below 2**53 are exact in doubles.
            exact = int(np.abs(near).max()) ** 2 * len(near) < 2**53
            near = near.astype(np.float64 if exact else object)
            own = near.T @ near
            sums[dim] = sums.get(dim, 0) + (own.astype(np.int64) if exact else own).astype(object)
        yield from _sum_rows(sums)

    return partial


def fit(rows: DataFrame, components: int = 32) -> dict[int, Whitening]:
    """The whitening of the vectors of each length in ``rows`` (``whole_numbers``), from all of them.

    Two passes: sums, then products of centred entries. No rows give no fit.
    """
    centres, counts, rests = {}, {}, {}
    for dim, sums in _gathered(rows, _column_sums).items():
        count, totals = sums[0, 0], [sums[i, i] for i in range(1, dim + 1)]
        centres[dim] = tuple(round(Fraction(t, count)) for t in totals)
        counts[dim], rests[dim] = count, tuple(t - count * c for t, c in zip(totals, centres[dim], strict=True))
    fits = {}
    for dim, products in _gathered(rows, _products(centres)).items():
        n, rest = counts[dim], rests[dim]
        # count**2 times the covariance, exactly.
        exact = {(i, j): n * value - rest[i] * rest[j] for (i, j), value in products.items()}
        values, vectors = eigenpairs(exact, n * n, dim)
        fits[dim] = Whitening(
            dim, n, centres[dim], rest, sum(exact[i, i] for i in range(dim)) / (n * n),
            values[:components], vectors[:, :components])
    return fits


def eigenpairs(entries: dict[tuple[int, int], int], divisor: int, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors (columns) of the symmetric matrix ``entries / divisor``.

    Eigenvalues within rounding of zero come as zero.
    """
    matrix = np.zeros((dim, dim), dtype=_WIDE)
    for (i, j), value in entries.items():
        high = value / divisor
        low = float(Fraction(value, divisor) - Fraction(high))
        matrix[i, j] = matrix[j, i] = _WIDE(high) + _WIDE(low)
    largest = np.abs(matrix).max(initial=0)
    if not largest:
        return np.zeros(dim), np.eye(dim)
    values, vectors = refine(matrix / largest)
    order = np.argsort(-values, kind="stable")
    values, vectors = values[order] * largest, vectors[:, order]
    values[values <= dim * np.finfo(np.float64).eps * values[0]] = 0
    vectors /= np.sqrt((vectors * vectors).sum(axis=0))
    return values.astype(np.float64), vectors.astype(np.float64)


def _norm(matrix: np.ndarray) -> float:
    return float(np.linalg.norm(matrix.astype(np.float64), 2))


def clusters(values: np.ndarray, error: float) -> list[np.ndarray]:
    """Positions of eigenvalues that lie within ``error`` of the next one, group by group."""
    order = np.argsort(values, kind="stable")
    cuts = np.flatnonzero(np.diff(values[order]) > error) + 1
    return np.split(order, cuts)


def refine(matrix: np.ndarray, rounds: int = 40) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues and eigenvectors of a symmetric matrix, from those in float32 on.

    With x the present vectors, ``r = 1 - x'x`` tells how far they are from
    orthogonal and ``s = x'ax`` how far from diagonal; ``x + x e`` is right in
    twice as many digits, with ``e[i, j] = (s[i, j] + v[j] r[i, j]) / (v[j] - v[i])``
    for eigenvalues apart and ``r[i, j] / 2`` for others. Stops when corrections
    no longer shrink.
    """
    size, eye = len(matrix), np.eye(len(matrix), dtype=_WIDE)
    x = np.linalg.eigh(matrix.astype(np.float32))[1].astype(_WIDE)
    scale = _norm(matrix)
    rounding = 64 * np.finfo(_WIDE).eps * scale
    before = np.inf

    def state(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        r, s = eye - x.T @ x, x.T @ matrix @ x
        s = (s + s.T) / 2
        return r, s, s.diagonal() / (1 - r.diagonal())

    def error(s: np.ndarray, r: np.ndarray) -> float:
        """First-order corrections are small where eigenvalues are this far apart."""
        return _APART * (_norm(s - np.diag(s.diagonal())) + scale * _norm(r))

    for _ in range(rounds):
        r, s, values = state(x)
        apart = np.ones((size, size), dtype=bool)
        several = [g for g in clusters(values, error(s, r)) if len(g) > 1]
        for group in several:
            inner = np.ix_(group, group)
            middle = values[group].mean()
            shifted = s[inner] - middle * (np.eye(len(group), dtype=_WIDE) - r[inner])
            if np.abs(shifted - np.diag(shifted.diagonal())).max() > rounding:
                turn = np.linalg.eigh((shifted / np.abs(shifted).max()).astype(np.float64))[1]
                x[:, group] = x[:, group] @ turn.astype(_WIDE)
        if several:
            r, s, values = state(x)
        for group in several:
            inner = np.ix_(group, group)
            apart[inner] = np.abs(values[group][:, None] - values[group][None, :]) > error(s[inner], r[inner])
        np.fill_diagonal(apart, False)
        # Pairs that are diagonal up to rounding have nothing left to be turned by.
        off = s + (values[None, :] + values[:, None]) / 2 * r
        apart &= np.abs(off) > rounding
        gaps = np.where(apart, values[None, :] - values[:, None], 1)
        e = np.where(apart, (s + values[None, :] * r) / gaps, r / 2)
        x = x + x @ e
        change = float(np.abs(e).max(initial=0))
        if change < 16 * np.finfo(_WIDE).eps or change >= before and change < 1e-12:
            break
        before = change
    return state(x)[2], x


def whiten(rows: DataFrame, fits: dict[int, Whitening]) -> DataFrame:
    """vec_id, dim, n, deviation (exact), whitened of every row of ``rows`` (``whole_numbers``).

    ``whitened`` holds a null for components without variance.
    """
    def project(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            # Ids come as text: with a null among them pandas would make them floats.
            for dim, part in batch.groupby("dim"):
                x, own = np.stack(part["x"].to_numpy()), fits[int(dim)]
                yield pd.DataFrame({
                    "vec_id": part["vec_id"].to_numpy(), "dim": dim, "n": own.count,
                    "deviation": own.deviations(x), "whitened": list(own.project(x))})

    out = rows.withColumn("vec_id", F.col("vec_id").cast("string")).mapInPandas(
        project, "vec_id string, dim int, n long, deviation decimal(38, 0), whitened array<double>")
    out = out.withColumn("vec_id", F.col("vec_id").cast("long"))
    if all((own.values > 0).all() for own in fits.values()):
        return out
    return out.withColumn("whitened", F.transform("whitened", lambda v: F.nanvl(v, F.lit(None).cast("double"))))


def identity_errors(whitened: DataFrame) -> dict[int, float]:
    """Per length of vectors the largest entry by which the covariance of all whitened rows differs from the identity.

    Components without variance are not counted.
    """
    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for dim, part in batch.groupby("dim"):
                rows = np.stack([np.array(w, dtype=np.float64) for w in part["whitened"]])
                wide = np.column_stack([np.ones(len(rows)), rows])
                sums[int(dim)] = sums.get(int(dim), 0) + wide.T @ wide
        for dim, total in sums.items():
            at = np.argwhere(np.triu(np.ones(total.shape, dtype=bool)))
            yield pd.DataFrame({"dim": dim, "i": at[:, 0], "j": at[:, 1], "value": total[tuple(at.T)]})

    found = whitened.select("dim", "whitened").mapInPandas(partial, "dim int, i int, j int, value double")
    total: dict[int, dict[tuple[int, int], float]] = {}
    for row in found.groupBy("dim", "i", "j").agg(F.sum("value").alias("value")).collect():
        total.setdefault(row["dim"], {})[row["i"], row["j"]] = row["value"]
    errors = {}
    for dim, sums in total.items():
        n = sums[0, 0]
        errors[dim] = max((
            abs(value / n - sums[0, i] / n * (sums[0, j] / n) - (i == j))
            for (i, j), value in sums.items() if i and value is not None), default=0.0)
    return errors


def whitened_rows(vectors: DataFrame, components: int = 32) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error: a row for each vector and component.

    ``vectors``: vec_id, embedding; other columns are left out. Vectors of
    different lengths are whitened apart, each from the vectors of its length,
    with as many components as they have entries at most. Repeated rows count
    and come out as often as they are there; a null vec_id is kept. A component
    without variance has a null in ``whitened``. An empty table gives no rows.
    """
    spark = vectors.sparkSession
    rows = settle(whole_numbers(vectors), "whole-numbers")
    fits = fit(rows, components)
    done = settle(whiten(rows, fits), "whitened")
    errors = identity_errors(done)
    facts = spark.createDataFrame(
        [(dim, k, float(value / own.trace) if own.trace else 0.0, float(errors.get(dim, 0.0)))
         for dim, own in fits.items() for k, value in enumerate(own.values)],
        "dim int, pos int, explained double, identity_error double")
    if len(fits) * components <= BROADCAST_ROWS:
        facts = F.broadcast(facts)
    return (
        done.select("vec_id", "dim", "n", "deviation", F.posexplode("whitened").alias("pos", "whitened"))
        .join(facts, ["dim", "pos"])
        .select("vec_id", (F.col("pos") + 1).alias("component"), "n", "deviation", "whitened", "explained", "identity_error")
    )
