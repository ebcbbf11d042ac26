"""Embedding whitening by a Jacobi-Davidson eigensolver (operator 12).

Vectors become integers, x = floor(256 * c). The covariance of the distinct
integer vectors (the fit list, n of them with sums S) is never formed: the
solver only asks for products of the centred list with a few directions. Each
product is one Spark job over the list: every task adds up ``X^T (X U)`` of its
centred rows, and the partial sums (a few numbers a dimension) are summed by
Spark.

* Rayleigh-Ritz: the operator on the span of the directions so far gives Ritz
  pairs, the largest ``components`` of them are wanted;
* a pair whose residual is below ``TOLERANCE`` times the trace (rounding level
  of a product) is locked, and everything later is kept orthogonal to it;
* for the others the projected correction equation
  (I - QQ')(V - eI)(I - QQ') t = -r, Q the locked vectors and the pair's own, is
  solved loosely by MINRES; the systems of all open pairs advance together, so a
  step of all costs one product;
* the corrections join the span, which is cut back to its best Ritz vectors
  when it has grown to ``SPAN`` directions.

Components whose eigenvalue is not above rounding level have no whitened
coordinate and are left out, so there may be fewer than asked for.

Sums, n and deviations are integers of any size; ``deviation`` is null where it
passes 64 bits. Directions are signed so that their largest entry is positive.

Defined cases: rows whose vector is null, empty, or holds null or non-finite
entries are dropped, and so are those with an entry whose x passes 64 bits and
those whose length isn't the commonest (the longer of equally common ones);
an empty table, or one without two different vectors, gives no rows; equal
rows each get their row of results but count once in the fit; equal
eigenvalues may come with any basis of their space. Other columns, whatever
their names, are not read; a null vec_id is an id like others.
"""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grist.llm.common import materialize

COMPONENTS = 4
SCALE = 256
TOLERANCE = 2e-14           # residual norm, as a share of the trace
INNER_STEPS = 4             # MINRES steps of one correction, at most
INNER_REDUCTION = 0.1
SPAN, KEPT = 48, 24         # directions before and after a restart
MAX_ROUNDS = 200
BLOCK = 4096                # rows that a task multiplies at once


def integers(vector: Column) -> Column:
    """floor(SCALE * c) of each entry as a long."""
    return F.transform(vector, lambda c: F.floor(c.cast("double") * SCALE).cast("bigint"))


def usable(vector: Column) -> Column:
    """Not null or empty, and all entries finite with an x of 64 bits."""
    limit = 2.0 ** 63 / SCALE
    fine = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) < limit))
    return vector.isNotNull() & (F.size(vector) > 0) & fine


def prepared(df: DataFrame, id_col: str, vector: str) -> DataFrame:
    """(id, x) of the rows that take part."""
    good = (df.select(F.col(id_col).alias("id"), F.when(usable(F.col(vector)), F.col(vector)).alias("v"))
            .filter("v is not null").select("id", integers(F.col("v")).alias("x")))
    lengths = good.groupBy(F.size("x").alias("d")).agg(F.count(F.lit(1)).alias("m"))
    common = lengths.orderBy(F.desc("m"), F.desc("d")).first()
    return good.filter(F.size("x") == (common["d"] if common else 0))


def matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, width)


def blocks(batches, width: int):
    """Integer rows from the first column of small batches, at most about ``BLOCK`` at once."""
    held, n = [], 0
    for batch in batches:
        if batch.num_rows:
            held.append(matrix(batch.column(0), width))
            n += batch.num_rows
        if n >= BLOCK:
            yield np.concatenate(held)
            held, n = [], 0
    if n:
        yield np.concatenate(held)


@dataclass
class Moments:
    """Exact figures of the fit list."""
    n: int
    sums: list[int]
    squares: list[int]

    @property
    def trace(self) -> float:
        """Sum of the variances: (n * squares - sums ** 2) / n ** 2, rounded once."""
        return sum(self.n * q - s * s for s, q in zip(self.sums, self.squares)) / (self.n * self.n)

    def scaled(self, x: np.ndarray) -> np.ndarray:
        """n * x - S, exact: 64-bit numbers where they suffice, Python's otherwise."""
        most = max(int(np.abs(x).max(initial=0)), 1) * self.n + max(map(abs, self.sums))
        kind = np.int64 if most < 2 ** 62 else object
        return x.astype(kind) * self.n - np.array(self.sums, dtype=kind)

    def centred(self, x: np.ndarray) -> np.ndarray:
        return self.scaled(x).astype(np.float64) / self.n


def moments(fit: DataFrame, width: int) -> Moments:
    """One pass over the fit list; sums as decimals, so that none overflows."""
    def run(batches):
        n, s, q = 0, np.zeros(width, object), np.zeros(width, object)
        for x in blocks(batches, width):
            big = int(np.abs(x).max()) ** 2 * len(x) >= 2 ** 62
            x = x.astype(object) if big else x
            n, s, q = n + len(x), s + x.sum(0), q + (x * x).sum(0)
        if n:
            decimals = lambda v: pa.array([Decimal(int(i)) for i in v], pa.decimal128(38, 0))
            yield pa.RecordBatch.from_arrays([pa.array(range(width), pa.int32()), pa.array([n] * width, pa.int64()), decimals(s), decimals(q)],
                                             names=["d", "n", "s", "q"])

    rows = (fit.mapInArrow(run, "d int, n long, s decimal(38,0), q decimal(38,0)").groupBy("d")
            .agg(F.sum("n").alias("n"), F.sum("s").alias("s"), F.sum("q").alias("q")).orderBy("d").collect())    # one row a dimension
    return Moments(rows[0]["n"], [int(r["s"]) for r in rows], [int(r["q"]) for r in rows])


class Covariance:
    """The covariance of a list of integer vectors as a product with directions."""

    def __init__(self, fit: DataFrame, width: int):
        self.fit, self.width, self.products = fit, width, 0
        self.moments = moments(fit, width)

    def __matmul__(self, u: np.ndarray) -> np.ndarray:
        """V U for a (width, b) array: one job, its result b numbers a dimension."""
        own, width, b = self.moments, self.width, u.shape[1]

        def run(batches):
            total = np.zeros((width, b))
            for x in blocks(batches, width):
                c = own.centred(x)
                total += c.T @ (c @ u)
            at = np.indices((width, b)).reshape(2, -1)
            yield pa.RecordBatch.from_arrays([pa.array(at[0], pa.int32()), pa.array(at[1], pa.int32()), pa.array(total.ravel())], names=["i", "j", "v"])

        found = self.fit.mapInArrow(run, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).toArrow()
        out = np.zeros((width, b))
        out[found["i"].to_numpy(), found["j"].to_numpy()] = found["v"].to_numpy()
        self.products += 1
        return out / own.n


def orthonormal(new: np.ndarray, *bases: np.ndarray) -> np.ndarray:
    """The directions of ``new`` outside the ``bases`` (orthonormal columns), orthonormal; none for those inside."""
    out = []
    for v in new.T:
        size = np.linalg.norm(v)
        for _ in range(3):                          # twice is enough, the third costs nothing
            for q in (*bases, *[o[:, None] for o in out]):
                v = v - q @ (q.T @ v)
        left = np.linalg.norm(v)
        if left > 1e-10 * size and left > 0:
            out.append(v / left)
    return np.stack(out, 1) if out else np.zeros((len(new), 0))


class Minres:
    """One MINRES run for a symmetric system, advanced by the caller's products."""

    def __init__(self, right: np.ndarray):
        self.size = self.start = np.linalg.norm(right)
        self.x = np.zeros_like(right)
        self.v_old, self.v = np.zeros_like(right), right / self.start
        self.w_old, self.w = np.zeros_like(right), np.zeros_like(right)
        self.beta, self.eta = 0.0, self.start
        self.c_old = self.c = 1.0
        self.s_old = self.s = 0.0
        self.done = False

    def step(self, av: np.ndarray):
        """``av``: the operator applied to ``self.v``. Lanczos step, then two Givens rotations."""
        alpha = self.v @ av
        nxt = av - alpha * self.v - self.beta * self.v_old
        beta = np.linalg.norm(nxt)
        d, l2, l3 = self.c * alpha - self.c_old * self.s * self.beta, self.s * alpha + self.c_old * self.c * self.beta, self.s_old * self.beta
        l1 = np.hypot(d, beta)
        if l1 == 0:
            self.done = True
            return
        c, s = d / l1, beta / l1
        w = (self.v - l3 * self.w_old - l2 * self.w) / l1
        self.x = self.x + c * self.eta * w
        self.eta = -s * self.eta
        self.w_old, self.w = self.w, w
        self.c_old, self.c, self.s_old, self.s = self.c, c, self.s, s
        self.size *= abs(s)
        self.done = self.size <= INNER_REDUCTION * self.start or beta <= 1e-14 * self.start
        self.v_old, self.v, self.beta = self.v, nxt / beta if beta else nxt, beta


def corrections(covariance, ritz: np.ndarray, values: np.ndarray, residuals: np.ndarray, locked: np.ndarray) -> np.ndarray:
    """Approximate solutions of the correction equations of all open pairs, one product a step for all."""
    outs = [np.column_stack((locked, u)) for u in ritz.T]

    def outside(q, v):
        return v - q @ (q.T @ v)

    runs = []
    for q, r in zip(outs, residuals.T):
        right = outside(q, -r)
        runs.append(Minres(right) if np.linalg.norm(right) > 0 else None)
    for _ in range(min(INNER_STEPS, len(ritz))):
        going = [i for i, m in enumerate(runs) if m and not m.done]
        if not going:
            break
        products = covariance @ np.stack([runs[i].v for i in going], 1)
        for i, av in zip(going, products.T):
            runs[i].step(outside(outs[i], av - values[i] * runs[i].v))
    return np.stack([m.x if m else np.zeros(len(ritz)) for m in runs], 1)


def jacobi_davidson(covariance, width: int, wanted: int, trace: float, seed: int = 42) -> tuple[np.ndarray, np.ndarray]:
    """(values, vectors): the ``wanted`` largest eigenpairs, falling. ``covariance``
    needs only ``@`` with a (width, b) array."""
    wanted = min(wanted, width)
    limit = TOLERANCE * trace
    locked, found = np.zeros((width, 0)), []
    span = orthonormal(np.random.default_rng(seed).standard_normal((width, min(KEPT, width))))
    image = covariance @ span
    for _ in range(MAX_ROUNDS):
        small = span.T @ image
        values, turn = np.linalg.eigh((small + small.T) / 2)
        order = np.argsort(-values)
        values, span, image = values[order], span @ turn[:, order], image @ turn[:, order]
        open_ = wanted - len(found)
        residual = image[:, :open_] - values[:open_] * span[:, :open_]
        residual -= locked @ (locked.T @ residual)
        whole = span.shape[1] + len(found) == width             # the span is everything: the pairs are exact
        met = 0
        while met < residual.shape[1] and (np.linalg.norm(residual[:, met]) <= limit or whole):
            met += 1
        if met:                                                 # lock from the largest down
            locked = np.column_stack((locked, span[:, :met]))
            found += list(values[:met])
            span, image, values, residual = span[:, met:], image[:, met:], values[met:], residual[:, met:]
        if len(found) >= wanted:
            order = np.argsort(-np.array(found), kind="stable")
            return np.array(found)[order], locked[:, order]
        if span.shape[1] + wanted > SPAN:
            span, image = span[:, :KEPT], image[:, :KEPT]
        k = residual.shape[1]
        new = orthonormal(corrections(covariance, span[:, :k], values[:k], residual, locked), locked, span)
        if not new.shape[1]:                                    # nothing new: any other direction
            new = orthonormal(np.random.default_rng(seed + len(found)).standard_normal((width, 1)), locked, span)
        span, image = np.column_stack((span, new)), np.column_stack((image, covariance @ new))
    raise ArithmeticError(f"residuals above {limit} after {MAX_ROUNDS} rounds")


@dataclass
class Whitening:
    """A fitted whitening: exact moments, eigenvalues and directions."""
    moments: Moments
    values: np.ndarray
    vectors: np.ndarray

    @property
    def explained(self) -> np.ndarray:
        return self.values / self.moments.trace

    def coordinates(self, x: np.ndarray) -> np.ndarray:
        return self.moments.centred(x) @ self.vectors / np.sqrt(self.values)

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sum of (n x - S) ** 2, exact; None beyond 64 bits."""
        c = self.moments.scaled(x)
        if c.dtype != object and int(np.abs(c).max(initial=0)) ** 2 * c.shape[1] >= 2 ** 63:
            c = c.astype(object)
        return [v if v < 2 ** 63 else None for v in (c * c).sum(1).tolist()]


def fit_whitening(vectors: DataFrame, components: int = COMPONENTS) -> tuple[Whitening, Covariance] | None:
    """The whitening of the distinct ``x`` of ``vectors``; None where they don't vary."""
    fit = materialize(vectors.select("x").distinct(), "fit")
    first = fit.first()
    if first is None:
        return None
    covariance = Covariance(fit, len(first["x"]))
    trace = covariance.moments.trace
    if not trace > 0:
        return None
    values, directions = jacobi_davidson(covariance, covariance.width, components, trace)
    real = values > 100 * np.finfo(float).eps * trace
    values, directions = values[real], directions[:, real]
    directions = directions * np.sign(directions[np.abs(directions).argmax(0), np.arange(directions.shape[1])])
    return Whitening(covariance.moments, values, directions), covariance


def identity_error(whitening: Whitening, covariance: Covariance) -> float:
    """Largest absolute entry of the whitened fit list's covariance less the identity, from one more product."""
    scaled = whitening.vectors / np.sqrt(whitening.values)
    return float(np.abs(scaled.T @ (covariance @ scaled) - np.eye(scaled.shape[1])).max())


SCHEMA = "id {id}, component int, n long, deviation long, whitened double, explained double, identity_error double"


def whiten(df: DataFrame, id_col: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """One row for each remaining row of ``df`` and component: id, component, n,
    deviation, whitened, explained, identity_error."""
    vectors = prepared(df, id_col, vector)
    schema = SCHEMA.format(id=vectors.schema["id"].dataType.simpleString())
    fitted = fit_whitening(vectors, components)
    if fitted is None:
        return df.sparkSession.createDataFrame([], schema)
    whitening, covariance = fitted
    error, width = identity_error(whitening, covariance), covariance.width

    def run(batches):
        k = len(whitening.values)
        for batch in batches:
            m = batch.num_rows
            if m:
                x = matrix(batch.column(1), width)
                rows = pa.array(np.repeat(np.arange(m), k))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(rows), pa.array(np.tile(np.arange(1, k + 1), m), pa.int32()),
                     pa.array(np.full(m * k, whitening.moments.n)), pa.array(whitening.deviations(x), pa.int64()).take(rows),
                     pa.array(whitening.coordinates(x).ravel()), pa.array(np.tile(whitening.explained, m)), pa.array(np.full(m * k, error))],
                    names=["id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return vectors.mapInArrow(run, schema)
