"""Whitening of embeddings by Chebyshev-filtered subspace iteration.

The covariance matrix is never formed.  Vectors are written once, as blocks of
integers with their ids; a pass over the blocks gives X'(XQ) of the centred
vectors for a block Q of directions, added up by Spark.  A polynomial of
degree ``DEGREE`` by the three-term recurrence, one pass a degree, damps the
spectrum below the wanted part; QR and a Rayleigh-Ritz step follow.  One
further column of each pass runs a Lanczos recurrence, whose smallest Ritz
value less its residual tells where the unwanted spectrum begins.

It ends when every wanted pair's residual is at the level of rounding (or
three rounds no longer lower it and it is below ``TOLERANCE``) and a round
with fresh random directions in place of the unwanted ones finds the same
pairs; reaching ``MAX_PASSES`` is an error, not a result.

Passes are maps over blocks; what is added up and sent to the driver is
dimensions x directions, whatever the number of rows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pathwise.llm.common import bounded_batches, stage

SCALE, SHIFT = 1024, 100_000
#: Directions of the subspace for 8 components; the further ones speed it up.
SUBSPACE = 32
DEGREE, MAX_PASSES = 10, 600
#: Residual of a certified pair, as a share of the largest eigenvalue.
TOLERANCE, ROUNDING = 1e-9, 4e-15
#: Numbers in a block.
BLOCK = 1 << 18
#: Bytes of vectors in a written file, where there are more than the cluster has cores.
FILE_BYTES = 64 << 20
_INT64 = 2 ** 63


def _blocks(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """vec_ids, no_id, x of up to BLOCK / d vectors, d, and largest |x|."""
    v = F.col("v")
    usable = df.select(F.col(id_col).cast("bigint").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v")
                       ).filter(v.isNotNull() & (F.size(v) > 0) & F.forall(
                           v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < 2.0 ** 52)))
    lengths = usable.groupBy(F.size("v").alias("d")).agg(F.count(F.lit(1)).alias("n"))
    first = lengths.orderBy(F.desc("n"), F.desc("d")).limit(1).collect()
    d, n = (first[0]["d"], first[0]["n"]) if first else (0, 0)
    schema = pa.schema([("ids", pa.binary()), ("no_id", pa.binary()), ("x", pa.binary()), ("largest", pa.int64())])
    most = max(1, BLOCK // max(d, 1))

    def run(batches):
        ids: list[np.ndarray] = []
        missing: list[np.ndarray] = []
        xs: list[np.ndarray] = []
        held = 0

        def block():
            x = np.concatenate(xs)
            return pa.RecordBatch.from_arrays(
                [pa.array([np.concatenate(ids).tobytes()]), pa.array([np.concatenate(missing).tobytes()]),
                 pa.array([x.tobytes()]), pa.array([int(np.abs(x).max())], pa.int64())], schema=schema)

        for b in batches:
            own = b.column(0)
            vectors = b.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, d)
            for lo in range(0, len(vectors), most):
                part = own.slice(lo, most)
                ids.append(part.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64))
                missing.append(part.is_null().to_numpy(zero_copy_only=False))
                xs.append(np.floor(SCALE * vectors[lo:lo + most]).astype(np.int64) + SHIFT)
                held += len(part)
                if held >= most:
                    yield block()
                    ids, missing, xs, held = [], [], [], 0
        if held:
            yield block()

    # every pass has a task for each file at least: as many as keep the cluster busy
    files = max(df.sparkSession.sparkContext.defaultParallelism, 8 * n * d // FILE_BYTES)
    rows = usable.filter(F.size("v") == d).coalesce(files)
    return stage(rows.mapInArrow(run, "ids binary, no_id binary, x binary, largest bigint")
                 .withColumn("d", F.lit(d)), "whitening-blocks")


class Centred:
    """The centred vectors as blocks: sums, passes and outputs over them."""

    def __init__(self, blocks: DataFrame):
        self.blocks = blocks
        first = blocks.agg(F.max("d").alias("d"), F.max("largest").alias("largest")).first()
        self.d, self.largest = first["d"] or 0, first["largest"] or 0
        self.n, self.sums = 0, np.zeros(0, object)
        if self.d:
            d = self.d

            def add(x):
                high, low = x >> 32, x & 0xFFFFFFFF  # sums of halves can't overflow
                return np.concatenate([[len(x)], high.sum(0), low.sum(0)]).astype(np.int64)

            total = self._total(add, 2 * d + 1, exact=True)
            self.n = int(total[0])
            self.sums = np.array([(int(h) << 32) + int(w) for h, w in zip(total[1:d + 1], total[d + 1:])], object)
            self.short = 2 * self.n * (self.largest + 1) < _INT64

    def _total(self, fn, size: int, exact: bool = False) -> np.ndarray:
        """Sum over all blocks of ``fn(x)``, an array of ``size`` numbers: added
        up in each task, then by Spark, position range by position range."""
        d, kind = self.d, np.int64 if exact else np.float64
        arrow, ddl = (pa.int64(), "bigint") if exact else (pa.float64(), "double")
        width = 1 << 15
        schema = pa.schema([("part", pa.int32()), ("v", pa.list_(arrow))])

        def run(batches):
            total = np.zeros(size, kind)
            for b in batches:
                for x in b.column(0).to_pylist():
                    total += fn(np.frombuffer(x, np.int64).reshape(-1, d))
            cuts = list(range(0, size, width))
            yield pa.RecordBatch.from_arrays([pa.array(range(len(cuts)), pa.int32()),
                                              pa.array([total[c:c + width] for c in cuts], pa.list_(arrow))], schema=schema)

        def add(batches):
            totals: dict[int, np.ndarray] = {}
            for b in batches:
                for part, v in zip(b.column(0).to_pylist(), b.column(1)):
                    v = v.values.to_numpy()
                    totals[part] = totals[part] + v if part in totals else v
            yield pa.RecordBatch.from_arrays([pa.array(list(totals), pa.int32()),
                                              pa.array(list(totals.values()), pa.list_(arrow))], schema=schema)

        parts = -(-size // width)
        rows = self.blocks.select("x").mapInArrow(run, f"part int, v array<{ddl}>")
        rows = (rows.repartition(parts, "part") if parts > 1 else rows.repartition(1)).mapInArrow(add, f"part int, v array<{ddl}>").collect()
        out = np.zeros(size, kind)
        for r in rows:
            out[r["part"] * width:r["part"] * width + len(r["v"])] += np.array(r["v"], kind)
        return out

    def centre(self):
        """x to n x - S (exact), and to x - S / n in doubles."""
        n, sums, short = self.n, self.sums, self.short
        whole = sums.astype(np.int64) if short else None

        def numerators(x):
            return n * x - whole if short else n * x.astype(object) - sums

        return numerators, lambda x: numerators(x).astype(np.float64) / n

    def apply(self, q: np.ndarray) -> np.ndarray:
        """Covariance times ``q``: one pass."""
        _, centred = self.centre()

        def fn(x):
            c = centred(x)
            return (c.T @ (c @ q)).ravel()

        return self._total(fn, self.d * q.shape[1]).reshape(q.shape) / self.n

    def trace(self) -> float:
        _, centred = self.centre()
        return float(self._total(lambda x: np.array([(centred(x) ** 2).sum()]), 1)[0]) / self.n

    def identity_error(self, w: np.ndarray) -> float:
        """Largest entry of the projected vectors' covariance less the identity."""
        _, centred = self.centre()
        k = w.shape[1]

        def fn(x):
            p = centred(x) @ w
            return (p.T @ p).ravel()

        return float(np.abs(self._total(fn, k * k).reshape(k, k) / self.n - np.eye(k)).max())

    def project(self, w: np.ndarray) -> DataFrame:
        """vec_id, component, deviation, whitened: a row per vector and column of ``w``."""
        numerators, centred = self.centre()
        d, k = self.d, w.shape[1]
        safe = self.short and d * (2 * self.n * (self.largest + 1)) ** 2 < _INT64
        schema = pa.schema([("vec_id", pa.int64()), ("component", pa.int32()), ("deviation", pa.int64()),
                            ("whitened", pa.float64())])

        def deviations(x):
            num = numerators(x)
            if safe:
                return (num * num).sum(1).tolist()
            low, high = np.abs(num).max(initial=0), math.isqrt((_INT64 - 1) // d)
            if low <= high:
                return (num * num).sum(1).tolist()
            exact = (num.astype(object) ** 2).sum(1)
            return [int(v) if v < _INT64 else None for v in exact]

        def run(batches):
            for b in batches:
                for ids, no_id, x in zip(*(c.to_pylist() for c in b.columns)):
                    x = np.frombuffer(x, np.int64).reshape(-1, d)
                    p = centred(x) @ w
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.repeat(np.frombuffer(ids, np.int64), k), mask=np.repeat(np.frombuffer(no_id, bool), k)),
                         pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                         pa.array([v for v in deviations(x) for _ in range(k)], pa.int64()), pa.array(p.ravel())],
                        schema=schema)

        return self.blocks.select("ids", "no_id", "x").mapInArrow(
            run, "vec_id bigint, component int, deviation bigint, whitened double")


def _ritz(q: np.ndarray, vq: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ritz values falling, vectors, and residual norms, from Q and VQ."""
    h = q.T @ vq
    e, u = np.linalg.eigh((h + h.T) / 2)
    e, u = e[::-1], u[:, ::-1]
    return e, q @ u, np.linalg.norm(vq @ u - (q @ u) * e, axis=0)


def principal_axes(data: Centred, components: int = 8, seed: int = 1) -> tuple[np.ndarray, np.ndarray, int]:
    """Eigenvalues (falling), unit eigenvectors as columns, passes made."""
    d = data.d
    wanted = min(components, d)
    size = min(d, max(SUBSPACE, 2 * wanted))
    rng = np.random.default_rng(seed)
    q = np.linalg.qr(rng.standard_normal((d, size)))[0]
    # the Lanczos column: basis, diagonal and off-diagonal of its matrix
    basis, alpha, beta = [q[:, 0] / np.linalg.norm(q[:, 0])], [], []
    passes = 0

    def cov(y: np.ndarray) -> np.ndarray:
        nonlocal passes
        if passes >= MAX_PASSES:
            raise RuntimeError("whitening: eigenvectors did not settle")
        passes += 1
        grows = len(alpha) < min(2 * DEGREE, d) and len(basis) > len(alpha)
        out = data.apply(np.column_stack([y, basis[-1]]) if grows else y)
        if grows:
            w, out = out[:, -1], out[:, :-1]
            alpha.append(float(basis[-1] @ w))
            for _ in range(2):
                for b in basis:
                    w = w - (b @ w) * b
            beta.append(float(np.linalg.norm(w)))
            if beta[-1] > 1e-9 * abs(alpha[0]):
                basis.append(w / beta[-1])
        return out

    def lower_end() -> float:
        """Below all of the spectrum, as far as the Lanczos column tells."""
        t = np.diag(alpha) + np.diag(beta[:len(alpha) - 1], 1) + np.diag(beta[:len(alpha) - 1], -1)
        e, u = np.linalg.eigh(t)
        return max(0.0, float(e[0]) - beta[len(alpha) - 1])

    def filtered(x: np.ndarray, low: float, high: float, top: float) -> np.ndarray:
        """The polynomial that is small on [low, high] and grows above, scaled
        to 1 at ``top``, applied to ``x``."""
        half, mid = (high - low) / 2, (high + low) / 2
        scale = half / (top - mid)
        first = scale
        y = (cov(x) - mid * x) * (scale / half)
        for _ in range(DEGREE - 1):
            after = 1 / (2 / first - scale)
            x, y = y, 2 * (after / half) * (cov(y) - mid * y) - scale * after * x
            scale = after
        return y

    e, x, residual = _ritz(q, cov(q))
    best, stale, certified, known = math.inf, 0, d == size, None
    while True:
        worst = float(residual[:wanted].max()) / max(e[0], 1e-300)
        settled = e[0] <= 0 or worst <= ROUNDING * math.sqrt(d)
        stale = 0 if worst < 0.5 * best else stale + 1
        best = min(best, worst)
        if settled or stale >= 3 and best <= TOLERANCE:
            if certified or known is not None and np.allclose(known, e[:wanted], rtol=0, atol=1e-12 * e[0] + 0.0):
                return e[:wanted], x[:, :wanted], passes
            # once more with fresh directions: is anything above them missed?
            known = e[:wanted].copy()
            fresh = rng.standard_normal((d, size - wanted))
            for _ in range(2):
                fresh -= x[:, :wanted] @ (x[:, :wanted].T @ fresh)
            x = np.column_stack([x[:, :wanted], fresh / np.linalg.norm(fresh, axis=0)])
            best, stale = math.inf, 0
        low, high = lower_end(), float(max(e[-1], 0.0))
        high = max(high, low + 1e-6 * float(e[0]))
        if high >= e[0]:  # all directions alike
            high, low = 0.5 * float(e[0]), 0.0
        q = np.linalg.qr(filtered(x, low, high, float(e[0])))[0]
        e, x, residual = _ritz(q, cov(q))


def whiten(df: DataFrame, components: int = 8, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error:
    a row for each vector and principal component.

    An entry c counts as floor(1024 c) + 100000.  Rows whose vector is null,
    empty, or holds a null, a non-finite entry or one of 2^52 or more are
    dropped, and so are vectors that are not of the most frequent length (of
    equally frequent ones the greatest).  Components whose variance is zero up to rounding have no
    rows, so one vector alone, or equal ones, give none.  ``deviation`` is
    null where it exceeds a long.  Null and repeated ids are kept, row for row;
    other columns are ignored.
    """
    spark = df.sparkSession
    bounded_batches(spark)
    data = Centred(_blocks(df, id_col, vector_col))
    ddl = ("vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, "
           "identity_error double")
    if not data.n:
        return spark.createDataFrame([], ddl)
    trace = data.trace()
    if trace <= 0:
        return spark.createDataFrame([], ddl)
    e, axes, _ = principal_axes(data, components)
    held = e > 1e-13 * data.d * trace
    e, axes = e[held], axes[:, held]
    w = axes / np.sqrt(e)
    error = data.identity_error(w)
    share = F.element_at(F.array(*[F.lit(float(v / trace)) for v in e]), F.col("component"))
    return (data.project(w).withColumn("n", F.lit(data.n).cast("bigint")).withColumn("explained", share)
            .withColumn("identity_error", F.lit(error))
            .select("vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"))
