"""Principal components and whitening of embeddings by Golub-Kahan-Lanczos bidiagonalisation.

The rows are never gathered.  Each step of the bidiagonalisation is one distributed pass
over the centred rows ``A`` (n x d): every row takes its product with a d-vector ``q``
(``A q``, the left vector's entry of that row) and adds the row times that product to a
sum (``A^T (A q)``).  Left vectors are kept as ``u_j = A q_j`` by their d-vectors ``q_j``
and ``g_j = A^T u_j``, so full reorthogonalisation of both sides is work of the driver on
d-vectors: ``<A q, u_j> = q . g_j``.  After ``k`` steps the small upper bidiagonal ``B``
(alphas on the diagonal, betas above) has the singular values of ``A`` that have
converged; its right singular vectors turned by the ``v`` vectors are the components,
and ``e = sigma^2 / n`` the eigenvalues of the covariance.

A step breaks down when the Krylov space is spent (a beta of nearly 0: an eigenvalue of
several vectors, or the rank is reached); the next ``v`` is then a new random vector
orthogonal to all before, and ``B`` falls into blocks.  The steps end when the leading
components have converged (``beta * |last entry|`` below ``TOLERANCE`` of the largest
singular value) or after ``d`` steps, when the decomposition is exact.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkloom.scratch import written

#: Components returned at most.
COMPONENTS = 8
SCALE = 1024
OFFSET = 100_000
#: A Ritz value is taken as converged below this residual, relative to the largest.
TOLERANCE = 1e-13
_SEED = 20_240_601


def _valid(vector: F.Column) -> F.Column:
    finite = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != F.lit(float("inf"))))
    return vector.isNotNull() & finite


def fit_rows(embeddings: DataFrame, column: str = "embedding") -> tuple[DataFrame, int, np.ndarray]:
    """``vec_id, x`` of the fit list, its size ``n`` and per-dimension sums ``S`` (exact).

    Dropped: vectors that are NULL, hold a NULL, NaN or infinite entry, or are shorter
    than the longest valid one (an empty table gives n = 0).  Repeated rows stay, each
    counts.  Entries become ``floor(1024 * c) + 100000`` as long.
    """
    valid = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col(column).alias("c")).where(_valid(F.col("c")))
    x = F.transform("c", lambda c: F.floor(c.cast("double") * SCALE).cast("long") + OFFSET)
    valid = valid.select("vec_id", x.alias("x"))
    d = valid.agg(F.max(F.size("x"))).first()[0] or 0
    rows = written(valid.where(F.size("x") == d), "fit-rows")
    sums = rows.select(F.posexplode("x").alias("dim", "v")).groupBy("dim").agg(F.sum("v").alias("s"))
    found = {r["dim"]: r["s"] for r in sums.collect()}  # d rows
    n = rows.count()
    return rows, n, np.array([found.get(i, 0) for i in range(d)], dtype=object)


def _gram_step(rows: DataFrame, n: int, sums: np.ndarray, q: np.ndarray) -> np.ndarray:
    """``A^T (A q)`` over the centred rows: one pass, partial sums of each task to the driver."""
    total = np.array(sums, float)

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros(len(q))
        for batch in batches:
            x = batch.column("x")
            if not len(x):
                continue
            flat = x.values.to_numpy(zero_copy_only=False).reshape(len(x), len(q)).astype(float)
            centred = flat - total / n
            found += centred.T @ (centred @ q)
        yield pa.RecordBatch.from_arrays([pa.array([found.tolist()], pa.list_(pa.float64()))], ["g"])

    parts = rows.select("x").mapInArrow(step, "g array<double>").collect()  # one row per task
    return np.sum([np.array(p["g"]) for p in parts], 0) if parts else np.zeros(len(q))


def _orthogonal(vector: np.ndarray, basis: list[np.ndarray]) -> np.ndarray:
    for _ in range(2):
        for b in basis:
            vector = vector - (vector @ b) * b
    return vector


def components(rows: DataFrame, n: int, sums: np.ndarray, most: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray, int]:
    """Eigenvalues ``e`` (falling) and unit eigenvectors (columns) of the covariance; steps taken.

    Only eigenvalues above ``TOLERANCE`` times the largest come back, ``most`` at most.
    """
    d = len(sums)
    if n < 2 or d == 0:
        return np.zeros(0), np.zeros((d, 0)), 0
    random = np.random.default_rng(_SEED)
    vs: list[np.ndarray] = []  # right vectors
    qs: list[np.ndarray] = []  # u_j = A q_j
    gs: list[np.ndarray] = []  # g_j = A^T u_j
    alphas: list[float] = []
    betas: list[float] = []  # betas[j] couples v_j and v_{j+1}; 0 between blocks
    v = None
    scale = 0.0
    while len(vs) < d:
        if v is None:  # a new block
            v = _orthogonal(random.standard_normal(d), vs)
            v = v / np.linalg.norm(v)
            raw = v.copy()
            if betas:
                betas[-1] = 0.0
        else:
            raw = v - betas[-1] * qs[-1]
        vs.append(v)
        raw = raw - sum(((raw @ g) * q for q, g in zip(qs, gs, strict=True)), np.zeros(d))
        raw = raw - sum(((raw @ g) * q for q, g in zip(qs, gs, strict=True)), np.zeros(d))
        h = _gram_step(rows, n, sums, raw)
        alpha = float(np.sqrt(max(raw @ h, 0.0)))
        scale = max(scale, alpha)
        if alpha <= 1e-12 * max(scale, 1e-300):  # v lies in the null space
            alphas.append(0.0)
            betas.append(0.0)
            qs.append(np.zeros(d))
            gs.append(np.zeros(d))
            v = None
            continue
        qs.append(raw / alpha)
        gs.append(h / alpha)
        alphas.append(alpha)
        r = _orthogonal(gs[-1] - alpha * v, vs)
        beta = float(np.linalg.norm(r))
        betas.append(beta)
        values, _, done = _ritz(alphas, betas, most)
        scale = max(scale, values[0] if len(values) else 0.0)
        if done or len(vs) == d:
            break
        v = r / beta if beta > 1e-12 * scale else None
    values, right, _ = _ritz(alphas, betas, most)
    keep = values > np.sqrt(TOLERANCE) * max(values[0] if len(values) else 0.0, 1e-300)
    vectors = np.stack(vs, 1) @ right[:, keep] if keep.any() else np.zeros((d, 0))
    return values[keep] ** 2 / n, vectors, len(vs)


def _ritz(alphas: list[float], betas: list[float], most: int) -> tuple[np.ndarray, np.ndarray, bool]:
    """Leading singular values of the bidiagonal, right vectors, and whether they converged."""
    k = len(alphas)
    bidiagonal = np.diag(alphas) + np.diag(betas[:-1], 1)
    left, values, right_t = np.linalg.svd(bidiagonal)
    want = min(most, k)
    residual = abs(betas[-1]) * np.abs(left[-1, :want])
    done = len(values) > 0 and values[0] > 0 and bool(np.all(residual <= TOLERANCE * values[0])) and want == most
    return values[:want], right_t[:want].T, done


def whiten(embeddings: DataFrame, most: int = COMPONENTS, column: str = "embedding") -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error`` of every fit row.

    One row for each kept vector (see ``fit_rows``) and each component 1..``most`` of
    nonzero eigenvalue: none for an empty table, a single row or vectors that are all
    equal.  ``deviation`` is the exact sum over dimensions of ``(n*x - S)^2`` (decimal,
    then long; an overflow fails).  ``whitened`` is the centred row on the component over
    ``sqrt(e)``; ``explained`` is ``e / trace``; ``identity_error`` is one value for all
    rows: the largest entry of the covariance of ``whitened`` minus the identity,
    measured by a further pass.  Signs of components are those of the decomposition.
    Columns of ``embeddings`` other than ``vec_id`` and the vectors are not carried.
    """
    rows, n, sums = fit_rows(embeddings, column)
    values, vectors, _ = components(rows, n, sums, most)
    spark = embeddings.sparkSession
    if not len(values):
        schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
        return spark.createDataFrame([], schema)
    s = [int(v) for v in sums]
    deviation = F.aggregate(
        F.zip_with("x", F.array(*(F.lit(v) for v in s)), lambda a, b: (a.cast("decimal(38,0)") * n - b.cast("decimal(38,0)"))),
        F.lit(0).cast("decimal(38,0)"),
        lambda acc, e: acc + e * e,
    )
    rows = rows.select("vec_id", "x", deviation.alias("dev"))
    trace_num = rows.agg(F.sum("dev")).first()[0]
    trace = float(trace_num) / float(n) ** 3
    mean = np.array(s, float) / n
    scale = vectors / np.sqrt(values)

    def project(x: pa.Array) -> np.ndarray:
        flat = x.values.to_numpy(zero_copy_only=False).reshape(len(x), len(s)).astype(float)
        return (flat - mean) @ scale

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        outer, first = np.zeros((scale.shape[1],) * 2), np.zeros(scale.shape[1])
        for batch in batches:
            if batch.num_rows:
                w = project(batch.column("x"))
                outer += w.T @ w
                first += w.sum(0)
        yield pa.RecordBatch.from_arrays([pa.array([outer.ravel().tolist()]), pa.array([first.tolist()])], ["o", "f"])

    parts = rows.select("x").mapInArrow(moments, "o array<double>, f array<double>").collect()  # one row per task
    outer = np.sum([np.array(p["o"]) for p in parts], 0).reshape(scale.shape[1], -1)
    first = np.sum([np.array(p["f"]) for p in parts], 0)
    covariance = outer / n - np.outer(first / n, first / n)
    identity_error = float(np.abs(covariance - np.eye(len(values))).max())
    explained = (values / trace).tolist()

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(values)
        for batch in batches:
            if not batch.num_rows:
                continue
            w = project(batch.column("x"))
            m = batch.num_rows
            each = pa.array(np.repeat(np.arange(m), k))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("vec_id").take(each),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                    pa.array(np.full(m * k, n, np.int64)),
                    batch.column("deviation").take(each),
                    pa.array(w.ravel()),
                    pa.array(np.tile(np.array(explained), m)),
                    pa.array(np.full(m * k, identity_error)),
                ],
                ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    return rows.select("vec_id", "x", F.col("dev").cast("long").alias("deviation")).mapInArrow(emit, schema)
