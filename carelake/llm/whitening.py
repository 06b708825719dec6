"""Whitening of embeddings by a weighted covariance over distinct vectors.

Vectors become integer codes x.  Identical codes are grouped, with their counts.  Counts (or one for each distinct vector)
are the weights of the fit: exact weighted sums first, then in each task one weighted matrix product of centred rows,
added up by Spark.  Each distinct vector is whitened once and joined back to the rows that hold it, so a vector that a
third of all rows repeat costs as much as any other until that join, which copies finished values only.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelake.llm.common import materialize

#: x = floor(SCALE * entry) + SHIFT.
SCALE, SHIFT = 1024, 100_000
#: Components that are returned.
COMPONENTS = 8
#: Distinct vectors in one matrix product.
BLOCK = 8192
_LONG = 2**62


@dataclass
class Model:
    """``n`` fit vectors with exact ``sums``; unit ``vectors`` (a column each) by falling ``values``; their ``trace``."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float


def coded(embeddings: DataFrame, scale: int = SCALE, shift: int = SHIFT) -> DataFrame:
    """``(vec_id, x binary)``: the codes of each vector, as little-endian 64-bit integers.

    Left out: vectors that are null, empty, or hold null or non-finite entries or entries whose code has no exact long
    (2**52 or more).
    """
    vec = embeddings.schema["vec_id"].dataType.simpleString()

    def run(batches):
        for b in batches:
            column = b.column(1)
            size = np.diff(column.offsets.to_numpy())
            values = column.values.slice(column.offsets[0].as_py(), int(size.sum())).cast(pa.float64())
            null = values.is_null().to_numpy(zero_copy_only=False)
            c = values.fill_null(0).to_numpy(zero_copy_only=False)
            with np.errstate(all="ignore"):
                x = np.floor(c * scale)
                bad = null | ~(np.abs(x) < 2.0**52)
            starts = np.r_[0, np.cumsum(size)]
            broken = np.r_[0, np.cumsum(bad)]
            keep = (size > 0) & (broken[starts[1:]] == broken[starts[:-1]])
            keep &= column.is_valid().to_numpy(zero_copy_only=False)
            raw = (np.where(bad, 0, x).astype("<i8") + shift).tobytes()
            rows = np.flatnonzero(keep)
            packed = [raw[8 * starts[i] : 8 * starts[i + 1]] for i in rows.tolist()]
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(rows)), pa.array(packed, pa.binary())], ["vec_id", "x"])

    vectors = F.col("embedding").cast("array<double>").alias("embedding")
    return embeddings.select("vec_id", vectors).mapInArrow(run, f"vec_id {vec}, x binary")


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<i8").reshape(len(column), -1)


def _blocks(batches):
    for b in batches:
        for at in range(0, b.num_rows, BLOCK):
            if (part := b.slice(at, BLOCK)).num_rows:
                yield part, _matrix(part.column(0)), part.column(1).to_numpy(zero_copy_only=False)


def _deviations(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n * x - S, exactly: as longs where these hold it, as Python integers elsewhere."""
    largest = max([int(np.abs(x).max()) * n, *(abs(s) for s in sums)])
    if 2 * largest < _LONG:
        return x * n - np.array(sums, np.int64)
    return x.astype(object) * n - np.array(sums, object)


def _squares(d: np.ndarray) -> list[int | None]:
    """Sum of squares by row, exactly; None where no long holds it."""
    if d.dtype != object and float(np.abs(d).max()) ** 2 * d.shape[1] < _LONG:
        return (d * d).sum(axis=1).tolist()
    total = (d.astype(object) ** 2).sum(axis=1)
    return [int(t) if t < 2**63 else None for t in total]


def distinct_codes(rows: DataFrame, weights: str = "count") -> DataFrame:
    """``(x, w)``: distinct codes of the table's dimension with fit weights, their ``count`` in ``rows`` or ``one``.

    The dimension is that of most rows (the smallest on a tie); vectors of another one take no part.
    """
    if weights not in ("count", "one"):
        raise ValueError("weights are 'count' or 'one'")
    found = materialize(rows.groupBy("x").agg(F.count("*").alias("w")), "distinct")
    size = F.octet_length("x")
    common = found.groupBy(size.alias("size")).agg(F.sum("w").alias("n")).orderBy(F.desc("n"), "size").first()
    found = found.where(size == (common["size"] if common else 0))
    return found if weights == "count" else found.withColumn("w", F.lit(1).cast("long"))


def fit(distinct: DataFrame) -> Model | None:
    """Weighted mean, covariance (divisor n) and its eigenvectors; None for an empty table.

    Two passes over the distinct vectors: exact sums, then products of rows centred on the exact mean.  A task returns
    one matrix; Spark adds them entry by entry.  The driver holds one matrix of the dimension's square.
    """

    def sums(batches):
        total: list[int] = []
        n = 0
        for _, x, w in _blocks(batches):
            wide = int(np.abs(x).max()) * int(w.sum()) >= _LONG
            part = (x.astype(object).T @ w.astype(object)) if wide else x.T @ w
            total = [a + int(b) for a, b in zip(total or [0] * len(part), part)]
            n += int(w.sum())
        place = [-1, *range(len(total))] if n else []
        yield pa.RecordBatch.from_arrays(
            [pa.array(place, pa.int32()), pa.array([str(v) for v in ([n, *total] if n else [])], pa.string())], ["i", "s"]
        )

    added = distinct.select("x", "w").mapInArrow(sums, "i int, s string")
    got = dict(added.groupBy("i").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).collect())
    if not got:
        return None
    n, total = int(got.pop(-1)), [int(got[i]) for i in range(len(got))]

    def products(batches):
        gram = None
        for _, x, w in _blocks(batches):
            c = _deviations(x, n, total).astype(np.float64) / n
            g = (c * w[:, None]).T @ c
            gram = g if gram is None else gram + g
        i, j = np.triu_indices(len(total)) if gram is not None else (np.zeros(0, np.int64),) * 2
        yield pa.RecordBatch.from_arrays(
            [pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(gram[i, j] if len(i) else [], pa.float64())],
            ["i", "j", "g"],
        )

    parts = distinct.select("x", "w").mapInArrow(products, "i int, j int, g double")
    cov = np.zeros((len(total), len(total)))
    for i, j, g in parts.groupBy("i", "j").agg(F.sum("g").alias("g")).collect():
        cov[i, j] = cov[j, i] = g / n
    values, vectors = np.linalg.eigh(cov)
    values, vectors = values[::-1], vectors[:, ::-1]
    # a sign of its own for each component, the same in every run
    lead = np.abs(vectors).argmax(axis=0)
    vectors = vectors * np.where(vectors[lead, np.arange(len(total))] < 0, -1.0, 1.0)
    return Model(n, total, values, vectors, float(np.trace(cov)))


def whiten_distinct(distinct: DataFrame, model: Model, components: int = COMPONENTS) -> DataFrame:
    """``(x, w, deviation long, whitened array<double>)``, one row for each distinct vector.

    Components whose variance is not above rounding (the largest times dimension and machine epsilon) can't be scaled to
    one and are left out, so ``whitened`` may be shorter than ``components``.
    """
    floor = max(float(model.values[0]), 0.0) * len(model.sums) * np.finfo(float).eps
    used = [k for k in range(min(components, len(model.values))) if model.values[k] > floor]
    turn = model.vectors[:, used] / np.sqrt(model.values[used])

    def run(batches):
        for part, x, w in _blocks(batches):
            d = _deviations(x, model.n, model.sums)
            z = (d.astype(np.float64) / model.n) @ turn
            ends = pa.array(np.arange(len(x) + 1) * len(used), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0),
                    part.column(1),
                    pa.array(_squares(d), pa.int64()),
                    pa.ListArray.from_arrays(ends, pa.array(z.ravel(), pa.float64())),
                ],
                ["x", "w", "deviation", "whitened"],
            )

    return distinct.select("x", "w").mapInArrow(run, "x binary, w long, deviation long, whitened array<double>")


def identity_error(white: DataFrame, n: int) -> float:
    """Largest absolute entry of the whitened fit vectors' covariance (divisor n, centred first) minus the identity."""
    k = white.select(F.max(F.size("whitened"))).first()[0] or 0
    if not k:
        return 0.0
    z = lambda i: F.element_at("whitened", i + 1)
    mean = white.agg(*[(F.sum(F.col("w") * z(i)) / n).alias(f"m{i}") for i in range(k)]).first()
    centred = lambda i: z(i) - F.lit(mean[i])
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    cov = white.agg(*[(F.sum(F.col("w") * centred(i) * centred(j)) / n).alias(f"c{i}_{j}") for i, j in pairs]).first()
    return float(max(abs(c - (i == j)) for c, (i, j) in zip(cov, pairs)))


def whiten(
    embeddings: DataFrame, components: int = COMPONENTS, *, scale: int = SCALE, shift: int = SHIFT, weights: str = "count"
) -> DataFrame:
    """``(vec_id, component int, n long, deviation long, whitened double, explained double, identity_error double)``.

    A row for each row of ``embeddings`` that takes part and each component (from 1, by falling variance): ``deviation``
    is the sum over dimensions of (n * x - S)**2, null where no long holds it; ``explained`` the component's share of the
    variance.  Out are null and empty vectors, null, non-finite or over-long entries, and vectors whose length is not the
    commonest.  A table whose vectors are all alike, or that is empty, has no component and gives no rows.  Repeated rows
    and ids give repeated rows; further columns are not read.
    """
    spark = embeddings.sparkSession
    rows = materialize(coded(embeddings, scale, shift), "codes")
    distinct = distinct_codes(rows, weights)
    model = fit(distinct)
    kind = embeddings.schema["vec_id"].dataType.simpleString()
    if model is None:
        return spark.createDataFrame([], f"vec_id {kind}, {OUT}")
    white = materialize(whiten_distinct(distinct, model, components), "whitened")
    error = identity_error(white, model.n)
    share = F.array(*[F.lit(float(v / model.trace)) if model.trace > 0 else F.lit(0.0) for v in model.values[:components]])
    joined = rows.join(white.select("x", "deviation", "whitened"), "x")
    return joined.select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened")).select(
        "vec_id",
        (F.col("at") + 1).cast("int").alias("component"),
        F.lit(model.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        share[F.col("at")].alias("explained"),
        F.lit(error).alias("identity_error"),
    )


#: Columns of whiten() after vec_id.
OUT = "component int, n long, deviation long, whitened double, explained double, identity_error double"
