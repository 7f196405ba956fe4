"""Embedding whitening from exact integers.

Entries become integers x; the fit list is each distinct x vector once, written as a table.  Its count and sums, and
then the scatter of the vectors centred on the whole part of their means, are summed exactly: tasks emit one row for
each place of the matrix (its triangle, so at most the square of the dimension), in limbs of 60 bits.  From them follows
the integer matrix n**2 V.  Tasks reduce it modulo one batch of primes each, the driver (which holds nothing that grows
with the rows) puts its characteristic polynomial together and isolates the roots, and tasks find each root's
eigenvectors (``exact_spectrum``).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from . import exact_spectrum as spectrum
from .common import ship

#: Bits of a limb; primes in a batch.
LIMB, BATCH = 60, 16
OUTPUT = "component int, n long, deviation long, whitened double, explained double, identity_error double"


def vectors(batch: pa.RecordBatch, d: int) -> np.ndarray:
    return batch["x"].flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


def limbs(place: int, value: int):
    """A whole number as rows (place, limb, value)."""
    k = 0
    while not -(1 << LIMB) <= value < 1 << LIMB:
        yield place, k, value & (1 << LIMB) - 1
        value, k = value >> LIMB, k + 1
    yield place, k, value


def added(x: DataFrame, of_batch) -> dict[int, int]:
    """Sums, over all batches, of the whole numbers that ``of_batch`` gives as {place: number}."""

    def run(batches):
        total: dict[int, int] = {}
        for b in batches:
            if b.num_rows:
                for k, v in of_batch(b).items():
                    total[k] = total.get(k, 0) + int(v)
        rows = [r for k, v in total.items() for r in limbs(k, v)]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.int32(), pa.int32(), pa.int64()))], names=["place", "limb", "value"])

    rows = x.mapInArrow(run, "place int, limb int, value long").groupBy("place", "limb").agg(F.sum(F.col("value").cast("decimal(20,0)")).alias("value")).collect()
    out: dict[int, int] = {}
    for r in rows:
        out[r.place] = out.get(r.place, 0) + (int(r.value) << LIMB * r.limb)
    return out


def exact_product(r: np.ndarray) -> np.ndarray:
    """r.T @ r as whole numbers: by doubles in blocks of rows while every sum is below 2**53, else by Python's."""
    most = max(int(r.max()), -int(r.min()), 1)
    rows = 2**53 // most**2
    if not rows:
        r = r.astype(object)
        return r.T @ r
    out = np.zeros((r.shape[1],) * 2, dtype=object)
    for s in range(0, len(r), rows):
        part = r[s:s + rows].astype(np.float64)
        out += (part.T @ part).astype(np.int64)
    return out


def centred(x: np.ndarray, centre: list[int]) -> np.ndarray:
    return x - np.array(centre, np.int64)


def scatter(x: DataFrame, d: int, n: int, sums: list[int]) -> list[list[int]]:
    """n**2 times the covariance of the rows, exactly."""
    centre = [s // n for s in sums]
    places = [(i, j) for i in range(d) for j in range(i, d)]

    def of_batch(b):
        product = exact_product(centred(vectors(b, d), centre))
        return {k: product[i, j] for k, (i, j) in enumerate(places)}

    total = added(x, of_batch)
    left = [s - n * c for s, c in zip(sums, centre, strict=True)]
    out = [[0] * d for _ in range(d)]
    for k, (i, j) in enumerate(places):
        out[i][j] = out[j][i] = n * total.get(k, 0) - left[i] * left[j]
    return out


def characteristic(spark: SparkSession, matrix: list[list[int]]) -> list[int]:
    """Coefficients of the matrix's characteristic polynomial, highest first; tasks take batches of primes."""
    primes = spectrum.primes_for(matrix)
    names = ["prime", "residues"]

    def run(batches):
        for b in batches:
            ps = b["prime"].to_pylist()
            for s in range(0, len(ps), BATCH):
                found = spectrum.polynomials_mod(matrix, ps[s:s + BATCH])
                yield pa.RecordBatch.from_arrays([pa.array(ps[s:s + BATCH], pa.int64()), pa.array(found.tolist(), pa.list_(pa.int64()))], names=names)

    frame = spark.createDataFrame([(p,) for p in primes], "prime long").repartition(-(-len(primes) // BATCH))
    rows = frame.mapInArrow(run, "prime long, residues array<long>").collect()
    return spectrum.remaindered(np.array([r.residues for r in rows], np.int64), [r.prime for r in rows])


def principal(spark: SparkSession, matrix: list[list[int]], components: int) -> tuple[list[tuple[int, int]], np.ndarray]:
    """The largest positive eigenvalues of the matrix, falling, and their unit eigenvectors as rows (the entry of largest
    absolute value, the first of equals, positive)."""
    roots = spectrum.largest_roots(characteristic(spark, matrix), components)
    if not roots:
        return [], np.zeros((0, len(matrix)))
    distinct = list(dict.fromkeys(roots))
    tasks = [(k, str(r[0]), r[1], roots.count(r)) for k, r in enumerate(distinct)]

    def run(batches):
        for b in batches:
            for k, numerator, shift, count in zip(*(c.to_pylist() for c in b.columns), strict=True):
                found = spectrum.eigenvectors(matrix, (int(numerator), shift), count)
                yield pa.RecordBatch.from_arrays([pa.array([k] * count, pa.int32()), pa.array(found, pa.list_(pa.float64()))], names=["k", "vector"])

    frame = spark.createDataFrame(tasks, "k int, numerator string, shift int, count int").repartition(len(tasks), "k")
    rows = sorted(frame.mapInArrow(run, "k int, vector array<double>").collect(), key=lambda r: (r.k, r.vector))
    v = np.array([r.vector for r in rows])
    signs = np.sign(v[np.arange(len(v)), np.argmax(abs(v).round(12), 1)])
    return roots, v * signs[:, None]


def whiten(embeddings: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = 16,
           scale: int = 64, shift: int = 1_000_000) -> DataFrame:
    """Whitened coordinates of each vector on the largest principal components of the distinct scaled vectors.

    One row per remaining row and component (from 1, by falling eigenvalue): ``id_col``, ``component``, ``n`` (distinct
    vectors), ``deviation`` (squared distance of n*x from the sums; null where it exceeds a long), ``whitened``,
    ``explained`` (share of the trace), ``identity_error`` (largest absolute entry of the whitened fit list's covariance
    less the identity).  An entry c becomes x = floor(scale * c) + shift.  Rows drop out whose vector is null or holds a
    null or non-finite entry, or one beyond 2**62 / scale; of tables with vectors of several lengths the most frequent
    (of equals the longest) stays.  A component needs a positive eigenvalue: with fewer than ``components`` of these,
    as with few or constant vectors, there are fewer rows, and none for an empty table.  Equal eigenvalues have any
    orthonormal vectors of their space.  Repeated rows and null ids give rows of their own; extra columns are left out.
    """
    spark = embeddings.sparkSession
    ship(spark)
    entry = F.col("v")
    rows = embeddings.select(F.col(id_col).alias("id"), F.col(vector_col).alias("v")).where(
        F.coalesce(F.forall(entry, lambda c: F.abs(c.cast("double")) * scale < F.lit(2.0**62)), F.lit(False)))
    first = rows.groupBy(F.size("v").alias("d")).count().where("d > 0").orderBy(F.desc("count"), F.desc("d")).first()
    d = first.d if first else 0
    x = rows.where(F.size("v") == d).select("id", F.transform(entry, lambda c: F.floor(c.cast("double") * scale) + F.lit(shift).cast("long")).alias("x"))
    id_type = embeddings.select(id_col).schema[0].dataType.simpleString()
    schema = f"id {id_type}, {OUTPUT}"
    fit = None
    if d:
        out = scratch_path(spark, "fit")
        x.select("x").distinct().write.option("compression", "zstd").parquet(out)
        fit = spark.read.parquet(out)
        sums_ = added(fit, lambda b: {0: b.num_rows} | {1 + k: s for k, s in enumerate(vectors(b, d).astype(object).sum(0))})
        n, sums = sums_[0], [sums_[1 + k] for k in range(d)]
        matrix = scatter(fit, d, n, sums)
        roots, axes = principal(spark, matrix, components) if any(matrix[k][k] for k in range(d)) else ([], None)
    if not d or not roots:
        return spark.createDataFrame([], schema).withColumnRenamed("id", id_col)

    trace = sum(matrix[k][k] for k in range(d))
    # an eigenvalue of V is the root over n**2
    explained = [r / (trace << s) for r, s in roots]
    deviations = [(r / ((n * n) << s)) ** 0.5 for r, s in roots]
    centre = [s // n for s in sums]
    rest = [s - n * c for s, c in zip(sums, centre, strict=True)]
    fraction, project = np.array([s / n for s in rest]), (axes / np.array(deviations)[:, None]).T
    k = len(roots)

    def whitened(some: np.ndarray) -> np.ndarray:
        return (centred(some, centre) - fraction) @ project

    def moments(batches):
        total = np.zeros(k + k * k)
        for b in batches:
            if b.num_rows:
                w = whitened(vectors(b, d))
                total += np.concatenate([w.sum(0), (w.T @ w).ravel()])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(k + k * k), pa.int32()), pa.array(total)], names=["place", "value"])

    found = {r.place: r.value for r in fit.mapInArrow(moments, "place int, value double").groupBy("place").agg(F.sum("value").alias("value")).collect()}
    mean = np.array([found[i] for i in range(k)]) / n
    covariance = np.array([found[k + i] for i in range(k * k)]).reshape(k, k) / n - np.outer(mean, mean)
    error = float(abs(covariance - np.eye(k)).max())

    def run(batches):
        for b in batches:
            if not b.num_rows:
                continue
            some = vectors(b, d)
            each = np.repeat(np.arange(len(some)), k)
            columns = [b["id"].take(pa.array(each)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(some))), pa.array(np.full(len(each), n)),
                       deviation(centred(some, centre), n, rest).take(pa.array(each)), pa.array(whitened(some).ravel()),
                       pa.array(np.tile(explained, len(some))), pa.array(np.full(len(each), error))]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return x.mapInArrow(run, schema).withColumnRenamed("id", id_col)


def deviation(r: np.ndarray, n: int, rest: list[int]) -> pa.Array:
    """Sum over dimensions of (n*x - S)**2 for centred vectors; null beyond a long."""
    most = (max(int(r.max()), -int(r.min())) + 1) * n
    if most * most * r.shape[1] < 2**63:
        y = r * n - np.array(rest, np.int64)
        return pa.array((y * y).sum(1))
    y = r.astype(object) * n - np.array(rest, dtype=object)
    return pa.array([int(v) if v < 2**63 else None for v in (y * y).sum(1)], pa.int64())
