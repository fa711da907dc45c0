"""Whitening of embeddings along their leading components.

Entries become whole numbers, so that means and deviations are exact. The vectors are packed
once into blocks of bytes in a written table; everything after is passes over that table.
The covariance matrix is never formed: the Jacobi-Davidson solver of ``eigen`` asks for
products of it with a few columns, and each is one distributed pass in which a task centres
its vectors and adds up its share. Only blocks of ``dimension x components`` reach the driver.

Cases: a vector that is null, empty, or holds null or non-finite entries is dropped, and so
is one whose length is not the commonest (the longer of equally common ones). Entries beyond
2**32 either way count as that. Ids may be null or repeat; each row is whitened. Directions
without variance (equal vectors, fewer rows than components) have no components, so these
rows may get fewer than asked for, or none. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from setwise.llm import eigen
from setwise.llm.common import store

SCALE, SHIFT = 1024, 100_000
LIMIT = 1 << 32
BLOCK_BYTES = 4 << 20
COMPONENTS = 8
NO_VARIANCE = 1e-13
"""Share of the largest variance below which a direction counts as one without variance."""


def whole_vector(vector: Column) -> Column:
    finite = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    return vector.isNotNull() & (F.size(vector) > 0) & finite


def whole_numbers(values: np.ndarray) -> np.ndarray:
    return np.floor(SCALE * np.clip(values, -LIMIT, LIMIT)).astype(np.int64) + SHIFT


def packed_vectors(vectors: DataFrame, key: str, vector: str) -> tuple[DataFrame, int]:
    """Blocks of vectors (``ids``, ``rows`` and ``x``, the numbers as bytes) and their length."""
    rows = vectors.select(vectors[key].alias("id"), vectors[vector].cast("array<double>").alias("v"))
    rows = rows.where(whole_vector(F.col("v")))
    lengths = rows.groupBy(F.size("v").alias("d")).count()
    found = lengths.orderBy(F.desc("count"), F.desc("d")).first()
    d = found["d"] if found else 0
    kind = rows.schema["id"].dataType.simpleString()

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        most = max(1, BLOCK_BYTES // (8 * d))
        for batch in batches:
            for at in range(0, batch.num_rows, most):
                part = batch.slice(at, most)
                n = part.num_rows
                x = whole_numbers(part.column("v").flatten().to_numpy(zero_copy_only=False))
                narrow = x.astype(np.int32) if (np.abs(x) < 1 << 31).all() else x
                ids = part.column("id")
                ids = pa.ListArray.from_arrays(pa.array([0, n], pa.int32()), pa.concat_arrays([ids]))
                yield pa.record_batch([ids, pa.array([n], pa.int32()), pa.array([narrow.tobytes()])], ["ids", "rows", "x"])

    blocks = rows.where(F.size("v") == d).mapInArrow(pack, f"ids array<{kind}>, rows int, x binary")
    return store(blocks, "vectors"), d


def _numbers(batch: pa.RecordBatch, d: int) -> Iterator[np.ndarray]:
    """The vectors of each block as rows."""
    for n, x in zip(batch.column("rows").to_pylist(), batch.column("x")):
        width = len(data := x.as_buffer()) // (n * d)
        yield np.frombuffer(data, dtype=f"i{width}").reshape(n, d).astype(np.int64)


class Centre:
    """Count and sums of all vectors, exact, and what they make of single ones."""

    def __init__(self, n: int, sums: list[int]):
        self.n, self.sums = n, sums
        self.small = max([n, *map(abs, sums)]) < 1 << 62
        self.array = np.array(sums, dtype=np.int64 if self.small else object)

    def scaled(self, x: np.ndarray) -> np.ndarray:
        """``n * x - sums``: 64-bit numbers where these hold it, else Python's."""
        if self.small and int(np.abs(x).max(initial=0)) * self.n < 1 << 62:
            return x * self.n - self.array
        return x.astype(object) * self.n - self.array.astype(object)

    def centred(self, x: np.ndarray) -> np.ndarray:
        return self.scaled(x).astype(np.float64) / self.n

    def deviations(self, x: np.ndarray) -> list[Decimal]:
        """Sums of squares of ``scaled``, exact."""
        v = self.scaled(x)
        widest = int(np.abs(v).max(initial=0)) if v.size else 0
        if widest * widest * v.shape[1] >= 1 << 63:
            v = v.astype(object)
        return [Decimal(int(s)) for s in (v * v).sum(axis=1)]


def _sums(blocks: DataFrame, d: int) -> Centre:
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for x in _numbers(batch, d):
                values = np.r_[len(x), x.sum(axis=0)]
                yield pa.record_batch([pa.array(range(d + 1), pa.int32()), pa.array(values)], ["pos", "value"])

    parts = blocks.mapInArrow(add, "pos int, value long")
    found = dict(parts.groupBy("pos").agg(F.sum(F.col("value").cast("decimal(38,0)"))).collect())
    return Centre(int(found.get(0, 0)), [int(found.get(i + 1, 0)) for i in range(d)])


def _added(blocks: DataFrame, d: int, share, size: int) -> np.ndarray:
    """The sum over all blocks of ``share(numbers)``, an array of ``size`` doubles. Tasks add
    up their blocks first."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        seen = False
        for batch in batches:
            for x in _numbers(batch, d):
                total += share(x)
                seen = True
        if seen:
            yield pa.record_batch([pa.array(range(size), pa.int32()), pa.array(total)], ["pos", "value"])

    parts = blocks.mapInArrow(add, "pos int, value double").groupBy("pos").agg(F.sum("value").alias("value")).toArrow()
    out = np.zeros(size)
    out[parts["pos"].to_numpy()] = parts["value"].to_numpy()
    return out


def covariance_product(blocks: DataFrame, d: int, centre: Centre) -> eigen.Product:
    """The covariance matrix times a block of columns, as one pass over the vectors."""

    def product(columns: np.ndarray) -> np.ndarray:
        def share(x: np.ndarray) -> np.ndarray:
            c = centre.centred(x)
            return (c.T @ (c @ columns)).ravel()

        return _added(blocks.select("rows", "x"), d, share, columns.size).reshape(columns.shape) / centre.n

    return product


def _check(blocks: DataFrame, d: int, centre: Centre, turn: np.ndarray) -> tuple[float, float]:
    """Trace of the covariance of the vectors, and the largest difference of the covariance
    of the whitened ones from the identity."""
    k = turn.shape[1]

    def share(x: np.ndarray) -> np.ndarray:
        c = centre.centred(x)
        z = c @ turn
        return np.r_[(c * c).sum(), z.sum(axis=0), (z.T @ z).ravel()]

    found = _added(blocks.select("rows", "x"), d, share, 1 + k + k * k) / centre.n
    mean = found[1 : 1 + k]
    spread = found[1 + k :].reshape(k, k) - np.outer(mean, mean)
    return float(found[0]), float(np.abs(spread - np.eye(k)).max(initial=0.0))


def whiten(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """Per remaining row and component: the key, ``component``, ``n``, ``deviation`` (exact, as
    a decimal), ``whitened``, ``explained`` and ``identity_error``."""
    kind = vectors.schema[key].dataType.simpleString()
    blocks, d = packed_vectors(vectors, key, vector)
    centre = _sums(blocks, d) if d else Centre(0, [])
    values, axes = eigen.leading(covariance_product(blocks, d, centre), d, components) if centre.n else (np.zeros(0), np.zeros((d, 0)))
    varied = values > max(NO_VARIANCE * values.max(initial=0.0), 0.0)
    values, axes = values[varied], axes[:, varied]
    k = len(values)
    turn = axes / np.sqrt(values)
    trace, error = _check(blocks, d, centre, turn) if k else (1.0, 0.0)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, x in zip(batch.column("ids"), _numbers(batch, d)):
                n = len(x)
                yield pa.record_batch(
                    [
                        ids.values.take(pa.array(np.repeat(np.arange(n), k))),
                        pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), n)),
                        pa.array(centre.deviations(x), pa.decimal128(38, 0)).take(pa.array(np.repeat(np.arange(n), k))),
                        pa.array((centre.centred(x) @ turn).ravel()),
                        pa.array(np.tile(values / trace, n)),
                    ],
                    ["id", "component", "deviation", "whitened", "explained"],
                )

    rows = blocks if k else blocks.where("false")
    out = rows.mapInArrow(project, f"id {kind}, component int, deviation decimal(38,0), whitened double, explained double")
    return out.select(
        F.col("id").alias(key), "component", F.lit(centre.n).cast("long").alias("n"), "deviation", "whitened", "explained",
        F.lit(error).alias("identity_error"),
    )
