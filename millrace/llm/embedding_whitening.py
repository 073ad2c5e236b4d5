"""Whitening of embeddings by a blockwise QR and a bidiagonal qd solver.

Vectors are read in four passes, each over its own rows where they lie:

1. exact integer sums per dimension;
2. each partition reduces its centred rows, block after block, to one triangle R with the same
   R'R, and triangles are joined in a tree of bounded fan-in until a few are left;
3. the last R goes to `bidiagonal`: Householder reflections, dqds, twisted factorisations; the
   covariance of the whitened rows is then measured over all rows;
4. rows are projected.

The covariance is never formed from products of raw numbers, so small directions keep their digits. What
the driver gathers are d sums, at most `FAN` triangles of d x d and one small covariance.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.bidiagonal import right_singular
from millrace.session import materialize

SCALE, OFFSET = 64, 1_000_000
# Triangles joined at once, and the bytes they may take.
FAN, FAN_BYTES = 64, 1 << 26
# Entries beyond this have no 64-bit code.
LARGEST = float(1 << 62)


@dataclass(frozen=True)
class Whitening:
    """n rows, per-dimension sums, unit directions (one per column), their variances, all variance."""

    n: int
    sums: tuple[int, ...]
    directions: np.ndarray
    variances: np.ndarray
    total: float
    identity_error: float = 0.0


def _vectors(vectors: DataFrame, id_column: str, column: str) -> DataFrame:
    return vectors.select(
        F.col(id_column).alias("vec_id"), F.col(column).cast("array<double>").alias("embedding")
    )


def _codes(batch: pa.RecordBatch, column: int = 1) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(positions, codes) of the usable rows of a batch, one matrix per vector length."""
    lists = batch.column(column)
    lengths = lists.value_lengths().to_numpy(zero_copy_only=False)
    lengths = np.nan_to_num(lengths.astype(float), nan=0.0).astype(np.int64)
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    starts = np.concatenate([[0], np.cumsum(lengths)[:-1]]).astype(np.int64)
    for length in np.unique(lengths[lengths > 0]):
        rows = np.flatnonzero(lengths == length)
        values = flat[starts[rows][:, None] + np.arange(length)]
        finite = np.isfinite(values).all(axis=1)
        scaled = np.floor(SCALE * values[finite])
        if (np.abs(scaled) >= LARGEST).any():
            raise ValueError("an embedding's entry is too large for a 64-bit code")
        if len(scaled):
            yield rows[finite], scaled.astype(np.int64) + OFFSET


def _sum_codes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of codes per dimension and the number of rows (position -1), per vector length."""
    totals: dict[int, list[int]] = {}
    for batch in batches:
        for _, x in _codes(batch, 0):
            held = totals.setdefault(x.shape[1], [0] * (x.shape[1] + 1))
            held[0] += len(x)
            # Halves of 32 bits, so that no sum of a batch leaves 64 bits.
            high, low = (x >> 32).sum(axis=0).tolist(), (x & 0xFFFFFFFF).sum(axis=0).tolist()
            for i, (h, w) in enumerate(zip(high, low)):
                held[i + 1] += (h << 32) + w
    rows = [(d, i - 1, str(total)) for d, held in totals.items() for i, total in enumerate(held)]
    columns = list(zip(*rows)) if rows else [[], [], []]
    types = (pa.int32(), pa.int32(), pa.string())
    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["d", "position", "total"])


def _sums(rows: DataFrame) -> tuple[int, tuple[int, ...]]:
    """Number of usable rows and sums of their codes; vectors of several lengths are an error."""
    parts = rows.select("embedding").mapInArrow(_sum_codes, "d int, position int, total string")
    total = F.sum(F.col("total").cast("decimal(38,0)")).alias("total")
    # Several lengths are refused, so two of them are enough to know.
    per_length = materialize(parts.groupBy("d", "position").agg(total), "whitening-sums")
    lengths = [r.d for r in per_length.where("position = -1").select("d").limit(2).collect()]
    if len(lengths) > 1:
        raise ValueError(f"vectors of different lengths: {sorted(lengths)}")
    found = {r.position: int(r.total) for r in per_length.collect()}
    return found.pop(-1, 0), tuple(found[i] for i in range(len(found)))


def _deviations(x: np.ndarray, n: int, sums: tuple[int, ...]) -> np.ndarray:
    """n*x - S, exact: 64-bit integers where they suffice, else Python's."""
    near = np.array([s // n for s in sums], dtype=np.int64)
    rest = [s - n * (s // n) for s in sums]
    shifted = x - near
    if (int(np.abs(shifted).max(initial=0)) + 1) * n < 1 << 62:
        return shifted * n - np.array(rest, dtype=np.int64)
    return shifted.astype(object) * n - np.array(rest, dtype=object)


def _squared(deviations: np.ndarray) -> list[int | None]:
    """Sums of squares per row, exact; None where one is no 64-bit integer."""
    largest = int(np.abs(deviations).max(initial=0))
    if largest * largest * deviations.shape[1] < 1 << 63:
        return (deviations * deviations).sum(axis=1).tolist()
    exact = (sum(v * v for v in row) for row in deviations.tolist())
    return [s if s < 1 << 63 else None for s in exact]


def _centred(x: np.ndarray, n: int, sums: tuple[int, ...]) -> np.ndarray:
    return _deviations(x, n, sums).astype(float) / n


def _triangle(blocks: list[np.ndarray]) -> np.ndarray:
    return np.linalg.qr(np.vstack(blocks), mode="r")


def _packed(part: int, r: np.ndarray) -> tuple[int, bytes]:
    return part, np.ascontiguousarray(r).tobytes()


def _final_triangle(rows: DataFrame, n: int, sums: tuple[int, ...]) -> np.ndarray:
    """R of all centred rows; triangles of partitions meet in groups of bounded size."""
    d = len(sums)
    fan = max(2, min(FAN, FAN_BYTES // (8 * d * d)))
    schema = "part long, r binary"

    def reduced(batches):
        r = np.zeros((0, d))
        for batch in batches:
            for _, x in _codes(batch, 0):
                for at in range(0, len(x), 4096):
                    r = _triangle([r, _centred(x[at : at + 4096], n, sums)])
        if len(r):
            part, packed = _packed(TaskContext.get().partitionId(), r)
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int64()), pa.array([packed], pa.binary())], ["part", "r"])

    def joined(key, group: pd.DataFrame) -> pd.DataFrame:
        part, packed = _packed(key[0], _triangle([np.frombuffer(r).reshape(-1, d) for r in group["r"]]))
        return pd.DataFrame({"part": [part], "r": [packed]})

    held = materialize(rows.select("embedding").mapInArrow(reduced, schema), "triangles")
    while held.count() > fan:
        part = F.floor(F.col("part") / fan).alias("part")
        held = materialize(held.select(part, "r").groupBy("part").applyInPandas(joined, schema), "triangles")
    return _triangle([np.frombuffer(r.r).reshape(-1, d) for r in held.orderBy("part").collect()])


def _projection(model: Whitening) -> np.ndarray:
    return model.directions / np.sqrt(model.variances)


def _covariance(rows: DataFrame, model: Whitening) -> np.ndarray:
    """The covariance of the whitened rows, from sums of products per partition."""
    projection, k = _projection(model), len(model.variances)

    def products(batches):
        total = np.zeros((k, k))
        for batch in batches:
            for _, x in _codes(batch, 0):
                w = _centred(x, model.n, model.sums) @ projection
                total += w.T @ w
        arrays = [pa.array(np.arange(k * k, dtype=np.int32)), pa.array(total.ravel())]
        yield pa.RecordBatch.from_arrays(arrays, ["position", "total"])

    parts = rows.select("embedding").mapInArrow(products, "position int, total double")
    found = parts.groupBy("position").agg(F.sum("total").alias("total")).collect()
    out = np.zeros(k * k)
    for r in found:
        out[r.position] = r.total
    return out.reshape(k, k) / model.n


def fit(
    vectors: DataFrame, components: int = 32, id_column: str = "vec_id", column: str = "embedding"
) -> Whitening | None:
    """The directions of most variance over all usable vectors; None without one.

    A vector is usable unless it is null, empty or holds a null or non-finite entry. Directions whose
    deviation is at rounding level of the greatest have no whitening and are left out, so
    there are fewer than `components` where rows or dimensions are fewer or depend on each other,
    and none when all rows are equal. Vectors of different lengths are an error.
    """
    rows = _vectors(vectors, id_column, column)
    n, sums = _sums(rows)
    if not n:
        return None
    r = _final_triangle(rows, n, sums)
    square = np.zeros((len(sums), len(sums)))
    square[: len(r)] = r
    squares, directions = right_singular(square / np.sqrt(n), components)
    model = Whitening(n, sums, directions, squares[: directions.shape[1]], float(squares.sum()))
    if not directions.shape[1]:
        return model
    error = np.abs(_covariance(rows, model) - np.eye(len(model.variances))).max()
    return Whitening(n, sums, directions, model.variances, model.total, float(error))


SCHEMA = (
    "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
)


def whiten(
    vectors: DataFrame, model: Whitening | None, id_column: str = "vec_id", column: str = "embedding"
) -> DataFrame:
    """One row per usable vector and component of the model, components from 1 by falling variance.

    `deviation` is the exact sum of (n*x - S)^2 over dimensions, null where it is no 64-bit integer;
    `explained` the component's share of all variance; `identity_error` the model's. Rows with the same
    id, or a null one, stay apart. Other columns are not read. Without a model, or without a
    component, there are no rows.
    """
    rows = _vectors(vectors, id_column, column).withColumn("vec_id", F.col("vec_id").cast("long"))
    if model is None or not len(model.variances):
        return rows.sparkSession.createDataFrame([], SCHEMA)
    projection, k = _projection(model), len(model.variances)
    explained = model.variances / model.total
    names = [part.split()[0] for part in SCHEMA.split(", ")]

    def projected(batches):
        for batch in batches:
            for positions, x in _codes(batch):
                for at in range(0, len(x), 1024):
                    deviations = _deviations(x[at : at + 1024], model.n, model.sums)
                    w = deviations.astype(float) / model.n @ projection
                    ids = batch.column(0).take(pa.array(np.repeat(positions[at : at + 1024], k)))
                    count = len(w)
                    squared = pa.array(_squared(deviations), pa.int64())
                    arrays = [
                        ids,
                        pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), count)),
                        pa.array(np.full(count * k, model.n, dtype=np.int64)),
                        squared.take(pa.array(np.repeat(np.arange(count), k))),
                        pa.array(w.ravel()),
                        pa.array(np.tile(explained, count)),
                        pa.array(np.full(count * k, model.identity_error)),
                    ]
                    yield pa.RecordBatch.from_arrays(arrays, names)

    return rows.mapInArrow(projected, SCHEMA)


def query(spark, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return whiten(vectors, fit(vectors))
