"""Exact top-k search by exhaustive term-at-a-time accumulation.

Vectors are integer weights per term (dimension). Candidates are packed into blocks that hold a
posting list per term; for each query of a block of queries the postings of its non-zero terms are
scattered, weighted, into one dense score array. Partition selection keeps the k best of a block,
and the blocks' results merge in Spark. Every query meets every candidate; queries are a stated
set, taken in blocks, so no task holds all of either. Scores are 64-bit; where a query and a
candidate are so large that their products might not fit, exact Python integers.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from millrace.session import materialize

# Vectors in a block of candidates and of queries: some MB, whatever the table holds.
CANDIDATES, QUERIES = 16384, 1024
# Doubles from here on are whole numbers.
WHOLE = 2.0**53
# Bound of products' sums, a step below 64 bits for the rounding of the bound itself.
FITS = 2.0**62


def integer_weights(vector: Column, scale: int = 64) -> Column:
    """floor(scale * x) of each component, taken as double, and as a double: some leave a long."""

    def weight(x: Column) -> Column:
        x = x.cast("double") * F.lit(float(scale))
        return F.when(F.abs(x) < WHOLE, F.floor(x).cast("double")).otherwise(x)

    return F.transform(vector, weight)


def _usable(vector: Column) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    return F.coalesce(finite, F.lit(False))


def _unpacked(block: pa.StructScalar) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row ids, vector ids and the weights, one row each and padded with zeros, by vector id."""
    rows = block.values
    row_id, vec_id = (rows.field(n).to_numpy(zero_copy_only=False) for n in ("row_id", "vec_id"))
    lists = rows.field("weights")
    length = np.diff(lists.offsets.to_numpy())
    table = np.zeros((len(rows), max(length, default=0)))
    table[np.arange(table.shape[1]) < length[:, None]] = lists.flatten().to_numpy(zero_copy_only=False)
    order = np.lexsort((row_id, vec_id))
    return row_id[order], vec_id[order], table[order]


def _postings(table: np.ndarray) -> list[tuple[np.ndarray | None, np.ndarray]]:
    """Per term the rows with a weight and the weights; None for the rows where many have one."""
    out = []
    for weights in np.ascontiguousarray(table.T):
        rows = np.flatnonzero(weights)
        out.append((None, weights) if len(rows) * 8 > len(weights) else (rows, weights[rows]))
    return out


def _scores(query: np.ndarray, postings: list, size: int) -> np.ndarray:
    scores = np.zeros(size, postings[0][1].dtype if postings else np.int64)
    for term in np.flatnonzero(query[: len(postings)]):
        rows, weights = postings[term]
        if rows is None:
            scores += query[term] * weights
        else:
            scores[rows] += query[term] * weights
    return scores


def _best(scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the k greatest scores; among equals at the border the first places."""
    if len(scores) <= k:
        return np.arange(len(scores))
    border = np.partition(scores, len(scores) - k)[len(scores) - k]
    above = np.flatnonzero(scores > border)
    return np.r_[above, np.flatnonzero(scores == border)[: k - len(above)]]


RESULT = pa.schema([(n, pa.int64()) for n in ("query_row", "query_id", "vec_id", "score")])


def _meet(queries, candidates, k: int) -> pa.RecordBatch:
    """The k best candidates of one block for each query of another."""
    query_rows, query_ids, query_table = queries
    rows, ids, table = candidates
    largest, largest_asked = (np.abs(t).max(axis=1, initial=0) for t in (table, query_table))
    postings = _postings(_whole(table, largest))
    terms = max(len(postings), 1)
    asked = _whole(query_table, largest_asked)
    if largest.max(initial=0) * largest_asked.max(initial=0) * terms < 2**31:
        postings = [(r, w.astype(np.int32)) for r, w in postings]
        asked = asked.astype(np.int32)
    found = []
    for i, (row, query_id) in enumerate(zip(query_rows, query_ids, strict=True)):
        scores = _scores(asked[i], postings, len(rows)).astype(np.int64)
        large = np.flatnonzero(largest * largest_asked[i] * terms >= FITS)
        if len(large):
            scores = scores.astype(object)
            scores[large] = [_exact(query_table[i], table[c]) for c in large]
        at = _best(scores, k + 1)
        at = at[rows[at] != row]
        at = np.sort(at)
        at = at[np.argsort(-scores[at], kind="stable")][:k]
        found.append((np.full(len(at), row), np.full(len(at), query_id), ids[at], _longs(scores[at])))
    columns = [np.concatenate(c) for c in zip(*found, strict=True)]
    arrays = [pa.array(c, pa.int64()) for c in columns]
    return pa.record_batch(arrays, schema=RESULT)


def _whole(table: np.ndarray, largest: np.ndarray) -> np.ndarray:
    """The weights as 64-bit numbers; zeros in rows that do not fit and are scored exactly."""
    return np.where((largest < FITS)[:, None], table, 0).astype(np.int64)


def _exact(a: np.ndarray, b: np.ndarray) -> int:
    return sum(int(x) * int(y) for x, y in zip(a, b) if x and y)


def _longs(scores: np.ndarray) -> np.ndarray:
    """Scores below every long are null: they come last, and raise if they are among the k best."""
    if scores.dtype != object:
        return scores
    if any(s >= 2**63 for s in scores):
        raise OverflowError("an inner product among the best is no 64-bit number")
    return np.array([s if s >= -(2**63) else None for s in scores], object)


def _search(k: int):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for queries, candidates in zip(batch["queries"], batch["candidates"], strict=True):
                yield _meet(_unpacked(queries), _unpacked(candidates), k)

    return search


def _blocks(rows: DataFrame, name: str, blocks: int, others: str, of_others: int) -> DataFrame:
    """A row for each block of rows and each block of the others that it is to meet."""
    place = F.pmod(F.xxhash64("row_id"), F.lit(blocks)).alias(f"{name}_block")
    packed = rows.groupBy(place).agg(F.collect_list(F.struct("row_id", "vec_id", "weights")).alias(name))
    each = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(of_others - 1).cast("long")))
    return packed.withColumn(f"{others}_block", each)


def search(
    vectors: DataFrame,
    is_query: Column,
    k: int = 20,
    scale: int = 64,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
) -> DataFrame:
    """The k candidates of greatest inner product for each query row.

    Returns query_id, rank (from 1), vec_id, score. Every row but the query's own is a candidate,
    ties go to the smaller vec_id. Rows with a null id, a null vector, or a null or non-finite
    component take no part. A result's score that leaves a long is an error. Missing trailing components count as zero, so
    an empty vector scores 0. Rows that repeat an id are separate candidates and separate queries.
    Fewer than k candidates are all returned; an empty table gives an empty result. Other columns are
    not read, whatever their names.
    """
    usable = vectors.where(_usable(F.col(vector_column)) & F.col(id_column).isNotNull())
    rows = materialize(
        usable.select(
            F.monotonically_increasing_id().alias("row_id"),
            F.col(id_column).cast("long").alias("vec_id"),
            integer_weights(F.col(vector_column), scale).alias("weights"),
            is_query.alias("is_query"),
        ),
        "vectors",
    )
    sizes = rows.agg(F.count("*").alias("all"), F.count_if("is_query").alias("queries")).first()
    of_candidates = -(-sizes["all"] // CANDIDATES) or 1
    of_queries = -(-sizes["queries"] // QUERIES) or 1
    queries = _blocks(rows.where("is_query"), "queries", of_queries, "candidates", of_candidates)
    candidates = _blocks(rows, "candidates", of_candidates, "queries", of_queries)
    met = queries.join(candidates, ["queries_block", "candidates_block"]).select("queries", "candidates")
    found = met.mapInArrow(_search(k), "query_row long, query_id long, vec_id long, score long")
    order = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    no_long = F.raise_error(F.lit("an inner product among the best is no 64-bit number")).cast("long")
    return ranked.select("query_id", "rank", "vec_id", F.coalesce("score", no_long).alias("score"))


def query(spark, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return search(vectors, F.col("vec_id") % 20 == 0)


SQL = """
WITH weights AS (
  SELECT vec_id, [CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS w
  FROM embeddings
  WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         CAST(list_sum(list_transform(list_zip(q.w, c.w), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM weights q JOIN weights c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id
),
ranked AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
         vec_id, score
  FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20
"""
