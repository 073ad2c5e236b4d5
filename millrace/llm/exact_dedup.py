"""Exact dedup by a heavy-hitter split.

Texts are equal when they are identical without the characters of `[\\x20\\x09-\\x0D]`; their
SHA-256 stands for them. A frequent-items sketch (Spark's `approx_top_k`, the mergeable
Misra-Gries summary) names the few digests that many rows share. Their exact counts and winners
are verified by a map-side combined aggregation and broadcast, so rows of a large group are
settled where they lie. All other digests go through an ordinary shuffle.

The sketch only decides the way a group takes, never the result. The broadcast holds at most
`TRACKED` digests, whatever the input.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.session import materialize

SPACES = " \t\n\x0b\x0c\r"
# Counters of the sketch, and so the most rows ever broadcast.
TRACKED = 4096
# A digest with fewer rows takes the ordinary way even if the sketch holds it.
FREQUENT = 32


def normalized(text: Column) -> Column:
    return F.translate(F.coalesce(text, F.lit("")), SPACES, "")


def digest(text: Column) -> Column:
    """Lowercase hex SHA-256 of the normalised text in UTF-8."""
    return F.sha2(normalized(text).cast("binary"), 256)


def _preference(n_chars: Column, doc_id: Column) -> Column:
    """Greater is better: more code points, then the smaller id, a null id last."""
    return F.struct(n_chars, F.bitwise_not(doc_id))


def _frequent(rows: DataFrame) -> DataFrame:
    """Digests the sketch holds as frequent: at most TRACKED rows."""
    top = rows.agg(F.expr(f"approx_top_k(digest, {TRACKED}, {TRACKED})").alias("top"))
    items = top.select(F.inline("top").alias("digest", "estimate"))
    return materialize(items.where(F.col("estimate") >= FREQUENT).select("digest"), "frequent")


def _winners(rows: DataFrame) -> DataFrame:
    """Per digest the row that stays and the group's size; combined before the shuffle."""
    best = F.max_by(F.struct("row_id", "doc_id", "n_chars"), _preference(F.col("n_chars"), F.col("doc_id")))
    grouped = rows.groupBy("digest").agg(best.alias("best"), F.count("*").alias("group_size"))
    return grouped.select(
        "digest",
        "group_size",
        F.col("best.row_id").alias("keep_row"),
        F.col("best.doc_id").alias("keep_id"),
        F.col("best.n_chars").alias("keep_chars"),
    )


def _digests(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """One narrow stored row per document; row_id tells rows of one id apart."""
    text = F.coalesce(F.col(text_column), F.lit(""))
    rows = docs.select(
        F.monotonically_increasing_id().alias("row_id"),
        F.col(id_column).cast("long").alias("doc_id"),
        F.length(text).cast("long").alias("n_chars"),
        digest(text).alias("digest"),
    )
    return materialize(rows, "digests")


def group_copies(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Every row with the row that stands for its group of equal texts.

    Returns doc_id, keep_id, group_size, kept and text_sha256, one row per input row. The row with
    the most code points stays, then the smallest id (a null id last); of rows alike in both, one.
    A null text counts as empty, so null, empty and blank texts form one group. An empty table
    gives an empty result. Other columns are not read.
    """
    rows = _digests(docs, id_column, text_column)
    frequent = F.broadcast(_frequent(rows))
    heavy = rows.join(frequent, "digest", "left_semi")
    light = rows.join(frequent, "digest", "left_anti")
    settled = heavy.join(F.broadcast(_winners(heavy)), "digest").unionByName(
        light.join(_winners(light), "digest")
    )
    return settled.select(
        "doc_id",
        "keep_id",
        "group_size",
        (F.col("row_id") == F.col("keep_row")).alias("kept"),
        F.col("digest").alias("text_sha256"),
    )


def drop_copies(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The documents that `group_copies` keeps, with all their columns as they are.

    Losers of frequent groups are removed where they lie; of what remains, one row per digest
    crosses the network after a map-side combine. Columns of any name pass through.
    """
    rows = _digests(docs, id_column, text_column)
    heavy = rows.join(F.broadcast(_frequent(rows)), "digest", "left_semi")
    winners = _winners(heavy).select("digest", "keep_id", "keep_chars")
    text = F.coalesce(F.col(text_column), F.lit(""))
    keyed = docs.select(
        F.struct("*").alias("document"),
        F.col(id_column).cast("long").alias("doc_id"),
        F.length(text).cast("long").alias("n_chars"),
        digest(text).alias("digest"),
    )
    wins = F.col("keep_chars").isNull() | (
        F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("n_chars") == F.col("keep_chars"))
    )
    left = keyed.join(F.broadcast(winners), "digest", "left").where(wins)
    best = F.max_by("document", _preference(F.col("n_chars"), F.col("doc_id")))
    return left.groupBy("digest").agg(best.alias("document")).select("document.*")


def query(spark, sf_dir: str) -> DataFrame:
    return group_copies(spark.read.parquet(f"{sf_dir}/documents.parquet"))


SQL = r"""
WITH texts AS (
  SELECT doc_id, length(coalesce(text, '')) AS n_chars,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents
),
ranked AS (
  SELECT doc_id, text_sha256,
         first_value(doc_id) OVER best AS keep_id,
         count(*) OVER (PARTITION BY text_sha256) AS group_size,
         row_number() OVER best = 1 AS kept
  FROM texts
  WINDOW best AS (PARTITION BY text_sha256 ORDER BY n_chars DESC, doc_id NULLS LAST)
)
SELECT doc_id, keep_id, group_size, kept, text_sha256 FROM ranked
"""
