"""Exact distinct counts of integer ids by bitmaps.

An id is one bit in the bitmap of its bucket, 32,768 ids each. Bitmaps are made before the shuffle and
joined by OR after it, so what moves is at most 4 KB per bucket and input partition, however often an id
occurs; and bitmaps that were stored per batch give the distinct count of all batches without
reading their rows again.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKET_IDS = 32_768
# Ids per possible id below which a bitmap takes more room than the ids: 4 KB for 512 ids of 8 bytes.
_DENSE = 512 / BUCKET_IDS


def id_bitmaps(df: DataFrame, ids: Column, *batch: str) -> DataFrame:
    """(batch columns, bucket, bits) of the non-null ids, for one table or per batch."""
    id_ = F.col("_id")
    held = df.select(*batch, ids.cast("bigint").alias("_id")).where(id_.isNotNull())
    return held.groupBy(*batch, F.bitmap_bucket_number(id_).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(id_)).alias("bits")
    )


def merge_bitmaps(bitmaps: DataFrame) -> DataFrame:
    """(bucket, bits) over all batches."""
    return bitmaps.groupBy("bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def count_bitmaps(bitmaps: DataFrame, name: str = "distinct") -> DataFrame:
    """One row with the number of ids in bitmaps of different buckets."""
    return bitmaps.agg(F.coalesce(F.sum(F.bitmap_count("bits")), F.lit(0)).cast("bigint").alias(name))


def exact_distinct(df: DataFrame, ids: Column, name: str = "distinct") -> DataFrame:
    """One row with the number of distinct non-null ids, exact either way.

    Ids that lie close enough, by their measured range and number, go through bitmaps; sparse ones, such as
    hashes, are shuffled themselves, which takes less room for them.
    """
    held = df.select(ids.cast("bigint").alias("_id"))
    seen = held.agg(F.min("_id").alias("low"), F.max("_id").alias("high"), F.count("_id").alias("n")).first()
    if seen["n"] and seen["n"] >= _DENSE * (seen["high"] - seen["low"] + 1):
        return count_bitmaps(id_bitmaps(held, F.col("_id")), name)
    return held.agg(F.count_distinct("_id").alias(name))
