"""One row per key."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def first_per_key(df: DataFrame, key: str, order) -> DataFrame:
    """Keep the first row of each key by `order`, ties broken by the remaining columns.

    Rows that still tie are equal in every column, so the result does not depend on the
    layout. NULL keys form one group. Spark trims each input partition to one row per key
    before the shuffle (window group limit), so a key holding a third of the rows sends at
    most one row per partition.
    """
    order = list(order)
    ties = [c for c in df.columns if c != key and c not in order]
    window = Window.partitionBy(key).orderBy(*order, *ties)
    return df.withColumn("_rank", F.row_number().over(window)).where("_rank = 1").drop("_rank")
