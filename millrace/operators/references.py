"""Parent-child joins: referential filters and orphan counts.

The child is the large side and its key may be skewed. Two things keep that safe:

* the parent is reduced to its distinct keys before it is shuffled, with map-side
  combining, so a repeated parent key costs one row;
* the join sees a plain shuffle on both sides, which is the shape AQE can split when a
  child key is hot. Grouping the parent by the key alone would leave its aggregate between
  shuffle and join and rule that out, hence the extra grouping expression below.

No side is broadcast by hint: Spark does so only when the measured size is under
`spark.sql.autoBroadcastJoinThreshold`.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.session import materialize

# Rows one array may produce when a parent key repeats.
_BLOCK = 4096
# Keys a sketch of the child's keys follows, and so the most rows a split broadcasts; a key is hot with
# at least one in _HOT of the child's rows.
TRACKED, _HOT = 4096, 1024


def key_counts(parent: DataFrame, key: str) -> DataFrame:
    """(key, copies) of the non-null parent keys."""
    return (
        parent.where(F.col(key).isNotNull())
        .groupBy(F.xxhash64(key).alias("_spread"), key)
        .agg(F.count("*").alias("copies"))
        .drop("_spread")
    )


def keep_referenced(
    child: DataFrame, parent: DataFrame, key: str, unique_parent: bool = False
) -> DataFrame:
    """Child rows whose key exists in the parent, each once.

    Equals the inner join when parent keys are unique. A parent known to be unique, such
    as a deduplicated table, is joined as it is.
    """
    keys = parent.select(key) if unique_parent else key_counts(parent, key).select(key)
    return child.join(keys, key, "left_semi").select(child.columns)


def match_parent(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """The inner join's child columns: a child row appears once per parent row with its key.

    The parent is counted per key first, and child rows are repeated after the join, so
    repeated parent rows are never shuffled or buffered. A key with very many parent rows becomes
    several counts of bounded size before the join, so one array per child row does, and a child
    row of a single parent, the usual case, meets a constant one.
    """
    return _repeated(child, _blocks(key_counts(parent, key), key), key)


def _blocks(counts: DataFrame, key: str) -> DataFrame:
    """(key, _copies): counts of at most _BLOCK that add up to the number of parent rows."""
    last_block = F.floor((F.col("copies") - 1) / F.lit(_BLOCK))
    blocks = counts.withColumn("_block", F.explode(F.sequence(F.lit(0).cast("bigint"), last_block)))
    size = F.least(F.lit(_BLOCK).cast("bigint"), F.col("copies") - F.col("_block") * _BLOCK)
    return blocks.select(key, size.alias("_copies"))


def _repeated(child: DataFrame, blocks: DataFrame, key: str) -> DataFrame:
    matched = child.join(blocks, key, "inner")
    one = F.array(F.lit(True))
    copies = F.when(F.col("_copies") == 1, one).otherwise(
        F.array_repeat(F.lit(True), F.col("_copies").cast("int"))
    )
    return matched.withColumn("_copy", F.explode(copies)).select(child.columns)


def hot_keys(child: DataFrame, key: str) -> DataFrame:
    """The keys that hold at least one in _HOT rows by a mergeable sketch; at most TRACKED rows."""
    held = child.where(F.col(key).isNotNull())
    top = held.agg(F.expr(f"approx_top_k(`{key}`, {TRACKED}, {TRACKED})").alias("top"), F.count("*").alias("n"))
    items = top.select(F.inline("top").alias(key, "estimate"), "n")
    return items.where(F.col("estimate") * _HOT >= F.col("n")).select(F.col(key).cast(child.schema[key].dataType))


def match_stored_parent(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """`match_parent` for a parent stored in buckets of the key, which is not shuffled then.

    A bucketed side rules out that a hot child key is split at run time. So the hot keys are found first,
    from the key column alone; their child rows stay where they lie and meet their few parent counts by
    broadcast, at most TRACKED keys whatever the input. All other rows meet the buckets.
    """
    hot = materialize(hot_keys(child, key), "hot-keys")
    counts = key_counts(parent, key)
    if hot.isEmpty():
        return _repeated(child, _blocks(counts, key), key)
    few = F.broadcast(hot)
    light = _repeated(child.join(few, key, "left_anti"), _blocks(counts, key), key)
    heavy_counts = materialize(counts.join(few, key, "left_semi"), "hot-counts")
    # The counts are broadcast before they are cut into blocks: one row per hot key.
    heavy = child.join(F.broadcast(heavy_counts), key)
    return light.unionByName(_copied(heavy).select(child.columns)).select(child.columns)


def keep_stored_referenced(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """`keep_referenced` for a parent with unique keys that is stored in buckets of the key.

    As in `match_stored_parent`, child rows of hot keys stay where they lie.
    """
    hot = materialize(hot_keys(child, key), "hot-keys")
    keys = parent.select(key)
    if hot.isEmpty():
        return child.join(keys, key, "left_semi").select(child.columns)
    few = F.broadcast(hot)
    found = F.broadcast(materialize(keys.join(few, key, "left_semi").distinct(), "hot-parents"))
    light = child.join(few, key, "left_anti").join(keys, key, "left_semi")
    return light.unionByName(child.join(found, key, "left_semi")).select(child.columns)


def _copied(matched: DataFrame) -> DataFrame:
    """Rows repeated `copies` times, by two arrays of bounded size."""
    count = F.col("copies")
    rows = matched.withColumn(
        "_block", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((count - 1) / F.lit(_BLOCK))))
    )
    size = F.least(F.lit(_BLOCK).cast("bigint"), count - F.col("_block") * _BLOCK).cast("int")
    return rows.withColumn("_copy", F.explode(F.array_repeat(F.lit(True), size)))


def orphan_keys(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """(key, rows) of child rows without a parent; a NULL key is an orphan.

    Counted per key before the join: no child row is shuffled, and a hot key arrives as
    one row per input partition. Both sides are then partitioned alike already.
    """
    counted = child.groupBy(key).agg(F.count("*").alias("rows"))
    return counted.join(parent.select(key).distinct(), key, "left_anti")


def orphan_count(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """One row with the number of orphaned child rows."""
    total = F.coalesce(F.sum("rows"), F.lit(0)).cast("bigint")
    return orphan_keys(child, parent, key).agg(total.alias("orphans"))
