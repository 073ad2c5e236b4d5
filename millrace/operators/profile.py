"""Column profiles."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace import vocab

SAMPLES = 5
# Rows read before a profile to bound its samples.
BOUND_ROWS = 500


def _sample_bounds(cells: DataFrame) -> DataFrame:
    """(column, bound): no sample of the column is greater; NULL where nothing is known.

    The fifth smallest of any of a column's values is no less than that of all. At most BOUND_ROWS rows
    are taken, from the first partition that has them.
    """
    rows = cells.limit(BOUND_ROWS).collect()
    smallest = {c: sorted({r[c] for r in rows if r[c] is not None})[:SAMPLES] for c in cells.columns}
    bounds = [
        F.struct(
            F.lit(c).alias("column"),
            F.lit(values[-1] if len(values) == SAMPLES else None).cast("string").alias("bound"),
        )
        for c, values in smallest.items()
    ]
    return cells.sparkSession.range(1).select(F.inline(F.array(*bounds)))


def profile(df: DataFrame, exclude=vocab.LINEAGE_COLUMNS) -> DataFrame:
    """(column, total, nulls, null_pct, distinct, samples) for every column not excluded.

    Columns are turned into (column, value) rows and counted per pair first, with map-side
    combining, so the shuffle carries distinct values only and a value holding a third of
    the rows is one row per input partition. Counts and samples read the same shuffle.
    Samples are the five smallest distinct values; only values up to a bound are sorted for them.
    """
    columns = [c for c in df.columns if c not in exclude]
    cells = df.select(*[F.col(c).cast("string").alias(c) for c in columns])
    pairs = cells.unpivot([], columns, "column", "value").groupBy("column", "value")
    counted = pairs.agg(F.count("*").alias("n"))
    # A row of zero cells per column, so that an empty table still lists its columns.
    listed = df.sparkSession.range(1).select(
        F.explode(F.array(*[F.lit(c) for c in columns])).alias("column"),
        F.lit(None).cast("string").alias("value"),
        F.lit(0).cast("bigint").alias("n"),
    )
    stats = counted.union(listed).groupBy("column").agg(
        F.sum("n").alias("total"),
        F.sum(F.when(F.col("value").isNull(), F.col("n")).otherwise(0)).alias("nulls"),
        F.count("value").alias("distinct"),
    )
    # Takes the counts along and sorts NULL last instead of dropping it, to read the same
    # shuffle as `stats`.
    smallest = Window.partitionBy("column").orderBy(F.col("value").asc_nulls_last())
    bounds = F.broadcast(_sample_bounds(cells))
    low = F.coalesce(F.col("value") <= F.col("bound"), F.col("bound").isNull())
    candidates = counted.join(bounds, "column").where(low).drop("bound")
    placed = candidates.withColumn("place", F.row_number().over(smallest))
    kept = F.sort_array(F.collect_list(F.struct("value", "n")))
    samples = (
        placed.where(F.col("place") <= SAMPLES)
        .groupBy("column")
        .agg(F.filter(kept["value"], lambda v: v.isNotNull()).alias("samples"))
    )
    # At most five values per column, so small whatever the table's size.
    return stats.join(F.broadcast(samples), "column", "left").select(
        "column",
        "total",
        "nulls",
        _percentage(F.col("nulls"), F.col("total")).alias("null_pct"),
        "distinct",
        F.coalesce("samples", F.array().cast("array<string>")).alias("samples"),
    )


def _percentage(part: Column, total: Column) -> Column:
    """One decimal, half up; 0 of an empty table."""
    return F.when(total > 0, F.round(100.0 * part / total, 1)).otherwise(F.lit(0.0))


def approximate_profile(df: DataFrame, exclude=vocab.LINEAGE_COLUMNS, rsd: float = 0.02) -> DataFrame:
    """The same counts with an estimated `distinct` and no samples, in one pass.

    For wide or very large tables: one sketch per column instead of a shuffle of values.
    """
    columns = [c for c in df.columns if c not in exclude]
    sketches = df.agg(
        F.count("*").alias("total"),
        *[F.count_if(F.col(c).isNull()).alias(f"n{i}") for i, c in enumerate(columns)],
        *[F.approx_count_distinct(c, rsd).alias(f"d{i}") for i, c in enumerate(columns)],
    )
    rows = [
        F.struct(
            F.lit(c).alias("column"),
            F.col("total"),
            F.col(f"n{i}").alias("nulls"),
            _percentage(F.col(f"n{i}"), F.col("total")).alias("null_pct"),
            F.col(f"d{i}").alias("distinct"),
        )
        for i, c in enumerate(columns)
    ]
    return sketches.select(F.inline(F.array(*rows)))


# Registers of a stored sketch, as a power of two: a relative standard error of 1.04 / sqrt(4096).
SKETCH_BITS = 12


def profile_sketches(df: DataFrame, exclude=vocab.LINEAGE_COLUMNS, *batch: str) -> DataFrame:
    """(batch columns, column, total, nulls, sketch): a profile that can be merged, from one pass.

    One row per column, and per batch when batch columns are named. Stored per batch, a new export
    needs no second look at the earlier ones.
    """
    columns = [c for c in df.columns if c not in exclude and c not in batch]
    sketches = df.groupBy(*batch).agg(
        F.count("*").alias("total"),
        *[F.count_if(F.col(c).isNull()).alias(f"n{i}") for i, c in enumerate(columns)],
        *[F.hll_sketch_agg(F.col(c).cast("string"), SKETCH_BITS).alias(f"s{i}") for i, c in enumerate(columns)],
    )
    rows = [
        F.struct(
            F.lit(c).alias("column"),
            F.col("total"),
            F.col(f"n{i}").alias("nulls"),
            F.col(f"s{i}").alias("sketch"),
        )
        for i, c in enumerate(columns)
    ]
    return sketches.select(*batch, F.inline(F.array(*rows)))


def merge_profiles(sketches: DataFrame, *by: str) -> DataFrame:
    """(by, column, total, nulls, null_pct, distinct) over all batches: counts exact, `distinct` estimated."""
    merged = sketches.groupBy(*by, "column").agg(
        F.sum("total").alias("total"),
        F.sum("nulls").alias("nulls"),
        F.hll_union_agg("sketch").alias("sketch"),
    )
    return merged.select(
        *by,
        "column",
        "total",
        "nulls",
        _percentage(F.col("nulls"), F.col("total")).alias("null_pct"),
        F.hll_sketch_estimate("sketch").alias("distinct"),
    )


def profile_all(tables: dict, source_files=vocab.SOURCE_FILES) -> DataFrame:
    """Profiles of several bronze tables with table and source file names."""
    parts = [
        profile(df).select(
            F.lit(f"bronze_{source}").alias("table"),
            F.lit(source_files[source]).alias("source_file"),
            "*",
        )
        for source, df in tables.items()
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
