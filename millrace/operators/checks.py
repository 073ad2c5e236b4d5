"""Validation checks. Each returns rows, the caller decides what a FAIL means."""

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace import vocab
from millrace.operators.references import orphan_count, orphan_keys


def union_all(parts) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def row_count(df: DataFrame, name: str = "rows") -> DataFrame:
    return df.agg(F.count("*").alias(name))


def _results(counts: DataFrame, check: str, items: dict) -> DataFrame:
    """A one-row frame of counts as (check_name, item, value, passed); zero passes."""
    rows = [
        F.struct(
            F.lit(check).alias("check_name"),
            F.lit(item).alias("item"),
            F.coalesce(F.col(column), F.lit(0)).cast("bigint").alias("value"),
        )
        for item, column in items.items()
    ]
    return counts.select(F.inline(F.array(*rows))).withColumn("passed", F.col("value") == 0)


# --- row counts -------------------------------------------------------------------------


def table_counts(tables: dict, batch_id: str | None = None) -> DataFrame:
    """(batch_id, table, rows), one row per table, zero rows included."""
    return union_all(
        [
            df.agg(
                F.lit(batch_id).cast("string").alias("batch_id"),
                F.lit(name).alias("table"),
                F.count("*").alias("rows"),
            )
            for name, df in tables.items()
        ]
    ).select("batch_id", "table", "rows")


def expected_counts(spark: SparkSession, expected=None) -> DataFrame:
    """(dataset, expected) from a dict, by default the published export sizes."""
    rows = list((vocab.EXPECTED_ROWS if expected is None else expected).items())
    return spark.createDataFrame(rows, "dataset string, expected bigint")


def written_counts(spark: SparkSession, rows: dict) -> DataFrame:
    """(layer, dataset, rows) from {(layer, dataset): rows}, as counted while the tables were written."""
    found = [(layer, dataset, n) for (layer, dataset), n in rows.items()]
    return spark.createDataFrame(found, "layer string, dataset string, rows bigint")


def load_reconciliation(tables: dict, expected: DataFrame) -> DataFrame:
    """(table, expected, loaded, status) per source plus an overall row, counting the tables."""
    return reconcile(table_counts(tables).select(F.col("table").alias("dataset"), "rows"), expected)


def reconcile(counts: DataFrame, expected: DataFrame) -> DataFrame:
    """The same from counts (dataset, rows).

    A table without an expected count, or the other way round, is a mismatch.
    """
    loaded = counts.select("dataset", F.col("rows").alias("loaded"))
    matches = F.col("expected") == F.col("loaded")
    per_table = expected.join(loaded, "dataset", "full").select(
        F.concat(F.lit("bronze_"), "dataset").alias("table"),
        "expected",
        F.coalesce("loaded", F.lit(0)).alias("loaded"),
        F.coalesce(matches, F.lit(False)).alias("matches"),
    )
    return (
        per_table.rollup("table")
        .agg(
            F.sum("expected").alias("expected"),
            F.sum("loaded").alias("loaded"),
            F.bool_and("matches").alias("matches"),
        )
        .select(
            F.coalesce("table", F.lit("overall")).alias("table"),
            "expected",
            "loaded",
            F.when(F.col("matches"), "OK").otherwise("MISMATCH").alias("status"),
        )
    )


def row_counts(expected: DataFrame, bronze: dict, gold: dict) -> DataFrame:
    """(dataset, source, bronze, gold, dropped, passed) of the tables, which are counted."""
    both = [
        df.agg(
            F.lit(layer).alias("layer"),
            F.lit(dataset).alias("dataset"),
            F.count("*").alias("rows"),
        )
        for layer, tables in (("bronze", bronze), ("gold", gold))
        for dataset, df in tables.items()
    ]
    return compare_layers(expected, union_all(both))


def compare_layers(expected: DataFrame, counts: DataFrame) -> DataFrame:
    """The same from counts (layer, dataset, rows); bronze has to equal the source.

    A dataset without an expected count does not pass.
    """
    layers = counts.groupBy("dataset").agg(
        F.sum(F.when(F.col("layer") == "bronze", F.col("rows"))).alias("bronze"),
        F.sum(F.when(F.col("layer") == "gold", F.col("rows"))).alias("gold"),
    )
    return expected.join(layers, "dataset", "full").select(
        "dataset",
        F.col("expected").alias("source"),
        "bronze",
        "gold",
        (F.col("expected") - F.col("gold")).alias("dropped"),
        F.coalesce(F.col("bronze") == F.col("expected"), F.lit(False)).alias("passed"),
    )


# --- keys and nulls ---------------------------------------------------------------------


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """(key, rows) of keys that occur more than once; NULL is a key."""
    return df.groupBy(key).agg(F.count("*").alias("rows")).where("rows > 1")


def key_profile(df: DataFrame, key: str, columns=()) -> DataFrame:
    """One row: rows, duplicate_keys, duplicate_set_keys (NULL ignored), nulls_<column>.

    Everything the key and null checks need, from one scan of the key columns and one
    shuffle of keys with map-side combining.
    """
    columns = list(columns)
    per_key = df.groupBy(F.col(key).alias("_key")).agg(
        F.count("*").alias("n"),
        *[F.count_if(F.col(c).isNull()).alias(f"nulls_{c}") for c in columns],
    )
    repeated = F.col("n") > 1
    return per_key.agg(
        F.sum("n").alias("rows"),
        F.count_if(repeated).alias("duplicate_keys"),
        F.count_if(repeated & F.col("_key").isNotNull()).alias("duplicate_set_keys"),
        *[F.sum(f"nulls_{c}").alias(f"nulls_{c}") for c in columns],
    )


def null_counts(df: DataFrame, columns) -> DataFrame:
    """One row of nulls_<column>, without a shuffle of rows."""
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(f"nulls_{c}") for c in columns])


def duplicate_check(gold: dict) -> DataFrame:
    parts = []
    for dataset, table in vocab.GOLD_TABLES.items():
        key = vocab.PRIMARY_KEYS[dataset]
        counts = duplicate_keys(gold[dataset], key).agg(F.count("*").alias("groups"))
        parts.append(_results(counts, vocab.DUPLICATE_CHECK, {f"{table}.{key}": "groups"}))
    return union_all(parts)


def null_check(gold: dict) -> DataFrame:
    parts = []
    for dataset, table in vocab.GOLD_TABLES.items():
        columns = vocab.MANDATORY_COLUMNS[table]
        items = {f"{table}.{c}": f"nulls_{c}" for c in columns}
        parts.append(_results(null_counts(gold[dataset], columns), vocab.NULL_CHECK, items))
    return union_all(parts)


def reference_check(gold: dict) -> DataFrame:
    """Orphans counted as a left join would: a NULL foreign key is one."""
    pairs = {
        "Orphaned orders (no matching customer)": ("orders", "customers", "customer_id"),
        "Orphaned transactions (no matching order)": ("transactions", "orders", "order_id"),
    }
    return union_all(
        [
            _results(
                orphan_count(gold[child], gold[parent], key), vocab.REFERENCE_CHECK, {item: "orphans"}
            )
            for item, (child, parent, key) in pairs.items()
        ]
    )


# --- declared column tests --------------------------------------------------------------


def declared_unique(tables: dict) -> DataFrame:
    """Repeated non-null keys per declared unique column."""
    parts = []
    for table, tests in vocab.DECLARED_CHECKS.items():
        for column in tests["unique"]:
            counts = key_profile(tables[table], column)
            parts.append(_results(counts, "unique", {f"{table}.{column}": "duplicate_set_keys"}))
    return union_all(parts)


def declared_not_null(tables: dict) -> DataFrame:
    parts = []
    for table, tests in vocab.DECLARED_CHECKS.items():
        columns = tests["not_null"]
        items = {f"{table}.{c}": f"nulls_{c}" for c in columns}
        parts.append(_results(null_counts(tables[table], columns), "not_null", items))
    return union_all(parts)


def declared_relationships(tables: dict) -> DataFrame:
    """Child rows whose set foreign key has no parent; NULL keys pass."""
    parts = []
    for table, tests in vocab.DECLARED_CHECKS.items():
        for column, parent in tests["relationships"]:
            child = tables[table].where(F.col(column).isNotNull())
            counts = orphan_count(child, tables[parent], column)
            parts.append(
                _results(counts, "relationships", {f"{table}.{column} -> {parent}": "orphans"})
            )
    return union_all(parts)


# --- all checks together ----------------------------------------------------------------


def validate(expected: DataFrame, bronze: dict, gold: dict, counts: DataFrame | None = None) -> DataFrame:
    """The four checks as (check_name, item, value, passed).

    Duplicate keys and nulls of a published table come from the same pass. Bronze is counted,
    unless `counts` (layer, dataset, rows) has its rows.
    """
    parts = []
    counted = []
    for dataset, table in vocab.GOLD_TABLES.items():
        key, columns = vocab.PRIMARY_KEYS[dataset], vocab.MANDATORY_COLUMNS[table]
        profile = key_profile(gold[dataset], key, columns)
        rows = [(vocab.DUPLICATE_CHECK, f"{table}.{key}", "duplicate_keys")]
        rows += [(vocab.NULL_CHECK, f"{table}.{c}", f"nulls_{c}") for c in columns]
        results = [
            F.struct(
                F.lit(check).alias("check_name"),
                F.lit(item).alias("item"),
                F.coalesce(F.col(column), F.lit(0)).cast("bigint").alias("value"),
            )
            for check, item, column in rows
        ]
        parts.append(
            profile.select(F.inline(F.array(*results))).withColumn("passed", F.col("value") == 0)
        )
        if counts is None:
            counted.append(row_count(bronze[dataset], "n").select(F.lit(dataset).alias("dataset"), "n"))
    if counts is None:
        loaded = union_all(counted)
    else:
        loaded = counts.where("layer = 'bronze'").select("dataset", F.col("rows").alias("n"))
    # Without an expected count, or without a table, the check fails.
    none = F.lit(0).cast("bigint")
    missing = expected.join(loaded, "dataset", "full").select(
        F.lit(vocab.ROW_COUNT_CHECK).alias("check_name"),
        F.concat(F.lit("bronze_"), "dataset").alias("item"),
        (F.coalesce("expected", none) - F.coalesce("n", none)).alias("value"),
        F.coalesce(F.col("expected") == F.col("n"), F.lit(False)).alias("passed"),
    )
    parts.append(missing)
    parts.append(reference_check(gold))
    return union_all(parts)


def all_pass(passed: Column) -> Column:
    """True when every row passes; no rows at all is not a pass."""
    return F.coalesce(F.bool_and(passed), F.lit(False))


def summarize(results: DataFrame) -> DataFrame:
    """(check_name, passed) per check and an `overall` row."""
    return (
        results.rollup("check_name")
        .agg(all_pass(F.col("passed")).alias("passed"))
        .select(F.coalesce("check_name", F.lit("overall")).alias("check_name"), "passed")
    )
