"""The full run: landing files to validated star schema, one stored table per step."""

import time
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace import vocab
from millrace.operators import checks
from millrace.operators.profile import profile_all
from millrace.operators.quarantine import number_groups
from millrace.plans import rules, silver
from millrace.plans.gold import COLUMNS, gold_table
from millrace.plans.steps import run_steps
from millrace.sources.landing import land_all, new_batch, presence, require_present, uneven_lines
from millrace.sources.tables import (
    Written,
    column_inventory,
    point,
    properties_of,
    publish,
    store_version,
)

BAD_RECORDS = ("id", "source_file", "rejection_reason", "rejected_at", "raw_record")
# The key that a layer's table is joined, checked or deduplicated by.
BUCKET_KEYS = {
    "customers": "customer_id",
    "orders": "order_id",
    "transactions": "transaction_id",
    "products": "product_id",
}
_ROWS = "millrace.rows"


@dataclass
class Migration:
    """What a run produced. Tables are read from storage."""

    batch_id: str
    bronze: dict
    bad_records: DataFrame
    profile: DataFrame
    silver: dict
    gold: dict
    validation: DataFrame
    row_counts: DataFrame
    uneven: DataFrame
    summary: DataFrame
    seconds: float
    table_counts: DataFrame
    inventory: DataFrame


def build_bronze(sources: dict, root: str, prefix: str = "", written: Written | None = None) -> dict:
    return {s: publish(df, f"{prefix}bronze.bronze_{s}", root, written=written) for s, df in sources.items()}


# --- quarantine -------------------------------------------------------------------------


def store_violations(
    bronze: DataFrame, source: str, root: str, rejected_at: str, prefix: str = "", written: Written | None = None
) -> tuple[str, int]:
    """Write one source's violations as a version, ids 1..n in rule order; returns its name and n."""
    found = rules.quarantine_source(bronze, source, rejected_at)
    numbered = number_groups(found, "rule", f"bad-records-{source}").select(*BAD_RECORDS)
    table, written = f"{prefix}bronze.bad_records_{source}", written or Written()
    return store_version(numbered, table, root, written=written), written.rows(table)


def point_bad_records(spark: SparkSession, stored: dict, prefix: str = "") -> DataFrame:
    """`bad_records` as the union of each source's stored version {source: (version, rows)}.

    Rules are numbered source by source, so a source's ids start after the rows of the sources before
    it: ids run 1..N whichever source was written last.
    """
    parts, before = [], 0
    others = ", ".join(BAD_RECORDS[2:])
    for source in vocab.SOURCE_FILES:
        version, rows = stored[source]
        # The file name as a constant, so that a filter on it reads its own source only.
        parts.append(f"SELECT id + {before} AS id, '{vocab.SOURCE_FILES[source]}' AS source_file, {others} FROM {version}")
        before += rows
    versions = [stored[s][0] for s in vocab.SOURCE_FILES]
    counts = ",".join(str(stored[s][1]) for s in vocab.SOURCE_FILES)
    return point(spark, f"{prefix}bronze.bad_records", " UNION ALL ".join(parts), versions, **{_ROWS: counts})


def build_bad_records(bronze: dict, root: str, rejected_at: str, prefix: str = "") -> DataFrame:
    """All violations in their declared columns, numbered 1..N in rule order without a shuffle."""
    stored = {s: store_violations(df, s, root, rejected_at, prefix) for s, df in bronze.items()}
    return point_bad_records(next(iter(bronze.values())).sparkSession, stored, prefix)


def reload_bad_records(bronze: DataFrame, source: str, root: str, rejected_at: str, prefix: str = "") -> DataFrame:
    """Replace one source's violations; files of the others are not touched, ids stay 1..N.

    Two reloads at the same time have to be kept apart by the caller: the later one would leave out
    the earlier one's rows.
    """
    spark, view = bronze.sparkSession, f"{prefix}bronze.bad_records"
    held = properties_of(spark, view)
    versions, counts = held["millrace.versions"].split(","), held[_ROWS].split(",")
    stored = {s: (v, int(n)) for s, v, n in zip(vocab.SOURCE_FILES, versions, counts)}
    stored[source] = store_violations(bronze, source, root, rejected_at, prefix)
    return point_bad_records(spark, stored, prefix)


# --- other tables of a run ----------------------------------------------------------------


def build_uneven_lines(
    spark: SparkSession, landing: str, root: str, prefix: str = "", written: Written | None = None, **read_options
) -> DataFrame:
    """Lines with more or fewer fields than their header: what a surplus field held stays visible."""
    parts = [
        uneven_lines(spark, s, f"{landing}/{name}", **read_options) for s, name in vocab.SOURCE_FILES.items()
    ]
    per_source = {
        source: F.count_if(F.col("source_file") == name) for source, name in vocab.SOURCE_FILES.items()
    }
    table = f"{prefix}bronze.uneven_lines"
    return publish(checks.union_all(parts), table, root, written=written, **(per_source if written else {}))


def run_summary(
    counts: DataFrame, uneven: DataFrame, expected: DataFrame, batch_id: str, started_at: str, seconds: float
) -> DataFrame:
    """(batch_id, table, rows, uneven_lines, status, started_at, seconds), one row per bronze table.

    From counts (dataset, rows) and uneven lines (dataset, uneven_lines); no table is read.
    """
    status = checks.reconcile(counts, expected).select("table", "status")
    loaded = counts.join(uneven, "dataset", "left").withColumn("table", F.concat(F.lit("bronze_"), "dataset"))
    return loaded.join(status, "table").select(
        F.lit(batch_id).alias("batch_id"),
        "table",
        "rows",
        F.coalesce("uneven_lines", F.lit(0)).cast("bigint").alias("uneven_lines"),
        "status",
        F.lit(started_at).alias("started_at"),
        F.lit(seconds).alias("seconds"),
    )


def store_silver(
    source: str, bronze: dict, parents: dict, root: str, prefix: str = "", buckets: int = 0, written: Written | None = None
) -> DataFrame:
    """One silver table. Its parent, if it has one, is the stored table in `parents`."""
    mode = "stored" if buckets else "inner"
    make = {
        "customers": lambda: silver.silver_customers(bronze["customers"]),
        "products": lambda: silver.silver_products(bronze["products"]),
        "orders": lambda: silver.silver_orders(bronze["orders"], parents["customers"], True, bool(buckets)),
        "transactions": lambda: silver.silver_transactions(bronze["transactions"], parents["orders"], mode),
    }[source]
    return publish(
        make(),
        f"{prefix}silver.silver_{source}",
        root,
        bucket_by=BUCKET_KEYS[source] if buckets else None,
        buckets=buckets,
        written=written,
    )


# The stored silver table that a source's rows have to refer to.
PARENTS = {"customers": (), "products": (), "orders": ("customers",), "transactions": ("orders",)}


def build_silver(bronze: dict, root: str, prefix: str = "", buckets: int = 0) -> dict:
    """Parents are stored before their children read them, so nothing is computed twice."""
    out: dict = {}
    for source in ("customers", "products", "orders", "transactions"):
        out[source] = store_silver(source, bronze, out, root, prefix, buckets)
    return out


def store_gold(
    source: str, silver_table: DataFrame, root: str, prefix: str = "", buckets: int = 0, written: Written | None = None
) -> DataFrame:
    name = vocab.GOLD_TABLES[source]
    return publish(
        gold_table(name, silver_table),
        f"{prefix}gold.{name}",
        root,
        bucket_by=COLUMNS[name][0] if buckets else None,
        buckets=buckets,
        written=written,
    )


def build_gold(silver_tables: dict, root: str, prefix: str = "", buckets: int = 0) -> dict:
    return {s: store_gold(s, silver_tables[s], root, prefix, buckets) for s in vocab.GOLD_TABLES}


def run_migration(
    spark: SparkSession,
    landing: str,
    root: str,
    expected: dict | None = None,
    batch_id: str | None = None,
    ingested_at: str | None = None,
    prefix: str = "",
    rejected_at: str | None = None,
    buckets: int = 0,
    at_once: int = 4,
    **read_options,
) -> Migration:
    """Land, quarantine, profile, clean, publish and validate.

    `landing` holds the four CSV exports, `root` is the table storage, both on storage all
    executors share. A failing check does not raise: `validation` says what failed.

    Steps that do not need each other run at the same time, `at_once` of them. Rows are counted while
    they are written; summary and row counts read no table. With `buckets`, silver and gold tables
    lie in so many buckets of their key, and joins and checks on it do not shuffle them.
    `read_options` are those of `read_text_csv`, such as `sep=None` to find the separator.
    """
    started = time.monotonic()
    new_id, now = new_batch()
    batch_id, ingested_at = batch_id or new_id, ingested_at or now
    rejected_at = rejected_at or new_batch()[1]
    require_present(presence(spark, landing), landing)
    sources = land_all(spark, landing, ingested_at, batch_id, **read_options)
    written, every = Written(), tuple(vocab.SOURCE_FILES)

    def bronze_step(s):
        return lambda: publish(sources[s], f"{prefix}bronze.bronze_{s}", root, written=written)

    def bad_step(s):
        return lambda df: store_violations(df, s, root, rejected_at, prefix, written)

    def silver_step(s):
        return lambda df, *parents: store_silver(
            s, {s: df}, dict(zip(PARENTS[s], parents)), root, prefix, buckets, written
        )

    def gold_step(s):
        return lambda df: store_gold(s, df, root, prefix, buckets, written)

    def profile_step(*tables):
        return publish(profile_all(dict(zip(every, tables))), f"{prefix}bronze.column_profile", root)

    steps: dict = {}
    for s in every:
        steps[f"bronze_{s}"] = ((), bronze_step(s))
    for s in every:
        steps[f"silver_{s}"] = ((f"bronze_{s}", *(f"silver_{p}" for p in PARENTS[s])), silver_step(s))
        steps[f"gold_{s}"] = ((f"silver_{s}",), gold_step(s))
    for s in every:
        steps[f"bad_{s}"] = ((f"bronze_{s}",), bad_step(s))
    steps["uneven"] = ((), lambda: build_uneven_lines(spark, landing, root, prefix, written, **read_options))
    steps["profile"] = (tuple(f"bronze_{s}" for s in every), profile_step)
    made = run_steps(spark, steps, at_once)

    bronze, silver_tables, gold = ({s: made[f"{layer}_{s}"] for s in every} for layer in ("bronze", "silver", "gold"))
    bad_records = point_bad_records(spark, {s: made[f"bad_{s}"] for s in every}, prefix)
    names = {("bronze", s): f"{prefix}bronze.bronze_{s}" for s in every}
    names |= {("silver", s): f"{prefix}silver.silver_{s}" for s in every}
    names |= {("gold", s): f"{prefix}gold.{vocab.GOLD_TABLES[s]}" for s in every}
    names |= {("bad_records", s): f"{prefix}bronze.bad_records_{s}" for s in every}
    counted = checks.written_counts(spark, {key: written.rows(table) for key, table in names.items()})
    table_counts = publish(counted, f"{prefix}gold.table_counts", root)
    inventory = publish(
        column_inventory(spark, {f"{layer}_{s}": made[f"{layer}_{s}"] for layer in ("bronze", "silver", "gold") for s in every}),
        f"{prefix}gold.column_inventory",
        root,
    )
    wanted = checks.expected_counts(spark, expected)
    validation = publish(checks.validate(wanted, bronze, gold, counted), f"{prefix}gold.validation", root)
    dropped = publish(checks.compare_layers(wanted, counted), f"{prefix}gold.row_counts", root)
    seconds = time.monotonic() - started
    lines = written.metrics[f"{prefix}bronze.uneven_lines"]
    uneven = spark.createDataFrame([(s, lines[s]) for s in every], "dataset string, uneven_lines bigint")
    loaded = counted.where("layer = 'bronze'").select("dataset", "rows")
    summary = publish(
        run_summary(loaded, uneven, wanted, batch_id, now, seconds), f"{prefix}gold.run_summary", root
    )
    return Migration(
        batch_id,
        bronze,
        bad_records,
        made["profile"],
        silver_tables,
        gold,
        validation,
        dropped,
        made["uneven"],
        summary,
        seconds,
        table_counts,
        inventory,
    )
