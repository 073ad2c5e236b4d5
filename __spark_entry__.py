"""Registered queries: `entry`, `queries` and `oracle_sql`."""

from __future__ import annotations

import os
import sys
import uuid
from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)
# Python workers of a session that starts from here find the package as well.
if ROOT not in os.environ.get("PYTHONPATH", "").split(os.pathsep):
    os.environ["PYTHONPATH"] = os.pathsep.join(filter(None, [ROOT, os.environ.get("PYTHONPATH")]))

import oracles  # noqa: E402
from millrace import functions as fn  # noqa: E402
from millrace import vocab  # noqa: E402
from millrace.operators import checks, dedup, references  # noqa: E402
from millrace.operators.distinct import (  # noqa: E402
    count_bitmaps,
    exact_distinct,
    id_bitmaps,
    merge_bitmaps,
)
from millrace.operators.profile import (  # noqa: E402
    approximate_profile,
    merge_profiles,
    profile,
    profile_all,
    profile_sketches,
)
from millrace.operators.quarantine import number_groups, number_rows  # noqa: E402
from millrace.plans import rules, silver  # noqa: E402
from millrace.plans.gold import gold_table, orders_by_status  # noqa: E402
from millrace.plans.migration import (  # noqa: E402
    BAD_RECORDS,
    Migration,
    build_gold,
    build_silver,
    point_bad_records,
    reload_bad_records,
    run_migration,
    store_violations,
)
from millrace.session import materialize, shared_dir  # noqa: E402
from millrace.sources import landing, legacy_views  # noqa: E402
from millrace.sources.tables import column_inventory, inventory_changes  # noqa: E402

# The text operators are optional: without their folder the rest is registered alone.
try:
    from millrace.llm import queries as text_queries
except ModuleNotFoundError as missing:
    if not str(missing.name).startswith("millrace.llm"):
        raise
    text_queries = None

# The pipeline is optional as well.
try:
    import corpus_pipeline
except ModuleNotFoundError as missing:
    if missing.name != "corpus_pipeline" and not str(missing.name).startswith("millrace.llm"):
        raise
    corpus_pipeline = None

REJECTED_AT = legacy_views.INGESTED_AT
# The table each legacy source is derived from.
DERIVED_FROM = {"customers": "customer", "orders": "orders", "transactions": "lineitem", "products": "part"}


class Tables(Mapping):
    """Named DataFrames, each built on first use."""

    def __init__(self, makers: dict):
        self._makers, self._made = makers, {}

    def __getitem__(self, name):
        if name not in self._made:
            self._made[name] = self._makers[name]()
        return self._made[name]

    def __iter__(self):
        return iter(self._makers)

    def __len__(self):
        return len(self._makers)


class Layers:
    """The layers over one scale folder, each built when first asked for.

    A query over one table is one plan. `stored()` is for queries that read a silver table
    several times.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self.bronze = Tables(
            {s: lambda view=view: view(spark, sf_dir) for s, view in legacy_views.VIEWS.items()}
        )
        bronze = self.bronze
        self.silver = Tables(
            {
                "customers": lambda: silver.silver_customers(bronze["customers"]),
                "orders": lambda: silver.silver_orders(
                    bronze["orders"], silver.customer_keys(bronze["customers"])
                ),
                "transactions": lambda: silver.silver_transactions(
                    bronze["transactions"], self.silver["orders"]
                ),
                "products": lambda: silver.silver_products(bronze["products"]),
            }
        )
        self.gold = Tables(
            {
                s: lambda s=s, name=name: gold_table(name, self.silver[s])
                for s, name in vocab.GOLD_TABLES.items()
            }
        )

    def stored(self) -> Layers:
        """Silver tables are written, parents before children, as a run does."""
        run = uuid.uuid4().hex
        folder = f"{shared_dir(self.spark)}/run-{run}"
        self.silver = build_silver(self.bronze, folder, f"run_{run}_")
        return self

    @property
    def declared(self) -> Mapping:
        """Silver and gold tables under their published names."""
        named = {f"silver_{s}": lambda s=s: self.silver[s] for s in self.silver}
        return Tables(named | {vocab.GOLD_TABLES[s]: lambda s=s: self.gold[s] for s in self.gold})

    def expected(self) -> DataFrame:
        """Source sizes: rows of the raw tables, so sources with repeated rows do not match."""
        counts = [
            self.spark.read.parquet(f"{self.sf_dir}/{table}.parquet").agg(
                F.lit(dataset).alias("dataset"), F.count("*").alias("expected")
            )
            for dataset, table in DERIVED_FROM.items()
        ]
        return checks.union_all(counts)


def _bronze(source):
    return lambda spark, sf: legacy_views.VIEWS[source](spark, sf)


def _silver(source):
    return lambda spark, sf: Layers(spark, sf).silver[source]


def _gold(source):
    """From the stored silver table, as in a run: its keys are parsed once, not again for the filter."""

    def run(spark, sf):
        made = materialize(Layers(spark, sf).silver[source], f"silver_{source}")
        return gold_table(vocab.GOLD_TABLES[source], made)

    return run


def _quarantine(source):
    return lambda spark, sf: rules.quarantine_source(_bronze(source)(spark, sf), source, REJECTED_AT)


def _profile(source):
    return lambda spark, sf: _samples_as_text(profile(_bronze(source)(spark, sf)))


def _profile_counts(spark, sf):
    """The exact part of the one-pass profile of the largest source."""
    return approximate_profile(_bronze("transactions")(spark, sf)).select("column", "total", "nulls", "null_pct")


def _samples_as_text(df: DataFrame) -> DataFrame:
    return df.withColumn("samples", F.concat_ws(", ", "samples"))


def _csv_copy(spark: SparkSession, sf: str, source: str) -> str:
    """The source's raw text written as CSV to the shared folder."""
    path = f"{shared_dir(spark)}/landing-{uuid.uuid4().hex}/{source}"
    text = _bronze(source)(spark, sf).drop(*vocab.LINEAGE_COLUMNS)
    text.write.options(**landing.csv_options()).csv(path)
    return path


def _csv(source):
    def run(spark, sf):
        return landing.land(
            spark,
            source,
            _csv_copy(spark, sf, source),
            legacy_views.INGESTED_AT,
            legacy_views.BATCH_ID,
            vocab.SOURCE_FILES[source],
        )

    return run


def _csv_header_products(spark, sf):
    text = landing.read_text_csv(spark, _csv_copy(spark, sf, "products"))
    return landing.with_lineage(
        text, legacy_views.INGESTED_AT, legacy_views.BATCH_ID, vocab.SOURCE_FILES["products"]
    )


def _csv_reordered_customers(spark, sf):
    """Landed by name from files whose columns come in the reverse order."""
    path = f"{shared_dir(spark)}/landing-{uuid.uuid4().hex}"
    text = _bronze("customers")(spark, sf).select(*reversed(vocab.SOURCE_COLUMNS["customers"]))
    text.write.options(**landing.csv_options()).csv(path)
    name = vocab.SOURCE_FILES["customers"]
    return landing.land(spark, "customers", path, legacy_views.INGESTED_AT, legacy_views.BATCH_ID, name)


def _csv_extra_fields(spark, sf):
    """Lines with a field beyond the header, per file."""
    path = f"{shared_dir(spark)}/landing-{uuid.uuid4().hex}"
    surplus = F.when(F.col("product_id").like("%5.0"), F.lit("SUP,surplus")).otherwise(F.col("supplier_code"))
    text = _bronze("products")(spark, sf).drop(*vocab.LINEAGE_COLUMNS).withColumn("supplier_code", surplus)
    text.write.options(**landing.csv_options()).option("quote", "\u0000").csv(path)
    lines = materialize(landing.uneven_lines(spark, "products", path), "uneven-lines")
    return lines.groupBy("source_file").agg(F.count("*").alias("lines"))


# One run per session and scale folder; its tables are read by several queries.
_RUNS: dict[tuple[str, str], Migration] = {}


def _migrated(spark: SparkSession, sf: str) -> Migration:
    """The whole run over CSV copies of the sources, published in the shared folder."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _RUNS:
        run = uuid.uuid4().hex
        folder = f"{shared_dir(spark)}/run-{run}"
        for source, name in vocab.SOURCE_FILES.items():
            text = _bronze(source)(spark, sf).drop(*vocab.LINEAGE_COLUMNS)
            text.write.options(**landing.csv_options()).csv(f"{folder}/landing/{name}")
        expected = {r["dataset"]: r["expected"] for r in Layers(spark, sf).expected().collect()}
        _RUNS[key] = run_migration(
            spark,
            f"{folder}/landing",
            f"{folder}/tables",
            expected,
            legacy_views.BATCH_ID,
            legacy_views.INGESTED_AT,
            f"run_{run}_",
            REJECTED_AT,
        )
    return _RUNS[key]


def _published(pick: Callable[[Migration], DataFrame]):
    return lambda spark, sf: pick(_migrated(spark, sf))


def _reloaded_ids(spark, sf):
    """Id ranges after the violations of one source were written again beside the others."""
    run = uuid.uuid4().hex
    folder, prefix = f"{shared_dir(spark)}/run-{run}", f"run_{run}_"
    bronze = legacy_views.all_views(spark, sf)
    stored = {s: store_violations(df, s, folder, REJECTED_AT, prefix) for s, df in bronze.items()}
    point_bad_records(spark, stored, prefix)
    found = reload_bad_records(bronze["orders"], "orders", folder, REJECTED_AT, prefix)
    return _id_ranges(found)


# Buckets of the registered queries over bucketed layers.
BUCKETS = 16


def _bucketed(spark, sf) -> dict:
    """Silver and gold tables in buckets of their keys, published under names of their own."""
    run = uuid.uuid4().hex
    folder, prefix = f"{shared_dir(spark)}/run-{run}", f"run_{run}_"
    made = build_silver(legacy_views.all_views(spark, sf), folder, prefix, BUCKETS)
    return build_gold(made, folder, prefix, BUCKETS)


def _csv_semicolon_customers(spark, sf):
    """Landed from files with another separator, which is found from their header."""
    path = f"{shared_dir(spark)}/landing-{uuid.uuid4().hex}"
    text = _bronze("customers")(spark, sf).drop(*vocab.LINEAGE_COLUMNS)
    text.write.options(**landing.csv_options(sep=";")).csv(path)
    name = vocab.SOURCE_FILES["customers"]
    return landing.land(
        spark, "customers", path, legacy_views.INGESTED_AT, legacy_views.BATCH_ID, name, sep=None
    )


def _source_presence(spark, sf):
    """Of four registered sources, the two written so far are there."""
    folder = f"{shared_dir(spark)}/landing-{uuid.uuid4().hex}"
    for source in ("customers", "products"):
        text = _bronze(source)(spark, sf).drop(*vocab.LINEAGE_COLUMNS)
        text.write.options(**landing.csv_options()).csv(f"{folder}/{vocab.SOURCE_FILES[source]}")
    return landing.presence(spark, folder).select("source", "source_file", "present")


def _inventory_changes(spark, sf):
    """The landed products against an export with a column more, one less, and two that changed places."""
    before = landing.land(
        spark, "products", _csv_copy(spark, sf, "products"), legacy_views.INGESTED_AT, legacy_views.BATCH_ID
    )
    path = f"{shared_dir(spark)}/landing-{uuid.uuid4().hex}"
    changed = _bronze("products")(spark, sf).select(
        "product_name", "product_id", "category", F.lit("red").alias("colour"), "unit_price"
    )
    changed.write.options(**landing.csv_options()).csv(path)
    now = landing.with_lineage(
        landing.read_text_csv(spark, path), legacy_views.INGESTED_AT, legacy_views.BATCH_ID
    )
    tables = [column_inventory(spark, {"bronze_products": df}) for df in (before, now)]
    return inventory_changes(*tables)


# Ids of bronze tables: (source, column, how its text is read).
IDS = (
    ("customers", "customer_id", fn.to_id),
    ("orders", "order_id", fn.to_id),
    ("orders", "customer_id", fn.to_id),
    ("transactions", "transaction_id", fn.to_id),
    ("transactions", "order_id", fn.to_int),
    ("products", "product_id", fn.to_id),
)


def _distinct_ids(spark, sf):
    """Distinct ids per id column, by bitmaps."""
    parts = []
    for source, column, read in IDS:
        counted = exact_distinct(_bronze(source)(spark, sf), read(F.col(column)), "ids")
        parts.append(counted.select(F.lit(source).alias("source"), F.lit(column).alias("column"), "ids"))
    return checks.union_all(parts)


def _in_batches(df: DataFrame, column: str) -> DataFrame:
    """The rows dealt to three batches, as if exported one after the other."""
    return df.withColumn("batch", F.pmod(F.hash(column), F.lit(3)))


def _merged_distinct_ids(spark, sf):
    """The same from bitmaps stored per batch; ids that several batches hold count once."""
    parts = []
    for source, column, read in IDS:
        batches = _in_batches(_bronze(source)(spark, sf), vocab.SOURCE_COLUMNS[source][-1])
        stored = materialize(id_bitmaps(batches, read(F.col(column)), "batch"), "bitmaps")
        counted = count_bitmaps(merge_bitmaps(stored), "ids")
        parts.append(counted.select(F.lit(source).alias("source"), F.lit(column).alias("column"), "ids"))
    return checks.union_all(parts)


def _merged_profiles(spark, sf):
    """Profiles merged from sketches stored per batch: exact counts, and whether the estimate is near.

    Near is within four standard errors of the exact number of distinct values.
    """
    parts = []
    for source in vocab.SOURCE_FILES:
        df = _bronze(source)(spark, sf)
        batches = _in_batches(df, vocab.SOURCE_COLUMNS[source][-1])
        stored = materialize(profile_sketches(batches, vocab.LINEAGE_COLUMNS, "batch"), "sketches")
        exact = profile(df).select("column", F.col("distinct").alias("exact"))
        error = F.abs(F.col("distinct") - F.col("exact"))
        near = error <= F.greatest(F.lit(1.0), 4 * 1.04 / 64 * F.col("exact"))
        merged = merge_profiles(stored).join(exact, "column").withColumn("near", near)
        parts.append(merged.select(F.lit(source).alias("source"), "column", "total", "nulls", "null_pct", "near"))
    return checks.union_all(parts)


def _load_reconciliation(spark, sf):
    layers = Layers(spark, sf)
    return checks.load_reconciliation(layers.bronze, layers.expected())


def _run_summary(spark, sf):
    bronze = legacy_views.all_views(spark, sf)
    return checks.table_counts({f"bronze_{s}": df for s, df in bronze.items()}, legacy_views.BATCH_ID)


def _stored_fact_orders(spark, sf):
    return materialize(Layers(spark, sf).gold["orders"], "fact_orders")


def _stored_star(spark, sf):
    gold = Layers(spark, sf).stored().gold
    named = {
        vocab.GOLD_TABLES[s]: materialize(df, vocab.GOLD_TABLES[s]) for s, df in gold.items()
    }
    return checks.table_counts(named).drop("batch_id")


def _dedup_customers(spark, sf):
    typed = silver.typed_customers(_bronze("customers")(spark, sf))
    return dedup.first_per_key(typed, "customer_id", ["raw_key"])


def _dedup_products(spark, sf):
    typed = silver.typed_products(_bronze("products")(spark, sf))
    return dedup.first_per_key(typed, "product_id", ["raw_key"])


def _ref_filter_semi(spark, sf):
    layers = Layers(spark, sf)
    return silver.silver_transactions(layers.bronze["transactions"], layers.silver["orders"], "semi")


def _ref_filter_inner(spark, sf):
    """Rows and distinct transactions per order: repeated orders repeat their transactions."""
    per_transaction = (
        Layers(spark, sf)
        .silver["transactions"]
        .groupBy("order_id", "transaction_id")
        .agg(F.count("*").alias("n"))
    )
    return per_transaction.groupBy("order_id").agg(
        F.sum("n").alias("rows"), F.count("transaction_id").alias("transactions")
    )


def _orphans_orders(spark, sf):
    bronze = legacy_views.all_views(spark, sf)
    typed, parents = silver.typed_orders(bronze["orders"]), silver.customer_keys(bronze["customers"])
    return references.orphan_count(typed, parents, "customer_id")


def _orphan_keys_transactions(spark, sf):
    layers = Layers(spark, sf)
    typed = silver.typed_transactions(layers.bronze["transactions"])
    return references.orphan_keys(typed, layers.silver["orders"], "order_id")


def _orphans_transactions(spark, sf):
    return _orphan_keys_transactions(spark, sf).agg(
        F.coalesce(F.sum("rows"), F.lit(0)).cast("bigint").alias("orphans")
    )


def _quarantine_ids(spark, sf):
    found = rules.quarantine_all(legacy_views.all_views(spark, sf), REJECTED_AT)
    return number_rows(found, ["rule", "raw_record"]).select(*BAD_RECORDS)


def _quarantine_id_ranges(spark, sf):
    """First and last id, sum of ids and rows per rule, numbered where the rows lie.

    Ids from first to last without a gap or a repetition have the sum they have to have.
    """
    found = rules.quarantine_all(legacy_views.all_views(spark, sf), REJECTED_AT)
    return _id_ranges(number_groups(found, "rule"))


def _id_ranges(numbered: DataFrame) -> DataFrame:
    return numbered.groupBy("rejection_reason").agg(
        F.min("id").alias("first_id"),
        F.max("id").alias("last_id"),
        F.sum("id").alias("id_sum"),
        F.count("*").alias("rows"),
    )


def _date_violations(broken: Callable[[], Column]):
    def run(spark, sf):
        orders = _bronze("orders")(spark, sf).where(broken())
        return orders.groupBy("order_date").agg(F.count("*").alias("rows"))

    return run


def _date_invalid() -> Column:
    date = F.col("order_date")
    return date.isNotNull() & fn.parse_order_date(date).isNull()


def _shown(source: str, column: str, convert: Callable[[Column], Column]):
    """A conforming operator on every raw text of a column, with the number of rows.

    Texts are counted before they are converted, so each distinct text is converted once.
    """

    def run(spark, sf):
        raw = F.col(column).alias("raw")
        texts = _bronze(source)(spark, sf).groupBy(raw).agg(F.count("*").alias("rows"))
        made = convert(F.col("raw"))
        if isinstance(made, Column):
            made = {"value": made}
        return texts.select("raw", *[c.alias(name) for name, c in made.items()], "rows")

    return run


def _stored(make: Callable[[Layers], DataFrame]):
    return lambda spark, sf: make(Layers(spark, sf).stored())


def _validation(layers: Layers) -> DataFrame:
    return checks.validate(layers.expected(), layers.bronze, layers.gold)


def entry(spark: SparkSession) -> DataFrame:
    """Orders per conformed status over the published orders."""
    return queries()["orders_by_status"](spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    out: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
    for source in vocab.SOURCE_FILES:
        out[f"bronze_{source}"] = _bronze(source)
        out[f"csv_bronze_{source}"] = _csv(source)
        out[f"silver_{source}"] = _silver(source)
        out[vocab.GOLD_TABLES[source]] = _gold(source)
        out[f"quarantine_{source}"] = _quarantine(source)
        out[f"profile_{source}"] = _profile(source)
        out[f"published_{vocab.GOLD_TABLES[source]}"] = _published(lambda run, s=source: run.gold[s])
    if text_queries:
        out |= text_queries.QUERIES
    if corpus_pipeline:
        out["pipeline"] = corpus_pipeline.run
    return out | {
        "csv_header_products": _csv_header_products,
        "csv_reordered_customers": _csv_reordered_customers,
        "csv_extra_fields": _csv_extra_fields,
        "published_bad_records": _published(lambda run: run.bad_records.drop("id")),
        "published_profile": _published(lambda run: _samples_as_text(run.profile)),
        "published_validation": _published(lambda run: run.validation),
        "published_row_counts": _published(lambda run: run.row_counts),
        "published_table_counts": _published(lambda run: run.table_counts),
        "published_inventory": _published(
            lambda run: run.inventory.where("`table` LIKE 'bronze%' OR `table` LIKE 'gold%'")
        ),
        "reloaded_bad_record_ids": _reloaded_ids,
        "bucketed_fact_transactions": lambda spark, sf: _bucketed(spark, sf)["transactions"],
        "bucketed_ref_integrity": lambda spark, sf: checks.reference_check(_bucketed(spark, sf)),
        "csv_semicolon_customers": _csv_semicolon_customers,
        "source_presence": _source_presence,
        "distinct_ids": _distinct_ids,
        "merged_distinct_ids": _merged_distinct_ids,
        "merged_profiles": _merged_profiles,
        "inventory_changes": _inventory_changes,
        "published_run_summary": _published(lambda run: run.summary.drop("started_at", "seconds")),
        "load_reconciliation": _load_reconciliation,
        "run_summary": _run_summary,
        "stored_fact_orders": _stored_fact_orders,
        "stored_star": _stored_star,
        "orders_by_status": lambda spark, sf: orders_by_status(_gold("orders")(spark, sf)),
        "dedup_customers": _dedup_customers,
        "dedup_products": _dedup_products,
        "ref_filter_semi": _ref_filter_semi,
        "ref_filter_inner": _ref_filter_inner,
        "orphans_orders": _orphans_orders,
        "orphans_transactions": _orphans_transactions,
        "orphan_keys_transactions": _orphan_keys_transactions,
        "quarantine_all": lambda spark, sf: rules.quarantine_all(
            legacy_views.all_views(spark, sf), REJECTED_AT
        ),
        "quarantine_summary": lambda spark, sf: rules.quarantine_summary(
            legacy_views.all_views(spark, sf)
        ),
        "quarantine_ids": _quarantine_ids,
        "quarantine_id_ranges": _quarantine_id_ranges,
        "date_shape_violations": _date_violations(rules.order_date_misshapen),
        "date_validity_violations": _date_violations(_date_invalid),
        "parse_dates_customers": _shown(
            "customers", "signup_date", lambda c: fn.parse_date(c, vocab.CUSTOMER_DATE_FORMATS)
        ),
        "parse_dates_orders": _shown("orders", "order_date", fn.parse_order_date),
        "parse_dates_transactions": _shown(
            "transactions",
            "transaction_date",
            lambda c: fn.parse_date(c, vocab.TRANSACTION_DATE_FORMATS),
        ),
        "parse_currency": _shown("orders", "total_amount", fn.parse_currency),
        "map_customer_status": _shown(
            "customers", "status", lambda c: fn.map_values(c, vocab.CUSTOMER_STATUS)
        ),
        "map_order_status": _shown("orders", "status", lambda c: fn.map_values(c, vocab.ORDER_STATUS)),
        "map_payment": _shown(
            "transactions", "payment_method", lambda c: fn.map_values(c, vocab.PAYMENT_METHOD)
        ),
        "map_flag": _shown(
            "transactions", "success_flag", lambda c: fn.map_values(c, vocab.SUCCESS_FLAG)
        ),
        "split_names": _shown(
            "customers",
            "full_name",
            lambda c: {"first_name": fn.first_name(c), "last_name": fn.last_name(c)},
        ),
        "conform_email": _shown("customers", "email", fn.conform_lower),
        "conform_phone": _shown("customers", "phone_number", fn.conform_text),
        "conform_channel": _shown("orders", "channel", fn.conform_lower),
        "sentence_case": _shown("products", "category", fn.sentence_case),
        "blank_to_null": _shown("products", "supplier_code", fn.blank_to_null),
        "lenient_number": _shown("products", "unit_price", fn.to_double),
        "to_id": _shown("customers", "customer_id", fn.to_id),
        "to_int": _shown("transactions", "order_id", fn.to_int),
        "profile_all": lambda spark, sf: _samples_as_text(
            profile_all(legacy_views.all_views(spark, sf))
        ),
        "profile_counts": _profile_counts,
        "row_counts": _stored(lambda x: checks.row_counts(x.expected(), x.bronze, x.gold)),
        "duplicate_keys": _stored(lambda x: checks.duplicate_check(x.gold)),
        "duplicate_key_rows": lambda spark, sf: checks.duplicate_keys(
            _gold("transactions")(spark, sf), "transaction_id"
        ),
        "null_checks": _stored(lambda x: checks.null_check(x.gold)),
        "ref_integrity": _stored(lambda x: checks.reference_check(x.gold)),
        "declared_unique": _stored(lambda x: checks.declared_unique(x.declared)),
        "declared_not_null": _stored(lambda x: checks.declared_not_null(x.declared)),
        "declared_relationships": _stored(lambda x: checks.declared_relationships(x.declared)),
        "validation_results": _stored(_validation),
        "validation_summary": _stored(lambda x: checks.summarize(_validation(x))),
    }


def oracle_sql() -> dict[str, str]:
    out = oracles.statements()
    if text_queries:
        out |= text_queries.ORACLE_SQL
    if corpus_pipeline and corpus_pipeline.ORACLE_SQL:
        out["pipeline"] = corpus_pipeline.ORACLE_SQL
    return out
