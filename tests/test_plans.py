"""Layer transforms: published sizes, quirks that are part of the rules, and plan shape."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as registry
from conftest import plan, rows
from millrace import vocab
from millrace.functions import to_id, to_int
from millrace.operators.references import orphan_count
from millrace.plans import silver
from millrace.sources.landing import text_schema

# (bronze, silver, NULL ids in silver, repeated keys) on the medium tables.
SIZES = {
    "customers": (1530, 1414, 0, 0),
    "orders": (15030, 11526, 0, 24),
    "transactions": (60000, 42190, 0, 8306),
    "products": (2040, 1888, 1, 0),
}


@pytest.fixture(scope="module")
def layers(spark, sf_medium):
    return registry.Layers(spark, sf_medium).stored()


@pytest.mark.parametrize("source", list(SIZES))
def test_sizes(layers, source):
    bronze, rows_, nulls, repeated = SIZES[source]
    key = vocab.PRIMARY_KEYS[source]
    table = layers.silver[source]
    assert layers.bronze[source].count() == bronze
    assert table.count() == rows_
    assert table.where(F.col(key).isNull()).count() == nulls
    assert table.where(F.col(key).isNotNull()).groupBy(key).count().where("count > 1").count() == repeated
    assert layers.gold[source].count() == rows_ - nulls


def test_one_word_names_have_no_last_name(layers):
    assert layers.silver["customers"].where("last_name IS NULL").count() == 110


def test_orphans_before_the_join(layers):
    """Of all bronze rows, and of those with a key."""
    bronze, stored = layers.bronze, layers.silver
    keys = {
        "orders": (to_id(F.col("customer_id")).alias("customer_id"), "customers", "customer_id"),
        "transactions": (to_int(F.col("order_id")).alias("order_id"), "orders", "order_id"),
    }
    every, keyed = {}, {}
    for child, (column, parent, key) in keys.items():
        every[child] = orphan_count(bronze[child].select(column), stored[parent], key).first()[0]
        with_key = bronze[child].where(F.col(vocab.PRIMARY_KEYS[child]).isNotNull())
        keyed[child] = orphan_count(with_key.select(column), stored[parent], key).first()[0]
    assert every == {"orders": 2891, "transactions": 15745}
    assert keyed == {"orders": 2754, "transactions": 14982}


def source(spark, name, *values):
    return spark.createDataFrame(list(values), text_schema(vocab.SOURCE_COLUMNS[name]))


def test_non_numeric_keys(spark):
    """Customers drop them, products keep one row, orders and transactions keep all."""
    customers = source(spark, "customers", ("x", "A", *[None] * 4), ("1.0", "B", *[None] * 4))
    assert rows(silver.silver_customers(customers).select("customer_id")) == [(1,)]
    products = source(spark, "products", ("x", "b", *[None] * 3), ("w", "a", *[None] * 3))
    assert rows(silver.silver_products(products).select("product_id", "product_name")) == [(None, "a")]
    orders = source(spark, "orders", ("x", "1.0", *[None] * 4), ("y", "1.0", *[None] * 4))
    parents = spark.createDataFrame([(1,)], "customer_id int")
    assert silver.silver_orders(orders, parents).count() == 2


def test_transaction_modes(spark):
    bronze = source(spark, "transactions", ("1.0", "5", None, "1", None, "Y"))
    orders = spark.createDataFrame([(5,), (5,)], "order_id int")
    assert silver.silver_transactions(bronze, orders).count() == 2
    assert silver.silver_transactions(bronze, orders, mode="semi").count() == 1


# The text operators and the pipeline have tests of their own.
STAR_QUERIES = sorted(q for q in registry.queries() if q != "pipeline" and not re.match(r"op\d+_", q))


@pytest.mark.parametrize("name", STAR_QUERIES)
def test_no_python_and_no_cross_join(name, spark, sf_small):
    text = plan(registry.queries()[name](spark, sf_small))
    for node in ("PythonUDF", "ArrowEvalPython", "MapInPandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in text


ROW_QUERIES = [
    *(f"bronze_{s}" for s in vocab.SOURCE_FILES),
    *(f"silver_{s}" for s in vocab.SOURCE_FILES),
    *(f"quarantine_{s}" for s in vocab.SOURCE_FILES),
    *vocab.GOLD_TABLES.values(),
    "dedup_customers",
    "dedup_products",
    "ref_filter_semi",
    "duplicate_key_rows",
    "quarantine_all",
    "quarantine_ids",
    "quarantine_id_ranges",
]


@pytest.mark.parametrize("source", list(vocab.SOURCE_FILES))
def test_quarantine_moves_no_row(source, spark, sf_small):
    assert "Exchange" not in plan(registry.queries()[f"quarantine_{source}"](spark, sf_small))


@pytest.mark.parametrize("name", ROW_QUERIES)
def test_rows_never_meet_in_one_partition(name, spark, sf_small):
    assert "SinglePartition" not in plan(registry.queries()[name](spark, sf_small))


def test_stored_tables_are_pruned_and_filtered_at_the_scan(layers):
    text = plan(layers.gold["orders"].select("customer_id"))
    assert "PushedFilters: [IsNotNull(order_id)]" in text
    assert "ReadSchema: struct<order_id:int,customer_id:int>" in text


def test_transaction_join_reads_only_parent_keys(spark, sf_small):
    text = plan(registry.Layers(spark, sf_small).silver["transactions"])
    assert "o_totalprice" not in text
    assert "o_orderdate" not in text
