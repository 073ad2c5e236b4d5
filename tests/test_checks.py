import pytest

from millrace import vocab
from millrace.operators import checks
from conftest import plan


@pytest.fixture
def gold(spark):
    return {
        "customers": spark.createDataFrame(
            [(1, "A", "B"), (2, "C", None)], "customer_id int, first_name string, last_name string"
        ),
        "products": spark.createDataFrame([(1, "p")], "product_id int, product_name string"),
        "orders": spark.createDataFrame([(10, 1), (10, 1), (11, 3)], "order_id int, customer_id int"),
        "transactions": spark.createDataFrame(
            [(1, 10), (2, 99), (3, None)], "transaction_id int, order_id int"
        ),
    }


def values(df):
    return {r["item"]: (r["value"], r["passed"]) for r in df.collect()}


def test_duplicates(gold):
    got = values(checks.duplicate_check(gold))
    assert got["fact_orders.order_id"] == (1, False)
    assert got["dim_customers.customer_id"] == (0, True)


def test_nulls(gold):
    got = values(checks.null_check(gold))
    assert len(got) == 9
    assert got["dim_customers.last_name"] == (1, False)
    assert got["fact_transactions.order_id"] == (1, False)
    assert got["fact_transactions.transaction_id"] == (0, True)


def test_references(gold):
    assert values(checks.reference_check(gold)) == {
        "Orphaned orders (no matching customer)": (1, False),
        "Orphaned transactions (no matching order)": (2, False),
    }


def test_null_key_is_a_duplicate_only_where_nulls_count(spark):
    df = spark.createDataFrame([(None,), (None,), (1,)], "k int")
    counts = checks.key_profile(df, "k", ["k"]).first()
    assert (counts.rows, counts.duplicate_keys, counts.duplicate_set_keys, counts.nulls_k) == (3, 1, 0, 2)
    assert checks.duplicate_keys(df, "k").count() == 1


def test_empty_tables_pass(spark, gold):
    empty = {s: df.limit(0) for s, df in gold.items()}
    for check in (checks.duplicate_check, checks.null_check, checks.reference_check):
        assert all(r.passed for r in check(empty).collect())


def test_declared(gold):
    tables = {f"silver_{s}": df for s, df in gold.items()}
    tables |= {vocab.GOLD_TABLES[s]: df for s, df in gold.items()}
    assert values(checks.declared_unique(tables))["silver_orders.order_id"] == (1, False)
    assert values(checks.declared_not_null(tables))["silver_transactions.order_id"] == (1, False)
    assert len(values(checks.declared_not_null(tables))) == 10
    got = values(checks.declared_relationships(tables))
    assert got["silver_orders.customer_id -> silver_customers"] == (1, False)
    # The NULL key passes here, unlike in the referential check.
    assert got["silver_transactions.order_id -> silver_orders"] == (1, False)


def test_load_reconciliation(spark, gold):
    expected = checks.expected_counts(spark, {"customers": 2, "orders": 4})
    tables = {s: gold[s] for s in ("customers", "orders")}
    got = {r.table: (r.expected, r.loaded, r.status) for r in checks.load_reconciliation(tables, expected).collect()}
    assert got == {
        "bronze_customers": (2, 2, "OK"),
        "bronze_orders": (4, 3, "MISMATCH"),
        "overall": (6, 5, "MISMATCH"),
    }


def test_row_counts(spark, gold):
    expected = checks.expected_counts(spark, {"customers": 5, "orders": 3})
    bronze = {"customers": spark.range(5), "orders": spark.range(4)}
    got = {r.dataset: tuple(r)[1:] for r in checks.row_counts(expected, bronze, gold).collect()}
    assert got["customers"] == (5, 5, 2, 3, True)
    assert got["orders"] == (3, 4, 3, 0, False)
    # Without an expected count nothing passes.
    assert got["products"] == (None, None, 1, None, False)


def test_tables_without_an_expected_count_fail(spark, gold):
    expected = checks.expected_counts(spark, {"customers": 2})
    status = {r.table: r.status for r in checks.load_reconciliation(gold, expected).collect()}
    assert status == {
        "bronze_customers": "OK",
        **{f"bronze_{s}": "MISMATCH" for s in ("orders", "products", "transactions")},
        "overall": "MISMATCH",
    }
    counts = checks.validate(expected, gold, gold).where(f"check_name = '{vocab.ROW_COUNT_CHECK}'")
    assert {r["item"] for r in counts.where("NOT passed").collect()} == {
        "bronze_orders",
        "bronze_products",
        "bronze_transactions",
    }


def test_no_expected_counts_are_not_the_default(spark):
    assert checks.expected_counts(spark, {}).count() == 0


def test_default_expected_counts(spark):
    assert {r.dataset: r.expected for r in checks.expected_counts(spark).collect()} == vocab.EXPECTED_ROWS


def test_summary(spark):
    results = spark.createDataFrame([("a", True), ("a", False), ("b", True)], "check_name string, passed boolean")
    got = {r.check_name: r.passed for r in checks.summarize(results).collect()}
    assert got == {"a": False, "b": True, "overall": False}
    assert checks.summarize(results.limit(0)).where("passed").count() == 0


def test_validate_equals_the_single_checks(spark, gold):
    bronze = {s: spark.range(n) for s, n in vocab.EXPECTED_ROWS.items()}
    got = values(checks.validate(checks.expected_counts(spark), bronze, gold))
    singles = {}
    for check in (checks.duplicate_check, checks.null_check, checks.reference_check):
        singles |= values(check(gold))
    counts = {f"bronze_{s}": (0, True) for s in vocab.EXPECTED_ROWS}
    assert len(checks.validate(checks.expected_counts(spark), bronze, gold).collect()) == 19
    # Key columns appear in both the duplicate and the null check.
    shared = {f"{t}.{vocab.PRIMARY_KEYS[s]}" for s, t in vocab.GOLD_TABLES.items()}
    for item, value in (singles | counts).items():
        if item not in shared:
            assert got[item] == value


def test_key_check_shuffles_keys_only(spark, sf_small):
    orders = spark.read.parquet(f"{sf_small}/orders.parquet")
    text = plan(checks.key_profile(orders, "o_orderkey", ["o_custkey"]))
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint>" in text
    assert text.count("Exchange hashpartitioning") == 1
