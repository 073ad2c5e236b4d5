from pyspark.sql import functions as F

from millrace.operators.profile import BOUND_ROWS, approximate_profile, profile, profile_all
from conftest import final_plan, plan
from millrace.sources import legacy_views


def by_column(df):
    return {r.column: r for r in df.collect()}


def test_counts_and_samples(spark):
    values = [(str(i % 7), None if i % 4 else "x", "m") for i in range(40)]
    df = spark.createDataFrame(values, "a string, b string, batch_id string")
    got = by_column(profile(df))
    assert set(got) == {"a", "b"}
    assert got["a"][1:] == (40, 0, 0.0, 7, ["0", "1", "2", "3", "4"])
    assert got["b"][1:] == (40, 30, 75.0, 1, ["x"])


def test_all_null_column_and_empty_text(spark):
    df = spark.createDataFrame([(None, ""), (None, "a")], "a string, b string")
    got = by_column(profile(df))
    assert got["a"][1:] == (2, 2, 100.0, 0, [])
    assert got["b"][1:] == (2, 0, 0.0, 2, ["", "a"])


def test_empty_table_lists_its_columns(spark):
    df = spark.createDataFrame([], "a string, b string")
    assert {tuple(r)[1:5] for r in profile(df).collect()} == {(0, 0, 0.0, 0)}
    assert len(profile(df).collect()) == 2
    assert approximate_profile(df).count() == 2


def test_percentage_rounds_half_up(spark):
    df = spark.createDataFrame([(None if i < 1 else "v",) for i in range(400)], "a string")
    assert by_column(profile(df))["a"].null_pct == 0.3


def test_approximate_profile_agrees_on_counts(spark, sf_small):
    df = legacy_views.transactions(spark, sf_small)
    exact, rough = by_column(profile(df)), by_column(approximate_profile(df))
    for column, row in rough.items():
        assert row[1:4] == exact[column][1:4]
        assert abs(row.distinct - exact[column].distinct) <= 0.1 * exact[column].distinct
    assert "Expand" not in plan(approximate_profile(df))


def test_counts_and_samples_share_one_shuffle(spark, sf_small):
    df = profile(legacy_views.orders(spark, sf_small))
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert "ReusedExchange" in text
    # Every scan but the first is reused, so the table is read once.
    assert text.count("FileScan") == 1


def test_samples_sort_only_values_up_to_a_bound(spark):
    """The smallest values come last, beside columns of few values and of none in the rows read first."""
    count = 4 * BOUND_ROWS
    df = spark.range(count, numPartitions=1).select(
        F.format_string("%06d", count - F.col("id")).alias("a"),
        F.expr("IF(id % 3 = 0, NULL, id % 4)").cast("string").alias("b"),
        F.expr(f"IF(id < {2 * BOUND_ROWS}, NULL, id % 7)").cast("string").alias("c"),
        F.lit(None).cast("string").alias("d"),
    )
    got = by_column(profile(df))
    assert got["a"][4:] == (count, [f"{i:06d}" for i in range(1, 6)])
    assert got["b"][4:] == (4, ["0", "1", "2", "3"])
    assert got["c"][4:] == (7, ["0", "1", "2", "3", "4"])
    assert got["d"][1:] == (count, count, 100.0, 0, [])
    # Below the first sort for the samples lies the bound.
    text = final_plan(profile(df))
    assert "bound#" in text[text.index("WindowGroupLimit") :]


def test_profile_all_names_sources(spark, sf_small):
    got = profile_all(legacy_views.all_views(spark, sf_small)).collect()
    assert len(got) == 23
    assert {r.table for r in got} == {
        "bronze_customers",
        "bronze_orders",
        "bronze_transactions",
        "bronze_products",
    }
