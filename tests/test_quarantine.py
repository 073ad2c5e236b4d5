from pyspark.sql import functions as F

from conftest import plan, rows
from millrace import vocab
from millrace.operators.quarantine import number_groups, number_rows
from millrace.plans import rules
from millrace.sources import legacy_views
from millrace.sources.landing import text_schema

AT = "2024-01-01T00:00:00+00:00"

# Violations per rule on the medium test tables, checked with both engines.
EXPECTED = {
    1: 88,
    2: 654,
    3: 218,
    4: 750,
    5: 1367,
    6: 2147,
    7: 1875,
    8: 2902,
    9: 17211,
    10: 6581,
    11: 8548,
    12: 96,
    13: 520,
    14: 346,
}


def test_violations_per_rule(spark, sf_medium):
    found = rules.quarantine_all(legacy_views.all_views(spark, sf_medium), AT)
    assert {r.rule: r["count"] for r in found.groupBy("rule").count().collect()} == EXPECTED


def customers(spark, *values):
    return spark.createDataFrame(list(values), text_schema(vocab.SOURCE_COLUMNS["customers"]))


def test_record_breaking_three_rules_is_listed_three_times(spark):
    df = customers(spark, ("x", "A B", None, None, "1994/01/02", ""), ("2.0", "C", None, None, None, None))
    found = rules.quarantine_source(df, "customers", AT).orderBy("rule").collect()
    assert [r.rejection_reason for r in found] == [vocab.REASONS[n] for n in (1, 2, 3)]
    assert len({r.raw_record for r in found}) == 1
    assert {r.source_file for r in found} == {vocab.SOURCE_FILES["customers"]}


def test_summary_counts_records_once_and_lists_silent_rules(spark):
    df = customers(spark, ("x", "A", None, None, "bad", "Act"), ("1", "B", None, None, "bad", None))
    got = {(r.source_file, r.rejection_reason): (r.violations, r.records)
           for r in rules.quarantine_summary({"customers": df}).collect()}
    file = vocab.SOURCE_FILES["customers"]
    assert got == {
        (file, vocab.REASONS[1]): (1, 1),
        (file, vocab.REASONS[2]): (2, 2),
        (file, vocab.REASONS[3]): (0, 0),
        (file, None): (3, 2),
        (None, None): (3, 2),
    }


def test_summary_of_nothing_is_zero(spark):
    got = rules.quarantine_summary({"customers": customers(spark).limit(0)}).collect()
    assert len(got) == 5
    assert {(r.violations, r.records) for r in got} == {(0, 0)}


def test_all_rules_run_in_one_scan(spark, sf_small):
    text = plan(rules.quarantine_source(legacy_views.orders(spark, sf_small), "orders", AT))
    assert text.count("FileScan") == 1
    # Each rule is evaluated once: no second copy in a filter under the generator.
    assert text.count("RLIKE") == 1
    assert "size(" not in text


def test_rules_are_evaluated_without_a_shuffle(spark):
    df = customers(spark, ("x", "A", None, None, "bad", "Act"))
    assert "Exchange" not in plan(rules.quarantine_source(df, "customers", AT))


def test_ids_follow_the_order(spark):
    df = spark.range(0, 5000, 1, 7).select(
        (F.col("id") % 3).cast("int").alias("rule"), (F.col("id") * 7919 % 5000).alias("raw")
    )
    got = number_rows(df, ["rule", "raw"]).orderBy("id").collect()
    assert [r.id for r in got] == list(range(1, 5001))
    assert [(r.rule, r.raw) for r in got] == sorted((r.rule, r.raw) for r in got)


def test_equal_rows_spread_over_partitions(spark, conf):
    conf(spark__sql__adaptive__enabled="false")
    df = spark.range(0, 8000, 1, 8).select(F.lit(1).alias("rule"), F.lit("same").alias("raw"))
    numbered = number_rows(df, ["rule", "raw"])
    assert rows(numbered.select("id")) == sorted([(i,) for i in range(1, 8001)], key=repr)
    assert len(numbered.inputFiles()) > 4


def test_ids_by_group_are_contiguous_in_group_order(spark):
    df = spark.range(0, 5000, 1, 7).select(
        F.when(F.col("id") % 3 == 0, 9).otherwise(F.col("id") % 5).cast("int").alias("rule"),
        F.col("id").alias("raw"),
    )
    got = number_groups(df, "rule").orderBy("id").collect()
    assert [r.id for r in got] == list(range(1, 5001))
    assert [r.rule for r in got] == sorted(r.rule for r in got)
    assert sorted(r.raw for r in got) == list(range(5000))


def test_numbering_nothing(spark):
    df = spark.range(0).select(F.lit(1).alias("rule"), F.col("id").alias("raw"))
    assert number_rows(df, ["rule", "raw"]).count() == 0
    assert number_groups(df, "rule").count() == 0
