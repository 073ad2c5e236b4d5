from collections import Counter

import pytest
from pyspark.sql import functions as F

from conftest import final_plan, plan, rows
from millrace.operators import references as ref
from millrace.operators.dedup import first_per_key


@pytest.fixture
def child(spark):
    values = [(1, "a"), (1, "b"), (2, "c"), (3, "d"), (None, "e"), (9, "f")]
    return spark.createDataFrame(values, "k int, v string")


@pytest.fixture
def parent(spark):
    return spark.createDataFrame([(1,), (1,), (1,), (2,), (None,), (5,)], "k int")


def test_keep_referenced_never_repeats(child, parent):
    assert rows(ref.keep_referenced(child, parent, "k")) == [(1, "a"), (1, "b"), (2, "c")]
    unique = parent.distinct()
    assert rows(ref.keep_referenced(child, unique, "k", unique_parent=True)) == [
        (1, "a"),
        (1, "b"),
        (2, "c"),
    ]


def test_match_parent_is_the_inner_join(child, parent):
    joined = child.join(parent, "k").select("k", "v")
    got = ref.match_parent(child, parent, "k")
    assert got.columns == child.columns
    assert rows(got) == rows(joined)
    assert Counter(r.v for r in got.collect()) == {"a": 3, "b": 3, "c": 1}


@pytest.mark.parametrize("copies", [1, 4095, 4096, 4097, 8192, 10000])
def test_many_copies_of_a_parent(spark, copies):
    child = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    parent = spark.range(copies).select(F.lit(1).alias("k"))
    assert ref.match_parent(child, parent, "k").count() == copies


def test_orphans_count_null_keys(child, parent):
    assert rows(ref.orphan_keys(child, parent, "k")) == [(3, 1), (9, 1), (None, 1)]
    assert ref.orphan_count(child, parent, "k").first().orphans == 3
    assert ref.orphan_count(child.limit(0), parent, "k").first().orphans == 0


@pytest.fixture
def skewed(spark, conf):
    conf(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__coalescePartitions__enabled="false",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="64k",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="64k",
    )
    key = F.when(F.col("id") % 3 == 0, 7).otherwise((F.col("id") % 1000).cast("int"))
    child = spark.range(0, 300000, 1, 16).select(
        key.alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("v")
    )
    parent = spark.range(0, 900, 1, 4).select(F.col("id").cast("int").alias("k"))
    return child, parent.union(parent.where("k % 10 = 0")), key


@pytest.mark.parametrize("join", [ref.keep_referenced, ref.match_parent])
def test_hot_child_key_is_split(skewed, join):
    child, parent, _ = skewed
    df = join(child, parent, "k")
    text = final_plan(df)
    assert "SortMergeJoin(skew=true)" in text
    repeats = 18000 if join is ref.match_parent else 0
    assert df.count() == 280000 + repeats


def test_hot_parent_key_is_counted_before_the_shuffle(spark):
    child = spark.createDataFrame([(1, "a")], "k int, v string")
    parent = spark.range(0, 30000, 1, 8).select(F.lit(1).alias("k"))
    text = plan(ref.match_parent(child, parent, "k"))
    below = text[text.index("hashpartitioning") :]
    assert "partial_count" in below


def test_orphans_shuffle_counts_only(skewed):
    child, parent, _ = skewed
    text = plan(ref.orphan_count(child, parent, "k"))
    # Exchanges: counted child, distinct parent, and the one-row total.
    assert text.count("Exchange") == 3
    assert "sha2" not in text


def test_first_per_key_orders_by_raw_then_content(spark):
    values = [
        (1, "10", "b"),
        (1, "1.0", "z"),
        (1, "1.0", "a"),
        (None, "x2", "c"),
        (None, "x1", "d"),
        (2, "2", None),
        (2, "2", "a"),
    ]
    df = spark.createDataFrame(values, "k int, raw string, v string").repartition(4)
    assert rows(first_per_key(df, "k", ["raw"])) == rows(
        spark.createDataFrame([(1, "1.0", "a"), (None, "x1", "d"), (2, "2", None)], df.schema)
    )


def test_dedup_trims_each_partition_before_the_shuffle(spark):
    df = spark.range(0, 1000, 1, 8).select((F.col("id") % 2).alias("k"), F.col("id").alias("raw"))
    text = plan(first_per_key(df, "k", ["raw"]))
    exchange = text.index("Exchange hashpartitioning")
    assert "WindowGroupLimit" in text[exchange:]
    got = first_per_key(df, "k", ["raw"])
    assert rows(got) == [(0, 0), (1, 1)]
