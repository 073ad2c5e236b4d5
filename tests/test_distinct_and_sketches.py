"""Exact distinct counts by bitmaps and profiles that can be merged."""

import pytest
from pyspark.sql import functions as F

from conftest import final_plan, plan, rows
from millrace.operators import distinct
from millrace.operators.profile import merge_profiles, profile, profile_sketches
from millrace.session import materialize
from millrace.sources import legacy_views

EDGES = [0, 1, -1, 32767, 32768, 32769, -32767, -32768, -32769, 2**31 - 1, -(2**31), 2**62, -(2**62)]


def count(df, column="id"):
    return distinct.count_bitmaps(distinct.id_bitmaps(df, F.col(column))).first()[0]


def test_edges_of_buckets(spark):
    table = spark.createDataFrame([(i,) for i in [*EDGES, *EDGES, None]], "id bigint")
    assert count(table) == len(EDGES)
    assert distinct.exact_distinct(table, F.col("id")).first()[0] == len(EDGES)


def test_a_range_around_zero(spark):
    assert count(spark.range(-70_000, 70_000).union(spark.range(-5, 100))) == 140_000


def test_nothing_to_count(spark):
    for rows_ in ([], [(None,)]):
        table = spark.createDataFrame(rows_, "id int")
        assert count(table) == 0
        assert distinct.exact_distinct(table, F.col("id")).first()[0] == 0


def test_batches_merge_exactly(spark):
    table = spark.range(100_000).selectExpr("id % 30011 AS id", "id % 7 AS batch")
    stored = materialize(distinct.id_bitmaps(table, F.col("id"), "batch"), "bitmaps")
    merged = distinct.merge_bitmaps(stored)
    assert merged.count() == 2
    assert distinct.count_bitmaps(merged).first()[0] == 30011
    per_batch = stored.groupBy("batch").agg(F.sum(F.bitmap_count("bits")).alias("n")).collect()
    expected = {r.batch: r.n for r in table.groupBy("batch").agg(F.count_distinct("id").alias("n")).collect()}
    assert {r.batch: r.n for r in per_batch} == expected


def test_dense_ids_shuffle_buckets_only(spark):
    dense = spark.range(0, 200_000, 1, 4)
    text = plan(distinct.exact_distinct(dense, F.col("id")))
    assert "bitmap_construct_agg" in text
    # What crosses the network: one row per bucket and partition.
    found = distinct.id_bitmaps(dense, F.col("id"))
    assert found.count() == 8
    assert final_plan(found).count("Exchange") == 1


def test_sparse_ids_are_shuffled_themselves(spark):
    sparse = spark.range(5000).selectExpr("xxhash64(id) AS id")
    df = distinct.exact_distinct(sparse, F.col("id"))
    assert "bitmap_construct_agg" not in plan(df)
    assert df.first()[0] == 5000


@pytest.mark.parametrize("source", list(legacy_views.VIEWS))
def test_merged_profile_against_the_exact_one(spark, sf_medium, source):
    df = legacy_views.VIEWS[source](spark, sf_medium)
    dealt = df.withColumn("batch", F.pmod(F.hash(df.columns[1]), F.lit(4)))
    stored = materialize(profile_sketches(dealt, (*("ingested_at", "source_file", "batch_id"),), "batch"), "sketches")
    merged = {r.column: r for r in merge_profiles(stored).collect()}
    exact = {r.column: r for r in profile(df).collect()}
    assert set(merged) == set(exact)
    for name, r in exact.items():
        m = merged[name]
        assert (m.total, m.nulls, m.null_pct) == (r.total, r.nulls, r.null_pct)
        assert abs(m.distinct - r.distinct) <= max(1, 0.065 * r.distinct)
    per_batch = merge_profiles(stored, "batch")
    assert per_batch.agg(F.sum("total")).first()[0] == sum(r.total for r in exact.values())


def test_sketches_do_not_depend_on_the_batches(spark):
    df = spark.range(20_000).selectExpr("CAST(id % 7777 AS STRING) AS a", "IF(id % 3 = 0, NULL, id) AS b", "id % 5 AS batch")
    one = merge_profiles(profile_sketches(df.drop("batch"), ()))
    many = merge_profiles(profile_sketches(df, (), "batch"))
    counts = ["column", "total", "nulls", "null_pct"]
    assert rows(one.select(counts)) == rows(many.select(counts))
    for a, b in zip(sorted(one.collect()), sorted(many.collect())):
        assert a.distinct == pytest.approx(b.distinct, rel=0.02)


def test_a_profile_of_sketches_is_one_pass(spark, sf_small):
    text = plan(profile_sketches(legacy_views.VIEWS["orders"](spark, sf_small)))
    assert text.count("FileScan") <= 2
    assert "hashpartitioning" not in text


def test_empty_tables(spark):
    none = spark.createDataFrame([], "a string, b string")
    found = merge_profiles(profile_sketches(none, ()))
    assert rows(found.select("column", "total", "nulls", "distinct")) == [("a", 0, 0, 0), ("b", 0, 0, 0)]
