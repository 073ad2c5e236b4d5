"""Quarantine: an audit copy of every (record, broken rule) pair."""

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions import row_json
from millrace.session import materialize


@dataclass(frozen=True)
class Rule:
    """A numbered rule; `broken` builds its predicate, and NULL counts as not broken."""

    number: int
    reason: str
    broken: Callable[[], Column]


def broken_rules(df: DataFrame, rules, source_file: str) -> DataFrame:
    """One row per (record, broken rule): the record's columns and four underscored ones.

    All rules are evaluated in one scan. `_first` marks one row per record, so records can
    be counted next to violations.
    """
    # Rules are evaluated once, in a projection of their own. The array of hits is built
    # inside the generator and its NULLs dropped after it: given a bare column, Catalyst
    # would filter on its size and evaluate every rule a second time below.
    broken = [f"_broken_{r.number}" for r in rules]
    judged = df.select(
        *df.columns,
        *[F.coalesce(r.broken(), F.lit(False)).alias(c) for r, c in zip(rules, broken)],
    )
    hits, earlier = [], F.lit(False)
    for rule, column in zip(rules, broken):
        hit = F.struct(
            F.lit(rule.number).alias("_rule"),
            F.lit(rule.reason).alias("_reason"),
            (~earlier).alias("_first"),
        )
        hits.append(F.when(F.col(column), hit))
        earlier = earlier | F.col(column)
    return (
        judged.select(*df.columns, F.explode(F.array(*hits)).alias("_hit"))
        .where(F.col("_hit").isNotNull())
        .select(*df.columns, F.lit(source_file).alias("_file"), "_hit.*")
    )


def quarantine(df: DataFrame, rules, source_file: str, rejected_at: str) -> DataFrame:
    """(rule, source_file, rejection_reason, rejected_at, raw_record) per violation."""
    return broken_rules(df, rules, source_file).select(
        F.col("_rule").alias("rule"),
        F.col("_file").alias("source_file"),
        F.col("_reason").alias("rejection_reason"),
        F.lit(rejected_at).alias("rejected_at"),
        row_json(df.columns).alias("raw_record"),
    )


def summarize(broken: DataFrame, rules_by_file: dict) -> DataFrame:
    """Violations per rule, per source file and overall; rules never broken show 0.

    `records` counts each record once: a record breaking three rules adds three
    violations but one record. Subtotal rows have a NULL rejection_reason, the grand
    total a NULL source_file as well.
    """
    spark = broken.sparkSession
    counted = broken.groupBy(F.col("_rule").alias("rule")).agg(
        F.count("*").alias("n"), F.count_if("_first").alias("firsts")
    )
    # The rule list itself: a handful of rows, whatever the data size.
    known = spark.createDataFrame(
        [(f, r.number, r.reason) for f, rules in rules_by_file.items() for r in rules],
        "source_file string, rule int, rejection_reason string",
    )
    per_rule = F.grouping("rejection_reason") == 0
    violations = F.coalesce(F.sum("n"), F.lit(0)).cast("bigint")
    records = F.coalesce(F.sum("firsts"), F.lit(0)).cast("bigint")
    return (
        known.join(counted, "rule", "left")
        .rollup("source_file", "rejection_reason")
        .agg(
            violations.alias("violations"),
            F.when(per_rule, violations).otherwise(records).alias("records"),
        )
    )


# monotonically_increasing_id: partition number in the upper bits, position in the lower 33.
_POSITION_BITS = 33
# Written partitions at most. It bounds the counts gathered on the driver and the offsets broadcast:
# one of each per written partition (and per group, of which there are a handful).
MAX_PARTS = 20_000


def _part_of(slot) -> Column:
    return F.shiftright(slot, _POSITION_BITS).cast("int")


def _with_offsets(stored: DataFrame, offsets: list, schema: str, on: list) -> DataFrame:
    """Join the offsets, bounded by MAX_PARTS, to the stored rows where they lie."""
    table = stored.sparkSession.createDataFrame(offsets, schema)
    return stored.join(F.broadcast(table), on)


def number_rows(df: DataFrame, order, name: str = "numbered") -> DataFrame:
    """Add `id` 1..N in the given order: the same ids for the same rows on any cluster.

    Rows are written once, so that sampling the ranges does not compute them again. They are then
    range-partitioned and sorted, with each row's input position as last key so that equal rows,
    however many, spread over partitions. The result is written before positions are counted, so a
    retry cannot renumber it. One count per written partition gives each its offset.

    All rows are shuffled once. Where ids need not be reproducible, `number_groups` moves
    no row.
    """
    spark = df.sparkSession
    found = materialize(df.withColumn("_origin", F.monotonically_increasing_id()), f"{name}-found")
    parts = min(int(spark.conf.get("spark.sql.shuffle.partitions")), MAX_PARTS)
    placed = (
        found.repartitionByRange(parts, *order, "_origin")
        .sortWithinPartitions(*order, "_origin")
        .drop("_origin")
        .withColumn("_slot", F.monotonically_increasing_id())
    )
    stored = materialize(placed, name).withColumn("_part", _part_of("_slot"))
    counted = stored.groupBy("_part").agg(F.count("*").alias("n")).collect()
    offsets, before = [], 0
    for row in sorted(counted):
        offsets.append((row["_part"], before))
        before += row["n"]
    position = F.col("_slot").bitwiseAND((1 << _POSITION_BITS) - 1)
    return _with_offsets(stored, offsets, "_part int, _offset bigint", ["_part"]).select(
        (F.col("_offset") + position + 1).alias("id"), *df.columns
    )


def number_groups(df: DataFrame, group: str, name: str = "numbered") -> DataFrame:
    """Add `id` 1..N, groups in order and rows within a group as they lie in storage.

    `group` has a small fixed set of values, such as the rule number. No row is shuffled:
    each partition is sorted by group where it is and written, and the offsets come from
    one count per (group, partition).
    """
    placed = (
        df.coalesce(MAX_PARTS)
        .sortWithinPartitions(group)
        .withColumn("_slot", F.monotonically_increasing_id())
    )
    stored = materialize(placed, name).withColumn("_part", _part_of("_slot"))
    runs = stored.groupBy(group, "_part").agg(
        F.count("*").alias("n"), F.min("_slot").alias("_first")
    )
    offsets, before = [], 0
    for row in sorted(runs.collect()):
        offsets.append((row[group], row["_part"], before - row["_first"]))
        before += row["n"]
    kind = stored.schema[group].dataType.simpleString()
    schema = f"`{group}` {kind}, _part int, _offset bigint"
    return _with_offsets(stored, offsets, schema, [group, "_part"]).select(
        (F.col("_offset") + F.col("_slot") + 1).alias("id"), *df.columns
    )
