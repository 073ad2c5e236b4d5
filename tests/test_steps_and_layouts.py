"""Steps at the same time, counts taken while writing, buckets, and replacement without a gap."""

import os
import re
import threading
import time

import pytest
from pyspark.sql import functions as F

from conftest import final_plan, plan, rows
from millrace import vocab
from millrace.operators import checks, references
from millrace.plans import migration, silver
from millrace.plans.steps import StepFailed, run_steps
from millrace.sources import legacy_views, tables
from millrace.sources.landing import csv_options, land, presence, require_present, separator_of
from millrace.sources.tables import Written, drop_superseded, publish, versions_of

AT = "2024-01-01T00:00:00+00:00"


# --- steps ------------------------------------------------------------------------------


def test_steps_wait_for_what_they_need(spark):
    order, lock = [], threading.Lock()

    def step(name, *given):
        with lock:
            order.append(name)
        return name + "".join(given)

    steps = {
        "c": (("a", "b"), lambda a, b: step("c", a, b)),
        "a": ((), lambda: step("a")),
        "b": (("a",), lambda a: step("b", a)),
    }
    assert run_steps(spark, steps) == {"a": "a", "b": "ba", "c": "caba"}
    assert order == ["a", "b", "c"]


def test_steps_overlap(spark):
    meet = threading.Barrier(3, timeout=30)

    def step():
        meet.wait()
        return spark.range(10).count()

    assert run_steps(spark, {n: ((), step) for n in "abc"}, at_once=3) == dict.fromkeys("abc", 10)


def test_a_failing_step_cancels_the_rest(spark):
    started = time.monotonic()
    late = []

    def fail():
        time.sleep(2)
        raise ValueError("no such thing")

    steps = {
        "slow": ((), lambda: spark.range(0, 8, 1, 8).selectExpr("reflect('java.lang.Thread', 'sleep', 40000L)").collect()),
        "broken": ((), fail),
        "after": (("broken",), late.append),
    }
    with pytest.raises(StepFailed, match="broken: no such thing"):
        run_steps(spark, steps)
    assert time.monotonic() - started < 35
    assert not late
    assert spark.range(3).count() == 3


def test_steps_that_cannot_start(spark):
    with pytest.raises(ValueError, match="not there"):
        run_steps(spark, {"a": (("b",), print)})
    with pytest.raises(ValueError, match="wait for each other"):
        run_steps(spark, {"a": (("b",), print), "b": (("a",), print)})


# --- counts while writing -----------------------------------------------------------------


@pytest.mark.parametrize("layout", [{}, {"partition_by": ["k"]}, {"bucket_by": "id", "buckets": 4}])
@pytest.mark.parametrize("size", [0, 1000])
def test_rows_are_counted_by_the_write(spark, tmp_path, layout, size):
    written = Written()
    df = spark.range(size).selectExpr("id", "id % 3 AS k")
    table = publish(df, "t_count.t", str(tmp_path), written=written, odd=F.count_if(F.col("id") % 2 == 1), **layout)
    assert written.metrics == {"t_count.t": {"rows": size, "odd": size // 2}}
    assert table.count() == size


def test_summary_and_row_counts_read_no_table(spark):
    counted = checks.written_counts(spark, {("bronze", "orders"): 5, ("gold", "orders"): 3})
    wanted = checks.expected_counts(spark, {"orders": 5})
    uneven = spark.createDataFrame([("orders", 1)], "dataset string, uneven_lines bigint")
    loaded = counted.where("layer = 'bronze'").select("dataset", "rows")
    summary = migration.run_summary(loaded, uneven, wanted, "b", AT, 1.0)
    layers = checks.compare_layers(wanted, counted)
    for df in (summary, layers, checks.reconcile(loaded, wanted)):
        assert "FileScan" not in plan(df)
    assert rows(summary) == [("b", "bronze_orders", 5, 1, "OK", AT, 1.0)]
    assert rows(layers) == [("orders", 5, 5, 3, 2, True)]


def test_validation_does_not_scan_bronze_for_its_counts(spark, sf_small):
    bronze = legacy_views.all_views(spark, sf_small)
    none = {s: df.limit(0) for s, df in bronze.items()}
    made = migration.build_silver(none, os.path.join(spark.conf.get("spark.checkpoint.dir"), "v"), "t_val_")
    gold = migration.build_gold(made, os.path.join(spark.conf.get("spark.checkpoint.dir"), "v"), "t_val_")
    counted = checks.written_counts(spark, {("bronze", s): 7 for s in bronze})
    found = checks.validate(checks.expected_counts(spark, {s: 7 for s in bronze}), {}, gold, counted)
    assert {r.item: r.passed for r in found.collect() if r.item.startswith("bronze")} == {
        f"bronze_{s}": True for s in bronze
    }


# --- buckets ----------------------------------------------------------------------------


@pytest.fixture(scope="module")
def bucketed(spark, sf_small, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("buckets"))
    bronze = legacy_views.all_views(spark, sf_small)
    made = migration.build_silver(bronze, root, "bk_", 8)
    return bronze, made, migration.build_gold(made, root, "bk_", 8)


def exchanges_over(text, table):
    """Exchanges of a plan that lie above a scan of the table: the indentation tells."""
    lines, found = text.split("\n"), []
    for i, line in enumerate(lines):
        if "FileScan" in line and table in line:
            depth = len(line) - len(line.lstrip(" :+-*(0123456789)"))
            for above in reversed(lines[:i]):
                indent = len(above) - len(above.lstrip(" :+-*(0123456789)"))
                if indent < depth:
                    depth = indent
                    if re.search(r"\bExchange hash", above):
                        found.append(above.strip())
                    if "Join" in above:
                        break
    return found


def test_bucketed_layers_hold_the_same_rows(spark, sf_small, bucketed):
    _, made, gold = bucketed
    plain = migration.build_silver(bucketed[0], spark.conf.get("spark.checkpoint.dir") + "/plain", "pl_")
    for source in vocab.SOURCE_FILES:
        assert rows(made[source]) == rows(plain[source])


def test_a_bucket_is_one_file(spark, bucketed):
    (stored,) = versions_of(spark, "bk_gold.fact_orders")
    location = spark.sql(f"DESCRIBE EXTENDED {stored}").where("col_name = 'Location'").first()[1]
    names = [n for n in os.listdir(location.removeprefix("file:")) if n.endswith(".parquet")]
    assert len(names) == 8


def test_stored_side_is_not_shuffled(conf, spark, bucketed):
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    bronze, made, gold = bucketed
    joined = plan(silver.silver_transactions(bronze["transactions"], made["orders"], "stored"))
    assert "Bucketed: true" in joined
    assert exchanges_over(joined, "silver_orders") == []
    for df in (
        checks.duplicate_keys(gold["transactions"], "transaction_id"),
        references.key_counts(gold["orders"], "order_id"),
        checks.key_profile(gold["products"], "product_id").select("rows"),
    ):
        assert "Exchange hashpartitioning" not in plan(df)
    orphans = plan(references.orphan_keys(gold["transactions"], gold["orders"], "order_id"))
    assert exchanges_over(orphans, "fact_orders") == []


def test_a_hot_bucket_is_not_read_by_one_task(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(tables, "BUCKET_BYTES", 1 << 10)
    noise = "sha2(CAST(id AS STRING), 512) AS noise"
    hot = spark.range(20_000).selectExpr("IF(id % 8 < 7, 5, id) AS k", noise)
    even = spark.range(20_000).selectExpr("id AS k", noise)
    assert "Bucketed: true" in plan(publish(even, "t_bk.even", str(tmp_path), bucket_by="k", buckets=8).groupBy("k").count())
    table = publish(hot, "t_bk.hot", str(tmp_path), bucket_by="k", buckets=8)
    assert "Bucketed: true" not in plan(table.groupBy("k").count())
    assert table.count() == 20_000


def test_hot_child_keys_meet_their_parents(spark, tmp_path, conf, monkeypatch):
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    monkeypatch.setattr(references, "_HOT", 4)
    monkeypatch.setattr(references, "_BLOCK", 3)
    child = spark.range(600).selectExpr("CAST(IF(id % 2 = 0, 7, IF(id % 5 = 0, NULL, id)) AS INT) AS k", "id AS n")
    parent = spark.range(50).selectExpr("CAST(id AS INT) AS k").union(spark.sql("SELECT 7 FROM range(10)"))
    stored = publish(parent, "t_bk.parent", str(tmp_path), bucket_by="k", buckets=4)
    assert [r.k for r in references.hot_keys(child, "k").collect()] == [7]
    assert rows(references.match_stored_parent(child, stored, "k")) == rows(references.match_parent(child, parent, "k"))
    unique = publish(parent.distinct(), "t_bk.unique", str(tmp_path), bucket_by="k", buckets=4)
    expected = rows(references.keep_referenced(child, parent, "k"))
    assert rows(references.keep_stored_referenced(child, unique, "k")) == expected
    # The hot rows are not shuffled: their join is a broadcast.
    assert "BroadcastHashJoin" in final_plan(references.match_stored_parent(child, stored, "k"))


def test_hot_keys_of_nothing(spark, tmp_path):
    none = spark.createDataFrame([], "k int, n int")
    stored = publish(spark.range(3).selectExpr("CAST(id AS INT) AS k"), "t_bk.some", str(tmp_path), bucket_by="k", buckets=4)
    assert references.match_stored_parent(none, stored, "k").count() == 0
    only_null = spark.createDataFrame([(None, 1)], "k int, n int")
    assert references.match_stored_parent(only_null, stored, "k").count() == 0


# --- replacement --------------------------------------------------------------------------


def test_a_reader_sees_the_old_table_or_the_new_one(spark, tmp_path):
    table, root = "t_swap.t", str(tmp_path)
    publish(spark.range(100).selectExpr("id"), table, root)
    seen, stop = set(), threading.Event()

    def read():
        while not stop.is_set():
            df = spark.table(table)
            seen.add((tuple(df.columns), df.count()))

    reader = threading.Thread(target=read)
    reader.start()
    publish(spark.range(200).selectExpr("id", "id % 2 AS part"), table, root, ["part"])
    publish(spark.range(300).selectExpr("CAST(id AS STRING) AS name"), table, root)
    publish(spark.range(400).selectExpr("id"), table, root, bucket_by="id", buckets=4)
    stop.set()
    reader.join()
    assert seen <= {(("id",), 100), (("id", "part"), 200), (("name",), 300), (("id",), 400)}
    assert spark.table(table).count() == 400


def test_a_failure_before_the_swap_leaves_the_old_table(spark, tmp_path, monkeypatch):
    table, root = "t_swap.kept", str(tmp_path)
    publish(spark.range(2), table, root)

    def fail(*_, **__):
        raise RuntimeError("no swap")

    monkeypatch.setattr(tables, "point", fail)
    with pytest.raises(RuntimeError, match="no swap"):
        publish(spark.range(5).selectExpr("id", "'x' AS more"), table, root)
    monkeypatch.undo()
    assert rows(spark.table(table)) == [(0,), (1,)]
    assert len(drop_superseded(spark, table, root)) == 1


def test_a_plain_table_of_that_name_is_replaced(spark, tmp_path):
    spark.sql("CREATE DATABASE IF NOT EXISTS t_swap")
    spark.range(2).write.saveAsTable("t_swap.plain")
    assert publish(spark.range(5), "t_swap.plain", str(tmp_path)).count() == 5


def files_of(spark, version):
    location = spark.sql(f"DESCRIBE EXTENDED {version}").where("col_name = 'Location'").first()[1]
    folder = location.removeprefix("file:")
    return {n: os.path.getmtime(os.path.join(folder, n)) for n in os.listdir(folder)}


def test_one_source_of_the_quarantine_is_reloaded(spark, sf_small, tmp_path):
    bronze, root = legacy_views.all_views(spark, sf_small), str(tmp_path)
    found = migration.build_bad_records(bronze, root, AT, "q_")
    before = {v: files_of(spark, v) for v in versions_of(spark, "q_bronze.bad_records")}
    everything = rows(found.drop("id"))
    total = found.count()

    fewer = bronze["orders"].where("order_id IS NOT NULL")
    found = migration.reload_bad_records(fewer, "orders", root, AT, "q_")
    after = {v: files_of(spark, v) for v in versions_of(spark, "q_bronze.bad_records")}
    kept = set(before) & set(after)
    assert len(kept) == 3 and all(before[v] == after[v] for v in kept)
    ids = sorted(r.id for r in found.select("id").collect())
    assert ids == list(range(1, len(ids) + 1)) and len(ids) < total

    found = migration.reload_bad_records(bronze["orders"].limit(0), "orders", root, AT, "q_")
    assert found.where(F.col("source_file") == vocab.SOURCE_FILES["orders"]).count() == 0
    found = migration.reload_bad_records(bronze["orders"], "orders", root, AT, "q_")
    assert rows(found.drop("id")) == everything
    assert sorted(r.id for r in found.select("id").collect()) == list(range(1, total + 1))
    one = found.where(F.col("source_file") == vocab.SOURCE_FILES["products"])
    assert plan(one).count("FileScan") == 1
    old = drop_superseded(spark, "q_bronze.bad_records_orders", root, "q_bronze.bad_records")
    assert len(old) == 3
    assert spark.table("q_bronze.bad_records").count() == total


# --- separators and presence ----------------------------------------------------------------

HEADER = ["product_id", "product_name", "category", "unit_price", "supplier_code"]


@pytest.mark.parametrize("sep", [",", ";", "\t", "|"])
def test_separator_from_the_header(spark, tmp_path, sep):
    path = tmp_path / "p.csv"
    path.write_text(sep.join(HEADER) + "\n" + sep.join(["1.0", "A,b", "c", "5", "S"]).replace("A,b", '"A,b"') + "\n")
    found = land(spark, "products", str(path), AT, "b", sep=None)
    assert rows(found.select(*HEADER)) == [("1.0", "A,b", "c", "5", "S")]


def test_ambiguous_headers_are_refused(spark, tmp_path):
    path = tmp_path / "p.csv"
    path.write_text("a,x;a\n1,2;3\n")
    with pytest.raises(ValueError, match="several separators"):
        separator_of(spark, str(path), [])
    with pytest.raises(ValueError, match="none of the separators"):
        land(spark, "products", str(path), AT, "b", sep=None)


def test_presence_before_any_read(spark, tmp_path):
    (tmp_path / vocab.SOURCE_FILES["orders"]).write_text("order_id\n")
    (tmp_path / vocab.SOURCE_FILES["products"]).mkdir()
    (tmp_path / vocab.SOURCE_FILES["products"] / "_SUCCESS").write_text("")
    found = presence(spark, str(tmp_path))
    assert {r.source: (r.present, r.files) for r in found.collect()} == {
        "customers": (False, 0),
        "orders": (True, 1),
        "transactions": (False, 0),
        "products": (False, 0),
    }
    with pytest.raises(FileNotFoundError) as error:
        require_present(found, str(tmp_path))
    for source in ("customers", "transactions", "products"):
        assert vocab.SOURCE_FILES[source] in str(error.value)


def test_a_run_over_another_separator(spark, sf_small, tmp_path):
    for source, name in vocab.SOURCE_FILES.items():
        text = legacy_views.VIEWS[source](spark, sf_small).drop(*vocab.LINEAGE_COLUMNS)
        text.write.options(**csv_options(sep=";")).csv(str(tmp_path / "in" / name))
    expected = {"customers": 153, "orders": 1503, "transactions": 6000, "products": 204}
    run = migration.run_migration(
        spark, str(tmp_path / "in"), str(tmp_path / "out"), expected, prefix="semi_", sep=None, buckets=4
    )
    assert {r.table: (r.rows, r.status) for r in run.summary.collect()} == {
        f"bronze_{s}": (n, "OK") for s, n in expected.items()
    }
    assert {s: df.count() for s, df in run.gold.items()} == {
        "customers": 141, "orders": 1144, "transactions": 4187, "products": 189
    }
    counts = {(r.layer, r.dataset): r.rows for r in run.table_counts.collect()}
    assert counts["gold", "orders"] == 1144 and counts["silver", "transactions"] == run.silver["transactions"].count()
    assert sum(n for (layer, _), n in counts.items() if layer == "bad_records") == run.bad_records.count()
