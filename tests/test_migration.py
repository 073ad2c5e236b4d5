"""The full run from CSV files to checked tables."""

import glob
import os
import shutil

import pytest

from conftest import rows
from millrace import vocab
from millrace.operators import checks
from millrace.plans.migration import run_migration
from millrace.sources import legacy_views
from millrace.sources.landing import csv_options


@pytest.fixture(scope="module")
def landing(spark, sf_small, tmp_path_factory):
    """The four exports as single CSV files under their landing names."""
    folder = tmp_path_factory.mktemp("landing")
    for source, name in vocab.SOURCE_FILES.items():
        text = legacy_views.VIEWS[source](spark, sf_small).drop(*vocab.LINEAGE_COLUMNS)
        text.coalesce(1).write.options(**csv_options()).csv(str(folder / f"_{source}"))
        (part,) = glob.glob(str(folder / f"_{source}" / "part-*.csv"))
        shutil.copy(part, os.path.join(folder, name))
    return str(folder)


@pytest.fixture(scope="module")
def run(spark, landing, tmp_path_factory):
    expected = {"customers": 153, "orders": 1503, "transactions": 6000, "products": 204}
    root = str(tmp_path_factory.mktemp("tables"))
    return run_migration(spark, landing, root, expected, prefix="m_")


def test_layers(run):
    assert {s: df.count() for s, df in run.gold.items()} == {
        "customers": 141,
        "orders": 1144,
        "transactions": 4187,
        "products": 189,
    }
    assert {r.table: r.rows for r in run.summary.collect()} == {
        "bronze_customers": 153,
        "bronze_orders": 1503,
        "bronze_transactions": 6000,
        "bronze_products": 204,
    }
    assert {r.batch_id for r in run.summary.collect()} == {run.batch_id}


def test_bad_records(run):
    assert run.bad_records.columns == [
        "id",
        "source_file",
        "rejection_reason",
        "rejected_at",
        "raw_record",
    ]
    ids = sorted(r.id for r in run.bad_records.select("id").collect())
    assert ids == list(range(1, len(ids) + 1))
    assert {r.source_file for r in run.bad_records.select("source_file").distinct().collect()} == set(
        vocab.SOURCE_FILES.values()
    )
    # Empty category texts come back from CSV as NULL and are quarantined too.
    assert len(ids) > 4350


def test_validation_reports_what_fails(run):
    failed = {r["item"]: r["value"] for r in run.validation.where("NOT passed").collect()}
    assert set(failed) == {
        "dim_customers.last_name",
        "fact_orders.order_id",
        "fact_transactions.transaction_id",
    }
    summary = {r.check_name: r.passed for r in checks.summarize(run.validation).collect()}
    assert summary == {
        vocab.ROW_COUNT_CHECK: True,
        vocab.DUPLICATE_CHECK: False,
        vocab.NULL_CHECK: False,
        vocab.REFERENCE_CHECK: True,
        "overall": False,
    }


def test_summary_has_status_and_duration(run):
    found = run.summary.collect()
    assert {r.status for r in found} == {"OK"}
    assert all(r.seconds > 0 and r.started_at and r.uneven_lines == 0 for r in found)
    assert run.uneven.count() == 0


def test_dropped_rows_are_stored(spark, run):
    stored = spark.table("m_gold.row_counts")
    assert {r.dataset: r.dropped for r in stored.collect()} == {
        "customers": 12,
        "orders": 359,
        "transactions": 1813,
        "products": 15,
    }


CLEAN = {
    "customers": ("customer_id,full_name,email,phone_number,signup_date,status", "1.0,Ann Lee,a@x.com,1,2023-01-02,Active"),
    "orders": ("order_id,customer_id,order_date,total_amount,status,channel", "5.0,1.0,2023-01-02,R 5,Done,Web"),
    "transactions": (
        "transaction_id,order_id,payment_method,transaction_amount,transaction_date,success_flag",
        "9.0,5,Cash,5,2023-01-02,Y",
    ),
    "products": ("product_id,product_name,category,unit_price,supplier_code", "1.0,A,Home,5,SUP1"),
}


def clean_run(spark, folder, prefix, **changed):
    for source, name in vocab.SOURCE_FILES.items():
        (folder / name).write_text("\n".join(changed.get(source, CLEAN[source])) + "\n")
    return run_migration(spark, str(folder), str(folder / "out"), {s: 1 for s in CLEAN}, prefix=prefix)


def test_clean_input(spark, tmp_path):
    run = clean_run(spark, tmp_path, "c_")
    assert run.bad_records.count() == 0
    assert all(df.count() == 1 for df in run.gold.values())
    assert run.validation.where("NOT passed").count() == 0


def test_reordered_export(spark, tmp_path):
    reordered = ("full_name,status,customer_id,email,signup_date,phone_number", "Ann Lee,Active,1.0,a@x.com,2023-01-02,1")
    run = clean_run(spark, tmp_path, "r_", customers=reordered)
    assert {s: df.count() for s, df in run.gold.items()} == dict.fromkeys(CLEAN, 1)
    assert run.gold["customers"].first().customer_id == 1
    assert run.bad_records.count() == 0


def test_surplus_fields_are_counted(spark, tmp_path):
    surplus = (CLEAN["products"][0], "1.0,Big, Lamp,Home,5,SUP1")
    run = clean_run(spark, tmp_path, "u_", products=surplus)
    assert [r.raw_line for r in run.uneven.collect()] == [surplus[1]]
    assert {r.table: r.uneven_lines for r in run.summary.collect()}["bronze_products"] == 1


def test_profile(run):
    assert run.profile.count() == 23


def test_tables_answer_sql(spark, run):
    joined = spark.sql(
        """SELECT count(*) AS n FROM m_gold.fact_transactions t
        WHERE NOT EXISTS (SELECT 1 FROM m_gold.fact_orders o WHERE o.order_id = t.order_id)"""
    )
    assert rows(joined) == [(0,)]


def test_second_run_replaces_the_first(spark, landing, run, tmp_path):
    again = run_migration(spark, landing, str(tmp_path), prefix="m_", batch_id="second")
    assert spark.table("m_bronze.bronze_orders").select("batch_id").distinct().first().batch_id == "second"
    assert spark.table("m_gold.fact_orders").count() == again.gold["orders"].count() == 1144
    missing = {r["item"] for r in again.validation.where("NOT passed AND item LIKE 'bronze%'").collect()}
    assert missing == {f"bronze_{s}" for s in vocab.SOURCE_FILES}


def test_missing_export_stops_the_run(spark, tmp_path):
    with pytest.raises(FileNotFoundError, match="Missing source file"):
        run_migration(spark, str(tmp_path), str(tmp_path / "out"), prefix="n_")
