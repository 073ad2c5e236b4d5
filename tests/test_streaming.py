from conftest import rows
from millrace.streaming.landing import land_new_files

HEADER = "product_id,product_name,category,unit_price,supplier_code\n"


def land(spark, tmp_path, batch_id):
    query = land_new_files(
        spark, "products", str(tmp_path / "in"), str(tmp_path / "out"), "2024-01-01", batch_id
    )
    assert query.awaitTermination(120)


def test_only_new_files_are_landed(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "day1.csv").write_text(HEADER + "1.0,A,Home,5,SUP1\n,B,,invalid,\n")
    land(spark, tmp_path, "one")
    (tmp_path / "in" / "day2.csv").write_text(HEADER + "2.0,C,Home,x,SUP1\n")
    land(spark, tmp_path, "two")
    land(spark, tmp_path, "three")

    bronze = spark.read.parquet(str(tmp_path / "out" / "bronze_products"))
    assert rows(bronze.select("product_name", "source_file", "batch_id")) == [
        ("A", "day1.csv", "one"),
        ("B", "day1.csv", "one"),
        ("C", "day2.csv", "two"),
    ]
    bad = spark.read.parquet(str(tmp_path / "out" / "bad_records_products"))
    assert rows(bad.groupBy("rule").count()) == [(12, 1), (13, 2), (14, 1)]
