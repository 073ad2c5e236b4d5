import pytest

from conftest import rows
from millrace import vocab
from millrace.sources import landing
from millrace.sources.tables import column_inventory, drop_superseded, publish

AT, BATCH = "2024-01-01T00:00:00+00:00", "b-1"


@pytest.fixture
def write(tmp_path):
    def put(text, name="products_legacy_large.csv"):
        path = tmp_path / name
        path.write_bytes(text.encode())
        return str(path)

    return put


HEADER = "product_id,product_name,category,unit_price,supplier_code\n"


def read(spark, path, **options):
    return landing.read_text_csv(spark, path, vocab.SOURCE_COLUMNS["products"], **options)


def test_text_is_kept_as_it_is(spark, write):
    path = write(HEADER + '1.0, Padded ,"a,b",007,NULL\n,x,"say ""hi""",1e3,\n')
    assert rows(read(spark, path)) == sorted(
        [("1.0", " Padded ", "a,b", "007", "NULL"), (None, "x", 'say "hi"', "1e3", None)], key=repr
    )


def test_short_rows_empty_fields_and_blank_lines(spark, write):
    path = write(HEADER + '1.0,A\n\n2.0,"",c,,\n')
    assert rows(read(spark, path)) == [("1.0", "A", None, None, None), ("2.0", None, "c", None, None)]


def test_extra_fields_stay_visible(spark, write):
    path = write(HEADER + "1.0,A,c,5,SUP1,surplus\n2.0,B,c,5,SUP1\n")
    df = read(spark, path, keep_corrupt=True)
    got = {r.product_id: r[landing.CORRUPT] for r in df.collect()}
    assert got == {"1.0": "1.0,A,c,5,SUP1,surplus", "2.0": None}


def test_quoted_line_break_needs_multi_line(spark, write):
    path = write(HEADER + '1.0,"two\nlines",c,5,SUP1\n')
    assert rows(read(spark, path, multi_line=True)) == [("1.0", "two\nlines", "c", "5", "SUP1")]


def test_header_names_columns(spark, write):
    df = landing.read_text_csv(spark, write("a,b\n1,x\n"))
    assert df.dtypes == [("a", "string"), ("b", "string")]
    assert rows(df) == [("1", "x")]


def test_columns_are_found_by_name(spark, write):
    path = write("supplier_code,product_name,product_id,unit_price,category\nS,A,1.0,5,c\n")
    assert rows(read(spark, path)) == [("1.0", "A", "c", "5", "S")]


def test_more_columns_follow_the_registered_ones(spark, write):
    path = write("colour,product_id,product_name,category,unit_price,supplier_code\nred,1.0,A,c,5,S\n")
    df = read(spark, path)
    assert df.columns == [*vocab.SOURCE_COLUMNS["products"], "colour"]
    assert rows(df) == [("1.0", "A", "c", "5", "S", "red")]


def test_a_missing_column_or_another_separator_is_refused(spark, write):
    with pytest.raises(ValueError, match="supplier_code"):
        read(spark, write("product_id,product_name,category,unit_price\n1.0,A,c,5\n"))
    path = write(HEADER.replace(",", ";") + "1.0;A;c;5;S\n")
    with pytest.raises(ValueError, match="separator ','"):
        read(spark, path)
    assert rows(read(spark, path, sep=";")) == [("1.0", "A", "c", "5", "S")]


def test_files_of_one_source_share_a_header(spark, tmp_path):
    (tmp_path / "a.csv").write_text(HEADER + "1.0,A,c,5,S\n")
    (tmp_path / "b.csv").write_text("product_name,product_id,category,unit_price,supplier_code\nB,2.0,c,5,S\n")
    with pytest.raises(Exception, match="header"):
        read(spark, str(tmp_path)).collect()


def test_uneven_lines(spark, write):
    path = write(HEADER + "1.0,A,c,5,S,surplus\n2.0,B,c,5,S\n3.0,C\n")
    found = landing.uneven_lines(spark, "products", path)
    name = vocab.SOURCE_FILES["products"]
    assert rows(found) == [(name, 2, "3.0,C"), (name, 5, "1.0,A,c,5,S,surplus")]


def test_missing_source_is_named(spark, tmp_path):
    with pytest.raises(FileNotFoundError, match="nowhere.csv"):
        landing.land(spark, "products", str(tmp_path / "nowhere.csv"), AT, BATCH)


def test_lineage(spark, write):
    path = write(HEADER + "1.0,A,c,5,SUP1\n", "part-07.csv")
    named = landing.land(spark, "products", path, AT, BATCH, "products_legacy_large.csv").first()
    assert tuple(named)[-3:] == (AT, "products_legacy_large.csv", BATCH)
    assert landing.land(spark, "products", path, AT, BATCH).first().source_file == "part-07.csv"


def test_batches_differ():
    first, second = landing.new_batch(), landing.new_batch()
    assert first[0] != second[0]
    assert first[1].endswith("+00:00")


def test_publish_replaces_the_whole_table(spark, tmp_path):
    root = str(tmp_path)
    table = "t_layer.things"
    assert rows(publish(spark.range(3), table, root)) == [(0,), (1,), (2,)]
    assert rows(publish(spark.range(5, 7), table, root)) == [(5,), (6,)]
    assert rows(spark.table(table)) == [(5,), (6,)]


def test_publish_from_itself(spark, tmp_path):
    table = "t_layer.self"
    publish(spark.range(4), table, str(tmp_path))
    publish(spark.table(table).where("id > 1"), table, str(tmp_path))
    assert rows(spark.table(table)) == [(2,), (3,)]


def test_failed_write_keeps_the_old_table(spark, tmp_path):
    table = "t_layer.kept"
    publish(spark.range(2), table, str(tmp_path))
    broken = spark.range(2).selectExpr("raise_error('no') AS id")
    with pytest.raises(Exception, match="no"):
        publish(broken.selectExpr("CAST(id AS BIGINT) AS id"), table, str(tmp_path))
    assert rows(spark.table(table)) == [(0,), (1,)]


def test_publish_takes_a_new_schema_and_partitions(spark, tmp_path):
    table = "t_layer.shape"
    publish(spark.range(2), table, str(tmp_path))
    wide = spark.range(4).selectExpr("id", "id % 2 AS part")
    assert publish(wide, table, str(tmp_path), ["part"]).where("part = 1").count() == 2
    assert publish(wide.where("id = 0"), table, str(tmp_path), ["part"]).count() == 1


def test_publish_without_rows(spark, tmp_path):
    none = spark.range(0).selectExpr("id", "id % 2 AS part")
    for table, parts in (("t_layer.none", []), ("t_layer.none_parted", ["part"])):
        for _ in range(2):
            assert publish(none, table, str(tmp_path), parts).columns == ["id", "part"]
        assert spark.table(table).count() == 0


def test_superseded_folders_are_dropped(spark, tmp_path):
    table = "t_layer.often"
    for n in (1, 2, 3):
        publish(spark.range(n), table, str(tmp_path))
    assert len(drop_superseded(spark, table, str(tmp_path))) == 2
    assert drop_superseded(spark, table, str(tmp_path)) == []
    assert spark.table(table).count() == 3


def test_column_inventory(spark):
    df = column_inventory(spark, {"t": spark.range(1).selectExpr("id", "'x' AS b")})
    assert rows(df) == [("t", 0, "id", "bigint"), ("t", 1, "b", "string")]
