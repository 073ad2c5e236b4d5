"""Legacy-shaped text sources derived from the star-schema test tables.

Each view is one scan and one projection, so it grows with its table. Values are made
dirty by key so that SQL can state the same text: mixed date formats, currency strings,
inconsistent spellings, null and non-numeric keys, orphans and repeated rows.
"""

from pyspark.sql import DataFrame, SparkSession

from millrace import vocab
from millrace.sources.landing import with_lineage

INGESTED_AT = "2024-01-01T00:00:00+00:00"
BATCH_ID = "00000000-0000-4000-8000-000000000001"


def _again(condition: str) -> str:
    """A column `copy`: rows where the condition holds appear twice, the second time true."""
    return f"explode(IF({condition}, array(false, true), array(false))) AS copy"


def _bronze(df: DataFrame, source: str, **columns: str) -> DataFrame:
    text = df.selectExpr(*[f"{columns[c]} AS {c}" for c in vocab.SOURCE_COLUMNS[source]])
    return with_lineage(text, INGESTED_AT, BATCH_ID, vocab.SOURCE_FILES[source])


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/customer.parquet").selectExpr(
        "*",
        "c_custkey AS k",
        "date_add(DATE '1990-01-01', CAST(c_custkey % 5000 AS INT)) AS d",
        _again("c_custkey % 50 = 0"),
    )
    return _bronze(
        rows,
        "customers",
        customer_id="""CASE WHEN copy THEN CAST(k AS STRING) WHEN k % 21 = 3 THEN NULL
            WHEN k % 97 = 5 THEN 'abc' ELSE k || '.0' END""",
        full_name="IF(k % 13 = 0, c_mktsegment, c_name || ' ' || c_mktsegment)",
        email="""CASE k % 10 WHEN 1 THEN NULL WHEN 2 THEN '  ' || upper(c_name) || '@X.COM '
            ELSE c_name || '@x.com' END""",
        phone_number="' +27-' || c_nationkey || '-' || k",
        signup_date="""CASE k % 7 WHEN 0 THEN date_format(d, 'yyyy-MM-dd')
            WHEN 1 THEN date_format(d, 'dd/MM/yyyy') WHEN 2 THEN date_format(d, 'MM-dd-yyyy')
            WHEN 3 THEN date_format(d, 'yyyy/MM/dd') WHEN 4 THEN 'invalid_date'
            WHEN 6 THEN '2023-13-01' END""",
        status="""CASE k % 7 WHEN 0 THEN 'Act' WHEN 1 THEN 'active' WHEN 2 THEN ' Active '
            WHEN 3 THEN 'inactive' WHEN 4 THEN 'ACTIVE' WHEN 6 THEN 'dormant' END""",
    )


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/orders.parquet").selectExpr(
        "*",
        "o_orderkey AS k",
        "o_orderdate AS d",
        "CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS STRING) AS m",
        _again("o_orderkey % 500 = 1"),
    )
    return _bronze(
        rows,
        "orders",
        order_id="IF(k % 20 = 7, NULL, k || '.0')",
        customer_id="""CASE WHEN k % 11 = 4 THEN NULL WHEN k % 17 = 0 THEN '99999999.0'
            ELSE o_custkey || '.0' END""",
        order_date="""CASE k % 7 WHEN 0 THEN date_format(d, 'yyyy-MM-dd')
            WHEN 1 THEN date_format(d, 'yyyy/MM/dd') WHEN 2 THEN date_format(d, 'dd/MM/yyyy')
            WHEN 3 THEN 'invalid_date' WHEN 5 THEN date_format(d, 'MM/dd/yyyy')
            WHEN 6 THEN '2023-02-30' END""",
        total_amount="""CASE k % 5 WHEN 0 THEN 'R ' || m WHEN 1 THEN 'R' || replace(m, '.', ',')
            WHEN 2 THEN m WHEN 3 THEN 'R -200' END""",
        status="""CASE k % 8 WHEN 0 THEN 'CANCELLED' WHEN 1 THEN 'Done' WHEN 2 THEN 'Completed'
            WHEN 3 THEN ' completed ' WHEN 4 THEN 'P' WHEN 6 THEN 'canceled' WHEN 7 THEN 'lost'
            END""",
        channel="CASE k % 4 WHEN 0 THEN 'App' WHEN 1 THEN 'store ' WHEN 2 THEN 'WEB' END",
    )


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/lineitem.parquet").selectExpr(
        "*", "l_orderkey * 10 + l_linenumber AS k", "l_shipdate AS d"
    )
    return _bronze(
        rows,
        "transactions",
        transaction_id="IF(k % 21 = 0, NULL, k || '.0')",
        order_id="IF(k % 40 = 1, '99999999', CAST(l_orderkey AS STRING))",
        payment_method="""CASE k % 8 WHEN 0 THEN 'Card' WHEN 1 THEN 'card' WHEN 2 THEN 'Cash'
            WHEN 3 THEN 'CASH' WHEN 4 THEN 'Crypto' WHEN 6 THEN 'eft' WHEN 7 THEN 'debit card'
            END""",
        transaction_amount="CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS STRING)",
        transaction_date="""CASE k % 4 WHEN 0 THEN date_format(d, 'yyyy-MM-dd')
            WHEN 1 THEN date_format(d, 'dd/MM/yyyy') WHEN 3 THEN '2023-13-01' END""",
        success_flag="""CASE k % 6 WHEN 0 THEN 'Y' WHEN 1 THEN 'N' WHEN 2 THEN 'maybe'
            WHEN 4 THEN '1' WHEN 5 THEN 'false' END""",
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/part.parquet").selectExpr(
        "*",
        "p_partkey AS k",
        "CAST(CAST(p_retailprice AS DECIMAL(18,2)) AS STRING) AS m",
        _again("p_partkey % 50 = 0"),
    )
    return _bronze(
        rows,
        "products",
        product_id="""CASE WHEN copy THEN CAST(k AS STRING) WHEN k % 21 = 0 THEN NULL
            WHEN k % 101 = 7 THEN 'x' || k ELSE k || '.0' END""",
        product_name="' ' || p_name || ' '",
        category="""CASE k % 6 WHEN 0 THEN 'electronics' WHEN 1 THEN 'Electronics' WHEN 2 THEN 'HOME'
            WHEN 3 THEN 'home and living' WHEN 5 THEN '' END""",
        unit_price="CASE k % 4 WHEN 0 THEN 'invalid' WHEN 1 THEN NULL ELSE m END",
        supplier_code="CASE k % 4 WHEN 0 THEN 'SUP1' WHEN 1 THEN ' SUP2' WHEN 2 THEN '  ' END",
    )


# One function per source.
VIEWS = {
    "customers": customers,
    "orders": orders,
    "transactions": transactions,
    "products": products,
}


def all_views(spark: SparkSession, sf_dir: str) -> dict:
    return {source: view(spark, sf_dir) for source, view in VIEWS.items()}
