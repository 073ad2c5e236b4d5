"""DuckDB statements that state each registered query independently.

The checker only knows the raw test tables, so every statement starts from the legacy
views, written here a second time in SQL. Values that are fixed by the data are those of
`oracle_values`; everything computed is written out in SQL.
"""

import oracle_values as vocab
from oracle_values import BATCH_ID, GOLD_COLUMNS, INGESTED_AT

SOURCES = tuple(vocab.SOURCE_FILES)

# --- the dirty views --------------------------------------------------------------------
# All rows of each table are read; the branches with a condition add repeated rows to them.


def _lineage(source: str) -> str:
    return (
        f"'{INGESTED_AT}' AS ingested_at, '{vocab.SOURCE_FILES[source]}' AS source_file, "
        f"'{BATCH_ID}' AS batch_id"
    )


_CUSTOMERS = f"""
customers_base AS (
  SELECT c_custkey AS k, *, DATE '1990-01-01' + CAST(c_custkey % 5000 AS INT) AS d FROM customer
),
customers_twice AS (
  SELECT false AS again, * FROM customers_base
  UNION ALL SELECT true, * FROM customers_base WHERE k % 50 = 0
),
bronze_customers AS (
  SELECT
    CASE WHEN again THEN CAST(k AS STRING) WHEN k % 21 = 3 THEN NULL
         WHEN k % 97 = 5 THEN 'abc' ELSE k || '.0' END AS customer_id,
    CASE WHEN k % 13 = 0 THEN c_mktsegment ELSE c_name || ' ' || c_mktsegment END AS full_name,
    CASE WHEN k % 10 = 1 THEN NULL WHEN k % 10 = 2 THEN '  ' || upper(c_name) || '@X.COM '
         ELSE c_name || '@x.com' END AS email,
    ' +27-' || c_nationkey || '-' || k AS phone_number,
    CASE k % 7 WHEN 0 THEN strftime(d, '%Y-%m-%d') WHEN 1 THEN strftime(d, '%d/%m/%Y')
         WHEN 2 THEN strftime(d, '%m-%d-%Y') WHEN 3 THEN strftime(d, '%Y/%m/%d')
         WHEN 4 THEN 'invalid_date' WHEN 6 THEN '2023-13-01' END AS signup_date,
    CASE k % 7 WHEN 0 THEN 'Act' WHEN 1 THEN 'active' WHEN 2 THEN ' Active ' WHEN 3 THEN 'inactive'
         WHEN 4 THEN 'ACTIVE' WHEN 6 THEN 'dormant' END AS status,
    {_lineage("customers")}
  FROM customers_twice
)"""

_ORDERS = f"""
orders_base AS (
  SELECT o_orderkey AS k, o_orderdate AS d, CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS STRING) AS m, *
  FROM orders
),
orders_twice AS (
  SELECT * FROM orders_base UNION ALL SELECT * FROM orders_base WHERE k % 500 = 1
),
bronze_orders AS (
  SELECT
    CASE WHEN k % 20 <> 7 THEN k || '.0' END AS order_id,
    CASE WHEN k % 11 = 4 THEN NULL WHEN k % 17 = 0 THEN '99999999.0' ELSE o_custkey || '.0' END
      AS customer_id,
    CASE k % 7 WHEN 0 THEN strftime(d, '%Y-%m-%d') WHEN 1 THEN strftime(d, '%Y/%m/%d')
         WHEN 2 THEN strftime(d, '%d/%m/%Y') WHEN 3 THEN 'invalid_date'
         WHEN 5 THEN strftime(d, '%m/%d/%Y') WHEN 6 THEN '2023-02-30' END AS order_date,
    CASE k % 5 WHEN 0 THEN 'R ' || m WHEN 1 THEN 'R' || replace(m, '.', ',') WHEN 2 THEN m
         WHEN 3 THEN 'R -200' END AS total_amount,
    CASE k % 8 WHEN 0 THEN 'CANCELLED' WHEN 1 THEN 'Done' WHEN 2 THEN 'Completed'
         WHEN 3 THEN ' completed ' WHEN 4 THEN 'P' WHEN 6 THEN 'canceled' WHEN 7 THEN 'lost' END
      AS status,
    CASE k % 4 WHEN 0 THEN 'App' WHEN 1 THEN 'store ' WHEN 2 THEN 'WEB' END AS channel,
    {_lineage("orders")}
  FROM orders_twice
)"""

_TRANSACTIONS = f"""
transactions_base AS (
  SELECT l_orderkey * 10 + l_linenumber AS k, l_shipdate AS d, * FROM lineitem
),
bronze_transactions AS (
  SELECT
    CASE WHEN k % 21 <> 0 THEN k || '.0' END AS transaction_id,
    CASE WHEN k % 40 = 1 THEN '99999999' ELSE CAST(l_orderkey AS STRING) END AS order_id,
    CASE k % 8 WHEN 0 THEN 'Card' WHEN 1 THEN 'card' WHEN 2 THEN 'Cash' WHEN 3 THEN 'CASH'
         WHEN 4 THEN 'Crypto' WHEN 6 THEN 'eft' WHEN 7 THEN 'debit card' END AS payment_method,
    CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS STRING) AS transaction_amount,
    CASE k % 4 WHEN 0 THEN strftime(d, '%Y-%m-%d') WHEN 1 THEN strftime(d, '%d/%m/%Y')
         WHEN 3 THEN '2023-13-01' END AS transaction_date,
    CASE k % 6 WHEN 0 THEN 'Y' WHEN 1 THEN 'N' WHEN 2 THEN 'maybe' WHEN 4 THEN '1'
         WHEN 5 THEN 'false' END AS success_flag,
    {_lineage("transactions")}
  FROM transactions_base
)"""

_PRODUCTS = f"""
products_base AS (
  SELECT p_partkey AS k, CAST(CAST(p_retailprice AS DECIMAL(18,2)) AS STRING) AS m, * FROM part
),
products_twice AS (
  SELECT false AS again, * FROM products_base
  UNION ALL SELECT true, * FROM products_base WHERE k % 50 = 0
),
bronze_products AS (
  SELECT
    CASE WHEN again THEN CAST(k AS STRING) WHEN k % 21 = 0 THEN NULL
         WHEN k % 101 = 7 THEN 'x' || k ELSE k || '.0' END AS product_id,
    ' ' || p_name || ' ' AS product_name,
    CASE k % 6 WHEN 0 THEN 'electronics' WHEN 1 THEN 'Electronics' WHEN 2 THEN 'HOME'
         WHEN 3 THEN 'home and living' WHEN 5 THEN '' END AS category,
    CASE k % 4 WHEN 0 THEN 'invalid' WHEN 1 THEN NULL ELSE m END AS unit_price,
    CASE k % 4 WHEN 0 THEN 'SUP1' WHEN 1 THEN ' SUP2' WHEN 2 THEN '  ' END AS supplier_code,
    {_lineage("products")}
  FROM products_twice
)"""

# --- value expressions ------------------------------------------------------------------


def _id(c):
    return f"TRY_CAST(TRY_CAST({c} AS DOUBLE) AS INT)"


def _date(c, formats):
    tried = ", ".join(f"TRY_STRPTIME({c}, '{f}')" for f in formats)
    return f"CAST(COALESCE({tried}) AS DATE)"


def _order_date(c):
    return _date(c, ("%Y-%m-%d", "%Y/%m/%d", "%d/%m/%Y", "%m/%d/%Y"))


def _lookup(c, mapping):
    entries = ", ".join(
        f"'{k}': " + (str(v).lower() if isinstance(v, bool) else f"'{v}'") for k, v in mapping.items()
    )
    return f"MAP {{{entries}}}[upper(trim({c}))]"


def _currency(c):
    return f"TRY_CAST(replace(regexp_replace(trim({c}), '^R\\s*', ''), ',', '.') AS DOUBLE)"


_FIRST = "trim(split_part(full_name, ' ', 1))"
_LAST = "CASE WHEN contains(full_name, ' ') THEN trim(full_name[instr(full_name, ' ') + 1:]) END"
_SENTENCE = "upper(trim(category)[1]) || lower(trim(category)[2:])"

_TYPED_CUSTOMERS = f"""
typed_customers AS (
  SELECT {_id("customer_id")} AS customer_id, {_FIRST} AS first_name, {_LAST} AS last_name,
    lower(trim(email)) AS email, trim(phone_number) AS phone_number,
    {_date("signup_date", vocab.CUSTOMER_DATE_FORMATS)} AS signup_date,
    {_lookup("status", vocab.CUSTOMER_STATUS)} AS status, customer_id AS raw_key
  FROM bronze_customers WHERE customer_id IS NOT NULL
)"""

_TYPED_ORDERS = f"""
typed_orders AS (
  SELECT {_id("order_id")} AS order_id, {_id("customer_id")} AS customer_id,
    {_order_date("order_date")} AS order_date, {_currency("total_amount")} AS total_amount,
    {_lookup("status", vocab.ORDER_STATUS)} AS status, lower(trim(channel)) AS channel
  FROM bronze_orders WHERE order_id IS NOT NULL
)"""

_TYPED_TRANSACTIONS = f"""
typed_transactions AS (
  SELECT {_id("transaction_id")} AS transaction_id, TRY_CAST(order_id AS INT) AS order_id,
    {_lookup("payment_method", vocab.PAYMENT_METHOD)} AS payment_method,
    TRY_CAST(transaction_amount AS DOUBLE) AS transaction_amount,
    {_date("transaction_date", vocab.TRANSACTION_DATE_FORMATS)} AS transaction_date,
    {_lookup("success_flag", vocab.SUCCESS_FLAG)} AS success_flag
  FROM bronze_transactions WHERE transaction_id IS NOT NULL
)"""

_TYPED_PRODUCTS = f"""
typed_products AS (
  SELECT {_id("product_id")} AS product_id, trim(product_name) AS product_name,
    {_SENTENCE} AS category, TRY_CAST(unit_price AS DOUBLE) AS unit_price,
    NULLIF(trim(supplier_code), '') AS supplier_code, product_id AS raw_key
  FROM bronze_products WHERE product_id IS NOT NULL
)"""

_SILVER_CUSTOMERS = """
dedup_customers AS (
  SELECT DISTINCT ON (customer_id) * FROM typed_customers WHERE customer_id IS NOT NULL
  ORDER BY customer_id, raw_key
),
silver_customers AS (SELECT * EXCLUDE (raw_key) FROM dedup_customers)"""

_SILVER_PRODUCTS = """
dedup_products AS (
  SELECT DISTINCT ON (product_id) * FROM typed_products ORDER BY product_id, raw_key
),
silver_products AS (SELECT * EXCLUDE (raw_key) FROM dedup_products)"""

_SILVER_ORDERS = """
silver_orders AS (
  SELECT * FROM typed_orders o
  WHERE EXISTS (SELECT 1 FROM silver_customers c WHERE c.customer_id = o.customer_id)
)"""

_SILVER_TRANSACTIONS = """
silver_transactions AS (
  SELECT t.* FROM typed_transactions t JOIN silver_orders o ON o.order_id = t.order_id
)"""


def _gold(name, silver):
    columns = GOLD_COLUMNS[name]
    return f"\n{name} AS (SELECT {', '.join(columns)} FROM {silver} WHERE {columns[0]} IS NOT NULL)"


_BRONZE = {
    "customers": _CUSTOMERS,
    "orders": _ORDERS,
    "transactions": _TRANSACTIONS,
    "products": _PRODUCTS,
}
_ALL_BRONZE = [_BRONZE[s] for s in SOURCES]
_TO_CUSTOMERS = [_CUSTOMERS, _TYPED_CUSTOMERS, _SILVER_CUSTOMERS]
_TO_ORDERS = [*_TO_CUSTOMERS, _ORDERS, _TYPED_ORDERS, _SILVER_ORDERS]
_TO_TRANSACTIONS = [*_TO_ORDERS, _TRANSACTIONS, _TYPED_TRANSACTIONS, _SILVER_TRANSACTIONS]
_TO_PRODUCTS = [_PRODUCTS, _TYPED_PRODUCTS, _SILVER_PRODUCTS]
_DIM_CUSTOMERS = _gold("dim_customers", "silver_customers")
_DIM_PRODUCTS = _gold("dim_products", "silver_products")
_FACT_ORDERS = _gold("fact_orders", "silver_orders")
_FACT_TRANSACTIONS = _gold("fact_transactions", "silver_transactions")
_ALL = [
    *_TO_TRANSACTIONS,
    *_TO_PRODUCTS,
    _DIM_CUSTOMERS,
    _DIM_PRODUCTS,
    _FACT_ORDERS,
    _FACT_TRANSACTIONS,
]


def _with(parts, body):
    return "WITH " + ",".join(parts) + "\n" + body


# --- quarantine -------------------------------------------------------------------------


def _outside(c, mapping):
    listed = ", ".join(f"'{v}'" for v in mapping)
    return f"upper(trim({c})) NOT IN ({listed})"


def _shapeless(c):
    return " AND ".join(f"NOT regexp_full_match({c}, '{s}')" for s in vocab.ORDER_DATE_SHAPES)


def _undated(c, formats):
    return f"{c} IS NOT NULL AND {_date(c, formats)} IS NULL"


_PREDICATES = {
    "customers": {
        1: "TRY_CAST(customer_id AS DOUBLE) IS NULL",
        2: _undated("signup_date", vocab.CUSTOMER_DATE_FORMATS),
        3: _outside("status", vocab.CUSTOMER_STATUS),
    },
    "orders": {
        4: "order_id IS NULL",
        5: "customer_id IS NULL",
        6: _shapeless("order_date"),
        7: _outside("status", vocab.ORDER_STATUS),
    },
    "transactions": {
        8: "transaction_id IS NULL",
        9: _undated("transaction_date", vocab.TRANSACTION_DATE_FORMATS),
        10: _outside("payment_method", vocab.PAYMENT_METHOD),
        11: _outside("success_flag", vocab.SUCCESS_FLAG),
    },
    "products": {
        12: "product_id IS NULL",
        13: "unit_price IS NOT NULL AND TRY_CAST(unit_price AS DOUBLE) IS NULL",
        14: "category IS NULL",
    },
}


def _violations(source):
    return "\nUNION ALL ".join(
        f"SELECT {n} AS rule, '{vocab.SOURCE_FILES[source]}' AS source_file, "
        f"'{vocab.REASONS[n]}' AS rejection_reason, '{INGESTED_AT}' AS rejected_at, "
        f"CAST(to_json(b) AS VARCHAR) AS raw_record FROM bronze_{source} b WHERE {p}"
        for n, p in _PREDICATES[source].items()
    )


_ALL_VIOLATIONS = "\nUNION ALL ".join(_violations(s) for s in SOURCES)


def _summary():
    rules = ", ".join(
        f"('{vocab.SOURCE_FILES[s]}', {n}, '{vocab.REASONS[n]}')" for s in SOURCES for n in _PREDICATES[s]
    )
    files = "\nUNION ALL ".join(
        f"SELECT '{vocab.SOURCE_FILES[s]}' AS source_file, count(*) AS records FROM bronze_{s} "
        "WHERE " + " OR ".join(f"({p})" for p in _PREDICATES[s].values())
        for s in SOURCES
    )
    return _with(
        [
            *_ALL_BRONZE,
            f"\nviolations AS ({_ALL_VIOLATIONS})",
            f"\nrules(source_file, rule, rejection_reason) AS (VALUES {rules})",
            "\ncounted AS (SELECT r.source_file, r.rejection_reason, count(v.rule) AS violations "
            "FROM rules r LEFT JOIN violations v ON v.rule = r.rule GROUP BY ALL)",
            f"\nfiles AS ({files})",
        ],
        """SELECT source_file, rejection_reason, violations, violations AS records FROM counted
UNION ALL SELECT c.source_file, NULL, CAST(sum(violations) AS BIGINT), any_value(records)
  FROM counted c JOIN files USING (source_file) GROUP BY c.source_file
UNION ALL SELECT NULL, NULL, (SELECT CAST(sum(violations) AS BIGINT) FROM counted),
  (SELECT CAST(sum(records) AS BIGINT) FROM files)""",
    )


# --- profile ----------------------------------------------------------------------------


def _profile(source, prefix=""):
    return "\nUNION ALL ".join(
        f"""SELECT {prefix}'{c}' AS "column", count(*) AS total, count(*) - count({c}) AS nulls,
  CASE WHEN count(*) = 0 THEN 0.0 ELSE round(100.0 * (count(*) - count({c})) / count(*), 1) END::DOUBLE
    AS null_pct, count(DISTINCT {c}) AS "distinct",
  array_to_string(list_sort(list(DISTINCT {c}) FILTER ({c} IS NOT NULL))[:5], ', ') AS samples
FROM bronze_{source}"""
        for c in vocab.SOURCE_COLUMNS[source]
    )


def _profile_all():
    parts = [
        _profile(s, f"""'bronze_{s}' AS "table", '{vocab.SOURCE_FILES[s]}' AS source_file, """)
        for s in SOURCES
    ]
    return _with(_ALL_BRONZE, "\nUNION ALL ".join(parts))


# --- checks -----------------------------------------------------------------------------


def _check(check, item, count):
    return (
        f"SELECT '{check}' AS check_name, '{item}' AS item, value, value = 0 AS passed "
        f"FROM (SELECT CAST(({count}) AS BIGINT) AS value)"
    )


def _nulls(table, c):
    return f"SELECT count(*) FROM {table} WHERE {c} IS NULL"


def _repeats(table, c, where=""):
    return f"SELECT count(*) FROM (SELECT 1 FROM {table} {where} GROUP BY {c} HAVING count(*) > 1)"


def _orphans(child, parent, c, extra=""):
    return (
        f"SELECT count(*) FROM {child} x WHERE NOT EXISTS "
        f"(SELECT 1 FROM {parent} y WHERE y.{c} = x.{c}) {extra}"
    )


_DUPLICATES = [
    _check(
        vocab.DUPLICATE_CHECK,
        f"{t}.{vocab.PRIMARY_KEYS[s]}",
        _repeats(t, vocab.PRIMARY_KEYS[s]),
    )
    for s, t in vocab.GOLD_TABLES.items()
]
_NULLS = [
    _check(vocab.NULL_CHECK, f"{t}.{c}", _nulls(t, c))
    for t, columns in vocab.MANDATORY_COLUMNS.items()
    for c in columns
]
_REFERENCES = [
    _check(
        vocab.REFERENCE_CHECK,
        "Orphaned orders (no matching customer)",
        _orphans("fact_orders", "dim_customers", "customer_id"),
    ),
    _check(
        vocab.REFERENCE_CHECK,
        "Orphaned transactions (no matching order)",
        _orphans("fact_transactions", "fact_orders", "order_id"),
    ),
]
# The tables the sources are derived from; sources with repeated rows do not reconcile.
_EXPECTED = {"customers": "customer", "orders": "orders", "transactions": "lineitem", "products": "part"}
_COUNTS = [
    _check(
        vocab.ROW_COUNT_CHECK,
        f"bronze_{s}",
        f"(SELECT count(*) FROM {raw}) - (SELECT count(*) FROM bronze_{s})",
    )
    for s, raw in _EXPECTED.items()
]


def _union(checks):
    return "\nUNION ALL ".join(checks)


def _declared(test, pick):
    return _with(_ALL, _union([c for t, tests in vocab.DECLARED_CHECKS.items() for c in pick(t, tests[test])]))


def _reconciliation():
    rows = "\nUNION ALL ".join(
        f"SELECT 'bronze_{s}' AS \"table\", (SELECT count(*) FROM {raw}) AS expected, "
        f"(SELECT count(*) FROM bronze_{s}) AS loaded"
        for s, raw in _EXPECTED.items()
    )
    return _with(
        [*_ALL_BRONZE, f"\nper AS ({rows})"],
        """SELECT "table", expected, loaded, CASE WHEN expected = loaded THEN 'OK' ELSE 'MISMATCH' END AS status
FROM per
UNION ALL SELECT 'overall', CAST(sum(expected) AS BIGINT), CAST(sum(loaded) AS BIGINT),
  CASE WHEN bool_and(expected = loaded) THEN 'OK' ELSE 'MISMATCH' END FROM per""",
    )


def _row_counts():
    rows = "\nUNION ALL ".join(
        f"SELECT '{s}' AS dataset, (SELECT count(*) FROM {_EXPECTED[s]}) AS source, "
        f"(SELECT count(*) FROM bronze_{s}) AS bronze, (SELECT count(*) FROM {t}) AS gold"
        for s, t in vocab.GOLD_TABLES.items()
    )
    return _with(_ALL, f"SELECT *, source - gold AS dropped, bronze = source AS passed FROM ({rows})")


# An empty text written to CSV comes back as NULL.
_LANDED = "\nbronze_products AS (SELECT * REPLACE (NULLIF(category, '') AS category) FROM written_products)"


def _published(select, ctes=()):
    written = _PRODUCTS.replace("bronze_products AS (", "written_products AS (") + "," + _LANDED
    return _with([written if c is _PRODUCTS else c for c in [*_ALL, *ctes]], select)


def _published_statements() -> dict:
    sql = {
        f"published_{t}": _published(f"SELECT {', '.join(vocab.GOLD_COLUMNS[t])} FROM {t}")
        for t in vocab.GOLD_TABLES.values()
    }
    sql["published_bad_records"] = _published(
        "SELECT source_file, rejection_reason, rejected_at, raw_record FROM violations",
        [f"\nviolations AS ({_ALL_VIOLATIONS})"],
    )
    profiles = [
        _profile(s, f"""'bronze_{s}' AS "table", '{vocab.SOURCE_FILES[s]}' AS source_file, """)
        for s in SOURCES
    ]
    sql["published_profile"] = _published(_union(profiles))
    sql["published_validation"] = _published(_union([*_COUNTS, *_DUPLICATES, *_NULLS, *_REFERENCES]))
    rows = "\nUNION ALL ".join(
        f"SELECT '{s}' AS dataset, (SELECT count(*) FROM {_EXPECTED[s]}) AS source, "
        f"(SELECT count(*) FROM bronze_{s}) AS bronze, (SELECT count(*) FROM {t}) AS gold"
        for s, t in vocab.GOLD_TABLES.items()
    )
    sql["published_row_counts"] = _published(
        f"SELECT *, source - gold AS dropped, bronze = source AS passed FROM ({rows})"
    )
    summary = "\nUNION ALL ".join(
        f"SELECT '{BATCH_ID}' AS batch_id, 'bronze_{s}' AS \"table\", "
        f"(SELECT count(*) FROM bronze_{s}) AS rows, CAST(0 AS BIGINT) AS uneven_lines, "
        f"CASE WHEN (SELECT count(*) FROM bronze_{s}) = (SELECT count(*) FROM {_EXPECTED[s]}) "
        "THEN 'OK' ELSE 'MISMATCH' END AS status"
        for s in SOURCES
    )
    sql["published_run_summary"] = _published(summary)
    counts = [f"SELECT 'bronze' AS layer, '{s}' AS dataset, count(*) AS rows FROM bronze_{s}" for s in SOURCES]
    counts += [f"SELECT 'silver', '{s}', count(*) FROM silver_{s}" for s in SOURCES]
    counts += [f"SELECT 'gold', '{s}', count(*) FROM {t}" for s, t in vocab.GOLD_TABLES.items()]
    counts += [f"SELECT 'bad_records', '{s}', count(*) FROM ({_violations(s)})" for s in SOURCES]
    sql["published_table_counts"] = _published(_union(counts))
    bronze = [
        f"('bronze_{s}', {i}, '{c}', 'string')"
        for s in SOURCES
        for i, c in enumerate([*vocab.SOURCE_COLUMNS[s], "ingested_at", "source_file", "batch_id"])
    ]
    gold = "\nUNION ALL ".join(
        f"SELECT 'gold_{s}' AS \"table\", CAST(row_number() OVER () - 1 AS INT) AS position, "
        f"column_name AS \"column\", CASE column_type WHEN 'VARCHAR' THEN 'string' WHEN 'INTEGER' THEN 'int' "
        f"ELSE lower(column_type) END AS type FROM (DESCRIBE SELECT * FROM {t})"
        for s, t in vocab.GOLD_TABLES.items()
    )
    sql["published_inventory"] = _published(
        f"""SELECT "table", position, "column", type FROM (VALUES {", ".join(bronze)}) AS b("table", position, "column", type)
UNION ALL {gold}"""
    )
    # Texts that are no ids count as none.
    ids = [
        ("customers", "customer_id", _id("customer_id")),
        ("orders", "order_id", _id("order_id")),
        ("orders", "customer_id", _id("customer_id")),
        ("transactions", "transaction_id", _id("transaction_id")),
        ("transactions", "order_id", "TRY_CAST(order_id AS INT)"),
        ("products", "product_id", _id("product_id")),
    ]
    sql["distinct_ids"] = sql["merged_distinct_ids"] = _with(
        _ALL_BRONZE,
        _union(
            f"SELECT '{s}' AS source, '{c}' AS \"column\", count(DISTINCT {value}) AS ids FROM bronze_{s}"
            for s, c, value in ids
        ),
    )
    profiles = _union(_profile(s, f"'{s}' AS source, ") for s in SOURCES)
    sql["merged_profiles"] = _with(
        _ALL_BRONZE, f'SELECT source, "column", total, nulls, null_pct, true AS near FROM ({profiles})'
    )
    sql["csv_semicolon_customers"] = _with([_CUSTOMERS], "SELECT * FROM bronze_customers")
    files = ", ".join(
        f"('{s}', '{name}', {str(s in ('customers', 'products')).lower()})" for s, name in vocab.SOURCE_FILES.items()
    )
    sql["source_presence"] = f"SELECT * FROM (VALUES {files}) AS f(source, source_file, present)"
    sql["inventory_changes"] = """SELECT * FROM (VALUES
  ('bronze_products', 'colour', 'added', NULL, 'string'), ('bronze_products', 'supplier_code', 'lost', 'string', NULL),
  ('bronze_products', 'product_id', 'moved', 'string', 'string'),
  ('bronze_products', 'product_name', 'moved', 'string', 'string'),
  ('bronze_products', 'unit_price', 'moved', 'string', 'string')
) AS c("table", "column", change, old_type, new_type)"""
    # Its columns in another order in the file; a surplus field in some lines.
    sql["csv_reordered_customers"] = _with([_CUSTOMERS], "SELECT * FROM bronze_customers")
    sql["csv_extra_fields"] = _with(
        [_PRODUCTS],
        f"""SELECT '{vocab.SOURCE_FILES["products"]}' AS source_file, count(*) AS lines
FROM bronze_products WHERE product_id LIKE '%5.0'""",
    )
    return sql


def statements() -> dict:
    sql = {}
    for s in SOURCES:
        sql[f"bronze_{s}"] = _with([_BRONZE[s]], f"SELECT * FROM bronze_{s}")
        sql[f"quarantine_{s}"] = _with([_BRONZE[s]], _violations(s))
        sql[f"profile_{s}"] = _with([_BRONZE[s]], _profile(s))
        # A written empty text comes back from CSV as NULL.
        texts = ", ".join(f"NULLIF({c}, '') AS {c}" for c in vocab.SOURCE_COLUMNS[s])
        sql[f"csv_bronze_{s}"] = _with(
            [_BRONZE[s]], f"SELECT {texts}, ingested_at, source_file, batch_id FROM bronze_{s}"
        )
    sql["csv_header_products"] = _with(
        [_PRODUCTS], "SELECT * REPLACE (NULLIF(category, '') AS category) FROM bronze_products"
    )
    sql["load_reconciliation"] = _reconciliation()
    sql["run_summary"] = _with(
        _ALL_BRONZE,
        _union(
            f"SELECT '{BATCH_ID}' AS batch_id, 'bronze_{s}' AS \"table\", count(*) AS rows FROM bronze_{s}"
            for s in SOURCES
        ),
    )

    sql["silver_customers"] = _with(_TO_CUSTOMERS, "SELECT * FROM silver_customers")
    sql["silver_orders"] = _with(_TO_ORDERS, "SELECT * FROM silver_orders")
    sql["silver_transactions"] = _with(_TO_TRANSACTIONS, "SELECT * FROM silver_transactions")
    sql["silver_products"] = _with(_TO_PRODUCTS, "SELECT * FROM silver_products")
    sql["dim_customers"] = _with([*_TO_CUSTOMERS, _DIM_CUSTOMERS], "SELECT * FROM dim_customers")
    sql["dim_products"] = _with([*_TO_PRODUCTS, _DIM_PRODUCTS], "SELECT * FROM dim_products")
    sql["fact_orders"] = _with([*_TO_ORDERS, _FACT_ORDERS], "SELECT * FROM fact_orders")
    sql["fact_transactions"] = _with(
        [*_TO_TRANSACTIONS, _FACT_TRANSACTIONS], "SELECT * FROM fact_transactions"
    )
    sql["stored_fact_orders"] = sql["fact_orders"]
    sql["bucketed_fact_transactions"] = sql["fact_transactions"]
    sql["stored_star"] = _with(
        _ALL,
        _union(f"SELECT '{t}' AS \"table\", count(*) AS rows FROM {t}" for t in vocab.GOLD_TABLES.values()),
    )
    sql["orders_by_status"] = _with(
        [*_TO_ORDERS, _FACT_ORDERS],
        """SELECT status, count(*) AS orders, count(*) - count(total_amount) AS without_amount,
  min(order_date) AS first_order, max(order_date) AS last_order,
  CAST(sum(CAST(total_amount AS DECIMAL(18,2))) AS DOUBLE) AS amount
FROM fact_orders GROUP BY status""",
    )
    sql["dedup_customers"] = _with(_TO_CUSTOMERS, "SELECT * FROM dedup_customers")
    sql["dedup_products"] = _with(_TO_PRODUCTS, "SELECT * FROM dedup_products")
    sql["ref_filter_semi"] = _with(
        [*_TO_ORDERS, _TRANSACTIONS, _TYPED_TRANSACTIONS],
        "SELECT * FROM typed_transactions WHERE order_id IN (SELECT order_id FROM silver_orders)",
    )
    sql["ref_filter_inner"] = _with(
        [*_TO_TRANSACTIONS],
        "SELECT order_id, count(*) AS rows, count(DISTINCT transaction_id) AS transactions "
        "FROM silver_transactions GROUP BY order_id",
    )
    sql["orphans_orders"] = _with(
        [*_TO_CUSTOMERS, _ORDERS, _TYPED_ORDERS],
        f"SELECT ({_orphans('typed_orders', 'silver_customers', 'customer_id')}) AS orphans",
    )
    sql["orphans_transactions"] = _with(
        [*_TO_ORDERS, _TRANSACTIONS, _TYPED_TRANSACTIONS],
        f"SELECT ({_orphans('typed_transactions', 'silver_orders', 'order_id')}) AS orphans",
    )
    sql["orphan_keys_transactions"] = _with(
        [*_TO_ORDERS, _TRANSACTIONS, _TYPED_TRANSACTIONS],
        "SELECT order_id, count(*) AS rows FROM typed_transactions x WHERE NOT EXISTS "
        "(SELECT 1 FROM silver_orders y WHERE y.order_id = x.order_id) GROUP BY order_id",
    )

    sql["quarantine_all"] = _with(_ALL_BRONZE, _ALL_VIOLATIONS)
    sql["quarantine_summary"] = _summary()
    sql["quarantine_ids"] = _with(
        [*_ALL_BRONZE, f"\nviolations AS ({_ALL_VIOLATIONS})"],
        """SELECT row_number() OVER (ORDER BY rule, raw_record) AS id, source_file, rejection_reason,
  rejected_at, raw_record FROM violations""",
    )
    sql["quarantine_id_ranges"] = _with(
        [
            *_ALL_BRONZE,
            f"\nviolations AS ({_ALL_VIOLATIONS})",
            "\nnumbered AS (SELECT row_number() OVER (ORDER BY rule) AS id, * FROM violations)",
        ],
        """SELECT rejection_reason, min(id) AS first_id, max(id) AS last_id, CAST(sum(id) AS BIGINT) AS id_sum,
  count(*) AS rows FROM numbered GROUP BY rejection_reason""",
    )
    sql["date_shape_violations"] = _with(
        [_ORDERS],
        f"SELECT order_date, count(*) AS rows FROM bronze_orders WHERE {_shapeless('order_date')} GROUP BY ALL",
    )
    sql["date_validity_violations"] = _with(
        [_ORDERS],
        "SELECT order_date, count(*) AS rows FROM bronze_orders "
        f"WHERE order_date IS NOT NULL AND {_order_date('order_date')} IS NULL GROUP BY ALL",
    )

    def shown(source, c, result):
        return _with(
            [_BRONZE[source]],
            f"SELECT {c} AS raw, {result}, count(*) AS rows FROM bronze_{source} GROUP BY ALL",
        )

    sql["parse_dates_customers"] = shown(
        "customers", "signup_date", f"{_date('signup_date', vocab.CUSTOMER_DATE_FORMATS)} AS value"
    )
    sql["parse_dates_orders"] = shown("orders", "order_date", f"{_order_date('order_date')} AS value")
    sql["parse_dates_transactions"] = shown(
        "transactions",
        "transaction_date",
        f"{_date('transaction_date', vocab.TRANSACTION_DATE_FORMATS)} AS value",
    )
    sql["parse_currency"] = shown("orders", "total_amount", f"{_currency('total_amount')} AS value")
    sql["map_customer_status"] = shown(
        "customers", "status", f"{_lookup('status', vocab.CUSTOMER_STATUS)} AS value"
    )
    sql["map_order_status"] = shown("orders", "status", f"{_lookup('status', vocab.ORDER_STATUS)} AS value")
    sql["map_payment"] = shown(
        "transactions", "payment_method", f"{_lookup('payment_method', vocab.PAYMENT_METHOD)} AS value"
    )
    sql["map_flag"] = shown(
        "transactions", "success_flag", f"{_lookup('success_flag', vocab.SUCCESS_FLAG)} AS value"
    )
    sql["split_names"] = shown("customers", "full_name", f"{_FIRST} AS first_name, {_LAST} AS last_name")
    sql["conform_email"] = shown("customers", "email", "lower(trim(email)) AS value")
    sql["conform_phone"] = shown("customers", "phone_number", "trim(phone_number) AS value")
    sql["conform_channel"] = shown("orders", "channel", "lower(trim(channel)) AS value")
    sql["sentence_case"] = shown("products", "category", f"{_SENTENCE} AS value")
    sql["blank_to_null"] = shown("products", "supplier_code", "NULLIF(trim(supplier_code), '') AS value")
    sql["lenient_number"] = shown("products", "unit_price", "TRY_CAST(unit_price AS DOUBLE) AS value")
    sql["to_id"] = shown("customers", "customer_id", f"{_id('customer_id')} AS value")
    sql["to_int"] = shown("transactions", "order_id", "TRY_CAST(order_id AS INT) AS value")

    sql["profile_all"] = _profile_all()
    sql["profile_counts"] = _with(
        [_TRANSACTIONS], f'SELECT "column", total, nulls, null_pct FROM ({_profile("transactions")})'
    )
    sql["row_counts"] = _row_counts()
    sql["duplicate_keys"] = _with(_ALL, _union(_DUPLICATES))
    sql["duplicate_key_rows"] = _with(
        _ALL,
        "SELECT transaction_id, count(*) AS rows FROM fact_transactions GROUP BY 1 HAVING count(*) > 1",
    )
    sql["null_checks"] = _with(_ALL, _union(_NULLS))
    sql["ref_integrity"] = _with(_ALL, _union(_REFERENCES))
    sql["declared_unique"] = _declared(
        "unique",
        lambda t, cols: [
            _check("unique", f"{t}.{c}", _repeats(t, c, f"WHERE {c} IS NOT NULL")) for c in cols
        ],
    )
    sql["declared_not_null"] = _declared(
        "not_null", lambda t, cols: [_check("not_null", f"{t}.{c}", _nulls(t, c)) for c in cols]
    )
    sql["declared_relationships"] = _declared(
        "relationships",
        lambda t, links: [
            _check(
                "relationships",
                f"{t}.{c} -> {parent}",
                _orphans(t, parent, c, f"AND x.{c} IS NOT NULL"),
            )
            for c, parent in links
        ],
    )
    every = _union([*_COUNTS, *_DUPLICATES, *_NULLS, *_REFERENCES])
    sql["validation_results"] = _with(_ALL, every)
    sql["validation_summary"] = _with(
        [*_ALL, f"\nresults AS ({every})"],
        "SELECT check_name, bool_and(passed) AS passed FROM results GROUP BY check_name "
        "UNION ALL SELECT 'overall', bool_and(passed) FROM results",
    )
    sql["bucketed_ref_integrity"] = sql["ref_integrity"]
    sql["reloaded_bad_record_ids"] = sql["quarantine_id_ranges"]
    return sql | _published_statements()
