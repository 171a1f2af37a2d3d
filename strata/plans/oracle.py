"""DuckDB SQL for every registered query (the correctness oracle).

Written independently of the Spark code: the SCD2 merge follows the table of
cases by key (no current row, the same hash, an unknown hash, other hashes),
the gold mart is the literal join-then-group-by.  Tables are the driver's views.
"""

from __future__ import annotations

import re

from strata.plans.adapters import DAY1, DAY2, DAY3, PIPELINE_SPLIT, RUN1, RUN2, RUN3

INT_TEXT = r"^\s*([+-]?)([0-9]*)(?:[.]([0-9]*))?\s*$"


def _parse_int(x: str) -> str:
    g = lambda i: f"regexp_extract({x}, '{INT_TEXT}', {i})"
    return (
        f"CASE WHEN regexp_matches({x}, '{INT_TEXT}') AND regexp_matches({x}, '^\\s*[+-]?[.0-9]') "
        f"THEN TRY_CAST({g(1)} || CASE WHEN {g(2)} = '' THEN '0' ELSE {g(2)} END AS INTEGER) END"
    )


def _ts(x: str) -> str:
    return f"try_strptime({x}, '%Y-%m-%d %H:%M:%S')"


def _pad(x: str, left: str = "  ", right: str = " ") -> str:
    return f"('{left}' || {x} || '{right}')"


RAW_ORDERS = f"""
SELECT concat_ws('-', CAST(l.l_orderkey AS VARCHAR), CAST(l.l_linenumber AS VARCHAR)) AS order_id,
       strftime(l.l_shipdate, '%Y-%m-%d %H:%M:%S') AS order_ts,
       CAST(o.o_custkey AS VARCHAR) AS customer_id,
       CAST(l.l_partkey AS VARCHAR) AS product_id,
       CAST(CAST(trunc(l.l_quantity) AS INTEGER) AS VARCHAR) AS quantity,
       CAST(p.p_retailprice AS VARCHAR) AS unit_price,
       CAST(date_trunc('month', l.l_shipdate) AS DATE) AS dt,
       l.l_linenumber AS ln, l.l_returnflag AS rf, l.l_linestatus AS ls, l.l_tax AS tax,
       l.l_discount AS disc, l.l_shipdate AS shipdate
FROM lineitem l
LEFT JOIN orders o ON l.l_orderkey = o.o_orderkey
LEFT JOIN part p ON l.l_partkey = p.p_partkey
"""

RAW_ORDERS_DIRTY = f"""
SELECT CASE WHEN rf = 'R' AND ln = 7 THEN ''
            WHEN rf = 'A' AND ln = 7 THEN NULL
            WHEN rf = 'N' AND ln = 7 THEN '   '
            WHEN ls = 'O' THEN {_pad('order_id')}
            ELSE order_id END AS order_id,
       CASE WHEN ln = 6 AND rf = 'A' THEN strftime(shipdate, '%Y/%m/%d %H:%M:%S') ELSE order_ts END AS order_ts,
       CASE WHEN ls = 'O' THEN {_pad('customer_id')} ELSE customer_id END AS customer_id,
       CASE WHEN ls = 'O' THEN {_pad('product_id', ' ', '  ')} ELSE product_id END AS product_id,
       CASE WHEN ln = 1 AND disc = 0.0 THEN '0'
            WHEN ln = 2 AND tax = 0.08 THEN 'x'
            WHEN ln = 3 AND tax = 0.0 THEN NULL
            WHEN ln = 4 AND rf = 'N' THEN quantity || '.0'
            WHEN ln = 5 AND disc = 0.1 THEN '-' || quantity
            WHEN ls = 'F' THEN {_pad('quantity', ' ', ' ')}
            ELSE quantity END AS quantity,
       CASE WHEN ln = 6 AND tax = 0.01 THEN 'n/a' ELSE unit_price END AS unit_price,
       dt
FROM raw_orders_all
"""

CUSTOMER_BASE = """
SELECT c.c_custkey, c.c_name, c.c_acctbal, c.c_mktsegment, n.n_name,
       lower(replace(c.c_name, '#', '.')) || '@example.com' AS email
FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
"""


def _customer_rows(city: str, ts: str, where: str) -> str:
    return (
        f"SELECT CAST(c_custkey AS VARCHAR) AS customer_id, c_name AS full_name, email, "
        f"{city} AS city, '{ts}' AS updated_at FROM customer_base WHERE {where}"
    )


RAW_CUSTOMERS_1 = _customer_rows("c_mktsegment", f"{DAY1} 08:00:00", "c_acctbal >= 0")
RAW_CUSTOMERS_2 = (
    _customer_rows("c_mktsegment", f"{DAY2} 08:00:00", "c_acctbal < 9000")
    + " UNION ALL "
    + _customer_rows("n_name", f"{DAY2} 17:30:00", "c_acctbal >= 0 AND c_acctbal < 1000")
)

RAW_CUSTOMERS_3 = _customer_rows("c_mktsegment", f"{DAY3} 08:00:00", "c_acctbal >= 0")

RAW_CUSTOMERS_DIRTY = f"""
SELECT CASE WHEN c_acctbal < 0 AND c_mktsegment = 'AUTOMOBILE' THEN ''
            WHEN c_acctbal < 0 AND c_mktsegment = 'FURNITURE' THEN NULL
            WHEN c_acctbal < 0 AND c_mktsegment = 'HOUSEHOLD' THEN '  '
            ELSE {_pad('CAST(c_custkey AS VARCHAR)', ' ', '  ')} END AS customer_id,
       {_pad('c_name')} AS full_name,
       CASE WHEN c_mktsegment = 'MACHINERY' THEN {_pad('upper(email)', ' ', ' ')} ELSE email END AS email,
       ' ' || c_mktsegment AS city,
       CASE WHEN c_acctbal >= 9000 THEN '2026/02/20 08:00:00'
            WHEN c_mktsegment = 'BUILDING' AND c_acctbal < 500 THEN NULL
            ELSE '{DAY1} 08:00:00' END AS updated_at
FROM customer_base
"""


def _product_rows(category: str, ts: str, where: str) -> str:
    return (
        f"SELECT CAST(p_partkey AS VARCHAR) AS product_id, p_name AS product_name, {category} AS category, "
        f"CAST(p_retailprice AS VARCHAR) AS list_price, '{ts}' AS updated_at FROM part WHERE {where}"
    )


RAW_PRODUCTS_1 = _product_rows("p_type", f"{DAY1} 08:00:00", "p_size <= 45")
RAW_PRODUCTS_3 = _product_rows("p_type", f"{DAY3} 08:00:00", "p_size <= 45")


def _raw_products_2(landed: str) -> str:
    return _product_rows("CASE WHEN p_brand = 'Brand#1' THEN 'CLEARANCE' ELSE p_type END", f"{DAY2} 08:00:00", landed)


RAW_PRODUCTS_2 = _raw_products_2("p_size >= 3")
RAW_PRODUCTS_2_WITHHELD = _raw_products_2("p_size >= 3 AND p_size <= 49")

RAW_PRODUCTS_DIRTY = f"""
SELECT CASE WHEN p_size = 50 AND p_type = 'SMALL' THEN '' ELSE {_pad('CAST(p_partkey AS VARCHAR)')} END AS product_id,
       {_pad('p_name', ' ', ' ')} AS product_name,
       {_pad('p_type', '', '  ')} AS category,
       CASE WHEN p_size = 1 THEN 'n/a'
            WHEN p_type = 'PROMO' THEN {_pad('CAST(p_retailprice AS VARCHAR)', ' ', ' ')}
            ELSE CAST(p_retailprice AS VARCHAR) END AS list_price,
       CASE WHEN p_size = 2 THEN 'yesterday' ELSE '{DAY1} 08:00:00' END AS updated_at
FROM part
"""


def std_customers(src: str, dt: str | None, run_ts: str) -> str:
    day = f"DATE '{dt}'" if dt else "dt"
    return f"""
SELECT trim(customer_id) AS customer_id, trim(full_name) AS full_name, lower(trim(email)) AS email,
       trim(city) AS city, {_ts('updated_at')} AS updated_at, {day} AS dt,
       TIMESTAMP '{run_ts}' AS ingest_ts
FROM {src} WHERE trim(customer_id) IS NOT NULL AND trim(customer_id) <> ''
"""


def std_products(src: str, dt: str | None, run_ts: str) -> str:
    day = f"DATE '{dt}'" if dt else "dt"
    return f"""
SELECT trim(product_id) AS product_id, trim(product_name) AS product_name, trim(category) AS category,
       TRY_CAST(list_price AS DOUBLE) AS list_price, {_ts('updated_at')} AS updated_at, {day} AS dt,
       TIMESTAMP '{run_ts}' AS ingest_ts
FROM {src} WHERE trim(product_id) IS NOT NULL AND trim(product_id) <> ''
"""


def std_orders(src: str, dt: str | None, run_ts: str) -> str:
    day = f"DATE '{dt}'" if dt else "dt"
    return f"""
SELECT * FROM (
  SELECT trim(order_id) AS order_id, {_ts('order_ts')} AS order_ts, trim(customer_id) AS customer_id,
         trim(product_id) AS product_id, {_parse_int('quantity')} AS quantity,
         TRY_CAST(unit_price AS DOUBLE) AS unit_price, {day} AS dt, TIMESTAMP '{run_ts}' AS ingest_ts
  FROM {src})
WHERE order_id IS NOT NULL AND order_id <> '' AND quantity > 0
"""


def fact(src: str, keys: str = "dt, order_id") -> str:
    return f"""
SELECT order_id, order_ts, customer_id, product_id, quantity, unit_price,
       CAST(round(quantity * unit_price, 2) AS DECIMAL(18,2)) AS order_amount, dt, ingest_ts
FROM (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY ingest_ts DESC NULLS LAST,
        order_ts DESC NULLS LAST, customer_id DESC NULLS LAST, product_id DESC NULLS LAST,
        quantity DESC NULLS LAST, unit_price DESC NULLS LAST, dt DESC NULLS LAST) AS rn FROM {src})
WHERE rn = 1
"""


def _hash(cols: list[str]) -> str:
    parts = ", ".join(f"coalesce(CAST({c} AS VARCHAR), '')" for c in cols)
    return f"sha256(concat_ws('||', {parts}))"


def src_latest(stg: str, key: str, tracked: list[str]) -> str:
    order = ", ".join(f"{c} DESC NULLS LAST" for c in ["updated_at", "ingest_ts", *tracked, "dt"])
    cols = ", ".join(tracked)
    return f"""
SELECT {key}, {cols}, {_hash(tracked)} AS hash_diff, ingest_ts
FROM (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY {order}) AS rn FROM {stg}) WHERE rn = 1
"""


def dim_columns(key: str, tracked: list[str]) -> str:
    return ", ".join([key, *tracked, "hash_diff", "effective_from_ts", "effective_to_ts", "is_current", "ingest_ts"])


def first_load(src: str, key: str, tracked: list[str], run_ts: str) -> str:
    cols = ", ".join(tracked)
    return (
        f"SELECT {key}, {cols}, hash_diff, TIMESTAMP '{run_ts}' AS effective_from_ts, "
        f"CAST(NULL AS TIMESTAMP) AS effective_to_ts, true AS is_current, ingest_ts FROM {src}"
    )


def merge_parts(prev: str, src: str, key: str, tracked: list[str], run_ts: str) -> dict[str, str]:
    """One merge as a table of cases.  For each source key, over the current
    rows of the target: does one have the same hash, or an unknown (null) one?
    Then nothing is inserted; else the new version is.  A current row whose
    known hash differs is closed."""
    cols = dim_columns(key, tracked)
    cases = f"""
SELECT s.{key} AS k, s.hash_diff AS new_hash,
       coalesce(bool_or(t.hash_diff = s.hash_diff), false) OR coalesce(bool_or(t.{key} IS NOT NULL AND t.hash_diff IS NULL), false) AS stays
FROM {src} s LEFT JOIN (SELECT * FROM {prev} WHERE is_current) t ON t.{key} = s.{key}
GROUP BY s.{key}, s.hash_diff
"""
    closing = "(t.is_current AND c.new_hash IS NOT NULL AND t.hash_diff <> c.new_hash) IS TRUE"
    merged = f"""
SELECT t.* EXCLUDE (effective_to_ts, is_current),
       CASE WHEN {closing} THEN TIMESTAMP '{run_ts}' ELSE t.effective_to_ts END AS effective_to_ts,
       CASE WHEN {closing} THEN false ELSE t.is_current END AS is_current, {closing} AS expired_now
FROM {prev} t LEFT JOIN ({cases}) c ON t.{key} = c.k
"""
    inserted = first_load(f"{src} s WHERE EXISTS (SELECT 1 FROM ({cases}) c WHERE c.k IS NOT DISTINCT FROM s.{key} AND NOT c.stays)", key, tracked, run_ts)
    return {"merged": merged, "inserted": inserted, "cols": cols}


def with_ctes(ctes: list[tuple[str, str]], body: str) -> str:
    return "WITH " + ",\n".join(f"{n} AS ({q})" for n, q in ctes) + "\n" + body


CUSTOMER_TRACKED = ["full_name", "email", "city"]
PRODUCT_TRACKED = ["product_name", "category", "list_price"]


def _dim_days(entity: str, days: int = 2, withheld: bool = False) -> tuple[list[tuple[str, str]], str]:
    """CTEs ending in ``dim<days>`` (whole dimension after each day), with
    ``merged<n>``/``inserted<n>`` of each later merge."""
    if entity == "customers":
        key, tracked, std = "customer_id", CUSTOMER_TRACKED, std_customers
        base, raw = [("customer_base", CUSTOMER_BASE)], [RAW_CUSTOMERS_1, RAW_CUSTOMERS_2, RAW_CUSTOMERS_3]
    else:
        key, tracked, std = "product_id", PRODUCT_TRACKED, std_products
        base, raw = [], [RAW_PRODUCTS_1, RAW_PRODUCTS_2_WITHHELD if withheld else RAW_PRODUCTS_2, RAW_PRODUCTS_3]
    ctes, cols = list(base), dim_columns(key, tracked)
    for n, (day, run) in enumerate(((DAY1, RUN1), (DAY2, RUN2), (DAY3, RUN3))[:days], 1):
        ctes += [(f"raw{n}", raw[n - 1]), (f"stg{n}", std(f"raw{n}", day, run)), (f"src{n}", src_latest(f"stg{n}", key, tracked))]
        if n == 1:
            ctes.append(("dim1", first_load("src1", key, tracked, run)))
            continue
        m = merge_parts(f"dim{n - 1}", f"src{n}", key, tracked, run)
        ctes += [(f"merged{n}", m["merged"]), (f"inserted{n}", m["inserted"]),
                 (f"dim{n}", f"SELECT {cols} FROM merged{n} UNION ALL SELECT {cols} FROM inserted{n}")]
    return ctes, cols


SUPPLIER_TRACKED = ["name", "nation"]


def _suppliers() -> str:
    rows = lambda nation, day, run, where: (
        f"SELECT CAST(s_suppkey AS VARCHAR) AS supplier_id, s_name AS name, CAST({nation} AS INTEGER) AS nation, "
        f"TIMESTAMP '{day} 08:00:00' AS updated_at, DATE '{day}' AS dt, TIMESTAMP '{run}' AS ingest_ts FROM supplier WHERE {where}"
    )
    m = merge_parts("dim1", "src2", "supplier_id", SUPPLIER_TRACKED, RUN2)
    return with_ctes([
        ("stg1", rows("s_nationkey", DAY1, RUN1, "s_acctbal >= 0")),
        ("stg2", rows("s_nationkey + CASE WHEN s_acctbal >= 0 AND s_acctbal < 1000 THEN 1 ELSE 0 END", DAY2, RUN2, "s_acctbal < 9000")),
        ("src1", src_latest("stg1", "supplier_id", SUPPLIER_TRACKED)),
        ("src2", src_latest("stg2", "supplier_id", SUPPLIER_TRACKED)),
        ("dim1", first_load("src1", "supplier_id", SUPPLIER_TRACKED, RUN1)),
        ("merged2", m["merged"]), ("inserted2", m["inserted"]),
    ], f"SELECT {m['cols']} FROM merged2 UNION ALL SELECT {m['cols']} FROM inserted2")


def _orders_ctes() -> list[tuple[str, str]]:
    return [
        ("raw_orders_all", RAW_ORDERS),
        ("stg_orders", std_orders("raw_orders_all", None, RUN1)),
        ("fact_orders", fact("stg_orders")),
    ]


def _sales_body(fact_src: str, dim_src: str, run_ts: str) -> str:
    return f"""
SELECT f.dt, f.product_id, d.category, count(DISTINCT f.order_id) AS orders_count,
       CAST(sum(f.quantity) AS BIGINT) AS units_sold,
       CAST(round(sum(f.order_amount), 2) AS DECIMAL(18,2)) AS gross_revenue,
       count(DISTINCT f.customer_id) AS unique_customers, TIMESTAMP '{run_ts}' AS ingest_ts
FROM {fact_src} f LEFT JOIN (SELECT product_id, category FROM {dim_src} WHERE is_current) d
  ON f.product_id = d.product_id
GROUP BY f.dt, f.product_id, d.category
"""


def _sales_ctes() -> list[tuple[str, str]]:
    dim_ctes, _ = _dim_days("products", withheld=True)
    return _orders_ctes() + dim_ctes + [("daily_sales", _sales_body("fact_orders", "dim2", RUN2))]


def _tz_body() -> str:
    def prev(expr: str, tz: str) -> str:
        return f"CAST((({expr}) AT TIME ZONE 'UTC') AT TIME ZONE '{tz}' AS DATE) - 1"

    spring, autumn = "ts + INTERVAL 80 DAY", "ts + INTERVAL 300 DAY"
    return f"""
SELECT event_id, ts,
       {prev('ts', 'Europe/London')} AS london_prev_dt,
       {prev('ts', 'America/New_York')} AS new_york_prev_dt,
       {prev(spring, 'Europe/London')} AS london_prev_dt_spring,
       {prev(spring, 'America/New_York')} AS new_york_prev_dt_spring,
       {prev(autumn, 'Europe/London')} AS london_prev_dt_autumn,
       {prev(autumn, 'America/New_York')} AS new_york_prev_dt_autumn
FROM events
"""


def _pipeline_ctes() -> list[tuple[str, str]]:
    """Two daily runs: orders shipped before the split month land on DAY1,
    the rest on DAY2; each day's fact is de-duplicated within the day and
    joined to the product dimension as it stood after that day's merge."""
    dim_ctes, _ = _dim_days("products", withheld=True)
    day_orders = lambda cond: (
        f"SELECT order_id, order_ts, customer_id, product_id, quantity, unit_price FROM raw_orders_all WHERE {cond}"
    )
    return dim_ctes + [
        ("raw_orders_all", RAW_ORDERS),
        ("raw_o1", day_orders(f"dt < DATE '{PIPELINE_SPLIT}'")),
        ("raw_o2", day_orders(f"dt >= DATE '{PIPELINE_SPLIT}'")),
        ("stg_o1", std_orders("raw_o1", DAY1, RUN1)),
        ("stg_o2", std_orders("raw_o2", DAY2, RUN2)),
        ("fact1", fact("stg_o1", "order_id")),
        ("fact2", fact("stg_o2", "order_id")),
        ("gold1", _sales_body("fact1", "dim1", RUN1)),
        ("gold2", _sales_body("fact2", "dim2", RUN2)),
    ]


def _pipeline_sql(tables: tuple[str, ...] = ("gold1", "gold2"), cols: str = "*") -> str:
    return with_ctes(_pipeline_ctes(), " UNION ALL ".join(f"SELECT {cols} FROM {t}" for t in tables))


def _catalog_sql() -> str:
    """Rows and keys of each stored table by day or state after two runs."""
    customers, _ = _dim_days("customers")
    names = {n: f"c_{n}" if n != "customer_base" else n for n, _ in customers}
    renamed = []
    for n, q in customers:
        for old, new in names.items():
            q = re.sub(rf"\b{old}\b", new, q)
        renamed.append((names[n], q))
    by_day = lambda table, key, *sources: [
        f"SELECT '{table}' AS table_name, CAST(dt AS VARCHAR) AS part, count(*) AS n_rows, count(DISTINCT {key}) AS n_keys FROM {s} GROUP BY dt"
        for s in sources
    ]
    by_state = lambda table, key, source: [
        f"SELECT '{table}', CASE WHEN is_current THEN 'open' ELSE 'closed' END, count(*), count(DISTINCT {key}) FROM {source} GROUP BY 2"
    ]
    return with_ctes(renamed + _pipeline_ctes(), " UNION ALL ".join([
        *by_day("bronze.customers_stg", "customer_id", "c_stg1", "c_stg2"), *by_day("bronze.products_stg", "product_id", "stg1", "stg2"),
        *by_day("bronze.orders_stg", "order_id", "stg_o1", "stg_o2"), *by_state("silver.dim_customer_scd2", "customer_id", "c_dim2"),
        *by_state("silver.dim_product_scd2", "product_id", "dim2"), *by_day("silver.fact_orders", "order_id", "fact1", "fact2"),
        *by_day("gold.daily_product_sales", "product_id", "gold1", "gold2"),
    ]))


def oracle_sql() -> dict[str, str]:
    cust_ctes, cust_cols = _dim_days("customers")
    prod_ctes, _ = _dim_days("products")
    fact_cols = "order_id, order_ts, customer_id, product_id, quantity, unit_price, order_amount, dt, ingest_ts"
    raw_cols = "order_id, order_ts, customer_id, product_id, quantity, unit_price, dt"
    return {
        "standardize_customers": with_ctes(
            [("customer_base", CUSTOMER_BASE), ("raw", RAW_CUSTOMERS_DIRTY)],
            std_customers("raw", DAY1, RUN1),
        ),
        "standardize_products": with_ctes([("raw", RAW_PRODUCTS_DIRTY)], std_products("raw", DAY1, RUN1)),
        "standardize_orders": with_ctes(
            [("raw_orders_all", RAW_ORDERS), ("raw", RAW_ORDERS_DIRTY)], std_orders("raw", None, RUN1)
        ),
        "latest_per_key": """
SELECT event_id, ts, user_id, event_type, value, props FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC NULLS LAST, event_id DESC NULLS LAST,
         event_type DESC NULLS LAST, value DESC NULLS LAST, props DESC NULLS LAST) AS rn FROM events)
WHERE rn = 1
""",
        "hash_diff": with_ctes(
            cust_ctes,
            f"SELECT customer_id, updated_at, {_hash(CUSTOMER_TRACKED)} AS hash_diff FROM (SELECT * FROM stg1 UNION ALL SELECT * FROM stg2)",
        ),
        "fact_orders": with_ctes(_orders_ctes(), f"SELECT {fact_cols} FROM fact_orders"),
        "scd2_customers": with_ctes(cust_ctes, "SELECT * FROM dim2"),
        "scd2_products": with_ctes(prod_ctes, "SELECT * FROM dim2"),
        "scd2_customers_three_days": with_ctes(_dim_days("customers", 3)[0], "SELECT * FROM dim3"),
        "scd2_customers_backfill": with_ctes(_dim_days("customers", 3)[0], "SELECT * FROM dim3"),
        "scd2_customers_sql": with_ctes(cust_ctes, "SELECT * FROM dim2"),
        "scd2_expired": with_ctes(cust_ctes, f"SELECT {cust_cols} FROM merged2 WHERE expired_now"),
        "scd2_inserted": with_ctes(cust_ctes, "SELECT * FROM inserted2"),
        "sales_enriched": with_ctes(
            _orders_ctes() + _dim_days("products", withheld=True)[0],
            f"SELECT f.product_id, {', '.join('f.' + c for c in fact_cols.split(', ') if c != 'product_id')}, d.category "
            "FROM fact_orders f LEFT JOIN (SELECT product_id, category FROM dim2 WHERE is_current) d "
            "ON f.product_id = d.product_id",
        ),
        "daily_product_sales": with_ctes(_sales_ctes(), "SELECT * FROM daily_sales"),
        "sales_preview": with_ctes(
            _sales_ctes(),
            "SELECT * FROM daily_sales ORDER BY dt DESC NULLS LAST, product_id ASC NULLS LAST, "
            "category ASC NULLS LAST LIMIT 50",
        ),
        "previous_business_date": _tz_body(),
        "landing_roundtrip": with_ctes([("raw_orders_all", RAW_ORDERS)], f"SELECT {raw_cols} FROM raw_orders_all"),
        "pipeline_two_days": _pipeline_sql(),
        # day 1 rerun with no orders landed: its gold folder is emptied, day 2 stays
        "pipeline_replay_empty_day": _pipeline_sql(("gold2",)),
        # bucketed dimensions change the physical layout only
        "pipeline_two_days_bucketed": _pipeline_sql(),
        "fact_orders_by_order_id": with_ctes(_orders_ctes()[:2], fact("stg_orders", "order_id")),
        "pipeline_dim_customer": with_ctes(_dim_days("customers", 3)[0], "SELECT * FROM dim3"),
        "pipeline_dim_versioned": with_ctes(_dim_days("customers", 3)[0], "SELECT * FROM dim3"),
        "pipeline_dim_product": with_ctes(_dim_days("products", 3)[0], "SELECT * FROM dim3"),
        "pipeline_default_clock": with_ctes(
            cust_ctes,
            "SELECT customer_id, count(*) AS versions, count(*) FILTER (WHERE is_current) AS open_versions, true AS gapless, true AS past "
            "FROM dim2 GROUP BY customer_id",
        ),
        "pipeline_fact": _pipeline_sql(("fact1", "fact2"), fact_cols),
        "pipeline_preview": with_ctes(
            _pipeline_ctes(),
            "SELECT * FROM (SELECT * FROM gold1 UNION ALL SELECT * FROM gold2) ORDER BY dt DESC, product_id ASC NULLS LAST, category ASC NULLS LAST LIMIT 50",
        ),
        "pipeline_enriched_catalog": with_ctes(
            _pipeline_ctes() + [("sold", "SELECT * FROM fact1 UNION ALL SELECT * FROM fact2")],
            "SELECT f.dt, f.order_id, f.product_id, f.order_amount, d.category FROM sold f "
            "LEFT JOIN (SELECT product_id, category FROM dim2 WHERE is_current) d ON f.product_id = d.product_id",
        ),
        "pipeline_catalog": _catalog_sql(),
        "scd2_suppliers": _suppliers(),
    }


__all__ = ["oracle_sql", "DAY1", "DAY2", "RUN1", "RUN2"]
