import os

from pyspark.sql import functions as F

from strata.plans.catalog import ensure_catalog, list_databases, list_tables
from strata.plans.daily import run_day
from strata.sinks import layout as L
from strata.sinks.writers import export_landing, replace_day
from strata.sources import read_current, read_day, read_landing, read_table
from strata.sources.landing import RAW_COLUMNS

DAYS = ("2026-02-20", "2026-02-21", "2026-02-22")


def _land(spark, landing, day, customers, products, orders):
    export_landing(spark.createDataFrame(customers, list(RAW_COLUMNS["customers"])), landing, "customers", day)
    export_landing(spark.createDataFrame(products, list(RAW_COLUMNS["products"])), landing, "products", day)
    export_landing(spark.createDataFrame(orders, list(RAW_COLUMNS["orders"])), landing, "orders", day)


def _scenario(spark, landing):
    ts = "{} 09:00:00"
    c = lambda d, city: [
        (" C1 ", "Alice", " ALICE@X.COM ", city, ts.format(d)),
        ("C2", "Bob", "bob@x.com", "MK", ts.format(d)),
    ]
    p = lambda d, cat: [("P1", "Prod 1", cat, "10.00", ts.format(d)), ("P2", "Prod 2", "Books", "2.50", ts.format(d))]
    o = lambda d: [
        (f"O{d[-2:]}1", ts.format(d), "C1", "P1", "2", "10.00"),
        (f"O{d[-2:]}1", ts.format(d), "C1", "P1", "2", "10.00"),
        (f"O{d[-2:]}2", ts.format(d), "C2", "P1", "1", "10.00"),
        (f"O{d[-2:]}3", ts.format(d), "C2", "P2", "3", "2.50"),
        (f"O{d[-2:]}4", ts.format(d), "C2", "P3", "x", "2.50"),
        (f"O{d[-2:]}5", ts.format(d), "C1", "P3", "1", "1.00"),
    ]
    _land(spark, landing, DAYS[0], c(DAYS[0], "London"), p(DAYS[0], "Electronics"), o(DAYS[0]))
    _land(spark, landing, DAYS[1], c(DAYS[1], "Oxford"), p(DAYS[1], "Electronics"), o(DAYS[1]))
    _land(spark, landing, DAYS[2], c(DAYS[2], "London"), p(DAYS[2], "Gadgets"), o(DAYS[2]))


def _snapshot(spark, root):
    drop = ["ingest_ts"]
    return {
        spec.name: sorted(map(repr, read_table(spark, spec, root).drop(*drop).collect()))
        for spec in (L.DIM_CUSTOMER, L.DIM_PRODUCT, L.FACT_ORDERS, L.DAILY_PRODUCT_SALES)
    }


def test_three_day_run_invariants_and_idempotent_rerun(spark, tmp_root, clean_catalog):
    landing, root = os.path.join(tmp_root, "landing"), os.path.join(tmp_root, "wh")
    _scenario(spark, landing)
    for i, day in enumerate(DAYS):
        run_day(spark, root, day, f"2026-02-{21 + i} 06:00:00", landing_root=landing)

    dim_c = read_table(spark, L.DIM_CUSTOMER, root)
    assert dim_c.where("is_current").groupBy("customer_id").count().where("count > 1").count() == 0
    assert dim_c.where("customer_id = 'C1'").count() == 3  # London -> Oxford -> London
    assert dim_c.where("NOT is_current AND NOT (effective_from_ts < effective_to_ts)").count() == 0
    cur_p = {r["product_id"]: r["category"] for r in read_current(spark, L.DIM_PRODUCT, root).collect()}
    assert cur_p == {"P1": "Gadgets", "P2": "Books"}

    fact = read_table(spark, L.FACT_ORDERS, root)
    gold = read_table(spark, L.DAILY_PRODUCT_SALES, root)
    assert fact.count() == 4 * 3  # duplicate O..1 removed, quantity "x" dropped in bronze
    assert fact.agg(F.sum("quantity")).collect()[0][0] == gold.agg(F.sum("units_sold")).collect()[0][0]
    g = {(str(r["dt"]), r["product_id"]): r for r in gold.collect()}
    assert g[(DAYS[2], "P1")]["category"] == "Gadgets" and g[(DAYS[0], "P1")]["category"] == "Electronics"
    assert g[(DAYS[0], "P3")]["category"] is None
    assert (g[(DAYS[0], "P1")]["orders_count"], g[(DAYS[0], "P1")]["units_sold"]) == (2, 3)
    assert str(g[(DAYS[0], "P1")]["gross_revenue"]) == "30.00"

    before = _snapshot(spark, root)
    run_day(spark, root, DAYS[2], "2026-02-23 07:00:00", landing_root=landing, bronze_mode="replace_day")
    after = _snapshot(spark, root)
    assert before == after
    assert read_day(spark, L.ORDERS_STG, root, DAYS[2]).count() == 5  # replace_day bronze, not a second append

    # catalog: databases and tables are registered over the same folders
    assert {r[0] for r in list_databases(spark).collect()} >= {"bronze", "silver", "gold"}
    assert {r["tableName"] for r in list_tables(spark, "gold").collect()} == {"daily_product_sales"}
    for spec in (L.DAILY_PRODUCT_SALES, L.FACT_ORDERS, L.DIM_CUSTOMER):  # run_day refreshed them
        assert spark.table(spec.qualified_name).count() == read_table(spark, spec, root).count()
    top = spark.sql("SELECT * FROM gold.daily_product_sales ORDER BY dt DESC, product_id LIMIT 50").collect()
    assert str(top[0]["dt"]) == DAYS[2]


def test_replace_day_empty_and_neighbours(spark, tmp_root):
    root = os.path.join(tmp_root, "wh")
    rows = [("O1", None, "C1", "P1", 1, 1.0, None, "2026-02-20", None), ("O2", None, "C1", "P1", 1, 1.0, None, "2026-02-21", None)]
    df = spark.createDataFrame(rows, "order_id string, order_ts timestamp, customer_id string, product_id string, quantity int, unit_price double, order_amount decimal(18,2), dt string, ingest_ts timestamp").withColumn("dt", F.to_date("dt"))
    for day in ("2026-02-20", "2026-02-21"):
        replace_day(df.where(F.col("dt") == day), L.FACT_ORDERS, root, day)
    assert read_table(spark, L.FACT_ORDERS, root).count() == 2
    replace_day(df.limit(0), L.FACT_ORDERS, root, "2026-02-21")
    out = read_table(spark, L.FACT_ORDERS, root)
    assert [r["order_id"] for r in out.collect()] == ["O1"]
    replace_day(df.where("dt = '2026-02-21'"), L.FACT_ORDERS, root, "2026-02-21")
    assert read_table(spark, L.FACT_ORDERS, root).count() == 2


def test_landing_csv_quirks_bind_by_name(spark, tmp_root):
    path = os.path.join(tmp_root, "orders.csv")
    with open(path, "w") as f:
        f.write("quantity,order_id,unit_price,customer_id,product_id,order_ts\n")
        f.write('2,O1,3.5,C1,P1,2026-02-20 09:00:00\n')
        f.write('"",O2,"",C1,P1,2026-02-20 09:00:00\n')
        f.write('1,O3\n')
        f.write('1,O4,1.0,C1,P1,2026-02-20 09:00:00,extra\n')
    raw = read_landing(spark, path, RAW_COLUMNS["orders"])
    assert raw.columns == list(RAW_COLUMNS["orders"])
    rows = {r["order_id"]: r for r in raw.collect()}
    assert rows["O1"]["quantity"] == "2" and rows["O1"]["unit_price"] == "3.5"
    assert rows["O2"]["quantity"] is None and rows["O2"]["unit_price"] is None
    assert rows["O3"]["customer_id"] is None
    assert rows["O4"]["order_ts"] == "2026-02-20 09:00:00"


def test_ensure_catalog_is_idempotent(spark, tmp_root, clean_catalog):
    ensure_catalog(spark, tmp_root)
    ensure_catalog(spark, tmp_root)
    assert {r["tableName"] for r in list_tables(spark, "silver").collect()} >= {"dim_customer_scd2", "dim_product_scd2", "fact_orders"}


def test_multi_day_export_writes_few_files_per_day(spark, tmp_root):
    import glob

    from strata.sources import read_landing_days

    df = spark.range(0, 20000, 1, 8).select(
        F.col("id").cast("string").alias("order_id"), F.lit("2026-02-20 09:00:00").alias("order_ts"),
        F.lit("C1").alias("customer_id"), F.lit("P1").alias("product_id"), F.lit("1").alias("quantity"),
        F.lit("1.0").alias("unit_price"),
        F.when(F.col("id") % 3 == 0, F.lit("2026-02-21")).otherwise(F.lit("2026-02-20")).cast("date").alias("dt"),
    )
    export_landing(df, tmp_root, "orders")
    back = read_landing_days(spark, tmp_root, "orders")
    assert back.count() == 20000
    assert back.where("dt = DATE'2026-02-21'").count() == 6667
    files = glob.glob(os.path.join(tmp_root, "raw", "orders", "dt=*", "*.csv"))
    assert 2 <= len(files) < 16  # not one file per (task, day)


def test_rerun_in_append_mode_keeps_silver_and_gold(spark, tmp_root):
    landing, root = os.path.join(tmp_root, "landing"), os.path.join(tmp_root, "wh")
    _scenario(spark, landing)
    run_day(spark, root, DAYS[0], "2026-02-21 06:00:00", landing_root=landing, register=False)
    before = _snapshot(spark, root)
    run_day(spark, root, DAYS[0], "2026-02-21 09:00:00", landing_root=landing, register=False)
    assert read_day(spark, L.ORDERS_STG, root, DAYS[0]).count() == 10  # bronze appended twice, as the reference
    assert _snapshot(spark, root) == before


def test_reordered_columns_across_days_fail_instead_of_mislabel(spark, tmp_root):
    import pytest

    from strata.sources import read_landing_days

    for day, header, row in (("2026-02-20", "order_id,quantity", "O1,2"), ("2026-02-21", "quantity,order_id", "3,O2")):
        folder = os.path.join(tmp_root, "raw", "orders", f"dt={day}")
        os.makedirs(folder)
        with open(os.path.join(folder, "part.csv"), "w") as f:
            f.write(f"{header},order_ts,customer_id,product_id,unit_price\n{row},,,,\n")
    with pytest.raises(Exception):
        read_landing_days(spark, tmp_root, "orders").collect()


def test_dimension_history_folders_are_never_rewritten(spark, tmp_root):
    import glob

    landing, root = os.path.join(tmp_root, "landing"), os.path.join(tmp_root, "wh")
    _scenario(spark, landing)
    run_day(spark, root, DAYS[0], "2026-02-21 06:00:00", landing_root=landing, register=False)
    run_day(spark, root, DAYS[1], "2026-02-22 06:00:00", landing_root=landing, register=False)
    dim_path = L.DIM_CUSTOMER.path(root)
    closed = glob.glob(os.path.join(dim_path, "is_current=false", f"closed_dt={DAYS[1]}", "*.parquet"))
    assert closed, "day 2 closed London"
    before = {f: (os.stat(f).st_mtime_ns, os.path.getsize(f)) for f in closed}
    run_day(spark, root, DAYS[2], "2026-02-23 06:00:00", landing_root=landing, register=False)
    after = {f: (os.stat(f).st_mtime_ns, os.path.getsize(f)) for f in closed if os.path.exists(f)}
    assert after == before
    folders = sorted(os.path.basename(p) for p in glob.glob(os.path.join(dim_path, "is_current=false", "closed_dt=*")))
    assert folders == [f"closed_dt={DAYS[1]}", f"closed_dt={DAYS[2]}"]


def test_bucketed_dimensions_match_path_layout(spark, tmp_root, clean_catalog):
    landing = os.path.join(tmp_root, "landing")
    plain, bucketed = os.path.join(tmp_root, "plain"), os.path.join(tmp_root, "bucketed")
    _scenario(spark, landing)
    before = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    for i, day in enumerate(DAYS):
        run_ts = f"2026-02-{21 + i} 06:00:00"
        run_day(spark, plain, day, run_ts, landing_root=landing, register=False)
        run_day(spark, bucketed, day, run_ts, landing_root=landing, register=False, dim_buckets=4)
    assert _snapshot(spark, plain) == _snapshot(spark, bucketed)
    assert spark.table(L.DIM_CUSTOMER.qualified_name).where("customer_id = 'C1'").count() == 3
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == before


def test_catalog_guard_refuses_another_warehouse_or_bucketing(spark, tmp_root, clean_catalog):
    import pytest

    from strata.plans.catalog import ensure_table

    spec = L.DIM_PRODUCT
    a, b = os.path.join(tmp_root, "a"), os.path.join(tmp_root, "b")
    assert ensure_table(spark, spec, a, 4) == spec.qualified_name
    assert ensure_table(spark, spec, a, 4) == spec.qualified_name  # idempotent
    with pytest.raises(ValueError, match="registered at"):
        ensure_table(spark, spec, b, 4)
    with pytest.raises(ValueError, match="buckets"):
        ensure_table(spark, spec, a, 8)
    with pytest.raises(ValueError, match="registered at"):
        ensure_catalog(spark, b)  # the whole catalog is guarded too


def test_backfill_append_rebalances_by_day(spark, tmp_root):
    import glob

    from strata.sinks.writers import append_by_name

    df = spark.range(0, 30000, 1, 8).select(
        F.col("id").cast("string").alias("order_id"), F.lit(None).cast("timestamp").alias("order_ts"),
        F.lit("C1").alias("customer_id"), F.lit("P1").alias("product_id"), F.lit(1).alias("quantity"),
        F.lit(1.0).alias("unit_price"),
        F.date_add(F.to_date(F.lit("2026-01-01")), (F.col("id") % 5).cast("int")).alias("dt"),
        F.lit(None).cast("timestamp").alias("ingest_ts"),
    )
    append_by_name(df, L.ORDERS_STG, tmp_root, rebalance=True)
    assert read_table(spark, L.ORDERS_STG, tmp_root).count() == 30000
    per_day = [len(glob.glob(os.path.join(p, "*.parquet")))
               for p in glob.glob(os.path.join(L.ORDERS_STG.path(tmp_root), "dt=*"))]
    assert len(per_day) == 5 and max(per_day) < 8  # not one file per (task, day)


def test_replace_day_fails_on_rows_of_another_day(spark, tmp_root):
    import pytest

    schema = "dt date, product_id string, category string, orders_count long, units_sold long, gross_revenue decimal(18,2), unique_customers long, ingest_ts timestamp"
    row = lambda day: (day, "P", "c", 1, 1, None, 1, None)
    import datetime as dt

    own, other = dt.date(2026, 5, 1), dt.date(2026, 5, 2)
    for days in ([own, other], [own, None]):
        with pytest.raises(Exception, match="in the load of 2026-05-01"):
            replace_day(spark.createDataFrame([row(d) for d in days], schema), L.DAILY_PRODUCT_SALES, tmp_root, "2026-05-01")
    replace_day(spark.createDataFrame([row(own)], schema), L.DAILY_PRODUCT_SALES, tmp_root, "2026-05-01")
    assert read_day(spark, L.DAILY_PRODUCT_SALES, tmp_root, "2026-05-01").count() == 1


def test_a_merge_after_a_broken_commit_is_refused(spark, tmp_root):
    import shutil

    import pytest

    landing = os.path.join(tmp_root, "landing")
    _scenario(spark, landing)
    for i, day in enumerate(DAYS[:2]):
        run_day(spark, tmp_root, day, f"2026-02-{21 + i} 06:00:00", landing_root=landing, register=False)
    path = L.DIM_CUSTOMER.path(tmp_root)
    assert os.path.isdir(f"{path}/is_current=false")
    shutil.move(f"{path}/is_current=true", os.path.join(tmp_root, "aside"))
    with pytest.raises(RuntimeError, match="history but no current rows"):
        run_day(spark, tmp_root, DAYS[2], "2026-02-23 06:00:00", landing_root=landing, register=False)


def test_a_damaged_dimension_is_not_taken_for_a_first_load(spark, tmp_root):
    import pytest

    landing = os.path.join(tmp_root, "landing")
    _scenario(spark, landing)
    run_day(spark, tmp_root, DAYS[0], "2026-02-21 06:00:00", landing_root=landing, register=False)
    folder = f"{L.DIM_CUSTOMER.path(tmp_root)}/is_current=true"
    for top, _, names in os.walk(folder):
        for name in names:
            if name.endswith(".parquet"):
                with open(os.path.join(top, name), "wb") as f:
                    f.write(b"not parquet")
    with pytest.raises(Exception):
        run_day(spark, tmp_root, DAYS[1], "2026-02-22 06:00:00", landing_root=landing, register=False)


def test_generic_merge_by_name_defaults_and_refusals(spark, tmp_root):
    import datetime as dt

    import pytest

    from strata.plans.catalog import create_dimension
    from strata.plans.daily import scd2_merge

    root = os.path.join(tmp_root, "it's here")  # the quote must survive the DDL
    name = "generic_db.dim_shop"
    stage = lambda city, day: spark.createDataFrame(
        [("S1", city, dt.datetime(2026, 4, day), dt.datetime(2026, 4, day), dt.date(2026, 4, day))],
        "shop_id string, city string, updated_at timestamp, ingest_ts timestamp, dt date",
    )
    try:
        spec = create_dimension(spark, name, stage("x", 1).select("shop_id", "city").schema, "shop_id", root)
        for city, day in (("Leeds", 1), ("York", 2), ("York", 3)):
            scd2_merge(spark, stage(city, day), name, "shop_id", ["city"], ["updated_at", "ingest_ts"])
        seen = sorted((r["city"], r["is_current"], str(r["closed_dt"])) for r in spark.table(name).collect())
        assert seen == [("Leeds", False, "2026-04-02"), ("York", True, "9999-12-31")]
        versions = {r["city"]: r for r in read_table(spark, spec, root).collect()}
        assert versions["Leeds"]["effective_to_ts"] == versions["York"]["effective_from_ts"]
        with pytest.raises(ValueError, match="not an SCD2 dimension"):
            scd2_merge(spark, stage("x", 4), name, "shop_id", ["colour"], ["updated_at"])
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        spark.sql("DROP DATABASE IF EXISTS generic_db")
