"""Steps side by side, the pruned preview, and statistics of a run."""

import datetime as dt
import threading
import time

import pytest
from pyspark.sql import functions as F

from strata.operators import enrich_sales, top_sales
from strata.plans import adapters as A
from strata.plans import daily as D
from strata.plans import registry as R
from strata.plans.catalog import analyze_columns, list_databases, list_tables, table_details
from strata.plans.together import together
from strata.sinks import layout as L
from strata.sinks.writers import replace_day
from strata.sources import read_table
from tests.test_pipeline import DAYS, _scenario


def test_steps_overlap_and_inherit_the_job_group(spark):
    barrier, groups = threading.Barrier(3, timeout=30), []
    spark.sparkContext.setJobGroup("together", "test")

    def step():
        barrier.wait()  # passes only if all three run at once
        groups.append(spark.sparkContext.getLocalProperty("spark.jobGroup.id"))

    together(spark, step, step, step)
    assert groups == ["together"] * 3


def test_a_failing_step_fails_the_run_after_the_others_stopped(spark):
    done = []

    def slow():
        time.sleep(0.5)
        done.append("slow")

    def fail(message):
        raise ValueError(message)

    with pytest.raises(ValueError, match="first") as e:
        together(spark, slow, lambda: fail("first"), lambda: fail("second"))
    assert done == ["slow"] and any("second" in n for n in e.value.__notes__)


def test_no_later_group_begins_after_a_failure(spark, tmp_root, monkeypatch):
    reached = []
    monkeypatch.setattr(D, "ingest_entity", lambda *a: (_ for _ in ()).throw(RuntimeError("no landing")) if a[3] == "products" else reached.append(a[3]))
    monkeypatch.setattr(D, "merge_dimension", lambda *a: reached.append("dimension"))
    monkeypatch.setattr(D, "load_fact", lambda *a: reached.append("fact"))
    with pytest.raises(RuntimeError, match="no landing"):
        D.run_day(spark, tmp_root, "2026-02-20", "2026-02-21 06:00:00", register=False)
    assert sorted(reached) == ["customers", "orders"]


def test_side_by_side_stores_the_same_tables(spark, tmp_root, clean_catalog):
    landing = f"{tmp_root}/landing"
    _scenario(spark, landing)
    for mode in (True, False):
        for day in DAYS:
            D.run_day(spark, f"{tmp_root}/{mode}", day, f"{day} 23:00:00", landing_root=landing, register=False, side_by_side=mode)
    for spec in L.TABLES:
        rows = [sorted(map(repr, read_table(spark, spec, f"{tmp_root}/{mode}").collect())) for mode in (True, False)]
        assert rows[0] == rows[1] and rows[0], spec.name


def _gold_day(spark, day, n):
    rows = [(None if i % 7 == 3 else f"p{i * 37 % n:03d}", f"c{i % 3}") for i in range(n)]
    return spark.createDataFrame(rows, "product_id string, category string").select(
        F.to_date(F.lit(day)).alias("dt"), "*", F.lit(1).cast("long").alias("orders_count"), F.lit(1).cast("long").alias("units_sold"),
        F.lit(1).cast("decimal(18,2)").alias("gross_revenue"), F.lit(1).cast("long").alias("unique_customers"), F.lit(None).cast("timestamp").alias("ingest_ts"),
    )


@pytest.mark.parametrize("n, folders", [(3, 1), (20, 3), (10_000, 9)])
def test_preview_opens_the_newest_days_only(spark, tmp_root, n, folders):
    for i in range(9):
        day = str(dt.date(2026, 3, 1) + dt.timedelta(days=i))
        replace_day(_gold_day(spark, day, 3 if i == 8 else 0 if i == 5 else 30).coalesce(1), L.DAILY_PRODUCT_SALES, tmp_root, day)
    out = D.preview_sales(spark, tmp_root, n)
    want = top_sales(D.read_gold(spark, tmp_root), n)
    assert out.collect() == want.collect()
    opened = {f.rsplit("/", 2)[1] for f in out.inputFiles()}
    assert len(opened) <= folders


def test_preview_of_nothing(spark, tmp_root):
    assert D.preview_sales(spark, tmp_root).collect() == []


def test_statistics_and_the_join_that_needs_no_shuffle_of_the_fact(spark, tmp_root, clean_catalog):
    landing, root = f"{tmp_root}/landing", f"{tmp_root}/house"
    days = DAYS
    _scenario(spark, landing)
    for day in days:
        D.run_day(spark, root, day, f"{day} 23:00:00", landing_root=landing, statistics=True)
    info = table_details(spark, "silver.dim_product_scd2")
    assert int(info["Statistics"].split(" bytes")[0]) > 0
    part = spark.sql(f"DESCRIBE TABLE EXTENDED silver.fact_orders PARTITION (dt=DATE'{days[0]}')").where("col_name = 'Partition Statistics'").first()[1]
    assert int(part.split(", ")[1].split(" rows")[0]) == spark.table("silver.fact_orders").where(F.col("dt") == F.to_date(F.lit(days[0]))).count()
    sales = enrich_sales(spark.table("silver.fact_orders"), spark.table("silver.dim_product_scd2").where("is_current"))
    plan = sales._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan
    analyze_columns(spark, "silver.dim_product_scd2", ["product_id"])
    column = {r[0]: r[1] for r in spark.sql("DESCRIBE TABLE EXTENDED silver.dim_product_scd2 product_id").collect()}
    assert int(column["distinct_count"]) > 0
    assert {"bronze", "silver", "gold"} <= {r[0] for r in list_databases(spark).collect()}
    assert {r["tableName"] for r in list_tables(spark, "gold").collect()} == {"daily_product_sales"}


def test_exports_overlap_and_the_second_day_lands_beside_the_first_run(spark, monkeypatch):
    first, second, done = threading.Barrier(3, timeout=60), threading.Barrier(4, timeout=60), []

    def export(df, root, entity, day):
        (first if day == A.DAY1 else second).wait()  # passes only if the others of the group run at once
        done.append(f"{entity} {day}")

    def run(spark, root, day, run_ts, **kwargs):
        if day == A.DAY1:
            second.wait()
        else:
            assert len(done) == 7
        done.append(day)

    monkeypatch.setattr(R, "export_landing", export)
    monkeypatch.setattr(R, "run_day", run)
    R._two_day_run(spark, "/root/testdata/sf0.001")
    entities = ("customers", "orders", "products")
    assert sorted(done[:3]) == [f"{e} {A.DAY1}" for e in entities]
    assert sorted(done[3:7]) == sorted([A.DAY1, *(f"{e} {A.DAY2}" for e in entities)]) and done[7] == A.DAY2
