"""Plan-shape checks: the properties the design relies on at scale."""

import os
import re

import pytest
from pyspark.sql import functions as F

from strata.operators import build_daily_product_sales, latest_per_key, scd2_apply, scd2_plan
from strata.plans import registry as R
from strata.sinks import layout as L
from strata.sinks.writers import replace_day, write_dimension
from strata.sources.tables import read_closed, read_current, read_day

SF = "/root/testdata/sf0.001"


def plan_text(df, capsys, mode="formatted"):
    capsys.readouterr()
    df.explain(mode)
    return capsys.readouterr().out


def test_latest_per_key_limits_before_the_shuffle(spark, capsys):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), F.col("id").alias("v"))
    text = plan_text(latest_per_key(df, "k", ["v"]), capsys, "simple")
    lines = [ln.strip(" :+-") for ln in text.splitlines()]
    exchange = next(i for i, ln in enumerate(lines) if ln.startswith("Exchange hashpartitioning(k"))
    # a WindowGroupLimit sits below (after, in print order) the exchange: map-side cut
    assert any(ln.startswith("WindowGroupLimit") for ln in lines[exchange + 1:])


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")
def test_scans_are_pruned(spark, capsys):
    text = plan_text(R.fact_all_days(spark, SF), capsys)
    read = [ln for ln in text.splitlines() if ln.startswith("ReadSchema") and "l_orderkey" in ln][0]
    assert "l_comment" not in read and "l_extendedprice" not in read and "l_suppkey" not in read


def _fact_day(spark, day):
    return spark.createDataFrame(
        [("O1", None, "C1", "P1", 1, 1.0, None, day, None)],
        "order_id string, order_ts timestamp, customer_id string, product_id string, quantity int, "
        "unit_price double, order_amount decimal(18,2), dt string, ingest_ts timestamp",
    ).withColumn("dt", F.to_date("dt")).coalesce(1)


def listed(df):
    """Files that the scans of a plan discovered."""
    node = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    return sum(node.apply(i).relation().location().inputFiles().__len__() for i in range(node.size()))


def test_day_scan_lists_only_its_day(spark, tmp_root):
    found = []
    for n in (1, 5, 20):
        for i in range(n):
            day = f"2026-03-{i + 1:02d}"
            replace_day(_fact_day(spark, day), L.FACT_ORDERS, tmp_root, day)
        df = read_day(spark, L.FACT_ORDERS, tmp_root, "2026-03-01")
        found.append(listed(df))
        assert df.count() == 1 and str(df.first()["dt"]) == "2026-03-01"
    assert found == [1, 1, 1]
    assert read_day(spark, L.FACT_ORDERS, tmp_root, "2026-04-01").count() == 0  # no folder: no rows


def test_current_and_closed_scans_list_only_their_folder(spark, tmp_root):
    for day in ("2026-02-20", "2026-02-21", "2026-02-22"):
        dim = spark.createDataFrame(
            [("P1", "n", "c", 1.0, "h", None, None, True, None), ("P1", "n", "b", 1.0, "g", None, None, False, None)], L.DIM_PRODUCT.schema
        ).coalesce(1)
        write_dimension(spark, L.DIM_PRODUCT, tmp_root, dim, None, day)
    current = read_current(spark, L.DIM_PRODUCT, tmp_root)
    closed = read_closed(spark, L.DIM_PRODUCT, tmp_root, "2026-02-21")
    assert listed(current) == listed(closed) == 1
    assert [r["is_current"] for r in current.collect()] == [True] and [r["is_current"] for r in closed.collect()] == [False]
    assert read_closed(spark, L.DIM_PRODUCT, tmp_root, "2026-03-01").count() == 0


def test_gold_joins_the_aggregate_not_the_fact(spark, capsys):
    fact = spark.range(10000).select(
        F.date_add(F.to_date(F.lit("2026-02-20")), (F.col("id") % 2).cast("int")).alias("dt"),
        F.col("id").cast("string").alias("order_id"),
        (F.col("id") % 7).cast("string").alias("customer_id"), (F.col("id") % 5).cast("string").alias("product_id"),
        F.lit(1).alias("quantity"), F.lit(1).cast("decimal(18,2)").alias("order_amount"),
    )
    dim = spark.range(5).select(F.col("id").cast("string").alias("product_id"), F.lit("c").alias("category"))
    text = plan_text(build_daily_product_sales(fact, dim), capsys, "simple")
    join_line = next(ln for ln in text.splitlines() if "Join" in ln)
    below = text[text.index(join_line):]
    above = text[: text.index(join_line)]
    # the fact side reaches the join only through the per-(dt, product) aggregate
    assert "HashAggregate(keys=[dt" in below and "Expand" in below
    # folding dimension copies in needs no second shuffle
    assert "Exchange" not in above


def _nodes(df, capsys):
    lines = [ln.lstrip(" :+-*()0123456789") for ln in plan_text(df, capsys, "simple").splitlines()]
    return {n: sum(bool(re.match(n, ln)) for ln in lines) for n in ("Exchange", "FileScan", r"\w*Join", "Sort ", "Window ")}


def _stored(spark, root, days):
    """A stored dimension and staged days, so that scans are file scans."""
    dim = spark.createDataFrame([("C1", "a", "a@x", "L", "h", None, None, True, None)], L.DIM_CUSTOMER.schema)
    write_dimension(spark, L.DIM_CUSTOMER, root, dim, None, "2026-02-20")
    stages = []
    for i in range(days):
        path = f"{root}/stage{i}"
        schema = "customer_id string, full_name string, email string, city string, updated_at timestamp, ingest_ts timestamp"
        spark.createDataFrame([("C1", "a", "a@x", f"M{i}", None, None)], schema).write.parquet(path)
        stages.append(spark.read.parquet(path))
    return read_current(spark, L.DIM_CUSTOMER, root), stages


SPEC = ("customer_id", ["full_name", "email", "city"], ["updated_at", "ingest_ts"])


def test_scd2_merge_scans_once_shuffles_twice_and_joins_nothing(spark, capsys, tmp_root):
    current, (stg,) = _stored(spark, tmp_root, 1)
    n = _nodes(scd2_plan(current, stg, *SPEC).current_and_closed(), capsys)
    assert n["Exchange"] == 2 and n["FileScan"] == 2 and n[r"\w*Join"] == 0, n


def test_scd2_plan_grows_linearly_with_the_days(spark, capsys, tmp_root):
    dim, stages = _stored(spark, tmp_root, 4)
    seen = []
    for stg in stages:
        dim = scd2_apply(dim, stg, *SPEC)
        seen.append(_nodes(dim, capsys))
    for kind in ("Exchange", "FileScan", "Window "):
        steps = [b[kind] - a[kind] for a, b in zip(seen, seen[1:])]
        assert len(set(steps)) == 1 and steps[0] <= 3, (kind, seen)
