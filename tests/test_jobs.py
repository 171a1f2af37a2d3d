import os

import pytest

from strata.jobs import run
from strata.sinks import layout as L
from strata.sinks.writers import export_landing
from strata.sources import read_table
from strata.sources.landing import RAW_COLUMNS


def test_step_jobs_equal_run_day(spark, tmp_root, clean_catalog):
    landing = os.path.join(tmp_root, "landing")
    day = "2026-02-20"
    rows = {
        "customers": [("C1", "Alice", "a@x", "London", f"{day} 09:00:00")],
        "products": [("P1", "Prod", "Books", "2.50", f"{day} 09:00:00")],
        "orders": [("O1", f"{day} 09:00:00", "C1", "P1", "2", "2.50"), ("O2", f"{day} 10:00:00", "C1", "P9", "1", "1.00")],
    }
    for entity, data in rows.items():
        export_landing(spark.createDataFrame(data, list(RAW_COLUMNS[entity])), landing, entity, day)
    stepwise, whole = os.path.join(tmp_root, "steps"), os.path.join(tmp_root, "whole")
    common = ["--root", stepwise, "--dt", day, "--run-ts", "2026-02-21 06:00:00"]
    for entity in ("customers", "products", "orders"):
        run(["bronze", *common, "--entity", entity, "--landing-root", landing], spark)
    for entity in ("customers", "products"):
        run(["dim", *common, "--entity", entity], spark)
    run(["fact", *common], spark)
    run(["gold", *common], spark)
    run(["run-day", "--root", whole, "--dt", day, "--run-ts", "2026-02-21 06:00:00", "--landing-root", landing], spark)
    for spec in (L.DIM_CUSTOMER, L.DIM_PRODUCT, L.FACT_ORDERS, L.DAILY_PRODUCT_SALES):
        a = sorted(map(repr, read_table(spark, spec, stepwise).collect()))
        b = sorted(map(repr, read_table(spark, spec, whole).collect()))
        assert a == b and a, spec.name
    gold = {r["product_id"]: r["category"] for r in read_table(spark, L.DAILY_PRODUCT_SALES, whole).collect()}
    assert gold == {"P1": "Books", "P9": None}


def test_bad_arguments_are_rejected():
    with pytest.raises(SystemExit):
        run(["dim", "--root", "/x", "--entity", "orders"])
    with pytest.raises(ValueError):
        run(["fact", "--root", "/x", "--dt", "2026-13-01"])
