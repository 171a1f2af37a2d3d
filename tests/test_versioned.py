"""Versioned dimensions: parts touched, switches, and runs that break off."""

import random
import uuid

import pytest
from pyspark.sql import functions as F

from strata.operators import scd2_apply
from strata.plans.catalog import table_details
from strata.plans.daily import scd2_merge
from strata.sinks import versioned as V

STAGED = "customer_id string, city string, updated_at timestamp, ingest_ts timestamp"
DAYS = [f"2026-03-0{d}" for d in range(1, 6)]


@pytest.fixture()
def name(spark, tmp_root):
    ns = f"t{uuid.uuid4().hex[:10]}"
    table = f"{ns}_silver.dim_place"
    V.create_versioned_dimension(spark, table, spark.createDataFrame([], "customer_id string, city string").schema, "customer_id", tmp_root, 4)
    yield table
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    spark.sql(f"DROP DATABASE IF EXISTS {ns}_silver")


def staged(spark, rows, day):
    made = spark.createDataFrame(rows, "customer_id string, city string")
    at = F.to_timestamp(F.lit(f"{day} 08:00:00"))
    return made.select("*", at.alias("updated_at"), at.alias("ingest_ts"))


def merge(spark, name, rows, day):
    scd2_merge(spark, staged(spark, rows, day), name, "customer_id", ["city"], ["updated_at"], dt=day, run_ts=f"{day} 12:00:00")


def canon(df):
    return sorted(map(str, df.select("customer_id", "city", "hash_diff", "effective_from_ts", "effective_to_ts", "is_current", "ingest_ts").collect()))


def model(spark, snapshots):
    dim = None
    for rows, day in snapshots:
        dim = scd2_apply(dim, staged(spark, rows, day), "customer_id", ["city"], ["updated_at"], f"{day} 12:00:00")
    return canon(dim)


def locations(spark, name):
    out = {}
    for p in (r["partition"] for r in spark.sql(f"SHOW PARTITIONS {name}").collect()):
        rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name} PARTITION {V._literal(p)}").where("col_name = 'Location'").collect()
        out[p] = rows[0]["data_type"]
    return out


def test_random_days_equal_the_plain_merge(spark, name):
    rng, past = random.Random(8), []
    for day in DAYS[:4]:
        rows = [(f"K{k}", rng.choice(["L", "M", None])) for k in rng.sample(range(12), 7)]
        past.append((rows, day))
        merge(spark, name, rows, day)
    merge(spark, name, *past[-1])  # the day again
    assert canon(V.read_dimension(spark, name)) == model(spark, past)


def test_one_changed_key_rewrites_one_part(spark, name):
    first = [(f"K{k}", "L") for k in range(40)]
    merge(spark, name, first, DAYS[0])
    before = locations(spark, name)
    changed = [("K7", "M") if k == "K7" else (k, c) for k, c in first]
    merge(spark, name, changed, DAYS[1])
    after = locations(spark, name)
    part = spark.createDataFrame([("K7",)], "k string").select(V.part_of("k", 4)).first()[0]
    moved = {p for p in after if before.get(p) != after[p]}
    assert moved == {f"is_current=true/closed_dt=9999-12-31/key_part={part}", f"is_current=false/closed_dt={DAYS[1]}/key_part={part}"}
    read = {f.rsplit("/versions/", 1)[1].split("/")[0] for f in spark.table(name).where("is_current").inputFiles()}
    assert read == {"v000000001", "v000000002"}
    assert canon(V.read_dimension(spark, name)) == model(spark, [(first, DAYS[0]), (changed, DAYS[1])])
    merge(spark, name, changed, DAYS[2])  # nothing new: nothing written
    assert len(V.versions(spark, table_details(spark, name)["Location"])) == 2


def test_a_run_killed_before_the_switch_leaves_the_old_rows(spark, name, monkeypatch):
    first, second = [("A", "L"), ("B", "L")], [("A", "M"), ("C", "L")]
    merge(spark, name, first, DAYS[0])
    old = canon(V.read_dimension(spark, name))
    with monkeypatch.context() as m:
        m.setattr(V, "switch", lambda *a: (_ for _ in ()).throw(RuntimeError("killed")))
        with pytest.raises(RuntimeError, match="killed"):
            merge(spark, name, second, DAYS[1])
    spark.catalog.refreshTable(name)
    assert canon(V.read_dimension(spark, name)) == old == model(spark, [(first, DAYS[0])])
    assert len(V.unused_versions(spark, name)) == 1 and not V.recover(spark, name)
    merge(spark, name, second, DAYS[1])
    assert canon(V.read_dimension(spark, name)) == model(spark, [(first, DAYS[0]), (second, DAYS[1])])


@pytest.mark.parametrize("after", [1, 3])
def test_a_run_killed_among_its_switches_is_finished_by_the_next(spark, name, monkeypatch, after):
    first = [(f"K{k}", "L") for k in range(20)]
    second = [(k, "M") for k, _ in first]
    third = [("K1", "N")]
    merge(spark, name, first, DAYS[0])
    real = V.switch

    def some(spark, name, folder, partitions):
        real(spark, name, folder, partitions[:after])
        raise RuntimeError("killed")

    with monkeypatch.context() as m:
        m.setattr(V, "switch", some)
        with pytest.raises(RuntimeError, match="killed"):
            merge(spark, name, second, DAYS[1])
    merge(spark, name, third, DAYS[2])
    assert canon(V.read_dimension(spark, name)) == model(spark, [(first, DAYS[0]), (second, DAYS[1]), (third, DAYS[2])])


def test_parts_are_fixed_with_the_table(spark, name):
    root = table_details(spark, name)["Location"].rsplit("/", 2)[0]
    schema = spark.createDataFrame([], "customer_id string, city string").schema
    V.create_versioned_dimension(spark, name, schema, "customer_id", root, 4)
    with pytest.raises(ValueError, match="key parts"):
        V.create_versioned_dimension(spark, name, schema, "customer_id", root, 8)
