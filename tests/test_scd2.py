import datetime as dt

from pyspark.sql import functions as F

from strata.operators import scd2_apply, scd2_plan, split_dimension
from strata.schemas import DIM_CUSTOMER

KEY, TRACKED, ORDER = "customer_id", ["full_name", "email", "city"], ["updated_at", "ingest_ts"]
T = dt.datetime


def stg(spark, rows, day):
    """rows: (id, name, email, city, updated_at-hour)"""
    data = [(k, n, e, c, None if h is None else T(2026, 2, day, h), T(2026, 2, day, 23)) for k, n, e, c, h in rows]
    return spark.createDataFrame(
        data, "customer_id string, full_name string, email string, city string, updated_at timestamp, ingest_ts timestamp"
    )


def run(dim, stage, day):  # dim=None: first load
    return scd2_apply(dim, stage, KEY, TRACKED, ORDER, f"2026-02-{day + 1:02d} 06:00:00")


def versions(dim):
    return sorted(
        (r["customer_id"], r["city"], r["is_current"], r["effective_from_ts"], r["effective_to_ts"]) for r in dim.collect()
    )


def empty(spark):
    return spark.createDataFrame([], DIM_CUSTOMER)


def test_fixture_change_expires_and_inserts(spark):
    target = spark.createDataFrame(
        [("C1", "Alice", "alice@example.com", "London", "hash_old", T(2026, 2, 19), None, True, T(2026, 2, 19))],
        DIM_CUSTOMER,
    )
    plan = scd2_plan(target, stg(spark, [("C1", "Alice", "alice@example.com", "Oxford", 10)], 20), KEY, TRACKED, ORDER,
                     "2026-02-21 06:00:00")
    assert plan.inserted.count() == 1 and plan.expired.count() == 1 and plan.unchanged.count() == 0
    e = plan.expired.collect()[0]
    i = plan.inserted.collect()[0]
    assert e["is_current"] is False and e["effective_to_ts"] == i["effective_from_ts"] == T(2026, 2, 21, 6)
    assert i["city"] == "Oxford" and i["is_current"] is True and i["effective_to_ts"] is None


def test_three_days_new_unchanged_changed_back_absent(spark):
    d1 = run(empty(spark), stg(spark, [("A", "a", "a@x", "L", 8), ("B", "b", "b@x", "L", 8), ("C", "c", "c@x", "L", 8)], 20), 20)
    # day 2: A unchanged, B changes (latest of two records wins), C absent, D new
    d2 = run(d1, stg(spark, [("A", "a", "a@x", "L", 8), ("B", "b", "b@x", "M", 9), ("B", "b", "b@x", "Z", 7),
                             ("D", "d", "d@x", "L", 8)], 21), 21)
    # day 3: B changes back
    d3 = run(d2, stg(spark, [("A", "a", "a@x", "L", 8), ("B", "b", "b@x", "L", 8), ("D", "d", "d@x", "L", 8)], 22), 22)
    rows = versions(d3)
    r1, r2, r3 = T(2026, 2, 21, 6), T(2026, 2, 22, 6), T(2026, 2, 23, 6)
    assert rows == sorted([
        ("A", "L", True, r1, None),
        ("B", "L", False, r1, r2), ("B", "M", False, r2, r3), ("B", "L", True, r3, None),
        ("C", "L", True, r1, None),
        ("D", "L", True, r2, None),
    ])
    # unchanged rows keep their original ingest_ts
    a = d3.where("customer_id = 'A'").collect()[0]
    assert a["ingest_ts"] == T(2026, 2, 20, 23)


def test_same_day_rerun_is_a_no_op(spark):
    s = stg(spark, [("A", "a", "a@x", "L", 8), ("B", "b", "b@x", "M", 8)], 20)
    d1 = run(empty(spark), s, 20)
    d1b = run(d1, s, 20)
    assert versions(d1) == versions(d1b)


def test_null_stored_hash_blocks_insert_and_two_current_rows(spark):
    now = T(2026, 2, 19)
    target = spark.createDataFrame(
        [
            ("N", "n", "n@x", "L", None, now, None, True, now),          # null hash: untouched, blocks insert
            ("D", "d", "d@x", "L", "h1", now, None, True, now),          # two current rows, both differ
            ("D", "d", "d@x", "K", "h2", now, None, True, now),
            ("E", "e", "e@x", "L", "h3", now, None, True, now),          # two current rows, one equal
            ("E", "e", "e@x", "L", None, now, None, True, now),
            ("H", "h", "h@x", "L", "h4", now, now, False, now),           # history is never touched
        ],
        DIM_CUSTOMER,
    )
    from strata.functions import change_hash

    e_hash = spark.range(1).select(change_hash([F.lit("e"), F.lit("e@x"), F.lit("L")])).collect()[0][0]
    target = target.withColumn("hash_diff", F.when(F.col("hash_diff") == "h3", F.lit(e_hash)).otherwise(F.col("hash_diff")))
    s = stg(spark, [("N", "n", "n@x", "Q", 8), ("D", "d", "d@x", "Q", 8), ("E", "e", "e@x", "L", 8), ("H", "h", "h@x", "Q", 8)], 20)
    plan = scd2_plan(split_dimension(target)[0], s, KEY, TRACKED, ORDER, "2026-02-21 06:00:00")
    assert sorted(r[KEY] for r in plan.expired.collect()) == ["D", "D"]
    assert sorted(r[KEY] for r in plan.inserted.collect()) == ["D", "H"]
    assert sorted(r[KEY] for r in plan.unchanged.collect()) == ["E", "E", "N"]
    full = scd2_apply(target, s, KEY, TRACKED, ORDER, "2026-02-21 06:00:00")
    assert full.count() == 6 + 2
    assert full.where("customer_id = 'H' AND NOT is_current").count() == 1


def test_null_source_key_is_always_inserted(spark):
    s = stg(spark, [(None, "x", "x@x", "L", 8)], 20)
    d1 = run(empty(spark), s, 20)
    d2 = run(d1, stg(spark, [(None, "x", "x@x", "L", 8)], 21), 21)
    assert d2.where(F.col("customer_id").isNull() & F.col("is_current")).count() == 2


def test_invariants_one_current_row_and_ordered_effective_times(spark):
    d = empty(spark)
    for day, city in ((20, "L"), (21, "M"), (22, "M"), (23, "L")):
        d = run(d, stg(spark, [("A", "a", "a@x", city, 8), ("B", "b", "b@x", "L", 8)], day), day)
    assert d.where("is_current").groupBy(KEY).count().where("count > 1").count() == 0
    assert d.where("NOT is_current AND NOT (effective_from_ts < effective_to_ts)").count() == 0
    assert d.where("customer_id = 'A'").count() == 3


def test_first_load_without_target_equals_load_into_empty_target(spark):
    s = stg(spark, [("A", "a", "a@x", "L", 8), ("B", "b", "b@x", "M", 8), ("A", "a", "a@x", "Z", 7)], 20)
    assert versions(run(None, s, 20)) == versions(run(empty(spark), s, 20))
