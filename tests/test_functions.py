import datetime as dt

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from strata.functions import change_hash, parse_double, parse_int, parse_timestamp, previous_business_date
from strata.sources.paths import raw_customers_path, raw_entity_path, raw_orders_path, raw_products_path


INT_CASES = [
    ("2", 2), ("2.7", 2), ("-3.9", -3), ("2.", 2), (" 7 ", 7), ("007", 7), ("0", 0),
    ("1e2", None), ("x", None), ("", None), ("   ", None), (None, None),
    ("3000000000", None), ("-2147483648", -2147483648), (".5", 0), ("+4", 4), ("-", None), (".", 0),
    ("-.", 0), ("+", None), ("1.2.3", None), ("- 1", None), ("2147483647.9", 2147483647), ("2147483648", None),
]


def test_parse_int_legacy_cast_semantics(spark):
    df = spark.createDataFrame([(s,) for s, _ in INT_CASES], "s string")
    got = [r[0] for r in df.select(parse_int("s")).collect()]
    assert got == [e for _, e in INT_CASES]


def legacy_int(text):
    """Model of the legacy (non-ANSI) string -> int cast: trim, sign, digits,
    an optional well-formed fraction that is truncated, overflow -> null."""
    if text is None:
        return None
    t = text.strip(" ")
    if not t:
        return None
    neg = t[0] == "-"
    if t[0] in "+-":
        t = t[1:]
        if not t:
            return None
    whole, _, frac = t.partition(".")
    if not all(ch in "0123456789" for ch in whole) or not all(ch in "0123456789" for ch in frac):
        return None
    value = -int(whole or "0") if neg else int(whole or "0")
    return value if -(2**31) <= value < 2**31 else None


@settings(max_examples=80, deadline=None)
@given(st.lists(st.text(alphabet="0123456789 .+-xe", max_size=8), min_size=1, max_size=40))
def test_parse_int_matches_legacy_cast_model(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    got = [r[0] for r in df.select(parse_int("s")).collect()]
    assert got == [legacy_int(t) for t in texts]


def test_parse_double_and_timestamp_never_raise(spark):
    df = spark.createDataFrame(
        [("12.50", "2026-02-20 10:00:00"), ("x", "2026/02/20 10:00"), (" 3.5 ", "nope"), ("NaN", None), ("1e2", "")],
        "p string, t string",
    )
    rows = df.select(parse_double("p").alias("p"), parse_timestamp("t").alias("t")).collect()
    assert rows[0]["p"] == 12.5 and rows[0]["t"] == dt.datetime(2026, 2, 20, 10, 0, 0)
    assert rows[1]["p"] is None and rows[1]["t"] is None
    assert rows[2]["p"] == 3.5 and rows[2]["t"] is None
    assert rows[3]["p"] != rows[3]["p"]  # NaN is a number
    assert rows[4]["p"] == 100.0 and rows[4]["t"] is None


def test_change_hash_stable_sensitive_and_null_as_empty(spark):
    df = spark.createDataFrame(
        [("C1", "Alice", "alice@example.com", "London"), ("C2", "Bob", None, "MK"), ("C3", "Bob", "", "MK")],
        "id string, a string, b string, c string",
    )
    h = {r["id"]: r["h"] for r in df.select("id", change_hash(["a", "b", "c"]).alias("h")).collect()}
    assert len(h["C1"]) == 64
    assert h["C2"] == h["C3"]  # null and '' collide by design of the stored format
    changed = df.withColumn("c", F.when(F.col("id") == "C1", "Oxford").otherwise(F.col("c")))
    h2 = {r["id"]: r["h"] for r in changed.select("id", change_hash(["a", "b", "c"]).alias("h")).collect()}
    assert h2["C1"] != h["C1"] and h2["C2"] == h["C2"]
    import hashlib

    assert h["C1"] == hashlib.sha256(b"Alice||alice@example.com||London").hexdigest()


@pytest.mark.parametrize(
    "utc, expected",
    [
        (dt.datetime(2025, 9, 1, 12, 30, 0), dt.date(2025, 8, 31)),
        (dt.datetime(2025, 1, 1, 0, 1, 0), dt.date(2024, 12, 31)),
        (dt.datetime(2024, 10, 27, 0, 30, 0), dt.date(2024, 10, 26)),
        (dt.datetime(2025, 6, 9, 23, 5, 0), dt.date(2025, 6, 9)),  # 00:05 BST on the 10th
    ],
)
def test_previous_business_date_london(spark, utc, expected):
    df = spark.createDataFrame([(utc,)], "ts timestamp_ntz")
    got = df.select(previous_business_date("ts", source_tz="UTC")).collect()[0][0]
    assert got == expected


def test_previous_business_date_of_an_instant_ignores_session_zone(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("UTC", "America/Los_Angeles", "Asia/Tokyo"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            df = spark.sql("SELECT TIMESTAMP_LTZ '2026-07-20 23:30:00+00:00' AS ts")
            assert df.select(previous_business_date("ts")).collect()[0][0] == dt.date(2026, 7, 20)
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


WRAPPERS = {"customers": raw_customers_path, "products": raw_products_path, "orders": raw_orders_path}


@given(bucket=st.from_regex(r"[a-z][a-z0-9.-]{0,20}", fullmatch=True), day=st.dates(), file=st.from_regex(r"[a-z]{1,8}\.[a-z]{3}", fullmatch=True), entity=st.sampled_from(sorted(WRAPPERS)))
def test_landing_paths(bucket, day, file, entity):
    folders = ["s3:", "", bucket, "raw", entity, f"dt={day.isoformat()}"]
    assert raw_entity_path(bucket, entity, str(day), file).split("/") == [*folders, file]
    assert WRAPPERS[entity](bucket, str(day)).split("/") == [*folders, f"{entity}.csv"]


@pytest.mark.parametrize("day", ["2026-02-30", "20th of May", ""])
def test_landing_paths_need_a_date(day):
    with pytest.raises(ValueError):
        raw_orders_path("b", day)


def test_checkpoint_root_prefers_cluster_setting_and_falls_back_once():
    from strata.config import checkpoint_root, scratch_path

    class Conf:
        def __init__(self, value):
            self.value = value

        def get(self, key, default=None):
            return self.value if key == "spark.checkpoint.dir" else default

    class Context:
        def __init__(self, master="local[2]"):
            self.dir, self.master = None, master

        def getCheckpointDir(self):
            return self.dir

        def setCheckpointDir(self, d):
            self.dir = "file:" + d + "/uuid"

    class Session:
        def __init__(self, value, master="local[2]"):
            self.conf, self.sparkContext = Conf(value), Context(master)

    shared = Session("hdfs://nn/shared/ckpt/")
    assert checkpoint_root(shared) == "hdfs://nn/shared/ckpt"
    assert scratch_path(shared, "x").startswith("hdfs://nn/shared/ckpt/strata-x-")
    assert shared.sparkContext.dir is None  # the cluster's setting is not touched
    local = Session(None)
    first = checkpoint_root(local)
    assert first.startswith("file:/") and checkpoint_root(local) == first
    with pytest.raises(ValueError, match="shared storage"):
        checkpoint_root(Session(None, master="yarn"))  # never a driver-local folder on a cluster


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="0123456789 .+-xe\t", max_size=10), min_size=1, max_size=40))
def test_parse_int_equals_spark_legacy_cast(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    ours = [r[0] for r in df.select(parse_int("s")).collect()]
    old = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        legacy = [r[0] for r in df.select(F.col("s").cast("int")).collect()]
    finally:
        spark.conf.set("spark.sql.ansi.enabled", old)
    assert ours == legacy, [(t, a, b) for t, a, b in zip(texts, ours, legacy) if a != b]


@settings(max_examples=40, deadline=None)
@given(
    st.lists(st.text(alphabet="0123456789 .+-eEaNIfnity", max_size=10), min_size=1, max_size=30),
    st.lists(st.one_of(
        st.datetimes(min_value=dt.datetime(1900, 1, 1), max_value=dt.datetime(2100, 1, 1)).map(lambda d: d.strftime("%Y-%m-%d %H:%M:%S")),
        st.text(alphabet="0123456789-: /", max_size=20),
    ), min_size=1, max_size=30),
)
def test_parse_double_and_timestamp_equal_spark_legacy(spark, numbers, stamps):
    n = max(len(numbers), len(stamps))
    rows = [(numbers[i % len(numbers)], stamps[i % len(stamps)]) for i in range(n)]
    df = spark.createDataFrame(rows, "p string, t string")
    ours = df.select(parse_double("p").alias("p"), parse_timestamp("t").alias("t")).collect()
    old = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        legacy = df.select(F.col("p").cast("double").alias("p"),
                           F.to_timestamp("t", "yyyy-MM-dd HH:mm:ss").alias("t")).collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", old)

    def same(a, b):
        return a == b or (isinstance(a, float) and isinstance(b, float) and a != a and b != b)

    assert all(same(a["p"], b["p"]) and a["t"] == b["t"] for a, b in zip(ours, legacy)), (rows, ours, legacy)
