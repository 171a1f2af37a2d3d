"""Adapters: the driver's TPC-H-like tables seen as the lakehouse's raw
landing snapshots (all text, as the upstream CSV files are).

* orders  = lineitem ⟕ orders ⟕ part.  ``order_id = l_orderkey-l_linenumber``
  (repeats, so de-duplication is exercised), ``customer_id = o_custkey``,
  ``product_id = l_partkey``, ``quantity = l_quantity``, ``unit_price =
  p_retailprice``, ``order_ts = l_shipdate``, business day ``dt`` = first day
  of the ship month (daily groups would be near-singletons).
* customers (two daily snapshots) = customer ⟕ nation.  ``city`` is the
  market segment; customers with a negative balance first appear on day 2,
  those with a balance of 9000 or more are missing from day 2, and those with
  a balance in [0, 1000) relocate on day 2 to their nation (a second, later
  record the same day, so "latest per key" has work to do).  Day 3 repeats
  day 1's snapshot: relocations change back, missing keys return, keys new on
  day 2 are absent.
* products (two daily snapshots) = part.  ``category`` is the part type;
  sizes 46-50 appear on day 2, sizes 1-2 only on day 1; Brand#1 moves to
  category CLEARANCE on day 2, and day 3 repeats day 1.  For the sales
  queries and the daily runs size 50 never lands, so that some sales have no
  dimension row.
* dirty variants wrap text in spaces, upper-case emails, blank or null some
  keys, and break some numbers and timestamps, chosen by data attributes.

Every adapter reads whole tables; each query's work grows with them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the two-day scenario.
DAY1, DAY2, DAY3 = "2026-02-20", "2026-02-21", "2026-02-22"
RUN1, RUN2, RUN3 = "2026-02-21 06:00:00", "2026-02-22 06:00:00", "2026-02-23 06:00:00"
PIPELINE_SPLIT = "1998-07-01"  # orders shipped in earlier months land on DAY1


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _s(c: str | Column) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def _pad(c: Column, left: str = "  ", right: str = " ") -> Column:
    return F.concat(F.lit(left), c, F.lit(right))


def raw_orders(spark: SparkSession, sf_dir: str, dirty: bool = False) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_shipdate",
        "l_returnflag", "l_linestatus", "l_tax", "l_discount",
    )
    od = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    pt = table(spark, sf_dir, "part").select("p_partkey", _s("p_retailprice").alias("unit_price"))  # rendered once a part
    j = li.join(od, li.l_orderkey == od.o_orderkey, "left").join(pt, li.l_partkey == pt.p_partkey, "left")

    order_id = F.concat_ws("-", _s("l_orderkey"), _s("l_linenumber"))
    order_ts = F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss")
    customer_id = _s("o_custkey")
    product_id = _s("l_partkey")
    quantity = _s(F.col("l_quantity").cast("int"))
    unit_price = F.col("unit_price")
    if dirty:
        ln, rf, ls = F.col("l_linenumber"), F.col("l_returnflag"), F.col("l_linestatus")
        tax, disc = F.col("l_tax"), F.col("l_discount")
        opened = ls == "O"
        order_id = (
            F.when((rf == "R") & (ln == 7), F.lit(""))
            .when((rf == "A") & (ln == 7), F.lit(None).cast("string"))
            .when((rf == "N") & (ln == 7), F.lit("   "))
            .when(opened, _pad(order_id))
            .otherwise(order_id)
        )
        quantity = (
            F.when((ln == 1) & (disc == F.lit(0.0)), F.lit("0"))
            .when((ln == 2) & (tax == F.lit(0.08)), F.lit("x"))
            .when((ln == 3) & (tax == F.lit(0.0)), F.lit(None).cast("string"))
            .when((ln == 4) & (rf == "N"), F.concat(quantity, F.lit(".0")))
            .when((ln == 5) & (disc == F.lit(0.1)), F.concat(F.lit("-"), quantity))
            .when(ls == "F", _pad(quantity, " ", " "))
            .otherwise(quantity)
        )
        unit_price = F.when((ln == 6) & (tax == F.lit(0.01)), F.lit("n/a")).otherwise(unit_price)
        order_ts = F.when((ln == 6) & (rf == "A"), F.date_format("l_shipdate", "yyyy/MM/dd HH:mm:ss")).otherwise(order_ts)
        customer_id = F.when(opened, _pad(customer_id)).otherwise(customer_id)
        product_id = F.when(opened, _pad(product_id, " ", "  ")).otherwise(product_id)
    return j.select(
        order_id.alias("order_id"),
        order_ts.alias("order_ts"),
        customer_id.alias("customer_id"),
        product_id.alias("product_id"),
        quantity.alias("quantity"),
        unit_price.alias("unit_price"),
        F.trunc(F.to_date("l_shipdate"), "month").alias("dt"),
    )


def _customer_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return c.join(n, c.c_nationkey == n.n_nationkey, "left")


def _email() -> Column:
    return F.concat(F.lower(F.replace(F.col("c_name"), F.lit("#"), F.lit("."))), F.lit("@example.com"))


def _customer_rows(df: DataFrame, city: Column, updated_at: str) -> DataFrame:
    return df.select(
        _s("c_custkey").alias("customer_id"),
        F.col("c_name").alias("full_name"),
        _email().alias("email"),
        city.alias("city"),
        F.lit(updated_at).alias("updated_at"),
    )


def raw_customers(spark: SparkSession, sf_dir: str, day: str) -> DataFrame:
    """Day 1 and day 3 carry the same snapshot (day 3 reverts day 2)."""
    base = _customer_base(spark, sf_dir)
    bal = F.col("c_acctbal")
    if day in (DAY1, DAY3):
        return _customer_rows(base.where(bal >= 0), F.col("c_mktsegment"), f"{day} 08:00:00")
    snapshot = _customer_rows(base.where(bal < 9000), F.col("c_mktsegment"), f"{DAY2} 08:00:00")
    moved = _customer_rows(base.where((bal >= 0) & (bal < 1000)), F.col("n_name"), f"{DAY2} 17:30:00")
    return snapshot.unionByName(moved)


def raw_customers_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = _customer_base(spark, sf_dir)
    bal, seg = F.col("c_acctbal"), F.col("c_mktsegment")
    neg = bal < 0
    key = _s("c_custkey")
    return base.select(
        F.when(neg & (seg == "AUTOMOBILE"), F.lit(""))
        .when(neg & (seg == "FURNITURE"), F.lit(None).cast("string"))
        .when(neg & (seg == "HOUSEHOLD"), F.lit("  "))
        .otherwise(_pad(key, " ", "  "))
        .alias("customer_id"),
        _pad(F.col("c_name")).alias("full_name"),
        F.when(seg == "MACHINERY", _pad(F.upper(_email()), " ", " ")).otherwise(_email()).alias("email"),
        F.concat(F.lit(" "), seg).alias("city"),
        F.when(bal >= 9000, F.lit("2026/02/20 08:00:00"))
        .when((seg == "BUILDING") & (bal < 500), F.lit(None).cast("string"))
        .otherwise(F.lit(f"{DAY1} 08:00:00"))
        .alias("updated_at"),
    )


def _product_rows(df: DataFrame, category: Column, updated_at: str) -> DataFrame:
    return df.select(
        _s("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        category.alias("category"),
        _s("p_retailprice").alias("list_price"),
        F.lit(updated_at).alias("updated_at"),
    )


def raw_products(spark: SparkSession, sf_dir: str, day: str, withheld: bool = False) -> DataFrame:
    """Day 1 and day 3 carry the same snapshot.  ``withheld`` keeps the largest
    size out on every day: a product master that lags its sales."""
    p = table(spark, sf_dir, "part")
    size = F.col("p_size")
    if day in (DAY1, DAY3):
        return _product_rows(p.where(size <= 45), F.col("p_type"), f"{day} 08:00:00")
    category = F.when(F.col("p_brand") == "Brand#1", F.lit("CLEARANCE")).otherwise(F.col("p_type"))
    landed = (size >= 3) & (size <= 49) if withheld else size >= 3
    return _product_rows(p.where(landed), category, f"{DAY2} 08:00:00")


def staged_suppliers(spark: SparkSession, sf_dir: str, day: str, run_ts: str) -> DataFrame:
    """A staged supplier snapshot: suppliers with a negative balance first
    appear on day 2, those with a balance of 9000 or more are missing from it,
    those with a balance in [0, 1000) move to the next nation on it."""
    s = table(spark, sf_dir, "supplier")
    bal, nation = F.col("s_acctbal"), F.col("s_nationkey").cast("int")
    s = s.where(bal >= 0) if day == DAY1 else s.where(bal < 9000)
    moved = F.when((bal >= 0) & (bal < 1000), nation + 1).otherwise(nation) if day == DAY2 else nation
    return s.select(
        _s("s_suppkey").alias("supplier_id"), F.col("s_name").alias("name"), moved.alias("nation"),
        F.to_timestamp(F.lit(f"{day} 08:00:00")).alias("updated_at"), F.to_date(F.lit(day)).alias("dt"),
        F.to_timestamp(F.lit(run_ts)).alias("ingest_ts"),
    )


def raw_products_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    size, typ = F.col("p_size"), F.col("p_type")
    price = _s("p_retailprice")
    return p.select(
        F.when((size == 50) & (typ == "SMALL"), F.lit("")).otherwise(_pad(_s("p_partkey"))).alias("product_id"),
        _pad(F.col("p_name"), " ", " ").alias("product_name"),
        _pad(typ, "", "  ").alias("category"),
        F.when(size == 1, F.lit("n/a")).when(typ == "PROMO", _pad(price, " ", " ")).otherwise(price).alias("list_price"),
        F.when(size == 2, F.lit("yesterday")).otherwise(F.lit(f"{DAY1} 08:00:00")).alias("updated_at"),
    )
