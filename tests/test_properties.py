"""Property tests against plain-Python models."""

import datetime as dt
from collections import defaultdict
from decimal import ROUND_HALF_UP, Decimal

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from strata.operators import build_daily_product_sales, latest_per_key

small = st.one_of(st.none(), st.integers(0, 3))


def _desc_nulls_last_key(values):
    # larger first, nulls after every value
    return tuple((v is None, -(v if v is not None else 0)) for v in values)


@settings(max_examples=40, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["a", "b", "c", None]), small, small, small), max_size=25))
def test_latest_per_key_matches_model(spark, rows):
    df = spark.createDataFrame(rows, "k string, o1 int, o2 int, v int")
    got = sorted(map(tuple, latest_per_key(df, "k", ["o1", "o2"]).collect()), key=repr)
    groups = defaultdict(list)
    for r in rows:
        groups[r[0]].append(r)
    want = sorted((min(g, key=lambda r: _desc_nulls_last_key(r[1:])) for g in groups.values()), key=repr)
    assert got == want


def _round2(x: Decimal) -> Decimal:
    return x.quantize(Decimal("0.01"), rounding=ROUND_HALF_UP)


@settings(max_examples=30, deadline=None)
@given(
    st.lists(
        st.tuples(
            st.sampled_from([0, 1]),
            st.sampled_from(["O1", "O2", "O3", "O4", None]),
            st.sampled_from(["C1", "C2", None]),
            st.sampled_from(["P1", "P2", "P3", None]),
            st.integers(1, 9),
            st.one_of(st.none(), st.integers(0, 99999).map(lambda c: Decimal(c) / 1000)),
        ),
        max_size=30,
    ),
    st.lists(st.tuples(st.sampled_from(["P1", "P2", None]), st.sampled_from(["x", "y", None])), max_size=4),
)
def test_gold_matches_model(spark, facts, dims):
    base = dt.date(2026, 2, 20)
    fact = spark.createDataFrame(
        [(base + dt.timedelta(days=d), o, c, p, q, a) for d, o, c, p, q, a in facts],
        "dt date, order_id string, customer_id string, product_id string, quantity int, order_amount decimal(18,3)",
    )
    dim = spark.createDataFrame(dims, "product_id string, category string")
    got = sorted(
        (tuple(r) for r in build_daily_product_sales(fact, dim)
         .select("dt", "product_id", "category", "orders_count", "units_sold", "gross_revenue", "unique_customers")
         .collect()),
        key=repr,
    )
    # model: left join on product_id (null never matches), then group by (dt, product_id, category)
    groups = defaultdict(list)
    for d, o, c, p, q, a in facts:
        matches = [cat for pid, cat in dims if p is not None and pid == p] or [None]
        for cat in matches:
            groups[(base + dt.timedelta(days=d), p, cat)].append((o, c, q, a))
    want = []
    for (d, p, cat), rows in groups.items():
        amounts = [a for _, _, _, a in rows if a is not None]
        want.append((
            d, p, cat,
            len({o for o, _, _, _ in rows if o is not None}),
            sum(q for _, _, q, _ in rows),
            _round2(sum(amounts, Decimal(0))) if amounts else None,
            len({c for _, c, _, _ in rows if c is not None}),
        ))
    assert got == sorted(want, key=repr)
