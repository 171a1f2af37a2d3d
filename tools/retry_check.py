"""Task-loss check: the first attempt of every map task upstream of the
de-duplication and gold shuffles fails; Spark retries it (local[4,4] allows
4 attempts).  The retried result must equal a run without failures, which
holds because every stage is deterministic (total sort orders for winners,
sorted round-robin, no wall-clock or random values).
Usage: python tools/retry_check.py [sf_dir]"""

from __future__ import annotations

import json
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark import TaskContext  # noqa: E402

from strata.config import build_session  # noqa: E402
from strata.operators import build_daily_product_sales, standardize_orders, transform_fact_orders  # noqa: E402
from strata.plans import adapters as A  # noqa: E402
from strata.plans.registry import current_products  # noqa: E402


def fail_first_attempt(batches):
    ctx = TaskContext.get()
    for i, batch in enumerate(batches):
        if ctx.attemptNumber() == 0 and i == 0 and batch.num_rows:
            raise RuntimeError("injected executor loss")
        yield batch


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("local[4,4]", 8)
    stg = standardize_orders(A.raw_orders(spark, sf), None, A.RUN1)
    flaky = stg.mapInArrow(fail_first_attempt, stg.schema)
    dims = current_products(spark, sf)
    out = {}
    for label, src in (("clean", stg), ("retried", flaky)):
        fact = transform_fact_orders(src)
        gold = build_daily_product_sales(fact, dims, A.RUN2)
        out[label] = (sorted(map(tuple, fact.collect()), key=repr), sorted(map(tuple, gold.collect()), key=repr))
    print(json.dumps({
        "fact_rows": len(out["clean"][0]), "gold_rows": len(out["clean"][1]),
        "fact_equal": out["clean"][0] == out["retried"][0], "gold_equal": out["clean"][1] == out["retried"][1],
    }))
    spark.stop()


if __name__ == "__main__":
    main()
