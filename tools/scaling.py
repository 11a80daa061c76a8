"""

    python tools/scaling.py [sf_dir] [repeats ...]      # default: sf0.1, 1 5 10

Repeats the sf lineitem table inside one plan (a union, so each copy keeps its
own scan splits) and runs the flagship plan to the noop sink; prints facts/s.
A local measurement, not a registered query.
"""

from __future__ import annotations

import os
import statistics
import sys
import time
from functools import reduce

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.1"
    repeats = [int(x) for x in argv[2:]] or [1, 5, 10]
    from carelens import fixtures as fx
    from carelens.plans.bronze import bronze_provider, bronze_staffing, bronze_state
    from carelens.plans.dashboard import dashboard
    from carelens.plans.gold import gold
    from carelens.session import get_spark

    spark = get_spark("local[8]", shuffle_partitions=8, conf={"spark.driver.memory": "16g"})
    li = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    n = li.count()
    p = bronze_provider(fx.role(spark, sf_dir, "provider"), stamped=False)
    st = bronze_state(fx.role(spark, sf_dir, "state"), stamped=False)
    for rep in repeats:
        big = reduce(lambda a, b: a.unionByName(b), [li] * rep)
        ts = []
        for _ in range(3):
            t0 = time.perf_counter()
            plan = dashboard(gold(bronze_staffing(fx.staffing_landing(big), stamped=False), p, st))
            plan.write.format("noop").mode("overwrite").save()
            ts.append(time.perf_counter() - t0)
        t = statistics.median(ts)
        print(f"facts={n * rep:>11,d}  median={t:6.2f}s  facts/s={n * rep / t:,.0f}", flush=True)
    spark.stop()


if __name__ == "__main__":
    main(sys.argv)
