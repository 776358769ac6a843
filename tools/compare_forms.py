"""Measures the design choices SURVEY §6 names against their alternatives,
at one scale factor (default sf0.1); best of three runs through the noop
sink. Prints one JSON line.

    python tools/compare_forms.py [sf_dir]
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from strandline.functions.columns import RESCUED, recover  # noqa: E402
from strandline.operators.metrics import table_counts  # noqa: E402
from strandline.operators.repair import repair_source, self_repair, update_by_key  # noqa: E402
from strandline.plans.fixtures import ORDERS, dirty_orders, table  # noqa: E402
from strandline.session import build_session, work_root  # noqa: E402
from strandline.operators.sink import ParquetTable  # noqa: E402

COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_partkey", "l_suppkey",
        "l_linenumber"]


def best(fn, n=3):
    times = []
    for _ in range(n):
        t0 = time.time()
        fn()
        times.append(time.time() - t0)
    return round(min(times), 3)


def noop(df):
    return lambda: df.write.format("noop").mode("overwrite").save()


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = build_session("local[8]")
    root = work_root(spark, "compare")
    out = {}

    # 1. W15 narrow self repair vs the join form (W10-W13 source + W14 merge)
    t = ParquetTable(f"{root}/orders")
    t.exists(spark)
    t.write_batch(dirty_orders(table(spark, sf, "orders")), 0)
    d = t.read(spark)
    types = ORDERS.rescued_types()
    noop(d)()                                                   # warm the scan
    out["self_repair_narrow"] = best(noop(self_repair(d, ORDERS.key, types, "clear")))
    out["self_repair_join_form"] = best(noop(update_by_key(
        d, repair_source(d, ORDERS.key, types, "clear"), ORDERS.key, list(types))))

    # 2. one from_json per row vs one get_json_object per column (7 columns)
    li = table(spark, sf, "lineitem")
    j = F.to_json(F.struct(*[F.col(c).cast("string").alias(c) for c in COLS]))
    rescued = li.select("l_orderkey", *[F.lit(None).cast("double").alias(c) for c in COLS],
                        j.alias(RESCUED))
    p = ParquetTable(f"{root}/rescued_li")
    p.exists(spark)
    p.write_batch(rescued, 0)
    r = p.read(spark)
    types7 = {c: "double" for c in COLS}
    noop(r)()
    out["recover_from_json_once"] = best(noop(recover(r, types7)))
    per_col = r.select("l_orderkey", *[F.coalesce(F.col(c), F.get_json_object(RESCUED, f"$.{c}")
                                                  .try_cast("double")).alias(c) for c in COLS],
                       RESCUED)
    out["recover_get_json_object_per_column"] = best(noop(per_col))

    # 3. one aggregate vs separate counts (total, then filter + count)
    out["counts_one_aggregate"] = best(lambda: table_counts(d).collect())
    out["counts_separate"] = best(lambda: (d.count(), d.filter(F.col(RESCUED).isNotNull()).count()))
    out["rows"] = {"orders": d.count(), "lineitem": r.count()}
    spark.stop()
    print(json.dumps({"sf": sf, "seconds_best_of_3": out}))


if __name__ == "__main__":
    main()
