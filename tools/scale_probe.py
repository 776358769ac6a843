"""Landing and repair at a multiple of a scale factor: lineitem replicated
``copies`` times (keys kept unique), quantities as text with 'n/a' (or, with
``--recoverable``, the text moved to an upstream rescued column) for 1 % of
rows; streamed into a table, then self-repaired. Prints one JSON line.

    python tools/scale_probe.py [--copies 10] [--recoverable] [sf_dir]
"""

from __future__ import annotations

import argparse
import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from strandline.contracts import TableContract  # noqa: E402
from strandline.operators.repair import self_repair_table  # noqa: E402
from strandline.operators.sink import ParquetTable  # noqa: E402
from strandline.plans.fixtures import table, write_drop  # noqa: E402
from strandline.session import build_session, work_root  # noqa: E402
from strandline.streaming.loads import LandingLoad  # noqa: E402


def main():
    ap = argparse.ArgumentParser()
    ap.add_argument("sf_dir", nargs="?", default="/root/testdata/sf0.1")
    ap.add_argument("--copies", type=int, default=10)
    ap.add_argument("--recoverable", action="store_true")
    a = ap.parse_args()
    spark = build_session("local[8]", driver_memory="16g")
    root = work_root(spark, "scale_probe")
    li = table(spark, a.sf_dir, "lineitem")
    big = (li.withColumn("rep", F.explode(F.sequence(F.lit(0), F.lit(a.copies - 1))))
           .withColumn("l_orderkey", F.col("l_orderkey") * a.copies + F.col("rep")).drop("rep"))
    bad = F.col("l_orderkey") % 97 == 0
    qty = F.col("l_quantity").cast("string")
    cols = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
            F.when(bad, F.lit(None if a.recoverable else "n/a")).otherwise(qty).alias("l_quantity"),
            F.col("l_extendedprice").cast("string").alias("l_extendedprice"),
            "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]
    if a.recoverable:
        cols.append(F.when(bad, F.to_json(F.struct(qty.alias("l_quantity")))).alias("_rescued_data"))
    t0 = time.time()
    write_drop(big.select(*cols), f"{root}/land")
    t_drop = time.time() - t0
    c = TableContract("li", "li", "bronze.li", "l_orderkey",
                      {"l_quantity": "double", "l_extendedprice": "double"}, ("l_quantity",))
    ld = LandingLoad(spark=spark, contract=c, source=f"{root}/land",
                     table=ParquetTable(f"{root}/table"), checkpoint=f"{root}/chk")
    t0 = time.time()
    r = ld.run()
    t_load = time.time() - t0
    t0 = time.time()
    rep = self_repair_table(spark, ld.table, c)
    t_rep = time.time() - t0
    print(json.dumps({"rows": r.rows_read, "rescued": r.rows_rescued, "drop_s": round(t_drop, 2),
                      "load_s": round(t_load, 2), "load_rows_per_s": int(r.rows_read / t_load),
                      "repair_s": round(t_rep, 2),
                      "repair": [rep.rows_rescued_before, rep.rows_rescued_after, rep.status]}))
    spark.stop()


if __name__ == "__main__":
    main()
