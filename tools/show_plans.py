"""Writes docs/PLANS.md: physical plans of the main operators on sf0.01
inputs, as Spark chooses them. Broadcasts are turned off for the join
shown, so the plan is the one large inputs get.

    python tools/show_plans.py
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from strandline.functions.columns import recover, rescued_filter  # noqa: E402
from strandline.operators.metrics import observed, run_metrics  # noqa: E402
from strandline.operators.repair import self_repair, self_repair_table, update_by_key  # noqa: E402
from strandline.operators.sink import ParquetTable  # noqa: E402
from strandline.plans.fixtures import (EVENTS, ORDERS, events_flagship_landing, table,  # noqa: E402
                                       write_drop)
from strandline.plans.queries import _stored_dirty  # noqa: E402
from strandline.session import build_session, work_root  # noqa: E402
from strandline.sources.landing import list_files, read_landing, schema_groups  # noqa: E402
from strandline.streaming.loads import prepare_batch  # noqa: E402

SF = "/root/testdata/sf0.01"


def plan(df) -> str:
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


def main():
    spark = build_session("local[8]")
    root = work_root(spark, "plans")
    out = ["# Physical plans", "",
           "Generated by `tools/show_plans.py` on sf0.01 inputs (paths shortened).", ""]

    def add(title, why, df):
        text = plan(df).replace(root, "<root>")
        out.extend([f"## {title}", "", why, "", "```", text.strip(), "```", ""])

    t = _stored_dirty(spark, SF, root, with_null_keys=True)
    d = t.read(spark)
    add("W10 rescued rows", "Pushed `IsNotNull(_rescued_data)`, two-column `ReadSchema`.",
        rescued_filter(d).select("o_orderkey"))
    add("W15 self repair", "One scan, no Exchange; JSON parsed only for guarded rows.",
        self_repair(d, ORDERS.key, ORDERS.rescued_types()))
    # the plans that a repair runs, taken from the repair itself
    ran = {}

    def spy(name):
        own = getattr(ParquetTable, name)

        def call(self, df, **kw):
            ran[name] = plan(df).replace(root, "<root>")
            return own(self, df, **kw)
        setattr(ParquetTable, name, call)
        return own
    saved = {n: spy(n) for n in ("summary", "replace_partitions")}
    self_repair_table(spark, t, ORDERS)
    for n, own in saved.items():
        setattr(ParquetTable, n, own)
    for n, title, why in (
            ("summary", "Repair job 1: partitions with changes", "Only rescued rows (pushed filter) and of "
             "them only the key, the columns the repair can change and `_rescued_data`; partial "
             "aggregation before a small shuffle by partition."),
            ("replace_partitions", "Repair job 2: the rewrite into the stage", "A semi join with the "
             "summary picks exactly the partitions with changes (dynamic partition pruning).")):
        out.extend([f"## {title}", "", why, "", "```", ran[n].strip(), "```", ""])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    fixes = (table(spark, SF, "orders").filter(F.col("o_orderkey") % 3 == 0)
             .select("o_orderkey", (F.col("o_totalprice") + 1).alias("o_totalprice")))
    add("W14 update by key (broadcast off)", "Source aggregated by key once, then joined on (key, "
        "salt); hot keys come from a count by key; healthy and NULL-key rows, and rows that the broadcast "
        "bitmap of the source's keys rules out, bypass the join through the union.",
        update_by_key(d, fixes, ORDERS.key, ["o_totalprice"]))
    shared = F.when(F.col("o_orderkey") % 2 == 0, F.lit(0)).otherwise(F.col("o_orderkey"))
    hot = d.select(shared.alias("k"), "o_totalprice", "_rescued_data")   # key 0: half the rows
    hot_src = fixes.select(F.col("o_orderkey").alias("k"), "o_totalprice")
    add("W14 update by key with a hot key (broadcast off)", "The same plan: a key with at least one "
        "in `parts` of the rows is dealt over the salts, its source row copied to each.",
        update_by_key(hot, hot_src, "k", ["o_totalprice"], parts=10))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10485760")
    write_drop(events_flagship_landing(table(spark, SF, "events")), f"{root}/land")
    batch = read_landing(spark, schema_groups(list_files(spark, f"{root}/land")), EVENTS.types)
    add("W1-W4, W7-W9, W19 landing batch", "Scan with `_metadata.file_path`, capture, recover, "
        "cast, in-flight metrics; no Exchange.",
        observed(prepare_batch(batch, EVENTS, None))[0])
    from strandline.streaming.loads import cluster_by_partition
    dated = table(spark, SF, "orders").withColumn("order_date", F.to_date("o_orderdate"))
    add("W21 clustered partitioned write (opt-in)", "`files_per_partition_value=k`: one "
        "hash exchange on (partition value, key hash mod k), so each value gets at most k "
        "files and a hot value is written by k tasks.",
        cluster_by_partition(dated, "order_date", "o_orderkey", 4))
    add("W8 recover", "`from_json` once per row into a map; keys looked up.",
        recover(table(spark, SF, "events"), {"k": "long"}, rescued_col="props"))
    add("W19 run metrics", "Partial aggregation per group before the shuffle.",
        run_metrics(batch, ["event_type"]))
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))),
                           "docs", "PLANS.md"), "w") as f:
        f.write("\n".join(out))
    spark.stop()


if __name__ == "__main__":
    main()
