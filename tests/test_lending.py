"""The fifteen lending contracts end to end on small landing folders:
multi-table load with typed misfits, inventory, worklist and repair."""

import random

from pyspark.sql import types as T

from strandline.contracts import REGISTRY
from strandline.operators.repair import repair_worklist, self_repair_table
from strandline.sources.inventory import source_inventory
from strandline.streaming.loads import load_table, run_all

SPARK_TYPES = {"double": T.DoubleType(), "long": T.LongType(), "boolean": T.BooleanType()}


def landing_rows(c, n=6, seed=0):
    """Rows as a feed would send them: declared columns as text; for columns
    the contract lists as rescued, a few values arrive unparseable."""
    rnd = random.Random(seed)
    cols = [c.key] + list(c.types) + (["transaction_date"] if c.partition else [])
    rows = []
    for i in range(n):
        r = [f"{c.name}-{i}"]
        for name, t in c.types.items():
            if name in c.rescued and i % 3 == 0:
                r.append("n/a")
            elif t == "double":
                r.append(str(round(rnd.uniform(0, 1000), 2)))
            elif t == "long":
                r.append(str(rnd.randint(0, 90)))
            else:
                r.append(rnd.choice(["true", "false", "yes", "0"]))
        if c.partition:
            r.append(f"2024-01-0{1 + i % 3}")
        rows.append(tuple(r))
    return cols, rows


def test_lending_load_inventory_worklist_repair(spark, tmp):
    land = f"{tmp}/landing"
    for c in REGISTRY.values():
        if c.name == "nach_bounces":
            continue                                   # one feed missing
        cols, rows = landing_rows(c)
        spark.createDataFrame(rows, ", ".join(f"`{x}` string" for x in cols)) \
            .coalesce(1).write.parquet(f"{land}/{c.folder}")
    import os
    os.makedirs(f"{land}/empty_feed")

    inv = {r["source"]: r for r in source_inventory(
        spark, land, [c.folder for c in REGISTRY.values()] + ["empty_feed"]).collect()}
    assert inv["nach_bounces"]["status"] == "MISSING"
    assert inv["empty_feed"]["status"] == "EMPTY"
    assert inv["cdc/loan_status"]["status"] == "PRESENT" and inv["cdc/loan_status"]["rows"] == 6

    loaded = run_all(spark, REGISTRY, land, f"{tmp}/tables", f"{tmp}/chk", raise_on_failure=False)
    res = {r["table_name"]: r for r in loaded.collect()}
    # the load results go to the run log; 2 of 6 rows rescued is above 5 %
    from strandline.operators.metrics import log_rows, threshold_alerts
    log = log_rows(loaded, threshold_alerts(loaded, ["table_name"]), "bronze_landing").collect()
    warned = {r["table_name"] for r in log if r["log_level"] == "WARN"}
    assert {n for n, c in REGISTRY.items() if c.rescued} <= warned
    assert sum(r["log_level"] == "METRIC" for r in log) == len(REGISTRY) - 1
    assert [r["table_name"] for r in log if r["log_level"] == "ERROR"] == ["nach_bounces"]
    assert res["nach_bounces"]["status"] == "FAILED"
    ok = [n for n in REGISTRY if n != "nach_bounces"]
    assert all(res[n]["status"] == "SUCCESS" and res[n]["rows_written"] == 6 for n in ok)
    for n in ok:
        c = REGISTRY[n]
        want = 2 if c.rescued else 0                    # rows 0 and 3 carry 'n/a'
        assert res[n]["rows_rescued"] == want, n
        t = load_table(spark, c, land, f"{tmp}/tables", f"{tmp}/chk").table.read(spark)
        for name, typ in c.types.items():
            assert t.schema[name].dataType == SPARK_TYPES[typ], (n, name)
    tx = load_table(spark, REGISTRY["transactions"], land, f"{tmp}/tables", f"{tmp}/chk").table
    assert tx.read(spark).select("transaction_date").distinct().count() == 3

    tables = {n: load_table(spark, REGISTRY[n], land, f"{tmp}/tables", f"{tmp}/chk").table
              for n in ok}
    wl = repair_worklist(spark, {n: t.read(spark) for n, t in tables.items()}, REGISTRY)
    items = {r["table_name"]: r for r in wl.collect()}
    assert set(items) == {n for n in ok if REGISTRY[n].rescued}
    assert items["underwriting_decisions"]["rescued_cols"].split(",")[0] == "approved_amount"

    # 'n/a' cannot be recovered: repair keeps those rows rescued and reports it
    r = self_repair_table(spark, tables["bureau_pulls"], REGISTRY["bureau_pulls"])
    assert (r.status, r.rows_rescued_before, r.rows_rescued_after) == ("SUCCESS", 2, 2)
    r = self_repair_table(spark, tables["bureau_pulls"], REGISTRY["bureau_pulls"], residual="clear")
    assert (r.rows_rescued_after, r.rows_repaired) == (0, 2)

    # the worklist repaired as a run, logged to the run log with the loads
    from strandline.operators.repair import repair_items
    from strandline.operators.sink import ParquetTable
    log = ParquetTable(f"{tmp}/run_log", ())
    run_all(spark, REGISTRY, land, f"{tmp}/tables", f"{tmp}/chk", raise_on_failure=False,
            log_table=log)
    done = repair_items(spark, wl, tables, REGISTRY, log_table=log).collect()
    assert len(done) == len(items)
    levels = {(r["task_name"], r["log_level"]) for r in log.read(spark).collect()}
    assert {("bronze_landing", "METRIC"), ("bronze_repair", "METRIC"),
            ("bronze_repair", "WARN")} <= levels


def test_inventory_root_forms(spark, tmp):
    import os
    os.makedirs(f"{tmp}/land/a")
    spark.createDataFrame([(1,)], "x long").coalesce(1).write.parquet(f"{tmp}/land/a/part")
    for root in (f"{tmp}/land", f"file://{tmp}/land", f"file:{tmp}/land/"):
        inv = {r["source"]: (r["files"], r["rows"], r["status"])
               for r in source_inventory(spark, root, ["a/part", "b"]).collect()}
        assert inv == {"a/part": (1, 1, "PRESENT"), "b": (0, 0, "MISSING")}, root


def test_declared_partition_type(spark, tmp):
    from strandline.contracts import REGISTRY
    from strandline.operators.sink import ParquetTable
    base = REGISTRY["transactions"]
    c = base.with_types(transaction_date="date")
    land = f"{tmp}/landing"
    cols, rows = landing_rows(base, n=3)
    spark.createDataFrame(rows, ", ".join(f"`{x}` string" for x in cols)) \
        .coalesce(1).write.parquet(f"{land}/{c.folder}")
    ld = load_table(spark, c, land, f"{tmp}/tables", f"{tmp}/chk")
    ld.run()
    fresh = ParquetTable(ld.table.path, ld.table.partition_cols, ld.table.partition_types)
    assert dict(fresh.read(spark).dtypes)["transaction_date"] == "date"
    assert fresh.read(spark).count() == 3


def test_files_per_partition_value(spark, tmp):
    import glob
    from strandline.contracts import REGISTRY
    c = REGISTRY["transactions"]
    land = f"{tmp}/landing"
    cols, rows = landing_rows(c, n=60)
    spark.createDataFrame(rows, ", ".join(f"`{x}` string" for x in cols)) \
        .repartition(6).write.parquet(f"{land}/{c.folder}")          # 6 input files, 3 dates each
    ld = load_table(spark, c, land, f"{tmp}/tables", f"{tmp}/chk", files_per_partition_value=2)
    r = ld.run()
    assert r.rows_read == 60 and ld.table.read(spark).count() == 60
    for day in glob.glob(f"{tmp}/tables/transactions/_batch_id=0/transaction_date=*"):
        assert len(glob.glob(f"{day}/*.parquet")) <= 2, day


def test_inventory_states_and_gate(spark, tmp):
    import os

    import pytest
    from strandline.sources.inventory import InventoryError, gate
    gone = source_inventory(spark, f"{tmp}/nowhere", ["a", "b"])
    assert {(r["source"], r["status"]) for r in gone.collect()} == {("a", "MISSING"), ("b", "MISSING")}
    os.makedirs(f"{tmp}/land/hollow")
    only = source_inventory(spark, f"{tmp}/land", ["hollow"])
    assert only.first()["status"] == "EMPTY"
    with pytest.warns(RuntimeWarning, match="hollow"):
        assert gate(only) == ["source hollow is EMPTY"]
    spark.createDataFrame([(1,), (2,)], "x long").coalesce(1).write.parquet(f"{tmp}/land/good")
    spark.createDataFrame([(1,)], "x long").coalesce(1).write.parquet(f"{tmp}/land/torn")
    with open(f"{tmp}/land/torn/junk.parquet", "wb") as f:
        f.write(b"no parquet")
    inv = source_inventory(spark, f"{tmp}/land", ["good", "torn", "hollow", "lost"])
    got = {r["source"]: (r["files"], r["unreadable"], r["rows"], r["status"]) for r in inv.collect()}
    assert got == {"good": (1, 0, 2, "PRESENT"), "torn": (2, 1, 1, "UNREADABLE"),
                   "hollow": (0, 0, 0, "EMPTY"), "lost": (0, 0, 0, "MISSING")}
    with pytest.raises(InventoryError, match="torn .UNREADABLE., lost .MISSING."):
        gate(inv, warn=())
    assert gate(inv.filter("source = 'good'")) == []
