"""Census of rescued entries, writers by size, alerts during a run, resumed runs."""

import glob
import json
import os
import time

import pytest
from pyspark.sql import functions as F

from strandline.contracts import TableContract
from strandline.operators.census import STATES, census_worklist, rescue_census, table_census
from strandline.operators.metrics import fired_rules
from strandline.operators.repair import self_repair
from strandline.operators.sink import ParquetTable
from strandline.streaming.loads import LandingLoad, cluster_by_size, run_all

C = TableContract("t", "t", "bronze.t", "id", {"amount": "double"}, ("amount",))


def make_load(spark, tmp, contract=C, **kw):
    return LandingLoad(spark=spark, contract=contract, source=f"{tmp}/{contract.folder}", table=ParquetTable(f"{tmp}/table_{contract.name}"),
                       checkpoint=f"{tmp}/chk_{contract.name}", mode="discover", **kw)


def drop(spark, folder, sql):
    spark.sql(sql).coalesce(1).write.mode("append").parquet(folder)


def census_of(df, types):
    return {r["column"]: tuple(r[s] for s in STATES) for r in table_census(df, "t", types).collect()}


def test_census_states(spark):
    e = '{"amount":"1.5"}'
    rows = [(1, None, e), (2, 1.5, e), (3, 2.0, e), (4, None, '{"amount":"x"}'), (5, 2.0, '{"amount":"x","other.col":"1"}'),
            (6, None, "no json"), (7, None, None), (8, None, '{"id":"9","amount":"1"}'), (None, None, "{}")]
    df = spark.createDataFrame(rows, "id long, amount double, _rescued_data string")
    assert census_of(df, C.types) == {"amount": (1, 2, 1, 2, 0), "id": (0, 0, 1, 0, 0), "other.col": (0, 0, 0, 0, 1),
                                      "_rescued_data": (0, 0, 0, 0, 1)}
    # the census says what a repair will do: entries that it can clear leave
    left = self_repair(df.filter("id IS NOT NULL"), "id", {"amount": "double"})
    after = census_of(left, C.types)
    assert after["amount"] == (0, 0, 1, 2, 0)
    assert table_census(df.drop("_rescued_data"), "t", C.types).count() == 0
    assert table_census(df.limit(0), "t", C.types).count() == 0


def test_census_of_nested_addresses_and_worklist(spark):
    schema = "id long, info struct<s:int,l:array<int>>, v long, _rescued_data string"
    rows = [(1, (None, [1, None]), None, '{"info.s":"7","info.l[1]":"x","v":"3"}'), (2, (7, []), 1, '{"info.s":"7"}'),
            (3, None, 1, '{"info":"{\\"s\\":1,\\"l\\":[2]}"}'), (4, (1, None), 5, '{"v":"6","info.zzz":"1"}')]
    df = spark.createDataFrame(rows, schema)
    got = census_of(df, {})
    assert got["info"] == (1, 2, 0, 2, 0) and got["v"] == (0, 1, 1, 0, 0)
    other = spark.createDataFrame([(1, None, '{"amount":"bad"}')], "id long, amount double, _rescued_data string")
    contracts = {"n": TableContract("n", "n", "n", "id", {}, ()), "t": C, "none": C}
    census = rescue_census(spark, {"n": df, "t": other, "none": other.limit(0)}, contracts)
    items = {r["table_name"]: (r["primary_key"], r["rescued_cols"], r["rows_rescued"]) for r in census_worklist(census, contracts).collect()}
    assert items == {"n": ("id", "info,v", 4)}      # nothing can be repaired in t
    assert rescue_census(spark, {}, {}).count() == 0


def test_plan_census_reads_rescued_rows_only(spark, tmp):
    spark.range(100).selectExpr("id", "CAST(NULL AS DOUBLE) AS amount", "IF(id = 3, '{}', NULL) AS _rescued_data").write.parquet(f"{tmp}/c")
    plan = table_census(spark.read.parquet(f"{tmp}/c"), "t", C.types)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(_rescued_data)]" in plan and plan.count("Exchange hashpartitioning") == 1


def test_files_follow_the_rows_of_a_value(spark, tmp):
    """A value with a third of the rows and 1,000 tiny ones: files of the large value are
    within a factor of 2 in size, a tiny value is one file."""
    big = spark.range(50_000).selectExpr("id", "'big' AS day", "cast(xxhash64(id) as string) AS x")
    mid = spark.range(50_000, 90_000).selectExpr("id", "concat('mid', id % 4) AS day", "cast(xxhash64(id) as string) AS x")
    tiny = spark.range(90_000, 100_000).selectExpr("id", "concat('tiny', id % 1000) AS day", "cast(xxhash64(id) as string) AS x")
    odd = spark.range(5).selectExpr("id", "CAST(NULL AS STRING) AS day", "'n' AS x")
    df = big.union(mid).union(tiny).union(odd).repartition(7)
    out = cluster_by_size(df, "day", "id", 5000)
    assert out.columns == df.columns
    out.write.partitionBy("day").parquet(f"{tmp}/sized")
    assert spark.read.parquet(f"{tmp}/sized").count() == 100_005

    def sizes(day):
        return [os.path.getsize(f) for f in glob.glob(f"{tmp}/sized/day={day}/part-*")]
    assert len(sizes("big")) == 10 and max(sizes("big")) <= 2 * min(sizes("big"))
    large = sizes("big") + [s for k in range(4) for s in sizes(f"mid{k}")]
    assert max(large) <= 2 * min(large)
    assert all(len(sizes(f"tiny{k}")) == 1 for k in range(0, 1000, 50)) and len(sizes("__HIVE_DEFAULT_PARTITION__")) == 1
    tasks = out.select(F.spark_partition_id().alias("p")).groupBy("p").count().collect()
    assert max(r["count"] for r in tasks) <= 10_500          # tiny values share writers, none of them large
    assert cluster_by_size(df.limit(0), "day", "id", 5000).count() == 0


def test_alerts_come_during_a_run(spark, tmp):
    """A continuous load alerts on its first bad batch, before it ends."""
    drop(spark, f"{tmp}/t", "SELECT id, IF(id < 5, 'x', '1') AS amount FROM range(10)")
    seen = []
    ld = make_load(spark, tmp, trigger="processing_time", processing_time="1 seconds",
                   on_alert=lambda *a: seen.append((a, time.time())))
    q = ld.start()
    try:
        for _ in range(300):
            if seen:
                break
            time.sleep(0.2)
        assert seen and q.isActive
        drop(spark, f"{tmp}/t", "SELECT id, '1' AS amount FROM range(10, 20)")
        q.processAllAvailable()
    finally:
        q.stop()
    ended = time.time()
    assert [a for a, _ in seen] == [("t", 0, "rescued_pct", 0.5, 0.05)] and all(t < ended for _, t in seen)
    assert fired_rules({"rescued_pct": 0.05, "rows_written": 0, "duration_secs": None}) == [("rows_written", 0.0, 1.0)]


def test_a_run_is_resumed_where_it_failed(spark, tmp):
    contracts = [TableContract(n, n, n, "id", {}, ()) for n in ("a", "b", "c")]
    for n in ("a", "c"):
        drop(spark, f"{tmp}/{n}", "SELECT id FROM range(3)")
    log = ParquetTable(f"{tmp}/log", ())
    loads = lambda: [make_load(spark, tmp, c) for c in contracts]
    with pytest.raises(RuntimeError, match="b"):
        run_all(spark, loads(), log_table=log, run_id="r1")
    with pytest.raises(ValueError, match="log_table"):
        run_all(spark, loads(), resume="r1")
    drop(spark, f"{tmp}/b", "SELECT id FROM range(4)")
    drop(spark, f"{tmp}/a", "SELECT id + 10 AS id FROM range(3)")       # new files of a finished table wait for the next run
    started = []
    again = loads()
    for ld in again:
        plain = ld.start
        ld.start = lambda plain=plain, n=ld.contract.name: (started.append(n), plain())[1]
    out = {r["table_name"]: (r["status"], r["rows_total"]) for r in run_all(spark, again, log_table=log, resume="r1").collect()}
    assert started == ["b"] and out == {"a": ("SKIPPED", 3), "b": ("SUCCESS", 4), "c": ("SKIPPED", 3)}
    rows = [(r["table_name"], r["status"], r["log_level"]) for r in log.read(spark).filter("run_id = 'r1'").orderBy("logged_at").collect()]
    assert sorted(rows[:3]) == [(n, "STARTED", "INFO") for n in "abc"] and ("b", "FAILED", "ERROR") in rows
    assert rows.count(("b", "STARTED", "INFO")) == 2 and ("b", "SUCCESS", "METRIC") in rows
    out = {r["table_name"]: r["status"] for r in run_all(spark, loads(), log_table=log, resume="r1").collect()}
    assert set(out.values()) == {"SKIPPED"}
    fresh = {r["table_name"]: r["rows_written"] for r in run_all(spark, loads(), log_table=log, run_id="r2").collect()}
    assert fresh == {"a": 3, "b": 0, "c": 0}
    assert json.dumps(sorted({r["run_id"] for r in log.read(spark).select("run_id").distinct().collect()})) == '["r1", "r2"]'
