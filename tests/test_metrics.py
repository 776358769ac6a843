"""Counts, metrics, alerts, run log."""

from pyspark.sql import functions as F

from strandline.operators.metrics import (RUN_LOG_SCHEMA, log_rows, run_metrics, table_counts,
                                          threshold_alerts)
from strandline.operators.sink import ParquetTable


def test_counts_and_share(spark):
    df = spark.createDataFrame([(1, None), (2, "{}"), (3, None), (4, '{"a":"b"}')],
                               "k long, _rescued_data string")
    r = table_counts(df).first()
    assert (r["rows_total"], r["rows_rescued"], r["rescued_pct"]) == (4, 2, 0.5)
    e = table_counts(df.limit(0)).first()
    assert (e["rows_total"], e["rows_rescued"], e["rescued_pct"]) == (0, 0, 0.0)
    assert table_counts(df.select("k")).first()["rows_rescued"] == 0


def test_alert_rules(spark):
    m = spark.createDataFrame([
        ("a", 100, 100, 0.06, 10.0), ("b", 100, 0, 0.01, 4000.0), ("c", 100, 100, 0.05, None),
    ], "table_name string, rows_read long, rows_written long, rescued_pct double, duration_secs double")
    got = sorted((r["table_name"], r["rule"]) for r in threshold_alerts(m, ["table_name"]).collect())
    assert got == [("a", "rescued_pct"), ("b", "duration_secs"), ("b", "rows_written")]


def test_run_metrics_and_log(spark, tmp):
    df = spark.createDataFrame([("x", None), ("x", "{}"), ("y", None)],
                               "table_name string, _rescued_data string")
    m = run_metrics(df, ["table_name"])
    got = {r["table_name"]: (r["rows_read"], r["rows_rescued"], r["rescued_pct"]) for r in m.collect()}
    assert got == {"x": (2, 1, 0.5), "y": (1, 0, 0.0)}
    rows = log_rows(m, threshold_alerts(m, ["table_name"]), task_name="t", run_id="r1")
    assert rows.schema.simpleString() == RUN_LOG_SCHEMA.simpleString()
    log = ParquetTable(f"{tmp}/log", ())
    log.append(rows)
    log.append(rows)
    back = log.read(spark)
    assert back.count() == 6
    msg = back.filter("log_level = 'METRIC' AND table_name = 'x'").first()["message"]
    assert msg == "x: 2 rows, 1 rescued (50.00%)"
    assert back.filter(F.col("logged_at").isNull()).count() == 0


def test_repair_and_load_log_rows(spark):
    from strandline.operators.metrics import repair_log_rows
    from strandline.operators.repair import RepairResult, repair_results
    res = repair_results(spark, [RepairResult("a", 10, 0, 10, 1.0, "SUCCESS"),
                                 RepairResult("b", 5, 2, 3, 1.0, "SUCCESS"),
                                 RepairResult("c", -1, -1, 0, 0.5, "FAILED", "boom")])
    rows = repair_log_rows(res, "repair").collect()
    levels = sorted((r["table_name"], r["log_level"]) for r in rows)
    assert levels == [("a", "METRIC"), ("b", "METRIC"), ("b", "WARN"), ("c", "ERROR")]
    failed = [r for r in rows if r["table_name"] == "c"][0]
    assert (failed["status"], failed["error_message"]) == ("FAILED", "boom")


def test_log_levels_texts_and_a_log_that_fails(spark, tmp):
    import pytest
    from strandline.operators.metrics import append_log
    long = "trace " * 3000
    m = spark.createDataFrame([("ok", 5, 0, "SUCCESS", None), ("bad", 0, 9, "FAILED", long)],
                              "table_name string, rows_read long, rows_written long, status string, error string")
    rows = {(r["table_name"], r["log_level"]): r for r in
            log_rows(m, threshold_alerts(m, ["table_name"]), "t").collect()}
    assert set(rows) == {("ok", "METRIC"), ("ok", "WARN"), ("bad", "ERROR")}
    assert rows["ok", "WARN"]["message"] == "rows_written 0.0 is below the least 1.0"
    assert rows["bad", "ERROR"]["error_message"] == long and long in rows["bad", "ERROR"]["message"]

    class Broken:
        path = "nowhere"

        def append(self, df):
            raise OSError("disk full")
    with pytest.warns(RuntimeWarning, match="disk full"):
        assert append_log(Broken(), log_rows(m, None, "t")) is False
