"""Counts, run metrics, threshold alerts and the run log (W16, W17, W19,
W20, W22). All are aggregates or filters over DataFrames; counts that
belong to one load come from one pass (or from ``observe`` on the write)."""

from __future__ import annotations

import uuid
import warnings
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strandline.functions.columns import RESCUED, col

# ---------------------------------------------------------------------------
# Alert thresholds, log levels and the run log's columns.
# ---------------------------------------------------------------------------
MAX_RESCUED_PCT = 0.05        # alert if more than 5 % of rows are rescued
MAX_DURATION_SECONDS = 3600   # alert if a task runs longer than an hour
MIN_ROWS_EXPECTED = 1         # alert if fewer rows are written
RULES = (("rescued_pct", ">", float(MAX_RESCUED_PCT)), ("duration_secs", ">", float(MAX_DURATION_SECONDS)),
         ("rows_written", "<", float(MIN_ROWS_EXPECTED)))
LEVEL_INFO, LEVEL_WARN, LEVEL_ERROR, LEVEL_METRIC = "INFO", "WARN", "ERROR", "METRIC"
SUCCESS, FAILED, SKIPPED, STARTED = "SUCCESS", "FAILED", "SKIPPED", "STARTED"

RUN_LOG_SCHEMA = T.StructType([
    T.StructField("run_id", T.StringType(), False),
    T.StructField("job_run_id", T.StringType()),
    T.StructField("task_name", T.StringType(), False),
    T.StructField("table_name", T.StringType()),
    T.StructField("log_level", T.StringType(), False),
    T.StructField("message", T.StringType()),
    T.StructField("rows_read", T.LongType()),
    T.StructField("rows_written", T.LongType()),
    T.StructField("rows_rescued", T.LongType()),
    T.StructField("rescued_pct", T.DoubleType()),
    T.StructField("duration_secs", T.DoubleType()),
    T.StructField("status", T.StringType()),
    T.StructField("error_message", T.StringType()),
    T.StructField("logged_at", T.TimestampType(), False),
    T.StructField("notebook_path", T.StringType()),
])


def count_exprs(df: DataFrame, rescued_col: str = RESCUED) -> list[Column]:
    """W16 + W17 as aggregate expressions for one pass: total rows and
    rescued rows (0 when the table has no rescued column)."""
    rescued = (F.count(col(rescued_col)) if rescued_col in df.columns   # non-NULL values
               else F.lit(0).cast(T.LongType()))
    return [F.count(F.lit(1)).alias("rows_total"), rescued.alias("rows_rescued")]


def table_counts(df: DataFrame, rescued_col: str = RESCUED) -> DataFrame:
    """One row with ``rows_total``, ``rows_rescued`` and the share."""
    agg = df.agg(*count_exprs(df, rescued_col))
    return agg.withColumn("rescued_pct", share(F.col("rows_rescued"), F.col("rows_total")))


def share(part: Column, whole: Column) -> Column:
    """part / whole as a double; 0 when nothing was read."""
    return F.when(whole > 0, part.cast(T.DoubleType()) / whole.cast(T.DoubleType())) \
        .otherwise(F.lit(0.0))


def observed(df: DataFrame, name: str | None = None, rescued_col: str = RESCUED,
             extra: dict | None = None):
    """W19 in flight: the same counts measured while ``df`` is written.
    ``extra`` adds named aggregate expressions. Returns (df with the
    observation attached, Observation)."""
    obs = Observation(name or f"load_{uuid.uuid4().hex[:8]}")
    rescued = (F.count(col(rescued_col)) if rescued_col in df.columns   # non-NULL values
               else F.lit(0).cast(T.LongType()))
    more = [e.alias(k) for k, e in (extra or {}).items()]
    return df.observe(obs, F.count(F.lit(1)).alias("rows"), rescued.alias("rescued"), *more), obs


def run_metrics(df: DataFrame, group_cols: list[str], rescued_col: str = RESCUED) -> DataFrame:
    """Per group rows read, rescued rows and rescued share. Partial
    aggregation runs before the shuffle, so a hot group costs one row per
    task, not a third of the data."""
    rescued = (F.count(col(rescued_col)) if rescued_col in df.columns   # non-NULL values
               else F.lit(0).cast(T.LongType()))
    agg = df.groupBy(*group_cols).agg(F.count(F.lit(1)).alias("rows_read"),
                                      rescued.alias("rows_rescued"))
    return agg.withColumn("rescued_pct", share(F.col("rows_rescued"), F.col("rows_read")))


def threshold_alerts(metrics: DataFrame, key_cols: list[str]) -> DataFrame:
    """One row per fired rule (``rule``, ``observed``, ``threshold``).
    Rules: rescued share above 5 %, duration above 3600 s, rows written
    below 1. A rule whose measure is absent or NULL does not fire."""
    def measure(name: str) -> Column:
        return (F.col(name) if name in metrics.columns else F.lit(None)).cast(T.DoubleType())

    rules = [(r, measure(r), t, op) for r, op, t in RULES]
    checks = F.array(*[
        F.struct(F.lit(r).alias("rule"), v.alias("observed"), F.lit(t).alias("threshold"),
                 (v > F.lit(t) if op == ">" else v < F.lit(t)).alias("fired"))
        for r, v, t, op in rules])
    return (metrics.select(*[F.col(k) for k in key_cols], F.explode(checks).alias("c"))
            .filter(F.col("c.fired"))
            .select(*[F.col(k) for k in key_cols], "c.rule", "c.observed", "c.threshold"))


def fired_rules(measures: dict) -> list[tuple[str, float, float]]:
    """``threshold_alerts`` for the measures of one batch, on the driver:
    (rule, observed, threshold) of each rule that fires."""
    out = []
    for rule, op, least in RULES:
        v = measures.get(rule)
        if v is not None and (v > least if op == ">" else v < least):
            out.append((rule, float(v), least))
    return out


def lifecycle_rows(spark, tables: list[str], task_name: str, run_id: str, status: str) -> DataFrame:
    """Run-log rows that say that a run of these tables has begun or ended."""
    now = datetime.now(timezone.utc)
    rows = [(run_id, None, task_name, t, LEVEL_INFO, f"{t}: {status.lower()}", None, None, None, None, None, status, None,
             now, None) for t in tables]
    return spark.createDataFrame(rows, RUN_LOG_SCHEMA)


def _pct_text(c: Column) -> Column:
    return F.format_string("%.2f%%", c * F.lit(100.0))


def metric_message(table: Column, read: Column, written: Column, rescued: Column,
                   pct: Column, duration: Column) -> Column:
    """One line for people; a measure that was not taken is left out."""
    parts = [F.concat(F.lit("wrote "), F.format_string("%,d", written), F.lit(" of ")),
             F.concat(F.format_string("%,d", read), F.lit(" rows")),
             F.concat(F.lit(", "), F.format_string("%,d", rescued), F.lit(" rescued")),
             F.concat(F.lit(" ("), _pct_text(pct), F.lit(")")),
             F.concat(F.lit(" in "), F.format_string("%.1f s", duration))]
    kept = [F.when(c.isNotNull(), p) for c, p in zip((written, read, rescued, pct, duration), parts)]
    return F.concat(F.coalesce(table.cast("string"), F.lit("?")), F.lit(": "),
                    F.concat_ws("", *kept))


def alert_message(rule: Column, observed: Column, threshold: Column) -> Column:
    side = F.when(observed < threshold, F.lit(" is below the least ")).otherwise(F.lit(" is above the most "))
    return F.concat(rule, F.lit(" "), observed.cast("string"), side, threshold.cast("string"))


def append_log(table, rows: DataFrame) -> bool:
    """Append run-log rows; a log that cannot be written is reported as a
    warning and does not replace the run's own result."""
    try:
        table.append(rows)
        return True
    except Exception as e:
        warnings.warn(f"run log {table.path} was not written: {e}", RuntimeWarning, stacklevel=2)
        return False


def log_rows(metrics: DataFrame, alerts: DataFrame | None, task_name: str,
             run_id: str | None = None, job_run_id: str | None = None,
             table_col: str = "table_name", notebook_path: str | None = None) -> DataFrame:
    """One row per table and one per alert in the run-log schema, one
    DataFrame per run (one append, not one job per message). A table whose
    status is FAILED has level ERROR, with the error's whole text; others
    have level METRIC, alerts WARN."""
    run_id = run_id or str(uuid.uuid4())
    now = F.lit(datetime.now(timezone.utc).replace(tzinfo=None)).cast(T.TimestampType())

    def m(name, t):
        return (F.col(name) if name in metrics.columns else F.lit(None)).cast(t)

    failed = F.coalesce(m("status", "string") == FAILED, F.lit(False))
    metric_part = metrics.select(
        F.lit(run_id).alias("run_id"), F.lit(job_run_id).cast("string").alias("job_run_id"),
        F.lit(task_name).alias("task_name"), F.col(table_col).cast("string").alias("table_name"),
        F.when(failed, F.lit(LEVEL_ERROR)).otherwise(F.lit(LEVEL_METRIC)).alias("log_level"),
        F.when(failed, F.concat(F.col(table_col).cast("string"), F.lit(" failed: "),
                                F.coalesce(m("error", "string"), F.lit("no reason given"))))
        .otherwise(metric_message(F.col(table_col), m("rows_read", "long"), m("rows_written", "long"),
                                  m("rows_rescued", "long"), m("rescued_pct", "double"),
                                  m("duration_secs", "double"))).alias("message"),
        m("rows_read", "long").alias("rows_read"), m("rows_written", "long").alias("rows_written"),
        m("rows_rescued", "long").alias("rows_rescued"), m("rescued_pct", "double").alias("rescued_pct"),
        m("duration_secs", "double").alias("duration_secs"),
        F.coalesce(m("status", "string"), F.lit(SUCCESS)).alias("status"),
        m("error", "string").alias("error_message"), now.alias("logged_at"),
        F.lit(notebook_path).cast("string").alias("notebook_path"))
    out = metric_part
    if alerts is not None:
        alert_part = alerts.select(
            F.lit(run_id).alias("run_id"), F.lit(job_run_id).cast("string").alias("job_run_id"),
            F.lit(task_name).alias("task_name"), F.col(table_col).cast("string").alias("table_name"),
            F.lit(LEVEL_WARN).alias("log_level"),
            alert_message(F.col("rule"), F.col("observed"), F.col("threshold")).alias("message"),
            *[F.lit(None).cast(f.dataType).alias(f.name) for f in RUN_LOG_SCHEMA.fields[6:11]],
            F.lit(LEVEL_WARN).alias("status"), F.lit(None).cast("string").alias("error_message"),
            now.alias("logged_at"), F.lit(notebook_path).cast("string").alias("notebook_path"))
        out = out.unionByName(alert_part)
    return out.select(*[F.col(f.name).cast(f.dataType) for f in RUN_LOG_SCHEMA.fields])


def repair_log_rows(results: DataFrame, task_name: str, run_id: str | None = None,
                    job_run_id: str | None = None) -> DataFrame:
    """Run-log rows for repair results: one row per table (rescued rows left
    after the repair, or its failure) and a WARN row where some are left:
    values that no column of their table can hold."""
    metrics = results.select("table_name", F.col("rows_rescued_after").alias("rows_rescued"),
                             "duration_secs", "status", "error")
    remaining = (results.filter(F.col("rows_rescued_after") > 0)
                 .select("table_name", F.lit("rows_rescued_after").alias("rule"),
                         F.col("rows_rescued_after").cast(T.DoubleType()).alias("observed"),
                         F.lit(0.0).alias("threshold")))
    return log_rows(metrics, remaining, task_name, run_id, job_run_id)
