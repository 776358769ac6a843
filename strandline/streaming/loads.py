"""Micro-batch landing loads (W23) and multi-table load.

One Structured Streaming query per table: a file-source stream (new files
only, remembered in the checkpoint), a ``foreachBatch`` that lines the
batch up with the contract (capture, recover, cast) and writes it as the
batch's own partition. Replays after a failure overwrite that partition.
"""

from __future__ import annotations

import threading
import time
import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import reduce
from typing import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQueryListener
from pyspark.sql.window import Window

from strandline.contracts import TableContract
from strandline.functions.columns import (BATCH_ID, RESCUED, SOURCE_FILE, capture, cast_to_contract,
                                          lineage, recover, unrecovered_flag)
from strandline.operators.metrics import (FAILED, LEVEL_METRIC, SKIPPED, STARTED, SUCCESS, append_log, count_exprs,
                                          fired_rules, lifecycle_rows, log_rows, observed, threshold_alerts)
from strandline.operators.sink import ParquetTable, align_to_table, evolved
from strandline.sources.landing import (DEFAULT_MAX_FILE_AGE, discover_stream, infer_schema, list_files,
                                       parquet_stream, read_landing, resolve_types, schema_groups)
from strandline.sources.ledger import FolderLedger

_UNRECOVERED = "__sl_unrecovered"

LOAD_RESULT_SCHEMA = T.StructType([
    T.StructField("table_name", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("batches", T.LongType()),
    T.StructField("rows_read", T.LongType()),
    T.StructField("rows_written", T.LongType()),
    T.StructField("rows_rescued_in_load", T.LongType()),
    T.StructField("rows_unrecovered_in_load", T.LongType()),
    T.StructField("rescued_pct", T.DoubleType()),
    T.StructField("rows_total", T.LongType()),
    T.StructField("rows_rescued", T.LongType()),
    T.StructField("duration_secs", T.DoubleType()),
    T.StructField("error", T.StringType()),
])


BATCH_METRICS_SCHEMA = T.StructType([
    T.StructField("table_name", T.StringType()),
    T.StructField("batch_id", T.LongType()),
    T.StructField("rows_read", T.LongType()),
    T.StructField("rows_rescued", T.LongType()),
    T.StructField("rows_unrecovered", T.LongType()),
    T.StructField("rescued_pct", T.DoubleType()),
])


@dataclass
class LoadResult:
    table_name: str
    status: str
    batches: int = 0
    rows_read: int = 0
    rows_written: int = 0
    rows_rescued_in_load: int = 0
    rows_unrecovered_in_load: int = 0
    rows_total: int = 0
    rows_rescued: int = 0
    duration_secs: float = 0.0
    error: str | None = None

    @property
    def rescued_pct(self) -> float:
        return self.rows_rescued_in_load / self.rows_read if self.rows_read > 0 else 0.0

    def as_row(self) -> tuple:
        return (self.table_name, self.status, self.batches, self.rows_read, self.rows_written,
                self.rows_rescued_in_load, self.rows_unrecovered_in_load, self.rescued_pct,
                self.rows_total, self.rows_rescued, self.duration_secs, self.error)


def _path_exists(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.format("binaryFile").load(path).schema  # noqa: B018  (lists the folder)
        return True
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e) or "Path does not exist" in str(e):
            return False
        raise


def prepare_batch(df: DataFrame, c: TableContract, table_schema: T.StructType | None,
                  incoming_rescued: bool = True) -> DataFrame:
    """The per-batch transform shared by stream and batch loads:
    lineage time, recovery of the contract's rescued columns (W8), cast to
    the contract (W9), table types kept for undeclared columns.

    Recovery only runs when the files brought rescued text of their own:
    text captured from this batch already failed the same cast to the same
    contract type, so trying it again could not recover anything."""
    df = lineage(df, file_col=None)
    if incoming_rescued and RESCUED in df.columns and c.rescued:
        df = recover(df, c.rescued_types(), residual="none")
    df = cast_to_contract(df, c.types)
    return align_to_table(df, table_schema)


def cluster_by_partition(df: DataFrame, partition: str, key: str, files: int) -> DataFrame:
    """Rows of one partition value spread over ``files`` tasks by a hash of
    the key: each value gets at most ``files`` files, and a value holding a
    third of the batch is written by ``files`` tasks, not one. The salt is
    deterministic, so a retried task reproduces it."""
    salt = F.pmod(F.xxhash64(F.col(f"`{key}`")), F.lit(files)) if key in df.columns \
        else F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]), F.lit(files))
    return df.repartition(F.col(f"`{partition}`"), salt)


def cluster_by_size(df: DataFrame, partition: str, key: str, rows_per_file: int) -> DataFrame:
    """Rows dealt to writers in proportion to what each partition value holds:
    a counting pass over the one column, then a writer for every
    ``rows_per_file`` rows of a value (rows spread by a hash of the key), while
    values with fewer share writers, one file each. A retried task reproduces its rows."""
    part = F.col(f"`{partition}`")
    counts = df.groupBy(part.alias("__value")).agg(F.count(F.lit(1)).alias("__n"))
    counts = counts.withColumn("__files", F.greatest(F.lit(1), F.round(F.col("__n") / rows_per_file)).cast("long"))
    # Writers are numbered by running sums over the values, large ones first: a row a
    # value, summed within hash buckets, the buckets' totals added up.
    large = (F.col("__files") > 1).cast("int")
    bucket = F.pmod(F.xxhash64("__value"), F.lit(_BUCKETS)).cast("int")
    counts = counts.withColumn("__large", large).withColumn("__bucket", bucket).withColumn(
        "__weight", F.when(F.col("__files") > 1, F.col("__files") * rows_per_file).otherwise(F.col("__n")))
    totals = counts.groupBy("__large", "__bucket").agg(F.sum("__weight").alias("__total")).collect()   # bounded: buckets
    start, at, end = {}, 0, 0
    for r in sorted(totals, key=lambda r: (-r["__large"], r["__bucket"])):
        start[r["__large"], r["__bucket"]] = at
        at += -(-r["__total"] // rows_per_file) * rows_per_file      # a bucket begins with a writer of its own
        end = at // rows_per_file
    base = F.create_map(*[x for (big, b), v in start.items() for x in (F.lit(big * _BUCKETS + b), F.lit(v))]) \
        if start else F.create_map(F.lit(0), F.lit(0))
    before = Window.partitionBy("__large", "__bucket").orderBy("__value").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("__first", ((base[F.col("__large") * _BUCKETS + F.col("__bucket")]
                                            + F.coalesce(F.sum("__weight").over(before), F.lit(0))) / rows_per_file).cast("long"))
    names = df.columns
    spread = F.xxhash64(F.col(f"`{key}`")) if key in names else F.xxhash64(*[F.col(f"`{c}`") for c in names])
    dealt = df.join(counts.select("__value", "__files", "__first"), part.eqNullSafe(F.col("__value")))
    writer = (F.col("__first") + F.pmod(spread, F.col("__files"))).cast("int")
    return dealt.withColumn("__writer", writer).repartitionById(max(1, int(end)), "__writer").select(
        *[F.col(f"`{c}`") for c in names])


_BUCKETS = 64


class LoadAlerts(StreamingQueryListener):
    """W20 during a run: the measures of each batch (rows and rescued rows, observed
    while it was written, and the batch's duration) are held against the alert rules as soon as the
    stream reports the batch, and each alert goes to ``on_alert(table, batch_id,
    rule, observed, threshold)`` while the stream goes on."""

    def __init__(self, on_alert):
        self.on_alert, self.watched, self.measured = on_alert, {}, {}

    def watch(self, query, load: "LandingLoad") -> None:
        self.watched[str(query.id)] = load

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        load = self.watched.get(str(p.id))
        if load is None:
            return
        batch = load.batches.get(load._offset + p.batchId)
        if batch is None or p.numInputRows == 0 or (str(p.id), p.batchId) in self.measured:
            return
        self.measured[str(p.id), p.batchId] = True
        rows = batch["rows"]
        measures = {"rescued_pct": batch["rescued"] / rows if rows else 0.0, "rows_written": rows,
                    "duration_secs": p.durationMs.get("triggerExecution", 0) / 1000}
        for rule, seen, least in fired_rules(measures):
            self.on_alert(load.contract.name, batch["batch_id"], rule, seen, least)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.watched.pop(str(event.id), None)


@dataclass
class LandingLoad:
    """W1 + W23 (+ W2-W4, W7-W9, W16, W17, W21) for one contract."""
    spark: SparkSession
    contract: TableContract
    source: str
    table: ParquetTable
    checkpoint: str
    mode: str = "discover"            # "discover": mixed schemas; "parquet": one schema
    glob: str = "*.parquet"
    evolve: bool = True
    trigger: str = "available_now"    # or "processing_time"
    processing_time: str = "30 seconds"
    max_files_per_trigger: int | None = 10_000   # bounds paths per batch on the driver
    reset: bool = False
    max_file_age: str = DEFAULT_MAX_FILE_AGE
    clean_source: str | None = None   # "archive" (to archive_dir) or "delete" after commit
    archive_dir: str | None = None
    totals: bool = True               # count the whole table after a run (one pass)
    # Opt-in for partitioned contracts: at most this many files per partition
    # value per batch (one shuffle). Default: narrow write, one file per task
    # and partition value.
    files_per_partition_value: int | None = None
    # Opt-in likewise: writers in proportion to each value's rows (a counting pass and one shuffle).
    rows_per_file: int | None = None
    on_alert: object = None           # called with (table, batch id, rule, observed, threshold) during a run
    # what this run wrote, by batch id: a batch that is delivered again counts once
    batches: dict = field(default_factory=dict)
    max_bytes_per_trigger: int | None = None     # bounds a batch by its files' sizes; takes the place of the file limit
    _schema: T.StructType | None = None
    _offset: int = 0
    _seen: T.StructType | None = None            # joined schema of the plan a batch belongs to

    def _check_start(self) -> None:
        """Batch ids restart at 0 with a new checkpoint. On a table that has
        data that would replace stored batches, so a new checkpoint is
        refused unless ``reset``; then ids continue above the highest stored
        one, and that offset is kept beside the checkpoint for later runs."""
        has_table = self.table.exists(self.spark)
        self._schema = self.table.schema(self.spark) if has_table else None
        marker = f"{self.checkpoint}/_strandline_batch_offset"
        if not has_table:
            return
        if _path_exists(self.spark, f"{self.checkpoint}/offsets"):
            if _path_exists(self.spark, marker):
                self._offset = int(self.spark.read.schema("offset long").json(marker)
                                   .first()["offset"])
            return
        if not self.reset:
            raise RuntimeError(
                f"{self.table.path} has data but checkpoint {self.checkpoint} is empty; "
                "batch ids would restart and replace stored batches. Pass reset=True.")
        top = self.table.read(self.spark).agg(F.max(BATCH_ID)).collect()[0][0]
        self._offset = 0 if top is None else int(top) + 1
        self.spark.createDataFrame([(self._offset,)], "offset long").coalesce(1) \
            .write.mode("overwrite").json(marker)

    def _stream(self) -> DataFrame:
        opts = dict(max_files_per_trigger=self.max_files_per_trigger, max_bytes_per_trigger=self.max_bytes_per_trigger,
                    max_file_age=self.max_file_age, clean_source=self.clean_source,
                    archive_dir=self.archive_dir)
        if self.mode == "discover":
            return discover_stream(self.spark, self.source, self.glob, **opts)
        schema = infer_schema(self.spark, self.source, self.glob)
        return parquet_stream(self.spark, self.source, schema, self.glob, **opts)

    def process_batch(self, batch_df: DataFrame, batch_id: int) -> None:
        spark = batch_df.sparkSession
        c = self.contract
        try:    # with FAIR scheduling, concurrent tables share the cluster
            spark.sparkContext.setLocalProperty("spark.scheduler.pool", f"landing_{c.name}")
        except Exception:
            pass
        info: dict = {}
        if self.mode == "discover":
            df = read_landing(spark, schema_groups(batch_df), c.types, self._schema, self.evolve,
                              info=info, seen=self._seen)
            if df is None:
                return
        else:
            info["incoming_rescued"] = RESCUED in batch_df.columns
            if self.trigger != "available_now":
                self._refuse_unknown_columns(batch_df)
            # every column gets a target type (declared, else the table's, else
            # its own), so a value that does not fit is captured, never nulled
            df = capture(batch_df, resolve_types(c.types, self._schema, [batch_df.schema],
                                                 self.evolve))
        df = prepare_batch(df, c, self._schema, info.get("incoming_rescued", True))
        if self.rows_per_file and c.partition and c.partition in df.columns:
            df = cluster_by_size(df, c.partition, c.key, self.rows_per_file)
        elif self.files_per_partition_value and c.partition and c.partition in df.columns:
            df = cluster_by_partition(df, c.partition, c.key, self.files_per_partition_value)
        watched, obs = observed(df)
        bid = self._offset + batch_id
        self.table.write_batch(watched, bid)
        m = obs.get
        rescued = int(m["rescued"])
        self.batches[bid] = {"batch_id": bid, "rows": int(m["rows"]), "rescued": rescued,
                             "unrecovered": self._unrecovered(bid) if rescued else 0}
        self._schema = df.schema if self._schema is None else evolved(self._schema, df.schema, self.table.partition_cols)

    def _refuse_unknown_columns(self, batch_df: DataFrame) -> None:
        """A stream of one schema reads only the columns it started with;
        files that have landed since with others fail the batch by name."""
        files = batch_df.select(F.col(SOURCE_FILE).alias("path")).distinct()
        known = {c.lower() for c in batch_df.columns}
        seen = {c for group in schema_groups(files)
                for c in batch_df.sparkSession.read.option("mergeSchema", "true").parquet(*group).columns}
        extra = sorted(c for c in seen if c.lower() not in known)
        if extra:
            raise RuntimeError(f"columns {extra} have landed that the running stream does not read; "
                               'restart the load, or use mode="discover"')

    def _unrecovered(self, bid: int) -> int:
        """Rows of batch ``bid`` whose rescued text no column holds. A small
        job after the write: only the batch's own folder is listed, only
        rescued rows are read (pushed filter), so the write itself stays a
        plain codegen'd copy."""
        rows = self.table.read_batch(self.spark, bid).filter(F.col(RESCUED).isNotNull())
        flagged = unrecovered_flag(rows, self.contract.rescued_types(), _UNRECOVERED)
        return int(flagged.agg(F.count_if(F.col(_UNRECOVERED))).first()[0])

    def start(self):
        self.batches.clear()
        self.table.finish_stage(self.spark)
        self._check_start()
        w = (self._stream().writeStream.foreachBatch(self.process_batch)
             .option("checkpointLocation", self.checkpoint))
        w = (w.trigger(availableNow=True) if self.trigger == "available_now"
             else w.trigger(processingTime=self.processing_time))
        if self.on_alert is None:
            return w.start()
        alerts = LoadAlerts(self.on_alert)
        self.spark.streams.addListener(alerts)
        query = w.start()
        alerts.watch(query, self)
        return query

    def run_planned(self, ledger: FolderLedger, files: DataFrame | None = None) -> LoadResult:
        """Batch form of the load (``mode="discover"``): the files that the
        ledger has not seen are planned and landed batch by batch, the
        unfinished batches of earlier runs first. ``files`` (path, length)
        replaces the listing of the source folder."""
        t0 = time.time()
        spark = self.spark
        self.batches.clear()
        self.table.finish_stage(spark)
        has_table = self.table.exists(spark)
        self._schema = self.table.schema(spark) if has_table else None
        first = 0
        if has_table and not ledger.plans(spark):
            if not self.reset:
                raise RuntimeError(f"{self.table.path} has data but ledger {ledger.path} is empty; its files would land "
                                   "again. Pass reset=True.")
            first = int(self.table.read(spark).agg(F.max(BATCH_ID)).first()[0]) + 1
        listed = files if files is not None else list_files(spark, self.source, self.glob)
        self._offset = 0
        # what was planned before this run was planned before anything newer is
        for again in (False, True):
            if again:
                ledger.plan(listed, first)
            for plan, batch in ledger.pending(spark):
                self._seen = ledger.schema(spark, plan)
                self.process_batch(ledger.files(spark, plan, batch), batch)
                ledger.landed(spark, plan, batch)
        self._seen = None
        return self.summary(SUCCESS, time.time() - t0)

    def batch_metrics(self) -> DataFrame:
        """W19 per micro-batch: rows and rescued rows measured in flight by
        ``observe`` while the batch was written, unrecovered rows by the
        small follow-up job; one row per batch of this run."""
        rows = [(self.contract.name, b["batch_id"], b["rows"], b["rescued"], b["unrecovered"],
                 b["rescued"] / b["rows"] if b["rows"] else 0.0) for b in self.batches.values()]
        return self.spark.createDataFrame(rows, BATCH_METRICS_SCHEMA)

    def summary(self, status: str, duration: float, error: str | None = None) -> LoadResult:
        done = list(self.batches.values())
        rows = sum(b["rows"] for b in done)
        return LoadResult(self.contract.name, status, len(done), rows, rows,
                          sum(b["rescued"] for b in done), sum(b["unrecovered"] for b in done),
                          duration_secs=duration, error=error)

    def run(self, raise_on_failure: bool = True) -> LoadResult:
        """Run to the end of what has landed. A failure is raised, or with
        ``raise_on_failure=False`` returned as a FAILED result with the
        batches written before it."""
        t0 = time.time()
        try:
            q = self.start()
            q.awaitTermination()
        except Exception as e:
            if raise_on_failure:
                raise
            return self.summary(FAILED, time.time() - t0, str(e))
        res = self.summary(SUCCESS, time.time() - t0)
        if self.totals and self.table.exists(self.spark):
            try:
                r = self.table.read(self.spark)
                tot = r.agg(*count_exprs(r)).collect()[0]
                res.rows_total, res.rows_rescued = int(tot["rows_total"]), int(tot["rows_rescued"])
            except Exception as e:   # the load stands; its counts are unknown
                res.rows_total, res.rows_rescued = -1, -1
                res.error = f"table totals could not be counted: {e}"
        return res


def load_table(spark: SparkSession, contract: TableContract, source_root: str, table_root: str,
               checkpoint_root: str, **kw) -> LandingLoad:
    parts = (BATCH_ID,) + ((contract.partition,) if contract.partition else ())
    ptypes = {contract.partition: contract.types[contract.partition]} \
        if contract.partition and contract.partition in contract.types else {}
    return LandingLoad(spark=spark, contract=contract,
                       source=f"{source_root.rstrip('/')}/{contract.folder}",
                       table=ParquetTable(f"{table_root.rstrip('/')}/{contract.name}", parts, ptypes),
                       checkpoint=f"{checkpoint_root.rstrip('/')}/{contract.name}", **kw)


def _run_one(ld: LandingLoad) -> LoadResult:
    """One load to its end, without table totals (they are counted together)."""
    started = time.time()
    try:
        ld.start().awaitTermination()
        return ld.summary(SUCCESS, time.time() - started)
    except Exception as e:  # a missing folder raises at start
        return ld.summary(FAILED, time.time() - started, str(e))


def run_all(spark: SparkSession, loads: Sequence[LandingLoad] | Mapping[str, TableContract],
            source_root: str | None = None, table_root: str | None = None,
            checkpoint_root: str | None = None, raise_on_failure: bool = True,
            log_table: ParquetTable | None = None, task_name: str = "bronze_landing",
            parallel: int = 16, run_id: str | None = None, resume: str | None = None, **kw) -> DataFrame:
    """One query per load, up to ``parallel`` of them at once. A load
    that fails, at start or while running, is reported FAILED and the others
    go on. Table totals come from one unioned job. Raises at the end naming
    the failed tables, unless told not to.

    With ``log_table`` the run's state is logged as it goes: a STARTED row for each
    table at the beginning, a metric or error row as each table ends, and alerts at the
    end. ``resume`` names an earlier run in that log: of its loads only those
    that have not ended in SUCCESS are started, under the same run id; the others are
    SKIPPED. Loads that share a table's name are all started unless each of them succeeded.

    Results are one row per load in the order given, also where two loads
    share a contract. Two loads that share a target or a checkpoint would
    overwrite each other and are refused before any starts.

    ``loads`` is a list of prepared ``LandingLoad``s, or contracts to build
    them from under the three roots."""
    if isinstance(loads, Mapping):
        loads = [load_table(spark, c, source_root, table_root, checkpoint_root, **kw)
                 for c in loads.values()]
    loads = list(loads)
    for what, of in (("target", lambda ld: ld.table.path), ("checkpoint", lambda ld: ld.checkpoint)):
        paths = [of(ld).rstrip("/") for ld in loads]
        twice = sorted({p for p in paths if paths.count(p) > 1})
        if twice:
            raise ValueError(f"several loads have the {what} {twice}")
    if resume is not None and log_table is None:
        raise ValueError("a run is resumed from the log it was kept in: pass log_table")
    run_id = resume or run_id or str(uuid.uuid4())
    names = [ld.contract.name for ld in loads]
    done = _succeeded(spark, log_table, run_id) if resume is not None else {}
    skip = {n for n in set(names) if done.get(n, 0) >= names.count(n)}
    todo = [n for n in dict.fromkeys(names) if n not in skip]
    if log_table is not None and todo:
        append_log(log_table, lifecycle_rows(spark, todo, task_name, run_id, STARTED))
    appending = threading.Lock()

    def one(ld: LandingLoad) -> LoadResult:
        if ld.contract.name in skip:
            return LoadResult(ld.contract.name, SKIPPED)
        res = _run_one(ld)
        if log_table is not None:
            with appending:         # a row as each table ends, so that a run that dies can be resumed
                append_log(log_table, log_rows(spark.createDataFrame([res.as_row()], LOAD_RESULT_SCHEMA), None,
                                               task_name, run_id))
        return res
    with ThreadPoolExecutor(max_workers=max(1, parallel)) as pool:
        ordered = list(pool.map(one, loads))
    ok = [k for k, r in enumerate(ordered) if r.status in (SUCCESS, SKIPPED) and loads[k].totals
          and loads[k].table.exists(spark)]
    if ok:
        try:
            parts = []
            for k in ok:
                r = loads[k].table.read(spark)
                parts.append(r.agg(*count_exprs(r)).select(F.lit(k).alias("k"), "*"))
            for row in reduce(DataFrame.unionByName, parts).collect():
                ordered[row["k"]].rows_total = int(row["rows_total"])
                ordered[row["k"]].rows_rescued = int(row["rows_rescued"])
        except Exception as e:       # loads stand; their table counts are unknown
            for k in ok:
                ordered[k].rows_total, ordered[k].rows_rescued = -1, -1
                ordered[k].error = f"table totals could not be counted: {e}"
    out = spark.createDataFrame([r.as_row() for r in ordered], LOAD_RESULT_SCHEMA)
    if log_table is not None and todo:      # W22: alerts, one append per run
        ran = out.filter(F.col("status") != SKIPPED)
        alerts = log_rows(ran.limit(0), threshold_alerts(ran, ["table_name"]), task_name, run_id)
        append_log(log_table, alerts)
    failed = [r.table_name for r in ordered if r.status == FAILED]
    if failed and raise_on_failure:
        raise RuntimeError(f"landing failed for: {failed}")
    return out


def _succeeded(spark: SparkSession, log_table: ParquetTable, run_id: str) -> dict[str, int]:
    """How many loads of each table ended in SUCCESS in a run (a row a table)."""
    if not log_table.exists(spark):
        return {}
    log = log_table.read(spark).filter((F.col("run_id") == run_id) & (F.col("log_level") == LEVEL_METRIC)
                                       & (F.col("status") == SUCCESS))
    return {r["table_name"]: r["count"] for r in log.groupBy("table_name").count().collect()}
