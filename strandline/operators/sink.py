"""Path-based Parquet tables: read (W5), batch-idempotent append with
schema evolution (W21), dynamic overwrite of touched partitions.

A table is a folder of Parquet files partitioned by ``_batch_id`` and then
by the contract's partition column. Writing a batch is a dynamic partition
overwrite of ``_batch_id=N``, so a micro-batch replayed after a failure
replaces itself instead of appending twice.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strandline.functions.columns import BATCH_ID, capture, col, to_type
from strandline.functions.lattice import relaxed, widened


def _missing_path(e: Exception) -> bool:
    text = str(e)
    return "PATH_NOT_FOUND" in text or "Path does not exist" in text or "UNABLE_TO_INFER_SCHEMA" in text


class ReplacementPending(RuntimeError):
    """Partitions of the table are being replaced, or a replacement was cut
    short: a read could miss rows."""


@dataclass
class ParquetTable:
    path: str
    partition_cols: tuple[str, ...] = (BATCH_ID,)
    partition_types: dict = field(default_factory=dict)
    # the table's schema once known: later reads pass it instead of merging
    # every footer again; our own writes keep it current
    _schema: T.StructType | None = field(default=None, repr=False, compare=False)
    _empty: bool = field(default=False, repr=False, compare=False)   # probed: no data yet

    # -- read ---------------------------------------------------------------
    def read(self, spark: SparkSession) -> DataFrame:
        """The whole table, by the schema kept beside it; columns added by
        later batches are NULL in older files. A table without a kept schema
        (written by others) has its footers merged once, and partition
        columns get their declared types (``_batch_id`` is a long).

        The files are listed here, at once. No replacement may be pending
        before or after the listing, and none may have happened meanwhile; so the
        rows are those before or after a replacement, or the read fails
        (``ReplacementPending``; ``finish_stage`` completes one that was cut short)."""
        return self._guarded(spark, lambda: self._read(spark))

    def _guarded(self, spark: SparkSession, listing) -> DataFrame:
        for _ in range(3):
            before = self._state(spark)
            if before[0] == "replace":
                raise ReplacementPending(f"partitions of {self.path} are being replaced (stage {before[1]}); "
                                         "read again later, or call finish_stage if that job has ended")
            df = listing()
            if self._state(spark) == before:
                return df
        raise ReplacementPending(f"partitions of {self.path} were replaced during each attempt to list its files")

    def _read(self, spark: SparkSession) -> DataFrame:
        if self._schema is None:
            self._schema = self._kept_schema(spark)
        if self._schema is not None:
            return spark.read.schema(self._schema).parquet(self.path)
        # Partition values come back as their folder text (no guessing of
        # dates or numbers, which would read '001' as 1), then get the
        # declared types; the setting is restored right after the listing.
        key = "spark.sql.sources.partitionColumnTypeInference.enabled"
        before = spark.conf.get(key, "true")
        spark.conf.set(key, "false")
        try:
            df = spark.read.option("mergeSchema", "true").parquet(self.path)
        finally:
            spark.conf.set(key, before)
        fixes = {BATCH_ID: T.LongType(), **{k: to_type(v) for k, v in self.partition_types.items()}}
        out = []
        for f in df.schema.fields:
            want = fixes.get(f.name)
            out.append(col(f.name).cast(want).alias(f.name) if want is not None and want != f.dataType
                       else col(f.name))
        df = df.select(*out)
        self._schema = df.schema
        return df

    def read_batch(self, spark: SparkSession, batch_id: int) -> DataFrame:
        """One batch of the table; only its own folder is listed."""
        path = f"{self.path}/{BATCH_ID}={int(batch_id)}"
        r = spark.read.option("basePath", self.path)
        if self._schema is None:
            self.read(spark)
        return self._guarded(spark, lambda: r.schema(self._schema).parquet(path))

    def refresh(self) -> None:
        """Forget the remembered schema (another of our writers changed the
        table; it keeps the schema beside it up to date)."""
        self._schema = None

    @property
    def _schema_path(self) -> str:
        return f"{self.path}/_schema"

    def _kept_schema(self, spark: SparkSession) -> T.StructType | None:
        try:
            row = spark.read.schema("value string").text(self._schema_path, wholetext=True).first()
        except AnalysisException as e:
            if not _missing_path(e):
                raise
            return None
        return T.StructType.fromJson(json.loads(row["value"])) if row and row["value"] else None

    def _keep_schema(self, df: DataFrame) -> None:
        """Keep the schema that ``df`` brings beside the table, before its data
        is written: a column that no file has yet is read as NULL. Only for
        tables whose schema is known to be complete (new, or kept already)."""
        spark = df.sparkSession
        old = self._schema or self._kept_schema(spark)
        if old is None and not self._empty and self.exists(spark):
            return
        self._schema = old
        self._empty = old is None
        self._remember(df)
        if self._schema != old:
            (spark.createDataFrame([(self._schema.json(),)], "value string").coalesce(1)
             .write.mode("overwrite").text(self._schema_path))

    def _layout(self, schema: T.StructType) -> T.StructType:
        """The schema a read returns for files written from ``schema``:
        data columns, then partition columns with their declared types
        (undeclared ones are read back as their folder text)."""
        fixes = {BATCH_ID: T.LongType(), **{k: to_type(v) for k, v in self.partition_types.items()}}
        by_name = {f.name: f for f in schema.fields}
        data = [f for f in schema.fields if f.name not in self.partition_cols]
        parts = [T.StructField(c, fixes.get(c, T.StringType()), True)
                 for c in self.partition_cols if c in by_name]
        return T.StructType(data + parts)

    def _remember(self, df: DataFrame) -> None:
        if self._schema is None:
            if self._empty:     # first write into a new table: its schema is this one
                self._schema, self._empty = self._layout(df.schema), False
            return              # otherwise learnt from the files on the next read
        self._schema = evolved(self._schema, df.schema, self.partition_cols)

    def exists(self, spark: SparkSession) -> bool:
        """Whether the table has data. Looks for the commit marker our writes
        leave at the root first (one file, no listing of the table); only a
        folder without it is listed."""
        if self._schema is not None:
            return True
        for probe in (lambda: spark.read.text(f"{self.path}/_SUCCESS"),
                      lambda: spark.read.parquet(self.path).schema):
            try:
                probe()
                return True
            except AnalysisException as e:
                if not _missing_path(e):
                    raise
        self._empty = True
        return False

    def as_view(self, spark: SparkSession, name: str) -> DataFrame:
        """W5 by name: the table as a temporary view for SQL users."""
        df = self.read(spark)
        df.createOrReplaceTempView(name)
        return df

    def schema(self, spark: SparkSession) -> T.StructType | None:
        return self.read(spark).schema if self.exists(spark) else None

    # -- write --------------------------------------------------------------
    def _writer(self, df: DataFrame, mode: str):
        w = df.write.mode(mode)
        if mode == "overwrite":
            w = w.option("partitionOverwriteMode", "dynamic")
        cols = [c for c in self.partition_cols if c in df.columns]
        if cols:
            w = w.partitionBy(*cols)
        return w

    def write_batch(self, df: DataFrame, batch_id: int | None = None) -> None:
        """Replace the batch's partition (dynamic overwrite). With a
        ``batch_id`` the column is set here; otherwise ``df`` carries it."""
        if batch_id is not None:
            df = df.withColumn(BATCH_ID, F.lit(int(batch_id)).cast(T.LongType()))
        if BATCH_ID not in df.columns or BATCH_ID not in self.partition_cols:
            # without the batch partition an overwrite would replace the table
            raise ValueError(f"{BATCH_ID} must be a column and a partition column to write "
                             "a batch idempotently")
        self._keep_schema(df)
        self._writer(df, "overwrite").parquet(self.path)

    def append(self, df: DataFrame) -> None:
        """Plain append (run log and other tables without batch replay)."""
        self._keep_schema(df)
        self._writer(df, "append").parquet(self.path)

    def overwrite_partitions(self, df: DataFrame) -> None:
        """Rewrite exactly the partitions present in ``df`` (dynamic mode);
        ``df`` must hold all rows of each of them and must not be read from
        them (``replace_partitions`` is for that)."""
        self._keep_schema(df)
        self._writer(df, "overwrite").parquet(self.path)

    # -- replacing partitions by what is read from them ---------------------
    # Folders that begin with "_" and are no partition are not part of a read.
    @property
    def _pointer(self) -> str:
        return f"{self.path}/_stage/pointer"

    def _point(self, spark: SparkSession, stage: str, state: str) -> None:
        # the folder's names say it all, so that a reader needs no job
        (spark.createDataFrame([(stage, state, 1)], "stage string, state string, x int").coalesce(1)
         .write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("state", "stage")
         .json(self._pointer))

    def _state(self, spark: SparkSession) -> tuple[str | None, str | None]:
        """(state, stage) of the last replacement, from a listing of file names."""
        try:
            names = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
                     .option("pathGlobFilter", "part-*").load(self._pointer).inputFiles())
        except AnalysisException as e:
            if not _missing_path(e):
                raise
            return None, None
        found = [dict(x.split("=", 1) for x in n.split("/") if "=" in x) for n in names]
        found = [(f["state"], f["stage"]) for f in found if "state" in f and "stage" in f]
        return found[0] if found else (None, None)

    def summary(self, df: DataFrame, **sums) -> tuple[DataFrame, dict]:
        """A small frame about the table, written beside it and read back, with
        aggregates that are taken while it is written."""
        path = f"{self.path}/_stage/summary-{uuid.uuid4().hex[:12]}"
        obs = Observation(f"summary_{uuid.uuid4().hex[:8]}")
        df.observe(obs, *[e.alias(k) for k, e in sums.items()]).write.parquet(path)
        return df.sparkSession.read.schema(df.schema).parquet(path), obs.get

    def replace_partitions(self, df: DataFrame) -> None:
        """Replace the partitions present in ``df`` by its rows, where ``df``
        is read from these partitions.

        The rows are first written to a stage folder in full; only when that
        write is committed, and a pointer says so, are partitions replaced
        from the stage. Whatever stops in between, either the table or the
        committed stage holds every row, and ``finish_stage`` completes it.
        """
        spark = df.sparkSession
        stage = uuid.uuid4().hex[:12]
        self._keep_schema(df)
        self._writer(df, "overwrite").parquet(f"{self.path}/_stage/{stage}")
        self._point(spark, stage, "replace")
        self._apply(spark, stage, df.schema)

    def _apply(self, spark: SparkSession, stage: str, schema: T.StructType) -> None:
        path = f"{self.path}/_stage/{stage}"
        layout = self._layout(schema)
        self._writer(spark.read.schema(layout).parquet(path), "overwrite").parquet(self.path)
        self._point(spark, stage, "done")
        # the stage's files are no longer needed: an empty frame takes their place
        spark.createDataFrame([], layout).write.mode("overwrite").parquet(path)

    def finish_stage(self, spark: SparkSession) -> bool:
        """Complete a replacement that was cut short after its stage was
        committed; whether there was one."""
        state, stage = self._state(spark)
        if state != "replace":
            return False
        files = spark.read.option("mergeSchema", "true").parquet(f"{self.path}/_stage/{stage}")
        self._apply(spark, stage, files.schema)
        self.refresh()
        return True


def evolved(table: T.StructType, batch: T.StructType, partition_cols=()) -> T.StructType:
    """The table's schema after a batch: new columns follow the data columns,
    and a column takes the batch's type where older files can be read by it
    (new struct fields, wider numbers). Partition columns stay last."""
    new = {f.name: f.dataType for f in batch.fields}

    def grown(f: T.StructField) -> T.StructField:
        if f.name in partition_cols or f.name not in new:
            return f
        t = widened(relaxed(f.dataType), relaxed(new[f.name]))
        return f if t == relaxed(f.dataType) else T.StructField(f.name, t, True)
    known = {f.name for f in table.fields}
    data = [grown(f) for f in table.fields if f.name not in partition_cols]
    extra = [f for f in batch.fields if f.name not in known]
    return T.StructType(data + extra + [f for f in table.fields if f.name in partition_cols])


def align_to_table(df: DataFrame, table_schema: T.StructType | None) -> DataFrame:
    """Keep a column already in the table at the table's type, widened where
    older files can be read so (``evolved``), so that one schema reads all
    files. A value that does not fit that type is captured into the rescued
    column (see ``capture``), never just nulled. All-NULL columns of no type
    take the table's type (or string)."""
    if table_schema is None:
        return df
    types = {f.name: f.dataType for f in table_schema.fields}
    fixed = df.select(*[col(f.name).cast(types.get(f.name, T.StringType())).alias(f.name)
                        if f.dataType == T.NullType() else col(f.name) for f in df.schema.fields])
    target = {f.name: widened(relaxed(types[f.name]), relaxed(f.dataType)) for f in fixed.schema.fields if f.name in types}
    differing = {n: t for n, t in target.items() if t != relaxed(fixed.schema[n].dataType)}
    return capture(fixed, differing) if differing else fixed
