"""W1/W2 in batch: a ledger of the files of a folder, landed in bounded batches.

A run lists the folder, anti-joins the listing with the files of earlier plans
and writes what is new as a plan: a table of (path, length, batch). Batches are
packed on executors, each of at most so many files and bytes (a file larger than
that is a batch of its own). Only one batch's paths at a time reach the driver,
whatever the number of files.

A plan is stored before anything is landed, and batches keep their numbers: a
batch that was cut short is landed again under its number and replaces itself.
The types of a plan's undeclared columns are joined over all its files, on
executors, before the first batch, so they do not depend on which files
come first.

    <path>/plans/plan=N   path, length, batch
    <path>/log            plan, batch (NULL: the plan stands), schema
"""

from __future__ import annotations

import sys
from dataclasses import dataclass

from pyspark import cloudpickle
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strandline.functions import lattice

LOG = "plan long, batch long, batches long, schema string"
FAN_IN = 64             # schemas joined by one task of the tree


# ---------------------------------------------------------------------------
# One schema of many footers
# ---------------------------------------------------------------------------

def footer_schema(metadata) -> T.StructType:
    """The schema that Spark gives a Parquet file: from the description that
    Spark left in it, else from its columns."""
    import json

    import pyarrow as pa
    kept = (metadata.metadata or {}).get(b"org.apache.spark.sql.parquet.row.metadata")
    if kept:
        return T.StructType.fromJson(json.loads(kept))
    leaves = iter([metadata.schema.column(i).physical_type for i in range(len(metadata.schema))])

    def one(t):
        if pa.types.is_struct(t):
            return T.StructType([T.StructField(f.name, one(f.type)) for f in t])
        if pa.types.is_map(t):
            return T.MapType(one(t.key_type), one(t.item_type))
        if pa.types.is_list(t) or pa.types.is_large_list(t):
            return T.ArrayType(one(t.value_type))
        physical = next(leaves)
        if pa.types.is_decimal(t):
            return T.DecimalType(t.precision, t.scale)
        if pa.types.is_timestamp(t):
            return T.TimestampType() if t.tz or physical == "INT96" else T.TimestampNTZType()
        plain = {"bool": T.BooleanType(), "int8": T.ByteType(), "int16": T.ShortType(), "int32": T.IntegerType(),
                 "int64": T.LongType(), "uint8": T.ShortType(), "uint16": T.IntegerType(), "uint32": T.LongType(),
                 "uint64": T.DecimalType(20, 0), "float": T.FloatType(), "double": T.DoubleType(),
                 "date32[day]": T.DateType(), "binary": T.BinaryType(), "large_binary": T.BinaryType()}
        return plain.get(str(t), T.StringType())
    return T.StructType([T.StructField(f.name, one(f.type)) for f in metadata.schema.to_arrow_schema()])


def open_footer(path: str, opened: dict):
    """The footer of the file at a URI; ``opened`` keeps a file system for each
    scheme and host."""
    import pyarrow.fs as pafs
    import pyarrow.parquet as pq
    uri = "file://" + path[5:] if path.startswith("file:") and not path.startswith("file://") else path
    if uri.startswith(("s3a://", "s3n://")):
        uri = "s3://" + uri.split("://", 1)[1]
    where = "://".join((uri.split("://", 1)[0], uri.split("://", 1)[-1].split("/", 1)[0]))
    fs, rel = pafs.FileSystem.from_uri(uri) if where not in opened or not uri.startswith("file:") \
        else (opened[where], uri[7:])
    return pq.read_metadata(opened.setdefault(where, fs).open_input_file(rel))


def joined_schema(files: DataFrame) -> T.StructType | None:
    """The least schema that holds all files: each task joins the footers it
    reads, tasks join their results in a tree, and the driver joins the last few."""
    def read(batches):
        import pandas as pd
        opened, own = {}, None
        for pdf in batches:
            got = [lattice.relaxed(footer_schema(open_footer(p, opened))) for p in pdf["path"]]
            got = got if own is None else [own, *got]
            own = lattice.join_columns(got) if got else own
        yield pd.DataFrame({"schema": [] if own is None else [own.json()]}, dtype="string")

    def meet(batches):
        import json

        import pandas as pd
        from pyspark.sql import types
        own = None
        for pdf in batches:
            got = [types.StructType.fromJson(json.loads(s)) for s in pdf["schema"]]
            got = got if own is None else [own, *got]
            own = lattice.join_columns(got) if got else own
        yield pd.DataFrame({"schema": [] if own is None else [own.json()]}, dtype="string")

    import json
    level = files.select("path").mapInPandas(read, "schema string")
    tasks = int(files.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    while tasks > FAN_IN:
        tasks = -(-tasks // FAN_IN)
        level = level.repartition(tasks, F.xxhash64("schema")).mapInPandas(meet, "schema string")
    got = [T.StructType.fromJson(json.loads(r["schema"])) for r in level.collect()]
    return lattice.join_columns(got) if got else None


# ---------------------------------------------------------------------------
# The ledger
# ---------------------------------------------------------------------------

@dataclass
class FolderLedger:
    path: str
    max_files: int = 10_000
    max_bytes: int = 1 << 40

    def _log(self, spark: SparkSession) -> DataFrame:
        try:
            return spark.read.schema(LOG).json(f"{self.path}/log")
        except AnalysisException as e:
            if "PATH_NOT_FOUND" not in str(e) and "Path does not exist" not in str(e):
                raise
            return spark.createDataFrame([], LOG)

    def _note(self, spark: SparkSession, plan: int, batch=None, batches=None, schema=None) -> None:
        spark.createDataFrame([(plan, batch, batches, schema)], LOG).coalesce(1).write.mode("append").json(f"{self.path}/log")

    def _plan(self, spark: SparkSession, plan: int) -> DataFrame:
        return spark.read.schema("path string, length long, batch long").parquet(f"{self.path}/plans/plan={plan}")

    def plans(self, spark: SparkSession) -> list[int]:
        """The plans that stand (a row each)."""
        return sorted(r["plan"] for r in self._log(spark).filter("batch IS NULL").select("plan").distinct().collect())

    def seen(self, spark: SparkSession) -> DataFrame | None:
        """The paths of all plans."""
        at = [f"{self.path}/plans/plan={n}" for n in self.plans(spark)]
        return spark.read.schema("path string").parquet(*at) if at else None

    def plan(self, files: DataFrame, first: int = 0) -> int | None:
        """Plan the files (path, length) that no plan has; the plan's number, or
        None where nothing is new. Its batches are numbered from ``first`` or from after
        the batches of earlier plans."""
        spark = files.sparkSession
        seen = self.seen(spark)
        new = files.select("path", F.col("length").cast("long").alias("length")).dropDuplicates(["path"])
        if seen is not None:
            new = new.join(seen.withColumnRenamed("path", "old"), F.col("path") == F.col("old"), "left_anti")
        new = new.persist()
        try:
            n = new.count()
            if not n:
                return None
            top = self._log(spark).agg(F.max("batches")).first()[0]
            number = max([-1, *self.plans(spark)]) + 1
            start = max(first, top or 0)
            buckets = -(-n // self.max_files)
            most, size = self.max_files, self.max_bytes

            def pack(pdf):
                """A bucket's files in order of their paths, cut into batches."""
                pdf = pdf.sort_values("path")
                part, held, total, out = 0, 0, 0, []
                for length in pdf["length"].fillna(0):
                    if held and (held >= most or total + length > size):
                        part, held, total = part + 1, 0, 0
                    held, total = held + 1, total + length
                    out.append(part)
                pdf["batch"] = [start + b + buckets * p for b, p in zip(pdf["bucket"], out)]
                return pdf[["path", "length", "batch"]]
            # a bucket holds about ``max_files`` files, so its packing is one small task
            packed = (new.withColumn("bucket", F.pmod(F.xxhash64("path"), F.lit(buckets)))
                      .groupBy("bucket").applyInPandas(pack, "path string, length long, batch long"))
            packed.write.mode("overwrite").parquet(f"{self.path}/plans/plan={number}")
            schema = joined_schema(self._plan(spark, number))
            end = self._plan(spark, number).agg(F.max("batch")).first()[0] + 1
            self._note(spark, number, batches=end, schema=schema.json() if schema else None)
            return number
        finally:
            new.unpersist()

    def pending(self, spark: SparkSession) -> list[tuple[int, int]]:
        """(plan, batch) of batches not landed yet, in order (a row a batch)."""
        log = self._log(spark)
        landed = {(r["plan"], r["batch"]) for r in log.filter("batch IS NOT NULL").select("plan", "batch").collect()}
        out = []
        for n in self.plans(spark):
            every = sorted(r["batch"] for r in self._plan(spark, n).select("batch").distinct().collect())
            out += [(n, b) for b in every if (n, b) not in landed]
        return out

    def files(self, spark: SparkSession, plan: int, batch: int) -> DataFrame:
        return self._plan(spark, plan).filter(F.col("batch") == batch).select("path", "length")

    def schema(self, spark: SparkSession, plan: int) -> T.StructType | None:
        import json
        row = self._log(spark).filter((F.col("plan") == plan) & F.col("batch").isNull()).select("schema").first()
        return T.StructType.fromJson(json.loads(row["schema"])) if row and row["schema"] else None

    def landed(self, spark: SparkSession, plan: int, batch: int) -> None:
        self._note(spark, plan, batch)


for _module in (lattice, sys.modules[__name__]):        # executors need no install
    cloudpickle.register_pickle_by_value(_module)
