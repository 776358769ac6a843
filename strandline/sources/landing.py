"""Landing folders: new-file discovery (W1), schema grouping from Parquet
footers (W2), evolution (W3) and rescue capture (W4).

Only file paths reach the driver, never rows: footers are read on the
executors in ``mapInPandas``; each group of files with one schema is read
by one ``spark.read.parquet`` and lined up with the target types; the
groups are unioned by name.
"""

from __future__ import annotations

import json
from typing import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strandline.functions.columns import RESCUED, SOURCE_FILE, capture, to_type
from strandline.functions.lattice import join_columns, relaxed, widened

BINARY_FILE_SCHEMA = T.StructType([
    T.StructField("path", T.StringType()),
    T.StructField("modificationTime", T.TimestampType()),
    T.StructField("length", T.LongType()),
    T.StructField("content", T.BinaryType()),
])


# A file older than ``maxFileAge`` (relative to the newest file seen) is
# skipped by the file stream source after its first batch; Spark's default of
# 7 days would silently drop back-filled files. Keep it beyond any real age
# (the seen-file map then grows with the files seen: ~100-200 MB of driver
# memory per million files), and keep the folder small with
# ``clean_source`` ("archive" or "delete").
DEFAULT_MAX_FILE_AGE = "36500d"


def _file_stream(reader, glob, max_files_per_trigger, max_bytes_per_trigger, max_file_age, clean_source, archive_dir):
    r = reader.option("pathGlobFilter", glob).option("maxFileAge", max_file_age)
    if max_bytes_per_trigger:       # Spark takes one of the two limits
        r = r.option("maxBytesPerTrigger", str(max_bytes_per_trigger))
    elif max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    if clean_source:
        r = r.option("cleanSource", clean_source)
        if archive_dir:
            r = r.option("sourceArchiveDir", archive_dir)
    return r


def discover_stream(spark: SparkSession, folder: str, glob: str = "*.parquet",
                    max_files_per_trigger: int | None = None,
                    max_file_age: str = DEFAULT_MAX_FILE_AGE, clean_source: str | None = None,
                    archive_dir: str | None = None, max_bytes_per_trigger: int | None = None) -> DataFrame:
    """A stream of files not seen before under ``folder``: ``path``,
    ``length``. The content column is pruned from the scan."""
    r = _file_stream(spark.readStream.format("binaryFile").schema(BINARY_FILE_SCHEMA), glob,
                     max_files_per_trigger, max_bytes_per_trigger, max_file_age, clean_source, archive_dir)
    return r.load(folder).select("path", "length")


def parquet_stream(spark: SparkSession, folder: str, schema: T.StructType,
                   glob: str = "*.parquet", max_files_per_trigger: int | None = None,
                   max_file_age: str = DEFAULT_MAX_FILE_AGE, clean_source: str | None = None,
                   archive_dir: str | None = None, max_bytes_per_trigger: int | None = None) -> DataFrame:
    """W1 for a folder whose files share one schema: a Parquet stream with
    the source file selected on the scan (W7)."""
    r = _file_stream(spark.readStream.schema(schema), glob, max_files_per_trigger, max_bytes_per_trigger,
                     max_file_age, clean_source, archive_dir)
    df = r.parquet(folder)
    return with_source_file(df)


def with_source_file(df: DataFrame) -> DataFrame:
    """W7 on the scan: ``_source_file`` from file metadata (replacing a column
    of that name the files may already carry)."""
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c != SOURCE_FILE],
                     F.col("_metadata.file_path").alias(SOURCE_FILE))


def infer_schema(spark: SparkSession, folder: str, glob: str = "*.parquet") -> T.StructType:
    """Schema of all files in ``folder`` (their footers merged), so a column
    that only some of them have is not left behind."""
    return (spark.read.option("mergeSchema", "true").option("pathGlobFilter", glob)
            .parquet(folder).schema)


# ---------------------------------------------------------------------------
# W2 footers
# ---------------------------------------------------------------------------

def schema_groups(files: DataFrame) -> list[list[str]]:
    """Group file paths so each group can be read as one: footers are read
    on the executors; what comes back is each path with a short hash of its
    schema, and each distinct schema once. Schemas without a conflict (of
    types, or of names that differ in case only, at any depth) share a group."""
    def footer_keys(batches):
        # defined here so it travels to executors by value, without needing
        # this package installed there
        import hashlib
        import json

        import pandas as pd
        import pyarrow as pa
        import pyarrow.fs as pafs
        import pyarrow.parquet as pq

        def parts(at, t):
            """(address, type) of a column and of every part of a nested one."""
            if pa.types.is_struct(t):
                inner = [(f.name, f.type) for f in t]
            elif pa.types.is_list(t) or pa.types.is_large_list(t):
                inner = [("[]", t.value_type)]
            elif pa.types.is_map(t):
                inner = [("{}", t.key_type), ("{}=", t.item_type)]
            else:
                return [[at, str(t)]]
            own = [[at, type(t).__name__]]
            return own + [x for name, u in inner for x in parts([*at, name], u)]

        opened: dict = {}       # one file system of a scheme and host per task
        said = set()
        for pdf in batches:
            keys, texts = [], []
            for p in pdf["path"]:
                uri = "file://" + p[5:] if p.startswith("file:") and not p.startswith("file://") else p
                if uri.startswith(("s3a://", "s3n://")):
                    uri = "s3://" + uri.split("://", 1)[1]
                where = uri.split("://", 1)[0] + "://" + uri.split("://", 1)[-1].split("/", 1)[0]
                if where not in opened:
                    opened[where], rel = pafs.FileSystem.from_uri(uri)
                else:
                    rel = pafs.FileSystem.from_uri(uri)[1] if not uri.startswith("file:") else uri[7:]
                sch = pq.read_schema(rel, filesystem=opened[where])
                text = json.dumps([x for f in sch for x in parts([f.name], f.type)])
                key = hashlib.md5(text.encode()).hexdigest()
                keys.append(key)
                texts.append(None if key in said else text)     # a schema once per task
                said.add(key)
            yield pd.DataFrame({"path": pdf["path"], "schema_key": keys, "schema_text": texts})

    keyed = files.select("path").mapInPandas(footer_keys, "path string, schema_key string, schema_text string")
    # The driver needs the paths anyway (one read per group); collecting the
    # pairs avoids gathering a dominant schema's paths in a single task.
    by_key: dict[str, list[str]] = {}
    schema_of: dict[str, str] = {}
    for r in keyed.collect():
        by_key.setdefault(r["schema_key"], []).append(r["path"])
        if r["schema_text"]:
            schema_of[r["schema_key"]] = r["schema_text"]
    # Schemas that only add or omit columns share one read (footers merged
    # by Spark); only a type conflict on a shared name needs its own group.
    # This keeps the number of reads, and the union, small even when every
    # file brings a different extra column.
    groups: list[tuple[dict, list[str]]] = []
    for key in sorted(by_key, key=lambda k: min(by_key[k])):
        types = {tuple(x.lower() for x in at): (at, t) for at, t in json.loads(schema_of[key])}
        for g_types, g_paths in groups:
            if all(g_types.get(n, t) == t for n, t in types.items()):
                g_types.update(types)
                g_paths.extend(by_key[key])
                break
        else:
            groups.append((dict(types), list(by_key[key])))
    return sorted((sorted(p) for _, p in groups), key=lambda g: g[0])


def resolve_types(declared: Mapping[str, object], table: T.StructType | None,
                  seen: Iterable[T.StructType], evolve: bool = True) -> dict[str, object]:
    """Target type per column: declared by the contract; else the type
    already in the table, widened where its files can be read so (new
    fields of structs are taken, ints grow to longs, see ``lattice.widened``);
    else the least type that holds all seen ones (``lattice.join_columns``). None of it
    depends on the order of ``seen``. Without evolution the table's types
    stay and a column new to it maps to ``None`` (its text is rescued)."""
    out: dict[str, object] = {}
    have = {f.name: f.dataType for f in table.fields} if table is not None else {}
    for f in join_columns([relaxed(s) for s in seen]).fields:
        if f.name == RESCUED:
            continue
        if f.name in declared:
            out[f.name] = to_type(declared[f.name])
        elif f.name in have:
            out[f.name] = widened(relaxed(have[f.name]), f.dataType) if evolve else have[f.name]
        elif table is not None and not evolve:
            out[f.name] = None
        else:
            out[f.name] = f.dataType
    return out


def read_landing(spark: SparkSession, groups: list[list[str]], declared: Mapping[str, object],
                 table: T.StructType | None = None, evolve: bool = True,
                 lineage: bool = True, info: dict | None = None,
                 seen: T.StructType | None = None) -> DataFrame | None:
    """Read each schema group, capture misfits against the resolved
    types, and union by name (a column missing from a group is NULL).
    ``info["incoming_rescued"]`` tells whether any file brought its own
    rescued column. ``seen``: the joined schema of these and of other files that land
    with them, so that all their batches take the same types."""
    if not groups:
        return None
    reads = [spark.read.option("mergeSchema", "true").parquet(*paths) for paths in groups]
    if info is not None:
        info["incoming_rescued"] = any(RESCUED in r.columns for r in reads)
    if lineage:
        reads = [with_source_file(r) for r in reads]
    reads = one_spelling(spark, reads, [*declared, *(table.names if table is not None else [])])
    target = resolve_types(declared, table, [r.schema for r in reads], evolve)
    if seen is not None:
        wide = resolve_types(declared, table, [seen], evolve)
        by_name = {n.lower(): n for n in wide}
        target = {n: wide.get(by_name.get(n.lower()), t) for n, t in target.items()}
    # columns in the target's order, which no order of files changes
    aligned = [_ordered(capture(r, target), target) for r in reads]
    out = aligned[0]
    for nxt in aligned[1:]:
        out = out.unionByName(nxt, allowMissingColumns=True)
    return _ordered(out, target)


def _ordered(df: DataFrame, target: Mapping[str, object]) -> DataFrame:
    first = [c for c in target if c in df.columns and c != SOURCE_FILE]
    rest = sorted(c for c in df.columns if c not in first)
    return df.select(*[F.col(f"`{c}`") for c in [*first, *rest]])


def one_spelling(spark: SparkSession, reads: list[DataFrame], first: Iterable[str]) -> list[DataFrame]:
    """Columns whose names differ in case only are one column (unless the
    session is case-sensitive), spelt as in ``first`` or else by the least spelling."""
    if spark.conf.get("spark.sql.caseSensitive", "false") == "true":
        return reads
    spelt: dict[str, str] = {}
    for name in [*first, RESCUED, SOURCE_FILE, *sorted(c for r in reads for c in r.columns)]:
        spelt.setdefault(name.lower(), name)
    return [r.select(*[F.col(f"`{c}`").alias(spelt[c.lower()]) for c in r.columns]) for r in reads]


def land_files(spark: SparkSession, paths: list[str], declared: Mapping[str, object],
               table: T.StructType | None = None, evolve: bool = True) -> DataFrame | None:
    """Batch form of W1-W4 over an explicit file list (paths are grouped by
    footer schema on the executors)."""
    if not paths:
        return None
    files = spark.createDataFrame([(p,) for p in paths], "path string")
    return read_landing(spark, schema_groups(files), declared, table, evolve)


def list_files(spark: SparkSession, folder: str, glob: str = "*.parquet") -> DataFrame:
    """All files under ``folder`` as (path, length), content pruned."""
    return (spark.read.format("binaryFile").option("pathGlobFilter", glob)
            .option("recursiveFileLookup", "true").load(folder).select("path", "length"))


def land_folder(spark: SparkSession, folder: str, declared: Mapping[str, object],
                table: T.StructType | None = None, evolve: bool = True,
                glob: str = "*.parquet") -> DataFrame | None:
    """Batch landing of a whole folder with mixed file schemas."""
    return read_landing(spark, schema_groups(list_files(spark, folder, glob)), declared, table, evolve)
