"""Helpers shared by the text operators."""

from __future__ import annotations

import sys
import uuid

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.operators.repair import key_filter, may_match
from strandline.session import checkpoint_dir

#: The white space that separates words, and a word.
SPACE_CLASS = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def words(text: Column) -> Column:
    """The words of a text, in order; none for null or blank text."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), f"{SPACE_CLASS}+"), lambda w: w != "")


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def fresh(name: str, taken) -> str:
    """``name``, lengthened until no column in ``taken`` is called so."""
    low = {c.lower() for c in taken}
    while name.lower() in low:
        name += "_"
    return name


def scratch(spark: SparkSession, label: str) -> str:
    """A new path in the folder that all executors share."""
    return f"{checkpoint_dir(spark)}/llm/{label}-{uuid.uuid4().hex[:12]}"


def filesystem(uri: str):
    """(file system, path) of a folder's URI, for code in tasks."""
    import pyarrow.fs as pafs
    if uri.startswith("file:") or "://" not in uri:
        return pafs.LocalFileSystem(), "/" + uri.removeprefix("file:").lstrip("/")
    return pafs.FileSystem.from_uri(uri)


def slices(batch, column: str | int, size: int):
    """An Arrow batch in slices of consecutive rows whose ``column`` (strings) takes about
    ``size`` bytes, so that what is made of a slice is sent before the next one is read."""
    import pyarrow.compute as pc
    length = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
    at = held = 0
    for k, n in enumerate(length):
        held += n
        if held >= size:
            yield batch.slice(at, k + 1 - at)
            at, held = k + 1, 0
    if at < len(length):
        yield batch.slice(at)


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared folder and read back: cuts the lineage,
    survives lost executors, and gives later plans its true size."""
    spark = df.sparkSession
    path = scratch(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def maybe_in(rows: DataFrame, key: str, need: DataFrame, need_key: str, flag: str) -> DataFrame:
    """Adds boolean ``flag``: false only if a row's ``key`` (a long, not null) is not among ``need_key``
    of ``need``, told by a bitmap of bounded size, so rows without a match need no shuffle."""
    return may_match(rows, key, key_filter(need, need_key), flag)


def may_be_in(rows: DataFrame, need: DataFrame, key: str) -> DataFrame:
    """The rows whose ``key`` may be in ``need``, before a join with it."""
    flag = fresh("may_be_in", rows.columns)
    return maybe_in(rows, key, need, key, flag).filter(F.col(flag)).drop(flag)


def _stars(e: DataFrame) -> bool:
    """Whether each u has one v and no v is a u: all v are roots."""
    ends = e.select("u", F.lit(1).alias("out"), F.lit(0).alias("root")).unionByName(
        e.select(F.col("v").alias("u"), F.lit(0).alias("out"), F.lit(1).alias("root")))
    return (ends.groupBy("u").agg(F.sum("out").alias("out"), F.max("root").alias("root"))
            .filter("out > 1 OR (out = 1 AND root = 1)").isEmpty())


def components(edges: DataFrame, label: str = "components") -> DataFrame:
    """Distributed union-find: edges (a, b) of one orderable type -> rows
    (id, component) for every id in an edge between different ids, with the
    smallest id reachable.

    Alternating large-star and small-star steps, each a minimum by key
    (partial aggregation) and a join on that key, so an id with very many
    neighbours costs one row per task in the aggregate and is split by the
    skew join. Null ids and loops take no part.
    """
    e = stored(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
               .filter(F.col("a").isNotNull() & F.col("b").isNotNull() & (F.col("a") != F.col("b")))
               .distinct(), label)
    while not _stars(e):
        both = e.select("u", "v").unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.join(low, "u").filter(F.col("v") > F.col("u"))
                 .select(F.col("v").alias("u"), F.col("m").alias("v")))
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(least, "u").filter(F.col("v") != F.col("m"))
                 .select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(least.select("u", F.col("m").alias("v"))).distinct())
        e = stored(small, label)
    roots = e.select(F.col("v").alias("u"), "v").distinct()
    return e.select("u", "v").unionByName(roots).toDF("id", "component")


cloudpickle.register_pickle_by_value(sys.modules[__name__])     # executors need no install
