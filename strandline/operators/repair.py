"""Repair of stored rows.

* ``self_repair``: rows still carrying rescued values get them back from
  their own JSON. A narrow projection: no join, no shuffle.
* ``update_by_key``: matched rows that are rescued take a source's columns.
  Only rescued rows with a key go through the join; everything else passes
  around it, so neither the healthy majority nor a NULL-key pile is shuffled.
* ``repair_table``: runs either one on a stored table, rewriting only the
  partitions in which it changes rows, by way of a committed stage; counts
  come from the probe and from the write itself.
"""

from __future__ import annotations

import time
from dataclasses import dataclass, replace
from functools import reduce
from typing import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strandline.contracts import TableContract
from strandline.functions.columns import RESCUED, _q, col, merge_projection, recover, rescued_filter
from strandline.operators.metrics import FAILED, SKIPPED, SUCCESS, observed
from strandline.operators.sink import ParquetTable


def repair_guard(key: str, rescued_col: str = RESCUED) -> Column:
    """Rows a repair may touch: rescued, with a key (NULL keys never match)."""
    return col(rescued_col).isNotNull() & col(key).isNotNull()


def self_repair(df: DataFrame, key: str, types: Mapping[str, object],
                residual: str = "keep", rescued_col: str = RESCUED) -> DataFrame:
    """W11 + W12 + W15: recover ``types`` columns from each row's own rescued
    JSON where the row is rescued and has a key; other rows are unchanged.
    ``residual="keep"`` removes only recovered entries, ``"clear"`` empties
    the rescued value as the update-by-key form does."""
    return recover(df, types, residual=residual, rescued_col=rescued_col,
                   guard=repair_guard(key, rescued_col))


def repair_source(df: DataFrame, key: str, types: Mapping[str, object],
                  residual: str = "clear", rescued_col: str = RESCUED) -> DataFrame:
    """W10 + W11 + W12 + W13: rescued rows, recovered, projected to key +
    columns + rescued value: the source of an update by key."""
    fixed = recover(rescued_filter(df, rescued_col), types, residual=residual,
                    rescued_col=rescued_col)
    return merge_projection(fixed, key, list(types), rescued_col)


#: A key is hot when it holds at least this share of the rows to update, so
#: there are at most HOT_PARTS hot keys whatever the table's size; each is
#: dealt over SALTS tasks.
HOT_PARTS = 1000
SALTS = 64


def hot_keys(candidates: DataFrame, key: str, parts: int = HOT_PARTS) -> DataFrame:
    """Keys (column ``k``) holding at least one in ``parts`` of the rows: at
    most ``parts`` rows, from a partial aggregation by key."""
    counts = candidates.groupBy(col(key).alias("k")).agg(F.count(F.lit(1)).alias("n"))
    total = candidates.agg(F.count(F.lit(1))).scalar()
    return counts.filter((F.col("n") > 1) & (F.col("n") * parts >= total)).select("k")


#: Bits of the filter of source keys: at most 8 MB travel, whatever the source. With n
#: keys a row without a match passes with a probability of 1 - exp(-n / BITS).
BITS = 1 << 26
_BUCKET, _BITMAP, _MAYBE = "__sl_bucket", "__sl_bitmap", "__sl_maybe"


def key_filter(source: DataFrame, key: str, bits: int = BITS) -> DataFrame:
    """The hashed keys of ``source`` as bitmaps (a row for each 32,768 bits,
    merged from partial bitmaps): at most ``bits`` / 8 bytes."""
    h = F.pmod(F.xxhash64(col(key)), F.lit(bits)) + 1
    return (source.filter(col(key).isNotNull())
            .groupBy(F.bitmap_bucket_number(h).alias(_BUCKET))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position(h)).alias(_BITMAP)))


def may_match(rows: DataFrame, key: str, bitmaps: DataFrame, flag: str, bits: int = BITS) -> DataFrame:
    """Adds boolean ``flag``: whether the row's key may be one of those in
    ``bitmaps`` (a broadcast of bounded size, no shuffle of the rows)."""
    h = F.pmod(F.xxhash64(col(key)), F.lit(bits)) + 1
    at = F.bitmap_bit_position(h)
    byte = F.conv(F.hex(F.substring(F.col(_BITMAP), (at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    bit = F.call_function("shiftright", byte, (at % 8).cast("int")).bitwiseAND(F.lit(1)) == 1
    joined = rows.withColumn(_BUCKET, F.when(col(key).isNotNull(), F.bitmap_bucket_number(h))) \
        .join(F.broadcast(bitmaps), _BUCKET, "left")
    return joined.select(*[col(c) for c in rows.columns], F.coalesce(bit, F.lit(False)).alias(flag))


def _filterable(target: DataFrame, source: DataFrame, key: str) -> bool:
    """Whether equal keys of both sides have equal hashes."""
    t = target.schema[key].dataType
    return t == source.schema[key].dataType and not isinstance(t, (T.FloatType, T.DoubleType, T.DecimalType))


def update_by_key(target: DataFrame, source: DataFrame, key: str, columns: Sequence[str],
                  rescued_col: str = RESCUED, parts: int = HOT_PARTS, hot: DataFrame | None = None,
                  bits: int = BITS) -> DataFrame:
    """Target rows with ``key`` equal to a source row's and a rescued
    value take the source's ``columns`` and rescued value (NULL if the source
    has none). Nothing is inserted or deleted; NULL keys never match.
    Result has the target's columns, in the target's order.

    The source is aggregated by key (partial aggregation first, so a hot key
    costs one row per task), keeping a row count; a repeated source key that
    meets a rescued target row fails the job, since its new value would be
    ambiguous. Only the target's rescued rows whose key passes a filter of the
    source's keys (``key_filter``) enter the join; the rest bypass it. The join
    is always on (key, salt): rows of a hot key are dealt over ``SALTS`` salts
    by a hash of the row and its one source row is copied to each; every other
    row has salt 0. ``hot``: the hot keys (column ``k``, at most ``parts``), if known.
    """
    guard = F.coalesce(repair_guard(key, rescued_col), F.lit(False))
    if _filterable(target, source, key):
        flagged = may_match(target, key, key_filter(source, key, bits), _MAYBE, bits)
        untouched = flagged.filter(~(guard & F.col(_MAYBE))).drop(_MAYBE)
        candidates = flagged.filter(guard & F.col(_MAYBE)).drop(_MAYBE)
    else:
        untouched, candidates = target.filter(~guard), target.filter(guard)
    src_cols = [c for c in columns if c != key]
    # Only a source that brings its own rescued column carries it through the
    # aggregate (a string buffer makes Spark sort instead of hash);
    # otherwise matched rows get NULL after the join.
    has_rescued = rescued_col in source.columns
    src = (source.filter(col(key).isNotNull())
           .groupBy(col(key).alias(key))
           .agg(F.count(F.lit(1)).alias("__n"),
                *[F.first(col(c)).alias(f"__src_{c}") for c in src_cols],
                *([F.first(col(rescued_col)).alias("__src_rescued")] if has_rescued else [])))
    hot = hot_keys(candidates, key, parts) if hot is None else hot
    hot = F.broadcast(hot.withColumnRenamed("k", "__hot"))     # at most ``parts`` rows
    spread = F.pmod(F.xxhash64(*[col(c) for c in target.columns
                                 if not isinstance(target.schema[c].dataType, T.MapType)]), F.lit(SALTS))
    salted = (candidates.join(hot, col(key) == F.col("__hot"), "left")
              .withColumn("__salt", F.when(F.col("__hot").isNotNull(), spread).otherwise(F.lit(0).cast("long")))
              .drop("__hot"))
    copies = F.when(F.col("__hot").isNotNull(), F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))) \
        .otherwise(F.array(F.lit(0).cast("long")))
    src = src.join(hot, col(key) == F.col("__hot"), "left").withColumn("__salt", F.explode(copies)).drop("__hot")
    joined = salted.join(src, on=[key, "__salt"], how="left")
    n = F.col("__n")
    m = F.when(n > 1, F.raise_error(F.concat(F.lit(f"DUPLICATE_SOURCE_KEY: {key}="),
                                             col(key).cast("string")))).otherwise(n.isNotNull())
    out = []
    for f in target.schema.fields:
        if f.name in src_cols:
            out.append(F.when(m, F.col(f"__src_{f.name}").cast(f.dataType)).otherwise(col(f.name))
                       .alias(f.name))
        elif f.name == rescued_col:
            new = F.col("__src_rescued") if has_rescued else F.lit(None).cast(T.StringType())
            out.append(F.when(m, new).otherwise(col(f.name)).alias(f.name))
        else:
            out.append(col(f.name))
    return untouched.unionByName(joined.select(*out))


# ---------------------------------------------------------------------------
# Table-level repair (W15 / W14 with W18)
# ---------------------------------------------------------------------------

@dataclass
class RepairResult:
    table_name: str
    rows_rescued_before: int
    rows_rescued_after: int
    rows_repaired: int
    duration_secs: float
    status: str
    error: str | None = None

    def as_row(self) -> tuple:
        return (self.table_name, self.rows_rescued_before, self.rows_rescued_after,
                self.rows_repaired, self.duration_secs, self.status, self.error)


REPAIR_RESULT_SCHEMA = T.StructType([
    T.StructField("table_name", T.StringType()),
    T.StructField("rows_rescued_before", T.LongType()),
    T.StructField("rows_rescued_after", T.LongType()),
    T.StructField("rows_repaired", T.LongType()),
    T.StructField("duration_secs", T.DoubleType()),
    T.StructField("status", T.StringType()),
    T.StructField("error", T.StringType()),
])


_BEFORE, _CHANGED = "__sl_before", "__sl_changed"


def changed_by(transform: Callable[[DataFrame], DataFrame], columns: Sequence[str],
               rescued_col: str = RESCUED) -> Callable[[DataFrame], DataFrame]:
    """Marks the rescued rows that a narrow ``transform`` would change. Only
    ``columns`` (those it reads or writes) are compared, so only they are
    read."""
    def mark(rows: DataFrame) -> DataFrame:
        have = [c for c in dict.fromkeys([*columns, rescued_col]) if c in rows.columns]
        snap = F.struct(*[col(c).alias(c) for c in have])
        probe = transform(rows.withColumn(_BEFORE, snap))
        changed = ~F.struct(*[col(c).alias(c) for c in have]).eqNullSafe(F.col(_BEFORE))
        for c in probe.columns:        # a column the repair creates
            if c not in rows.columns and c != _BEFORE:
                changed = changed | col(c).isNotNull()
        return probe.withColumn(_CHANGED, changed)
    return mark


def _sums() -> dict[str, Column]:
    """Sums over the partitions, taken while their summary is written: rescued
    rows, those in partitions without a change, changing rows."""
    n, changed = F.col("__n"), F.col("__changed")
    return {"before": F.sum(n), "kept": F.sum(F.when(changed == 0, n).otherwise(0)), "changes": F.sum(changed)}


def changed_stats(mark: Callable[[DataFrame], DataFrame]) -> Callable[..., tuple[DataFrame, dict]]:
    """Job 1 of a narrow repair: the partitions' rescued and changing rows."""
    def job(table: ParquetTable, rescued: DataFrame, parts: Sequence[str]) -> tuple[DataFrame, dict]:
        stats = (mark(rescued).groupBy(*[col(c) for c in parts])
                 .agg(F.count(F.lit(1)).alias("__n"), F.count_if(F.col(_CHANGED)).alias("__changed")))
        return table.summary(stats, **_sums())
    return job


class KeyUpdate:
    """The two jobs of an update by key on a stored table.

    Job 1 aggregates the rescued rows by (partition, key) before it meets the
    source's keys, so a key with a third of all rows is a few rows there; rows
    whose key the filter rules out are aggregated by partition alone. What it
    finds also names the hot keys of job 2.
    """

    def __init__(self, source: DataFrame, key: str, columns: Sequence[str], rescued_col: str = RESCUED,
                 parts: int = HOT_PARTS, bits: int = BITS):
        self.source, self.key, self.columns = source, key, columns
        self.rescued_col, self.parts, self.bits, self.hot = rescued_col, parts, bits, None

    def stats(self, table: ParquetTable, rescued: DataFrame, parts: Sequence[str]) -> tuple[DataFrame, dict]:
        key = self.key
        rows = rescued.select(*[col(c) for c in parts], col(key).alias("__k"))
        if _filterable(rescued, self.source, key):
            bitmaps = key_filter(self.source, key, self.bits)
            rows = may_match(rows, "__k", bitmaps, _MAYBE, self.bits) \
                .withColumn("__k", F.when(F.col(_MAYBE), F.col("__k"))).drop(_MAYBE)
        counts = rows.groupBy(*[col(c) for c in parts], "__k").agg(F.count(F.lit(1)).alias("__n"))
        keys = self.source.select(col(key).alias("__s")).filter(F.col("__s").isNotNull()).distinct()
        met = counts.join(keys, F.col("__k") == F.col("__s"), "left")
        met = met.withColumn("__changed", F.when(F.col("__s").isNotNull(), F.col("__n")).otherwise(F.lit(0).cast("long")))
        found, got = table.summary(met.select(*[col(c) for c in parts], "__k", "__n", "__changed"), changed=F.sum("__changed"))
        total = int(got["changed"] or 0)
        self.hot = (found.filter("__changed > 0").groupBy(F.col("__k").alias("k")).agg(F.sum("__n").alias("n"))
                    .filter((F.col("n") > 1) & (F.col("n") * self.parts >= F.lit(total))).select("k"))
        stats = found.groupBy(*[col(c) for c in parts]).agg(F.sum("__n").alias("__n"), F.sum("__changed").alias("__changed"))
        return table.summary(stats, **_sums())

    def transform(self, scope: DataFrame) -> DataFrame:
        return update_by_key(scope, self.source, self.key, self.columns, self.rescued_col, self.parts, self.hot, self.bits)


def _same_partition(a: str, b: str, parts: Sequence[str]) -> Column:
    """Equality of partition values, null to null, as plain equalities of the
    partition columns: Spark prunes folders by these, not by ``<=>``."""
    def value(side: str, c: str) -> Column:
        return F.coalesce(F.col(f"{side}.{_q(c)}").cast("string"), F.lit("\0"))
    return reduce(lambda x, y: x & y, [value(a, c) == value(b, c) for c in parts])


def repair_table(spark: SparkSession, table: ParquetTable, name: str,
                 transform: Callable[[DataFrame], DataFrame],
                 stats: Callable[..., tuple[DataFrame, dict]], reads: Sequence[str],
                 rescued_col: str = RESCUED) -> RepairResult:
    """Apply ``transform`` (a DataFrame -> DataFrame repair) to the partitions
    of ``table`` where it changes rows, and write them back in place.

    Job 1 reads only rescued rows (``IsNotNull`` pushed to the scan) and of
    them only the columns in ``reads``; ``stats(table, rescued, partition
    columns)`` says how many rows of each partition would change. Its
    summary, a row for each partition with rescued rows, is written beside
    the table, not collected; its sums are taken on the way. Job 2 reads exactly the partitions with
    changes (a semi join with the summary, which prunes the other folders),
    writes them repaired into a stage folder and counts rescued rows in
    flight; job 3 replaces the partitions from the stage. A stage whose
    replacing was cut short is finished first (``ParquetTable.finish_stage``).
    Partitions without changes keep their files, and a repair that can
    recover nothing writes nothing.
    """
    t0 = time.time()
    try:
        table.finish_stage(spark)
        df = table.read(spark)
        if rescued_col not in df.columns:
            return RepairResult(name, 0, 0, 0, time.time() - t0, SKIPPED)
        parts = [c for c in table.partition_cols if c in df.columns]
        if not parts:
            raise ValueError("in-place repair needs a partitioned table")
        need = [c for c in dict.fromkeys([*parts, *reads, rescued_col]) if c in df.columns]
        rescued = df.filter(col(rescued_col).isNotNull()).select(*[col(c) for c in need])
        found, sums = stats(table, rescued, parts)
        before, kept, changes = (int(sums[k] or 0) for k in ("before", "kept", "changes"))
        if before == 0:
            return RepairResult(name, 0, 0, 0, time.time() - t0, SKIPPED)
        if changes == 0:
            return RepairResult(name, before, before, 0, time.time() - t0, SUCCESS)
        todo = found.filter(F.col("__changed") > 0)
        scope = df.alias("a").join(todo.alias("b"), _same_partition("a", "b", parts), "left_semi")
        fixed, obs = observed(transform(scope), rescued_col=rescued_col)
        table.replace_partitions(fixed)
        after = int(obs.get["rescued"]) + kept
        return RepairResult(name, before, after, before - after, time.time() - t0, SUCCESS)
    except Exception as e:  # a failed repair is reported, like a failed load
        return RepairResult(name, -1, -1, 0, time.time() - t0, FAILED, str(e))


def self_repair_table(spark: SparkSession, table: ParquetTable, contract: TableContract,
                      columns: Sequence[str] | None = None, residual: str = "keep",
                      rescued_col: str = RESCUED) -> RepairResult:
    """W15 on a stored table. ``columns`` empty means the contract's rescued
    columns (or, if it has none, every declared column). A column stored
    with a type other than the contract's is recovered into the stored
    type, so the table's files keep one schema."""
    try:
        table.finish_stage(spark)
        cols = [c for c in (columns or contract.rescued or list(contract.types)) if c]
        have = {f.name: f.dataType for f in table.read(spark).schema.fields} \
            if table.exists(spark) else {}
        types = {c: have.get(c, contract.type_of(c)) for c in cols}
    except Exception as e:
        return RepairResult(contract.name, -1, -1, 0, 0.0, FAILED, str(e))

    def fix(d: DataFrame) -> DataFrame:
        return self_repair(d, contract.key, types, residual, rescued_col)
    reads = [contract.key, *types]
    return repair_table(spark, table, contract.name, fix, changed_stats(changed_by(fix, reads, rescued_col)), reads,
                        rescued_col)


def update_table_by_key(spark: SparkSession, table: ParquetTable, name: str, key: str,
                        source: DataFrame, columns: Sequence[str],
                        rescued_col: str = RESCUED) -> RepairResult:
    """W14 on a stored table: rewrite only partitions in which a rescued row
    meets a source row. A repeated source key that meets a rescued row fails
    the write job before anything is committed, and the repair is reported
    FAILED."""
    job = KeyUpdate(source, key, columns, rescued_col)
    return repair_table(spark, table, name, job.transform, job.stats, [key], rescued_col)


def repair_results(spark: SparkSession, results: Sequence[RepairResult]) -> DataFrame:
    return spark.createDataFrame([r.as_row() for r in results], REPAIR_RESULT_SCHEMA)


# ---------------------------------------------------------------------------
# W25 worklist
# ---------------------------------------------------------------------------

def repair_worklist(spark: SparkSession, tables: Mapping[str, DataFrame],
                    contracts: Mapping[str, TableContract],
                    rescued_col: str = RESCUED) -> DataFrame:
    """Tables with rescued rows, each with its key and comma-joined columns:
    the items a per-table repair takes. One aggregate per table, unioned
    into one job; the contract list is a small, bounded lookup."""
    counts = []
    for name, df in tables.items():
        n = (F.count(col(rescued_col)) if rescued_col in df.columns
             else F.lit(0).cast(T.LongType()))
        counts.append(df.agg(n.alias("rows_rescued")).select(F.lit(name).alias("table_name"),
                                                             "rows_rescued"))
    if not counts:
        return spark.createDataFrame([], "table_name string, primary_key string, "
                                         "rescued_cols string, rows_rescued long")
    all_counts = reduce(DataFrame.unionByName, counts)
    items = spark.createDataFrame(
        [(n, c.key, ",".join(c.rescued or tuple(c.types))) for n, c in contracts.items()],
        "table_name string, primary_key string, rescued_cols string")
    return (all_counts.filter(F.col("rows_rescued") > 0)
            .join(F.broadcast(items), "table_name")
            .select("table_name", "primary_key", "rescued_cols", "rows_rescued"))


# ---------------------------------------------------------------------------
# Per-item repair (the worklist's consumer)
# ---------------------------------------------------------------------------

def parse_item(item) -> tuple[str, str, list[str]]:
    """A worklist item (dict, Row or JSON text) as (table, key, columns).
    An empty column list means the contract's columns."""
    import json
    if isinstance(item, str):
        item = json.loads(item)
    elif hasattr(item, "asDict"):
        item = item.asDict()
    cols = [c.strip() for c in (item.get("rescued_cols") or "").split(",") if c.strip()]
    return item["table"] if "table" in item else item["table_name"], item["primary_key"], cols


def repair_items(spark: SparkSession, items, tables: Mapping[str, ParquetTable],
                 contracts: Mapping[str, TableContract], residual: str = "keep",
                 parallel: int = 4, log_table: ParquetTable | None = None,
                 task_name: str = "bronze_repair") -> DataFrame:
    """Repair each worklist item's table in place. Items are different
    tables, so up to ``parallel`` repairs run at once (each is its own set
    of distributed jobs); a failing table does not stop the rest. ``items``
    is a worklist DataFrame (one row per table, a bounded list) or a list.
    Results keep the items' order; with ``log_table`` they are also
    appended to the run log (metric rows, and warnings where rescued rows
    remain)."""
    from concurrent.futures import ThreadPoolExecutor

    rows = items.collect() if isinstance(items, DataFrame) else list(items)

    def one(it) -> RepairResult:
        name = str(it)
        try:
            name, key, cols = parse_item(it)
            return self_repair_table(spark, tables[name], replace(contracts[name], key=key), cols or None, residual)
        except KeyError as e:
            return RepairResult(name, -1, -1, 0, 0.0, FAILED, f"unknown table or missing field: {e}")
        except Exception as e:
            return RepairResult(name, -1, -1, 0, 0.0, FAILED, str(e))

    with ThreadPoolExecutor(max_workers=max(1, parallel)) as pool:
        results = list(pool.map(one, rows))
    out = repair_results(spark, results)
    if log_table is not None:   # W22: one append per run
        from strandline.operators.metrics import append_log, repair_log_rows
        append_log(log_table, repair_log_rows(out, task_name))
    return out
