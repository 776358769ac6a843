"""The driver query set: one function (spark, sf_dir) -> DataFrame per
work item, each with an equivalent DuckDB query over the given tables.

Queries that land or repair write into a fresh folder under the session's
checkpoint folder and return a DataFrame that reads the result back, so the
returned rows come from what was stored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.contracts import TableContract
from strandline.functions.columns import (RESCUED, SOURCE_FILE, capture, cast_to_contract,
                                          lineage, recover, rescued_filter)
from strandline.operators.census import census_worklist, rescue_census
from strandline.operators.metrics import (log_rows, run_metrics, table_counts,
                                          threshold_alerts)
from strandline.operators.repair import (repair_items, repair_results, repair_source,
                                         repair_worklist, self_repair_table, update_table_by_key)
from strandline.operators.sink import ParquetTable
from strandline.plans.fixtures import (CUSTOMER, EVENTS, LINEITEM, ORDERS, PLAN_CONTRACTS,
                                       dirty_orders, events_flagship_landing, events_landing,
                                       null_keys, table, write_drop)
from strandline.session import work_root
from strandline.sources.inventory import source_inventory
from strandline.sources.landing import land_folder, list_files
from strandline.sources.ledger import FolderLedger
from strandline.streaming.loads import LOAD_RESULT_SCHEMA, LandingLoad, run_all

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def _load(spark, contract, source, root, mode="discover", glob="*.parquet", parts=None, **kw):
    return LandingLoad(spark=spark, contract=contract, source=source,
                       table=ParquetTable(f"{root}/table_{contract.name}",
                                          parts or ("_batch_id",)),
                       checkpoint=f"{root}/chk_{contract.name}", mode=mode, glob=glob, **kw)


def _stored_dirty(spark, sf_dir, root, with_null_keys=False) -> ParquetTable:
    """dirty(orders) stored as a table, in two batches (even / odd keys)."""
    t = ParquetTable(f"{root}/orders_dirty")
    t.exists(spark)
    d = dirty_orders(table(spark, sf_dir, "orders"))
    if with_null_keys:
        d = null_keys(d)
    t.write_batch(d.filter(F.col("o_orderkey") % 2 == 0), 0)
    t.write_batch(d.filter(~(F.col("o_orderkey") % 2 == 0) | F.col("o_orderkey").isNull()), 1)
    return t


# ---------------------------------------------------------------------------
# Flagship: stream, lineage, capture, recover, cast, write, self-repair
# ---------------------------------------------------------------------------

def landing_flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = work_root(spark, "landing_flagship")
    write_drop(events_flagship_landing(table(spark, sf_dir, "events")), f"{root}/landing/events")
    ld = _load(spark, EVENTS, f"{root}/landing/events", root)
    ld.run()
    self_repair_table(spark, ld.table, EVENTS, residual="keep")
    return ld.table.read(spark).select("event_id", "user_id", "event_type", "value", RESCUED)


# ---------------------------------------------------------------------------
# Scans, streams, sinks
# ---------------------------------------------------------------------------

def incremental_ingest(spark, sf_dir):
    root = work_root(spark, "incremental_ingest")
    ld = _load(spark, EVENTS, sf_dir, root, mode="parquet", glob="events.parquet")
    ld.run()
    return ld.table.read(spark).select("event_id", "user_id", "event_type", "value")


def replay_idempotent(spark, sf_dir):
    """The stream loads events; batch 0 is then delivered again (as after a
    failure between write and commit). The table must not grow."""
    root = work_root(spark, "replay_idempotent")
    ld = _load(spark, EVENTS, sf_dir, root, mode="parquet", glob="events.parquet")
    ld.run()
    again = (spark.read.option("pathGlobFilter", "events.parquet").parquet(sf_dir)
             .select("*", F.col("_metadata.file_path").alias(SOURCE_FILE)))
    ld.process_batch(again, 0)
    return ld.table.read(spark).agg(F.count(F.lit(1)).alias("row_count"),
                                    F.count_distinct("_batch_id").alias("batches"))


def source_lineage(spark, sf_dir):
    df = lineage(spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet"))
    name = F.element_at(F.split(F.col(SOURCE_FILE), "/"), -1)
    return df.groupBy(name.alias("source_file")).agg(F.count(F.lit(1)).alias("row_count"))


def schema_evolution(spark, sf_dir):
    """Two drops: even keys without ``o_orderpriority``, then odd keys with
    it. The second run adds the column; old rows read it as NULL."""
    root = work_root(spark, "schema_evolution")
    o = table(spark, sf_dir, "orders")
    src = f"{root}/landing/orders"
    ld = _load(spark, ORDERS, src, root)
    write_drop(o.filter(F.col("o_orderkey") % 2 == 0).select("o_orderkey", "o_totalprice"), src)
    ld.run()
    write_drop(o.filter(F.col("o_orderkey") % 2 == 1)
               .select("o_orderkey", "o_totalprice", "o_orderpriority"), src)
    ld.run()
    return ld.table.read(spark).select("o_orderkey", "o_orderpriority")


def rescue_capture(spark, sf_dir):
    """``o_orderpriority`` declared bigint: even keys send its first
    character (fits), odd keys the whole text (rescued)."""
    root = work_root(spark, "rescue_capture")
    o = table(spark, sf_dir, "orders")
    p = F.col("o_orderpriority")
    write_drop(o.select("o_orderkey", F.when(F.col("o_orderkey") % 2 == 0, F.substring(p, 1, 1))
                        .otherwise(p).alias("o_orderpriority")), f"{root}/landing")
    c = ORDERS.with_types(o_orderpriority="long")
    ld = _load(spark, c, f"{root}/landing", root)
    ld.run()
    return ld.table.read(spark).select("o_orderkey", "o_orderpriority", RESCUED)


def capture_fractional(spark, sf_dir):
    """W4's fractional rule: lineitem discounts declared bigint. Whole
    values fit; fractional ones are rescued (truncating would lose them)."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_discount")
    out = capture(li, {"l_discount": "long"})
    return out.select("l_orderkey", "l_linenumber", "l_discount",
                      F.col(RESCUED).isNotNull().alias("is_rescued"))


def capture_lossy(spark, sf_dir):
    """W4 for casts that would lose something without failing: quantities
    declared boolean, order keys beyond 2^53 declared double, dates with a
    time of day declared date, prices of three digits declared
    decimal(12,2); and text with more than 18 places or 20 digits declared
    decimal, times without a day and digits beyond microseconds declared timestamp."""
    li = table(spark, sf_dir, "lineitem")
    odd = F.col("l_linenumber") % 2
    key = F.lpad(F.col("l_orderkey").cast("string"), 10, "0")
    d = li.select("l_orderkey", "l_linenumber",
                  (F.col("l_linenumber") % 3).cast("double").alias("flag"),
                  (F.lit(1 << 53) + odd).cast("long").alias("big"),
                  F.timestamp_seconds(F.lit(1704067200) + odd * 3600).alias("day"),
                  (F.round(F.col("l_quantity")).cast("decimal(20,3)") + (odd / 1000).cast("decimal(20,3)"))
                  .cast("decimal(20,3)").alias("price"),
                  F.concat(F.lit("1234567890123"), key, F.when(odd == 1, F.lit(".5")).otherwise(F.lit(".0"))).alias("code"),
                  F.concat(F.lit("0.0000000001"), key, F.when(odd == 1, F.lit("7")).otherwise(F.lit("0"))).alias("rate"),
                  F.when(F.col("l_linenumber") % 3 == 0, F.lit("10:30"))
                  .when(F.col("l_linenumber") % 3 == 1, F.lit("2024-01-02 10:30:00.1234567"))
                  .otherwise(F.lit("2024-01-02 10:30:00.1234560")).alias("at"))
    out = capture(d, {"flag": "boolean", "big": "double", "day": "date", "price": "decimal(12,2)",
                      "code": "decimal(38,0)", "rate": "decimal(22,20)", "at": "timestamp_ntz"})
    has = F.from_json(RESCUED, "map<string,string>")
    return out.select("l_orderkey", "l_linenumber", "flag", F.col("big").cast("long").alias("big"), "day",
                      F.col("price").cast("double").alias("price"), F.col("code").cast("string").alias("code"),
                      F.col("rate").cast("string").alias("rate"), F.date_format("at", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("at"),
                      *[has[c].alias(f"{c}_text") for c in ("code", "rate", "at")],
                      *[F.coalesce(F.map_contains_key(has, c), F.lit(False)).alias(f"{c}_rescued")
                        for c in ("flag", "big", "day", "price")])


def capture_nested(spark, sf_dir):
    """W4 by address: orders with a struct, an array and a map of texts, landed
    under a contract of numbers. Only the parts that do not fit are rescued,
    each under its address; recovered as text the whole value is back."""
    o = table(spark, sf_dir, "orders")
    k, status = F.col("o_orderkey"), F.col("o_orderstatus")
    info = F.struct(F.when(k % 3 == 0, status).otherwise(F.col("o_custkey").cast("string")).alias("c"),
                    F.array(k.cast("string"), F.when(k % 4 == 0, status), F.lit("7")).alias("tags"),
                    F.create_map(status, F.when(k % 5 == 0, F.lit("n/a")).otherwise(F.lit("1.5"))).alias("m"))
    d = o.select("o_orderkey", info.alias("info"))
    wide = d.schema["info"].dataType.simpleString()
    got = capture(d, {"info": "struct<c:bigint,tags:array<bigint>,m:map<string,double>>"})
    back = recover(got.withColumn("kept", F.col("info")), {"info": wide}, residual="keep")
    before = F.to_json(F.struct(F.col("kept.c"), F.col("kept.tags")))
    n = F.size(F.json_object_keys(RESCUED))
    return (back.join(got.select("o_orderkey", F.coalesce(n, F.lit(0)).cast("long").alias("misfits")), "o_orderkey")
            .select("o_orderkey", before.alias("kept"), "misfits", F.col("info.c").alias("c"),
                    F.col("info.tags")[1].alias("tag"), F.element_at("info.m", status_of("info")).alias("m"),
                    F.col(RESCUED).isNotNull().alias("is_rescued")))


def status_of(col):
    """The one key of the map in a struct column."""
    return F.map_keys(F.col(f"{col}.m"))[0]


def nested_evolution(spark, sf_dir):
    """Three drops, one stream run each: orders with a struct and an array of structs, both
    grown by a field, and a column whose name differs in case. New fields
    become columns: of later rows, and NULL of earlier ones; the name is one column."""
    root = work_root(spark, "nested_evolution")
    src = f"{root}/landing/orders"
    o = table(spark, sf_dir, "orders")
    ld = _load(spark, ORDERS, src, root)
    c, s = F.col("o_custkey").alias("c"), F.col("o_orderstatus").alias("s")
    drops = ((F.struct(c).alias("info"), F.array(F.struct(c)).alias("parts")),
             (F.struct(c, s).alias("info"), F.array(F.struct(s, c), F.struct(s, c)).alias("parts")),
             (F.struct(c).alias("INFO"), F.array(F.struct(c)).alias("parts")))
    for k, cols in enumerate(drops):
        write_drop(o.filter(F.col("o_orderkey") % 3 == k).select("o_orderkey", *cols), src)
        ld.run()
    t = ParquetTable(ld.table.path).read(spark)         # as another process reads it
    return t.select("o_orderkey", F.col("info.c").alias("c"), F.col("info.s").alias("s"),
                    F.size("parts").cast("long").alias("n_parts"), F.col("parts")[0]["c"].alias("part_c"),
                    F.element_at("parts", -1)["s"].alias("part_s"), RESCUED)


def arrival_order(spark, sf_dir):
    """Three drops of orders whose undeclared columns differ in type (int,
    long and decimal; date and timestamp; text and number; a struct of other fields), landed
    as one batch under names in either order, and int before long in runs of their own. Each
    gives one schema and one table; the query returns them all."""
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    day = F.to_date(F.col("o_orderdate"))
    kinds = [
        (k.cast("int").alias("n"), day.alias("d"), F.col("o_orderstatus").alias("t"), F.struct(k.alias("a")).alias("s")),
        (k.alias("n"), day.cast("timestamp_ntz").alias("d"), F.col("o_custkey").alias("t"),
         F.struct(F.col("o_orderstatus").alias("b")).alias("s")),
        (F.col("o_totalprice").cast("decimal(12,2)").alias("n"), day.alias("d"), F.lit(True).alias("t"),
         F.struct(k.cast("int").alias("a")).alias("s"))]
    out = None
    for order in ("forward", "backward"):
        root = work_root(spark, f"arrival_{order}")
        for i, cols in enumerate(kinds):
            place = i if order == "forward" else 2 - i
            write_drop(o.filter(k % 3 == i).select("o_orderkey", *cols), f"{root}/landing/drop={place}")
        ld = _load(spark, ORDERS, f"{root}/landing/*", root)
        ld.run()
        t = ParquetTable(ld.table.path).read(spark)
        got = t.select(
            F.lit(order).alias("arrival"), F.lit(",".join(f"{f.name}:{f.dataType.simpleString()}" for f in t.schema.fields[:5]))
            .alias("columns"), "o_orderkey", F.col("n").cast("double").alias("n"), F.col("d").cast("date").alias("d"), "t",
            F.col("s.a").alias("a"), F.col("s.b").alias("b"), RESCUED)
        out = got if out is None else out.unionByName(got)
    for order, first in (("int_first", 0), ("long_first", 1)):
        root = work_root(spark, f"arrival_{order}")
        ld = _load(spark, ORDERS, f"{root}/landing", root)
        for i in (first, 1 - first):
            write_drop(o.filter(k % 3 == i).select("o_orderkey", kinds[i][0]), f"{root}/landing")
            ld.run()
        t = ParquetTable(ld.table.path).read(spark)
        nothing = F.lit(None)
        out = out.unionByName(t.select(
            F.lit(order).alias("arrival"), F.lit(",".join(f"{f.name}:{f.dataType.simpleString()}" for f in t.schema.fields[:2]))
            .alias("columns"), "o_orderkey", F.col("n").cast("double").alias("n"), nothing.cast("date").alias("d"),
            nothing.cast("string").alias("t"), nothing.cast("long").alias("a"), nothing.cast("string").alias("b"), RESCUED))
    return out


def ledger_landing(spark, sf_dir):
    """W1/W2 in batch: orders dropped as two rounds of files whose undeclared
    column differs in type, landed by a ledger in batches of at most three files.
    The first run is cut short after a batch was written; the next takes it up again: its rows are
    there once. A run with nothing new lands nothing."""
    root = work_root(spark, "ledger_landing")
    src = f"{root}/landing"
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    kinds = (k.cast("int"), F.col("o_totalprice"), k)

    def drop(half, files):
        for third, kind in enumerate(kinds):
            write_drop(o.filter((k % 2 == half) & (k % 3 == third)).select("o_orderkey", kind.alias("n")), src, files)
    ld = _load(spark, ORDERS, src, root)
    ledger = FolderLedger(f"{root}/ledger", max_files=3)

    class CutShort(FolderLedger):
        def landed(self, spark, plan, batch):
            raise InterruptedError
    drop(0, 2)
    try:
        ld.run_planned(CutShort(ledger.path, ledger.max_files))
    except InterruptedError:
        pass
    drop(1, 1)
    ld.run_planned(ledger)
    idle = ld.run_planned(ledger)
    t = ParquetTable(ld.table.path).read(spark)
    files = t.groupBy("_batch_id").agg(F.count_distinct(SOURCE_FILE).alias("f")).agg(F.max("f").alias("most"))
    return (t.select("o_orderkey", F.col("n").cast("double").alias("n"),
                     F.lit(idle.rows_read + len(ledger.pending(spark))).cast("long").alias("left"))
            .join(files, F.lit(True)).select("o_orderkey", "n", "left", (F.col("most") <= 3).alias("bounded")))


def evolving_parquet_load(spark, sf_dir):
    """``mode="parquet"``: the second drop brings a column that the first
    has not; it is loaded, and NULL in the rows of the first."""
    root = work_root(spark, "evolving_parquet_load")
    src = f"{root}/landing/orders"
    o = table(spark, sf_dir, "orders")
    ld = _load(spark, ORDERS, src, root, mode="parquet")
    write_drop(o.filter(F.col("o_orderkey") % 2 == 0).select("o_orderkey", "o_totalprice"), src)
    ld.run()
    write_drop(o.filter(F.col("o_orderkey") % 2 == 1).select("o_orderkey", "o_totalprice", "o_orderpriority"), src)
    ld.run()
    return ld.table.read(spark).select("o_orderkey", "o_totalprice", "o_orderpriority")


def mixed_schema_landing(spark, sf_dir):
    """Two file schemas in one folder: ``o_totalprice`` double (even keys) and
    string with 'bad' where the key is a multiple of 5, plus
    ``o_orderpriority`` (odd keys); landed as one table in one batch."""
    root = work_root(spark, "mixed_schema_landing")
    o = table(spark, sf_dir, "orders")
    src = f"{root}/landing/orders"
    write_drop(o.filter(F.col("o_orderkey") % 2 == 0).select("o_orderkey", "o_totalprice"), src)
    odd = o.filter(F.col("o_orderkey") % 2 == 1)
    write_drop(odd.select("o_orderkey",
                          F.when(F.col("o_orderkey") % 5 == 0, F.lit("bad"))
                          .otherwise(F.col("o_totalprice").cast("string")).alias("o_totalprice"),
                          "o_orderpriority"), src)
    ld = _load(spark, ORDERS, src, root)
    ld.run()
    return ld.table.read(spark).select("o_orderkey", "o_totalprice", "o_orderpriority", RESCUED)


def partitioned_append(spark, sf_dir):
    """Two appends to a table partitioned by order year; rows per day."""
    root = work_root(spark, "partitioned_append")
    t = ParquetTable(f"{root}/orders_by_year", ("_batch_id", "order_year"), {"order_year": "int"})
    o = (table(spark, sf_dir, "orders")
         .select("o_orderkey", "o_orderdate", F.year("o_orderdate").alias("order_year")))
    t.write_batch(o.filter(F.col("o_orderkey") % 2 == 0), 0)
    t.write_batch(o.filter(F.col("o_orderkey") % 2 == 1), 1)
    return (t.read(spark).groupBy(F.to_date("o_orderdate").alias("order_date"))
            .agg(F.count(F.lit(1)).alias("row_count")))


# ---------------------------------------------------------------------------
# Projections and scalar work
# ---------------------------------------------------------------------------

def rescue_recover(spark, sf_dir):
    d = dirty_orders(table(spark, sf_dir, "orders"))
    return recover(d, ORDERS.rescued_types()).select("o_orderkey", "o_totalprice")


def json_field(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    return recover(e, {"k": "long"}, rescued_col="props").select("event_id", "k")


def cast_contract(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    as_text = li.select(*[F.col(c).cast("string").alias(c) if c in LINEITEM.types else F.col(c)
                          for c in li.columns])
    return cast_to_contract(as_text, LINEITEM.types).select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus")


def rescued_rows(spark, sf_dir):
    t = _stored_dirty(spark, sf_dir, work_root(spark, "rescued_rows"))
    return rescued_filter(t.read(spark)).select("o_orderkey")


def rescued_count(spark, sf_dir):
    t = _stored_dirty(spark, sf_dir, work_root(spark, "rescued_count"))
    return table_counts(t.read(spark))


# ---------------------------------------------------------------------------
# Repair
# ---------------------------------------------------------------------------

def _self_repair(spark, sf_dir, residual, label):
    t = _stored_dirty(spark, sf_dir, work_root(spark, label), with_null_keys=True)
    res = self_repair_table(spark, t, ORDERS, residual=residual)
    return repair_results(spark, [res]).select("rows_rescued_before", "rows_rescued_after",
                                               "rows_repaired", "status")


def self_repair_keep(spark, sf_dir):
    return _self_repair(spark, sf_dir, "keep", "self_repair_keep")


def self_repair_clear(spark, sf_dir):
    return _self_repair(spark, sf_dir, "clear", "self_repair_clear")


def self_repair_rows(spark, sf_dir):
    """The stored table after a keep-mode repair, run twice (the second run
    must change nothing)."""
    t = _stored_dirty(spark, sf_dir, work_root(spark, "self_repair_rows"), with_null_keys=True)
    self_repair_table(spark, t, ORDERS, residual="keep")
    self_repair_table(spark, t, ORDERS, residual="keep")
    return t.read(spark).select("o_orderkey", "o_custkey", "o_totalprice",
                                F.col(RESCUED).isNotNull().alias("is_rescued"))


def self_repair_partitioned(spark, sf_dir):
    """Self repair of orders stored by (batch, order year). Partitions in
    which nothing can be recovered share their batch and their year with
    partitions that change; their rescued rows count once."""
    t = ParquetTable(f"{work_root(spark, 'self_repair_partitioned')}/orders", ("_batch_id", "order_year"),
                     {"order_year": "int"})
    t.exists(spark)
    o = table(spark, sf_dir, "orders")
    d = dirty_orders(o).withColumn("order_year", F.year("o_orderdate"))
    # batch and year of the same parity: only texts that no repair can use
    d = d.withColumn(RESCUED, F.when(F.col(RESCUED).isNotNull() & (F.col("o_orderkey") % 2 == F.col("order_year") % 2),
                                     F.lit('{"o_totalprice":"N/A"}')).otherwise(F.col(RESCUED)))
    for b in (0, 1):
        t.write_batch(d.filter(F.col("o_orderkey") % 2 == b), b)
    res = self_repair_table(spark, t, ORDERS, residual="keep")
    left = t.read(spark).agg(F.count(F.lit(1)).alias("rows_total"), F.count(RESCUED).alias("rows_left"))
    return (repair_results(spark, [res]).select("rows_rescued_before", "rows_rescued_after", "rows_repaired", "status")
            .withColumn("k", F.lit(1)).join(left.withColumn("k", F.lit(1)), "k").drop("k"))


def repair_by_merge(spark, sf_dir):
    """The join form of the repair: the table's own rescued rows, recovered,
    cleared and projected to key + columns (W10-W13), merged back by key
    (W14). Same answer as ``self_repair_clear``, with a shuffle join."""
    t = _stored_dirty(spark, sf_dir, work_root(spark, "repair_by_merge"), with_null_keys=True)
    src = repair_source(t.read(spark), ORDERS.key, ORDERS.rescued_types(), residual="clear")
    res = update_table_by_key(spark, t, "orders", ORDERS.key, src, list(ORDERS.rescued))
    return repair_results(spark, [res]).select("rows_rescued_before", "rows_rescued_after",
                                               "rows_repaired", "status")


def update_by_key(spark, sf_dir):
    """Corrected rows (keys that are multiples of 3 or 7, price + 1) merged
    into the stored dirty table: only rescued rows take them."""
    t = _stored_dirty(spark, sf_dir, work_root(spark, "update_by_key"))
    o = table(spark, sf_dir, "orders")
    fixes = (o.filter((F.col("o_orderkey") % 3 == 0) | (F.col("o_orderkey") % 7 == 0))
             .select("o_orderkey", (F.col("o_totalprice") + F.lit(1.0)).alias("o_totalprice")))
    update_table_by_key(spark, t, "orders", "o_orderkey", fixes, ["o_totalprice"])
    return t.read(spark).select("o_orderkey", "o_custkey", "o_totalprice", RESCUED)


# ---------------------------------------------------------------------------
# Metrics, alerts, run log
# ---------------------------------------------------------------------------

def _landed_events(spark, sf_dir, label):
    root = work_root(spark, label)
    write_drop(events_landing(table(spark, sf_dir, "events")), f"{root}/landing/events")
    return land_folder(spark, f"{root}/landing/events", EVENTS.types)


def load_metrics(spark, sf_dir):
    """Events landed in two drops (even ids, then odd ids), one stream run
    each, then a third run with nothing new; in the second run its batch is
    delivered twice. Per run and batch the rows and rescued rows observed
    during the writes (a run without a batch as one row of zeros), and
    whether the "too few rows" alert fires."""
    root = work_root(spark, "load_metrics")
    ev = events_landing(table(spark, sf_dir, "events"))
    src = f"{root}/landing/events"
    ld = _load(spark, EVENTS, src, root)
    out = None
    for run, rest in enumerate((0, 1, None)):
        if rest is not None:
            write_drop(ev.filter(F.col("event_id") % 2 == rest), src)
        res = ld.run()
        if rest == 1:       # again, as after a failure between write and commit
            odd = list_files(spark, src).filter(~F.col("path").isin(first))
            ld.process_batch(odd, run)
            res = ld.summary(res.status, res.duration_secs)
        first = [r["path"] for r in list_files(spark, src).select("path").collect()] if rest == 0 else first
        got = ld.batch_metrics().select("batch_id", "rows_read", "rows_rescued", "rows_unrecovered", "rescued_pct")
        if not res.batches:
            got = spark.createDataFrame([(None, 0, 0, 0, 0.0)], got.schema)
        alerts = threshold_alerts(spark.createDataFrame([res.as_row()], LOAD_RESULT_SCHEMA), ["table_name"])
        few = alerts.filter("rule = 'rows_written'").count() == 1
        got = got.select(F.lit(run).cast("long").alias("run"), "*", F.lit(few).alias("few_rows_alert"))
        out = got if out is None else out.unionByName(got)
    return out


def run_metrics_query(spark, sf_dir):
    return run_metrics(_landed_events(spark, sf_dir, "run_metrics"), ["event_type"])


def threshold_alerts_query(spark, sf_dir):
    m = run_metrics(_landed_events(spark, sf_dir, "threshold_alerts"), ["event_type"])
    return threshold_alerts(m, ["event_type"])


def run_log(spark, sf_dir):
    root = work_root(spark, "run_log")
    m = run_metrics(_landed_events(spark, sf_dir, "run_log_src"), ["event_type"]) \
        .withColumnRenamed("event_type", "table_name") \
        .withColumns({"status": F.lit("SUCCESS"), "error": F.lit(None).cast("string")})
    bad = (table(spark, sf_dir, "events").select(F.lit("broken_feed").alias("table_name")).distinct()
           .withColumns({"rows_read": F.lit(0).cast("long"), "rows_rescued": F.lit(0).cast("long"),
                         "rescued_pct": F.lit(0.0), "status": F.lit("FAILED"),
                         "error": F.repeat(F.lit("a long trace "), 500)}))
    m = m.unionByName(bad)
    rows = log_rows(m, threshold_alerts(m, ["table_name"]), task_name="landing_events")
    log = ParquetTable(f"{root}/run_log", ())
    log.append(rows)
    return log.read(spark).select("task_name", "table_name", "log_level", "rows_read",
                                  "rows_rescued", "rescued_pct", "status",
                                  F.length("error_message").cast("long").alias("error_chars"))


# ---------------------------------------------------------------------------
# Multi-table flow
# ---------------------------------------------------------------------------

def source_inventory_query(spark, sf_dir):
    """The given tables, one that is not there, and one under a root that is
    not there."""
    inv = source_inventory(spark, sf_dir, TABLES + ["transactions"], layout="file")
    absent = source_inventory(spark, f"{work_root(spark, 'absent')}/nowhere", ["absent_root"])
    return inv.unionByName(absent).select("source", "files", "rows", "status")


def multi_table_load(spark, sf_dir):
    """Four feeds, one of them missing; orders land twice, by one contract
    in two targets."""
    root = work_root(spark, "multi_table_load")
    missing = TableContract("missing_feed", "missing_feed", "bronze.missing_feed", "id")
    loads = [_load(spark, c, sf_dir, root, mode="parquet", glob=f"{c.name}.parquet")
             for c in (ORDERS, CUSTOMER, EVENTS)]
    loads.append(_load(spark, missing, f"{root}/no_such_folder", root, mode="parquet"))
    loads.append(_load(spark, ORDERS, sf_dir, f"{root}/again", mode="parquet", glob="orders.parquet"))
    res = run_all(spark, loads, raise_on_failure=False)
    return res.select("table_name", "status", "rows_written")


def repair_worklist_query(spark, sf_dir):
    o = dirty_orders(table(spark, sf_dir, "orders"))
    e = _landed_events(spark, sf_dir, "repair_worklist")
    c = table(spark, sf_dir, "customer")
    return repair_worklist(spark, {"orders": o, "events": e, "customer": c}, PLAN_CONTRACTS)


def repair_from_worklist(spark, sf_dir):
    """Worklist over stored tables (dirty orders, events with 'n/a' values,
    clean customers), then each listed table repaired in place."""
    root = work_root(spark, "repair_from_worklist")
    orders = _stored_dirty(spark, sf_dir, root)
    events = ParquetTable(f"{root}/events")
    events.write_batch(_landed_events(spark, sf_dir, "repair_from_worklist_src"), 0)
    customer = ParquetTable(f"{root}/customer")
    customer.write_batch(table(spark, sf_dir, "customer"), 0)
    tables = {"orders": orders, "events": events, "customer": customer}
    items = repair_worklist(spark, {n: t.read(spark) for n, t in tables.items()}, PLAN_CONTRACTS)
    return repair_items(spark, items, tables, PLAN_CONTRACTS).select(
        "table_name", "rows_rescued_before", "rows_rescued_after", "rows_repaired", "status")


def rescue_census_query(spark, sf_dir):
    """What the rescued entries of dirty orders (some of whose prices are
    filled again with another value, some with the same), of landed events and of customers
    are worth, by column; and whether the worklist made from it names the column."""
    o = dirty_orders(table(spark, sf_dir, "orders"))
    k = F.col("o_orderkey")
    price = F.get_json_object(RESCUED, "$.o_totalprice").try_cast("double")
    o = o.withColumn("o_totalprice", F.when((k % 7 == 0) & (k % 3 == 0), price + F.lit(1.0))
                     .when((k % 7 == 0) & (k % 5 == 0), price).otherwise(F.col("o_totalprice")))
    o = o.withColumn(RESCUED, F.when(k % 14 == 0, F.regexp_replace(RESCUED, "}$", ',"no_column":"1"}')).otherwise(F.col(RESCUED)))
    tables = {"orders": o, "events": _landed_events(spark, sf_dir, "rescue_census"), "customer": table(spark, sf_dir, "customer")}
    census = rescue_census(spark, tables, PLAN_CONTRACTS)
    listed = census_worklist(census, PLAN_CONTRACTS).select(F.col("table_name").alias("t"), F.col("rescued_cols").alias("c"))
    return (census.join(listed, (F.col("table_name") == F.col("t")) & (F.col("column") == F.col("c")), "left")
            .select(*census.columns, F.col("c").isNotNull().alias("listed")))


def resumed_run(spark, sf_dir):
    """Three feeds, one of them broken (its folder is missing). The run is
    resumed after the folder came: only that feed is loaded, the log holds both
    attempts under one run id, and every table has its rows once."""
    root = work_root(spark, "resumed_run")
    log = ParquetTable(f"{root}/log", ())
    src = f"{root}/landing/customer"
    loads = lambda: [_load(spark, ORDERS, sf_dir, root, mode="parquet", glob="orders.parquet"),
                     _load(spark, CUSTOMER, src, root, mode="parquet"),
                     _load(spark, EVENTS, sf_dir, root, mode="parquet", glob="events.parquet")]
    first = run_all(spark, loads(), raise_on_failure=False, log_table=log, run_id="nightly")
    write_drop(table(spark, sf_dir, "customer"), src)
    second = run_all(spark, loads(), log_table=log, resume="nightly")
    states = (log.read(spark).filter("run_id = 'nightly'").groupBy("table_name").agg(
        F.count_if(F.col("status") == "STARTED").alias("starts"), F.count_if(F.col("status") == "SUCCESS").alias("successes"),
        F.count_if(F.col("status") == "FAILED").alias("failures")))
    a = first.select("table_name", F.col("status").alias("first_status"))
    b = second.select("table_name", F.col("status").alias("second_status"), "rows_total")
    return a.join(b, "table_name").join(states, "table_name")


QUERIES = {
    "landing_flagship": landing_flagship,
    "incremental_ingest": incremental_ingest,
    "replay_idempotent": replay_idempotent,
    "source_lineage": source_lineage,
    "schema_evolution": schema_evolution,
    "rescue_capture": rescue_capture,
    "capture_fractional": capture_fractional,
    "capture_lossy": capture_lossy,
    "capture_nested": capture_nested,
    "mixed_schema_landing": mixed_schema_landing,
    "nested_evolution": nested_evolution,
    "arrival_order": arrival_order,
    "ledger_landing": ledger_landing,
    "evolving_parquet_load": evolving_parquet_load,
    "rescue_recover": rescue_recover,
    "json_field": json_field,
    "cast_contract": cast_contract,
    "partitioned_append": partitioned_append,
    "rescued_rows": rescued_rows,
    "rescued_count": rescued_count,
    "self_repair_keep": self_repair_keep,
    "self_repair_clear": self_repair_clear,
    "self_repair_rows": self_repair_rows,
    "self_repair_partitioned": self_repair_partitioned,
    "repair_by_merge": repair_by_merge,
    "update_by_key": update_by_key,
    "load_metrics": load_metrics,
    "run_metrics": run_metrics_query,
    "threshold_alerts": threshold_alerts_query,
    "run_log": run_log,
    "source_inventory": source_inventory_query,
    "multi_table_load": multi_table_load,
    "rescue_census": rescue_census_query,
    "resumed_run": resumed_run,
    "repair_worklist": repair_worklist_query,
    "repair_from_worklist": repair_from_worklist,
}
