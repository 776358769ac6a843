"""Landing folders, schema groups, streams, replay."""

import json
import pytest
from pyspark.sql import functions as F

from strandline.contracts import TableContract
from strandline.operators.sink import ParquetTable
from strandline.sources.landing import land_folder, list_files, resolve_types, schema_groups
from strandline.streaming.loads import LandingLoad

C = TableContract("t", "t", "bronze.t", "id", {"amount": "double"}, ("amount",))


def drop(spark, folder, rows, schema):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(folder)


def test_schema_groups_and_conflicting_types(spark, tmp):
    src = f"{tmp}/land"
    drop(spark, src, [(1, 1.5)], "id long, amount double")
    drop(spark, src, [(2, "2.25"), (3, "oops")], "id long, amount string")
    drop(spark, src, [(4, "x", 9)], "id long, amount string, extra int")
    groups = schema_groups(list_files(spark, src))
    # the string-typed files share a group (one only adds a column)
    assert len(groups) == 2 and sum(len(g) for g in groups) == 3
    out = land_folder(spark, src, C.types)
    got = {r["id"]: (r["amount"], r["extra"], r["_rescued_data"]) for r in out.collect()}
    assert got == {1: (1.5, None, None), 2: (2.25, None, None),
                   3: (None, None, '{"amount":"oops"}'), 4: (None, 9, '{"amount":"x"}')}
    assert dict(out.dtypes)["amount"] == "double"
    assert all(r["_source_file"].endswith(".parquet") for r in out.collect())


def test_resolve_types_order(spark):
    from pyspark.sql import types as T
    table = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.StringType())])
    seen = [T.StructType([T.StructField("a", T.StringType()), T.StructField("b", T.LongType()),
                          T.StructField("c", T.DoubleType()), T.StructField("d", T.StringType())])]
    got = resolve_types({"d": "boolean"}, table, seen)
    assert got == {"a": T.LongType(), "b": T.StringType(), "c": T.DoubleType(),
                   "d": T.BooleanType()}
    assert resolve_types({}, table, seen, evolve=False)["c"] is None


def make_load(spark, tmp, mode="discover", **kw):
    return LandingLoad(spark=spark, contract=C, source=f"{tmp}/land",
                       table=ParquetTable(f"{tmp}/table"), checkpoint=f"{tmp}/chk", mode=mode, **kw)


def test_stream_two_drops_rerun_and_evolution(spark, tmp):
    src = f"{tmp}/land"
    drop(spark, src, [(1, 1.0), (2, 2.0)], "id long, amount double")
    ld = make_load(spark, tmp)
    r1 = ld.run()
    assert (r1.rows_read, r1.rows_total, r1.rows_rescued) == (2, 2, 0)
    # rerun with nothing new reads nothing
    assert ld.run().rows_read == 0
    # a new drop with a new column and a bad value
    drop(spark, src, [(3, "bad", "x")], "id long, amount string, note string")
    r3 = ld.run()
    assert (r3.rows_read, r3.rows_total, r3.rows_rescued) == (1, 3, 1)
    t = ld.table.read(spark)
    got = {r["id"]: (r["amount"], r["note"], r["_batch_id"]) for r in t.collect()}
    assert got[1][1] is None and got[3] == (None, "x", got[3][2]) and got[3][2] > got[1][2]

    # the same files landed by a fresh load in one go give the same table
    one = LandingLoad(spark=spark, contract=C, source=src, table=ParquetTable(f"{tmp}/table2"),
                      checkpoint=f"{tmp}/chk2")
    one.run()
    cols = ["id", "amount", "note", "_rescued_data"]
    assert sorted(one.table.read(spark).select(cols).collect()) == sorted(t.select(cols).collect())


def test_replay_overwrites_its_batch(spark, tmp):
    src = f"{tmp}/land"
    drop(spark, src, [(1, 1.0), (2, 2.0)], "id long, amount double")
    ld = make_load(spark, tmp, mode="parquet")
    ld.run()
    again = spark.read.parquet(src).select("*", F.col("_metadata.file_path").alias("_source_file"))
    ld.process_batch(again, 0)
    ld.process_batch(again, 0)
    assert ld.table.read(spark).count() == 2


def test_refuses_lost_checkpoint_unless_reset(spark, tmp):
    src = f"{tmp}/land"
    drop(spark, src, [(1, 1.0)], "id long, amount double")
    make_load(spark, tmp).run()
    lost = LandingLoad(spark=spark, contract=C, source=src, table=ParquetTable(f"{tmp}/table"),
                       checkpoint=f"{tmp}/chk_new")
    with pytest.raises(RuntimeError, match="checkpoint"):
        lost.run()
    again = LandingLoad(spark=spark, contract=C, source=src, table=ParquetTable(f"{tmp}/table"),
                        checkpoint=f"{tmp}/chk_new", reset=True)
    again.run()
    t = ParquetTable(f"{tmp}/table").read(spark)
    assert t.count() == 2 and t.select("_batch_id").distinct().count() == 2   # nothing replaced
    # a later run on the new checkpoint keeps counting above the old batches
    drop(spark, src, [(3, 3.0)], "id long, amount double")
    later = LandingLoad(spark=spark, contract=C, source=src, table=ParquetTable(f"{tmp}/table"),
                        checkpoint=f"{tmp}/chk_new")
    later.run()
    t = ParquetTable(f"{tmp}/table").read(spark)
    assert t.count() == 3 and t.select("_batch_id").distinct().count() == 3


def test_evolution_off_rescues_new_columns(spark, tmp):
    src = f"{tmp}/land"
    drop(spark, src, [(1, 1.0)], "id long, amount double")
    make_load(spark, tmp).run()
    drop(spark, src, [(2, 2.0, "n")], "id long, amount double, note string")
    ld = make_load(spark, tmp, evolve=False)
    ld.run()
    t = ld.table.read(spark)
    assert "note" not in t.columns
    assert t.filter("id = 2").first()["_rescued_data"] == '{"note":"n"}'


def test_processing_time_trigger_and_view(spark, tmp):
    src = f"{tmp}/land"
    drop(spark, src, [(1, 1.0)], "id long, amount double")
    ld = make_load(spark, tmp, trigger="processing_time", processing_time="1 second")
    q = ld.start()
    try:
        q.processAllAvailable()
        drop(spark, src, [(2, "2.5")], "id long, amount string")
        q.processAllAvailable()
    finally:
        q.stop()
    assert sum(b["rows"] for b in ld.batches.values()) == 2
    ld.table.as_view(spark, "landed_t")
    assert spark.sql("SELECT sum(amount) AS s FROM landed_t").first()["s"] == 3.5


def test_missing_table_does_not_exist(spark, tmp):
    assert not ParquetTable(f"{tmp}/nothing").exists(spark)


def test_old_file_dropped_late_is_still_read(spark, tmp):
    import os
    src = f"{tmp}/land"
    drop(spark, src, [(1, 1.0)], "id long, amount double")
    ld = make_load(spark, tmp)
    ld.run()
    drop(spark, f"{tmp}/stage", [(2, 2.0)], "id long, amount double")
    for f in os.listdir(f"{tmp}/stage"):
        if f.endswith(".parquet"):
            old = 1_000_000_000                           # 2001: far older than 7 days
            os.utime(f"{tmp}/stage/{f}", (old, old))
            os.rename(f"{tmp}/stage/{f}", f"{src}/late-{f}")
    assert ld.run().rows_read == 1


def test_empty_folder_loads_nothing(spark, tmp):
    import os
    os.makedirs(f"{tmp}/land")
    r = make_load(spark, tmp).run()
    assert (r.status, r.rows_read, r.batches) == ("SUCCESS", 0, 0)


def test_clean_source_archives_processed_files(spark, tmp):
    import os
    src = f"{tmp}/land"
    drop(spark, src, [(1, 1.0)], "id long, amount double")
    ld = make_load(spark, tmp, clean_source="archive", archive_dir=f"{tmp}/archive")
    ld.run()
    drop(spark, src, [(2, 2.0)], "id long, amount double")
    ld.run()
    assert ld.table.read(spark).count() == 2


def test_parquet_mode_captures_undeclared_type_change(spark, tmp):
    src = f"{tmp}/land"
    drop(spark, src, [(1, 1.0, 5)], "id long, amount double, qty long")
    make_load(spark, tmp, mode="parquet").run()
    # the folder's schema changes: qty now arrives as text
    drop(spark, f"{tmp}/land2", [(2, 2.0, "seven")], "id long, amount double, qty string")
    ld = LandingLoad(spark=spark, contract=C, source=f"{tmp}/land2", table=ParquetTable(f"{tmp}/table"),
                     checkpoint=f"{tmp}/chk2", mode="parquet", reset=True)
    ld.run()
    got = {r["id"]: (r["qty"], r["_rescued_data"]) for r in ld.table.read(spark).collect()}
    assert got == {1: (5, None), 2: (None, '{"qty":"seven"}')}


def test_unrecovered_rows_are_counted_in_flight(spark, tmp):
    src = f"{tmp}/land"
    rows = [(1, None, '{"amount":"2.5"}'),       # recovered at ingest
            (2, None, '{"amount":"n/a"}'),       # cannot be recovered
            (3, 1.0, '{"other":"x"}'),           # an entry no column holds
            (4, 4.0, None)]
    drop(spark, src, rows, "id long, amount double, _rescued_data string")
    r = make_load(spark, tmp).run()
    assert (r.rows_read, r.rows_rescued_in_load, r.rows_unrecovered_in_load) == (4, 3, 2)
    assert r.rows_rescued == 3                         # rescued text kept at ingest


def test_replay_then_repair_converges(spark, tmp):
    from strandline.operators.repair import self_repair_table
    src = f"{tmp}/land"
    drop(spark, src, [(1, None, '{"amount":"2.5"}'), (2, 3.0, None)],
         "id long, amount double, _rescued_data string")
    ld = make_load(spark, tmp, mode="parquet")
    ld.run()
    self_repair_table(spark, ld.table, C)
    once = sorted(tuple(r) for r in ld.table.read(spark).select("id", "amount", "_rescued_data")
                  .collect())
    again = spark.read.parquet(src).select("*", F.col("_metadata.file_path").alias("_source_file"))
    ld.process_batch(again, 0)                          # the batch comes back, rescued again
    assert ld.table.read(spark).filter("_rescued_data IS NOT NULL").count() == 1
    self_repair_table(spark, ld.table, C)
    assert sorted(tuple(r) for r in ld.table.read(spark).select("id", "amount", "_rescued_data")
                  .collect()) == once
    assert once == [(1, 2.5, None), (2, 3.0, None)]


def test_new_column_inside_a_running_stream(spark, tmp):
    src = f"{tmp}/land"
    drop(spark, src, [(1, 1.0)], "id long, amount double")
    ld = make_load(spark, tmp, trigger="processing_time", processing_time="1 second")
    q = ld.start()
    try:
        q.processAllAvailable()
        drop(spark, src, [(2, 2.0, "n")], "id long, amount double, note string")
        q.processAllAvailable()
    finally:
        q.stop()
    ld.table.refresh()
    got = {r["id"]: r["note"] for r in ld.table.read(spark).collect()}
    assert got == {1: None, 2: "n"}


def test_many_extra_columns_stay_one_read(spark, tmp):
    src = f"{tmp}/land"
    for i in range(12):
        drop(spark, src, [(i, float(i), i)], f"id long, amount double, extra_{i} long")
    groups = schema_groups(list_files(spark, src))
    assert len(groups) == 1 and len(groups[0]) == 12
    out = land_folder(spark, src, C.types)
    assert out.count() == 12 and len([c for c in out.columns if c.startswith("extra_")]) == 12
    assert out.filter("extra_5 = 5").count() == 1


def test_file_with_no_rows(spark, tmp):
    src = f"{tmp}/land"
    spark.createDataFrame([], "id long, amount string").coalesce(1).write.mode("append").parquet(src)
    for mode in ("discover", "parquet"):
        ld = LandingLoad(spark=spark, contract=C, source=src, table=ParquetTable(f"{tmp}/t_{mode}"),
                         checkpoint=f"{tmp}/chk_{mode}", mode=mode)
        r = ld.run()
        assert (r.status, r.rows_read) == ("SUCCESS", 0)


def test_files_that_already_carry_lineage_columns(spark, tmp):
    src = f"{tmp}/land"
    drop(spark, src, [(1, 1.0, "elsewhere.csv", 99)], "id long, amount double, _source_file string, _batch_id long")
    for mode in ("discover", "parquet"):
        ld = LandingLoad(spark=spark, contract=C, source=src, table=ParquetTable(f"{tmp}/t_{mode}"),
                         checkpoint=f"{tmp}/chk_{mode}", mode=mode)
        ld.run()
        r = ld.table.read(spark).first()
        assert r["_source_file"].endswith(".parquet") and r["_batch_id"] == 0


def test_land_files_from_a_path_list(spark, tmp):
    import glob
    from strandline.sources.landing import land_files
    drop(spark, f"{tmp}/a", [(1, 1.5)], "id long, amount double")
    drop(spark, f"{tmp}/b", [(2, "oops")], "id long, amount string")
    paths = sorted(glob.glob(f"{tmp}/a/*.parquet") + glob.glob(f"{tmp}/b/*.parquet"))
    out = land_files(spark, paths, C.types)
    got = {r["id"]: (r["amount"], r["_rescued_data"]) for r in out.collect()}
    assert got == {1: (1.5, None), 2: (None, '{"amount":"oops"}')}
    assert land_files(spark, [], C.types) is None


def test_run_all_raises_naming_failed_tables(spark, tmp):
    from strandline.streaming.loads import run_all
    drop(spark, f"{tmp}/land", [(1, 1.0)], "id long, amount double")
    good = make_load(spark, tmp)
    bad = LandingLoad(spark=spark, contract=TableContract("gone", "gone", "bronze.gone", "id"),
                      source=f"{tmp}/missing", table=ParquetTable(f"{tmp}/t_gone"),
                      checkpoint=f"{tmp}/chk_gone", mode="parquet")
    with pytest.raises(RuntimeError, match="gone"):
        run_all(spark, [good, bad])
    assert good.table.read(spark).count() == 1           # the healthy table still loaded


def test_clean_source_delete(spark, tmp):
    import glob
    src = f"{tmp}/land"
    drop(spark, src, [(1, 1.0)], "id long, amount double")
    ld = make_load(spark, tmp, clean_source="delete")
    ld.run()
    drop(spark, src, [(2, 2.0)], "id long, amount double")
    ld.run()                                  # the first file is removed once committed
    assert ld.table.read(spark).count() == 2
    assert len(glob.glob(f"{src}/*.parquet")) <= 1


def test_loads_of_one_contract_and_refused_doubles(spark, tmp):
    from dataclasses import replace

    from strandline.streaming.loads import run_all
    drop(spark, f"{tmp}/land", [(1, 1.0)], "id long, amount double")
    drop(spark, f"{tmp}/land2", [(2, 2.0), (3, 3.0)], "id long, amount double")
    a = make_load(spark, tmp)
    b = replace(a, source=f"{tmp}/land2", table=ParquetTable(f"{tmp}/table2"), checkpoint=f"{tmp}/chk2", batches={})
    out = [(r["table_name"], r["status"], r["rows_written"], r["rows_total"]) for r in run_all(spark, [a, b], parallel=1).collect()]
    assert out == [("t", "SUCCESS", 1, 1), ("t", "SUCCESS", 2, 2)]
    for twin, what in ((replace(b, checkpoint=a.checkpoint), "checkpoint"), (replace(b, table=a.table), "target")):
        with pytest.raises(ValueError, match=what):
            run_all(spark, [a, twin])


def test_a_single_load_can_return_its_failure(spark, tmp):
    ld = LandingLoad(spark=spark, contract=C, source=f"{tmp}/missing", table=ParquetTable(f"{tmp}/t"),
                     checkpoint=f"{tmp}/chk", mode="parquet")
    r = ld.run(raise_on_failure=False)
    assert r.status == "FAILED" and "missing" in r.error and r.rows_written == 0
    with pytest.raises(Exception):
        ld.run()


def test_metrics_are_of_the_run(spark, tmp):
    src = f"{tmp}/land"
    drop(spark, src, [(1, 1.0), (2, 2.0)], "id long, amount double")
    ld = make_load(spark, tmp)
    assert ld.run().rows_read == 2
    drop(spark, src, [(3, 3.0)], "id long, amount double")
    assert ld.run().rows_read == 1
    r = ld.run()
    assert (r.rows_read, r.batches, ld.batch_metrics().count()) == (0, 0, 0)


def test_files_that_cannot_be_cast_do_not_block_the_stream(spark, tmp):
    src = f"{tmp}/land"
    ld = make_load(spark, tmp)
    spark.sql("SELECT 1L AS id, named_struct('a', 1) AS s, 5 AS v").coalesce(1).write.mode("append").parquet(src)
    ld.run()
    spark.sql("SELECT 2L AS id, named_struct('a', 2, 'b', 3) AS s, 6 AS V").coalesce(1).write.mode("append").parquet(src)
    spark.sql("SELECT 3L AS id, named_struct('a', 4) AS s, 7 AS v").coalesce(1).write.mode("append").parquet(src)
    ld.run()
    spark.sql("SELECT 4L AS id, named_struct('a', 9) AS s, 8 AS v").coalesce(1).write.mode("append").parquet(src)
    assert ld.run().status == "SUCCESS"
    got = {r["id"]: (r["s"] and r["s"]["a"], r["v"], r["_rescued_data"]) for r in ld.table.read(spark).collect()}
    assert got[1] == (1, 5, None) and got[3] == (4, 7, None) and got[4] == (9, 8, None)
    assert got[2] == (2, 6, None)
    assert {r["id"]: r["b"] for r in ld.table.read(spark).selectExpr("id", "s.b AS b").collect()} == {1: None, 2: 3, 3: None, 4: None}


def test_nested_fields_evolve_or_are_rescued_by_address(spark, tmp):
    """New fields of structs, also in arrays and maps, are columns of later rows;
    without evolution they are rescued under their address, and the rest stays."""
    def drops(at):
        spark.sql("SELECT 1L AS id, named_struct('a', 1) AS s, array(named_struct('x', 1)) AS l, map('k', named_struct('p', 1)) AS m") \
            .coalesce(1).write.mode("append").parquet(at)
        yield
        spark.sql("""SELECT 2L AS id, named_struct('b', 'two', 'a', 5000000000L) AS s, array(named_struct('x', 2, 'y', 'why'), NULL) AS l,
                            map('k', named_struct('p', 2, 'q', named_struct('r', 7))) AS m""") \
            .coalesce(1).write.mode("append").parquet(at)
        yield
    ld = make_load(spark, f"{tmp}/on")
    for _ in drops(f"{tmp}/on/land"):
        ld.run()
    t = ParquetTable(ld.table.path).read(spark)
    assert t.schema["s"].dataType.simpleString() == "struct<a:bigint,b:string>"
    got = {r["id"]: r for r in t.collect()}
    assert tuple(got[1]["s"]) == (1, None) and tuple(got[2]["s"]) == (5000000000, "two")
    assert [x and tuple(x) for x in got[2]["l"]] == [(2, "why"), None] and tuple(got[1]["l"][0]) == (1, None)
    assert got[2]["m"]["k"]["q"]["r"] == 7 and got[1]["m"]["k"]["q"] is None
    assert got[1]["_rescued_data"] is None and got[2]["_rescued_data"] is None
    off = make_load(spark, f"{tmp}/off", evolve=False)
    for _ in drops(f"{tmp}/off/land"):
        off.run()
    t = ParquetTable(off.table.path).read(spark)
    assert t.schema["s"].dataType.simpleString() == "struct<a:int>"
    got = {r["id"]: r for r in t.collect()}
    assert json.loads(got[2]["_rescued_data"]) == {"s.b": "two", "s.a": "5000000000", "l[0].y": "why", 'm["k"].q': '{"r":7}'}
    assert tuple(got[2]["s"]) == (None,) and tuple(got[2]["l"][0]) == (2,) and got[2]["l"][1] is None


def test_schema_is_kept_beside_the_table_and_batches_are_read_alone(spark, tmp, monkeypatch):
    import os
    t = ParquetTable(f"{tmp}/kept")
    t.write_batch(spark.createDataFrame([(1, "a")], "id long, x string"), 0)
    t.write_batch(spark.createDataFrame([(2, "b", 1.5)], "id long, x string, y double"), 1)
    fresh = ParquetTable(f"{tmp}/kept")
    for f in os.listdir(f"{tmp}/kept/_batch_id=0"):      # no footer is opened to learn the schema
        if f.endswith(".parquet"):
            os.rename(f"{tmp}/kept/_batch_id=0/{f}", f"{tmp}/gone.parquet")
    assert fresh.read(spark).columns == ["id", "x", "y", "_batch_id"]
    one = fresh.read_batch(spark, 1)
    assert [tuple(r) for r in one.collect()] == [(2, "b", 1.5, 1)]
    assert all("_batch_id=1" in f for f in one.inputFiles())


def test_no_checkpoint_folder_is_an_error_on_a_cluster(monkeypatch):
    from strandline import session

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return {}

    class Session:
        sparkContext = Context()
        conf = {}
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.checkpoint_dir(Session())
