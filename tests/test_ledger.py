"""Batch landing by a ledger: bounded batches, resumption, types of a whole plan."""

import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandline.contracts import TableContract
from strandline.operators.sink import ParquetTable
from strandline.sources.landing import list_files
from strandline.sources.ledger import FolderLedger, joined_schema
from strandline.streaming.loads import LandingLoad

C = TableContract("t", "t", "bronze.t", "id", {"amount": "double"}, ("amount",))


def make_load(spark, tmp, **kw):
    return LandingLoad(spark=spark, contract=C, source=f"{tmp}/land", table=ParquetTable(f"{tmp}/table"),
                       checkpoint=f"{tmp}/chk", **kw)


def drop(spark, tmp, sql):
    spark.sql(sql).coalesce(1).write.mode("append").parquet(f"{tmp}/land")


def test_many_paths_reach_the_driver_only_batch_by_batch(spark, tmp, monkeypatch):
    """50,000 listed paths in batches of 2,000: nothing collected is longer than
    a batch, and every path is in one batch."""
    from strandline.sources import ledger as module
    monkeypatch.setattr(module, "joined_schema", lambda files: None)        # no such files
    ledger = FolderLedger(f"{tmp}/ledger", max_files=2000)
    taken = []
    plain = DataFrame.collect
    kind = type(spark.range(1))

    def counted(self, *a, **kw):
        out = plain(self, *a, **kw) if kind is DataFrame else own(self, *a, **kw)
        taken.append(len(out))
        return out
    own = kind.collect
    monkeypatch.setattr(kind, "collect", counted)
    listing = spark.range(50_000).select(F.concat(F.lit("file:/x/f"), F.col("id").cast("string")).alias("path"),
                                         F.lit(10).alias("length"))
    assert ledger.plan(listing) == 0 and ledger.plan(listing) is None
    pending = ledger.pending(spark)
    sizes = [ledger.files(spark, *b).count() for b in pending[:12]]
    got = [r["path"] for r in ledger.files(spark, *pending[0]).collect()]
    assert got and taken and max(taken) <= 2000 and max(sizes) <= 2000
    more = listing.unionByName(spark.createDataFrame([("file:/x/new", 1)], "path string, length int"))
    assert ledger.plan(more) == 1
    assert [r["path"] for r in ledger.files(spark, *ledger.pending(spark)[-1]).collect()] == ["file:/x/new"]
    every = ledger.seen(spark)
    assert every.count() == every.distinct().count() == 50_001


def test_batches_are_bounded_by_bytes(spark, tmp, monkeypatch):
    from strandline.sources import ledger as module
    monkeypatch.setattr(module, "joined_schema", lambda files: None)
    ledger = FolderLedger(f"{tmp}/ledger", max_files=1000, max_bytes=100)
    sizes = [(f"f{i:03d}", 9) for i in range(200)] + [("huge", 5000), ("none", None), ("f000", 9)]
    ledger.plan(spark.createDataFrame(sizes, "path string, length long"))
    got = {}
    for p, b in ledger.pending(spark):
        got[b] = [(r["path"], r["length"] or 0) for r in ledger.files(spark, p, b).collect()]
    assert sorted(x for g in got.values() for x, _ in g) == sorted({x for x, _ in sizes})
    assert all(sum(n for _, n in g) <= 100 or g == [("huge", 5000)] for g in got.values())
    assert len(got) <= 25


def test_planned_runs_land_each_file_once_and_resume(spark, tmp):
    for k in range(7):
        kind = ["CAST({0} AS INT)", "{0}.5D", "{0}L"][k % 3].format(k)
        drop(spark, tmp, f"SELECT {k}L AS id, '{'x' if k == 3 else k}' AS amount, {kind} AS n, named_struct('f{k % 2}', {k}) AS s")
    ledger = FolderLedger(f"{tmp}/ledger", max_files=2)
    ld = make_load(spark, tmp)
    calls = []
    plain = ledger.landed

    class Cut(FolderLedger):
        def landed(self, spark, plan, batch):
            if len(calls) == 1:
                raise InterruptedError      # the batch is written, the ledger does not know
            calls.append(batch)
            plain(spark, plan, batch)
    with pytest.raises(InterruptedError):
        ld.run_planned(Cut(ledger.path, 2))
    drop(spark, tmp, "SELECT 100L AS id, '1' AS amount, 9L AS n, named_struct('f0', 1) AS s")
    res = ld.run_planned(ledger)
    assert res.status == "SUCCESS" and ledger.pending(spark) == []
    t = ParquetTable(ld.table.path).read(spark)
    got = {r["id"]: r for r in t.collect()}
    assert t.count() == 8 and sorted(got) == [0, 1, 2, 3, 4, 5, 6, 100]
    assert t.schema["n"].dataType.simpleString() == "double" and got[1]["n"] == 1.5 and got[0]["n"] == 0.0
    assert t.schema["s"].dataType.simpleString() == "struct<f0:int,f1:int>" and tuple(got[1]["s"]) == (None, 1)
    assert got[3]["amount"] is None and got[3]["_rescued_data"] == '{"amount":"x"}'
    assert ld.run_planned(ledger).rows_read == 0 and ParquetTable(ld.table.path).read(spark).count() == 8
    most = t.groupBy("_batch_id").agg(F.count_distinct("_source_file").alias("f")).agg(F.max("f")).first()[0]
    assert most <= 2
    # a table with rows and an empty ledger
    with pytest.raises(RuntimeError, match="ledger"):
        ld.run_planned(FolderLedger(f"{tmp}/other"))
    again = make_load(spark, tmp, reset=True).run_planned(FolderLedger(f"{tmp}/other"))
    assert again.rows_read == 8 and ParquetTable(ld.table.path).read(spark).count() == 16


def test_schema_of_many_footers(spark, tmp, monkeypatch):
    """Joined by tasks in a tree, in Spark's types, whoever wrote the files."""
    import os

    import pyarrow as pa
    import pyarrow.parquet as pq

    from strandline.sources import ledger as module
    monkeypatch.setattr(module, "FAN_IN", 2)
    drop(spark, tmp, "SELECT 1L AS id, CAST(1.5 AS DECIMAL(5,2)) AS d, map('k', array(1)) AS m, DATE'2024-01-01' AS day")
    drop(spark, tmp, "SELECT 2 AS id, CAST(1.5 AS DECIMAL(12,4)) AS d, map('k', array(1.5D)) AS m, TIMESTAMP_NTZ'2024-01-01 00:00:00' AS day")
    os.makedirs(f"{tmp}/land", exist_ok=True)
    pq.write_table(pa.table({"id": pa.array([3], pa.uint32()), "f": pa.array([1.5], pa.float32()), "b": pa.array([b"x"]),
                             "s": pa.array([{"x": 1, "t": [True]}], pa.struct([("x", pa.int64()), ("t", pa.list_(pa.bool_()))])), "flag": pa.array([True])}), f"{tmp}/land/other.parquet")
    got = joined_schema(list_files(spark, f"{tmp}/land").repartition(3))
    assert {f.name: f.dataType.simpleString() for f in got} == {
        "id": "bigint", "d": "decimal(12,4)", "m": "map<string,array<double>>", "day": "timestamp_ntz", "f": "float",
        "b": "binary", "s": "struct<x:bigint,t:array<boolean>>", "flag": "boolean"}
    assert joined_schema(list_files(spark, f"{tmp}/land").limit(0)) is None


def test_stream_batches_by_bytes(spark, tmp):
    """One large file and many small ones: the byte limit parts them."""
    spark.range(200_000).selectExpr("id", "cast(rand(1) as string) AS amount").coalesce(1).write.mode("append").parquet(f"{tmp}/land")
    spark.range(8).selectExpr("id + 1000000 AS id", "'1' AS amount").repartition(8, "id").write.mode("append").parquet(f"{tmp}/land")
    ld = make_load(spark, tmp, max_bytes_per_trigger=100_000)
    res = ld.run()
    sizes = sorted(b["rows"] for b in ld.batches.values())
    assert res.rows_read == 200_008 and len(sizes) >= 2 and sizes[-1] >= 200_000
    assert sum(sizes[:-1]) >= 1     # small ones land in batches of their own
