"""Executors must not need this package on their path: Python work shipped
to them (the footer reader) travels by value. Run from another folder, in
a fresh process, with the package only on the driver's path."""

import os
import subprocess
import sys
import textwrap

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_footer_grouping_from_outside_the_repo(tmp_path):
    code = textwrap.dedent(f"""
        import sys
        sys.path.insert(0, {REPO!r})
        from pyspark.sql import SparkSession
        from strandline.sources.landing import land_folder
        spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
                 .getOrCreate())
        d = {str(tmp_path / "land")!r}
        spark.createDataFrame([(1, 1.5)], "id long, v double").write.mode("append").parquet(d)
        spark.createDataFrame([(2, "x")], "id long, v string").write.mode("append").parquet(d)
        out = land_folder(spark, d, {{"v": "double"}})
        print("ROWS", sorted((r["id"], r["v"], r["_rescued_data"]) for r in out.collect()))
    """)
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    r = subprocess.run([sys.executable, "-c", code], cwd=str(tmp_path), env=env,
                       capture_output=True, text=True, timeout=300)
    assert "ROWS [(1, 1.5, None), (2, None, '{\"v\":\"x\"}')]" in r.stdout, r.stderr[-3000:]


def test_bench_prints_one_json_line(tmp_path):
    import json
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    env.update(BENCH_SF_DIR="/root/testdata/sf0.001", BENCH_CPUS="4")
    r = subprocess.run([sys.executable, os.path.join(REPO, "bench.py"), "rescued_count",
                        "json_field"], cwd=str(tmp_path), env=env, capture_output=True, text=True,
                       timeout=600)
    lines = [x for x in r.stdout.splitlines() if x.strip()]
    assert len(lines) == 1, r.stdout + r.stderr[-2000:]
    out = json.loads(lines[0])
    assert out["unit"] == "sec" and set(out["queries"]) == {"rescued_count", "json_field"}
    assert out["sf"] == 0.001 and "errors" not in out
