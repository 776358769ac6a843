"""The pipeline's stages against brute force, and the queries' DuckDB statements."""

import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as cp
from strandline.llm.queries import ORACLES, QUERIES
from tools.oracle_check import TABLES, compare

from .helpers import word_list
from .test_llm_dedup import plain_leaks, plain_near

SMALL, SF = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


def test_stages(spark):
    assert [n for n, _ in cp.STAGES] == ["language_id", "near_duplicates", "decontamination", "mixing", "token_files"]
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    cols = docs.columns
    told = cp.language_id(spark, docs, SMALL)
    assert told.columns == cols and told.count() >= 0.95 * docs.count()
    one = cp.near_duplicates(spark, told, SMALL)
    rows = {r["doc_id"]: r["text"] for r in told.collect()}
    near = plain_near(list(rows.items()), 5)
    kept = {i for i in rows if near[i][2]}
    assert one.columns == cols and {r["doc_id"] for r in one.collect()} == kept and len(kept) < len(rows)
    clean = cp.decontamination(spark, one, SMALL)
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    bad = {d for d, _ in plain_leaks([(i, rows[i]) for i in kept], items)}
    assert clean.columns == cols and {r["doc_id"] for r in clean.collect()} == kept - bad and bad
    mixed = cp.mixing(spark, clean, SMALL)
    took = [r["doc_id"] for r in mixed.collect()]
    assert mixed.columns == cols and set(took) <= kept - bad and max(map(took.count, took)) <= 3
    words = sum(len(word_list(rows[i])) for i in kept - bad)
    assert abs(sum(len(word_list(rows[i])) for i in took) - words) < 0.2 * words
    from tokenizers import Tokenizer
    import public_tokenizers
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    start, want = 0, []
    for i in sorted(took):
        ids = tok.encode(rows[i], add_special_tokens=False).ids + [0]
        want.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted(map(tuple, cp.tokens(spark, mixed, SMALL).collect())) == want


def test_stages_of_odd_and_no_rows(spark):
    docs = spark.createDataFrame(
        [(None, None, None, None, None), (1, "", "en", "s", 0), (2, "A clear sentence of some words. " * 30, "en", None, 5),
         (2, "A clear sentence of some words. " * 30, "en", None, 5)],
        "doc_id long, text string, lang string, source string, n_chars long")
    for d in (docs, docs.limit(0)):
        for _, stage in cp.STAGES:
            stage(spark, d, SMALL).collect()


def test_mixing_takes_each_row_by_itself(spark):
    """50 rows without an id of one source and 50 of another: each source's share is
    near its target, no row comes more than three times, columns stay."""
    from strandline.llm.common import word_count
    from strandline.llm.mixing import mix, mixed_rows
    rows = [(None, f"a{i} " * (5 + i % 7), "a", 1, i) for i in range(50)] + [(9, f"b{i} " * (5 + i % 7), "b", 1, i) for i in range(50)]
    rows += [(9, "same text of five words", "b", 2, 0)] * 12 + [(None, None, None, None, 0), (1, "", "a", 0, 0), (1, "", "a", 0, 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars int, mix_copies int")
    out = mixed_rows(df, word_count(df["text"]))
    assert out.columns == df.columns
    got = [tuple(r) for r in out.collect()]
    count = {r: rows.count(r) for r in rows}
    assert all(r in count and got.count(r) <= 3 * count[r] for r in set(got))
    assert got.count((None, None, None, None, 0)) == 1 and got.count((1, "", "a", 0, 0)) == 2
    sized = df.select(F.monotonically_increasing_id().alias("id"), "source", word_count(F.col("text")).alias("size"))
    target = {r["source"]: r["target"] for r in mix(sized).select("source", "target").distinct().collect()}
    for s in "ab":
        taken = sum(len(word_list(r[1])) for r in got if r[2] == s)
        assert abs(taken - target[s]) <= 12, (s, taken, target[s])
    assert mixed_rows(df.limit(0), word_count(df["text"])).count() == 0


def test_each_stage_on_null_shared_and_repeated_ids(spark):
    """What each stage keeps of rows with odd ids and extra columns, by value."""
    rng = np.random.default_rng(3)
    text = {k: " ".join(f"{k}{x}" for x in rng.integers(0, 10 ** 6, 60)) for k in ("the", "and", "with")}
    item = "one held out item of the benchmark with some words in it"
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    cols = "doc_id long, text string, lang string, source string, n_chars long, t string, class long, item_id long"
    rows = [(k, x, "en", "s", 0, "t", 5, 1) for k, x in [
        (None, text["the"]), (None, text["the"]), (None, text["and"]), (4, text["with"]), (4, text["and"] + " more"),
        (4, item), (None, item + " x"), (6, None), (6, ""), (7, "word " * 200_000)]]
    df = spark.createDataFrame(rows, cols)
    one = cp.near_duplicates(spark, df, SMALL)
    assert one.columns == df.columns
    want = sorted([(None, text["the"]), (4, text["and"] + " more"), (4, text["with"]), (4, item), (6, None), (6, ""),
                   (7, "word " * 200_000)], key=repr)
    assert sorted([(r["doc_id"], r["text"]) for r in one.collect()], key=repr) == want
    from strandline.llm.decontaminate import without_leaks
    clean = without_leaks(df, bench)
    assert clean.columns == df.columns
    assert sorted([(r["doc_id"], r["text"]) for r in clean.collect()], key=repr) == sorted(
        [(r[0], r[1]) for r in rows if item not in (r[1] or "")], key=repr)
    mixed = cp.mixing(spark, df, SMALL)
    assert mixed.columns == df.columns and {(r["doc_id"], r["text"]) for r in mixed.collect()} <= {(r[0], r[1]) for r in rows}
    last = cp.tokens(spark, df, SMALL).collect()
    assert len(last) == len(rows) and sorted(r["start"] for r in last)[0] == 0


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", list(ORACLES))
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, con, name, QUERIES[name], ORACLES[name], SF)
    assert r[1] == "ok", r
