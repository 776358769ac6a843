"""Union-find and mixing against plain Python."""

import random

import pytest
from pyspark.sql import functions as F

from strandline.llm.common import components, word_count, words
from strandline.llm.mixing import mix, mixed_rows, source_targets

from .helpers import groups


@pytest.mark.parametrize("seed", [1, 2])
def test_components_match_a_plain_union_find(spark, seed):
    rng = random.Random(seed)
    edges = [(rng.randrange(80), rng.randrange(80)) for _ in range(50)]
    edges += [(100 + i, 101 + i) for i in range(30)] + [(200, 200 + i) for i in range(1, 25)]   # a chain, a star
    edges = [(a, b) for a, b in edges if a != b]
    df = spark.createDataFrame(edges + [(None, 5), (7, 7)], "a long, b long")
    got = {r["id"]: r["component"] for r in components(df).collect()}
    assert got == groups(edges)


def test_components_of_nothing(spark):
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_words(spark):
    d = spark.createDataFrame([("a\tb c  d\n",), ("",), (None,), (" \x0b",)], "t string")
    got = d.select(words(F.col("t")).alias("w"), word_count(F.col("t")).alias("n")).collect()
    assert [r["w"] for r in got] == [["a", "b c", "d"], [], [], []]
    assert [r["n"] for r in got] == [3, 0, 0, 0]


def plain_targets(sizes):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = dict(zip(order, [5, 2, 1] * len(order)))
    total, target, open_ = float(sum(sizes.values())), {}, set(order)
    while True:
        rest = total - sum(target.values())
        weight = sum(w[s] for s in open_)
        over = [s for s in open_ if rest * w[s] / weight > 3 * sizes[s]] if weight else []
        if not over:
            return {**target, **{s: rest * w[s] / weight for s in open_}}
        for s in over:
            target[s] = 3.0 * sizes[s]
        open_ -= set(over)


@pytest.mark.parametrize("sizes", [
    {"a": 10, "b": 1000, "c": 50, None: 70}, {"a": 5}, {"b": 0, "c": 40, "d": 1},
    {f"s{i}": (i * 37) % 91 + 1 for i in range(20)}, {"Z": 3, "a": 900, "é": 8, "": 4}])
def test_targets(spark, sizes):
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r["source"]: r["target"] for r in source_targets(df).collect()}
    want = plain_targets(sizes)
    assert got.keys() == want.keys()
    for s in want:
        assert got[s] == pytest.approx(want[s], abs=1e-6)


def sized_rows():
    rng = random.Random(5)
    rows = [(i, rng.choice(["a", "a", "a", "b", "c", None]), rng.choice([0, 1, 7, 40, 400])) for i in range(1500)]
    return rows + [(9000, "b", 11)] * 300 + [(None, "c", 5)] * 3


def test_mix_rows_targets_and_reruns(spark):
    rows = sized_rows()
    df = spark.createDataFrame(rows, "id long, source string, size long")
    key = ["id", "source", "size", "copies"]
    one = sorted(map(tuple, mix(df, block=16).select(*key).collect()), key=repr)
    two = sorted(map(tuple, mix(df.repartition(3, "size"), block=16).select(*key).collect()), key=repr)
    assert one == two
    assert sorted([r[:3] for r in one], key=repr) == sorted(rows, key=repr)     # every row once
    sizes = {}
    for _, s, n in rows:
        sizes[s] = sizes.get(s, 0) + n
    want = plain_targets(sizes)
    for s in sizes:
        taken = sum(r[2] * r[3] for r in one if r[1] == s)
        assert abs(taken - want[s]) <= 400
    assert all(r[3] <= 3 for r in one)


def test_mix_is_fair_over_seeds(spark):
    df = spark.createDataFrame([(i, "ab"[i % 2], 10 + i) for i in range(40)], "id long, source string, size long")
    total = {}
    for seed in range(12):
        for r in mix(df, block=8, seed=seed).collect():
            total[r["id"]] = total.get(r["id"], 0) + r["copies"]
    a = [v / 12 for k, v in total.items() if k % 2 == 0]
    # the expected number of copies of source a is its target over its size
    size_a, size = sum(10 + i for i in range(0, 40, 2)), sum(10 + i for i in range(40))
    assert sum(a) / len(a) == pytest.approx(size * 5 / 7 / size_a, abs=0.15)


def test_mixed_rows_keep_columns_and_empty(spark):
    d = spark.createDataFrame([(1, "x y", "s", 5), (2, None, None, 6), (1, "x y", "s", 7)],
                              "doc_id long, text string, source string, copies long")
    out = mixed_rows(d, word_count(F.col("text")))
    assert out.columns == d.columns
    got = sorted(map(tuple, out.collect()), key=repr)
    assert {r[3] for r in got} == {5, 6, 7}       # one source takes all there is, once
    none = mixed_rows(d.limit(0), word_count(F.col("text")))
    assert none.count() == 0
