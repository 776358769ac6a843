"""Property tests: whatever text arrives, nothing is lost."""

import json

import pytest

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from strandline.functions.columns import capture, recover

texts = st.one_of(
    st.floats(allow_nan=True, allow_infinity=True).map(repr),
    st.integers(min_value=-10**20, max_value=10**20).map(str),
    st.text(max_size=12),
    st.sampled_from(["", " 7 ", "1e3", "NaN", "n/a", "12.5", "yes", "-0", "1,5", '"q"', "{}"]),
    st.none(),
)


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(texts, min_size=1, max_size=40), st.sampled_from(["double", "long", "boolean"]))
def test_capture_loses_nothing_and_recovers_text(spark, values, typ):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i long, v string")
    cap = capture(df, {"v": typ})
    got = {r["i"]: (r["v"], r["_rescued_data"]) for r in cap.collect()}
    assert len(got) == len(values)                       # rows in = rows out
    for i, v in enumerate(values):
        val, resc = got[i]
        if v is None:
            assert (val, resc) == (None, None)
        elif resc is None:
            assert val is not None                       # it fit: the value is there
        else:
            assert val is None and json.loads(resc) == {"v": v}   # it did not: text kept whole
    # recovering as text returns every rescued text and clears what it used
    back = recover(cap.withColumn("v", F.lit(None).cast("string")), {"v": "string"},
                   residual="keep")
    for r in back.collect():
        v = values[r["i"]]
        if got[r["i"]][1] is not None:
            assert r["v"] == v and r["_rescued_data"] is None


keys = st.one_of(st.none(), st.integers(min_value=0, max_value=6))


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(keys, st.one_of(st.none(), st.floats(-5, 5)), st.booleans()),
                min_size=1, max_size=25),
       st.lists(st.tuples(keys, st.floats(-5, 5)), max_size=10),
       st.sampled_from([1, 2, 5, 1000]))
def test_update_by_key_matches_a_brute_force_model(spark, target, source, hot):
    from strandline.operators.repair import update_by_key
    t = spark.createDataFrame([(i, k, p, '{"p":"x"}' if r else None)
                               for i, (k, p, r) in enumerate(target)],
                              "i long, k long, p double, _rescued_data string")
    s = spark.createDataFrame(source, "k long, p double")
    by_key = {}
    for k, p in source:
        if k is not None:
            by_key.setdefault(k, []).append(p)
    ambiguous = any(k is not None and r and len(by_key.get(k, [])) > 1 for k, _, r in target)
    out = update_by_key(t, s, "k", ["p"], parts=hot)   # what counts as hot must not change it
    if ambiguous:
        with pytest.raises(Exception, match="DUPLICATE_SOURCE_KEY"):
            out.collect()
        return
    got = {r["i"]: (r["k"], r["p"], r["_rescued_data"]) for r in out.collect()}
    want = {}
    for i, (k, p, r) in enumerate(target):
        hit = r and k is not None and k in by_key
        want[i] = (k, by_key[k][0], None) if hit else (k, p, '{"p":"x"}' if r else None)
    assert got == want


NUMBERS = st.one_of(st.none(), st.integers(-2**62, 2**62).map(float), st.floats(allow_nan=False),
                    st.integers(-300, 300).map(float), st.sampled_from([0.0, 1.0, 0.3, 2.0, 1.5, 2.0**53 + 2]))


@settings(max_examples=25, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(NUMBERS, min_size=1, max_size=12),
       st.sampled_from(["long", "int", "byte", "boolean", "float", "decimal(10,2)", "date"]))
def test_what_capture_keeps_comes_back(spark, values, typ):
    """A number stays in its column only if the column gives it back."""
    if typ == "date":
        df = spark.createDataFrame([(i, None if v is None else i * 43200 + 10) for i, v in enumerate(values)], "i long, s long") \
            .select("i", F.timestamp_seconds("s").alias("v"))
        src = "timestamp"
    else:
        df, src = spark.createDataFrame(list(enumerate(values)), "i long, v double"), "double"
    cap = capture(df, {"v": typ}).withColumnRenamed("v", "c")
    for r in df.join(cap, "i").select("i", "v", "_rescued_data", F.col("c").isNotNull().alias("kept"),
                                      F.col("c").cast(src).eqNullSafe(F.col("v")).alias("same")).collect():
        assert r["kept"] == (r["v"] is not None and r["_rescued_data"] is None)
        assert r["same"] or r["_rescued_data"] is not None
