"""Capture, recover, cast: edge rows and laws."""

import json

from pyspark.sql import functions as F

from strandline.functions.columns import (capture, cast_to_contract, clear_rescued, lineage,
                                          recover, rescued_filter)


def rows(df, *cols):
    return [tuple(r[c] for c in cols) for r in df.orderBy("k").collect()]


def test_capture_misfits_keep_text(spark):
    df = spark.createDataFrame(
        [(1, "12.5", "yes", 1.5), (2, "7", "abc", 2.0), (3, " 7 ", "t", 3.25), (4, None, None, None)],
        "k long, n string, b string, d double")
    out = capture(df, {"n": "long", "b": "boolean", "d": "long"})
    got = rows(out, "k", "n", "b", "d", "_rescued_data")
    assert got[0][:4] == (1, None, True, None)
    assert json.loads(got[0][4]) == {"n": "12.5", "d": "1.5"}
    assert got[1][:4] == (2, 7, None, 2) and json.loads(got[1][4]) == {"b": "abc"}
    assert got[2] == (3, 7, True, None, '{"d":"3.25"}')
    assert got[3] == (4, None, None, None, None)     # NULL is not a misfit; no '{}'


def test_capture_merges_incoming_rescued(spark):
    df = spark.createDataFrame(
        [(1, "x", '{"a":"1","n":"old"}'), (2, "5", "not json"), (3, "y", "not json"),
         (4, "6", None), (5, "z", None)],
        "k long, n string, _rescued_data string")
    got = rows(capture(df, {"n": "long"}), "k", "n", "_rescued_data")
    assert json.loads(got[0][2]) == {"a": "1", "n": "x"}   # new text wins on its name
    assert got[1] == (2, 5, "not json")                   # incoming text kept as is
    assert json.loads(got[2][2]) == {"_rescued_data": "not json", "n": "y"}   # nothing lost
    assert got[3] == (4, 6, None)
    assert got[4] == (5, None, '{"n":"z"}')


def test_capture_without_evolution_rescues_new_column(spark):
    df = spark.createDataFrame([(1, "v")], "k long, extra string")
    out = capture(df, {"extra": None})
    assert out.columns == ["k", "_rescued_data"]
    assert out.collect()[0]["_rescued_data"] == '{"extra":"v"}'


def test_recover_edge_rows(spark):
    df = spark.createDataFrame([
        (1, None, None, '{"a":"12.5","b":"yes"}'),        # both recovered
        (2, 3.0, None, '{"a":"12.5"}'),                   # filled column wins; conflict stays
        (3, None, None, "not json"),                      # invalid JSON: untouched
        (4, None, None, "{}"),                            # empty object
        (5, None, None, '{"a":"n/a","z":"q"}'),           # not castable + unknown key
        (6, None, None, '{"a.b":"5"}'),                   # dotted name, new column
        (7, None, None, None),
    ], "k long, a double, b boolean, _rescued_data string")
    types = {"a": "double", "b": "boolean", "a.b": "long"}
    keep = rows(recover(df, types, residual="keep"), "k", "a", "b", "a.b", "_rescued_data")
    assert keep == [
        (1, 12.5, True, None, None),
        (2, 3.0, None, None, '{"a":"12.5"}'),
        (3, None, None, None, "not json"),
        (4, None, None, None, None),
        (5, None, None, None, '{"a":"n/a","z":"q"}'),
        (6, None, None, 5, None),
        (7, None, None, None, None),
    ]
    none = rows(recover(df, types), "k", "a", "_rescued_data")
    assert [r[2] for r in none] == [r["_rescued_data"] for r in df.orderBy("k").collect()]
    clear = rows(recover(df, types, residual="clear"), "k", "a", "_rescued_data")
    assert all(r[2] is None for r in clear) and clear[0][1] == 12.5


def test_fractional_text_is_not_a_long(spark):
    df = spark.createDataFrame([(1, None, '{"n":"12.5"}'), (2, None, '{"n":"12"}')],
                               "k long, n long, _rescued_data string")
    got = rows(recover(df, {"n": "long"}, residual="keep"), "k", "n", "_rescued_data")
    assert got == [(1, None, '{"n":"12.5"}'), (2, 12, None)]


def test_guard_limits_changes(spark):
    df = spark.createDataFrame([(1, None, '{"a":"1"}'), (None, None, '{"a":"2"}')],
                               "k long, a double, _rescued_data string")
    out = recover(df, {"a": "double"}, residual="clear", guard=F.col("k").isNotNull())
    got = sorted(out.collect(), key=lambda r: r["a"] if r["a"] is not None else -1)
    assert (got[0]["a"], got[0]["_rescued_data"]) == (None, '{"a":"2"}')
    assert (got[1]["a"], got[1]["_rescued_data"]) == (1.0, None)


def test_law_capture_then_recover_is_identity(spark):
    li = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    text = li.select(F.when(F.col("l_linenumber") % 3 == 0, F.lit("bad"))
                     .otherwise(F.col("l_quantity").cast("string")).alias("l_quantity"))
    text = text.select("l_quantity", F.col("l_quantity").alias("orig"))   # rides along untouched
    cap = capture(text, {"l_quantity": "double"})
    assert cap.count() == li.count()                           # rows in = rows out
    bad = cap.filter(F.col("orig") == "bad")
    assert bad.filter(F.col("l_quantity").isNotNull()
                      | (F.col("_rescued_data") != '{"l_quantity":"bad"}')).count() == 0
    good = cap.filter(F.col("orig") != "bad")
    assert good.filter(F.col("_rescued_data").isNotNull()
                       | (F.col("l_quantity") != F.col("orig").cast("double"))).count() == 0
    # recovering the captured text as a string gives the original text back
    back = recover(cap.withColumn("l_quantity", F.lit(None).cast("string")),
                   {"l_quantity": "string"}, residual="keep")
    assert bad.count() == back.filter(F.col("l_quantity") == F.col("orig")).count()
    assert back.filter(F.col("_rescued_data").isNotNull()).count() == 0


def test_cast_to_contract_skips_absent(spark):
    df = spark.createDataFrame([("1", "2.5", "true")], "a string, b string, c string")
    out = cast_to_contract(df, {"a": "long", "b": "double", "c": "boolean", "zz": "long"})
    assert out.dtypes == [("a", "bigint"), ("b", "double"), ("c", "boolean")]
    assert tuple(out.collect()[0]) == (1, 2.5, True)


def test_clear_and_filter_and_lineage(spark):
    df = spark.createDataFrame([(1, '{"a":"1"}'), (2, None)], "k long, _rescued_data string")
    assert rescued_filter(df).count() == 1
    assert rescued_filter(clear_rescued(df)).count() == 0
    e = lineage(spark.read.parquet("/root/testdata/sf0.001/events.parquet"))
    r = e.select("_source_file", "_ingestion_time").first()
    assert r["_source_file"].endswith("events.parquet") and r["_ingestion_time"] is not None


def test_capture_keeps_what_a_cast_would_lose(spark):
    df = spark.sql("""SELECT 2 AS b, 0.3D AS b2, 9007199254740993L AS d, TIMESTAMP '2024-01-01 10:00:00' AS t,
                             CAST(1.2345 AS DECIMAL(10,4)) AS p, '1.2345' AS tp, '2024-01-01 10:00' AS td,
                             '1.50' AS fits, 'yes' AS flag, '2024-01-01' AS day, 1 AS one""")
    out = capture(df, {"b": "boolean", "b2": "boolean", "d": "double", "t": "date", "p": "decimal(10,2)",
                       "tp": "decimal(10,2)", "td": "date", "fits": "double", "flag": "boolean", "day": "date",
                       "one": "boolean"}).first()
    import json
    lost = json.loads(out["_rescued_data"])
    assert set(lost) == {"b", "b2", "d", "t", "p", "tp", "td"} and lost["d"] == "9007199254740993"
    assert all(out[c] is None for c in lost)
    assert (out["fits"], out["flag"], str(out["day"]), out["one"]) == (1.5, True, "2024-01-01", True)


def test_capture_with_a_repeated_json_name(spark):
    df = spark.createDataFrame([("x", '{"a":"1","a":"2","v":"old"}'), ("7", '{"a":"1","a":"2"}'), ("y", "no json")],
                               "v string, _rescued_data string")
    import json
    got = [(r["v"], r["_rescued_data"]) for r in capture(df, {"v": "long"}).collect()]
    assert got[0][0] is None and json.loads(got[0][1]) == {"a": "2", "v": "x"}
    assert got[1] == (7, '{"a":"1","a":"2"}')
    assert json.loads(got[2][1]) == {"_rescued_data": "no json", "v": "y"}


def test_capture_keeps_what_a_cast_inside_a_nested_value_would_lose(spark):
    df = spark.sql("""SELECT array('a', '1') AS a, named_struct('x', 'a', 'y', 2) AS s, array(1.5D, 2D) AS f,
                             map('k', '1', 'l', 'b') AS m, array(named_struct('v', array('1', 'z'))) AS deep,
                             named_struct('p', 1, 'q', 2) AS swapped, array('9007199254740993') AS digits,
                             map(1.5D, 'x') AS keys
                      UNION ALL
                      SELECT array('2', NULL), named_struct('x', '1', 'y', NULL), array(3D), map('k', '2'),
                             array(named_struct('v', array('1', NULL)), NULL), NULL, array('1.50', NULL), map(2D, 'y')
                      UNION ALL SELECT array(), NULL, NULL, map(), NULL, NULL, NULL, NULL""")
    types = {"a": "array<int>", "s": "struct<x:int,y:bigint>", "f": "array<int>", "m": "map<string,int>",
             "deep": "array<struct<v:array<int>>>", "swapped": "struct<q:bigint,p:bigint>", "digits": "array<double>",
             "keys": "map<int,string>"}
    bad, good, none = capture(df, types).collect()
    assert json.loads(bad["_rescued_data"]) == {
        "a[0]": "a", "s.x": "a", "f[0]": "1.5", 'm["l"]': "b", "deep[0].v[1]": "z", "digits[0]": "9007199254740993",
        "keys": '{"1.5":"x"}'}
    assert (bad["a"], tuple(bad["s"]), bad["f"], bad["m"]) == ([None, 1], (None, 2), [None, 2], {"k": 1, "l": None})
    assert bad["deep"][0]["v"] == [1, None] and tuple(bad["swapped"]) == (2, 1) and bad["keys"] is None
    assert good["_rescued_data"] is None and good["keys"] == {2: "y"}
    assert (good["a"], tuple(good["s"]), good["m"], good["digits"]) == ([2, None], (1, None), {"k": 2}, [1.5, None])
    assert good["deep"][0]["v"] == [1, None] and good["deep"][1] is None
    assert none["_rescued_data"] is None and none["a"] == [] and none["m"] == {}


def test_capture_keeps_digits_of_text_in_floats(spark):
    fits = ["9007199254740992", "1.50", "0.1", "-1e300", "1234567890.12345", " 7 ", "Infinity", "NaN", "0.000", "1.0E23",
            "0.30000000000000004", "100000000000000000000000", "00000000000000000001.5"]
    lost = ["9007199254740993", "1e999", "1e-999", "123456789012345678901234567891", "1.2345678901234567890123e-30", "x"]
    df = spark.createDataFrame([(t, i) for i, t in enumerate(fits + lost)], "d string, i int")
    got = [(r["d"], r["_rescued_data"]) for r in capture(df, {"d": "double"}).orderBy("i").collect()]
    assert all(d is not None and r is None for d, r in got[:len(fits)]), got
    assert [(d, json.loads(r)["d"]) for d, r in got[len(fits):]] == [(None, t) for t in lost]
    df = spark.createDataFrame([("16777217",), ("0.1",), ("16777216",)], "d string")
    assert [r["d"] is None for r in capture(df, {"d": "float"}).collect()] == [True, False, False]


def test_text_into_decimals_and_timestamps_loses_nothing_and_fails_nothing(spark):
    """(text, type, whether it fits): no text fails the batch."""
    cases = [("1234567890123456789012345", "decimal(38,0)", True), ("1" * 39, "decimal(38,0)", False),
             ("1.0000000000000000001", "decimal(12,2)", False), ("1.123456789012345678901234", "decimal(38,20)", False),
             ("1.12345678901234567890", "decimal(38,20)", True), ("1.500", "decimal(12,2)", True), ("-0.00", "decimal(12,2)", True),
             ("1.5e1", "decimal(12,2)", True), ("1e-5", "decimal(12,2)", False), ("99999999999999999999", "decimal(12,2)", False),
             ("x", "decimal(12,2)", False), ("0.005", "decimal(12,2)", False), (" 7 ", "decimal(12,2)", True),
             ("10:00", "timestamp", False), ("T10:00", "timestamp", False), ("2024-01-02 10:00", "timestamp", True),
             ("2024-01-02 10:00:00.123456", "timestamp", True), ("2024-01-02 10:00:00.1234560", "timestamp", True),
             ("2024-01-02 10:00:00.1234567", "timestamp", False), ("2024-01-02T10:00:00Z", "timestamp", True),
             ("2024-01-02 10:00", "timestamp_ntz", True), ("2024-01-02 10:00:00+05:00", "timestamp_ntz", False),
             ("2024-01-02 10:00:00 Europe/Paris", "timestamp_ntz", False), ("10:00", "timestamp_ntz", False),
             ("2024-01-02", "date", True), ("2024-01-02 00:00:00", "date", True), ("2024-01-02 10:00", "date", False),
             ("2024-01-02 xyz", "date", False), ("2024-01-02 00:00:00.0000001", "date", False), ("10:00", "date", False)]
    for t in sorted({t for _, t, _ in cases}):
        own = [(x, fits) for x, u, fits in cases if u == t]
        df = spark.createDataFrame([(i, x) for i, (x, _) in enumerate(own)], "i int, v string")
        got = capture(df, {"v": t}).orderBy("i").collect()
        for r, (x, fits) in zip(got, own):
            assert (r["v"] is not None) == fits, (x, t, r)
            assert (None if fits else {"v": x}) == (json.loads(r["_rescued_data"]) if r["_rescued_data"] else None), (x, t)


def test_nested_values_come_back_from_their_addresses(spark):
    """capture, then recover as text: the whole value again, whatever its names
    and depth; entries of healthy parts are none."""
    wide = "struct<s:string,`odd name`:array<string>,m:map<string,struct<x:string>>,n:struct<d:string>>"
    narrow = "struct<s:int,`odd name`:array<int>,m:map<string,struct<x:date>>,n:struct<d:decimal(12,2)>>"
    rows = [("1", ["2", "x", None, "4.5"], {"k": ("2024-01-02",), 'q"] .': ("no day",)}, ("1.25",)),
            ("no", [], {}, ("1.255",)), (None, None, None, None), ("7", ["8"], {"a.b": ("2024-13-01",)}, (None,))]
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)] + [(9, None)], f"i int, info {wide}")
    got = capture(df, {"info": narrow})
    lost = {r["i"]: json.loads(r["_rescued_data"] or "{}") for r in got.collect()}
    assert lost[0] == {"info.`odd name`[1]": "x", "info.`odd name`[3]": "4.5", 'info.m["q\\"] ."].x': "no day"}
    assert lost[1] == {"info.s": "no", "info.n.d": "1.255"} and lost[2] == lost[9] == {}
    for residual in ("none", "keep"):
        back = recover(got, {"info": wide}, residual=residual)
        assert back.schema["info"].dataType == df.schema["info"].dataType
        assert sorted(map(repr, back.select("i", "info").collect())) == sorted(map(repr, df.collect()))
        left = {r["i"]: r["_rescued_data"] for r in back.collect()}
        assert all(v is None for v in left.values()) if residual == "keep" else left[1] is not None
    # a column that is called like an address inside another
    both = spark.createDataFrame([(("x",), "y")], "info struct<s:string>, `info.s` string")
    r = capture(both, {"info": "struct<s:int>", "info.s": "int"})
    assert json.loads(r.first()["_rescued_data"]) == {"`info`.s": "x", "info.s": "y"}
    back = recover(r, {"info": "struct<s:string>", "info.s": "string"}, residual="keep").first()
    assert (back[0]["s"], back[1], back["_rescued_data"]) == ("x", "y", None)


def test_type_joins_do_not_depend_on_order():
    import itertools
    from pyspark.sql import types as T
    from strandline.functions.lattice import join, join_columns
    names = ["tinyint", "int", "bigint", "decimal(12,2)", "decimal(38,20)", "float", "double", "boolean", "date",
             "timestamp_ntz", "timestamp", "string", "binary", "array<int>", "array<string>", "struct<z:int,a:int>",
             "struct<A:bigint,m:struct<x:date>>", "struct<z:int,m:struct<x:int,y:int>>", "map<string,int>", "map<int,double>"]
    types = [T.DataType.fromDDL(n) for n in names]
    for a, b in itertools.product(types, types):
        assert join(a, b) == join(b, a) and join(a, a) == a
    for a, b, c in itertools.product(types, types, types):
        assert join(join(a, b), c) == join(a, join(b, c)), (a, b, c)
    one = [T.DataType.fromDDL(x) for x in ("id bigint, v int", "v double, ID int, w string", "w struct<a:int>, v int, id int")]
    assert len({join_columns(p).json() for p in itertools.permutations(one)}) == 1
    assert join_columns(one).simpleString() == "struct<ID:bigint,v:double,w:string>"
