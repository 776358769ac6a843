"""Secret scans: fixed patterns and a randomness test battery.

Base spans come from three patterns (see ``BASE``). The battery adds tokens
that no pattern names:

* Tokens of 20 and more characters of the base64 alphabets are candidates; each
  gets the smallest encoding whose alphabet holds it.
* *Against randomness*: a chi-squared test of a uniform alphabet, a runs test
  about the median and a test of serial correlation. A token that fails one
  at level ``REFUTE`` is not random.
* *Against ordinary text*: the same three statistics (collisions, which are
  chi-squared up to scale; changes between kinds of characters; serial correlation) are
  measured on all ordinary tokens of 12 to 19 characters, too short to be candidates.
  A candidate's p-values under that model are combined by Fisher's method. Tails are
  bounded from above (Chernoff), so p-values err on the safe side.
* *False discoveries*: Benjamini-Hochberg at ``FDR`` within each range of lengths,
  so the many short tokens do not lend their discoveries to the few long, nor
  the other way round.

The texts are read once. What is collected is the model's few numbers and
one threshold for each range of lengths.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandline.llm.common import stored

#: Fixed values of the contract: kind, pattern, group whose length counts, least length.
#: ``hex`` and ``access`` are greedy over a class, so a least length inside the
#: pattern finds the same as dropping short matches; ``assign`` is not.
BASE = (
    ("assign", r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 1, 8),
    ("access", r"AKIA[A-Z0-9]{12,}", 0, 16),
    ("hex", r"[0-9a-f]{32,}", 0, 32),
)
TOKEN = "[A-Za-z0-9+/_=-]"
LEAST, ORDINARY = 20, 12
#: Encodings by size of alphabet, smallest first: kind, pattern, size.
ENCODINGS = (
    ("hex", r"^(?:[0-9a-f]+|[0-9A-F]+)$", 16),
    ("lower", r"^[a-z]+$", 26),
    ("upper", r"^[A-Z]+$", 26),
    ("base32", r"^[A-Z2-7]+=*$", 32),
    ("base36", r"^(?:[0-9a-z]+|[0-9A-Z]+)$", 36),
    ("base62", r"^[0-9A-Za-z]+$", 62),
    ("base64", r"^[0-9A-Za-z+/_=-]+$", 64),
)
LENGTHS = (20, 24, 32, 48, 80, 160)     # lower ends of the ranges of lengths
REFUTE = 1e-4
FDR = 0.01
BIN = 0.25          # of -ln p, in which discoveries are counted
MOST = 600.0        # largest -ln p told apart

SPAN = "struct<start:int,rank:int,kind:string,end:int>"
TOKENS = ("array<struct<start:int,end:int,n:int,collisions:bigint,changes:int,serial:double,"
          "runs:double,size:int,encoding:string>>")


def _placed(text: Column, pattern: str, group: int = 0) -> Column:
    """Leftmost matches of ``pattern`` as (start, end, group): code points, end
    exclusive. What stands between matches is what ``split`` leaves."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    inner = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else found
    gaps = F.split(text, pattern, -1)
    both = F.zip_with(found, inner, lambda a, b: F.struct(F.length(a).alias("n"), b.alias("g")))
    both = F.zip_with(F.slice(gaps, 1, F.size(found)), both,
                      lambda a, b: F.struct(F.length(a).alias("gap"), b["n"].alias("n"), b["g"].alias("g")))
    none = "array<struct<start:int,end:int,g:string>>"
    zero = F.struct(F.lit(0).alias("at"), F.array().cast(none).alias("out"))

    def step(s, m):
        start = s["at"] + m["gap"]
        return F.struct((start + m["n"]).alias("at"), F.array_append(s["out"], F.struct(
            start.alias("start"), (start + m["n"]).alias("end"), m["g"].alias("g"))).alias("out"))
    return F.when(F.size(found) > 0, F.aggregate(both, zero, step)["out"]).otherwise(F.array().cast(none))


def base_spans(text: Column) -> Column:
    """All base spans, by start, then kind as listed."""
    parts = []
    for rank, (kind, pattern, group, least) in enumerate(BASE):
        parts.append(_spans(_placed(text, pattern, group), rank, F.lit(kind), least))
    return F.sort_array(F.concat(*parts)).cast(f"array<{SPAN}>")


def _spans(hits: Column, rank: int, kind: Column, least: int) -> Column:
    return F.transform(F.filter(hits, lambda m: F.length(m["g"]) >= least), lambda m: F.struct(
        m["start"].alias("start"), F.lit(rank).alias("rank"), kind.alias("kind"), m["end"].alias("end")))


def _kind_of(code: Column) -> Column:
    """Digit, upper, lower or sign."""
    return (F.when((code >= 48) & (code <= 57), 0).when((code >= 65) & (code <= 90), 1)
            .when((code >= 97) & (code <= 122), 2).otherwise(3))


def _measured(token: Column) -> Column:
    """The statistics of a token: number of characters, ordered pairs of equal
    characters, changes of kind, lag-1 serial correlation of the codes, and
    the runs test's z about the median."""
    codes = F.transform(F.filter(F.split(token, ""), lambda c: c != ""), lambda c: F.ascii(c))

    def with_codes(a):
        n = F.size(a)
        ordered = F.sort_array(a)
        zero = F.struct(F.lit(-1).alias("v"), F.lit(0).cast("long").alias("run"), F.lit(0).cast("long").alias("sum"))
        collisions = F.aggregate(ordered, zero, lambda s, v: F.struct(
            v.alias("v"), F.when(v == s["v"], s["run"] + 1).otherwise(F.lit(0).cast("long")).alias("run"),
            (s["sum"] + F.when(v == s["v"], 2 * (s["run"] + 1)).otherwise(0)).cast("long").alias("sum")))["sum"]
        middle = F.get(ordered, F.floor(n / 2).cast("int"))
        first = F.get(a, 0)
        start = F.struct(first.alias("v"), F.lit(0).alias("changes"), F.lit(0).alias("high"), F.lit(1).alias("runs"),
                         F.lit(0.0).alias("s"), F.lit(0.0).alias("q"), F.lit(0.0).alias("x"))

        def step(s, v):
            d, p = (v - middle).cast("double"), (s["v"] - middle).cast("double")
            return F.struct(
                v.alias("v"), (s["changes"] + F.when(_kind_of(v) != _kind_of(s["v"]), 1).otherwise(0)).alias("changes"),
                (s["high"] + F.when(v >= middle, 1).otherwise(0)).alias("high"),
                (s["runs"] + F.when((v >= middle) != (s["v"] >= middle), 1).otherwise(0)).alias("runs"),
                (s["s"] + d).alias("s"), (s["q"] + d * d).alias("q"), (s["x"] + d * p).alias("x"))
        w = F.aggregate(a, start, step)
        return F.struct(n.alias("n"), collisions.alias("collisions"), w.alias("w"), (first - middle).alias("f"))

    def finish(m):
        n, w = m["n"].cast("double"), m["w"]
        mean = w["s"] / n
        # the first character met itself as its neighbour: take that product out
        cross = w["x"] - (m["f"] * m["f"]).cast("double")
        spread = w["q"] - n * mean * mean
        serial = F.when(spread > 0, (cross - (n - 1) * mean * mean) / spread).otherwise(F.lit(1.0))
        a = w["high"].cast("double")
        b = n - a
        mu = 2 * a * b / n + 1
        var = (mu - 1) * (mu - 2) / F.greatest(n - 1, F.lit(1.0))
        runs = F.when(var > 0, (w["runs"] - mu) / F.sqrt(var)).otherwise(F.lit(99.0))
        return F.struct(m["n"].alias("n"), m["collisions"].alias("collisions"), w["changes"].alias("changes"),
                        serial.alias("serial"), runs.alias("runs"))
    # each value is computed once: a list of one, transformed
    return F.get(F.transform(F.transform(F.array(codes), with_codes), finish), 0)


def scan(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, base, candidates, ordinary): one read of the texts."""
    t = F.coalesce(F.col(text_col), F.lit(""))
    d = docs.select(F.col(id_col).alias("doc_id"), t.alias("t"))
    short = F.filter(F.regexp_extract_all("t", F.lit(f"{TOKEN}{{{ORDINARY},}}"), F.lit(0)),
                     lambda x: F.length(x) < LEAST)
    d = d.select("doc_id", base_spans(F.col("t")).alias("base"),
                 _placed(F.col("t"), f"{TOKEN}{{{LEAST},}}").alias("long"),
                 F.transform(short, _measured).alias("ordinary"))
    # a candidate that a base span touches is known already
    free = F.filter("long", lambda m: ~F.exists("base", lambda b: (b["start"] < m["end"]) & (m["start"] < b["end"])))

    def tested(m):
        s, size, name = _measured(m["g"]), F.lit(64), F.lit("base64")
        for kind, pattern, k in reversed(ENCODINGS):
            hit = m["g"].rlike(pattern)
            size, name = F.when(hit, F.lit(k)).otherwise(size), F.when(hit, F.lit(kind)).otherwise(name)
        return F.transform(F.array(s), lambda x: F.struct(
            m["start"].alias("start"), m["end"].alias("end"), x["n"].alias("n"), x["collisions"].alias("collisions"),
            x["changes"].alias("changes"), x["serial"].alias("serial"), x["runs"].alias("runs"),
            size.alias("size"), name.alias("encoding")))[0]
    return d.select("doc_id", "base", F.transform(free, tested).cast(TOKENS).alias("candidates"), "ordinary")


def _tail(z: Column) -> Column:
    """-ln of a bound on P(Z > z) for a normal Z: exp(-z^2 / 2) / 2."""
    return F.when(z > 0, z * z / 2 + math.log(2)).otherwise(F.lit(math.log(2)))


def looks_random(c: Column) -> Column:
    """Whether none of the three tests refutes randomness at ``REFUTE``."""
    n, k = c["n"].cast("double"), c["size"].cast("double")
    chi = (c["collisions"] + n) * k / n - n
    df = k - 1
    # Wilson-Hilferty: the cube root of chi-squared / df is nearly normal
    z = (F.pow(F.greatest(chi, F.lit(0.0)) / df, F.lit(1 / 3)) - (1 - 2 / (9 * df))) / F.sqrt(2 / (9 * df))
    limit = -math.log(REFUTE)
    two = -math.log(REFUTE / 2)
    return ((_tail(z) < limit) & (_tail(F.abs(c["runs"])) < two)
            & (_tail(F.abs(c["serial"] + 1 / n) * F.sqrt(n)) < two))


#: Model of ordinary tokens where the corpus has fewer than 100 of them: pairs
#: equal, changes of kind per step, serial correlation, and spreads of the z's.
PRIOR = {"pairs": 0.08, "steps": 0.02, "serial": -0.1, "pair_sd": 1.5, "serial_sd": 1.0}


def ordinary_model(scanned: DataFrame) -> dict[str, float]:
    o = scanned.select(F.explode("ordinary").alias("o")).select("o.*")
    a = o.agg(F.count(F.lit(1)).alias("m"), F.sum("collisions").alias("c"),
              F.sum(F.col("n") * (F.col("n") - 1)).alias("p"), F.sum("changes").alias("h"),
              F.sum(F.col("n") - 1).alias("s"), F.avg("serial").alias("r")).first()
    if not a["m"] or a["m"] < 100:
        return dict(PRIOR)
    pairs = min(max(a["c"] / a["p"], 1e-3), 0.5)
    steps, serial = min(max(a["h"] / a["s"], 1e-3), 0.5), a["r"]
    both = F.col("n") * (F.col("n") - 1)
    z = (F.col("collisions") - both * pairs) / F.sqrt(2 * both * pairs * (1 - pairs))
    b = o.agg(F.stddev_pop(z).alias("z"), F.stddev_pop((F.col("serial") - serial) * F.sqrt("n")).alias("r")).first()
    return {"pairs": pairs, "steps": steps, "serial": serial, "pair_sd": max(1.0, b["z"] or 1.0),
            "serial_sd": max(0.5, b["r"] or 1.0)}


def evidence(c: Column, model: dict[str, float]) -> Column:
    """-ln p of a candidate under the model of ordinary tokens."""
    n = c["n"].cast("double")
    both = n * (n - 1)
    pairs = model["pairs"]
    z = (both * pairs - c["collisions"]) / (F.sqrt(2 * both * pairs * (1 - pairs)) * model["pair_sd"])
    fewer = _tail(z)
    share = F.least(F.lit(1 - 1e-9), c["changes"] / (n - 1))
    steps = model["steps"]
    more = F.when(share > steps, (n - 1) * (share * F.log(share / steps)
                                            + (1 - share) * F.log((1 - share) / (1 - steps)))).otherwise(F.lit(0.0))
    apart = F.abs(c["serial"] - model["serial"]) * F.sqrt(n) / model["serial_sd"]
    serial = F.greatest(F.lit(0.0), _tail(apart) - math.log(2))
    # Fisher: the sum of three -ln p is gamma distributed
    x = fewer + more + serial
    return F.least(F.lit(MOST), F.greatest(F.lit(0.0), x - F.log(1 + x + x * x / 2)))


def _range(n: Column) -> Column:
    out = F.lit(0)
    for k, low in enumerate(LENGTHS):
        out = F.when(n >= low, F.lit(k)).otherwise(out)
    return out


def thresholds(scanned: DataFrame, model: dict[str, float], fdr: float = FDR) -> dict[int, float]:
    """Least -ln p of a discovery by range of lengths (Benjamini-Hochberg, from
    counts of candidates in bins of -ln p: at most MOST / BIN rows a range)."""
    c = scanned.select(F.explode("candidates").alias("c"))
    binned = c.select(_range(F.col("c.n")).alias("range"),
                      F.floor(evidence(F.col("c"), model) / BIN).alias("bin")).groupBy("range", "bin").agg(
                          F.count(F.lit(1)).alias("k"))
    w = Window.partitionBy("range")
    down = w.orderBy(F.desc("bin")).rowsBetween(Window.unboundedPreceding, 0)
    b = (binned.withColumn("found", F.sum("k").over(down)).withColumn("m", F.sum("k").over(w))
         .filter(F.col("m") * F.exp(-F.col("bin") * BIN) <= fdr * F.col("found")))
    return {r["range"]: r["low"] * BIN for r in b.groupBy("range").agg(F.min("bin").alias("low")).collect()}


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", fdr: float = FDR) -> DataFrame:
    """One row per row of ``docs``: (doc_id, base, added), arrays of spans (start,
    rank, kind, end) by start: those of the patterns, and those of the battery,
    of kind ``random-<encoding>``.

    A null text is empty and has no span. An empty table gives no row.
    """
    scanned = stored(scan(docs, id_col, text_col), "secret-scan")
    model = ordinary_model(scanned)
    least = thresholds(scanned, model, fdr)

    def found(c):
        low = F.lit(2 * MOST)
        for k, y in least.items():
            low = F.when(_range(c["n"]) == k, F.lit(y)).otherwise(low)
        return (evidence(c, model) >= low) & looks_random(c)
    rank = len(BASE)
    added = F.transform(F.filter("candidates", found), lambda c: F.struct(
        c["start"].alias("start"), F.lit(rank).alias("rank"),
        F.concat(F.lit("random-"), c["encoding"]).alias("kind"), c["end"].alias("end")))
    return scanned.select("doc_id", "base", added.cast(f"array<{SPAN}>").alias("added"))


def joined(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
