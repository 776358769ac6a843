"""Quality rules with risk-controlled cutoffs.

Fixed base rules (too few words, too many repeated words) come first. Every
further rule rejects a text whose statistic lies above a cutoff. Cutoffs are
learned from labelled documents, by stratum (language): for each rule a
fixed ladder of cutoffs is climbed down from the most lenient, and at each
step the hypothesis "this cutoff rejects more than ``risk`` of the
good texts" is tested with the exact binomial tail of the good labelled
texts that it rejects. The climb ends at the first step that is not refuted
(fixed-sequence testing), and the level ``delta`` is divided among all rules and
strata (Bonferroni). So with probability 1 - delta no cutoff in use rejects more than
``risk`` of the good texts of its stratum. Of the refuted steps the most
lenient that rejects the most bad labelled texts is used; a rule that rejects none, and a stratum
without enough labels, gets no cutoff.

The texts are read once; what is stored and joined is a row of numbers each.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandline.llm.common import SPACE_CLASS, stored, words

#: Fixed values of the contract.
MIN_WORDS = 50
SYMBOLS = r"[#*$%&|<>]"

#: Each rule's ladder, lenient to strict.
LADDER = {
    "symbol_share": (0.5, 0.4, 0.3, 0.25, 0.2, 0.15, 0.12, 0.1, 0.08, 0.06, 0.05, 0.04, 0.03, 0.02),
    "upper_share": (0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.35, 0.3, 0.25, 0.2, 0.15),
    "bang_share": (2.0, 1.5, 1.0, 0.8, 0.6, 0.5, 0.4, 0.3, 0.2, 0.15, 0.1),
    "dup_line_share": (0.95, 0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.2),
    "repeat_share": (0.5, 0.45, 0.4, 0.35, 0.3, 0.25, 0.2),
    "mean_word": (40.0, 30.0, 25.0, 20.0, 18.0, 16.0, 14.0, 12.0, 11.0, 10.0),
}
RISK = 0.01
DELTA = 0.05


def _share(a: Column, b: Column) -> Column:
    return F.when(b > 0, a / b).otherwise(F.lit(0.0))


def _removed(text: Column, pattern: str) -> Column:
    """How many characters of ``text`` match a character class."""
    return (F.length(text) - F.length(F.regexp_replace(text, f"{pattern}+", ""))).cast("long")


def features(docs: DataFrame, id_col: str, text_col: str, stratum_col: str) -> DataFrame:
    """(doc_id, stratum, the counts of the contract, the rules' statistics)."""
    d = docs.select(F.col(id_col).alias("doc_id"), F.col(stratum_col).cast("string").alias("stratum"),
                    F.coalesce(F.col(text_col), F.lit("")).alias("t"))
    t = F.col("t")
    d = d.select("doc_id", "stratum", "t", words(t).alias("w"),
                 F.filter(F.split(t, "\n", -1), lambda s: s.rlike(r"[^\x20\x09-\x0D]")).alias("l"))
    d = d.select(
        "doc_id", "stratum", F.size("w").cast("long").alias("n_words"),
        F.length(F.regexp_replace(t, f"{SPACE_CLASS}+", "")).cast("long").alias("word_chars"),
        _removed(t, SYMBOLS).alias("n_symbols"), _removed(t, r"\p{Lu}").alias("upper"),
        _removed(t, "!").alias("bangs"), F.size("l").alias("lines"),
        (F.size("l") - F.size(F.array_distinct("l"))).cast("long").alias("n_dup_lines"),
        F.transform("w", lambda x: F.xxhash64(x)).alias("h"))
    # hashes of the 3-word windows; a hash met again marks a window that repeats
    n = F.greatest(F.size("h") - 2, F.lit(0))
    d = d.withColumn("g", F.transform(F.slice("h", 1, n), lambda x, i: F.xxhash64(
        x, F.get("h", i + 1), F.get("h", i + 2)))).drop("h")
    d = d.withColumn("s", F.sort_array("g"))
    d = d.withColumn("again", F.filter("s", lambda x, i: (i > 0) & (x == F.get("s", i - 1))
                                       & ((i == 1) | (x != F.get("s", i - 2))))).drop("s")
    # Where they are: a short list is looked up, a long one found by sorting
    # (hash, place), so a very long text costs n log n.
    d = d.withColumn("placed", F.when(F.size("again") > 8, F.sort_array(F.transform(
        "g", lambda x, i: F.struct(x.alias("x"), i.alias("i"))))))
    by_sort = F.sort_array(F.transform(F.filter("placed", lambda p, k: (
        F.coalesce(p["x"] == F.get("placed", k - 1)["x"], F.lit(False))
        | F.coalesce(p["x"] == F.get("placed", k + 1)["x"], F.lit(False)))), lambda p: p["i"]))
    by_look = F.filter(F.transform("g", lambda x, i: F.when(F.array_contains("again", x), i)),
                       lambda i: i.isNotNull())
    d = d.withColumn("at", F.when(F.size("again") == 0, F.array().cast("array<int>"))
                     .when(F.size("again") > 8, by_sort).otherwise(by_look)).drop("placed", "again", "g")
    covered = F.aggregate(
        F.transform("at", lambda p, k: F.least(F.lit(3), F.coalesce(F.get("at", k + 1) - p, F.lit(3)))),
        F.lit(0).cast("long"), lambda a, x: a + x)
    d = d.withColumn("n_repeat_words", covered).drop("at")
    return d.select(
        "doc_id", "stratum", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        _share(F.col("n_symbols"), F.col("word_chars")).alias("symbol_share"),
        _share(F.col("upper"), F.col("word_chars")).alias("upper_share"),
        _share(F.col("bangs"), F.col("n_words")).alias("bang_share"),
        _share(F.col("n_dup_lines"), F.col("lines")).alias("dup_line_share"),
        _share(F.col("n_repeat_words"), F.col("n_words")).alias("repeat_share"),
        _share(F.col("word_chars"), F.col("n_words")).alias("mean_word"),
        ((F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")))
        .alias("base_failed"))


def binomial_tail(k: Column, n: Column, p: float) -> Column:
    """P(X <= k) for X ~ Binomial(n, p), summed term by term; 1 where k is
    not below the mean (such counts refute nothing)."""
    odds = math.log(p / (1 - p))
    start = F.struct((n * math.log(1 - p)).alias("log"), F.exp(n * math.log(1 - p)).alias("sum"))

    def step(s, i):
        log = s["log"] + F.log((n - i + 1) / i) + odds
        return F.struct(log.alias("log"), (s["sum"] + F.exp(log)).alias("sum"))
    ks = F.when(k >= 1, F.sequence(F.lit(1).cast("long"), k)).otherwise(F.array().cast("array<bigint>"))
    return F.when(k >= n * p, F.lit(1.0)).otherwise(F.aggregate(ks, start, step)["sum"])


def cutoffs(labelled: DataFrame, risk: float = RISK, delta: float = DELTA, ladder=None) -> DataFrame:
    """(stratum, good boolean, a column for each rule) -> (stratum, cutoffs
    map<rule, cutoff>). One row per (stratum, rule, step) is all that is
    gathered, whatever the number of labels."""
    ladder = ladder or LADDER
    # step: how many cutoffs of the ladder a text lies above
    above = [F.struct(F.lit(r).alias("rule"), sum(
        [F.when(F.col(r) > c, 1).otherwise(0) for c in steps], F.lit(0)).alias("above"))
        for r, steps in ladder.items()]
    seen = (labelled.select("stratum", "good", F.explode(F.array(*above)).alias("a"))
            .groupBy("stratum", F.col("a.rule").alias("rule"), F.col("a.above").alias("above"))
            .agg(F.count_if("good").alias("good"), F.count_if(~F.col("good")).alias("bad")))
    rule_steps = F.create_map(*[x for r, s in ladder.items() for x in (
        F.lit(r), F.array(*[F.lit(float(c)) for c in s]))])
    # every step of every ladder met, with the labelled texts that it rejects
    cells = (seen.withColumn("cuts", F.element_at(rule_steps, F.col("rule")))
             .groupBy("stratum", "rule", "cuts").agg(
                 F.sum("good").alias("n"), F.collect_list(F.struct("above", "good", "bad")).alias("h"))
             .select("stratum", "rule", "n", "h", "cuts", F.posexplode("cuts").alias("j", "cutoff")))

    def rejected(what):
        # a text above k cutoffs lies above the k strictest, the last of the ladder
        return F.aggregate(F.filter("h", lambda x: x["above"] + F.col("j") >= F.size("cuts")), F.lit(0).cast("long"),
                           lambda a, x: a + x[what])
    cells = cells.withColumn("k", rejected("good")).withColumn("caught", rejected("bad")).drop("h", "cuts")
    strata = Window.partitionBy()
    cells = (cells.withColumn("tests", F.size(F.collect_set("stratum").over(strata))
                              + F.max(F.col("stratum").isNull().cast("int")).over(strata))
             .withColumn("tests", F.col("tests") * len(ladder)))
    cells = cells.withColumn("refuted", binomial_tail(F.col("k"), F.col("n"), risk) * F.col("tests") <= delta)
    climb = Window.partitionBy("stratum", "rule").orderBy("j").rowsBetween(Window.unboundedPreceding, 0)
    cells = cells.withColumn("in_use", F.min("refuted").over(climb)).filter("in_use AND caught > 0")
    best = cells.groupBy("stratum", "rule").agg(
        F.max(F.struct("caught", (-F.col("j")).alias("lenient"), "cutoff")).alias("m"))
    return best.groupBy("stratum").agg(F.map_from_entries(
        F.collect_list(F.struct("rule", F.col("m.cutoff").alias("cutoff")))).alias("cutoffs"))


def judge(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          stratum_col: str = "lang", quality_col: str = "quality", risk: float = RISK,
          delta: float = DELTA) -> DataFrame:
    """One row per row of ``docs``: the counts, ``base_failed``, ``kept`` and
    ``failed``, the first rule that rejects it.

    A null text has no words and fails the base. A null stratum is a stratum.
    A document labelled more than once is good only if all its labels are; null labels
    and labels of unknown documents teach nothing. With an empty table of labels
    only the base rules hold; an empty table of documents gives no row.
    """
    f = stored(features(docs, id_col, text_col, stratum_col), "quality-features")
    y = (labels.filter(F.col(quality_col).isNotNull()).groupBy(F.col(id_col).alias("l_id"))
         .agg((F.min(quality_col) > 0).alias("good")))
    labelled = f.filter(~F.col("base_failed")).join(y, F.col("doc_id") == F.col("l_id"))
    cut = stored(cutoffs(labelled.select("stratum", "good", *LADDER), risk, delta), "quality-cutoffs")
    d = f.join(cut.withColumnRenamed("stratum", "s"), F.col("stratum").eqNullSafe(F.col("s")), "left")
    fails = F.coalesce(*[F.when(F.col(r) > F.element_at("cutoffs", r), F.lit(r)) for r in LADDER])
    fails = F.when(F.col("base_failed"), F.lit("base")).otherwise(fails)
    return d.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                    "base_failed", fails.isNull().alias("kept"), fails.alias("failed"))
