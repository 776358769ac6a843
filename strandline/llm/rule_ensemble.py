"""Quality classifier: a sparse ensemble of rules.

1. **Statistics** of each whole text, one projection of built-in functions.
2. **Rules.** A random forest of shallow trees is fitted on the labelled rows; every path
   from a root to a node below it is a conjunction of bounds on statistics.
   Bounds of one path on one side of one statistic are merged into the
   tightest, and equal conjunctions are one rule.
3. **Weights.** A logistic regression with an L1 penalty over the rules (as 0 and
   1) leaves most of them without a weight.
4. **Scoring.** The rules that are left are compiled into one Spark column, so
   scoring is a narrow projection over the statistics and needs no model
   on the executors.

Labels are few beside the corpus; both fits run on the cluster, over all
of them. The driver sees only the trees and the weights.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandline.llm.common import SPACE_CLASS, stored, words

STATISTICS = ("n_words", "mean_word", "symbol_share", "pipe_share", "upper_share", "bang_share", "digit_share",
              "other_share", "distinct_words", "dup_line_share", "line_words", "short_words")
TREES, DEPTH, SEED = 24, 3, 20240611
PENALTY = 0.002
FIT_PARTITIONS = 8      # fixed, so that the forest's bootstrap draws the same rows on any cluster
CUTOFF = 0.3


def held_out(id_col: str) -> Column:
    """Rows of which no label is learned."""
    return F.crc32(F.col(id_col).cast("string")) % 5 == 0


def _share(a: Column, b: Column) -> Column:
    return F.when(b > 0, a / b).otherwise(F.lit(0.0))


def _removed(text: Column, pattern: str) -> Column:
    return F.length(text) - F.length(F.regexp_replace(text, f"{pattern}+", ""))


def statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, STATISTICS...) of each row's whole text; a null text counts as an empty one."""
    d = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("t"))
    t = F.col("t")
    d = d.select("doc_id", "t", words(t).alias("w"),
                 F.filter(F.split(t, "\n", -1), lambda s: s.rlike(r"[^\x20\x09-\x0D]")).alias("l"))
    d = d.select(
        "doc_id", F.size("w").alias("words"), F.size(F.array_distinct("w")).alias("kinds"),
        F.size(F.filter("w", lambda x: F.length(x) <= 3)).alias("short"),
        F.size("l").alias("lines"), F.size(F.array_distinct("l")).alias("line_kinds"),
        F.length(F.regexp_replace(t, f"{SPACE_CLASS}+", "")).alias("chars"),
        _removed(t, "[#*$%&<>]").alias("symbols"), _removed(t, "[|]").alias("pipes"),
        _removed(t, r"\p{Lu}").alias("upper"), _removed(t, "!").alias("bangs"), _removed(t, "[0-9]").alias("digits"),
        _removed(t, r"[^\p{L}0-9\x20\x09-\x0D.,#*$%&<>|!]").alias("other"))
    c, n = F.col("chars"), F.col("words")
    return d.select(
        "doc_id", n.cast("double").alias("n_words"), _share(c, n).alias("mean_word"),
        _share(F.col("symbols"), c).alias("symbol_share"), _share(F.col("pipes"), n).alias("pipe_share"),
        _share(F.col("upper"), c).alias("upper_share"), _share(F.col("bangs"), n).alias("bang_share"),
        _share(F.col("digits"), c).alias("digit_share"), _share(F.col("other"), c).alias("other_share"),
        _share(F.col("kinds"), n).alias("distinct_words"),
        _share(F.col("lines") - F.col("line_kinds"), F.col("lines")).alias("dup_line_share"),
        _share(n, F.col("lines")).alias("line_words"), _share(F.col("short"), n).alias("short_words"))


@dataclass(frozen=True)
class Rule:
    """A conjunction: for each (statistic, side) one bound; side "<=" or ">"."""
    bounds: tuple[tuple[str, str, float], ...]

    def column(self) -> Column:
        parts = [F.col(s) <= F.lit(b) if side == "<=" else F.col(s) > F.lit(b) for s, side, b in self.bounds]
        return reduce(lambda a, b: a & b, parts)


@dataclass(frozen=True)
class RuleModel:
    intercept: float
    rules: tuple[Rule, ...] = ()
    weights: tuple[float, ...] = ()

    def score(self) -> Column:
        """The probability of label 1, a column over ``statistics``."""
        z = F.lit(float(self.intercept))
        for rule, w in zip(self.rules, self.weights):
            z = z + F.when(rule.column(), F.lit(float(w))).otherwise(F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


_NODE = re.compile(r"^( *)(If|Else) \(feature (\d+) (<=|>) ([^)]+)\)$")


def tree_paths(text: str, names=STATISTICS) -> list[Rule]:
    """The rules of one printed tree: a path from the root to each other node."""
    out, path = [], []
    lines = text.splitlines()
    top = min((len(x) - len(x.lstrip()) for x in lines if _NODE.match(x)), default=0)
    for line in lines:
        m = _NODE.match(line)
        if not m:
            continue
        depth = len(m[1]) - top
        path = [*path[:depth], (names[int(m[3])], m[4], float(m[5]))]
        tight: dict[tuple[str, str], float] = {}
        for s, side, b in path:
            old = tight.get((s, side))
            tight[s, side] = b if old is None else min(old, b) if side == "<=" else max(old, b)
        out.append(Rule(tuple(sorted((s, side, b) for (s, side), b in tight.items()))))
    return out


def learn(labelled: DataFrame, trees: int = TREES, depth: int = DEPTH, penalty: float = PENALTY,
          seed: int = SEED) -> RuleModel:
    """(STATISTICS..., y 0.0 or 1.0) -> the model. Without labels every score
    is 0.5; with labels of one kind it is their smoothed share."""
    from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
    from pyspark.ml.feature import VectorAssembler
    own = [c for c in ("doc_id",) if c in labelled.columns]     # copies have equal statistics, but ids of their own
    d = stored(labelled.select(*own, *STATISTICS, "y").repartition(FIT_PARTITIONS, *own, *STATISTICS)
               .sortWithinPartitions(*STATISTICS, "y").drop(*own), "rules-labelled")
    n, good = d.agg(F.count(F.lit(1)), F.coalesce(F.sum("y"), F.lit(0.0))).first()
    prior = (good + 1.0) / (n + 2.0)
    base = RuleModel(math.log(prior / (1 - prior)))
    if good == 0 or good == n:
        return base
    whole = VectorAssembler(inputCols=list(STATISTICS), outputCol="x").transform(d)
    forest = RandomForestClassifier(featuresCol="x", labelCol="y", numTrees=trees, maxDepth=depth, maxBins=64,
                                    minInstancesPerNode=5, seed=seed).fit(whole)
    rules = list(dict.fromkeys(r for t in forest.trees for r in tree_paths(t.toDebugString)))
    if not rules:
        return base
    held = d.select("y", *[r.column().cast("double").alias(f"r{k}") for k, r in enumerate(rules)])
    x = VectorAssembler(inputCols=[f"r{k}" for k in range(len(rules))], outputCol="x").transform(held).select("x", "y")
    fit = LogisticRegression(featuresCol="x", labelCol="y", elasticNetParam=1.0, regParam=penalty, maxIter=60,
                             tol=1e-5).fit(x)
    weights = fit.coefficients.toArray()
    kept = [(r, float(w)) for r, w in zip(rules, weights) if w != 0.0]
    return RuleModel(float(fit.intercept), tuple(r for r, _ in kept), tuple(w for _, w in kept))


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             label_col: str = "quality", held=held_out, cutoff: float = CUTOFF, **kw) -> DataFrame:
    """One row per row of ``docs``: (doc_id, held_out, score, predicted).

    Labels are learned only from rows for which ``held(id_col)`` is false.
    Null texts are scored as empty ones. A row with a null id counts as
    not held out, and has no label. A document labelled more than once
    teaches each distinct label once; a repeated id teaches each of its rows. Null
    labels and labels of unknown documents teach nothing; any label above 0
    counts as 1. An empty table gives no row.
    """
    f = stored(statistics(docs, id_col, text_col), "rules-statistics")
    out = F.coalesce(held("doc_id"), F.lit(False))
    y = (labels.filter(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
         .select(F.col(id_col).alias("l_id"), (F.col(label_col) > 0).cast("double").alias("y")).distinct())
    model = learn(f.filter(~out).join(y, F.col("doc_id") == F.col("l_id")), **kw)
    score = model.score()
    return (f.select("doc_id", out.alias("held_out"), score.alias("score"))
            .withColumn("predicted", F.when(F.col("score") >= cutoff, 1).otherwise(0)))
