"""Mixing sources to target weights by pivotal dependent rounding.

Each source gets a target size; a document's expected number of copies is
``target / source size``. The whole part is certain. The fractional parts
are rounded by the pivotal method: two undecided documents of a source meet,
and size-weighted mass moves at random from one to the other until one of
the two probabilities is 0 or 1. Each meeting keeps the expected mass of both
and the total mass of the source exactly, so a source's taken size differs
from its target by less than its last undecided document.

Documents meet inside small blocks of one source (a hash of the document picks
the block, so block sizes stay near ``block`` however large the source is).
Each block leaves at most one undecided document; these meet again in blocks
of the next level, a reduction tree of depth log(rows) / log(block). A hot
source is only more blocks.

All random numbers are hashes of the documents and ``seed``: reruns agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandline.llm.common import fresh, stored

#: Fixed values of the mixing contract: weights by rank of the source, and
#: how many times a source may be repeated.
WEIGHTS = (5, 2, 1)
MAX_REPEAT = 3.0

_STATE = ("struct<id:bigint,row:bigint,size:bigint,x:double,done:array<"
          "struct<id:bigint,row:bigint,size:bigint,x:double>>>")


def source_targets(sizes: DataFrame, weights=WEIGHTS, max_repeat: float = MAX_REPEAT) -> DataFrame:
    """(source, source_size) -> with ``target``: the sum of all sizes shared by
    weight (weights repeat over the sources by code point, null last), no
    target above ``max_repeat`` times its source, the excess going to the
    others by weight.

    Once sources are ordered by size per weight, those at their cap come
    first: the level at which the rest share is found with running sums. One
    row per source takes part.
    """
    n = len(weights)
    ranked = Window.orderBy(F.col("source").asc_nulls_last())
    d = sizes.withColumn("w", F.element_at(
        F.array(*[F.lit(float(w)) for w in weights]),
        (((F.row_number().over(ranked) - 1) % n) + 1).cast("int")))
    d = d.withColumn("cap", F.lit(float(max_repeat)) * F.col("source_size"))
    by_cap = Window.orderBy(F.col("cap") / F.col("w"), F.col("source").asc_nulls_last())
    before = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_cap.rowsBetween(0, Window.unboundedFollowing)
    every = Window.partitionBy()
    share = ((F.sum("source_size").over(every) - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
             / F.sum("w").over(onward))
    d = d.withColumn("level", F.when(share <= F.col("cap") / F.col("w"), share))
    d = d.withColumn("level", F.max("level").over(every))   # the first such source
    return d.select("source", "source_size",
                    F.coalesce(F.least(F.col("cap"), F.col("level") * F.col("w")), F.col("cap"))
                    .alias("target"))


def _meet(state: Column, item: Column, seed: int) -> Column:
    """One meeting of the carried document with the next one.

    ``a`` and ``b`` are their masses (size times probability), ``p`` and ``q`` their sizes.
    Mass ``up`` can move from b to a before one is decided, or ``down`` from
    a to b; it moves up with probability down / (up + down). The decided
    one joins ``done`` with probability exactly 0 or 1, the other is carried.
    """
    p, q = state["size"], item["size"]
    a, b = p * state["x"], q * item["x"]
    up, down = F.least(p - a, b), F.least(a, q - b)
    u = ((F.xxhash64(state["id"], state["row"], item["id"], item["row"], F.lit(seed))
          .bitwiseAND(F.lit((1 << 53) - 1))) / float(1 << 53))
    rise = u * (up + down) < down
    # which of the two is decided, and how
    first = F.when(rise, p - a <= b).otherwise(a <= q - b)
    to = F.when(first, F.when(rise, 1.0).otherwise(0.0)).otherwise(
        F.when(rise, 0.0).otherwise(1.0))
    rest = F.when(first, F.when(rise, (b - (p - a)) / q).otherwise((b + a) / q)).otherwise(
        F.when(rise, (a + b) / p).otherwise((a - (q - b)) / p))

    def row(s, x):
        return F.struct(s["id"].alias("id"), s["row"].alias("row"), s["size"].alias("size"),
                        x.cast("double").alias("x"))
    decided = F.when(first, row(state, to)).otherwise(row(item, to))
    carried = F.when(first, row(item, rest)).otherwise(row(state, rest))
    return F.struct(carried["id"].alias("id"), carried["row"].alias("row"),
                    carried["size"].alias("size"),
                    F.greatest(F.lit(0.0), F.least(F.lit(1.0), carried["x"])).alias("x"),
                    F.array_append(state["done"], decided).alias("done"))


def _round_level(level: DataFrame, blocks: Column, depth: int, seed: int) -> DataFrame:
    """Documents (source, id, row, size, x, n) -> the same, where each block
    has left at most one undecided."""
    block = F.pmod(F.xxhash64("id", "row", F.lit(seed + 7919 * (depth + 1))), blocks)
    # Largest first: a large document is decided against the many smaller ones
    # after it, so what stays undecided tends to be small.
    items = F.sort_array(F.collect_list(F.struct("size", "id", "row", "x")), asc=False)
    d = (level.groupBy("source", "n", block.alias("block")).agg(items.alias("items"))
         .withColumn("first", F.col("items")[0]))
    none = F.array().cast("array<struct<id:bigint,row:bigint,size:bigint,x:double>>")
    start = F.struct(F.col("first.id").alias("id"), F.col("first.row").alias("row"),
                     F.col("first.size").alias("size"), F.col("first.x").alias("x"),
                     none.alias("done")).cast(_STATE)
    d = d.withColumn("end", F.aggregate(
        F.slice("items", 2, F.size("items")), start,
        lambda s, i: _meet(s, i, seed).cast(_STATE)))
    last = F.struct(*[F.col(f"end.{c}").alias(c) for c in ("id", "row", "size", "x")])
    return (d.select("source", "n", F.explode(F.array_append("end.done", last)).alias("d"))
            .select("source", "n", "d.*"))


def mix(sized: DataFrame, block: int = 128, seed: int = 17, weights=WEIGHTS,
        max_repeat: float = MAX_REPEAT) -> DataFrame:
    """(id long, source string, size long) -> (id, source, size, source_size,
    target, copies): how many whole copies of each row the mix takes, one
    row for each row of the input.

    Rows that agree in id, source and size are one document with a count:
    their copies are decided together and dealt evenly, so a repeated row
    is never a large block. Rows of size 0 move no words and are taken
    once. A null source is a source of its own, the last; null ids are ids.
    An empty table gives an empty result.
    """
    d = sized.groupBy("id", "source", "size").agg(F.count(F.lit(1)).alias("m"))
    d = stored(d, "mix-documents")
    sizes = d.groupBy("source").agg(F.sum(F.col("size") * F.col("m")).alias("source_size"),
                                    F.count(F.lit(1)).alias("n"))
    sizes = stored(sizes, "mix-sources")
    rows = sizes.agg(F.max("n")).first()[0] or 0
    targets = source_targets(sizes.select("source", "source_size"), weights, max_repeat)
    # One row per source; whether that list is broadcast is left to Spark's size check.
    targets = stored(targets.join(sizes.select(F.col("source").alias("s"), "n"),
                                  F.col("source").eqNullSafe(F.col("s")))
                     .select(F.col("source").alias("t_source"), "source_size", "target", "n"),
                     "mix-targets")
    d = d.join(targets, F.col("source").eqNullSafe(F.col("t_source"))).drop("t_source")
    want = F.when(F.col("source_size") > 0,
                  F.col("m") * F.col("target") / F.col("source_size")).otherwise(0.0)
    d = d.withColumn("want", want)
    open_ = (F.col("want") > F.floor("want")) & (F.col("size") > 0)
    level = (d.filter(open_)
             .select("source", "id", F.col("m").alias("row"), "size",
                     (F.col("want") - F.floor("want")).alias("x"), "n"))
    decided, depth = [], 0
    while True:
        blocks = F.greatest(F.lit(1), F.ceil(F.col("n") / float(block ** (depth + 1)))).cast("long")
        done = stored(_round_level(level, blocks, depth, seed), f"mix-level{depth}")
        undecided = (F.col("x") > 0) & (F.col("x") < 1)
        decided.append(done.filter(~undecided))
        level = done.filter(undecided)
        depth += 1
        if rows <= block ** depth:
            break
    u = F.xxhash64("id", "row", F.lit(seed + 1)).bitwiseAND(F.lit((1 << 53) - 1)) / float(1 << 53)
    out = level.withColumn("x", F.when(u < F.col("x"), 1.0).otherwise(0.0))
    for part in decided:
        out = out.unionByName(part)
    up = (out.join(targets.drop("n"), F.col("source").eqNullSafe(F.col("t_source")))
          .select("id", "source", "size", "source_size", "target", F.col("row").alias("m"),
                  (F.floor(F.col("row") * F.col("target") / F.col("source_size"))
                   + F.col("x").cast("long")).alias("k")))
    rest = d.filter(~open_).select(
        "id", "source", "size", "source_size", "target", "m",
        F.when(F.col("size") > 0, F.floor("want")).otherwise(F.col("m")).cast("long").alias("k"))
    i = F.explode(F.sequence(F.lit(1).cast("long"), F.col("m"))).alias("i")
    return (up.unionByName(rest)
            .select("id", "source", "size", "source_size", "target", "m", "k", i)
            .select("id", "source", "size", "source_size", "target",
                    (F.floor(F.col("k") / F.col("m"))
                     + F.when(F.col("i") <= F.col("k") % F.col("m"), 1).otherwise(0))
                    .cast("long").alias("copies")))


def mixed_rows(docs: DataFrame, text_size: Column, id_col: str = "doc_id",
               source_col: str = "source", **kw) -> DataFrame:
    """The rows of the mix, each as often as it is taken, with the columns
    of ``docs``. Rows equal in all columns are one unit, whose copies are decided
    together; an id decides nothing, so rows that share one, or have none, are
    taken each by itself. Null and empty texts move no words and stay once; a very
    long text is one unit. An empty table gives no row."""
    cols = docs.columns
    unit, many, k = (fresh(x, cols) for x in ("mix_unit", "mix_many", "mix_copies"))
    d = docs.withColumn(unit, F.xxhash64(*[F.col(f"`{c}`") for c in cols]))
    units = d.select(F.col(unit).alias("id"), F.col(source_col).alias("source"), text_size.alias("size"))
    took = mix(stored(units, "mix-units"), **kw).groupBy("id").agg(F.sum("copies").alias("k"), F.count(F.lit(1)).alias("m"))
    took = stored(took.filter("k > 0"), "mix-taken")
    a, b = d.alias("a"), took.alias("b")
    d = a.join(b, F.col(f"a.{unit}") == F.col("b.id")).select(
        "a.*", (F.col("b.m") > 1).alias(many), F.col("b.k").alias(k))
    # equal rows: one of them stands for all
    d = d.filter(~F.col(many)).unionByName(d.filter(F.col(many)).dropDuplicates([unit]))
    return (d.withColumn(many, F.explode(F.sequence(F.lit(1).cast("long"), F.col(k))))
            .select(*[F.col(f"`{c}`") for c in cols]))
