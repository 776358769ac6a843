"""Benchmark decontamination: which documents hold which test items.

Size-partitioned MinHash containment search, then exact confirmation.

* A document's word shingles are hashed once. Documents are partitioned by
  their number of shingles (powers of two), and each partition has its own
  number of MinHash registers, in proportion to its upper size: the high
  bits of a hash name the register, the register keeps its smallest hash.
  So a short item keeps the same chance to show in a register however long
  the document is.
* Each item is sketched at every partition's register count. A document and
  an item that agree in any register are a candidate pair. Registers per
  shingle are set from the smallest item, so that a document with the wanted
  share of that item is missed with a probability below ``miss``.
* Candidates are confirmed on the shingles themselves.

Documents are never shuffled by a shingle: their registers meet the items'
registers in a broadcast join while the items' registers number at most
``broadcast_rows`` (counted first), and in a shuffle join beyond that.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandline.llm.common import fresh, stored, words

WIDTH = 5
SHARE = (8, 10)         # a document holds an item with at least 8 / 10 of its shingles
BROADCAST_ROWS = 1_000_000


def _hashes(w: str, width: int) -> Column:
    """Hashes of the word shingles of array column ``w`` (hashed words), in order."""
    a = F.col(w)
    n = F.size(a) - width + 1
    parts = lambda x, i: F.xxhash64(x, *[F.get(a, i + k) for k in range(1, width)], F.lit(width))
    return F.when(n > 0, F.transform(F.slice(a, 1, F.greatest(n, F.lit(0))), parts)) \
        .otherwise(F.array().cast("array<bigint>"))


def _grams(w: str, width: Column | int) -> Column:
    """The distinct word shingles of array column ``w`` as texts."""
    n = F.size(w) - width + 1
    return F.when(n > 0, F.array_distinct(F.transform(
        F.sequence(F.lit(1), F.greatest(n, F.lit(1))),
        lambda i: F.concat_ws(" ", F.slice(w, i, width))))) \
        .otherwise(F.array().cast("array<string>"))


def _bucket(x: Column, bits: Column) -> Column:
    return F.call_function("shiftright", x, F.lit(64) - bits)


def _registers(sorted_hashes: str, bits: Column) -> Column:
    """Of ascending hashes the smallest of each of the 2**bits registers."""
    a = F.col(sorted_hashes)
    return F.filter(a, lambda x, i: (i == 0) | (_bucket(x, bits) != _bucket(F.get(a, i - 1), bits)))


def _spare_bits(smallest: int, miss: float) -> int:
    """log2 of registers per shingle so that a share of an item of
    ``smallest`` shingles goes unseen with a probability of at most ``miss``.

    With a load of r shingles per register, a shingle is its register's
    smallest with probability (1 - exp(-r)) / r, apart for different shingles.
    """
    hits = max(1.0, smallest * SHARE[0] / SHARE[1])
    for bits in range(-2, 20):
        r = 2.0 ** -bits
        if (1 - (1 - math.exp(-r)) / r) ** hits <= miss:
            return bits
    return 20


def leaks(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          item_col: str = "item_id", item_text: str = "text", width: int = WIDTH,
          miss: float = 1e-6, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """One row (doc_id, item_id, item_shingles, common, containment) for each
    document and item where the document holds at least 8 / 10 of the
    item's distinct word shingles (words in lower case).

    An item with fewer than ``width`` words is one shingle of all its words.
    Null, empty and blank texts hold nothing and are in nothing; very long
    documents have registers in proportion. Rows with one
    id (also a null id) give one row for each item that any of them holds, with
    the largest share; an item given twice likewise. Empty tables give none.
    """
    best = F.max(F.struct("containment", "common", "item_shingles"))
    return (_leaks_by_text(docs, items, id_col, text_col, item_col, item_text, width, miss, broadcast_rows)
            .groupBy("doc_id", "item_id").agg(best.alias("m"))
            .select("doc_id", "item_id", "m.item_shingles", "m.common", "m.containment"))


def _leaks_by_text(docs, items, id_col, text_col, item_col, item_text, width, miss, broadcast_rows) -> DataFrame:
    """(doc_id, t, item_id, item_shingles, common, containment): as ``leaks``, by
    id and hash of the text."""
    it = (items.select(F.col(item_col).alias("item_id"), words(F.lower(item_text)).alias("w"))
          .filter(F.size("w") > 0)
          .withColumn("width", F.least(F.size("w"), F.lit(width))))
    it = stored(it.withColumn("grams", _grams("w", F.col("width")))
                .withColumn("h", F.transform("w", lambda x: F.xxhash64(x)))
                .drop("w"), "leak-items")
    widths = [r[0] for r in it.select("width").distinct().collect()]    # at most ``width`` of them
    smallest = it.agg(F.min(F.size("grams"))).first()[0] or 1
    spare = _spare_bits(smallest, miss)

    def bits(n: Column) -> Column:
        p = F.floor(F.log2(F.greatest(n, F.lit(1)).cast("double"))).cast("int")
        return F.greatest(F.lit(1), F.least(F.lit(48), p + 1 + spare))

    d = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("t"), F.col(text_col).alias("text"))
    hashed = (d.withColumn("wh", F.transform(words(F.lower("text")), lambda x: F.xxhash64(x))))
    sh = [_hashes("wh", k) for k in widths] or [F.array().cast("array<bigint>")]
    # No filter on these arrays: pushed below, it would repeat their making inside
    # the lambdas. A text without shingles has no register, and so no row.
    s = (hashed.select("doc_id", "t", F.concat(*sh).alias("h"))
         .select("doc_id", "t", F.sort_array("h").alias("h"), bits(F.size("h")).alias("bits")))
    regs = s.select("doc_id", "t", "bits", F.explode(_registers("h", F.col("bits"))).alias("x"))

    counts = range(1, 49)   # every register count that a document's size can ask for
    per_item = it.select("item_id", "width", "h")
    sketch = None
    for k in widths:
        x = per_item.filter(F.col("width") == k).select("item_id", F.sort_array(_hashes("h", k)).alias("h"))
        sketch = x if sketch is None else sketch.unionByName(x)
    if sketch is None:
        sketch = per_item.select("item_id", "h")
    sketch = (sketch.withColumn("bits", F.explode(F.array(*[F.lit(c) for c in counts])))
              .select("item_id", "bits", F.explode(_registers("h", F.col("bits"))).alias("x"))
              .groupBy("item_id", "x").agg(F.min("bits").alias("from_bits")))
    # A hash that is the smallest of its register stays so in every finer
    # partition, so one row with the coarsest count stands for all of them.
    sketch = stored(sketch, "leak-sketch")
    if sketch.count() <= broadcast_rows:
        sketch = F.broadcast(sketch)
    pairs = (regs.join(sketch, (regs["x"] == sketch["x"]) & (regs["bits"] >= sketch["from_bits"]))
             .select("doc_id", "t", "item_id").distinct())
    pairs = stored(pairs, "leak-pairs")

    full = it.select("item_id", "width", "grams").withColumnRenamed("item_id", "i")
    near = (pairs.join(full, F.col("item_id").eqNullSafe(F.col("i"))).drop("i")
            .select(F.col("doc_id").alias("p_id"), F.col("t").alias("p_t"), "item_id", "width", "grams"))
    # a text is split once for all its candidates; equal rows give equal rows
    near = near.groupBy("p_id", "p_t").agg(F.collect_list(F.struct("item_id", "width", "grams")).alias("items"))
    held = (d.join(near, F.col("doc_id").eqNullSafe(F.col("p_id")) & (F.col("t") == F.col("p_t")))
            .withColumn("dw", words(F.lower("text")))
            .select("doc_id", "t", "dw", F.explode("items").alias("i"))
            .withColumn("common", F.size(F.array_intersect(_grams("dw", F.col("i.width")), F.col("i.grams"))))
            .select("doc_id", "t", F.col("i.item_id").alias("item_id"), "common",
                    F.size("i.grams").alias("item_shingles")))
    best = F.max(F.struct(F.col("common") / F.col("item_shingles"), "common", "item_shingles"))
    # The filter follows the aggregate: ahead of it, Spark would push it down
    # and split the text anew for every shingle.
    return (held.groupBy("doc_id", "t", "item_id").agg(best.alias("m"))
            .filter(F.col("m.common") * SHARE[1] >= F.col("m.item_shingles") * SHARE[0])
            .select("doc_id", "t", "item_id", F.col("m.item_shingles").cast("long").alias("item_shingles"),
                    F.col("m.common").cast("long").alias("common"),
                    F.col("m.col1").alias("containment")))


def without_leaks(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text: str = "text", width: int = WIDTH, miss: float = 1e-6,
                  broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """The rows of ``docs``, all columns, whose own text holds no item: rows
    that share an id, or have none, stay or go each by its text; equal rows alike.
    Null and empty texts stay. An empty table of items takes nothing away."""
    found = _leaks_by_text(docs, items, id_col, text_col, item_col, item_text, width, miss, broadcast_rows)
    found = stored(found.select(F.col("doc_id").alias("leak_id"), F.col("t").alias("leak_t")).distinct(), "leak-ids")
    t = fresh("leak_row_t", docs.columns)
    a, b = docs.withColumn(t, F.xxhash64(text_col)).alias("a"), found.alias("b")
    return a.join(b, F.col(f"a.{id_col}").eqNullSafe(F.col("b.leak_id")) & (F.col(f"a.{t}") == F.col("b.leak_t")),
                  "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])
