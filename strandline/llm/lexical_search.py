"""Ranked lexical search: accumulators from short lists, then document at a time
over long ones.

1. **Index** (one read of the texts). The postings of the query terms are
   gathered by block of at most ``BLOCK_DOCS`` documents, in id order: a row of
   the index table is a block with its documents, their lengths, and for
   each term the documents and frequencies.
2. **Statistics** of the collection: documents, total length, and the
   documents of each term, summed from the blocks.
3. **Search**, a narrow pass over the blocks. In a block the lists of at most
   ``SHORT`` postings of an item are summed into accumulators (term at a time). The
   accumulators are then one more list, with a bound for each window of
   documents, and are read with the long lists document at a time: a
   window whose bounds add up to less than the item's threshold is skipped
   in all lists, and in the others only documents that can still reach the threshold
   are looked up. Thresholds rise from window to window and from block to block
   of a task.
4. The best of each task meet by item; a task gives at most ``k`` rows an item.

The items' terms travel to the tasks. They are counted first, and beyond
``QUERY_TERMS`` the items are searched in groups, each with an index of its
own, so the size of what travels is bounded whatever the number of items.
"""

from __future__ import annotations

import math
import sys
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandline.llm.common import stored

#: A term, and the constants of the score.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UNIT, SATURATION, SLOPE = 1000, 12, 25
TOP = 20

BLOCK_DOCS, BLOCK_POSTINGS = 8192, 250_000
SHORT = 128             # postings: lists up to this are summed first
WINDOW, STEP = 32, 32   # documents in a window; windows looked at between two thresholds
QUERY_TERMS = 200_000   # (item, term) rows that travel at once

#: A-Z as a-z; every other ASCII character that is no digit or letter as a space.
_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32
               for b in range(256))
_INDEX = "ids array<long>, lengths array<int>, terms array<int>, sizes array<int>, docs binary, tfs binary"


def terms(text: Column) -> Column:
    """The terms of a text, in order."""
    low = F.translate(F.coalesce(text, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.regexp_extract_all(low, F.lit(f"({TERM})"), 1)


def index(docs: DataFrame, number: dict[bytes, int], id_col: str, text_col: str) -> DataFrame:
    """The blocks: documents with a term in ascending id order (null ids last)
    and, for the terms in ``number``, the places and frequencies of those that hold them."""
    def block(held):
        held.sort(key=lambda x: (x[0] is None, x[0]))
        lists = defaultdict(lambda: ([], []))
        for at, (_, _, tf) in enumerate(held):
            for term, f in tf.items():
                lists[term][0].append(at)
                lists[term][1].append(f)
        order = sorted(lists)

        def packed(k):
            return np.array([x for t in order for x in lists[t][k]], "<i4").tobytes()
        return pa.RecordBatch.from_arrays(
            [pa.array([x], t) for x, t in (
                ([h[0] for h in held], pa.list_(pa.int64())), ([h[1] for h in held], pa.list_(pa.int32())),
                (order, pa.list_(pa.int32())), ([len(lists[t][0]) for t in order], pa.list_(pa.int32())),
                (packed(0), pa.binary()), (packed(1), pa.binary()))],
            names=["ids", "lengths", "terms", "sizes", "docs", "tfs"])

    def run(batches):
        held, postings = [], 0
        for batch in batches:
            for own, text in zip(batch.column("id").to_pylist(), batch.column("text")):
                found = text.as_buffer()
                words = found.to_pybytes().translate(_BYTES).split() if found is not None else ()
                if not words:
                    continue
                tf = Counter(map(number.get, words))
                tf.pop(None, None)
                held.append((own, len(words), tf))
                postings += len(tf)
                if len(held) >= BLOCK_DOCS or postings >= BLOCK_POSTINGS:
                    yield block(held)
                    held, postings = [], 0
        if held:
            yield block(held)

    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("binary").alias("text")) \
        .mapInArrow(run, _INDEX)


class Block:
    """A block of the index with the impacts of its postings."""

    def __init__(self, row: dict, weight, n_docs: int, total: int):
        self.ids = row["ids"]
        n = np.array(row["lengths"], dtype=np.int64)
        self.m = (100 - SLOPE) + (SLOPE * n * n_docs) // total
        cuts = np.cumsum([0, *row["sizes"]])
        docs = np.frombuffer(row["docs"], "<i4").astype(np.int64)
        tfs = np.frombuffer(row["tfs"], "<i4").astype(np.int64)
        self.lists = {t: (docs[a:b], tfs[a:b], weight[t])
                      for t, a, b in zip(row["terms"], cuts[:-1], cuts[1:])}
        self.windows = -(-len(n) // WINDOW)
        self.ready, self.bounds = {}, {}

    def impacts(self, t: int):
        """(places, impacts) of a term, once a block."""
        if t not in self.ready:
            d, tf, w = self.lists[t]
            self.ready[t] = d, w * ((UNIT * 1_000_000 * tf) // (UNIT * tf + SATURATION * self.m[d]))
        return self.ready[t]

    def bound(self, t: int):
        """The largest impact of a long list in each window."""
        if t not in self.bounds:
            self.bounds[t] = self.per_window(*self.impacts(t))
        return self.bounds[t]

    def per_window(self, docs, values):
        out = np.zeros(self.windows, dtype=np.int64)
        np.maximum.at(out, docs // WINDOW, values)
        return out


def search_block(block: Block, query: list[tuple[int, int]], best: list[tuple[int, int]], k: int) -> list:
    """The ``k`` best (score, id) of ``best`` and of the block's documents, for one item's
    (term, times) pairs. ``best`` is ordered, the highest first."""
    short, long = [], []
    for t, times in query:
        if t in block.lists:
            (short if len(block.lists[t][0]) <= SHORT else long).append((t, times))
    if not short and not long:
        return best
    # term at a time: the short lists, summed
    acc = np.zeros(len(block.m), dtype=np.int64)
    for t, times in short:
        docs, values = block.impacts(t)
        acc[docs] += times * values
    seen = np.flatnonzero(acc)
    # document at a time: the accumulators are one list, with bounds like the others'
    bound = block.per_window(seen, acc[seen])
    for t, times in long:
        bound = bound + times * block.bound(t)
    least = best[-1][0] if len(best) == k else 1
    open_ = np.flatnonzero(bound >= least)
    in_window = np.arange(WINDOW)
    for at in range(0, len(open_), STEP):
        w = open_[at:at + STEP]
        w = w[bound[w] >= least]
        if not len(w):
            continue
        docs = (w[:, None] * WINDOW + in_window).ravel()
        docs = docs[docs < len(acc)]
        score = acc[docs]
        # what the lists not yet looked at can still add, the strongest first
        rest = sum((times * block.bound(t)[docs // WINDOW] for t, times in long), np.zeros(len(docs), dtype=np.int64))
        for t, times in long:
            docs, score, rest = (x[score + rest >= least] for x in (docs, score, rest))
            if not len(docs):
                break
            places, values = block.impacts(t)
            hit = np.minimum(np.searchsorted(places, docs), len(places) - 1)
            score = score + np.where(places[hit] == docs, times * values[hit], 0)
            rest = rest - times * block.bound(t)[docs // WINDOW]
        keep = score >= least
        docs, score = docs[keep], score[keep]
        if len(docs) > k:
            top = np.lexsort((docs, -score))[:k]
            docs, score = docs[top], score[top]
        if len(docs):
            best = sorted(best + [(int(s), block.ids[d]) for s, d in zip(score, docs)],
                          key=lambda x: (-x[0], x[1] is None, x[1]))[:k]
            if len(best) == k:
                least = max(1, best[-1][0])
    return best


def _search(blocks: DataFrame, queries: list, weight: dict, n_docs: int, total: int, k: int) -> DataFrame:
    def run(batches):
        best = [[] for _ in queries]
        for batch in batches:
            for r in range(batch.num_rows):
                block = Block(batch.slice(r, 1).to_pylist()[0], weight, n_docs, total)
                for q, (_, pairs) in enumerate(queries):
                    best[q] = search_block(block, pairs, best[q], k)
        rows = [(queries[q][0], d, s) for q, own in enumerate(best) for s, d in own]
        item, doc, score = zip(*rows) if rows else ((), (), ())
        yield pa.RecordBatch.from_arrays(
            [pa.array(item, pa.int64()), pa.array(doc, pa.int64()), pa.array(score, pa.int64())],
            names=["item", "doc_id", "score"])
    return blocks.mapInArrow(run, "item long, doc_id long, score long")


def search(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           item_col: str = "item_id", item_text: str = "text", k: int = TOP,
           query_terms: int = QUERY_TERMS) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` documents of the highest score above 0
    of each item, ranked from 1, equal scores by ascending doc_id (null ids last).

    Null and empty texts hold no term, and such an item has no row. Rows of
    ``docs`` that repeat an id are documents of their own; rows of ``items``
    that agree in id and text are one item. Empty tables give no row.
    """
    spark = docs.sparkSession
    q = (items.select(F.col(item_col).alias("item_id"), F.col(item_text).alias("text")).distinct()
         .select("item_id", F.xxhash64("item_id", "text").alias("item"), F.explode(terms(F.col("text"))).alias("term"))
         .groupBy("item_id", "item", "term").agg(F.count(F.lit(1)).alias("times")))
    q = stored(q, "search-items")
    n = q.count()
    groups = max(1, -(-n // query_terms))
    found = None
    for g in range(groups):
        own = q.filter(F.pmod("item", F.lit(groups)) == g).select("item", "term", "times").collect()   # bounded: counted
        number = {t: i for i, t in enumerate(sorted({r["term"] for r in own}))}
        blocks = stored(index(docs, {t.encode(): i for t, i in number.items()}, id_col, text_col), "search-index")
        df = dict(blocks.select(F.explode(F.arrays_zip("terms", "sizes")).alias("x"))
                  .groupBy("x.terms").agg(F.sum("x.sizes").alias("df")).collect())      # a row a term
        n_docs, total = blocks.agg(
            F.coalesce(F.sum(F.size("ids")), F.lit(0)),
            F.coalesce(F.sum(F.aggregate("lengths", F.lit(0).cast("long"), lambda a, x: a + x)), F.lit(0))).first()
        weight = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * f + 1))) for t, f in df.items()}
        queries: dict[int, list] = {}
        for r in own:
            if weight.get(number[r["term"]], 0) > 0:
                queries.setdefault(r["item"], []).append((number[r["term"]], r["times"]))
        # the strongest lists first, so that documents drop out early
        ordered = [(item, sorted(pairs, key=lambda p: -weight[p[0]] * p[1])) for item, pairs in sorted(queries.items())]
        part = _search(blocks, ordered, weight, n_docs, max(1, total), k)
        found = part if found is None else found.unionByName(part)
    order = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    best = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    names = q.select("item_id", "item").distinct()
    return best.join(names, "item").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")


cloudpickle.register_pickle_by_value(sys.modules[__name__])
