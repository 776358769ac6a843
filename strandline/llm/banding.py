"""Components of verified links from bands, without listing all pairs of a
bucket."""

from __future__ import annotations

import sys
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandline.llm.common import components, stored

SLICE_MEMBERS = 2048    # members of a bucket that one task compares with as many others
SLICE_SIZE = 1 << 22    # most shingles of them together, as far as members can be divided
TRIED = 1 << 20         # shingles compared at a time
ROUNDS = 0              # rounds with newly drawn hubs

#: (registers, registers, sizes, sizes) of equally many pairs -> whether each can be linked.
Passes = Callable[..., np.ndarray]


def _sides(members: DataFrame, limit: int) -> DataFrame:
    """(class, key, p, size) of buckets with several parts -> (class, key, kind,
    i, j, right, p): dealt to groups whose left members meet their right ones.

    The members of a bucket's largest part (kind 0) need only meet the
    others, and the others (kind 1) each other too. Both are cut into slices
    of at most about ``limit`` members and SLICE_SIZE by hash, and each pair of slices is a group, so
    a large part is dealt once for each slice of the others.
    """
    parts = members.groupBy("key", "p").agg(F.count(F.lit(1)).alias("c"), F.sum("size").alias("w"))

    def slices(count, weight):
        return F.greatest(F.lit(1), F.ceil(count / limit), F.ceil(weight / SLICE_SIZE)).cast("int")
    # the largest part by (members, p), from partial aggregates
    of = parts.groupBy("key").agg(F.max(F.struct("c", "p", "w")).alias("m"), F.sum("c").alias("all"),
                                  F.sum("w").alias("weight")).select(
        "key", F.col("m.p").alias("top"), slices(F.col("m.c"), F.col("m.w")).alias("tops"),
        slices(F.col("all") - F.col("m.c"), F.col("weight") - F.col("m.w")).alias("rests"))
    d = members.join(of, "key")
    first = F.col("p") == F.col("top")
    own = F.pmod(F.xxhash64("class"), F.when(first, F.col("tops")).otherwise(F.col("rests"))).cast("int")
    d = d.withColumn("first", first).withColumn("own", own)

    def to(n):
        return F.sequence(F.lit(0), n - 1)

    def group(kind, i, j, right):
        return F.struct(F.lit(kind).alias("kind"), i.alias("i"), j.alias("j"), right.alias("right"))
    o = F.col("own")
    tops = F.transform(to(F.col("rests")), lambda x: group(0, o, x, F.lit(False)))
    rests = F.concat(F.transform(to(F.col("tops")), lambda x: group(0, x, o, F.lit(True))),
                     F.transform(to(F.col("rests")), lambda x: group(1, F.least(x, o), F.greatest(x, o), o > x)))
    return (d.withColumn("g", F.explode(F.when(F.col("first"), tops).otherwise(rests)))
            .select("class", "key", "p", "g.*"))


def alike(one, others: list, share: tuple[int, int]):
    """Which of several sets (sorted distinct hashes) have a similarity of ``share`` with one."""
    num, den = share
    sizes = np.array([len(x) for x in others])
    every = np.concatenate(others)
    at = np.searchsorted(one, every)
    at[at == len(one)] = 0
    common = np.add.reduceat(one[at] == every, np.cumsum(sizes) - sizes, dtype=np.int64)
    return common * den >= (len(one) + sizes - common) * num


def joining(left, right, key: int, passes: Passes, first_key, share: tuple[int, int]):
    """Links (a, b) that join parts: of lists (class, part, registers, set) of
    members of one bucket, left ones against right ones (of one list if ``right`` is
    None). A pair counts in the first bucket that it shares and if its members' parts have not
    been joined here, so there are fewer links than members."""
    one = right is None
    if not one and len(left) > len(right):
        left, right = right, left
    c, part, regs, sets = zip(*(left if one else left + right))
    part, regs = np.unique(np.array(part), return_inverse=True)[1], np.array(regs)
    n = np.array([len(s) for s in sets])
    for k in range(len(left)):
        away = np.arange(k + 1 if one else len(left), len(c))
        away = away[part[away] != part[k]]
        if len(away):
            away = away[passes(np.broadcast_to(regs[k], (len(away), regs.shape[1])), regs[away],
                               np.full(len(away), n[k]), n[away])]
        if len(away):
            away = away[first_key(np.broadcast_to(regs[k], (len(away), regs.shape[1])), regs[away]) == key]
        take = 1        # first one of each other part, then two, four and so on
        while len(away):
            away = away[np.argsort(part[away], kind="stable")]
            at = part[away]
            start = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
            rank = np.arange(len(at)) - np.repeat(start, np.diff(np.r_[start, len(at)]))
            now = np.flatnonzero(rank < take)
            now = now[:max(1, np.searchsorted(np.cumsum(n[away[now]]), TRIED))]
            for j in away[now[alike(sets[k], [sets[x] for x in away[now]], share)]]:
                if part[j] != part[k]:
                    yield min(c[k], c[j]), max(c[k], c[j])
                    part[part == part[j]] = part[k]
            away = np.delete(away, now)
            away = away[part[away] != part[k]]
            take *= 2


def _meetings(members: DataFrame, contents: DataFrame, pack, passes: Passes, first_key, share: tuple[int, int],
              limit: int, band: int) -> DataFrame:
    """(class, key, p, size) -> links (a, b) between classes of one bucket that join its
    parts, compared in the tasks that hold the bucket: fewer than the rows dealt."""
    dealt = _sides(members, limit).join(contents.select("class", "content"), "class")
    tasks = max(1, int(members.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    at = ["key", "kind", "i", "j"]

    def run(batches):
        def groups():
            where, sides = None, ([], [])
            for batch in batches:
                if not batch.num_rows:
                    continue
                sets, regs = pack(batch.column("content"))
                cols = [batch.column(c).to_pylist() for c in (*at, "right", "class", "p")]
                for key, kind, i, j, side, *row in zip(*cols, regs, sets):
                    if where != (key, kind, i, j):
                        if where is not None:
                            yield where, sides
                        where, sides = (key, kind, i, j), ([], [])
                    sides[side].append(row)
            if where is not None:
                yield where, sides
        with np.errstate(over="ignore"):
            for (key, kind, i, j), (left, right) in groups():
                one = kind == 1 and i == j
                if not left or not (one or right):
                    continue
                found = list(joining(left, None if one else right, key & band, passes, first_key, share))
                if found:
                    a, b = zip(*found)
                    yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])
    return (dealt.repartition(tasks, *at).sortWithinPartitions(*at)
            .select(*at, "right", "class", "p", "content").mapInArrow(run, "a long, b long"))


def banded_components(keys: DataFrame, contents: Callable[[DataFrame], DataFrame], pack, passes: Passes, first_key,
                      verify: Callable[[DataFrame, str], DataFrame], share: tuple[int, int], label: str,
                      rounds: int = ROUNDS, limit: int = SLICE_MEMBERS, band: int = -1) -> DataFrame:
    """(class, key), a row for each band of each class, each once ->
    (id, component) of every class with a link.

    ``contents(need)``: (class, size, content) of the classes in ``need``;
    ``pack(column)``: of an Arrow column of contents the sets (sorted distinct hashes) and
    their registers, a row each;
    ``passes(ra, rb, na, nb)``: of pairs those that can be linked;
    ``first_key(ra, rb)``: the key of the first band that each pair shares, as far as the bits
    ``band`` of a bucket's key tell it;
    ``verify(pairs, label)``: of pairs (a, b) those linked.

    In each bucket a member drawn by hash is the hub. Each class is compared
    with the hub it shares most buckets with; next, of the hubs in components
    other than its own, with the one it shares most buckets with and with those of buckets
    of two, so a large group costs two pairs a member however many hubs it has; then,
    ``rounds`` times, the members of buckets that
    are still in several components with newly drawn hubs of them. A group of alike
    classes has become one component by then, for a few comparisons a
    member. Last, in each bucket still split, the members of different
    components are compared in the tasks that hold them, by registers and then by their
    full sets; of the links only those that join components go on. So every pair that shares a
    band is in one component or was compared, and no step lists the pairs of a bucket.
    """
    keys = keys.repartition("key")      # shuffled once for both sides of the join
    many = (keys.groupBy("key").agg(F.min(F.struct(F.xxhash64("class", "key"), "class")).alias("m"),
                                    F.count(F.lit(1)).alias("c"))
            .filter(F.col("c") > 1).select("key", F.col("m.class").alias("hub"), "c"))
    members = stored(keys.join(many, "key"), f"{label}-buckets")
    to_hub = stored(members.filter(F.col("class") != F.col("hub")).groupBy("class", "hub")
                    .agg(F.count(F.lit(1)).alias("shared"), F.min("c").alias("c")), f"{label}-hubs")

    def ordered(p: DataFrame, a: str, b: str) -> DataFrame:
        return p.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).distinct()

    def part_of(df: DataFrame, col: str, name: str) -> DataFrame:
        return (df.join(parts.select(F.col("id").alias(col), F.col("component").alias(name)), col, "left")
                .withColumn(name, F.coalesce(name, col)))

    best = to_hub.groupBy("class").agg(F.max(F.struct("shared", "hub")).alias("m"))
    links = verify(ordered(best.select("class", F.col("m.hub").alias("hub")), "class", "hub"), f"{label}-1")
    parts = components(links, f"{label}-parts")

    def joined(more: DataFrame) -> None:
        nonlocal links, parts
        if not more.isEmpty():
            links = links.unionByName(more)
            parts = components(links, f"{label}-parts")

    def compared(pairs: DataFrame, step: str) -> None:
        pairs = stored(pairs, f"{label}-{step}-pairs")
        if not pairs.isEmpty():
            joined(verify(pairs, f"{label}-{step}"))

    # buckets of two are done with this; the last round meets the others that are still split
    away = part_of(part_of(to_hub, "class", "p"), "hub", "q").filter(F.col("p") != F.col("q"))
    next_best = away.groupBy("class").agg(F.max(F.struct("shared", "hub")).alias("m")).select("class", F.col("m.hub").alias("hub"))
    compared(ordered(away.filter(F.col("c") == 2).select("class", "hub").unionByName(next_best), "class", "hub"), "hubs")
    rest = members.select("class", "key")
    for k in range(rounds + 1):
        m = part_of(rest, "class", "p")
        split = (m.groupBy("key").agg(F.min("p").alias("lo"), F.max("p").alias("hi"), F.count(F.lit(1)).alias("c"),
                                      F.min(F.struct(F.xxhash64("class", "key", F.lit(k + 1)), "class", "p")).alias("m"))
                 .filter("lo <> hi AND c > 2")          # a pair met its hub already
                 .select("key", F.col("m.class").alias("hub"), F.col("m.p").alias("q")))
        m = stored(m.join(split, "key"), f"{label}-split")
        rest = m.select("class", "key")
        if k < rounds:
            compared(ordered(m.filter(F.col("p") != F.col("q")), "class", "hub"), f"round{k}")
        elif not m.isEmpty():
            have = stored(contents(m.select("class").distinct()), f"{label}-contents")
            m = stored(m.select("class", "key", "p").join(have.select("class", "size"), "class"), f"{label}-sizes")
            joined(stored(_meetings(m, have, pack, passes, first_key, share, limit, band), f"{label}-last"))
    return parts


cloudpickle.register_pickle_by_value(sys.modules[__name__])
