"""Near-duplicate documents by HyperMinHash.

1. **Sketch** (Arrow batches, one read of the texts). Word shingles are hashed
   to 64 bits. The high 8 bits of a hash name one of 256 buckets; each bucket
   keeps its smallest hash, of which a register of 16 bits is stored: the
   count of leading zeros and the 10 bits after the first one. Empty buckets
   take the register of another bucket, in an order fixed for each bucket, so
   small sets band as well as large ones.
2. **Classes.** Documents with equal shingle sets share a 128-bit fingerprint
   of the set; one row per class goes on, however many copies it has.
3. **Banding.** 42 bands of 6 registers. Two sets of Jaccard similarity 0.8 meet in no
   band with a probability of 3e-6.
4. **Verification** of candidate pairs: sizes, then the estimate, which corrects
   for registers that agree by chance, then the full sets.
5. **Components** by ``banding``: classes are compared with a few hubs of their
   buckets. Members of a bucket that are still in different components are held
   against each other in the tasks that hold the bucket, by their registers and, where the
   corrected estimate passes, by their full sets; only links that join components are
   stored. So every pair that shares a band is in one component or was compared, and no
   step lists the pairs of a large group.

No count or bucket is capped. What is collected on the driver: nothing but
row counts.
"""

from __future__ import annotations

import sys
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandline.llm.banding import banded_components
from strandline.llm.common import fresh, may_be_in, maybe_in, slices, stored

BUCKETS, BANDS, ROWS, MANTISSA = 256, 42, 6, 10
#: Fixed value: expected chance agreements of HyperMinHash registers are
#: about this constant times 2**(p - r), for sets of equal size.
CHANCE = 0.1699194871597391
DEVIATIONS = 5      # of the estimate, allowed for (a miss in 3 million pairs at the threshold)
SLICE = 1 << 20     # bytes of text hashed at a time

SKETCH = "n long, f1 long, f2 long, regs binary"


def mix64(x):
    """The finaliser of splitmix64 on an array of unsigned 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def distinct(x):
    """The sorted distinct values of an array."""
    x = np.sort(x)
    keep = np.ones(len(x), dtype=bool)
    np.not_equal(x[1:], x[:-1], out=keep[1:])
    return x[keep]


def _tables():
    """Random numbers for the bytes (A-Z as a-z), the powers of an odd base and their
    inverses, and the order in which an empty bucket looks at the others."""
    rng = np.random.default_rng(20240607)
    byte = rng.integers(0, 1 << 64, 256, dtype=np.uint64)
    byte[65:91] = byte[97:123]
    base = 0x9E3779B97F4A7C15 | 1
    inv = pow(base, -1, 1 << 64)
    steps = {}
    for name, b in (("pow", base), ("inv", inv)):
        a = np.full(SLICE + 1, b, dtype=np.uint64)
        a[0] = 1
        steps[name] = np.multiply.accumulate(a)
    probe = np.argsort(rng.random((BUCKETS, BUCKETS)), axis=1).astype(np.int64)
    space = np.zeros(256, dtype=bool)
    space[[32, 9, 10, 11, 12, 13]] = True
    return byte, steps["pow"], steps["inv"], probe, space


def _word_sums(data, tables):
    """(sum, start, length) of each word of an array of bytes no longer than
    SLICE: the sum of a word's bytes times the powers of the base."""
    byte, power, inverse, _, space = tables
    blank = space[data]
    edge = np.diff(np.concatenate(([True], blank, [True])).astype(np.int8))
    start, end = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    total = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(byte[data] * power[:len(data)], out=total[1:])
    return (total[end] - total[start]) * inverse[start], start, (end - start).astype(np.uint64)


def _word_hashes(data, tables):
    """(hash, start) of each word of an array of bytes no longer than SLICE."""
    h, start, size = _word_sums(data, tables)
    return mix64(h + size), start


def _shingle_hashes(words, width):
    """Hashes of the shingles of one text's words (all words as one shingle
    where there are fewer), repeats included."""
    if not len(words):
        return words
    w = min(width, len(words))
    h = np.full(len(words) - w + 1, w, dtype=np.uint64)
    for k in range(w):
        h = mix64(h * np.uint64(0x9E3779B97F4A7C15) + words[k:len(words) - w + 1 + k])
    return h


def _text_sets(column, width, tables):
    """The sorted distinct shingle hashes of each text of an Arrow column."""
    if not len(column):
        return
    column = column.cast(pa.large_string()) if not pa.types.is_large_string(column.type) else column
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", dtype=np.uint8)
    valid = column.is_valid().to_numpy(zero_copy_only=False)
    i = 0
    while i < len(column):
        j = i + 1
        while j < len(column) and offsets[j + 1] - offsets[i] <= SLICE:
            j += 1
        lo, hi = int(offsets[i]), int(offsets[j])
        if hi - lo <= SLICE:
            # a space between texts, so that no word spans two of them
            part = np.insert(data[lo:hi], offsets[i + 1:j] - lo, 32) if j > i + 1 else data[lo:hi]
            if len(part) > SLICE:
                h, start = _long_words(part, tables)
            else:
                h, start = _word_hashes(part, tables)
            first = np.searchsorted(start, offsets[i:j] - lo + np.arange(j - i))
        else:
            h, start = _long_words(data[lo:hi], tables)
            first = np.zeros(1, dtype=np.int64)
        last = np.append(first[1:], len(h))
        for k in range(j - i):
            own = h[first[k]:last[k]] if valid[i + k] else h[:0]
            yield distinct(_shingle_hashes(own, width))
        i = j


def _long_words(data, tables):
    """The words of more than SLICE bytes, slice by slice. A word that a
    slice's end cuts goes on in the next: its sum, start and length so far are
    carried until white space or the end comes, so it is one word however
    long it is."""
    power, space = tables[1], tables[4]
    hashes, starts, cut = [], [], None
    for at in range(0, len(data), SLICE):
        part = data[at:at + SLICE]
        h, s, size = _word_sums(part, tables)
        s = s + at
        if cut is not None and space[part[0]]:
            h, s, size = (np.insert(x, 0, c) for x, c in zip((h, s, size), cut))
        elif cut is not None:
            shift = np.uint64(pow(int(power[1]), int(cut[2]), 1 << 64))
            h[0], s[0], size[0] = cut[0] + h[0] * shift, cut[1], cut[2] + size[0]
        cut = None
        if at + SLICE < len(data) and not space[part[-1]]:
            cut = h[-1], s[-1], size[-1]
            h, s, size = h[:-1], s[:-1], size[:-1]
        hashes.append(mix64(h + size))
        starts.append(s)
    return np.concatenate(hashes), np.concatenate(starts)


def _registers(s, probe):
    """Registers of a set of sorted distinct hashes."""
    bucket = (s >> np.uint64(56)).astype(np.int64)
    at = np.flatnonzero(np.diff(bucket, prepend=-1))
    full = np.zeros(BUCKETS, dtype=bool)
    regs = np.zeros(BUCKETS, dtype=np.uint16)
    low = (s[at] << np.uint64(8)) | np.uint64(128)      # 56 bits and a stop bit
    # leading zeros by way of the exponent of the number's high half
    zeros = 63 - np.frexp((low >> np.uint64(11)).astype(np.float64))[1] - 10
    mantissa = (low << (zeros + 1).astype(np.uint64)) >> np.uint64(64 - MANTISSA)
    full[bucket[at]] = True
    regs[bucket[at]] = (zeros.astype(np.uint16) << np.uint16(MANTISSA)) | mantissa.astype(np.uint16)
    if len(at) < BUCKETS:
        none = np.flatnonzero(~full)
        for looks in (16, BUCKETS):     # most find a full one within a few looks
            order = probe[none, :looks]
            hit = full[order]
            found = hit.any(axis=1)
            regs[none[found]] = regs[order[found, np.argmax(hit[found], axis=1)]]
            none = none[~found]
            if not len(none):
                break
    return regs


def _keys(r, bands=slice(None)):
    """The band keys of a matrix of registers, a column for each band."""
    r = r[:, :BANDS * ROWS].reshape(-1, BANDS, ROWS).astype(np.uint64)[:, bands]
    h = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64)[bands], r.shape[:2])
    for k in range(ROWS):
        h = mix64(h * np.uint64(0x9E3779B97F4A7C15) + r[:, :, k])
    return h.view(np.int64)


def first_key(ra, rb):
    """The key of the first band that each pair shares (of no band: of the first);
    ``ra`` may be one row for all."""
    same = (ra == rb)[:, :BANDS * ROWS].reshape(-1, BANDS, ROWS).all(axis=2)
    return np.take_along_axis(np.broadcast_to(_keys(ra), same.shape), same.argmax(axis=1)[:, None], axis=1)[:, 0]


def band_keys(classes: DataFrame) -> DataFrame:
    """(class, regs) -> (class, key): one row for each band."""
    def run(batches):
        with np.errstate(over="ignore"):
            for batch in batches:
                r = np.frombuffer(b"".join(batch.column("regs").to_pylist()), "<u2").reshape(-1, BUCKETS)
                own = np.repeat(batch.column("class").to_numpy(zero_copy_only=False), BANDS)
                yield pa.RecordBatch.from_arrays([pa.array(own), pa.array(_keys(r).ravel())], names=["class", "key"])
    return classes.select("class", "regs").mapInArrow(run, "class long, key long")


def _fingerprint(s):
    """128 bits that stand for a set of hashes."""
    return [int(mix64(x).sum(dtype=np.uint64).astype(np.int64))
            for x in (s + np.uint64(1), s ^ np.uint64(0xA5A5A5A5A5A5A5A5))]


def sketches(docs: DataFrame, width: int) -> DataFrame:
    """(doc_id, t, text) -> (doc_id, t, n, f1, f2, regs); nulls and n = 0
    for a text without words."""
    def run(batches):
        with np.errstate(over="ignore"):
            tables = _tables()
            for batch in batches:
                n, f1, f2, regs = [], [], [], []
                for s in _text_sets(batch.column("text"), width, tables):
                    n.append(len(s))
                    if not len(s):
                        for out in (f1, f2, regs):
                            out.append(None)
                        continue
                    x, y = _fingerprint(s)
                    f1.append(x)
                    f2.append(y)
                    regs.append(_registers(s, tables[3]).astype("<u2").tobytes())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), batch.column("t"), pa.array(n, pa.int64()), pa.array(f1, pa.int64()),
                     pa.array(f2, pa.int64()), pa.array(regs, pa.binary())],
                    names=["doc_id", "t", "n", "f1", "f2", "regs"])
    return docs.select("doc_id", "t", "text").mapInArrow(run, f"doc_id long, t long, {SKETCH}")


def shingle_sets(docs: DataFrame, width: int) -> DataFrame:
    """(key, text) -> (key, n, f1, f2, s): the distinct shingle hashes of each
    text, with the set's size and fingerprint."""
    def run(batches):
        with np.errstate(over="ignore"):
            tables = _tables()
            for batch in (part for whole in batches for part in slices(whole, "text", SLICE)):
                sets = list(_text_sets(batch.column("text"), width, tables))
                marks = np.array([_fingerprint(s) for s in sets], dtype=np.int64).reshape(-1, 2)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("key"), pa.array([len(s) for s in sets], pa.int64()),
                     pa.array(marks[:, 0]), pa.array(marks[:, 1]),
                     pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))],
                    names=["key", "n", "f1", "f2", "s"])
    return docs.select("key", "text").mapInArrow(
        run, "key long, n long, f1 long, f2 long, s array<long>")


def sets_of(texts: DataFrame, width: int) -> DataFrame:
    """(key, text) -> (key, s), one row a class: a text found by its id counts
    only if it is the class's own."""
    return (shingle_sets(texts, width).filter(F.xxhash64("n", "f1", "f2") == F.col("key"))
            .select("key", "s").dropDuplicates(["key"]))


def estimate(ra, rb, na, nb):
    """(Jaccard estimate, corrected for chance agreements; a generous bound on its
    error, DEVIATIONS for the registers that differ in origin) of pairs."""
    ratio = np.minimum(na, nb) / np.maximum(na, nb)
    chance = CHANCE * 2.0 ** (8 - MANTISSA) * 4 * ratio / (1 + ratio) ** 2
    j = ((ra == rb).sum(axis=1) - chance) / (BUCKETS - chance)
    return j, DEVIATIONS * np.sqrt(0.16 / np.minimum(BUCKETS, np.minimum(na, nb)))


def passing(share: tuple[int, int]):
    """Whether pairs can have a similarity of ``share``, by sizes and estimate."""
    num, den = share

    def passes(ra, rb, na, nb):
        good = np.minimum(na, nb) * den >= np.maximum(na, nb) * num
        if good.any():
            j, slack = estimate(ra[good], rb[good], na[good], nb[good])
            good[good] = j + slack >= num / den
        return good
    return passes


def estimates(pairs: DataFrame) -> DataFrame:
    """(a, b, na, nb, ra, rb) -> (a, b, j, slack), see ``estimate``."""
    def run(batches):
        for batch in batches:
            a, b, na, nb = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("a", "b", "na", "nb"))
            ra, rb = (np.frombuffer(b"".join(batch.column(c).to_pylist()), "<u2").reshape(-1, BUCKETS) for c in ("ra", "rb"))
            j, slack = estimate(ra, rb, na, nb)
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(j), pa.array(slack)],
                                             names=["a", "b", "j", "slack"])
    return pairs.select("a", "b", "na", "nb", "ra", "rb").mapInArrow(
        run, "a long, b long, j double, slack double")


cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _packed(column):
    """(sets, registers) of an Arrow column of sets, see ``banding``."""
    probe = _tables()[3]
    values = column.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
    ends = np.cumsum(column.value_lengths().to_numpy(zero_copy_only=False))
    sets = np.split(values, ends[:-1])
    return sets, np.array([_registers(s, probe) for s in sets])


def _linked(pairs: DataFrame, classes: DataFrame, texts: Callable[[DataFrame], DataFrame], width: int,
            share: tuple[int, int], label: str) -> DataFrame:
    """Of pairs (a, b) of classes those with similarity of at least
    ``share``: sizes first, then the estimate, then the full sets."""
    num, den = share
    pairs = stored(pairs, f"{label}-ordered")
    need = pairs.select(F.explode(F.array("a", "b")).alias("class")).distinct()
    c = may_be_in(classes.select("class", "n", "regs"), need, "class")
    p = (pairs.join(c.select(F.col("class").alias("a"), F.col("n").alias("na"), F.col("regs").alias("ra")), "a")
         .join(c.select(F.col("class").alias("b"), F.col("n").alias("nb"), F.col("regs").alias("rb")), "b")
         .filter(F.least("na", "nb") * den >= F.greatest("na", "nb") * num))
    near = stored(estimates(p).filter(F.col("j") + F.col("slack") >= num / den).select("a", "b"), f"{label}-near")
    need = near.select(F.explode(F.array("a", "b")).alias("class")).distinct()
    sets = stored(sets_of(texts(need), width), f"{label}-sets")
    both = (near.join(sets.select(F.col("key").alias("a"), F.col("s").alias("sa")), "a")
            .join(sets.select(F.col("key").alias("b"), F.col("s").alias("sb")), "b"))
    common = F.size(F.array_intersect("sa", "sb"))
    union = F.size("sa") + F.size("sb") - common
    return stored(both.filter(common * den >= union * num).select("a", "b"), f"{label}-links")


def _grouped(docs: DataFrame, id_col: str, text_col: str, width: int, share: tuple[int, int], **how):
    """(rows, classes): (doc_id, t, n, class) of each row, class null where a
    text has no words; (class, doc_id, t, p) of each class, its smallest row
    by id (null last) and the component that it belongs to."""
    d = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_col).alias("t"),
                    F.col(text_col).alias("text"))
    rows = stored(sketches(d, width).withColumn(
        "class", F.when(F.col("n") > 0, F.xxhash64("n", "f1", "f2"))), "near-sketches")
    # ``regs`` is a function of the set, so any copy's will do.
    classes = stored(rows.filter(F.col("class").isNotNull()).groupBy("class")
                     .agg(F.min("doc_id").alias("doc_id"),
                          F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "t"))["t"].alias("t"),
                          F.first("n").alias("n"),
                          F.first("regs").alias("regs")), "near-classes")

    def texts(need: DataFrame) -> DataFrame:
        """One text of each class in ``need``, found by its document's id and
        a hash of the text, so that rows that share an id are told apart."""
        named = classes.join(need, "class")
        named = stored(named.select(F.col("doc_id").alias("c_id"), F.col("t").alias("c_t"), F.col("class").alias("key"),
                                    F.xxhash64("doc_id", "t").alias("near_h")), "near-named")
        some = may_be_in(d.withColumn("near_h", F.xxhash64("doc_id", "t")), named, "near_h").drop("near_h")
        found = some.join(named, F.col("doc_id").eqNullSafe(F.col("c_id")) & (F.col("t") == F.col("c_t")))
        return found.select("key", "text")

    def verify(pairs: DataFrame, label: str) -> DataFrame:
        return _linked(pairs, classes, texts, width, share, label)

    def contents(need: DataFrame) -> DataFrame:
        return sets_of(texts(need), width).select(F.col("key").alias("class"), F.size("s").cast("long").alias("size"),
                                                  F.col("s").alias("content"))

    parts = banded_components(band_keys(classes), contents, _packed, passing(share), first_key, verify, share,
                              "near", **how)
    group = (classes.select("class", "doc_id", "t").join(parts.withColumnRenamed("id", "class"), "class", "left")
             .select("class", "doc_id", "t", F.coalesce("component", "class").alias("p")))
    return rows.select("doc_id", "t", "n", "class"), group


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5,
                    share: tuple[int, int] = (8, 10), **how) -> DataFrame:
    """One row per row of ``docs``: (doc_id, n_shingles, component_id, kept).

    A document's set is its distinct ``width``-word shingles (A-Z as a-z; the
    whole sequence where it has fewer words). Documents whose sets have a
    similarity of at least ``share`` are linked; ``component_id`` is the
    smallest doc_id reachable and ``kept`` is doc_id = component_id.
    Null, empty and blank texts have an empty set and no link; very long texts
    are sets like others. Rows with a
    null id link others but name no component (null if nothing else does) and
    are always kept. Rows that repeat an id are linked each by its own text.
    An empty table gives an empty result. ``one_of_each`` decides by row instead.
    """
    rows, group = _grouped(docs, id_col, text_col, width, share, **how)
    least = group.groupBy("p").agg(F.min("doc_id").alias("component_id"))
    named = group.join(least, "p").select("class", F.col("component_id").alias("c"))
    out = rows.select("doc_id", F.col("n").alias("n_shingles"), "class").join(named, "class", "left")
    out = out.withColumn("component_id", F.coalesce("c", "doc_id"))
    return out.select("doc_id", "n_shingles", "component_id",
                      F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"))


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5,
                share: tuple[int, int] = (8, 10), **how) -> DataFrame:
    """Of each group of near duplicates one row of ``docs``, with all columns:
    the one with the smallest (id, hash of the text), null ids last. Of rows equal in
    id and text, any one. Rows without words are in no group and all stay. An id
    decides nothing else: rows that share an id, or have none, stay or go each
    by its own text. Very long texts and an empty table are nothing special.
    """
    rows, group = _grouped(docs, id_col, text_col, width, share, **how)
    place = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "t")
    keep = group.groupBy("p").agg(F.min(place).alias("keep"))
    named = group.join(keep, "p").select("class", "keep")
    # a row for each (id, text) that goes, or that stays but comes more than once
    seen = rows.filter(F.col("class").isNotNull()).groupBy("doc_id", "t", "class").agg(F.count(F.lit(1)).alias("c"))
    odd = (seen.join(named, "class").select(F.col("doc_id").alias("g_id"), F.col("t").alias("g_t"),
                                            (place == F.col("keep")).alias("g_stays"), "c")
           .filter("NOT g_stays OR c > 1").select("g_id", "g_t", "g_stays"))
    odd = stored(odd.withColumn("g_h", F.xxhash64("g_id", "g_t")), "near-odd")
    t, h, stays, maybe = (fresh(x, docs.columns) for x in ("near_t", "near_h", "near_stays", "near_maybe"))
    d = docs.withColumn(t, F.xxhash64(text_col)).withColumn(h, F.xxhash64(F.col(id_col).cast("long"), F.col(t)))
    d = maybe_in(d, h, odd, "g_h", maybe)       # only rows that may be odd meet them
    some = d.filter(F.col(maybe)).alias("a").join(
        odd.alias("b"), F.col(f"a.{id_col}").cast("long").eqNullSafe(F.col("b.g_id")) & (F.col(f"a.{t}") == F.col("b.g_t")), "left")
    some = some.select("a.*", F.col("b.g_stays").alias(stays))
    one = some.filter(F.col(stays)).dropDuplicates([id_col, t])
    columns = [F.col(f"`{c}`") for c in docs.columns]
    return (d.filter(~F.col(maybe)).select(*columns).unionByName(some.filter(F.col(stays).isNull()).select(*columns))
            .unionByName(one.select(*columns)))
