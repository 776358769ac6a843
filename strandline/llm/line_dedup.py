"""Fuzzy line deduplication: of lines that are alike, in all documents, one stays.

* Equal lines are one class, told by a 64-bit hash.
* A line's MinHash signature comes from one 64-bit hash of each of its
  character shingles: the high 6 bits name one of 64 registers, each keeps its
  smallest hash, and an empty register takes the next full one's. 16 bands of 4
  registers each give a row (key, class, sketch, more); the sketch is two bits of each of 58
  registers and the number of registers that were full.
  Lines shorter than a shingle are like no other line and have no rows.
* Most band keys belong to one line only, so the texts are signed twice. The first time
  36 bits of each key go out, 6 bytes in all, and come back as a bitmap of the keys that
  several classes have (``shared_keys``); the second time only rows of such keys go out.
  The bitmap lets some others pass, and misses a key of two classes if 24 bits of both agree.
* The rows of a band key meet in one task, which reads them as a stream: rows whose
  sketch is unlike all others' go no further, so lines that meet
  by chance cost no more than that. Rows that are alike, directly or by way of others, go on as
  a bucket of their own, so groups that meet by chance are not held against each other.
  Of a key with more than ``KEPT_MEMBERS`` rows all go on.
* What is left, lines that are alike, goes through ``banding``, which compares the lines
  of a band key in its task; pairs of unlike sketches are not read, links are verified on
  the full shingle sets, and components come from distributed union-find (``common``).
* Which line of a component stays is found among the lines that may go: those
  of a component, and those whose class the first reading saw more than once.

Only hashes are shuffled. Texts are read again for the verification of candidates only.

Shingles are hashed in Arrow batches: with DataFrame functions alone they cost
over twice the CPU time allowed (figures in the README).
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandline.llm.banding import banded_components
from strandline.llm.common import filesystem, fresh, may_be_in, scratch, slices, stored
from strandline.llm.near_dup import distinct, mix64

SHINGLE = 5             # characters
REGISTERS = 64
CHARS = 1 << 19         # characters hashed at a time
SLICE = 1 << 22         # bytes of text split into lines at a time
SHARE = (8, 10)
BANDS, ROWS = 16, 4
BITS = 58               # of each word of a sketch; the other 6 of the first count the full registers
#: Registers of two sketches that may differ, by full registers: at a similarity of 0.8 one differs
#: in two bits with a probability of 0.15; five deviations of so many independent ones are allowed.
ALLOWED = np.ceil(BITS * (0.15 + 5 * np.sqrt(0.1275 / np.maximum(1, np.arange(64))))).astype(np.int64)
#: Of a hash the highest 12 bits name the part it is dealt to, and 24 more tell it from others there.
PARTS, LOW = 1 << 12, 24
TAG = 24                # bits of a class beside a key
DEALT = 1 << 20         # keys dealt at a time
SPARE = 16              # bits of a bitmap for each shared key, up to
MOST = 17               # ... two to this power for a part (64 MB in all)
ALL_PAIRS = 512         # rows of a key that are all held against each other
BAND = -1 << 16         # the bits of a bucket's key that it has from the band; the others tell groups apart
KEPT_MEMBERS = 1 << 20  # rows of one key that a task holds
SEEN = 2_000_000        # lines that a task knows it has signed
BROADCAST_ROWS = 1_000_000
HAS_WORD = r"[^\x20\x09-\x0D]"
BLANK = " \t\x0b\x0c\r"


def _lines(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, t, line_no, line) of all lines with a word. ``t`` is a hash of
    the text: with it rows that share an id are told apart."""
    return (docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("t"),
                        F.posexplode(F.split(F.coalesce(F.col(text_col), F.lit("")), "\n", -1)).alias("line_no", "line"))
            .filter(F.col("line").rlike(HAS_WORD)))


def _line_numbers(text_col: str):
    """The numbers of a text's lines with a word."""
    split = F.split(F.coalesce(F.col(text_col), F.lit("")), "\n", -1)
    return F.filter(F.transform(split, lambda x, k: F.when(x.rlike(HAS_WORD), k)), lambda k: k.isNotNull())


def _parts(texts: list[str]):
    """Slices of the list of at most CHARS characters together (a longer
    line is a slice of its own)."""
    i = 0
    while i < len(texts):
        j, n = i + 1, len(texts[i])
        while j < len(texts) and n + len(texts[j]) <= CHARS:
            n += len(texts[j])
            j += 1
        yield texts[i:j]
        i = j


def _hashes(texts: list[str], width: int = SHINGLE):
    """(hashes, line): a hash for each character shingle of each text, and the
    text's number; of a text shorter than a shingle one of all of it."""
    sizes = np.array([len(t) for t in texts])
    codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    h = np.zeros(max(0, len(codes) - width + 1), dtype=np.uint64)
    for k in range(width):        # a polynomial in an odd number, mixed once
        h *= np.uint64(0x9E3779B97F4A7C15)
        h += codes[k:k + len(h)]
    h = mix64(h)
    ends = np.cumsum(sizes)
    line = np.repeat(np.arange(len(texts)), sizes)[:len(h)]
    inside = np.arange(len(h)) + width <= ends[line]      # not across two lines
    h, line = h[inside], line[inside]
    short = np.flatnonzero(sizes < width)
    if len(short):      # all of a text that is shorter than a shingle, padded to a matrix
        at = ends[short] - sizes[short]
        place = at[:, None] + np.arange(width - 1)
        within = np.arange(width - 1) < sizes[short][:, None]
        cells = np.where(within, codes[np.minimum(place, max(0, len(codes) - 1))] + np.uint64(1), np.uint64(0)) \
            if len(codes) else np.zeros(place.shape, np.uint64)
        own = sizes[short].astype(np.uint64)
        for k in range(width - 1):
            own = mix64(own * np.uint64(0x9E3779B97F4A7C15) + cells[:, k])
        order = np.argsort(np.concatenate([line, short]), kind="stable")
        h = np.concatenate([h, own])[order]
        line = np.concatenate([line, short])[order]
    return h, line


def _signatures(h, line, n: int):
    """(band keys, a row a line; sketches of two words) of ``n`` lines with a shingle each."""
    least = np.full(n * REGISTERS, np.iinfo(np.uint64).max, dtype=np.uint64)
    np.minimum.at(least, line * REGISTERS + (h >> np.uint64(58)).astype(np.int64), h)
    least = least.reshape(n, REGISTERS)
    # an empty register takes the next full one's, the last ones the first's
    at = np.where(least != np.iinfo(np.uint64).max, np.arange(REGISTERS), 2 * REGISTERS)
    nxt = np.minimum.accumulate(at[:, ::-1], axis=1)[:, ::-1]
    nxt = np.where(nxt < REGISTERS, nxt, at.min(axis=1, keepdims=True))
    r = np.take_along_axis(least, nxt, axis=1)
    # a band's registers are neighbours: those of a short line that were filled from one
    # another lie in one band, and the bands differ
    x = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), (n, BANDS))
    for k in range(ROWS):
        x = mix64(x * np.uint64(0x9E3779B97F4A7C15) + r[:, k::ROWS])
    places = np.arange(64 - BITS, 64, dtype=np.uint64)
    words = [((r[:, :BITS] >> np.uint64(k) & np.uint64(1)) << places).sum(axis=1, dtype=np.uint64) for k in (0, 1)]
    words[0] |= np.minimum((at < REGISTERS).sum(axis=1), 63).astype(np.uint64)
    return x.view(np.int64), np.column_stack(words).view(np.int64)


def _near(a, b):
    """Which of two arrays of sketches are alike."""
    a, b = np.asarray(a).view(np.uint64), np.asarray(b).view(np.uint64)
    full = np.minimum(a[..., 0] & np.uint64(63), b[..., 0] & np.uint64(63)).astype(np.int64)
    differ = (a[..., 0] ^ b[..., 0]) | (a[..., 1] ^ b[..., 1])
    return np.bitwise_count(differ >> np.uint64(64 - BITS)) <= ALLOWED[full]


def _near_columns(a: tuple[str, str], b: tuple[str, str]):
    """``_near`` of the sketches in columns."""
    (x, u), (y, v) = [[F.col(c) for c in side] for side in (a, b)]
    differ = F.shiftrightunsigned(x.bitwiseXOR(y).bitwiseOR(u.bitwiseXOR(v)), 64 - BITS)
    full = F.least(x.bitwiseAND(F.lit(63)), y.bitwiseAND(F.lit(63))).cast("int")
    return F.bit_count(differ) <= F.element_at(F.array(*[F.lit(int(n)) for n in ALLOWED]), full + 1)


def _signed(batches):
    """(classes, classes seen before, band keys, sketches) of slices of the lines of all texts; a
    line that comes again in the same task is not signed again."""
    import xxhash
    seen = set()
    for batch in (part for whole in batches for part in slices(whole, "text", SLICE)):
        lines, classes, again = [], [], []
        for text in batch.column("text").to_pylist():
            for x in (text or "").split("\n"):
                if len(x) >= SHINGLE:
                    if x.strip(BLANK):
                        c = xxhash.xxh64_intdigest(x.encode(), 42)     # as Spark's xxhash64
                        if c in seen:
                            again.append(c)
                        else:
                            seen.add(c)
                            lines.append(x)
                            classes.append(c)
                elif x.strip(BLANK):
                    again.append(xxhash.xxh64_intdigest(x.encode(), 42))
        if len(seen) > SEEN:
            seen.clear()
        if again:
            yield np.zeros(0, np.uint64), np.array(again, np.uint64), None, None
        at = 0
        for texts in _parts(lines):
            own = np.array(classes[at:at + len(texts)], np.uint64)
            at += len(texts)
            yield own, np.zeros(0, np.uint64), *_signatures(*_hashes(texts), len(texts))


def _dealt(entries: list):
    """Arrow batches (part, entries) of arrays of 64-bit entries: 13 bits of the part, 24 of the
    hash and TAG that tell classes apart; 6 bytes of each go on, the high four and the low two."""
    v = np.sort(np.concatenate(entries))
    v = v[np.r_[np.ones(min(2, len(v)), dtype=bool), v[2:] != v[:-2]]]      # each twice at most
    part = (v >> np.uint64(LOW + TAG)).astype(np.int32)
    at = np.flatnonzero(np.r_[True, part[1:] != part[:-1]])
    high, low = (v >> np.uint64(16)).astype("<u4"), v.astype("<u2")
    ends = np.r_[at[1:], len(v)]
    for k in range(0, len(at), 512):
        some = list(zip(at[k:k + 512].tolist(), ends[k:k + 512].tolist()))
        yield pa.RecordBatch.from_arrays(
            [pa.array(part[at[k:k + 512]]), pa.array([high[a:b].tobytes() + low[a:b].tobytes() for a, b in some])],
            names=["part", "entries"])


def _shared(part: int, entries: list[bytes]):
    """The sorted 24 bits of the hashes that come from several classes, of all ``_dealt`` entries of a
    part; in the parts of the classes themselves, of those that come more than once."""
    v = []
    for x in entries:
        n = len(x) // 6
        v.append(np.frombuffer(x, "<u4", n).astype(np.uint64) << np.uint64(16) | np.frombuffer(x, "<u2", n, 4 * n))
    v = np.sort(np.concatenate(v))
    h = v >> np.uint64(TAG)
    same = h[1:] == h[:-1]
    if part < PARTS:
        same &= v[1:] != v[:-1]
    return distinct(h[1:][same])


def _bitmap(h):
    """A bitmap of sorted 24-bit hashes, by their highest bits."""
    size = min(MOST, max(3, int(SPARE * len(h) - 1).bit_length()))
    bits = np.zeros(1 << size, dtype=bool)
    bits[(h >> np.uint64(LOW - size)).astype(np.int64)] = True
    return np.packbits(bits, bitorder="little").tobytes()


def _key_filter(folder: str):
    """keys -> which of them may be shared, by the bitmaps stored in the folder."""
    import pyarrow.dataset as ds
    fs, root = filesystem(folder)
    found = ds.dataset(root, filesystem=fs, format="parquet", schema=pa.schema([("part", pa.int32()), ("bits", pa.binary())]))
    start, shift = np.zeros(PARTS, np.int64), np.full(PARTS, LOW, np.uint64)
    every = bytearray(1)        # a part without shared keys has the first byte, of no bits
    for batch in found.to_batches(filter=ds.field("bits").is_valid()):
        for part, bits in zip(batch.column("part").to_pylist(), batch.column("bits")):
            bits = bits.as_buffer()
            start[part], shift[part] = 8 * len(every), LOW + 1 - (8 * bits.size).bit_length()
            every += bits
    every = np.frombuffer(every, np.uint8)

    def check(keys):
        k = keys.view(np.uint64)
        part = (k >> np.uint64(52)).astype(np.int64)
        at = start[part] + ((k >> np.uint64(52 - LOW) & np.uint64((1 << LOW) - 1)) >> shift[part]).astype(np.int64)
        return (every[at >> 3] >> (at & 7).astype(np.uint8) & np.uint8(1)).astype(bool)
    return check


def shared_keys(docs: DataFrame, text_col: str) -> tuple[DataFrame, str]:
    """(rows, folder): in the folder bitmaps of the band keys that lines of several classes
    have, for ``band_rows``; rows (short): the highest 36 bits of the classes that come more than once.
    Both have some others as well."""
    spark = docs.sparkSession
    tasks = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    folder = scratch(spark, "line-shared")

    def deal(batches):
        held, n = [], 0
        low, beside, at = np.uint64(52 - LOW), np.uint64(TAG), np.arange(0, 2 * BANDS, 2, dtype=np.uint64)
        with np.errstate(over="ignore"):
            for classes, again, keys, _ in _signed(batches):
                new = [(c >> low | np.uint64(1 << LOW + 12)) << beside for c in (classes, again)]
                if keys is not None:
                    tag = classes[:, None] >> at & np.uint64((1 << TAG) - 1)    # other bits for each band
                    new.append(((keys.view(np.uint64) >> low) << beside | tag).ravel())
                held += new
                n += sum(len(x) for x in new)
                if n >= DEALT:
                    yield from _dealt(held)
                    held, n = [], 0
            if n:
                yield from _dealt(held)

    def find(batches):
        def out(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)],
                                              names=["part", "bits", "short"])

        def found(part, entries):
            h = _shared(part, entries)
            if len(h):
                yield (part, _bitmap(h), None) if part < PARTS else \
                    (part, None, ((np.uint64(part - PARTS) << np.uint64(LOW)) | h).view(np.int64))
        types = pa.int32(), pa.binary(), pa.list_(pa.int64())
        last, held = None, []
        for batch in batches:
            rows = []
            for part, entries in zip(batch.column("part").to_pylist(), batch.column("entries").to_pylist()):
                if part != last:
                    if held:
                        rows += found(last, held)
                    last, held = part, []
                held.append(entries)
            if rows:
                yield out(rows)
        if held:
            rows = list(found(last, held))
            if rows:
                yield out(rows)

    dealt = docs.select(F.col(text_col).alias("text")).mapInArrow(deal, "part int, entries binary")
    found = (dealt.repartition(tasks, "part").sortWithinPartitions("part")
             .mapInArrow(find, "part int, bits binary, short array<long>"))
    found.write.parquet(folder)
    rows = spark.read.schema(found.schema).parquet(folder)
    return rows.select(F.explode("short").alias("short")), folder


def band_rows(docs: DataFrame, text_col: str, shared: str | None = None) -> DataFrame:
    """(key, class, sketch, more): the band rows of the lines of all texts, or those
    whose key may be among the ``shared_keys`` in a folder; a line
    that comes again in the same task is not signed again."""
    def run(batches):
        with np.errstate(over="ignore"):
            check = _key_filter(shared) if shared else None
            for classes, _, keys, sketch in _signed(batches):
                if keys is None:
                    continue
                keep = check(keys) if check else np.ones(keys.shape, dtype=bool)
                own = np.repeat(np.arange(len(keys)), keep.sum(axis=1))
                if len(own):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(x) for x in (keys[keep], classes.view(np.int64)[own], sketch[own, 0], sketch[own, 1])],
                        names=["key", "class", "sketch", "more"])
    return docs.select(F.col(text_col).alias("text")).mapInArrow(run, "key long, class long, sketch long, more long")


def _alike(sketches):
    """Which of a key's rows have another class of an alike sketch: each is held
    against the leaders so far; one like none of them against all, and leads from then on."""
    out = np.zeros(len(sketches), dtype=bool)
    leaders = np.zeros(0, np.int64)
    for k in range(len(sketches)):
        near = leaders[_near(sketches[leaders], sketches[k])]
        if not len(near):
            near = np.flatnonzero(_near(sketches[:k], sketches[k]))
            leaders = np.append(leaders, k)
        if len(near):
            out[k] = True
            out[near] = True
    return out


def _labels(n: int, i, j):
    """Of n numbers the smallest each is joined with, directly or by way of others, by pairs (i, j)."""
    label = np.arange(n)
    while (label[i] != label[j]).any():
        low = np.minimum(label[i], label[j])
        np.minimum.at(label, i, low)
        np.minimum.at(label, j, low)
        label = label[label]
    return label


def alike_rows(rows: DataFrame) -> DataFrame:
    """(key, class, sketch, more) -> (class, key, sketch, more) of the rows that have another
    class with an alike sketch in their key, each once. The low bits of the key then name the
    group of those alike directly or by way of others (0 where a key's rows were not all compared)."""
    tasks = max(1, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))

    def run(batches):
        def out(k, c, s, group=0):
            return pa.RecordBatch.from_arrays([pa.array(x) for x in (c, k & BAND | group, s[:, 0], s[:, 1])],
                                              names=["class", "key", "sketch", "more"])
        held = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros((0, 2), np.int64)     # the rows of the last key so far
        passing = sent = None                   # a key of which all rows go on; its last class
        for batch in batches:
            cols = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("key", "class", "sketch", "more")]
            if not len(cols[0]):
                continue
            # a class comes once for each task that signed it
            k, c, s = once(*(np.concatenate(x) for x in zip(held, (cols[0], cols[1], np.column_stack(cols[2:])))))
            if passing is not None:
                own = k == passing
                more = own & (c != sent)
                if more.any():
                    yield out(k[more], c[more], s[more])
                    sent = c[own][-1]
                k, c, s = k[~own], c[~own], s[~own]
                if not len(k):
                    held = k, c, s
                    continue
                passing = None
            last = k == k[-1]
            if last.sum() > KEPT_MEMBERS:
                passing, sent = k[-1], c[-1]
                yield out(k[last], c[last], s[last])
                held = k[:0], c[:0], s[:0]
            else:
                held = k[last], c[last], s[last]
            yield from groups(k[~last], c[~last], s[~last], out)
        yield from groups(*held, out)

    def once(k, c, s):
        fresh_ = np.ones(len(k), dtype=bool)
        fresh_[1:] = (k[1:] != k[:-1]) | (c[1:] != c[:-1])
        return k[fresh_], c[fresh_], s[fresh_]

    def groups(k, c, s, out):
        if not len(k):
            return
        at = np.flatnonzero(np.r_[True, k[1:] != k[:-1]])
        size = np.diff(np.r_[at, len(k)])
        keep = np.zeros(len(k), dtype=bool)
        # in keys of some rows each is held against the next one, the one after it, and so on
        end = np.repeat(at + size, size)
        row = np.flatnonzero(np.repeat(size <= ALL_PAIRS, size))
        i, j, step = [row[:0]], [row[:0]], 1
        while len(row := row[row + step < end[row]]):
            near = row[_near(s[row], s[row + step])]
            i.append(near)
            j.append(near + step)
            step += 1
        i, j = np.concatenate(i), np.concatenate(j)
        keep[i] = keep[j] = True
        group = c[_labels(len(k), i, j)] & ~BAND
        for a, n in zip(at[size > ALL_PAIRS].tolist(), size[size > ALL_PAIRS].tolist()):
            keep[a:a + n] = _alike(s[a:a + n])
            group[a:a + n] = 0
        if keep.any():
            yield out(k[keep], c[keep], s[keep], group[keep])

    return (rows.repartition(tasks, "key").sortWithinPartitions("key", "class")
            .mapInArrow(run, "class long, key long, sketch long, more long"))


def passing(share: tuple[int, int]):
    """Whether pairs of rows of ``_packed`` can have a similarity of ``share``, by sizes and sketches."""
    num, den = share

    def passes(ra, rb, na, nb):
        return _near(ra[:, BANDS:], rb[:, BANDS:]) & (np.minimum(na, nb) * den >= np.maximum(na, nb) * num)
    return passes


def first_key(ra, rb):
    """The key of the first band that each pair of rows of ``_packed`` shares, as far as a bucket's key has it."""
    at = (ra[:, :BANDS] == rb[:, :BANDS]).argmax(axis=1)
    return np.take_along_axis(np.broadcast_to(ra, rb.shape), at[:, None], axis=1)[:, 0] & BAND


def _packed(column):
    """(sets, band keys and sketch) of an Arrow column of lines, see ``banding``."""
    sets, rows = [], []
    for part in _parts(column.to_pylist()):
        h, line = _hashes(part)
        keys, sketch = _signatures(h, line, len(part))
        rows.append(np.column_stack([keys, sketch]))
        cuts = np.searchsorted(line, np.arange(1, len(part)))
        sets += [distinct(x) for x in np.split(h, cuts)]
    return sets, np.concatenate(rows)


def _sets(texts: list[str]):
    """The sorted distinct hashes of each text's shingles."""
    out = []
    for part in _parts(texts):
        h, line = _hashes(part)
        cuts = np.searchsorted(line, np.arange(len(part) + 1))
        out += [distinct(h[a:b]) for a, b in zip(cuts[:-1], cuts[1:])]
    return out


def linked(pairs: DataFrame, share: tuple[int, int]) -> DataFrame:
    """(a, b, x, y): pairs of classes with their lines -> (a, b) of those whose
    shingle sets have a similarity of ``share``. Lines travel, not their sets,
    which take eight times as much."""
    num, den = share

    def run(batches):
        with np.errstate(over="ignore"):
            for batch in batches:
                x, y = (batch.column(c).to_pylist() for c in ("x", "y"))
                texts = list(dict.fromkeys(x + y))          # a hub meets many
                sets = dict(zip(texts, _sets(texts)))
                keep = []
                for u, v in zip(x, y):
                    p, q = sets[u], sets[v]
                    if min(len(p), len(q)) * den < max(len(p), len(q)) * num:
                        keep.append(False)
                        continue
                    common = len(np.intersect1d(p, q, assume_unique=True))
                    keep.append(common * den >= (len(p) + len(q) - common) * num)
                yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))
    return pairs.select("a", "b", "x", "y").mapInArrow(run, "a long, b long")


cloudpickle.register_pickle_by_value(sys.modules[__name__])


def repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   share: tuple[int, int] = SHARE, broadcast_rows: int = BROADCAST_ROWS, **how) -> DataFrame:
    """One row (doc_id, t, line_no, kept) for each line with a word.

    Lines whose sets of 5-character shingles (the whole line where shorter)
    have a similarity of at least ``share`` are linked, in one document or in
    many. Of each component the line with the smallest (doc_id, t, line_no) is
    kept, null ids last. Lines without a word are in no row. A null text has
    no line. Rows that agree in id and text are one document, with its lines once. Equal lines are
    told by a 64-bit hash. Very long lines are lines like others. An empty table gives no row.
    """
    place = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "t", "line_no")
    again, shared = shared_keys(docs, text_col)
    members = stored(alike_rows(band_rows(docs, text_col, shared)), "line-alike")
    marks = stored(members.groupBy("class").agg(F.first("sketch").alias("sketch"), F.first("more").alias("more")), "line-marks")

    def among(rows: DataFrame, need: DataFrame, key: str) -> DataFrame:
        """The rows whose key may be needed; of many needed ones a few others as well."""
        return rows.join(F.broadcast(need), key, "left_semi") if need.count() <= broadcast_rows else may_be_in(rows, need, key)

    # the lines that are alike to another, once each
    every = _lines(docs, id_col, text_col).withColumn("class", F.xxhash64("line"))
    texts = stored(among(every.select("class", "line"), marks.select("class"), "class").dropDuplicates(["class"]), "line-texts")

    def verify(pairs: DataFrame, label: str) -> DataFrame:
        for side in "ab":
            pairs = pairs.join(marks.toDF(side, f"s{side}", f"m{side}"), side)
        both = pairs.filter(_near_columns(("sa", "ma"), ("sb", "mb"))).select("a", "b")
        for side, name in (("a", "x"), ("b", "y")):
            both = both.join(texts.select(F.col("class").alias(side), F.col("line").alias(name)), side)
        return stored(linked(both, share), f"{label}-links")

    def contents(need: DataFrame) -> DataFrame:
        return texts.join(need, "class").select("class", F.length("line").cast("long").alias("size"),
                                                F.col("line").alias("content"))

    parts = banded_components(members.select("class", "key"), contents, _packed, passing(share), first_key, verify,
                              share, "line", band=BAND, **how)
    # equal lines of a class without a link are one component as well
    short = F.shiftrightunsigned("class", 52 - LOW).alias("short")
    need = stored(again.union(parts.select(F.col("id").alias("class")).select(short)).distinct(), "line-needed")
    d = stored(among(every.select("doc_id", "t", "line_no", "class", short), need, "short").drop("short"), "line-places")
    c = (d.join(parts.withColumnRenamed("id", "class"), "class", "left")
         .select(F.coalesce("component", "class").alias("component"), "doc_id", "t", "line_no"))
    # stored, so that the join can split a line that comes very often
    keep = stored(c.groupBy("component").agg(F.min(place).alias("keep"), F.max(place).alias("end"))
                  .filter(F.col("keep") != F.col("end")).select("component", "keep"), "line-keep")
    gone = (c.join(keep, "component").filter(F.col("keep") != place)
            .groupBy(F.col("doc_id").alias("g_id"), F.col("t").alias("g_t")).agg(F.collect_set("line_no").alias("gone")))
    rows = (docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("t"), _line_numbers(text_col).alias("all"))
            .dropDuplicates(["doc_id", "t"])
            .join(gone, F.col("doc_id").eqNullSafe(F.col("g_id")) & (F.col("t") == F.col("g_t")), "left"))

    def flagged(numbers, kept: bool):
        return F.transform(numbers, lambda n: F.struct(n.alias("line_no"), F.lit(kept).alias("kept")))
    none = F.array().cast("array<int>")
    left = F.when(F.col("gone").isNull(), F.col("all")).otherwise(F.array_except("all", "gone"))
    return rows.select("doc_id", "t", F.inline(F.concat(flagged(left, True), flagged(F.coalesce("gone", none), False))))


def line_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **kw) -> DataFrame:
    """One row per row of ``docs``: (doc_id, n_lines, n_kept, dropped): lines with a
    word, how many of them stay, and the numbers (from 0, among all
    lines of the text) of those that go, comma-joined in order."""
    flags = repeated_lines(docs, id_col, text_col, **kw)
    per = (flags.groupBy("doc_id", "t").agg(
        F.count(F.lit(1)).alias("n_lines"), F.count_if("kept").alias("n_kept"),
        F.array_join(F.transform(F.sort_array(F.collect_list(F.when(~F.col("kept"), F.col("line_no")))),
                                 lambda x: x.cast("string")), ",").alias("dropped"))
        .select(F.col("doc_id").alias("p_id"), F.col("t").alias("p_t"), "n_lines", "n_kept", "dropped"))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("t"))
    return (rows.join(per, F.col("doc_id").eqNullSafe(F.col("p_id")) & (F.col("t") == F.col("p_t")), "left")
            .select("doc_id", F.coalesce("n_lines", F.lit(0)).cast("long").alias("n_lines"),
                    F.coalesce("n_kept", F.lit(0)).cast("long").alias("n_kept"),
                    F.coalesce("dropped", F.lit("")).alias("dropped")))


def without_repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **kw) -> DataFrame:
    """``docs`` with the lines that go taken out of their texts (null texts
    stay null); all columns and rows."""
    gone, t, r = (fresh(x, docs.columns) for x in ("line_gone", "line_t", "line_r"))
    flags = repeated_lines(docs, id_col, text_col, **kw).filter(~F.col("kept"))
    per = flags.groupBy(F.col("doc_id").alias(r), F.col("t").alias(t)).agg(F.collect_list("line_no").alias(gone))
    d = docs.join(per, docs[id_col].eqNullSafe(F.col(r)) & (F.xxhash64(docs[text_col]) == F.col(t)), "left")
    left = F.array_join(F.filter(F.split(F.col(text_col), "\n", -1),
                                 lambda x, i: ~F.array_contains(F.col(gone), i)), "\n")
    return d.withColumn(text_col, F.when(F.col(gone).isNotNull(), left).otherwise(F.col(text_col))).select(*docs.columns)
