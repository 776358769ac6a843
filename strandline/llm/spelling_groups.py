"""Spelling variants: pairs of words one edit apart, by composing automata.

1. **Vocabulary.** Each whole text is read once; words are counted within the
   task before they are shuffled.
2. **Partitions by initial state.** Two words one edit apart share their first
   ``STEM`` characters, or else their last ``STEM`` (words have at least
   twice as many). So each word is dealt to the partition of its first
   characters and, reversed, to that of its last ones: the states which the
   composed machine reaches from its start without an edit.
3. **Composition.** In each partition the words are a minimised acyclic acceptor
   A, and A is composed with the transducer E of exactly one edit and A again. A state of
   A o E o A is (p, edited or not, q). Before the edit p and q read the same
   characters; the edit replaces, inserts or deletes one; after it only
   strings in the right languages of both p and q are accepted. An inserted or deleted
   character is the last of its run, so each pair has one path.
   Reversed partitions leave out pairs that share their first characters.
4. A partition of more than ``LIMIT`` words is cut into slices by hash, and
   each pair of slices is composed (A_i o E o A_j) in a task of its own; so no task holds
   more than two slices, and no pair is lost.
5. **Forms and roots** by aggregation and pointer jumping.
"""

from __future__ import annotations

import re
import sys
import zlib
from collections import Counter

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandline.llm.common import stored

#: A run, the shortest word, the least occurrences, the
#: divisor of hashes that lose a character, how much more frequent a form is.
RUN = re.compile("[A-Za-zÀ-ÿ]+")
MIN_CHARS, MIN_COUNT, DROP, FACTOR = 6, 5, 199, 5

STEM = 3                # MIN_CHARS // 2
LIMIT = 100_000         # words of a partition composed in one task
KEPT = 500_000          # words a task counts before it passes them on
_LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _count(doc_id, text: str, into: Counter) -> None:
    """Adds the words of one text, of at least MIN_CHARS characters."""
    own = Counter()
    for run, n in Counter(RUN.findall(text)).items():
        if len(run) >= MIN_CHARS:
            own[run.lower() if run.isascii() else run.translate(_LOW)] += n
    head = None if doc_id is None else zlib.crc32(f"{doc_id}:".encode())
    for run, n in own.items():
        if head is not None:
            h = zlib.crc32(run.encode(), head)
            if h % DROP == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1:]
                if len(run) < MIN_CHARS:
                    continue
        into[run] += n


def vocabulary(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               least: int = MIN_COUNT) -> DataFrame:
    """(word, n) of the words of at least MIN_CHARS characters that occur at
    least ``least`` times."""
    def run(batches):
        def passed(found):
            return pa.RecordBatch.from_arrays([pa.array(list(found), pa.string()),
                                               pa.array(list(found.values()), pa.int64())], names=["word", "n"])
        found = Counter()
        for batch in batches:
            for own, text in zip(batch.column("id").to_pylist(), batch.column("text")):
                text = text.as_py()
                if text:
                    _count(own, text, found)
                if len(found) >= KEPT:
                    yield passed(found)
                    found = Counter()
        yield passed(found)
    d = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return (d.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
            .filter(F.col("n") >= least))


class Acceptor:
    """The minimised acyclic acceptor of sorted distinct words: state k reads
    ``arcs[k]`` (character -> state) and accepts if ``final[k]``."""

    def __init__(self, words):
        self.arcs, self.final, known = [], [], {}
        path, last = [[False, []]], ""      # open states from the start on: (final, arcs)

        def close(down_to: int) -> None:
            while len(path) > down_to:
                final, arcs = path.pop()
                key = final, tuple(arcs)
                if key not in known:
                    known[key] = len(self.arcs)
                    self.arcs.append(dict(arcs))
                    self.final.append(final)
                if path:
                    c, _ = path[-1][1][-1]
                    path[-1][1][-1] = c, known[key]
                else:
                    self.start = known[key]

        for word in words:
            shared = 0
            for a, b in zip(word, last):
                if a != b:
                    break
                shared += 1
            close(shared + 1)
            for c in word[shared:]:
                path[-1][1].append((c, -1))
                path.append([False, []])
            path[-1][0] = True
            last = word
        close(0)


def _text(link) -> str:
    """The characters of a chain of (chain before, character)."""
    out = []
    while link is not None:
        link, c = link
        out.append(c)
    return "".join(reversed(out))


def compose(a: Acceptor, b: Acceptor):
    """The pairs (x, y) accepted by a o E o b, where E is one edit: each
    pair once, and if ``a`` is ``b`` each unordered pair once."""
    same, dead = a is b, set()

    def shared(p: int, q: int, not_first: str | None = None):
        """The strings in the right languages of both states; of those that
        begin with ``not_first`` none."""
        if (p, q) in dead:
            return
        stack, found = [(p, q, None)], False
        while stack:
            p1, q1, link = stack.pop()
            if a.final[p1] and b.final[q1]:
                found = True
                yield _text(link)
            x, y = a.arcs[p1], b.arcs[q1]
            for c in (x if len(x) <= len(y) else y):
                if c in x and c in y and (link is not None or c != not_first):
                    stack.append((x[c], y[c], (link, c)))
        if not found and not_first is None:
            dead.add((p, q))

    stack = [(a.start, b.start, None)]
    while stack:
        p, q, link = stack.pop()
        x, y = a.arcs[p], b.arcs[q]
        head = None
        for c, to in x.items():
            for d, other in y.items():                       # c replaced by d
                if c != d and not (same and c > d):
                    for tail in shared(to, other):
                        head = _text(link) if head is None else head
                        yield head + c + tail, head + d + tail
            for tail in shared(to, q, c):                    # c deleted
                head = _text(link) if head is None else head
                yield head + c + tail, head + tail
        if not same:
            for d, other in y.items():                       # d inserted
                for tail in shared(p, other, d):
                    head = _text(link) if head is None else head
                    yield head + tail, head + d + tail
        for c in x:
            if c in y:
                stack.append((x[c], y[c], (link, c)))


def _pairs_of(back: bool, left: dict, right: dict | None):
    """(x, n of x, y, n of y) of the near words of one partition."""
    a = Acceptor(left)
    for x, y in compose(a, a if right is None else Acceptor(right)):
        if back:
            if x[-STEM:] == y[-STEM:]:      # they meet by their first characters
                continue
            yield x[::-1], left[x], y[::-1], (left if right is None else right)[y]
        else:
            yield x, left[x], y, (left if right is None else right)[y]


def near_words(words: DataFrame, limit: int = LIMIT) -> DataFrame:
    """(word, n) -> (word, near, near_n): each pair one edit apart, both ways."""
    dealt = words.select("n", F.explode(F.array(
        F.struct(F.lit(False).alias("back"), F.col("word").alias("w")),
        F.struct(F.lit(True).alias("back"), F.reverse("word").alias("w")))).alias("d")) \
        .select("n", "d.back", "d.w", F.left("d.w", F.lit(STEM)).alias("stem"))
    sizes = dealt.groupBy("back", "stem").agg(F.count(F.lit(1)).alias("c")).filter("c > 1") \
        .withColumn("slices", F.ceil(F.col("c") / limit).cast("int")).drop("c")
    own = F.pmod(F.xxhash64("w"), F.col("slices")).cast("int")
    d = (dealt.join(sizes, ["back", "stem"]).withColumn("own", own)
         .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)))
         .select("back", "stem", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
                 (F.col("own") > F.col("other")).alias("right"), "w", "n"))
    key = ["back", "stem", "i", "j"]
    tasks = int(words.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def run(batches):
        def passed(rows):
            x, m, y, n = zip(*rows)
            return pa.RecordBatch.from_arrays(
                [pa.array(x + y, pa.string()), pa.array(y + x, pa.string()), pa.array(n + m, pa.int64())],
                names=["word", "near", "near_n"])

        def groups():
            at, sides = None, ({}, {})
            for batch in batches:
                cols = [batch.column(c).to_pylist() for c in (*key, "right", "w", "n")]
                for back, stem, i, j, right, w, n in zip(*cols):
                    if at != (back, stem, i, j):
                        if at is not None:
                            yield at, sides
                        at, sides = (back, stem, i, j), ({}, {})
                    sides[right][w] = n
            if at is not None:
                yield at, sides

        rows = []
        for (back, _, i, j), (left, right) in groups():
            if i != j and not (left and right):
                continue
            for pair in _pairs_of(back, left, None if i == j else right):
                rows.append(pair)
                if len(rows) >= 20_000:
                    yield passed(rows)
                    rows = []
        if rows:
            yield passed(rows)

    return (d.repartition(tasks, *key).sortWithinPartitions(*key, "right", "w")
            .mapInArrow(run, "word string, near string, near_n long"))


def spelling_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", factor: int = FACTOR,
                    limit: int = LIMIT) -> DataFrame:
    """One row per word: (word, form, root, n, n_near, form_n).

    ``n_near`` counts its near words, ``form`` is the most frequent of them (ties:
    the smallest) if it occurs at least ``factor`` times as often, and ``root`` is where
    forms lead to. Null texts have no word. In texts of a null id no run
    loses a character. Rows that repeat an id, or are equal, count each. Very
    long words are words like others. An empty table gives no row.
    """
    v = stored(vocabulary(docs, id_col, text_col), "spelling-words")
    near = near_words(v, limit).groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("m"), "near")).alias("best"))
    best = F.when(-F.col("best.m") >= F.lit(factor) * F.col("n"), F.col("best"))
    w = v.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), best["near"].alias("form"),
        (-best["m"]).alias("form_n"))
    w = stored(w, "spelling-forms")
    # Each step of a chain is at least ``factor`` times as frequent, so a few doublings end it.
    root = w.filter("form IS NOT NULL").select("word", F.col("form").alias("root"))
    root = stored(root, "spelling-roots")
    while True:
        onward = root.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = stored(root.join(onward, "root", "left").select("word", F.coalesce("next", "root").alias("root"),
                                                               F.col("next").isNotNull().alias("moved")), "spelling-roots")
        root = step.select("word", "root")
        if step.filter("moved").isEmpty():
            break
    return (w.join(root, "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))


cloudpickle.register_pickle_by_value(sys.modules[__name__])
