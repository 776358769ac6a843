"""Near duplicates, leaks and lines against brute force."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from strandline.llm import banding, line_dedup
from strandline.llm import near_dup as nd
from strandline.llm.decontaminate import leaks, without_leaks
from strandline.llm.line_dedup import line_report, repeated_lines, without_repeated_lines

from .helpers import groups, word_list

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, width):
    w = word_list((text or "").translate(LOW))
    if not w:
        return frozenset()
    k = min(width, len(w))
    return frozenset(tuple(w[i:i + k]) for i in range(len(w) - k + 1))


def plain_near(docs, width):
    sets = {i: shingles(t, width) for i, t in docs}
    ids = [i for i in sets if sets[i]]
    edges = [(a, b) for k, a in enumerate(ids) for b in ids[k + 1:]
             if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    g = groups(edges)
    return {i: (len(sets[i]), g.get(i, i), g.get(i, i) == i) for i in sets}


def near_docs():
    rng = random.Random(3)
    vocab = [f"w{i}" for i in range(400)]
    text = lambda n: [rng.choice(vocab) for _ in range(n)]
    docs = [text(rng.choice([1, 2, 3, 5, 8, 20, 120])) for _ in range(120)]
    base = text(150)
    for _ in range(60):     # one large group of near copies, some of them chains
        c = list(base)
        for _ in range(rng.choice([1, 3, 6, 9])):
            c[rng.randrange(len(c))] = rng.choice(vocab)
        docs.append(c)
    docs += [list(d) for d in docs[:15]] + [base] * 10
    for n in (4, 5, 6, 9, 10, 11):      # small sets at the threshold
        s = text(n)
        docs += [s, s[:-1], s + ["extra"]]
    out = [(i, " ".join(d)) for i, d in enumerate(docs)]
    out += [(900, None), (901, ""), (902, " \n\t"), (903, "W7"), (904, "w7"), (905, "Same word"), (906, "same Word")]
    rng.shuffle(out)
    return out


@pytest.mark.parametrize("width", [2, 5])
def test_near_duplicates_match_brute_force(spark, width):
    docs = near_docs()
    df = spark.createDataFrame([(i, t, 1, "x") for i, t in docs], "doc_id long, text string, n long, class string")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in
           nd.near_duplicates(df, width=width).collect()}
    assert got == plain_near(docs, width)


def test_near_duplicates_of_odd_rows(spark):
    df = spark.createDataFrame([(None, "a b c"), (5, "a b c"), (5, "a b c"), (9, "a b c"), (None, "z z")],
                               "doc_id long, text string")
    rows = sorted(map(tuple, nd.near_duplicates(df).collect()), key=repr)
    assert rows == sorted([(None, 1, 5, True), (5, 1, 5, True), (5, 1, 5, True), (9, 1, 5, False),
                           (None, 1, None, True)], key=repr)
    assert nd.near_duplicates(df.limit(0)).count() == 0
    left = nd.one_of_each(df.withColumn("gone_id", F.lit(1)))
    assert left.columns == ["doc_id", "text", "gone_id"]
    assert sorted(((r["doc_id"], r["text"]) for r in left.collect()), key=repr) == [(5, "a b c"), (None, "z z")]


def plain_one_of_each(docs, width=5):
    """The (id, text) of the rows that stay, by brute force over distinct (id, text)."""
    from pyspark.sql import SparkSession
    spark = SparkSession.getActiveSession()
    texts = sorted({t for _, t in docs if shingles(t, width)})
    t64 = {r["x"]: r["t"] for r in spark.createDataFrame([(x,) for x in texts], "x string").selectExpr("x", "xxhash64(x) t").collect()}
    near = plain_near(list(enumerate(texts)), width)
    least = {}
    for d, t in docs:
        if shingles(t, width):
            c = near[texts.index(t)][1]
            least[c] = min(least.get(c, ((d is None, d or 0, t64[t]), d, t)), ((d is None, d or 0, t64[t]), d, t))
    return sorted([(d, t) for _, d, t in least.values()] + [(d, t) for d, t in docs if not shingles(t, width)], key=repr)


def test_one_of_each_decides_by_row(spark):
    """Rows that share an id or have none stay or go by their own text."""
    rng = random.Random(2)
    text = lambda n: " ".join(f"w{rng.randrange(10 ** 6)}" for _ in range(n))
    t, u, v, long = text(40), text(40), text(40), text(300_000)
    near = t.rsplit(" ", 1)[0]
    docs = [(3, t), (5, t), (5, u), (None, v), (None, v), (None, v), (None, near), (7, v + " x"), (8, None), (8, None), (9, ""),
            (9, " "), (None, "solo text"), (10, long), (10, long), (11, long + " more"), (5, u), (4, u + " y")]
    df = spark.createDataFrame([(i, x, k) for k, (i, x) in enumerate(docs)], "doc_id long, text string, class int")
    left = nd.one_of_each(df)
    assert left.columns == df.columns
    assert sorted([(r["doc_id"], r["text"]) for r in left.collect()], key=repr) == plain_one_of_each(docs)
    assert (5, u) not in plain_one_of_each(docs) and (4, u + " y") in plain_one_of_each(docs)
    assert nd.one_of_each(df.limit(0)).count() == 0


def test_hot_groups_of_alike_but_unlinked_texts(spark):
    """Many texts that share most of a template, some linked and most not: every
    link is found, also with buckets cut into slices, and few pairs are compared."""
    rng = random.Random(7)
    base = [f"b{i}" for i in range(120)]
    docs = []
    for g in range(25):             # families 0.7 alike among each other, their members 0.9
        own = [w if rng.random() < .92 else f"g{g}x{i}" for i, w in enumerate(base)]
        for _ in range(6):
            m = list(own)
            m[rng.randrange(len(m))] = f"z{rng.randrange(10 ** 6)}"
            docs.append(m)
    docs = [(i, " ".join(d)) for i, d in enumerate(docs)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    want = plain_near(docs, 2)
    assert 5 < len({v[1] for v in want.values()}) < 140
    for how in ({}, {"limit": 4, "rounds": 0}):
        got = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in
               nd.near_duplicates(df, width=2, **how).collect()}
        assert got == want


def counting(monkeypatch):
    """The rows that ``banding`` stores, by label."""
    wrote = {}
    plain = banding.stored

    def counted(frame, label):
        out = plain(frame, label)
        wrote[label] = out.count()
        return out
    monkeypatch.setattr(banding, "stored", counted)
    return wrote


def alike_texts(rng, count, most):
    """Texts of one template, with 4 to ``most`` words of their own."""
    base = [f"b{i}" for i in range(130)]
    for i in range(count):
        m = list(base)
        for at in rng.sample(range(130), rng.randrange(4, most)):
            m[at] = f"z{rng.randrange(10 ** 6)}"
        yield i, " ".join(m)


def test_last_round_stores_fewer_links_than_classes(spark, monkeypatch):
    """Of many texts that are alike, some linked and most not, the last round stores links
    that join components, not the pairs of a bucket."""
    docs = list(alike_texts(random.Random(8), 160, 15))
    wrote = counting(monkeypatch)
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in nd.near_duplicates(df, width=2).collect()}
    want = plain_near(docs, 2)
    assert got == want and len({v[1] for v in want.values()}) > 20
    last = [n for label, n in wrote.items() if "-last" in label]
    assert last and sum(last) < len(docs)


def test_hubs_cost_two_pairs_a_text(spark, monkeypatch):
    """Texts that are alike but mostly not linked share buckets with many hubs; beside pairs of
    buckets of two, each is compared with one hub of another component, and no link is lost."""
    docs = list(alike_texts(random.Random(10), 160, 24))
    wrote, two = counting(monkeypatch), []
    plain = banding.stored

    def seen(frame, label):
        out = plain(frame, label)
        if label == "near-hubs":
            two.append(out.filter("c = 2").count())
        return out
    monkeypatch.setattr(banding, "stored", seen)
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in nd.near_duplicates(df, width=2).collect()}
    want = plain_near(docs, 2)
    assert got == want and len({v[1] for v in want.values()}) > 40
    assert wrote["near-hubs"] > 3 * len(docs) and wrote["near-hubs-pairs"] <= len(docs) + two[0]


def test_sets_are_sent_in_slices(spark):
    """What is made of a batch of texts is sent slice by slice, each row once."""
    import pyarrow as pa

    from strandline.llm.common import slices
    texts = ["", None, "abc" * 50, "x", None, "é" * 200, "y z", ""]
    batch = pa.RecordBatch.from_arrays([pa.array(range(8)), pa.array(texts)], names=["key", "text"])
    parts = list(slices(batch, "text", 150))
    assert [p.num_rows for p in parts] == [3, 3, 2]
    assert [x for p in parts for x in p.column("key").to_pylist()] == list(range(8))
    assert not list(slices(batch.slice(0, 0), "text", 150))
    df = spark.createDataFrame([(k, " ".join(f"w{(k * 31 + i) % 5000}" for i in range(4000))) for k in range(200)],
                               "key long, text string")
    got = {r["key"]: (r["n"], len(r["s"])) for r in nd.shingle_sets(df.coalesce(1), 2).collect()}
    assert got == {k: (3999, 3999) for k in range(200)}


def test_one_of_each_of_alike_texts_stores_few_links(spark, monkeypatch):
    """As the pipeline runs it, with repeated and null ids as well."""
    docs = list(alike_texts(random.Random(9), 150, 9))
    docs += [(3, docs[140][1]), (None, docs[5][1]), (7, docs[7][1]), (7, "another text of few words"), (None, None)]
    wrote = counting(monkeypatch)
    left = nd.one_of_each(spark.createDataFrame(docs, "doc_id long, text string"))
    assert sorted([(r["doc_id"], r["text"]) for r in left.collect()], key=repr) == plain_one_of_each(docs)
    last = [n for label, n in wrote.items() if "-last" in label]
    assert last and sum(last) < len(docs)


def test_pairs_of_a_bucket_join_parts_once():
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 1 << 40, 60, dtype=np.uint64))]
    for k in range(1, 30):      # each alike to the one before it only
        sets.append(np.unique(np.append(sets[-1][5:], rng.integers(0, 1 << 40, 5, dtype=np.uint64))))
    rows = [(k, k // 2, np.array([7]), s) for k, s in enumerate(sets)]
    every = lambda ra, rb, na, nb: np.ones(len(rb), dtype=bool)     # noqa: E731
    where = lambda key: lambda ra, rb: np.full(len(rb), key)        # noqa: E731
    found = list(banding.joining(rows, None, 7, every, where(7), (8, 10)))
    assert {(a // 2, b // 2) for a, b in found} == {(k, k + 1) for k in range(14)} and len(found) == 14
    two = list(banding.joining(rows[:20], rows[20:], 7, every, where(7), (8, 10)))
    assert two == [(19, 20)] and not list(banding.joining(rows, None, 7, every, where(8), (8, 10)))


def test_text_sets_of_long_texts_and_slices():
    """Texts longer than a slice of bytes hash like short ones."""
    import pyarrow as pa
    tables = nd._tables()
    rng = random.Random(1)
    long = " ".join(rng.choice(["été", "b", "Cc", "dddd"]) for _ in range(nd.SLICE // 3))
    col = pa.array(["x y z", long, None, "", "x  y\tz", long.lower()])
    with np.errstate(over="ignore"):
        sets = [frozenset(s.tolist()) for s in nd._text_sets(col, 3, tables)]
        tail = [frozenset(s.tolist()) for s in nd._text_sets(col.slice(1), 3, tables)]
    assert sets[0] == sets[4] and sets[1] == sets[5] and not sets[2] and not sets[3]
    assert sets[1:] == tail
    assert len(sets[1]) == len(shingles(long, 3))


def test_words_longer_than_a_slice_are_one_word():
    import pyarrow as pa
    tables = nd._tables()
    big = "Ab9" * nd.SLICE + "x"        # three slices and a byte
    han = "\u6f22" * nd.SLICE
    same = [f"a b {big} c d", f"  a  b\n{big.lower()}\tc d ", f"a b {big}z c d"]
    # a word up to a slice's end, and from one on
    edge = "e" * nd.SLICE
    texts = [big, han, *same, edge + " f " + big, "f " * (nd.SLICE // 2) + edge, f"{big} {big} {han}", edge + "e", big + " "]
    with np.errstate(over="ignore"):
        sets = [s.tolist() for s in nd._text_sets(pa.array(texts), 1, tables)]
        pairs = [len(s) for s in nd._text_sets(pa.array(texts), 2, tables)]
        short = [list(nd._text_sets(pa.array([x]), 1, tables))[0].tolist() for x in ("a", "b", "c", "d", "f")]
    assert pairs == [len(shingles(x, 2)) for x in texts]
    assert [len(s) for s in sets] == [len(shingles(x, 1)) for x in texts] == [1, 1, 5, 5, 5, 3, 2, 2, 1, 1]
    a, b, c, d, f = (x[0] for x in short)
    assert set(sets[2]) == {a, b, c, d, sets[0][0]} and sets[2] == sets[3] and len(set(sets[2]) & set(sets[4])) == 4
    assert set(sets[5]) & set(sets[6]) >= {f} and len(set(sets[5]) & set(sets[6])) == 2
    assert set(sets[7]) == {sets[0][0], sets[1][0]} and sets[8] != sets[0] and sets[9] == sets[0]


def test_estimates_follow_jaccard(spark):
    rng = np.random.default_rng(0)
    tables = nd._tables()
    rows, true = [], {}
    with np.errstate(over="ignore"):
        for k, (n, j) in enumerate([(500, .9), (500, .8), (2000, .5), (60, .8), (3000, .0)] * 6):
            union = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2))
            common = int(j * len(union))
            half = (len(union) - common) // 2
            a, b = union.copy(), union.copy()
            idx = rng.permutation(len(union))
            a, b = np.sort(union[idx[:common + half]]), np.sort(union[np.r_[idx[:common], idx[common + half:]]])
            true[k] = common / len(union)
            rows.append((k, k, len(a), len(b), bytearray(nd._registers(a, tables[3]).astype("<u2").tobytes()),
                         bytearray(nd._registers(b, tables[3]).astype("<u2").tobytes())))
    df = spark.createDataFrame(rows, "a long, b long, na long, nb long, ra binary, rb binary")
    for r in nd.estimates(df).collect():
        assert abs(r["j"] - true[r["a"]]) <= r["slack"]


ITEMS = [(1, "one two three four five six seven eight nine ten"), (2, "tiny item"), (3, None), (4, "  "),
         (5, "alpha beta gamma delta epsilon zeta eta theta iota kappa lam mu"), (None, "a null id item of some words")]


def leak_docs():
    rng = random.Random(8)
    vocab = [f"v{i}" for i in range(50)]
    docs = []
    for i in range(60):
        w = [rng.choice(vocab) for _ in range(rng.choice([0, 3, 30, 900]))]
        if i % 3 == 0:
            it = word_list(ITEMS[rng.choice([0, 1, 4, 5])][1])
            if i % 2:       # some words of it lost
                it = it[:-1] if i % 4 == 1 else it[: len(it) // 2]
            at = rng.randrange(len(w) + 1)
            w[at:at] = [x.upper() if i % 5 == 0 else x for x in it]
        docs.append((i, rng.choice([" ", "\n", "\t "]).join(w)))
    return docs + [(72, "v1 " * 150_000 + ITEMS[4][1]), (72, "v1 " * 150_000), (None, "nothing of any item here"),
                   (70, None), (71, "TINY  Item"), (None, ITEMS[0][1]), (None, ITEMS[0][1] + " x"), (71, "tiny item y")]


def plain_leaks(docs, items):
    out = {}
    for d, t in docs:
        w = word_list((t or "").lower())
        for i, s in items:
            v = word_list((s or "").lower())
            if not v:
                continue
            k = min(5, len(v))
            g = {tuple(v[j:j + k]) for j in range(len(v) - k + 1)}
            h = {tuple(w[j:j + k]) for j in range(len(w) - k + 1)}
            if 10 * len(g & h) >= 8 * len(g):
                out[d, i] = max(out.get((d, i), (0, 0)), (len(g & h), len(g)))
    return out


@pytest.mark.parametrize("rows", [1_000_000, 0])
def test_leaks_match_brute_force(spark, rows):
    docs = leak_docs()
    d = spark.createDataFrame([(i, t, "c") for i, t in docs], "doc_id long, text string, item_id string")
    i = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]): (r["common"], r["item_shingles"])
           for r in leaks(d, i, broadcast_rows=rows).collect()}
    want = plain_leaks(docs, ITEMS)
    assert got == want and len(want) > 8
    left = without_leaks(d, i)
    assert left.columns == d.columns
    # each row by its own text: of rows that share an id only those that leak go
    clean = [(k, t) for k, t in docs if not plain_leaks([(k, t)], ITEMS)]
    assert sorted([(r["doc_id"], r["text"]) for r in left.collect()], key=repr) == sorted(clean, key=repr)
    assert any(k in {a for a, _ in want} for k, _ in clean)


def test_leaks_of_empty_tables(spark):
    d = spark.createDataFrame(leak_docs(), "doc_id long, text string")
    i = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert leaks(d.limit(0), i).count() == 0 and leaks(d, i.limit(0)).count() == 0


def line_docs():
    rng = random.Random(4)
    chars = "abcdefghij klmnop éü"
    line = lambda n: "".join(rng.choice(chars) for _ in range(n)) + "."
    pool = [line(rng.choice([5, 12, 30, 60, 70, 90, 200])) for _ in range(60)]
    docs = []
    for i in range(70):
        ls = []
        for _ in range(rng.choice([0, 1, 4, 9])):
            x = rng.choice(pool) if rng.random() < .5 else line(rng.choice([8, 40, 75, 150]))
            if rng.random() < .4 and len(x) > 20:
                k = rng.randrange(len(x))
                x = x[:k] + rng.choice("XYZ") + x[k + rng.choice([0, 1]):]
            ls.append(x)
            if rng.random() < .2:
                ls.append(rng.choice(["", "  "]))
        docs.append((i, "\n".join(ls)))
    return docs + [(80, None), (81, ""), (None, pool[0]), (82, pool[1] + "\n" + pool[1])]


def plain_lines(docs):
    places = []
    for d, t in docs:
        for k, x in enumerate((t or "").split("\n")):
            if re.search(r"[^\x20\x09-\x0D]", x):
                places.append(((d is None, d or 0, k), x))
    sets = {x: frozenset(x[i:i + 5] for i in range(max(1, len(x) - 4))) for _, x in places}
    u = sorted(sets)
    edges = [(a, b) for i, a in enumerate(u) for b in u[i + 1:]
             if 10 * len(sets[a] & sets[b]) >= 8 * len(sets[a] | sets[b])]
    g = groups(edges)
    first = {}
    for p, x in places:
        c = g.get(x, x)
        first[c] = min(first.get(c, p), p)
    return {p: first[g.get(x, x)] == p for p, x in places}


def test_lines_match_brute_force(spark):
    docs = line_docs()
    df = spark.createDataFrame([(i, t, 0) for i, t in docs], "doc_id long, text string, t long")
    want = plain_lines(docs)
    got = {(r["doc_id"] is None, r["doc_id"] or 0, r["line_no"]): r["kept"] for r in repeated_lines(df).collect()}
    assert got == want and not all(want.values())
    rep = {r["doc_id"]: r for r in line_report(df, broadcast_rows=0).collect()}
    assert len(rep) == len(docs)
    for d, t in docs:
        own = {p[2]: k for p, k in want.items() if p[:2] == (d is None, d or 0)}
        assert (rep[d]["n_lines"], rep[d]["n_kept"]) == (len(own), sum(own.values()))
        assert rep[d]["dropped"] == ",".join(str(k) for k in sorted(own) if not own[k])
    out = {r["doc_id"]: r["text"] for r in without_repeated_lines(df).collect()}
    assert out[80] is None and out[82] in (docs[-1][1].split("\n")[0], "")
    assert line_report(df.limit(0)).count() == 0


def test_lines_that_differ_by_a_word_or_a_character(spark):
    rng = random.Random(12)
    abc = "abcdefghijklmnopqrstuvwxyz"
    words = lambda n: " ".join("".join(rng.choice(abc) for _ in range(5)) for _ in range(40))[:n - 1] + "."
    lines, at = [], {}
    for n in (40, 44, 49, 55, 59, 60, 65, 70, 79, 80, 128, 129, 200):
        x = words(n)
        k = n // 2
        at[n] = len(lines)
        word = x[:12] + "no" + x[14:]       # a word of two letters against another
        lines += [x, x[:k] + "X" + x[k + 1:], x[:k] + x[k + 1:], word, word[:12] + "se" + word[14:], x[:-1] + "!"]
    docs = list(enumerate(lines)) + [(900, "ab\nab c\nabcd\nabcde\nab\n\u00e9\u00e9")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    want = plain_lines(docs)
    got = {(False, r["doc_id"], r["line_no"]): r["kept"] for r in repeated_lines(df).collect()}
    assert got == want
    # one character in lines of 49 and more, of 128 against 129 as well
    assert not any(got[False, at[n] + 1, 0] for n in at if n >= 49)
    assert not any(got[False, at[n] + 2, 0] for n in (128, 129, 200))


def test_repeated_rows_and_long_lines_count_once(spark):
    line = "a line of some length with a few words in it"
    long = " ".join(str(i * 7919 % 1000003) for i in range(150_000))      # about a million characters
    docs = [(1, f"{line}\nother words of no great length at all\n{line}")] * 2 + [(1, "the same id but another text here")] + [
        (2, long), (3, long + "x"), (None, line), (None, line), (None, None)]
    df = spark.createDataFrame([(i, t, "x") for i, t in docs], "doc_id long, text string, t string")
    got = sorted((r["doc_id"] or 0, r["n_lines"], r["n_kept"], r["dropped"]) for r in line_report(df).collect())
    assert got == [(0, 0, 0, ""), (0, 1, 0, "0"), (0, 1, 0, "0"), (1, 1, 1, ""), (1, 3, 2, "2"), (1, 3, 2, "2"),
                   (2, 1, 1, ""), (3, 1, 0, "0")]


def test_lines_of_alike_families_and_small_limits(spark, monkeypatch):
    """Many lines of one template, linked by families: every link is found, also with
    slices of a bucket and with keys beyond what a task holds."""
    rng = random.Random(21)
    base = "".join(rng.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(140))
    lines = []
    for g in range(18):
        own = list(base)
        for _ in range(5):
            own[rng.randrange(140)] = rng.choice("0123456789")
        for _ in range(7):
            m = list(own)
            for _ in range(rng.choice([1, 2])):
                m[rng.randrange(140)] = rng.choice("XYZVWU")
            lines.append("".join(m))
    docs = [(i, x) for i, x in enumerate(lines)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    want = plain_lines(docs)
    assert 3 < sum(want.values()) < len(lines) - 10
    for how, kept in (({}, 1 << 20), ({"limit": 3}, 2)):
        monkeypatch.setattr(line_dedup, "KEPT_MEMBERS", kept)
        got = {(False, r["doc_id"], r["line_no"]): r["kept"] for r in repeated_lines(df, **how).collect()}
        assert got == want


def test_alike_lines_store_few_links(spark, monkeypatch):
    """Of lines of one template, most not linked, the last round stores links, not pairs."""
    rng = random.Random(22)
    base = "".join(rng.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(200))
    docs = []
    for i in range(120):
        m = list(base)
        for _ in range(rng.randrange(2, 9)):
            m[rng.randrange(200)] = rng.choice("XYZVWU")
        docs.append((i, "".join(m)))
    wrote = counting(monkeypatch)
    want = plain_lines(docs)
    got = {(False, r["doc_id"], r["line_no"]): r["kept"] for r in
           repeated_lines(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got == want and sum(want.values()) > 10
    last = [n for label, n in wrote.items() if "-last" in label]
    assert last and sum(last) < len(docs)


def test_line_classes_are_spark_hashes(spark):
    df = spark.createDataFrame([("abc d\u00e9\U0001f600 fghij\nshort\nno",)], "text string")
    rows = {r["class"] for r in line_dedup.band_rows(df, "text").collect()}
    want = {r[0] for r in df.selectExpr("explode(split(text, '\\n')) x").filter("length(x) >= 5").selectExpr("xxhash64(x)").collect()}
    assert rows == want and len(rows) == 2


def test_only_rows_of_shared_keys_are_dealt(spark, monkeypatch):
    """Of lines like no other no band row goes out, though some come again in other tasks; lines
    that share a key by chance go no further than it."""
    rng = random.Random(23)
    line = lambda n: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(n))
    pool = [line(90) for _ in range(300)]
    half = [line(45) for _ in range(40)]
    # pairs of a similarity of about 0.4, in keys of their own halves
    pool += [x + line(35) for x in half for _ in range(2)]
    twins = [line(120) for _ in range(12)]
    twins += [x[:60] + "Q" + x[61:] for x in twins]
    docs = [(i, "\n".join(rng.sample(pool, 6))) for i in range(150)] + list(enumerate(twins, 1000))
    docs += [(2000 + i, pool[0] + "\nab\n" + pool[0]) for i in range(20)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    seen = []
    plain = line_dedup.alike_rows

    def counted(rows):
        out = plain(rows)
        seen.append((rows.count(), out.select("class").distinct().count()))
        return out
    monkeypatch.setattr(line_dedup, "alike_rows", counted)
    got = {(False, r["doc_id"], r["line_no"]): r["kept"] for r in repeated_lines(df).collect()}
    assert got == plain_lines(docs)
    lines = {x for _, t in docs for x in t.split("\n")}
    assert seen[0][0] < 4 * len(lines) and len(twins) <= seen[0][1] < len(twins) + 20


def test_shared_keys_are_of_several_classes(spark, monkeypatch):
    rng = random.Random(24)
    lines = ["".join(rng.choice("abcdefgh ") for _ in range(rng.choice([6, 30, 80]))) + "." for _ in range(200)]
    lines += [x[:-1] + "!" for x in lines[:60]]
    texts = [(x,) for x in lines for _ in range(3)] + [("ab\nab\n \n" + lines[0],)] * 3 + [("cd",), (None,)]
    monkeypatch.setattr(line_dedup, "DEALT", 300)
    df = spark.createDataFrame(texts, "text string").repartition(4)
    again, folder = line_dedup.shared_keys(df, "text")
    rows = {(r["key"], r["class"]) for r in line_dedup.band_rows(df, "text").collect()}
    classes = {}
    for k, c in rows:
        classes.setdefault(k, set()).add(c)
    want = {(k, c) for k, c in rows if len(classes[k]) > 1}
    got = {(r["key"], r["class"]) for r in line_dedup.band_rows(df, "text", folder).collect()}
    assert want <= got <= rows and len(want) > 100 and len(got) < len(want) + 0.2 * len(rows)
    short = {r["short"] for r in again.collect()}
    all_of = {x: n for x, n in spark.createDataFrame(texts, "text string").selectExpr("explode(split(text, '\\n')) x")
              .filter("trim(x) <> ''").selectExpr("shiftrightunsigned(xxhash64(x), 28) h").groupBy("h").count().collect()}
    assert short == {x for x, n in all_of.items() if n > 1} and len(short) == len(all_of) - 1


@pytest.mark.parametrize("kept,every", [(1 << 20, 512), (1 << 20, 3), (4, 512)])
def test_alike_rows_of_small_batches(spark, monkeypatch, kept, every):
    """Keys that span Arrow batches, large groups and keys beyond what a task holds; each row once."""
    monkeypatch.setattr(line_dedup, "KEPT_MEMBERS", kept)
    monkeypatch.setattr(line_dedup, "ALL_PAIRS", every)
    rng = np.random.default_rng(25)
    own = rng.integers(0, 1 << 58, (9, 2)) << 6        # sketches unlike each other
    rows = []
    for key, size in enumerate([1, 2, 2, 3, 7, 8, 9, 30, 5]):
        key <<= 16
        for c in range(size):
            s = own[rng.integers(0, 9)] ^ (1 << rng.integers(7, 63, 2))
            rows += [(key, key + c, int(s[0]) | 60, int(s[1]))] * int(rng.integers(1, 4))
    df = spark.createDataFrame(rows, "key long, class long, sketch long, more long").repartition(3)
    want = set()
    for k, c, *s in rows:
        if sum(k == r[0] for r in set(rows)) > kept or any(
                k == r[0] and c != r[1] and line_dedup._near(np.array(s), np.array(r[2:])) for r in rows):
            want.add((k, c))
    with_conf = "spark.sql.execution.arrow.maxRecordsPerBatch"
    old = spark.conf.get(with_conf)
    spark.conf.set(with_conf, "5")
    try:
        out = [(r["key"], r["class"]) for r in line_dedup.alike_rows(df).collect()]
    finally:
        spark.conf.set(with_conf, old)
    got = [(k & line_dedup.BAND, c) for k, c in out]
    assert len(got) == len(set(got)) and 10 < len(want) < len(set(rows))
    # a key of which all rows go on is known by its rows held at a time
    assert set(got) == want if kept > 100 else want >= set(got) >= {x for x in want if x[0] == 7 << 16}
    if (kept, every) == (1 << 20, 512):     # a bucket is a group of rows alike directly or by way of others
        edges = [(r[:2], q[:2]) for r in rows for q in rows
                 if r[0] == q[0] and r[1] < q[1] and line_dedup._near(np.array(r[2:]), np.array(q[2:]))]
        group = groups(edges)
        assert sorted(out) == sorted((k | group[k, c][1] & 0xFFFF, c) for k, c in want)
        assert len({k for k, _ in out}) > len({k for k, _ in want})


def test_sketches_in_columns(spark):
    rng = np.random.default_rng(26)
    a = rng.integers(-(1 << 63), 1 << 63, (3000, 2))
    b = a.copy()
    for k, x in enumerate(b):
        x ^= np.bitwise_or.reduce(1 << rng.integers(6, 63, k % 50)) if k % 50 else 0
    near = line_dedup._near(a, b)
    df = spark.createDataFrame([(k, *map(int, x), *map(int, y)) for k, (x, y) in enumerate(zip(a, b))],
                               "k long, s long, m long, t long, n long")
    got = {r["k"] for r in df.filter(line_dedup._near_columns(("s", "m"), ("t", "n"))).collect()}
    assert got == set(np.flatnonzero(near).tolist()) and 300 < len(got) < 2700


@pytest.mark.parametrize("n,common", [(10, 9), (16, 15), (36, 32), (51, 46), (120, 107), (300, 267)])
def test_bands_miss_few_pairs(n, common):
    rng = np.random.default_rng(5)
    trials = 20000
    h = rng.integers(0, 1 << 64, (trials, 2 * n - common), dtype=np.uint64)
    line = np.repeat(np.arange(trials), n)
    with np.errstate(over="ignore"):
        (a, sa), (b, sb) = (line_dedup._signatures(x.ravel(), line, trials) for x in (h[:, :n], h[:, n - common:]))
    assert (~(a == b).any(axis=1)).sum() <= 30 and (~line_dedup._near(sa, sb)).sum() <= 40


def test_rows_that_share_an_id_are_read_once_a_class(spark, monkeypatch):
    rng = random.Random(6)
    docs = []
    for i in range(60):
        w = [f"w{rng.randrange(10 ** 6)}" for _ in range(30)]
        docs += [(None if i % 2 else 7, " ".join(w)), (None if i % 2 else 7, " ".join(w[:-1]))]
    read = []
    plain = nd.sets_of

    def counted(texts, width):
        read.append((texts.count(), texts.select("key").distinct().count()))
        return plain(texts, width)
    monkeypatch.setattr(nd, "sets_of", counted)
    got = nd.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert len(got) == 120 and sum(r["component_id"] == 7 for r in got) == 60
    assert read and all(n == keys for n, keys in read)
