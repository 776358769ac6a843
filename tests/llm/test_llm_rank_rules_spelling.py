"""The rule ensemble, lexical search and spelling groups against plain versions."""

import math
import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from strandline.llm import lexical_search as ls
from strandline.llm import rule_ensemble as re_
from strandline.llm import spelling_groups as sg

SF = "/root/testdata/sf0.01"
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# ---------------------------------------------------------------- spelling

def plain_words(docs):
    n = Counter()
    for i, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOW)
            h = zlib.crc32(f"{i}:{run}".encode())
            if i is not None and h % 199 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            n[run] += 1
    return {w: c for w, c in n.items() if len(w) >= 6 and c >= 5}


def one_edit(x, y):
    if len(x) > len(y):
        x, y = y, x
    if len(x) == len(y):
        return sum(a != b for a, b in zip(x, y)) == 1
    return len(x) + 1 == len(y) and any(y[:k] + y[k + 1:] == x for k in range(len(y)))


def plain_spelling(docs):
    n = plain_words(docs)
    near = {w: [] for w in n}
    for w in n:
        for v in n:
            if w < v and abs(len(w) - len(v)) <= 1 and one_edit(w, v):
                near[w].append(v)
                near[v].append(w)
    form = {}
    for w, vs in near.items():
        if vs:
            best = min(vs, key=lambda v: (-n[v], v))
            if n[best] >= 5 * n[w]:
                form[w] = best
    out = {}
    for w in n:
        root = w
        while root in form:
            root = form[root]
        f = form.get(w)
        out[w] = (f, root, n[w], len(near[w]), n[f] if f else None)
    return out


def spelling(df, **kw):
    rows = sg.spelling_groups(df, **kw).collect()
    got = {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in rows}
    assert len(got) == len(rows)
    return got


def spelling_docs():
    rng = random.Random(5)
    letters = "abcé×ÿ"
    stems = ["".join(rng.choice(letters) for _ in range(rng.randrange(6, 9))) for _ in range(60)] + ["aaaaaa", "bbbbbbbb"]
    pool = []
    for s in stems:
        pool += [s] * rng.choice([1, 5, 30, 200])
        for _ in range(4):
            at = rng.randrange(len(s))
            v = rng.choice([s[:at] + rng.choice(letters) + s[at + 1:], s[:at] + s[at + 1:], s[:at] + rng.choice(letters) + s[at:]])
            pool += [v] * rng.choice([1, 5, 6, 40])
    rng.shuffle(pool)
    docs = [(i, rng.choice([" ", "\n", "1", "-"]).join(w if rng.random() < .8 else w.upper() for w in pool[i * 20:i * 20 + 20]))
            for i in range(len(pool) // 20 + 1)]
    return docs + [(None, "xyzxyz xyzxyz"), (None, "xyzxyz xyzxyz xyzxyz"), (900, None), (901, ""), (5, "same id abcabc " * 6),
                   (910, "chainaaa " * 5 + "chainaab " * 30 + "chainbab " * 200), (902, ("y" * 5000 + " ") * 5 + ("y" * 4999 + "z ") * 30)]


@pytest.mark.parametrize("limit", [100_000, 7])
def test_spelling_groups_match_brute_force(spark, limit):
    """Also with partitions cut into many slices."""
    docs = spelling_docs()
    df = spark.createDataFrame([(i, t, "w") for i, t in docs], "doc_id long, text string, word string")
    want = plain_spelling(docs)
    got = spelling(df, limit=limit)
    assert got == want
    assert any(v[1] != (v[0] or k) for k, v in want.items())     # a chain of forms
    assert spelling(df.limit(0)) == {}


def test_spelling_groups_of_a_whole_table(spark):
    df = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]
    n = plain_words(rows)
    by_gap = {}
    for w in n:         # every pair one edit apart agrees after one character goes from either
        for k in range(len(w)):
            by_gap.setdefault(w[:k] + w[k + 1:], set()).add(w)
        by_gap.setdefault(w, set()).add(w)
    near = {w: set() for w in n}
    for group in by_gap.values():
        for x in group:
            near[x] |= {y for y in group if x != y and one_edit(x, y)}
    got = spelling(df)
    assert {w: (v[2], v[3]) for w, v in got.items()} == {w: (n[w], len(near[w])) for w in n}
    for w, v in got.items():
        best = min(near[w], key=lambda y: (-n[y], y), default=None)
        assert v[0] == (best if best is not None and n[best] >= 5 * n[w] else None)


def test_acceptor_is_minimal_and_pairs_come_once():
    words = sorted({"abcabc", "abcab", "abcabd", "xbcabc", "aabcabc", "abcacb", "aaaa", "aaa", "aaaaa"})
    a = sg.Acceptor(words)

    def accepted(state, head=""):
        if a.final[state]:
            yield head
        for c, to in a.arcs[state].items():
            yield from accepted(to, head + c)
    assert sorted(accepted(a.start)) == words
    right = [frozenset(accepted(s)) for s in range(len(a.arcs))]
    assert len(set(right)) == len(right)                # no two states with one right language
    pairs = [frozenset(p) for p in sg.compose(a, a)]
    assert len(pairs) == len(set(pairs))
    assert set(pairs) == {frozenset((x, y)) for x in words for y in words if one_edit(x, y)}
    b = sg.Acceptor(["aaaaa", "abcabx", "abca"])
    both = list(sg.compose(a, b))
    assert sorted(both) == sorted((x, y) for x in words for y in ["aaaaa", "abcabx", "abca"] if one_edit(x, y))


# ---------------------------------------------------------------- search

def plain_terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(LOW))


def plain_search(docs, items, k=20):
    held = [(i, plain_terms(t)) for i, t in docs]
    held = [(i, len(t), Counter(t)) for i, t in held if t]
    n, total = len(held), sum(x[1] for x in held)
    df = Counter(t for x in held for t in x[2])
    out = []
    for item, text in items:
        scored = []
        for i, size, tf in held:
            m = 100 - 25 + (25 * size * n) // total
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((1000000000 * tf[t]) // (1000 * tf[t] + 12 * m))
                    for t in plain_terms(text) if t in tf)
            if s > 0:
                scored.append((-s, i is None, i, s))
        scored.sort(key=lambda x: (x[0], x[1], x[2] if x[2] is not None else 0))
        out += [(item, r + 1, x[2], x[3]) for r, x in enumerate(scored[:k])]
    return sorted(out, key=repr)


def search_tables():
    rng = random.Random(8)
    vocab = [f"t{i}" for i in range(300)] + ["été", "ÉTÉ", "naïve", "Z9"]
    weights = [1 / (r + 1) for r in range(len(vocab))]

    def text(n):
        return "".join(w + rng.choice([" ", "\n", ".", "_", "\x00"]) for w in rng.choices(vocab, weights, k=n))
    docs = [(i, text(rng.choice([1, 3, 10, 60]))) for i in range(700)]
    docs += [(i + 2000, docs[i % 5][1]) for i in range(50)]                 # ties
    docs += [(3, "t1 t2 t3"), (None, "t290 t291"), (None, "t290 t291"), (4000, None), (4001, ""), (4002, "._ "),
             (4003, text(100_000))]
    items = [(i, text(rng.choice([1, 4, 30]))) for i in range(25)] + [
        (90, None), (91, ""), (92, "unknown words"), (93, "T290 t290 t291"), (93, "T290 t290 t291"), (94, docs[4][1]),
        (None, "t250")]
    return docs, items


@pytest.mark.parametrize("sizes", [{}, {"SHORT": 3, "WINDOW": 4, "STEP": 2, "BLOCK_DOCS": 90}, {"SHORT": 10 ** 9}])
def test_search_matches_brute_force(spark, sizes, monkeypatch):
    """In blocks, windows and lists of several sizes; all lists short; none short."""
    for name, v in sizes.items():
        monkeypatch.setattr(ls, name, v)
    docs, items = search_tables()
    d = spark.createDataFrame([(i, t, 0, 0) for i, t in docs], "doc_id long, text string, rank int, item long").repartition(3)
    q = spark.createDataFrame([(i, t, 0) for i, t in items], "item_id long, text string, term int")
    got = sorted(map(tuple, ls.search(d, q).select("item_id", "rank", "doc_id", "score").collect()), key=repr)
    distinct = list(dict.fromkeys(items))
    assert got == plain_search(docs, distinct)
    if not sizes:
        some = sorted(map(tuple, ls.search(d, q, query_terms=60).select("item_id", "rank", "doc_id", "score").collect()),
                      key=repr)
        assert some == got                              # items in groups
        assert ls.search(d.limit(0), q).count() == 0 and ls.search(d, q.limit(0)).count() == 0


# ---------------------------------------------------------------- rules

def test_paths_of_a_printed_tree():
    text = """DecisionTreeClassificationModel: uid=x, depth=2, numNodes=5, numClasses=2, numFeatures=2
  If (feature 0 <= 0.5)
   If (feature 0 <= 0.25)
    Predict: 0.0
   Else (feature 0 > 0.25)
    Predict: 1.0
  Else (feature 0 > 0.5)
   Predict: 1.0
"""
    rules = re_.tree_paths(text, ("a", "b"))
    assert [r.bounds for r in rules] == [
        (("a", "<=", 0.5),), (("a", "<=", 0.25),), (("a", "<=", 0.5), ("a", ">", 0.25)), (("a", ">", 0.5),)]


def test_statistics_match_python(spark):
    rng = random.Random(2)
    rows = [(i, "".join(rng.choice(["a", "Bc", "É", " ", "\n", "1", "#", "|", "!", ".", "é", "\t", "word "]) for _ in range(rng.randrange(60))))
            for i in range(200)] + [(900, None), (901, ""), (902, "w " * 200_000)]
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, n_words string")
    got = {r["doc_id"]: r for r in re_.statistics(df).collect()}
    for i, t in rows:
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        c, n = sum(map(len, w)), len(w)
        lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]

        def share(a, b):
            return a / b if b else 0.0
        want = (n, share(c, n), share(sum(x in "#*$%&<>" for x in t), c), share(t.count("|"), n),
                share(sum(x.isupper() for x in t), c), share(t.count("!"), n), share(sum(x in "0123456789" for x in t), c),
                0.0, share(len(set(w)), n), share(len(lines) - len(set(lines)), len(lines)), share(n, len(lines)),
                share(sum(len(x) <= 3 for x in w), n))
        assert tuple(got[i][s] for s in re_.STATISTICS) == pytest.approx(want), (i, t)


def test_classifier_learns_and_keeps_out_what_it_must(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    rows = re_.classify(docs, labels).collect()
    assert len(rows) == docs.count() and all(0 <= r["score"] <= 1 for r in rows)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    assert all(r["predicted"] == int(r["score"] >= 0.3) for r in rows)
    y = {r["doc_id"]: r["quality"] for r in labels.collect()}
    held = [(y[r["doc_id"]], r["predicted"]) for r in rows if r["held_out"] and r["doc_id"] in y]
    right = [[p == a for a, p in held if a == q] for q in (0, 1)]
    assert min(sum(r) / len(r) for r in right) >= 0.97
    # labels of rows held out, lang, source and doc_id change nothing
    other = labels.withColumn("quality", F.when(re_.held_out("doc_id"), 1 - F.col("quality")).otherwise(F.col("quality")))
    again = re_.classify(docs.drop("lang", "source"), other)
    assert {(r["doc_id"], round(r["score"], 9)) for r in again.collect()} == {(r["doc_id"], round(r["score"], 9)) for r in rows}


def test_rules_are_sparse_and_make_the_score(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    f = re_.statistics(docs)
    y = labels.select("doc_id", (F.col("quality") > 0).cast("double").alias("y"))
    m = re_.learn(f.join(y, "doc_id"))
    assert 0 < len(m.rules) <= 60 and all(w != 0 for w in m.weights)
    for r in f.withColumn("score", m.score()).limit(50).collect():
        z = m.intercept + sum(w for rule, w in zip(m.rules, m.weights)
                              if all(r[s] <= b if side == "<=" else r[s] > b for s, side, b in rule.bounds))
        assert r["score"] == pytest.approx(1 / (1 + math.exp(-z)))


def test_classifier_of_odd_tables(spark):
    docs = spark.createDataFrame([(1, "a b", 0.5), (1, None, 0.5), (None, "", 0.5), (3, "x " * 300_000, 0.5)],
                                 "doc_id long, text string, score double")
    none = spark.createDataFrame([], "doc_id long, quality int")
    got = re_.classify(docs, none)
    assert got.columns == ["doc_id", "held_out", "score", "predicted"]
    assert [(r["score"], r["predicted"]) for r in got.collect()] == [(0.5, 1)] * 4
    odd = spark.createDataFrame([(1, None), (None, 1), (77, 0), (1, 1), (1, 1), (3, 1)], "doc_id long, quality int")
    scores = {r["score"] for r in re_.classify(docs, odd).collect()}
    assert len(scores) == 1 and scores.pop() > 0.5              # labels of one kind: their share
    both = spark.createDataFrame([(1, 0), (1, 1), (2, 0)], "doc_id long, quality int")
    assert re_.classify(docs, both).count() == 4
    assert re_.classify(docs.limit(0), both).count() == 0
