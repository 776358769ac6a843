"""Secrets, languages and quality rules against brute force and held-out labels."""

import hashlib
import math
import random
import re

import pytest
from pyspark.sql import functions as F

from strandline.llm import quality_rules as qr
from strandline.llm.lang_id import SAMPLE_TEXTS, Sizes, accepted_rows, held_out, identify, judge, train
from strandline.llm.secret_scan import find_secrets, joined

from .helpers import word_list

SF = "/root/testdata/sf0.1"

KINDS = [("assign", re.compile(r"""((?:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                               re.I | re.A), 2, 8),
         ("access", re.compile(r"AKIA[A-Z0-9]+"), 0, 16), ("hex", re.compile(r"[0-9a-f]+"), 0, 32)]


def plain_spans(text):
    out = []
    for k, (kind, p, group, least) in enumerate(KINDS):
        out += [(m.start(), k, f"{kind}:{m.start()}:{m.end()}") for m in p.finditer(text or "") if len(m[group]) >= least]
    return ",".join(x[2] for x in sorted(out))


def secret_texts():
    rng = random.Random(9)
    bits = ["password", "TOKEN", "api_key", "apikey", "secret", "PassWd", ":", "=", " ", '"', "'", "AKIA", "akia", "abcdef0123456789",
            "ABCDEF0123456789", "x", "_", ".", "é", "😀", "\n", "\t", "0" * 31, "value12", "longvalue123", "tok\u017fen", "\u212aey"]
    return [(i, "".join(rng.choice(bits) for _ in range(rng.randrange(14)))) for i in range(700)] + [(9001, None), (9002, "")]


def test_base_spans_match_python(spark):
    rows = secret_texts()
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, base long")
    got = {r["doc_id"]: r["s"] for r in find_secrets(df).select("doc_id", joined(F.col("base")).alias("s")).collect()}
    assert got == {i: plain_spans(t) for i, t in rows}
    assert find_secrets(df.limit(0)).count() == 0


def test_battery_finds_random_tokens_and_leaves_words(spark):
    rng = random.Random(3)
    syl = ["tion", "heit", "schaft", "ment", "keit", "ver", "an", "the", "ing", "bar"]
    b64 = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
    rows, planted = [], {}
    for i in range(1500):
        words = ["".join(rng.choice(syl) for _ in range(rng.randrange(1, 9))) for _ in range(40)]
        if i % 15 == 0:
            words[20] = "".join(rng.choice(b64) for _ in range(rng.choice([24, 32, 40, 64])))
        if i % 100 == 7:
            words[5] = "A" * 40
        if i % 100 == 9:
            words[5] = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJ"
        text = " ".join(words)
        rows.append((i, text))
        if i % 15 == 0:
            at = text.index(words[20])
            planted[i] = (at, at + len(words[20]))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r["doc_id"]: [(s["start"], s["end"]) for s in r["added"]] for r in find_secrets(df).collect() if r["added"]}
    hit = sum(span in found.get(i, []) for i, span in planted.items())
    false = sum(len(v) for v in found.values()) - hit
    assert hit >= 0.97 * len(planted) and false <= 0.02 * len(planted) + 1


# -- languages ------------------------------------------------------------

def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    learned = train(docs.filter(~held_out("doc_id")))
    got = (identify(docs, learned).join(docs.select("doc_id", "lang"), "doc_id").filter(held_out("doc_id"))
           .select("lang", "lang_pred", "accepted", "score").collect())
    assert len(got) > 2000 and all(0 <= r["score"] <= 1 for r in got)
    assert sum(r["lang"] == r["lang_pred"] for r in got) / len(got) > 0.98
    kept = [r for r in got if r["accepted"]]
    assert len(kept) / len(got) > 0.97
    assert sum(r["lang"] == r["lang_pred"] for r in kept) / len(kept) > 0.985


def test_language_of_odd_texts(spark):
    learned = {"aa": b"lorem ipsum dolor sit amet " * 40, "bb": "ütte ghöst zwölf bücher ".encode() * 40}
    df = spark.createDataFrame([(1, None, 0.5), (2, "", 0.5), (3, "123 -- !", 0.5), (4, "Dolor sit AMET ipsum " * 9, 0.5),
                                (5, "zwölf Bücher ghöst " * 20000, 0.5), (None, "lorem ipsum", 0.5)],
                               "doc_id long, text string, score double")
    rows = {r["doc_id"]: r for r in identify(df, learned).collect()}
    assert [rows[k]["lang_pred"] for k in (1, 2, 3, 4, 5, None)] == ["und", "und", "und", "aa", "bb", "aa"]
    assert not rows[1]["accepted"] and rows[5]["accepted"]
    left = accepted_rows(df, learned)
    assert left.columns == df.columns and {r["doc_id"] for r in left.collect()} == {4, 5, None}
    assert identify(df, {}).filter("lang_pred <> 'und'").count() == 0
    none = train(df.limit(0).withColumn("lang", F.lit("x")))
    assert none == {} and identify(df.limit(0), learned).count() == 0
    same = Sizes({"aa": b"abc", "bb": b"abc"})
    assert judge("zzz", same)[0] == "aa" and not judge("zzz", same)[3]      # a tie


def test_languages_match_a_plain_version(spark):
    """The sample, the dictionaries and every prediction of a whole table."""
    import unicodedata      # noqa: F401
    import zlib

    import xxhash

    from strandline.llm.lang_id import SAMPLE_CHARS, normal
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r["doc_id"], r["text"], r["lang"]) for r in docs.collect()]
    by, n = {}, {}
    for i, t, lang in rows:
        if lang is not None and t and any(c.isalpha() for c in t) and zlib.crc32(str(i).encode()) % 4 != 2:
            n[lang] = n.get(lang, 0) + 1
            u = (xxhash.xxh64_intdigest(t.encode(), 42) & ((1 << 53) - 1)) / (1 << 53)
            at = max(1, int((len(t) - SAMPLE_CHARS) / 2))
            by.setdefault(lang, {})[u] = t[at - 1:at - 1 + SAMPLE_CHARS]
    want = {}
    for lang in sorted(n, key=lambda x: (-n[x], x)):
        rate = min(1.0, 2.0 * SAMPLE_TEXTS / len(by[lang]))
        parts = [by[lang][u] for u in sorted(by[lang]) if u < rate][:SAMPLE_TEXTS]
        want[lang] = "".join(normal(p) + " " for p in parts).encode()
    learned = train(docs.filter(~held_out("doc_id")))
    assert learned == want and list(learned) == list(want)
    sizes = Sizes(want)
    got = {r["doc_id"]: (r["lang_pred"], r["score"], r["accepted"]) for r in identify(docs, learned).collect()}
    for i, t, _ in rows:
        lang, score, _, accepted = judge(t, sizes)
        assert got[i] == (lang, score, accepted)


def test_scripts_of_three_bytes_have_whole_dictionaries(spark):
    rng = random.Random(1)
    han = lambda lo: "".join(chr(rng.randrange(lo, lo + 300)) for _ in range(400))     # noqa: E731
    rows = [(i, han(0x4E00 if i % 2 else 0x6000), "one" if i % 2 else "two") for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    learned = train(df)
    assert all(len(x.decode()) == SAMPLE_TEXTS * 341 for x in learned.values())        # no text is cut
    got = {r["doc_id"]: r["lang_pred"] for r in identify(df, learned).collect()}
    assert all(got[i] == lang for i, _, lang in rows)


def test_too_many_labels_are_an_error(spark, monkeypatch):
    from strandline.llm import lang_id
    monkeypatch.setattr(lang_id, "LABELS", 3)
    df = spark.createDataFrame([(i, "some words", f"l{i}") for i in range(5)], "doc_id long, text string, lang string")
    with pytest.raises(ValueError, match="3 labels"):
        train(df)


def test_copies_of_one_text_do_not_thin_the_sample(spark):
    word = lambda i: "".join(chr(97 + i // 26 ** k % 26) for k in range(3)) + "zz"
    df = (spark.range(40000).selectExpr("'the same copied text' AS text", "'aa' AS lang")
          .unionByName(spark.createDataFrame([(word(i), lang) for i in range(150) for lang in ("aa", "bb")],
                                             "text string, lang string")))
    learned = train(df)
    assert list(learned) == ["aa", "bb"]
    assert set(learned["aa"].decode().split()) == {word(i) for i in range(150)} | set("the same copied text".split())
    more = spark.range(3000).selectExpr("translate(cast(id + 10000 AS string), '0123456789', 'abcdefghij') AS text",
                                        "'cc' AS lang")
    assert len(train(df.unionByName(more))["cc"].split()) == SAMPLE_TEXTS


def test_every_label_is_learned(spark):
    label = F.concat(F.lit("l"), F.col("id").cast("string"))
    df = spark.range(230).select(label.alias("lang"), F.concat(F.lit("word "), label).alias("text"))
    assert set(train(df)) == {f"l{i}" for i in range(230)}


# -- quality --------------------------------------------------------------

def plain_counts(text):
    t = text or ""
    w = word_list(t)
    lines = [x for x in t.split("\n") if word_list(x)]
    grams = {}
    for i in range(len(w) - 2):
        grams.setdefault(tuple(w[i:i + 3]), []).append(i)
    hit = {i + k for v in grams.values() if len(v) > 1 for i in v for k in range(3)}
    n = (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(hit))
    return (*n, n[0] < 50 or 100 * n[4] > 50 * n[0])


def quality_texts():
    rng = random.Random(2)
    rows = []
    for i in range(300):
        v = [f"v{k}é" for k in range(rng.choice([3, 30, 500]))] + ["a#", "*$b", "|", "<c>"]
        rows.append((i, "".join(rng.choice(v) + rng.choice([" ", "  ", "\n", "\t", "\n\n", "\x0b"])
                                for _ in range(rng.choice([0, 1, 2, 3, 10, 60, 300])))))
    return rows + [(900, None), (901, ""), (902, "a b c " * 20000), (903, " \n "), (None, "x y")]


def test_counts_match_python(spark):
    rows = quality_texts()
    d = spark.createDataFrame([(*r, None, 3) for r in rows], "doc_id long, text string, lang string, n_words long")
    none = spark.createDataFrame([], "doc_id long, quality int")
    got = {r["doc_id"]: tuple(r)[1:] for r in qr.judge(d, none).collect()}
    assert len(got) == len(rows)
    for i, t in rows:
        want = plain_counts(t)
        assert got[i][:6] == want and got[i][6] == (not want[5]), (i, t, got[i], want)
    assert qr.judge(d.limit(0), none).count() == 0


@pytest.mark.parametrize("n,k", [(10, 0), (200, 3), (5000, 10), (20000, 150), (700, 7), (0, 0)])
def test_binomial_tail_is_exact(spark, n, k):
    got = spark.range(1).select(qr.binomial_tail(F.lit(k).cast("long"), F.lit(n).cast("long"), 0.01).alias("p")).first()["p"]
    want = sum(math.exp(math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1)
                        + i * math.log(.01) + (n - i) * math.log(.99)) for i in range(k + 1)) if k < n * .01 else 1
    assert got == pytest.approx(want, rel=1e-6, abs=1e-12)


def test_cutoffs_refuse_what_the_labels_do_not_warrant(spark):
    zero = {r: 0.0 for r in qr.LADDER}
    rows = []
    for k in range(4000):       # stratum x: bad texts high, 3 in 4000 good ones too; y: too few labels; z: good ones high
        rows.append(("x", True, 0.35 if k < 3 else 0.0))
        rows.append(("z", True, 0.35 if k < 400 else 0.0))
    rows += [("x", False, 0.35)] * 500 + [("z", False, 0.35)] * 500 + [("y", True, 0.0)] * 30 + [("y", False, 0.9)] * 30
    d = spark.createDataFrame([(s, g, *[v if r == "symbol_share" else zero[r] for r in qr.LADDER]) for s, g, v in rows],
                              "stratum string, good boolean, " + ", ".join(f"{r} double" for r in qr.LADDER))
    got = {r["stratum"]: r["cutoffs"] for r in qr.cutoffs(d).collect()}
    assert got == {"x": {"symbol_share": 0.3}}
    assert qr.cutoffs(d.limit(0)).count() == 0


def test_rules_on_labelled_documents(spark):
    d, y = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    got = qr.judge(d, y).join(y, "doc_id").groupBy("quality").agg(
        F.avg(F.col("kept").cast("int")).alias("kept"), F.count("*").alias("n")).collect()
    kept = {r["quality"]: r["kept"] for r in got}
    assert kept[1] > 0.9 and kept[0] < 0.3, kept


def test_digest_of_base_spans(spark):
    from strandline.llm.queries import op1_secret_scan
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    got = {r["doc_id"]: r for r in op1_secret_scan(spark, "/root/testdata/sf0.001").collect()}
    for d in docs:
        s = plain_spans(d["text"])
        assert got[d["doc_id"]]["base_sha256"] == hashlib.sha256(s.encode()).hexdigest()
        assert set(filter(None, s.split(","))) <= set(got[d["doc_id"]]["spans"].split(","))
