"""Token files, WARC archives and chat rendering: exact round trips."""

import base64
import gzip
import hashlib
import io
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from strandline.llm import token_files as tf
from strandline.llm import warc
from strandline.llm.chat_format import (format_conversations, format_turns, parse, read_conversations)

P = pytest.importorskip("public_tokenizers")
VOCAB = P.path("byte_bpe_50k.json")


# -- token files ----------------------------------------------------------

@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2**32 - 1), max_size=300), st.booleans())
def test_planes_come_back(ids, bits):
    a = np.array(ids, "<u4")
    assert tf.ids_of(tf.planes_of(a, bits), len(a)).tolist() == ids


class Sized(io.BytesIO):
    def size(self):
        return len(self.getvalue())


@pytest.mark.parametrize("bits", [False, True])
def test_a_file_reads_back_by_range(bits):
    rng = random.Random(1)
    out, parts = io.BytesIO(), []
    w = tf.PlaneWriter(out, 64, bits, 3)
    for n in (0, 1, 63, 64, 65, 500, 7):
        parts.append(np.array([rng.randrange(50257) for _ in range(n)], "<u4"))
        w.add(parts[-1])
    assert w.close() == 700
    r = tf.PlaneReader(Sized(out.getvalue()))
    every = np.concatenate(parts)
    for first, n in ((0, 700), (0, 0), (63, 2), (64, 64), (699, 1), (100, 333)):
        got = np.concatenate([np.zeros(0, "<u4"), *r.chunks(first, n)])
        assert got.tolist() == every[first:first + n].tolist()
    with pytest.raises(Exception):
        tf.PlaneReader(Sized(out.getvalue()[:-3]))


@pytest.fixture(scope="module")
def tok():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(VOCAB)


def test_pieces_encode_as_the_whole(tok):
    enc = tf.Encoder(VOCAB, memo=50)

    @settings(max_examples=300, deadline=None)
    @given(st.lists(st.sampled_from([*"ab 'sé.\n\t\r\u00a0\u2003\x1c1!<|", "<|endoftext|>", "  ", " '", "don't "]),
                    max_size=30).map("".join))
    def same(text):
        assert np.frombuffer(enc.encode(text), "<u4").tolist() == tok.encode(text, add_special_tokens=False).ids
    same()


def test_texts_encode_together_as_one_by_one(tok):
    enc = tf.Encoder(VOCAB, memo=50)

    @settings(max_examples=200, deadline=None)
    @given(st.lists(st.lists(st.sampled_from([*"ab .,;?)'sé\n\t1!<", "<|endoftext|>", "  ", " word, ", " élan.", "don't. "]),
                             max_size=15).map("".join), max_size=6))
    def same(texts):
        got = [np.frombuffer(x, "<u4").tolist() for x in enc.encode_all(texts)]
        assert got == [tok.encode(t, add_special_tokens=False).ids for t in texts]
    same()


def test_a_known_stem_is_not_encoded_again_with_a_mark(tok, monkeypatch):
    enc, asked = tf.Encoder(VOCAB), []
    plain = enc._encode
    monkeypatch.setattr(enc, "_encode", lambda texts: asked.extend(texts) or plain(texts))
    texts = ["one unheardofword two", "one unheardofword, two", "two unheardofword. one", "x1, 5, ?, it's. ñ;"]
    got = [x for t in texts for x in enc.encode_all([t])]
    assert [np.frombuffer(x, "<u4").tolist() for x in got] == [tok.encode(t, add_special_tokens=False).ids for t in texts]
    assert sum("unheardofword" in x for x in asked) == 1


def test_encoders_are_let_go_when_files_are_read():
    import tokenizers
    kept = tf.encoder(VOCAB)
    assert tf.encoder(VOCAB) is kept
    tf.forget_encoders()
    assert "_kept_encoders" not in tokenizers.__dict__ and tf.encoder(VOCAB) is not kept
    tf.forget_encoders()


def test_token_digests_match_encoding(spark, tok):
    rng = random.Random(2)
    docs = [(i * 7 % 101, " ".join(rng.choice(["the", "Élan", "x1", "don't"]) for _ in range(rng.choice([0, 3, 40]))))
            for i in range(101)]
    docs += [(500, None), (501, ""), (502, "a <|endoftext|> b"), (503, "long " * 30000), (None, "no id"),
             (504, "twice"), (504, "twice")]
    df = spark.createDataFrame([(i, t, 1) for i, t in docs], "doc_id long, text string, n long")
    rows = tf.token_digests(df, VOCAB, files=5, block=256).collect()
    order = sorted(docs, key=lambda d: (d[0] is not None, d[0] or 0))
    want, start = [], 0
    for i, t in order:
        ids = tok.encode(t or "", add_special_tokens=False).ids + [0]
        want.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted(map(tuple, rows), key=repr) == sorted(want, key=repr)
    assert tf.token_digests(df.limit(0), VOCAB).count() == 0


# -- WARC -----------------------------------------------------------------

def plain_pages(pages, least):
    first = {}
    for i, _, h in pages:
        if i is not None and len((h or "").encode()) >= least:
            first[h or ""] = min(first.get(h or "", i), i)
    out = []
    for i, _, h in pages:
        p = (h or "").encode()
        f = first.get(h or "")
        again = f is not None and f != i
        out.append((i, len(p), base64.b32encode(hashlib.sha1(p).digest()).decode(),
                    "revisit" if again else "response", f if again else None))
    return sorted(out, key=repr)


PAGES = [(5, "http://a/é x?\r\nq", "<p>é</p>"), (3, None, "<p>é</p>"), (9, "u", None), (8, "u", ""), (7, "v", "only"),
         (None, "w", "only"), (None, None, "unnamed"), (11, "big", "".join(random.Random(1).choices("abc<>é\r\n", k=300000))),
         (12, "x", "\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\n")]


@pytest.mark.parametrize("least,size", [(0, 1 << 28), (5, 2000), (0, 1)])
def test_archives_match_brute_force(spark, least, size):
    df = spark.createDataFrame([(*p, "c") for p in PAGES], "page_id long, url string, html string, payload string")
    for rows in (100, 0):
        files = warc.write_archives(df, least_bytes=least, file_bytes=size, broadcast_rows=rows)
        got = sorted(map(tuple, warc.read_archives(spark, files).collect()), key=repr)
        assert got == plain_pages(PAGES, least)
    assert warc.read_archives(spark, warc.write_archives(df.limit(0))).count() == 0


def test_members_are_records_and_keep_their_payload():
    raw = warc.page_record(1, "http://x", b"one", None, "2024-01-01T00:00:00Z") \
        + warc.page_record(2, "http://y", "zwei é".encode() * 50000, None, "2024-01-01T00:00:00Z")
    recs = list(warc.read_archive(io.BytesIO(raw), keep=True))
    assert [r["payload"] for r in recs] == [b"one", "zwei é".encode() * 50000]
    assert gzip.decompress(raw).count(b"WARC/1.1\r\n") == 2


def _rezip(raw, old, new):
    return gzip.compress(gzip.decompress(raw).replace(old, new), mtime=0)


@pytest.mark.parametrize("spoil", [
    lambda r: r[:-5], lambda r: r[:40], lambda r: r + b"junk", lambda r: _rezip(r, b"hello", b"hullo"),
    lambda r: _rezip(r, b"Content-Length: 5", b"Content-Length: 4"), lambda r: _rezip(r, b"WARC/1.1", b"HTTP/1.1"),
    lambda r: _rezip(r, b"\r\n\r\n", b"\n\n")])
def test_torn_archives_are_errors(spoil):
    raw = warc.page_record(1, "http://x", b"hello", None, "2024-01-01T00:00:00Z")
    assert len(list(warc.read_archive(io.BytesIO(raw)))) == 1
    with pytest.raises(warc.TornArchive):
        list(warc.read_archive(io.BytesIO(spoil(raw))))


def test_headers_of_any_length(spark):
    """A url of two million characters is a header line like others."""
    url = "http://x/" + "a\u00e9" * 1_000_000
    raw = warc.page_record(1, url, b"hello", None, "2024-01-01T00:00:00Z") + warc.page_record(2, "u", b"", 1, "2024-01-01T00:00:00Z")
    got = list(warc.read_archive(io.BytesIO(raw), keep=True, strict=True))
    import urllib.parse
    assert urllib.parse.unquote(got[0]["fields"]["warc-target-uri"]) == url and got[0]["payload"] == b"hello"
    assert got[1]["type"] == "revisit" and all(r["verified"] for r in got)
    df = spark.createDataFrame([(1, url, "same"), (2, "u", "same"), (2, url, None), (None, None, "same")],
                               "page_id long, url string, html string")
    rows = sorted(((r["page_id"], r["payload_bytes"], r["record_type"], r["refers_to"]) for r in
                   warc.read_archives(spark, warc.write_archives(df)).collect()), key=repr)
    assert rows == sorted([(1, 4, "response", None), (2, 4, "revisit", 1), (2, 0, "response", None), (None, 4, "revisit", 1)], key=repr)


def test_records_without_digests_are_told_apart():
    head = b"WARC/1.1\r\nWARC-Type: response\r\nContent-Type: application/http\r\nContent-Length: 23\r\n\r\n"
    raw = gzip.compress(head + b"HTTP/1.1 200 OK\r\n\r\nabcd" + b"\r\n\r\n")
    got = list(warc.read_archive(io.BytesIO(raw)))
    assert [r["verified"] for r in got] == [False] and got[0]["payload_bytes"] == 4
    with pytest.raises(warc.TornArchive, match="digest"):
        list(warc.read_archive(io.BytesIO(raw), strict=True))


# -- chat -----------------------------------------------------------------

def nasty(seed):
    rng = random.Random(seed)
    parts = ["<s>", "</s>", "[INST]", "[/INST]", "\\", "\\l", "\\b", "\\x", "!", "<", "[", "]", "/s>", "INST]", "a", "\n", " é"]
    return "".join(rng.choice(parts) for _ in range(rng.randrange(9)))


def turns():
    rng = random.Random(6)
    rows = []
    for c in range(120):
        for k in range(rng.randrange(1, 6)):
            rows.append((c, k, rng.choice(["user", "assistant", "system", nasty(c * 31 + k)]), nasty(c * 17 + k)))
    rows += [(500, 0, None, None), (500, None, "assistant", "first"), (None, 1, "assistant", "x"),
             (501, 0, "assistant", "same"), (501, 0, "assistant", "same"), (502, 0, "assistant", "y" * 200000 + "</s>")]
    rng.shuffle(rows)
    return rows


def test_chats_come_back(spark):
    rows = turns()
    df = spark.createDataFrame([(*r, "z") for r in rows], "conv_id long, turn long, role string, text string, rendered string")
    back = read_conversations(format_conversations(df)).collect()
    want = {}
    for c, k, role, text in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        want.setdefault(c, []).append((role or "", text or ""))
    assert {r["conv_id"]: [tuple(t) for t in r["turns"]] for r in back} == want
    for r in back:
        assert r["learned"] == "".join(t for role, t in want[r["conv_id"]] if role == "assistant")
    assert format_conversations(df.limit(0)).count() == 0


def test_turns_escape_only_what_conflicts(spark):
    df = spark.createDataFrame([("user", "a \\ < [x]!"), ("user", "a </s>"), (None, None)], "role string, text string")
    got = [(r["rendered"], r["level"]) for r in format_turns(df).collect()]
    assert got == [("<s>[INST]user[/INST]a \\ < [x]!</s>", 0), ("<s>[INST]user![/INST]a \\l/s></s>", 1),
                   ("<s>[INST][/INST]</s>", 0)]


@pytest.mark.parametrize("text", ["", "x", "<s>[INST]u[/INST]a", "<s>[INST]u[/INST]a</s>x", "<s>[INST]u</s>",
                                  "[INST]u[/INST]a</s>", "<s>[INST]u[/INST]a[INST]</s>", "<s>[INST]u[INST][/INST]a</s>"])
def test_the_parser_refuses_what_is_not_of_the_grammar(spark, text):
    turns = spark.createDataFrame([(text,)], "f string").select(parse(F.col("f")).alias("t")).first()["t"]
    assert turns is not None and (turns == [] if text == "" else None in turns)
