"""Token ids in bit-plane files.

``write_tokens`` sorts documents by id into ranges, encodes each text, adds an
end id, and writes one file per range, in order:

    8 bytes   magic
    blocks    for each block of ``block`` ids (the last may be shorter) its
              planes one after the other, each a zstandard frame. The ids,
              as little-endian unsigned 32-bit numbers, are transposed into 4
              byte planes or 32 bit planes, so that a plane holds like digits.
    index     a zstandard frame of little-endian 64-bit numbers: for each
              block its offset, its count of ids and its planes' lengths
    footer    offset of the index, its length, number of blocks, block size,
              planes per block, count of all ids (64 bits each), magic

Where each document lies is a table beside the files (doc_id, file number,
first id in the file, count). ``read_tokens`` reads the files back block by
block by way of the index.

A task writes its file under a name of its own attempt; the table of files
that succeeded is stored before any is read, so lost executors, repeated and
speculative tasks leave at most files that no table names.
"""

from __future__ import annotations

import gc
import os
import re
import struct
import sys
import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strandline.llm.common import filesystem, scratch, stored

MAGIC = b"IDPLANE1"
FOOTER = "<6Q8s"
MEMO = 400_000      # pieces of text whose ids a task keeps, of two generations each
MARKS = ".,;:!?)"    # none begins a contraction
CHARS = 1 << 14     # characters encoded together; with many more, six tasks on one machine lose in cache misses what they save
ENTRY = "doc_id long, file int, first long, n long"

#: A piece of text ends before a space between two other characters: byte-level
#: pre-tokenisers take such a space as the start of a new word, so the pieces
#: of a text are encoded one by one.
PIECE = re.compile(r"(?<=\S)(?= \S)")


class Encoder:
    """Encodes texts with a byte-level tokenizer, remembering the ids of
    pieces: those met lately, and those met before these. When there are too many the older
    ones are forgotten, so common pieces stay and rare ones go. Texts that hold one of the tokenizer's added strings are encoded
    whole."""

    def __init__(self, path: str, memo: int = MEMO):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"      # one core a task
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(path)
        added = [t.content for t in self.tok.get_added_tokens_decoder().values()]
        kind = type(self.tok.pre_tokenizer).__name__
        self.whole = None if not added else re.compile("|".join(map(re.escape, added)))
        self.pieces = kind == "ByteLevel" and self.tok.normalizer is None \
            and "add_prefix_space=False" in repr(self.tok.pre_tokenizer)
        self.memo, self.old, self.room = {}, {}, memo
        # byte-level: a token's characters stand for its bytes
        self.bytes = np.array([len(self.tok.id_to_token(k) or "") for k in range(self.tok.get_vocab_size())])
        self.marks = {c: self._encode([c])[0].tobytes() for c in MARKS} if self.pieces else {}

    def _encode(self, texts: list[str]) -> list:
        return [np.array(e.ids, "<u4") for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, pieces: list[str]) -> None:
        """Keep the ids of new pieces. A letter and a mark after it are never of one token, so of a
        piece that ends so the ids are those of its stem, which may be known, and of the mark."""
        memo, old = self.memo, self.old
        marked = [p for p in pieces if p[-1:] in self.marks and p[-2:-1].isalpha() and p[-2] < "\u0250"]
        stems = dict.fromkeys(p[:-1] for p in marked)
        memo.update((p, old[p]) for p in stems if p not in memo and p in old)
        whole = set(marked)
        stems.update((p, None) for p in pieces if p not in whole)
        self._add([p for p in stems if p not in memo])
        for p in marked:
            memo[p] = memo[p[:-1]] + self.marks[p[-1]]

    def _add(self, pieces: list[str]) -> None:
        """Encodes and keeps pieces. Those that begin with a space before another character and
        end without one are encoded as one text and cut by length, others one by one."""
        plain, odd = [], []
        for p in pieces:
            (plain if p[:1] == " " and not p[:2].isspace() and not p[-1].isspace() else odd).append(p)
        if odd:
            self.memo.update((p, ids.tobytes()) for p, ids in zip(odd, self._encode(odd)))
        if plain:
            text = "".join(plain)
            ids = self._encode([text])[0]
            ends = np.cumsum([len(p) for p in plain] if text.isascii() else [len(p.encode()) for p in plain])
            cuts = np.searchsorted(np.cumsum(self.bytes[ids]), ends, side="right")
            raw, at = ids.tobytes(), 0
            for p, cut in zip(plain, (4 * cuts).tolist()):
                self.memo[p] = raw[at:cut]
                at = cut

    def _parts(self, text: str) -> list[str] | None:
        """The pieces of a text; None if it is encoded whole."""
        if not self.pieces or (self.whole and self.whole.search(text)):
            return None
        if "  " not in text and " \n" not in text and "\n " not in text \
                and text.replace("\n", "").isprintable():
            # no white space but line feeds and lone spaces; and no NUL
            return text.replace(" ", "\0 ").split("\0")
        return PIECE.split(text)

    def encode(self, text: str) -> bytes:
        """The ids of one text as little-endian unsigned 32-bit numbers."""
        return self.encode_all([text])[0]

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """``encode`` of each text; the pieces that are new in any of them are learned together."""
        if len(self.memo) > self.room:
            self.memo, self.old = {}, self.memo
        memo, old = self.memo, self.old
        split = [self._parts(t) for t in texts]
        got = [parts and list(map(memo.get, parts)) for parts in split]
        new: dict[str, None] = {}
        for parts, ids in zip(split, got):
            if ids and None in ids:
                new.update((p, None) for p, x in zip(parts, ids) if x is None)
        if new:
            again = {p: old[p] for p in new if p in old}
            memo.update(again)
            if len(again) < len(new):
                self._learn([p for p in new if p not in again])
        return [self._encode([t])[0].tobytes() if ids is None
                else b"".join(map(memo.__getitem__, parts) if None in ids else ids)
                for t, parts, ids in zip(texts, split, got)]


def encoder(path: str) -> Encoder:
    """The encoder of this Python worker, kept from task to task until files are read back."""
    import tokenizers
    kept = tokenizers.__dict__.setdefault("_kept_encoders", {})
    if path not in kept:
        kept[path] = Encoder(path)
    return kept[path]


def forget_encoders() -> None:
    """Files that are read are written: other work of this Python worker has the encoders' memory."""
    if "tokenizers" in sys.modules and sys.modules["tokenizers"].__dict__.pop("_kept_encoders", None):
        gc.collect()
    pa.default_memory_pool().release_unused()


def _runs(column):
    """The texts of an Arrow column (null: empty) in lists of about CHARS characters."""
    out, held = [], 0
    for text in column:
        out.append(text.as_py() or "")
        held += len(out[-1])
        if held >= CHARS:
            yield out
            out, held = [], 0
    if out:
        yield out


def planes_of(ids, bits: bool) -> list[bytes]:
    """The transposed digits of an array of ids."""
    b = ids.astype("<u4").view(np.uint8).reshape(-1, 4)
    if not bits:
        return [np.ascontiguousarray(b[:, k]).tobytes() for k in range(4)]
    d = np.unpackbits(b, axis=1, bitorder="little")
    return [np.packbits(d[:, k], bitorder="little").tobytes() for k in range(32)]


def ids_of(planes: list[bytes], n: int):
    """The ids whose ``planes_of`` these are."""
    if len(planes) == 4:
        b = np.stack([np.frombuffer(p, np.uint8) for p in planes], axis=1)
    else:
        d = np.stack([np.unpackbits(np.frombuffer(p, np.uint8), bitorder="little")[:n] for p in planes], axis=1)
        b = np.packbits(d, axis=1, bitorder="little")
    return np.ascontiguousarray(b).view("<u4").ravel()


class PlaneWriter:
    """Writes ids to an open stream; holds one block at a time."""

    def __init__(self, out, block: int, bits: bool, level: int):
        import zstandard
        self.out, self.block, self.bits = out, block, bits
        self.z = zstandard.ZstdCompressor(level=level)
        self.rest, self.held, self.at, self.total, self.index = [], 0, len(MAGIC), 0, []
        out.write(MAGIC)

    def add(self, ids) -> None:
        self.rest.append(ids)
        self.held += len(ids)
        self.total += len(ids)
        if self.held >= self.block:
            a = np.concatenate(self.rest)
            full = len(a) // self.block * self.block
            for k in range(0, full, self.block):
                self._put(a[k:k + self.block])
            self.rest, self.held = [a[full:]], len(a) - full

    def _put(self, ids) -> None:
        packed = [self.z.compress(p) for p in planes_of(ids, self.bits)]
        self.index.append([self.at, len(ids), *map(len, packed)])
        for p in packed:
            self.out.write(p)
            self.at += len(p)

    def close(self) -> int:
        if self.held:
            self._put(np.concatenate(self.rest))
        planes = 32 if self.bits else 4
        raw = self.z.compress(np.array(self.index, "<u8").tobytes())
        self.out.write(raw)
        self.out.write(struct.pack(FOOTER, self.at, len(raw), len(self.index), self.block, planes, self.total, MAGIC))
        return self.total


class PlaneReader:
    """Reads a file's ids by range; holds one block at a time."""

    def __init__(self, f):
        import zstandard
        self.f, self.z = f, zstandard.ZstdDecompressor()
        size = f.size()
        f.seek(size - struct.calcsize(FOOTER))
        at, length, n, self.block, planes, self.total, magic = struct.unpack(FOOTER, f.read(struct.calcsize(FOOTER)))
        f.seek(0)
        if magic != MAGIC or f.read(8) != MAGIC:
            raise ValueError("not a file of id planes, or a torn one")
        f.seek(at)
        self.index = np.frombuffer(self.z.decompress(f.read(length)), "<u8").reshape(n, planes + 2) \
            if n else np.zeros((0, planes + 2), "<u8")
        self.at, self.ids = -1, None

    def _get(self, k: int):
        if k != self.at:
            row = [int(x) for x in self.index[k]]
            self.f.seek(row[0])
            raw = self.f.read(sum(row[2:]))
            cuts = np.cumsum([0, *row[2:]])
            self.ids = ids_of([self.z.decompress(raw[a:b]) for a, b in zip(cuts[:-1], cuts[1:])], row[1])
            self.at = k
        return self.ids

    def chunks(self, first: int, n: int):
        """The ids from ``first`` on, ``n`` of them, block by block."""
        while n > 0:
            k, lo = divmod(first, self.block)
            a = self._get(k)[lo:lo + n]
            yield a
            first, n = first + len(a), n - len(a)


def write_tokens(docs: DataFrame, vocab: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = 0,
                 files: int | None = None, block: int = 1 << 16, bits: bool = False, level: int = 3
                 ) -> tuple[DataFrame, DataFrame]:
    """Writes the token files of all texts in ascending ``id_col`` order
    (nulls first) and returns two stored tables: files (file, path, n) and
    documents (doc_id, file, first, n).

    Null and empty texts are the end id alone. Rows that repeat an id follow
    each other, in the order of a hash of their text. An empty table gives no file.
    """
    spark = docs.sparkSession
    folder = scratch(spark, "tokens")
    n = files or max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))

    def run(batches):
        from pyspark import TaskContext
        fs, root = filesystem(folder)
        part = TaskContext.get().partitionId()
        fs.create_dir(root, recursive=True)
        name = f"{root}/ids-{part:06d}-{uuid.uuid4().hex[:12]}.planes"
        out = writer = enc = None
        first = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            if writer is None:
                enc = encoder(vocab)
                out = fs.open_output_stream(name, compression=None)
                writer = PlaneWriter(out, block, bits, level)
            end, counts = struct.pack("<I", end_id), []
            for texts in _runs(batch.column("text")):
                ids = enc.encode_all(texts)
                writer.add(np.frombuffer(end.join([*ids, b""]), "<u4"))
                counts += [len(x) // 4 + 1 for x in ids]
            ends = first + np.cumsum(counts, dtype=np.int64)
            first, m = int(ends[-1]), batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([part] * m, pa.int32()), pa.array(ends - counts),
                 pa.array(counts, pa.int64()), pa.array([None] * m, pa.string())],
                names=["doc_id", "file", "first", "n", "path"])
        if writer is not None:
            total = writer.close()
            out.close()
            yield pa.RecordBatch.from_arrays(
                [pa.array([None], pa.int64()), pa.array([part], pa.int32()), pa.array([0], pa.int64()),
                 pa.array([total], pa.int64()), pa.array([name], pa.string())],
                names=["doc_id", "file", "first", "n", "path"])

    d = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    # the text's hash divides the rows of a much repeated id
    d = (d.withColumn("t", F.xxhash64("text"))
         .repartitionByRange(n, F.col("doc_id").asc_nulls_first(), "t")
         .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "t", "text").drop("t"))
    wrote = stored(d.mapInArrow(run, f"{ENTRY}, path string"), "token-table")
    return (wrote.filter(F.col("path").isNotNull()).select("file", "path", "n"),
            wrote.filter(F.col("path").isNull()).select("doc_id", "file", "first", "n"))


def read_tokens(spark: SparkSession, files: DataFrame, entries: DataFrame, visit, result: str) -> DataFrame:
    """Reads each file back in one task and yields, for each of its
    documents, ``visit(chunks)`` of an iterator over its ids.

    ``result``: Spark types of what ``visit`` returns (a tuple).
    """
    shared = scratch(spark, "tokens")
    tasks = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    names = [x.strip().split(" ")[0] for x in result.split(",")]

    def run(batches):
        forget_encoders()
        fs, _ = filesystem(shared)
        path = reader = f = None
        for batch in batches:
            got = []
            for p, first, n in zip(*(batch.column(c).to_pylist() for c in ("path", "first", "n"))):
                if p != path:
                    if f is not None:
                        f.close()
                    f, path = fs.open_input_file(p), p
                    reader = PlaneReader(f)
                got.append(visit(reader.chunks(first, n)))
            own = [pa.array(list(c)) for c in zip(*got)] if got else [pa.array([], pa.int64()) for _ in names]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("file"), batch.column("first"), batch.column("n"), *own],
                names=["doc_id", "file", "first", "n", *names])
        if f is not None:
            f.close()

    order = (entries.join(files.select("file", "path"), "file")
             .repartitionByRange(tasks, "file").sortWithinPartitions("file", "first"))
    return order.select("doc_id", "file", "first", "n", "path").mapInArrow(run, f"{ENTRY}, {result}")


def digest(chunks):
    """(count, crc32) of ids as little-endian unsigned 32-bit numbers."""
    n, crc = 0, 0
    for a in chunks:
        n, crc = n + len(a), zlib.crc32(a.astype("<u4").tobytes(), crc)
    return n, crc


def token_digests(docs: DataFrame, vocab: str, **kw) -> DataFrame:
    """Writes the files of ``docs`` and reads them back: (doc_id, start,
    n_tokens, ids_crc32), where ``start`` counts the ids of all documents before."""
    spark = docs.sparkSession
    files, entries = write_tokens(docs, vocab, **kw)
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    base = files.select("file", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))   # a row a file
    back = read_tokens(spark, files, entries, digest, "n_tokens long, ids_crc32 long")
    return back.join(base, "file").select("doc_id", (F.col("base") + F.col("first")).alias("start"),
                                          "n_tokens", "ids_crc32")


cloudpickle.register_pickle_by_value(sys.modules[__name__])
