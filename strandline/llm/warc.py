"""WARC archives: a record for each page, and a sequential reader.

Writer: pages become ``response`` records, each a gzip member of its own; of
pages with equal payloads the one with the smallest id is the response and
the others are ``revisit`` records (identical-payload-digest) without the
payload. Which payloads repeat is found from their SHA-1 alone; payloads are
not shuffled while the list of repeated digests is small (counted first).

Reader: an archive is read from start to end in chunks. Each member is
inflated step by step with its own zlib object, a record's block is framed by
its Content-Length, its digests are recomputed as it streams by, and what
follows must be the end of the record and of the member. Anything else is an
error that names the file and the offset.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import sys
import urllib.parse
import uuid
import zlib

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.llm.common import filesystem, scratch, stored

#: Fixed values of the format.
VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
END = b"\r\n\r\n"

FILE_BYTES = 256 << 20      # an archive is closed once it is so long
CHUNK = 1 << 16
BROADCAST_ROWS = 200_000    # repeated digests, some 30 bytes each
PAGE_URN = "urn:page:"


def base32_sha1(sha1) -> str:
    return base64.b32encode(sha1.digest()).decode()


def _sha1_text(data: bytes) -> str:
    return base32_sha1(hashlib.sha1(data))


def record(kind: str, fields: list[tuple[str, str]], block: bytes) -> bytes:
    """One WARC record as a gzip member."""
    head = [VERSION, f"WARC-Type: {kind}", *(f"{k}: {v}" for k, v in fields),
            f"WARC-Block-Digest: sha1:{_sha1_text(block)}", f"Content-Length: {len(block)}"]
    return gzip.compress("\r\n".join(head).encode() + END + block + END, compresslevel=6, mtime=0)


def page_record(page_id, url, payload: bytes, first, date: str) -> bytes:
    """The record of one page; ``first``: the id of the response it repeats, or None."""
    uri = urllib.parse.quote(url or f"{PAGE_URN}{page_id}", safe="!#$%&'()*+,/:;=?@[]~")
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {len(payload)}\r\n\r\n").encode()
    fields = [("WARC-Record-ID", f"<{PAGE_URN}{page_id}>"), ("WARC-Date", date), ("WARC-Target-URI", uri),
              ("Content-Type", "application/http; msgtype=response"),
              ("WARC-Payload-Digest", f"sha1:{_sha1_text(payload)}")]
    if first is None:
        return record("response", fields, http + payload)
    return record("revisit", [*fields, ("WARC-Profile", REVISIT_PROFILE),
                              ("WARC-Refers-To", f"<{PAGE_URN}{first}>")], http)


class TornArchive(ValueError):
    pass


class Members:
    """The bytes of one gzip member after another, in steps."""

    def __init__(self, stream, name: str):
        self.stream, self.name = stream, name
        self.raw, self.data, self.at = b"", b"", 0
        self.z = None

    def torn(self, why: str) -> TornArchive:
        return TornArchive(f"{self.name}, member at byte {self.at}: {why}")

    def open(self) -> bool:
        """Starts the next member; False at the end of the file."""
        if not self.raw:
            self.raw = self.stream.read(CHUNK)
        if not self.raw:
            return False
        self.z, self.data, self.used = zlib.decompressobj(31), b"", 0
        return True

    def more(self) -> bool:
        """Inflates one step; False at the end of the member."""
        if self.z.eof:
            return False
        if not self.raw and not self.z.unconsumed_tail:
            self.raw = self.stream.read(CHUNK)
            if not self.raw:
                raise self.torn("the file ends inside it")
        taken = self.z.unconsumed_tail + self.raw
        try:
            self.data += self.z.decompress(taken, CHUNK)
        except zlib.error as e:
            raise self.torn(str(e)) from e
        self.raw = self.z.unused_data       # empty but at the member's end
        self.used += len(taken) - len(self.z.unconsumed_tail) - len(self.raw)
        return True

    def until(self, mark: bytes) -> bytes:
        """What comes before ``mark``, however long; the mark is skipped."""
        parts, tail = [], b""
        while (k := (tail + self.data).find(mark)) < 0:
            # all but a mark's beginning is done with
            whole = tail + self.data
            parts.append(whole[:max(0, len(whole) - len(mark))])
            tail, self.data = whole[max(0, len(whole) - len(mark)):], b""
            if not self.more():
                raise self.torn("no end of its header")
        whole = tail + self.data
        self.data = whole[k + len(mark):]
        return b"".join(parts) + whole[:k]

    def take(self, n: int):
        """The next ``n`` bytes, in pieces."""
        while n > 0:
            if not self.data and not self.more():
                raise self.torn(f"its block is {n} bytes short")
            piece, self.data = self.data[:n], self.data[n:]
            n -= len(piece)
            if piece:
                yield piece

    def close(self) -> None:
        """The member must end here."""
        while self.more():
            pass
        if self.data:
            raise self.torn("bytes after the record")
        self.at += self.used


def _fields(lines: list[bytes]) -> dict[str, str]:
    out = {}
    for line in lines:
        k, _, v = line.decode("utf-8", "replace").partition(":")
        out[k.strip().lower()] = v.strip()
    return out


def read_archive(stream, name: str = "archive", keep: bool = False, strict: bool = False):
    """The records of an archive in order, each a dict of ``type``, ``fields``, ``http``
    (header fields), ``payload_bytes``, ``payload_digest``, ``block_digest``, ``verified`` (whether it
    states the digests that were recomputed) and, with ``keep``, ``payload``. A record
    whose digest differs is an error; with ``strict`` so is a response or revisit that states none."""
    m = Members(stream, name)
    while m.open():
        lines = m.until(END).split(b"\r\n")
        if not lines[0].startswith(b"WARC/"):
            raise m.torn("no WARC version line")
        f = _fields(lines[1:])
        try:
            length = int(f["content-length"])
        except (KeyError, ValueError):
            raise m.torn("no Content-Length") from None
        block, payload, kept, size = hashlib.sha1(), hashlib.sha1(), [], 0
        is_http = f.get("content-type", "").startswith("application/http")
        head, http = bytearray(), None if is_http else {}
        for piece in m.take(length):
            block.update(piece)
            if http is None:        # the HTTP header comes first
                seen = max(0, len(head) - len(END))
                head += piece
                k = head.find(END, seen)
                if k < 0:
                    continue
                http, piece = _fields(bytes(head[:k]).split(b"\r\n")[1:]), bytes(head[k + len(END):])
            payload.update(piece)
            size += len(piece)
            if keep:
                kept.append(piece)
        if http is None:
            raise m.torn("no end of its HTTP header")
        if b"".join(m.take(len(END))) != END:
            raise m.torn("no end of the record")
        m.close()
        got = {"block": base32_sha1(block), "payload": base32_sha1(payload)}
        kind = f.get("warc-type", "")
        whats = ("block",) if kind == "revisit" else ("block", "payload")
        stated = {what: f.get(f"warc-{what}-digest", "") for what in whats}
        for what, said in stated.items():
            if said.startswith("sha1:") and said[5:] != got[what]:
                raise m.torn(f"its {what} digest is {got[what]}, not {said[5:]}")
        verified = all(said.startswith("sha1:") for said in stated.values())
        if strict and kind in ("response", "revisit") and not verified:
            raise m.torn("it states no SHA-1 digest")
        out = {"verified": verified,"type": kind, "fields": f, "http": http or {}, "payload_bytes": size,
               "payload_digest": got["payload"], "block_digest": got["block"]}
        yield {**out, "payload": b"".join(kept)} if keep else out


def write_archives(pages: DataFrame, id_col: str = "page_id", url_col: str = "url",
                   html_col: str = "html", least_bytes: int = 0, file_bytes: int = FILE_BYTES,
                   date: str = "2024-01-01T00:00:00Z", broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Writes the archives of all pages and returns the stored table of
    files (path, records, bytes).

    A null html is an empty payload, a null or empty url the page's urn; urls and
    payloads may be of any length. Payloads of at
    least ``least_bytes`` bytes are deduplicated. Null ids are written as
    ``urn:page:null``; they revisit others and are revisited by none. Rows that repeat
    the smallest id of a payload are responses all. An empty table gives no file.
    """
    spark = pages.sparkSession
    folder = scratch(spark, "warc")

    def run(batches):
        fs, root = filesystem(folder)
        fs.create_dir(root, recursive=True)
        done, out, path, n, size = [], None, "", 0, 0
        info = record("warcinfo", [("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"), ("WARC-Date", date),
                                   ("Content-Type", "application/warc-fields")], b"format: WARC File Format 1.1\r\n")
        for batch in batches:
            for pid, url, data, first in zip(*(batch.column(c) for c in ("page_id", "url", "payload", "first"))):
                if out is None:
                    path = f"{root}/pages-{uuid.uuid4().hex}.warc.gz"
                    out, n, size = fs.open_output_stream(path, compression=None), 0, len(info)
                    out.write(info)
                page = pid.as_py()
                raw = page_record("null" if page is None else page, url.as_py(), data.as_py(), first.as_py(), date)
                out.write(raw)
                n, size = n + 1, size + len(raw)
                if size >= file_bytes:
                    out.close()
                    done.append((path, n, size))
                    out = None
        if out is not None:
            out.close()
            done.append((path, n, size))
        cols = list(zip(*done)) if done else [[], [], []]
        yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.string()), pa.array(cols[1], pa.int64()),
                                          pa.array(cols[2], pa.int64())], names=["path", "records", "bytes"])

    d = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"),
                     F.encode(F.coalesce(F.col(html_col), F.lit("")), "UTF-8").alias("payload"))
    sha1 = F.unhex(F.sha1("payload"))
    again = stored(d.filter(F.octet_length("payload") >= least_bytes).select("page_id", sha1.alias("sha1"))
                   .groupBy("sha1").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
                   .filter((F.col("n") > 1) & F.col("first").isNotNull()).select("sha1", "first"), "warc-again")
    if again.count() <= broadcast_rows:
        again = F.broadcast(again)
    first = F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first"))
    d = (d.withColumn("sha1", sha1).join(again, "sha1", "left")
         .select("page_id", "url", "payload", first.alias("first")))
    return stored(d.mapInArrow(run, "path string, records long, bytes long"), "warc-files")


def read_archives(spark: SparkSession, files: DataFrame) -> DataFrame:
    """One row per page record of the archives: (page_id, payload_bytes,
    payload_digest, record_type, refers_to), of revisits the size and digest of
    the payload that they repeat. One task reads a file from start to end."""
    folder = scratch(spark, "warc")

    def page(urn: str):
        x = urn.strip("<>").removeprefix(PAGE_URN)
        return int(x) if x not in ("", "null") else None

    def run(batches):
        fs, _ = filesystem(folder)
        rows = []

        def batch_of(rows):
            c = list(zip(*rows)) if rows else [[]] * 5
            return pa.RecordBatch.from_arrays(
                [pa.array(c[0], pa.int64()), pa.array(c[1], pa.int64()), pa.array(c[2], pa.string()),
                 pa.array(c[3], pa.string()), pa.array(c[4], pa.int64())],
                names=["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"])
        for batch in batches:
            for path in batch.column("path").to_pylist():
                with fs.open_input_stream(path, compression=None) as stream:
                    for r in read_archive(stream, path, strict=True):
                        f = r["fields"]
                        if r["type"] == "response":
                            rows.append((page(f["warc-record-id"]), r["payload_bytes"], r["payload_digest"],
                                         "response", None))
                        elif r["type"] == "revisit":
                            rows.append((page(f["warc-record-id"]), int(r["http"]["content-length"]),
                                         f["warc-payload-digest"].removeprefix("sha1:"), "revisit",
                                         page(f["warc-refers-to"])))
                        if len(rows) >= 5000:
                            yield batch_of(rows)
                            rows = []
        yield batch_of(rows)

    tasks = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return files.select("path").repartitionByRange(tasks, "path").mapInArrow(
        run, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long")


cloudpickle.register_pickle_by_value(sys.modules[__name__])
