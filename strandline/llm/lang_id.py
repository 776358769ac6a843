"""Language identification by compression.

For each language a raw-content zstandard dictionary is cut from a bounded
sample of labelled texts. A text is compressed in blocks with each
dictionary; the one that makes it smallest names the language. Blocks are
short against a dictionary, so a long text cannot teach the compressor its own words
and the dictionary counts from its first byte to its last.

A text is *rejected* where the margin between the two smallest sizes is
narrow: under ``MARGIN`` of the smaller.
"""

from __future__ import annotations

import re
import sys

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandline.llm.common import slices

#: Bounds of the sample, the only labelled rows that are collected: so many
#: texts of each language, so many characters of each, whatever bytes they take. Every
#: label is learned, of at most ``LABELS``; with more, training fails and says so.
SAMPLE_TEXTS = 160
SAMPLE_CHARS = 340
LABELS = 500
BLOCK = 2048            # bytes compressed at a time
SENT = 1 << 22          # bytes of text judged before the rows that stay are sent on
MARGIN = 0.005          # of the smallest size
UND = "und"


NO_LETTERS = re.compile(r"[\W\d_]+")


def normal(text: str) -> str:
    """Lower-case letters, all else a space: markup, numbers and shouting say
    nothing about the language."""
    return NO_LETTERS.sub(" ", text.lower())


def held_out(id_col: str) -> Column:
    """Whether the id's remainder keeps a document from the training."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 4 == 2, F.lit(False))


def train(docs: DataFrame, text_col: str = "text", lang_col: str = "lang",
          texts: int = SAMPLE_TEXTS, chars: int = SAMPLE_CHARS) -> dict[str, bytes]:
    """A dictionary for each language of the labelled rows of ``docs``, the
    most frequent first, however many there are.

    The sample is drawn by a hash of the text, ``texts`` of each language (twice
    that are asked for, of its distinct texts, and the smallest hashes kept); of
    each text ``chars`` characters from its middle. Equal texts count once,
    however many rows repeat them. Null labels and texts without a letter
    teach nothing; null and repeated ids are ids like others. More than ``LABELS``
    labels are an error.
    """
    unit = (F.xxhash64("text").bitwiseAND(F.lit((1 << 53) - 1)) / float(1 << 53))
    d = (docs.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
         .filter(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}")).withColumn("u", unit))
    # A text repeated by a third of all rows is one row after the first aggregate.
    each = d.groupBy("lang", "u").agg(F.count(F.lit(1)).alias("c"))
    seen = (each.groupBy("lang").agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("texts"))
            .orderBy(F.desc("n"), "lang").limit(LABELS + 1).collect())
    if not seen:
        return {}
    if len(seen) > LABELS:
        raise ValueError(f"more than {LABELS} labels; a dictionary for each is kept in every task")
    # joined, not a map in the plan, which would be searched from its start for each row
    rate = F.broadcast(docs.sparkSession.createDataFrame(
        [(r["lang"], min(1.0, 2.0 * texts / r["texts"])) for r in seen], "lang string, rate double"))
    part = F.substring("text", F.greatest(F.lit(1), ((F.length("text") - chars) / 2).cast("int")), F.lit(chars))
    got = (d.join(rate, "lang").filter(F.col("u") < F.col("rate"))
           .select("lang", "u", part.alias("part")).groupBy("lang", "u")
           .agg(F.min("part").alias("part")))
    first = Window.partitionBy("lang").orderBy("u")
    rows = (got.withColumn("k", F.row_number().over(first)).filter(F.col("k") <= texts)
            .orderBy("lang", "k").collect())
    out: dict[str, bytes] = {}
    for r in rows:
        out[r["lang"]] = out.get(r["lang"], b"") + (normal(r["part"]) + " ").encode()
    return {r["lang"]: out[r["lang"]] for r in seen if r["lang"] in out}


class Sizes:
    """Compressed sizes of a text under each language's dictionary.

    Matches of four bytes and a lazy search of 16 places: words and
    word parts that the dictionary has are found, at 4 MB/s for four languages.
    """

    def __init__(self, dictionaries: dict[str, bytes]):
        import zstandard as z
        self.langs = list(dictionaries)
        self.by = []
        for k in self.langs:
            d = z.ZstdCompressionDict(dictionaries[k], dict_type=z.DICT_TYPE_RAWCONTENT)
            p = z.ZstdCompressionParameters(strategy=z.STRATEGY_LAZY, window_log=18, hash_log=16, chain_log=17,
                                            search_log=4, min_match=4, target_length=16,
                                            write_content_size=False, write_dict_id=False)
            d.precompute_compress(compression_params=p)
            self.by.append(z.ZstdCompressor(compression_params=p, dict_data=d))

    def __call__(self, data: bytes) -> list[int]:
        parts = [data[k:k + BLOCK] for k in range(0, len(data), BLOCK)]
        return [sum(len(c.compress(p)) for p in parts) for c in self.by]


def judge(text, sizes: Sizes):
    """(language, score, margin, accepted) of one text."""
    data = normal(text).encode() if text else b""
    if not text or not sizes.langs or not any(c.isalpha() for c in text):
        return UND, 0.0, 0.0, False
    n = sizes(data)
    order = sorted(range(len(n)), key=lambda k: (n[k], k))
    best = n[order[0]]
    if len(n) == 1:
        return sizes.langs[0], 1.0, 1.0, True
    margin = (n[order[1]] - best) / best
    # the score: how sure, 0.5 at no margin, 1 from a margin of a tenth
    score = min(1.0, 0.5 + margin * 5)
    return sizes.langs[order[0]], score, margin, margin >= MARGIN


def identify(docs: DataFrame, dictionaries: dict[str, bytes], id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score, margin, accepted) for each row of ``docs``.

    ``und`` with score 0, not accepted, for a null text or one without a letter, or
    if nothing was learned. Ties go to the language with more labels. Rows that
    repeat an id, or have none, are predicted each by its own whole text, however long.
    """
    def run(batches):
        sizes = Sizes(dictionaries)
        for batch in batches:
            got = [judge(t.as_py(), sizes) for t in batch.column("text")]
            cols = list(zip(*got)) if got else [[], [], [], []]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(cols[0], pa.string()), pa.array(cols[1], pa.float64()),
                 pa.array(cols[2], pa.float64()), pa.array(cols[3], pa.bool_())],
                names=["doc_id", "lang_pred", "score", "margin", "accepted"])
    return (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
            .mapInArrow(run, "doc_id long, lang_pred string, score double, margin double, accepted boolean"))


def accepted_rows(docs: DataFrame, dictionaries: dict[str, bytes], text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, whose language is told by a clear margin.
    Nulls and texts without a letter go."""
    names, types = docs.columns, docs.schema

    def run(batches):
        sizes = Sizes(dictionaries)
        for batch in batches:
            for part in slices(batch, names.index(text_col), SENT):
                keep = [judge(t.as_py(), sizes)[3] for t in part.column(names.index(text_col))]
                yield part.filter(pa.array(keep, pa.bool_()))
    return docs.mapInArrow(run, types)


cloudpickle.register_pickle_by_value(sys.modules[__name__])
