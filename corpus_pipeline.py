"""A training corpus from ``documents``: language identification, near-duplicate
removal, benchmark decontamination, mixing to target weights, token files.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir)
and returns a DataFrame, which is written as Parquet and read again as the
next one's ``docs``. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.llm.common import read, stored, word_count
from strandline.llm.decontaminate import without_leaks
from strandline.llm.lang_id import accepted_rows, held_out, train
from strandline.llm.mixing import mixed_rows
from strandline.llm.near_dup import one_of_each
from strandline.llm.token_files import token_digests


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told by a clear margin; the others go,
    among them null and empty texts and texts without a letter. Learns from the
    labels of ``docs``. Each row is told by its own text, whatever its id."""
    return accepted_rows(docs, train(docs.filter(~held_out("doc_id"))))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates (five-word shingles,
    similarity of 0.8 or more), the one with the smallest id, null last. Rows that share
    an id are told apart by their texts; of equal rows one stays; texts
    without words stay."""
    return one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose text holds no benchmark item. A null or repeated id
    decides nothing; null and empty texts stay."""
    return without_leaks(docs, read(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each row as often as the mix takes it; not at all if not taken. Equal rows
    are taken together, rows that only share an id each by itself."""
    return mixed_rows(docs, word_count(docs["text"]))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of what is left, and what they hold of each document."""
    import public_tokenizers
    return token_digests(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [("language_id", language_id), ("near_duplicates", near_duplicates),
          ("decontamination", decontamination), ("mixing", mixing), ("token_files", tokens)]

#: Compression and tokenisation can't be stated in SQL; the stages are tested
#: against brute-force versions (tests/llm).
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the rows of the last."""
    docs = read(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = stored(docs, f"pipeline-{name}")
    return docs
