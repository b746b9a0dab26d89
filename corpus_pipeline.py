"""A corpus pipeline of five text operators: raw documents to packed training sequences.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; ``run`` writes each one's rows as
Parquet and reads them again as the next one's documents. All stages but the last return the columns of
``documents``, whatever further columns there are. No documents: no rows, from any stage. SQL can express neither the trained models nor the packing plan, so there is no
``ORACLE_SQL``; the tests hold each stage against brute force.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import langid, mixing, packing, secret_scan, shingles
from tessera.llm.entries import tokenizer_path
from tessera.llm.support import load, place, plain, release, tune, written

#: How far from chance (0) to certainty (1) a language score must be, whatever the number of languages.
LEAST_LANGUAGE_SCORE = 0.4


def _sized(docs: DataFrame) -> DataFrame:
    """``docs`` with n_chars, if there is such a column, as the length of the text."""
    names = docs.columns
    if "n_chars" not in names:
        return docs
    at = names.index("n_chars")
    own = plain(docs)
    return own.withColumn(f"c{at}", F.length(place(docs, "text")).cast("bigint")).toDF(*names)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a learned language, which their lang column then names; the rest goes.

    Null texts and texts without a letter go. Documents with a lang teach the languages; without any such document all
    go. Long texts are read whole, null ids and repeated rows stay, ties go to the language first by code point.
    """
    tune(spark)
    return langid.accepted(docs, langid.fit(docs), LEAST_LANGUAGE_SCORE)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of texts linked by a five-word similarity of 0.8 or more: that with the least id.

    Null ids come last, and of rows with the same id the first stays. Null and wordless texts are one class. Long texts
    count whole.
    """
    tune(spark)
    return shingles.keep_one(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, accepted secrets masked, n_chars as it is then. Null texts stay null; repeated rows and null ids stay."""
    tune(spark)
    return _sized(secret_scan.redact(docs, secret_scan.fit()))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' words in the mix, a row for each document and pass, n_chars as it is then.

    Documents of which the mix takes nothing, null and wordless ones among them, don't appear. Null sources are a source
    of their own; repeated rows are mixed each for itself.
    """
    tune(spark)
    return _sized(mixing.mixed(docs))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Training sequences: pieces of documents with their ids and places. Null texts hold the end id alone; repeated rows have places of their own."""
    tune(spark)
    return packing.pack(docs, tokenizer_path(), keep_ids=True)


STAGES = [("language ID", language), ("SimHash near-dedup", near_duplicates), ("secret scans", secrets), ("mixing", mixture), ("packing", packed)]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = written(docs, "stage")
            release(spark, (docs,))  # what the stages so far have left
    return docs
