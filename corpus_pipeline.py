"""Corpus pipeline: from raw documents to packed training sequences.

Every stage is a function of (spark, docs, sf_dir) that returns a DataFrame, written as Parquet and read again as the
docs of the next. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gearledger.llm.common import table
from gearledger.llm.line_dedup import drop_duplicate_lines
from gearledger.llm.mixing import curriculum
from gearledger.llm.near_dedup import drop_near_duplicates
from gearledger.llm.packing import pack_in_order
from gearledger.llm.quality import keep_good
from gearledger.session import materialise

#: Near copies share at least so many percent of their five-word shingles; a pair at 80 % misses all bands with 1e-5.
NEAR_PERCENT = 80
NEAR_BANDS = 64


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the quality classifier rejects; it learns from the labels of the corpus.

    Null, empty and blank texts all get the score of the bias and so share one fate; equal texts do too, and repeated rows
    stay or go together. Texts of any length are scored whole. Rows with a null id are judged like others. Further columns
    pass unread, whatever their names. An empty table gives an empty result, and without labels every document stays.
    """
    return keep_good(docs, table(spark, sf_dir, "labels"))


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts repeated line blocks out of later documents, and drops those left without a word. Lengths follow.

    Null ids take no part and keep their text; null and empty texts stay. Rows equal in id and text lose the same lines.
    Texts are compared whole. Further columns pass, but ``n_chars`` is set anew and a column ``n_lines_removed`` is
    dropped. An empty table gives an empty result.
    """
    return drop_duplicate_lines(docs).withColumn("n_chars", F.char_length("text").cast("long"))


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near copies, the one with the smallest id.

    Null, empty and blank texts are near to nothing and stay. A row without an id is a document named by its text and
    gives way to a copy with an id; of rows equal in id and text one stays. Ids must be numbers. Further columns pass,
    except that ``near_dedup_id`` and ``near_dedup_key`` are the stage's own names. An empty table gives an empty result.
    """
    return drop_near_duplicates(docs, NEAR_PERCENT, NEAR_BANDS).select(docs.columns)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents in training order; a document stands as often as its source's target takes it.

    Null and empty texts have no words and are never taken. Null sources are one source; rows without an id stand at
    their text's place; repeated rows are documents of their own. Further columns pass, whatever their names. An empty
    table gives an empty result.
    """
    return curriculum(docs).select(docs.columns)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their places in training sequences, whose numbers follow the training order.

    The order is that of the files of docs: sequences of a group of consecutive documents come before those of the next.
    Null and empty texts are one piece of the closing id alone; longer texts than a sequence are cut into several. Null
    ids stay null, repeated rows are packed each, further columns are left out. An empty table gives an empty result.
    """
    return pack_in_order(docs)


STAGES = [
    ("quality_classifier", quality_stage),
    ("line_dedup", line_stage),
    ("near_dedup", near_stage),
    ("source_mixing", mixing_stage),
    ("best_fit_packing", packing_stage),
]

#: No SQL: the classifier, patience diff and the local search are not expressible; see tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder, each written and read again; the packed pieces.

    What a stage does with nulls, empty and very long texts, repeated rows and further columns is told there. The written
    tables stay in the shared folder, so a failed run can be looked into; the owner of the folder clears it.
    """
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return docs
