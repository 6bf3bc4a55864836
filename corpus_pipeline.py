"""From raw documents to packed training sequences: five stages, each one operator over all that the one before kept.

What holds for every stage: a null or empty text is a document like any other, rows that repeat or share an id are told
apart by their texts, null ids, languages and sources are values of their own, further columns (whatever their names) come
out as they went in, and an empty table gives an empty one. All but the last return the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadastra.llm.common import discard, n_words, staged, table
from cadastra.llm.line_dedup import dedup_lines
from cadastra.llm.mixing import mixed_documents
from cadastra.llm.near_copies import keep_one_copy
from cadastra.llm.packing import pack_documents, word_bpe
from cadastra.llm.quality_classifier import accepted


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained quality classifier accepts; repeated rows are accepted alike. Without labels, all."""
    return accepted(docs, table(spark, sf_dir, "labels"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents without lines that an equal or close line comes before; n_chars is that of the new text.

    A null text stays null, and a document that loses all its lines stays with an empty text. Rows equal in id and text
    are one document here and lose the same lines; the next stage keeps one of them.
    """
    cut = dedup_lines(docs, name=None)
    return cut.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else cut


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five-word shingles, similarity 0.8), that of the smallest id.

    Null ids come last; texts without words, null ones too, are copies of each other.
    """
    return keep_one_copy(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as often as the source mix takes them, up to twice; a null source is one source. Texts without words
    take nothing of a target and come as often as their source's whole passes."""
    return mixed_documents(docs, n_words(F.col("text")))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 2048 tokens and their places in sequences, one set for each row of the mix, told apart by ``row``.

    A text without words is one piece of the closing id alone.
    """
    return pack_documents(docs, word_bpe())


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_classifier", quality),
    ("line_dedup", lines),
    ("simhash_near_dedup", near_duplicates),
    ("mix_sources", mix),
    ("best_fit_packing", pack),
]

#: SQL can express neither the classifier nor the packing.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn over the documents table; each result is written, read by the next and then deleted."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        kept = staged(stage(spark, docs, sf_dir), f"stage-{name}")
        discard(docs)
        docs = kept
    packed = STAGES[-1][1](spark, docs, sf_dir)
    discard(docs)
    return packed
