"""The corpus pipeline: quality rules, language, near duplicates, source mix, packing; each stage stored before the next.

Edge cases: all stages take null, empty and very long texts, null and repeated
ids, repeated rows, empty tables and any further columns, whatever their names;
each stage's docstring says what becomes of them. All stages but the last
return the columns of their input.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from voxloom.llm import language_id, mixing, near_dedup, packing, quality_rules
from voxloom.llm.common import documents, release, stored_alone
from voxloom.llm.queries import vocabulary_path


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep. Texts without words go; rows that repeat are judged alike; null lang or source are groups of their own.

    Texts are measured twice, for the thresholds and for the verdict, rather
    than stored once more.
    """
    return quality_rules.filter_documents(docs)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told with a score of 0.5 or more. Texts without a letter go; without any labelled language all go."""
    return language_id.filter_documents(docs, vocabulary_path("piece_bpe_32k.model"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates, the one whose doc_id is smallest (null last). Rows without words are no copies of each other."""
    return near_dedup.one_of_each(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, 0 to 3 times. Rows without words weigh nothing; a null source is a source."""
    return mixing.mix_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The packed pieces of every row, repeated ones as often as they occur. A null or empty text is one piece, its end id."""
    return packing.pack(docs, vocabulary_path("word_bpe_49k.json"), ids=False)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality rules", quality),
    ("language ID", language),
    ("near duplicates", near_duplicates),
    ("source mix", mix),
    ("packing", pack),
]

#: No stage after the second can be said in SQL (MinHash groups, hash-shuffled mix, packing); tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; every stage but the last is stored as Parquet and read again, and what it stored on its way is deleted."""
    docs = documents(spark, sf_dir)
    for _, stage in STAGES[:-1]:
        before, docs = docs, stored_alone(lambda f=stage, d=docs: f(spark, d, sf_dir))
        release(before)
    return STAGES[-1][1](spark, docs, sf_dir)
