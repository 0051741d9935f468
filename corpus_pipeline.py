"""A corpus pipeline: language, quality, near duplicates, mixture, packing.

Every stage reads what its predecessor has written as Parquet and works on all of it. The
stages but the last return the columns of their input, whatever these are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from linkrisk.llm import language, mixing, packing, repetition, simhash
from linkrisk.session import write_scratch


def _with_row(docs: DataFrame) -> DataFrame:
    """The whole row as one column, so that no name collides and the text goes to Python once."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"))


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without letters and long ones that resemble no learnt language.

    Null and empty texts have no letters and go; repeated rows share their fate; no rows give none.
    """
    found = language.identify(_with_row(docs), "_row.text", "_row.lang", "_row.doc_id", ["_row"])
    return found.where(language.accepts(F.col("_row.text"))).select("_row.*")


def check_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that are too short or repeat themselves.

    Null and empty texts have no words and go; a very long text is judged whole; repeated rows share their fate.
    """
    found = repetition.repeats(_with_row(docs), "_row.text", ["_row"], with_spans=False)
    return found.where(repetition.keeps()).select("_row.*")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each class of ``op8_simhash``: 3-word shingles, fingerprints within 3 bits, the least key.

    Null and empty texts are one class; a null key stays only where its class has no other; of equal rows one stays.
    """
    return simhash.one_of_each(docs, size=3, radius=3)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes the sources at their weights; a document may be taken several times.

    A null source is a source of its own; a document without words is taken by its hash like the others of its source,
    in a source without any words once.
    """
    return mixing.mix(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in their sequences; a null or empty text is its end id alone."""
    return packing.pack(docs)


STAGES = [
    ("language", identify_language),
    ("quality", check_quality),
    ("near_duplicates", drop_near_duplicates),
    ("mixture", mix_sources),
    ("packing", pack_sequences),
]

#: Prototypes, suffix arrays and fingerprints have no counterpart in SQL; the tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = write_scratch(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
