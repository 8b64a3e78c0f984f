"""The corpus pipeline: five operators one after another, each over all that its predecessor kept.

Every stage is a function (spark, docs, sf_dir) -> DataFrame.  All but the last return the columns of
``documents``; n_chars follows the text where a stage changes it.  ``run`` writes each stage's result
as Parquet in the shared folder and reads it back for the next one.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.llm import packing, passages, pii, quality, setjoin
from tidewatch.llm.common import read, ship, written

#: Spans below this score stay in the text.
MASK_FROM = 0.5


def _measured(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else docs


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the discriminant rejects go."""
    ship(spark)
    return quality.keep(docs, read(spark, sf_dir, "labels"))


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    ship(spark)
    return setjoin.keep_first(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Paragraphs that repeat across documents stay once."""
    ship(spark)
    return _measured(passages.cleaned(docs))


def mask_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind."""
    return _measured(pii.masked(docs, least=MASK_FROM))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The remaining documents' ids in sequences of at most 2048, one row for each piece."""
    ship(spark)
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [("quality classifier", quality_classifier), ("n-gram Jaccard join", jaccard_join), ("substring dedup", substring_dedup),
          ("PII", mask_pii), ("packing", pack)]

#: Similarity components, a fitted discriminant and tokenizer ids are not SQL; tests compare each stage with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "_"))
    return docs
