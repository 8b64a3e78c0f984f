"""Registered queries of the training-data operators and their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline

from . import automaton, bpe, collocations, dialogue, hnsw, lm, multiindex, packing, passages, pii, quality, setjoin, tokenfile
from .common import read, ship

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(fn):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return fn(spark, sf_dir)

    QUERIES[fn.__name__] = run
    return run


@query
def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every whole text, learned from the labels outside the held-out fold."""
    return quality.classify(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


@query
def op2_token_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every text, written to range-coded files in ascending order of documents and read back."""
    return tokenfile.read(tokenfile.write(read(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json")))


@query
def op3_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest of every vector whose id is divisible by 20, by inner product."""
    return multiindex.search(read(spark, sf_dir, "embeddings"))


@query
def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every text: counts by kind and digests of the spans."""
    d = pii.find(read(spark, sf_dir, "documents").select("doc_id", "text"), spans="found")
    base = F.filter("found", lambda s: s["rank"] < len(pii.BASE))
    count = lambda k: F.size(F.filter("found", lambda s: s["kind"] == k)).cast("bigint").alias(f"n_{k}")
    return d.select(
        "doc_id", *(count(k) for k in pii.BASE),
        F.sha2(pii.digest(base), 256).alias("base_sha256"), pii.digest(F.col("found")).alias("spans"),
        count("iban"), F.array_join(F.transform("found", lambda s: s["score"].cast("string")), ",").alias("scores"))


@query
def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every text by the byte-level ranks, and the bytes that they decode to, as digests."""
    return bpe.encode(read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"),
                      public_tokenizers.PATTERN, columns=("n_tokens", "ids_sha256", "decoded_sha256"))


@query
def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's ids in sequences of at most 2048, one row for each piece."""
    return packing.pack(read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query
def op8_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cross-entropy difference of every text: texts labelled good against the whole corpus."""
    return lm.score(read(spark, sf_dir, "documents"), None, members=lm.labelled(read(spark, sf_dir, "labels")))


@query
def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Size of every document's shingle set and the component of the similarity links that it is in."""
    return setjoin.join(read(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


@query
def op10_hnsw_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of vectors of a label with a cosine of at least 0.98."""
    return hnsw.near(read(spark, sf_dir, "embeddings"))


@query
def op7_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Paragraphs of every document that repeat, and which of them go."""
    return passages.summary(read(spark, sf_dir, "documents"))


@query
def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each language's first phrases of two and three words by their least score."""
    return collocations.mine(read(spark, sf_dir, "documents"))


ORACLES["op11_collocations"] = collocations.ORACLE_SQL


@query
def op12_dialogue_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation behind the damage: its faults, the cheapest repair and the digest of the repaired text."""
    return dialogue.repair(read(spark, sf_dir, "conversations"))


@query
def op13_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every text by the tokenization automaton, and the text that they decode to, as digests."""
    return automaton.encode(read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), columns=("n_tokens", "ids_sha256", "decoded_sha256"))


QUERIES["pipeline"] = corpus_pipeline.run
if corpus_pipeline.ORACLE_SQL is not None:
    ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL
