"""Cleans a corpus of documents and packs it for training: STAGES in order, each on what the one before kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedwell.llm.keep_one import keep_one
from feedwell.llm.packing import pack_sequences
from feedwell.llm.secret_scan import redact
from feedwell.llm.shared import Scratch
from feedwell.llm.tiling import contaminated
from feedwell.llm.toxicity import fit_toxicity


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that a model fitted on all labels calls toxic."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    with Scratch(spark) as scratch:
        model = fit_toxicity(docs, labels, scratch)
    return docs.filter(model.column("text") < 0.5)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that is linked by five-word shingles and a similarity of 0.8."""
    with Scratch(spark) as scratch:
        return keep_one(docs, scratch, width=5, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that hold a passage of the benchmark; each row by its own text, whatever its id."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    place = max(docs.columns, key=len) + "_"
    keyed = docs.withColumn(place, F.xxhash64("text"))
    with Scratch(spark) as scratch:
        hits = contaminated(keyed.select(F.col(place).alias("place"), "text"), items, doc_id="place")
        hits = scratch.result(hits.select(F.col("doc_id").alias(place)).distinct())
    return keyed.join(hits, place, "left_anti").select(docs.columns)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every secret replaced by a mark; ``n_chars`` follows."""
    with Scratch(spark) as scratch:
        clean = redact(docs, scratch=scratch)
    if "n_chars" in docs.columns:
        clean = clean.withColumn("n_chars", F.length("text").cast("long"))
    return clean.select(docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The kept documents as pieces of sequences of 1024 tokens, with their token ids."""
    return pack_sequences(docs, public_tokenizers.path("byte_bpe_50k.json"), 0)


STAGES = [
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("secrets", secrets),
    ("packing", packing),
]

#: SQL cannot express the fitted model or the tokenizer: the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages; what each keeps is written once and read by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    with Scratch(spark) as scratch:
        for _, stage in STAGES[:-1]:
            docs = scratch.table(stage(spark, docs, sf_dir))
        return scratch.result(STAGES[-1][1](spark, docs, sf_dir))
