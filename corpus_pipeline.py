"""The corpus pipeline: documents pass five stages, each over all that its predecessor kept.

Each stage takes (spark, docs, sf_dir) and returns the rows it keeps with the columns of documents; the last returns the
pieces of the packed sequences. No SQL can state the learned stages, so ``ORACLE_SQL`` is None and tests compare the stages
with brute force.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from patronage.llm import contracts, packing, quality_neighbours, quality_rules, secrets, simhash
from patronage.llm.common import prepare, table
from patronage.session import shared_dir

ORACLE_SQL = None


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that their nearest labelled neighbours call good. Labels of the held-out third are not learned from."""
    prepare(spark)
    held_out = F.coalesce(contracts.fold(3) == 1, F.lit(False))
    model = quality_neighbours.fit(docs.select("doc_id", "text"), table(spark, sf_dir, "labels").where(~held_out))
    return quality_neighbours.keep_good(docs, model)


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rule and whose posterior of being good is at least one half."""
    prepare(spark)
    return quality_rules.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that fingerprints of three-word shingles link at three bits or fewer, that with the smallest id."""
    prepare(spark)
    return simhash.keep_one(docs, shingle=contracts.SHINGLE, radius=contracts.RADIUS)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets in their texts replaced by the kind of secret."""
    prepare(spark)
    return secrets.redact(docs, length="n_chars" if "n_chars" in docs.columns else None)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of at most 1024 tokens."""
    prepare(spark)
    pieces = packing.pack(docs, "doc_id", "text", contracts.TOKENIZERS("byte_bpe_50k.tiktoken"), contracts.PATTERN,
                          special={"<|endoftext|>": contracts.END_OF_TEXT})
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


STAGES = [("quality_classifier", quality_classifier), ("quality_rules", rules), ("near_duplicates", near_duplicates),
          ("secret_scan", secret_scan), ("packing", pack)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written to the shared folder and read by the next stage."""
    docs = table(spark, sf_dir, "documents")
    folder = f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
