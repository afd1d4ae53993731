"""One query per operator, over its whole table with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, conversation_repair, language, merkle, nearest, odd_sketches, packing, quality_neighbours, quality_rules, secrets, simhash, token_files, warc
from .common import run_folder, table
from .contract_sql import CONVERSATION_REPAIR, MERKLE, ODD_SKETCHES, WARC
from .registry import register

#: where the vocabulary files are and how texts are split before merges; parameters of the operators
TOKENIZERS = public_tokenizers.path
PATTERN = public_tokenizers.PATTERN
END_OF_TEXT = 50256


def fold(modulus: int):
    """crc32 of the id as text, by remainder."""
    return F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(modulus))


@register("op1_warc", WARC)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = run_folder(spark, "warc")
    warc.write(table(spark, sf_dir, "pages"), folder)
    return warc.read(spark, folder).select(F.col("key").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")


@register("op2_language")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    remainder = fold(5)
    identifier = language.fit(docs.where(F.coalesce(remainder != 0, F.lit(True))), calibrate=F.coalesce(remainder == 4, F.lit(False)))
    found = language.identify(docs.select("doc_id", "text"), identifier)
    # a text with letters gets the nearest language here; what the operator rejects is told apart
    return found.select("doc_id", F.coalesce(remainder == 0, F.lit(False)).alias("held_out"), F.col("best").alias("lang_pred"), "score",
                        "bits", ((F.col("lang_pred") != F.col("best"))).alias("rejected"))


#: words of a shingle and differing bits that link
SHINGLE, RADIUS = 3, 3


@register("op3_simhash")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@register("op4_quality_rules")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.score(table(spark, sf_dir, "documents"))


@register("op5_vantage_points")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return nearest.search(vectors, vectors.where(F.col("vec_id") % 100 == 0), factor=FACTOR)


#: relaxation of the pruning; one is exact
FACTOR = 1.0


@register("op6_packing")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(table(spark, sf_dir, "documents"), "doc_id", "text", TOKENIZERS("byte_bpe_50k.tiktoken"), PATTERN,
                          special={"<|endoftext|>": END_OF_TEXT})
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


@register("op7_secrets")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.drop("text")


@register("op8_quality_neighbours")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = F.coalesce(fold(3) == 1, F.lit(False))
    model = quality_neighbours.fit(docs, table(spark, sf_dir, "labels").where(~held_out))
    return quality_neighbours.with_scores(docs, model, "text", "score").select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


@register("op9_token_counts")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.count_tokens(table(spark, sf_dir, "documents"), "doc_id", "text", TOKENIZERS("byte_bpe_multi_50k.tiktoken"),
                                    PATTERN, END_OF_TEXT)


@register("op10_bpe")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = TOKENIZERS("byte_bpe_multi_50k.tiktoken")
    docs = bpe.merged(table(spark, sf_dir, "documents").select("doc_id", "text"))
    found = bpe.decode(bpe.encode(docs, path, PATTERN), path, listed="listed")
    # the list ends with a comma that the contract leaves out
    listed = F.substring("listed", F.lit(1), F.greatest(F.octet_length("listed") - 1, F.lit(0)))
    return found.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(listed, 256).alias("ids_sha256"),
                        F.sha2("decoded", 256).alias("decoded_sha256"))


@register("op12_merkle", MERKLE)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["doc_id", "source", "lang", "n_chars", "text"]
    docs = table(spark, sf_dir, "documents")
    tampered = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(7)) == 0, F.lit(False))
    # tampering adds one to n_chars of every row whose crc32 7 divides; other rows keep their leaf
    other = merkle.leaf([F.col(c) + 1 if c == "n_chars" else F.col(c) for c in columns])
    rows = merkle.manifest(docs, columns, carry={"other": F.when(tampered, other)})
    text = {c: F.lower(F.hex(c)) for c in ("leaf", "subroot", "root")}
    fold = F.lower(F.hex(merkle.folded(F.coalesce("other", "leaf"), F.col("path"))))
    return rows.select("doc_id", *[v.alias(c) for c, v in text.items()], F.sha2(F.lower(F.hex(merkle.proof(F.col("path")))), 256).alias("proof_sha256"),
                       fold.alias("folded_root")).withColumn("verified", F.col("folded_root") == F.col("root"))


def damaged(turns: DataFrame) -> DataFrame:
    """Conversation rows with planted faults, by crc32 of ``conv_id:turn``; NULLs are read as one blank."""
    blank = F.lit(" ")
    number = lambda c: F.coalesce(F.col(c).cast("string"), blank)
    fault = F.pmod(F.crc32(F.concat(number("conv_id"), F.lit(":"), number("turn"))), F.lit(20))
    text, role = F.coalesce("text", blank), F.coalesce("role", blank)
    changed = F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.translate(text, ".!?", "")).otherwise(text)
    return (turns.withColumn("fault", fault).where("fault <> 0")
            .withColumn("copy", F.explode(F.when(F.col("fault") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))))
            .select("conv_id", "turn", F.when(F.col("fault") == 4, "user").otherwise(role).alias("role"), changed.alias("text")))


@register("op11_conversation_repair", CONVERSATION_REPAIR)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    repair = conversation_repair.repair(damaged(turns))
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    found = (turns.select("conv_id").distinct().join(repair.report, F.col("conv_id").eqNullSafe(F.col("conv")), "left").drop("conv")
             .join(conversation_repair.digests(repair.rows), F.col("conv_id").eqNullSafe(F.col("conv")), "left"))
    # conversations without a row after damage, or after repair
    return found.select("conv_id", *[F.coalesce(n, F.lit(0).cast("long")).alias(n) for n in counts], F.coalesce("audit", F.lit("")).alias("audit"),
                        F.coalesce("sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


@register("op13_odd_sketches", ODD_SKETCHES)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return odd_sketches.near_duplicates(table(spark, sf_dir, "documents"), shingle=2, least=80)
