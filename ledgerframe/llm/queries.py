"""The operators applied to their whole tables, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, chat, divergence, exact, extract, forest, packing, pii, quality, rules, simhash, spelling, toxicity
from .common import table


def _tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.judge_lines(table(spark, sf_dir, "documents"))


def byte_bpe() -> str:
    return _tokenizer("byte_bpe_50k.json")


def packed_digests(pieces: DataFrame) -> DataFrame:
    """Places of token pieces, with the checksum of each piece's ids for the ids."""
    return packing.pack(pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids"))


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents"))


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_groups(table(spark, sf_dir, "documents"))
    digits = F.lpad(F.lower(F.hex("fp")), 16, "0")
    return found.select("doc_id", digits.alias("fingerprint"), "component_id")


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed_digests(packing.token_pieces(table(spark, sf_dir, "documents"), byte_bpe()))


def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = extract.extract(table(spark, sf_dir, "pages"))
    return found.withColumn("n_chars", F.length("text").cast("long"))


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_groups(table(spark, sf_dir, "documents"), hash_all=True)


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.found_spans(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        *[F.size(kind).cast("long").alias(f"n_{kind}") for kind in pii.KINDS],
        F.sha2(pii.span_string(pii.all_spans(base_only=True)), 256).alias("base_sha256"),
        pii.span_string(pii.all_spans()).alias("spans"),
    )


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit_chain(docs, table(spark, sf_dir, "labels")))


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = bpe.encode_decode(table(spark, sf_dir, "documents"), _tokenizer("word_bpe_49k.json"))
    return coded.select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )


def op10_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.format_chats(table(spark, sf_dir, "conversations"))


def op11_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forest.nearest(table(spark, sf_dir, "embeddings"))


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants_of_texts(table(spark, sf_dir, "documents"))


def op13_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_quality": op1_quality,
    "op2_simhash": op2_simhash,
    "op3_quality_rules": op3_quality_rules,
    "op4_packing": op4_packing,
    "op5_html_extraction": op5_html_extraction,
    "op6_exact_dedup": op6_exact_dedup,
    "op7_pii": op7_pii,
    "op8_toxicity": op8_toxicity,
    "op9_bpe": op9_bpe,
    "op10_chat_formatting": op10_chat_formatting,
    "op11_neighbours": op11_neighbours,
    "op12_spelling": op12_spelling,
    "op13_divergence": op13_divergence,
}
