"""One query per operator, over the whole driver tables, and SQL where it can state the result."""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from ratingloom.llm import (
    attribution,
    bpe,
    conversations,
    langid,
    licences,
    minhash,
    mixing,
    negatives,
    oracle,
    quality,
    repeats,
    secrets,
    topk,
    wrappers,
)


def vocabulary_path() -> str:
    """The public byte-level vocabulary of 50,257 ids."""
    return public_tokenizers.path("byte_bpe_50k.json")


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_bpe_roundtrip(spark, folder):
    return bpe.digests(bpe.transcode(_table(spark, folder, "documents"), vocabulary_path()))


def op2_licence_scan(spark, folder):
    docs = _table(spark, folder, "documents")
    return licences.scan(docs, licences.train(docs))


def op3_repeated_bytes(spark, folder):
    return repeats.digests(repeats.remove_repeats(_table(spark, folder, "documents")))


def op4_language(spark, folder):
    docs = _table(spark, folder, "documents")
    return langid.identify(docs, langid.fit(docs))


def op5_circulant_minhash(spark, folder):
    return minhash.near_duplicates(_table(spark, folder, "documents"))


def op6_secret_layers(spark, folder):
    return secrets.digests(secrets.find_secrets(_table(spark, folder, "documents")))


def op7_source_mix(spark, folder):
    return mixing.mix_report(_table(spark, folder, "documents"))


def op8_section_tokens(spark, folder):
    return attribution.section_tokens(_table(spark, folder, "documents"), vocabulary_path())


def op9_exact_topk(spark, folder):
    return topk.top_k(_table(spark, folder, "embeddings"))


def op10_quality_rules(spark, folder):
    return quality.quality_rules(_table(spark, folder, "documents"))


def op11_hard_negatives(spark, folder):
    return negatives.hard_negatives(negatives.relabelled(_table(spark, folder, "embeddings")))


def op12_page_text(spark, folder):
    return wrappers.extract(_table(spark, folder, "pages"))


def op13_conversation_repair(spark, folder):
    turns = _table(spark, folder, "conversations")
    return conversations.repair(conversations.damage(turns), turns)


QUERIES = {
    f.__name__: f
    for f in (
        op1_bpe_roundtrip,
        op2_licence_scan,
        op3_repeated_bytes,
        op4_language,
        op5_circulant_minhash,
        op6_secret_layers,
        op7_source_mix,
        op8_section_tokens,
        op9_exact_topk,
        op10_quality_rules,
        op11_hard_negatives,
        op12_page_text,
        op13_conversation_repair,
    )
}

ORACLE_SQL = oracle.SQL
