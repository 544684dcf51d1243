"""Clean, mix and encode the corpus: stages from ``documents`` to token ids.

Each stage takes what the one before kept and returns rows of ``documents``; the
last returns one row per text with its token ids. Further columns pass through
the stages up to the last.
"""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratingloom.llm import bpe, langid, minhash, mixing, secrets
from ratingloom.session import durable, remove, scratch_path, temporary_tables


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of a known language; a null ``lang`` becomes the predicted one.

    Rejected are texts that are null or without a letter, and scores under 0.3: a text
    of several languages keeps a higher one.
    """
    return langid.keep_identified(docs, langid.fit(docs))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, that of the smallest id.

    Rows that repeat an id and its text are one document and stay once; an id
    with several texts is one document and keeps them; rows without id take no
    part and stay.
    """
    found = minhash.near_duplicates(docs)
    kept = durable(found.filter("kept").select(F.col("doc_id").alias("_kept_id")).distinct(), "near-duplicates-kept")
    stay = docs.join(kept, docs["doc_id"] == kept["_kept_id"], "left_semi")
    return stay.dropDuplicates(["doc_id", "text"]).unionByName(docs.filter(docs["doc_id"].isNull()))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, every secret in their text masked; ``n_chars`` is that of the new text.

    Null and empty texts and repeated rows stay as they are; an empty table gives none.
    """
    masked = secrets.redact(docs)
    if "n_chars" not in docs.columns:
        return masked
    return masked.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixture: documents as often as their source's target asks, up to twice, in shuffled shards.

    A null source is one of its own, repeated rows are taken alike; an empty table gives none.
    """
    return mixing.mix(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text of the mixture with the digests of ids and decoded text.

    A null text counts as empty; every row has its own, also a repeated one; an empty table gives none.
    """
    coded = bpe.transcode(docs, public_tokenizers.path("byte_bpe_50k.json"))
    return bpe.digests(coded, "ids")


STAGES = [
    ("language", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("secrets", mask_secrets),
    ("mixture", mix_sources),
    ("bpe", encode),
]

# SQL has no random field, recursive decoding or BPE.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read again.

    What a stage stores for itself goes when its result is written, and that
    result when the next one is; the last table stays for the rows returned.
    """
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, f"pipeline-{name}")
        with temporary_tables(spark):
            kept = stage(spark, docs, sf_dir)
            kept.write.parquet(path)
        docs = spark.read.schema(kept.schema).parquet(path)
        if before:
            remove(spark, before)
        before = path
    return STAGES[-1][1](spark, docs, sf_dir)
