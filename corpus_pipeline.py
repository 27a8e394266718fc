"""Corpus pipeline over ``documents``: each stage applies one operator of ``nightledger.llm``.

Every stage function takes (spark, docs, sf_dir); its result is written as
Parquet and read again as the next one's ``docs``. All but the last return
the columns of ``docs`` as they came.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from nightledger.llm import language_crf, lsh_forest, mixing, pii_crf, piece_bpe
from nightledger.llm.common import stored, table
from nightledger.llm.queries import tokenizer_path

MIN_SCORE = 0.4   # mean marginal of the best language below which a text is in no known one


def all_of(docs: DataFrame) -> list[Column]:
    """The columns of ``docs``, those with a dot in their name too."""
    return [F.col(f"`{c}`") for c in docs.columns]


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a known language stay; texts without letters or with a low score go.

    Without any labelled row nothing is known, and only texts without a
    letter go. Rows keep all their columns; a null text goes.
    """
    model = language_crf.fit(docs)
    if model is None:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    return language_crf.known(docs, model, MIN_SCORE)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays, the one with the least doc_id.

    Documents without an id or without words have no group and stay; of rows
    that repeat a doc_id the one with the least hash of its text stays.
    """
    kept = lsh_forest.near_duplicates(docs).where("kept").select(F.col("doc_id").alias("kept_id")).distinct()
    known = docs.where(F.col("doc_id").isNotNull())
    text = F.sha2(F.col("text").cast("binary"), 256)
    place = F.row_number().over(Window.partitionBy("doc_id").orderBy(text, F.xxhash64(*all_of(docs))))
    one = known.join(kept, known.doc_id == kept.kept_id, "left_semi").withColumn("near_dedup place", place)
    return (one.where(F.col("near_dedup place") == 1).select(all_of(docs)).union(docs.where(F.col("doc_id").isNull())))


def redact_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every span of personal data becomes its kind in brackets; n_chars follows the text."""
    out = pii_crf.redact(docs, pii_crf.fit(docs))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(all_of(docs))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: a row for each draw of a document, shard by shard, each shard shuffled.

    Documents of sources above their target are drawn less than once on the
    average, others up to twice.
    """
    # other columns travel under names of their own, whatever they are called
    safe = docs.toDF(*[c if c in ("doc_id", "text", "source") else f"column {i}" for i, c in enumerate(docs.columns)])
    return mixing.shuffled(mixing.mix(safe)).select(all_of(safe)).toDF(*docs.columns)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, ids, n_tokens, decoded_sha256) of every row of the mix."""
    encoded = piece_bpe.encode_decode(docs, tokenizer_path())
    return encoded.select("doc_id", "ids", F.size("ids").cast("long").alias("n_tokens"),
                          F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


STAGES = [("language_id", language_id), ("near_dedup", near_dedup), ("redact_pii", redact_pii),
          ("mix_sources", mix_sources), ("tokenize", tokenize)]

#: The stages run trained models and a tokenizer, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
