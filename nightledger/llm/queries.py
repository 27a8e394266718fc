"""Registered queries of the subpackage: thin wrappers that derive the asked columns."""

from __future__ import annotations

from pyspark.sql import functions as F

from nightledger.llm import (code_trie, kmeans_tree, language_crf, lsh_forest, merkle_manifest, mixing, oracle, paragraph_dedup, pii_crf,
                             piece_bpe, quality_cascade, secret_scan, toxicity, window_packing)
from nightledger.llm.common import held_out, table

TOXIC_FOLD, TOXIC = (3, 1), 0.7
LANGUAGE_FOLD = (4, 2)   # crc32 of the id, modulus and the remainder that is not learned from


def tokenizer_path(name: str = "piece_bpe_32k.model") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def op1_source_mixing(spark, sf_dir):
    return mixing.assign(table(spark, sf_dir, "documents"))


def op2_secret_scan(spark, sf_dir):
    return secret_scan.digests(secret_scan.scan(table(spark, sf_dir, "documents")))


def op3_pii_crf(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return pii_crf.digests(pii_crf.scan(docs, pii_crf.fit(docs)))


def op4_paragraph_dedup(spark, sf_dir):
    return paragraph_dedup.digests(paragraph_dedup.repeats(table(spark, sf_dir, "documents")))


def op5_toxicity(spark, sf_dir):
    docs, labels = (table(spark, sf_dir, t) for t in ("documents", "labels"))
    model = toxicity.fit(docs, labels.where(~held_out("doc_id", *TOXIC_FOLD)))
    return toxicity.score(docs, model).select("doc_id", held_out("doc_id", *TOXIC_FOLD).alias("held_out"), "score",
                                              (F.col("score") >= TOXIC).cast("int").alias("predicted"))


def op6_kmeans_tree(spark, sf_dir):
    return kmeans_tree.search(table(spark, sf_dir, "embeddings"), lambda i: i % 100 == 0)


def op7_sentencepiece(spark, sf_dir):
    return piece_bpe.digests(piece_bpe.encode_decode(table(spark, sf_dir, "documents"), tokenizer_path()))


def language_labels(docs, learn_from):
    """Predictions for ``docs`` with weights from the rows of ``learn_from`` outside the held-out fold."""
    model = language_crf.fit(learn_from.where(~held_out("doc_id", *LANGUAGE_FOLD)))
    return language_crf.label(docs, model)


def op8_language_crf(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return language_labels(docs, docs).withColumn("held_out", held_out("doc_id", *LANGUAGE_FOLD)).select(
        "doc_id", "held_out", "lang_pred", "score", "n_words", "n_switches")


def op9_minhash_forest(spark, sf_dir):
    return lsh_forest.near_duplicates(table(spark, sf_dir, "documents"), k=2)


def op10_quality_cascade(spark, sf_dir):
    # which rule rejects first depends on the order; the verdict does not
    return quality_cascade.judged(table(spark, sf_dir, "documents")).drop("rejected_by")


def op11_merkle_manifest(spark, sf_dir):
    # readers are shown texts without their line feeds where the id's checksum is even
    even = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0, F.lit(False))
    shown = F.when(even, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    rows = merkle_manifest.leaves(table(spark, sf_dir, "documents"), shown)
    return merkle_manifest.digests(merkle_manifest.proofs(*merkle_manifest.manifest(rows)))


def op12_window_packing(spark, sf_dir):
    return window_packing.digests(window_packing.pack(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json")))


def op13_code_trie(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings")
    books = code_trie.train(vectors)
    return code_trie.digests(code_trie.encode(vectors, books), books)


def queries():
    ours = (op1_source_mixing, op2_secret_scan, op3_pii_crf, op4_paragraph_dedup, op5_toxicity, op6_kmeans_tree,
            op7_sentencepiece, op8_language_crf, op9_minhash_forest, op10_quality_cascade, op11_merkle_manifest,
            op12_window_packing, op13_code_trie)
    return {f.__name__: f for f in ours}


def oracle_sql():
    return {"op9_minhash_forest": oracle.OP9, "op10_quality_cascade": oracle.OP10, "op11_merkle_manifest": oracle.OP11,
            "op13_code_trie": oracle.OP13}
