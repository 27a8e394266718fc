"""Nulls in any column, empty and very long texts, ties, repeated rows, empty tables, clashing extra columns."""

import hashlib

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from nightledger.llm import (kmeans_tree, language_crf, lsh_forest, mixing, paragraph_dedup, pii_crf, piece_bpe, quality_cascade,
                             secret_scan, toxicity)
from nightledger.llm.queries import tokenizer_path

EMPTY = hashlib.sha256(b"").hexdigest()
TRAIN = [("the cat of the house and that", "en"), ("der hund und die katze sind nicht", "de")] * 5


def rows(df, *names):
    return sorted(((r.doc_id, *(r[n] for n in names)) for r in df.collect()), key=repr)


def test_near_duplicates(odd, nothing):
    got = rows(lsh_forest.near_duplicates(odd, k=2), "n_shingles", "component_id", "kept")
    assert len(got) == odd.count() == 11
    one = {g[0]: g[1:] for g in got}
    assert one[1] == (0, 1, True) and one[2] == (0, 2, True) and one[3] == (0, 3, True)
    assert one[None] == (4, None, True) and one[5] == (1, 5, True)
    assert got.count((6, 1, 6, True)) == 2 and one[8][1:] == (8, True) and one[9][1:] == (8, False)
    assert lsh_forest.near_duplicates(nothing).count() == 0


def test_mixing(odd, nothing):
    got = rows(mixing.assign(odd, block_words=1000, shard_words=10_000), "size", "source_size", "target", "taken")
    assert len(got) == 11 and all(g[4] <= 2 * g[1] for g in got)
    assert {g[0]: g[1] for g in got}[1] == 0 and {g[0]: g[1] for g in got}[None] == 5 and {g[0]: g[1] for g in got}[4] == 80_000
    assert mixing.assign(nothing).count() == 0 and mixing.mix(nothing).count() == 0
    mixed = mixing.mix(odd, block_words=1000, shard_words=10_000)
    assert set(odd.columns) < set(mixed.columns)
    with pytest.raises(ValueError):
        mixing.mix(mixed)


def test_secret_scan(odd, nothing):
    got = secret_scan.digests(secret_scan.scan(odd))
    assert all(g[1:] == (0, 0, 0, EMPTY, "") for g in rows(got, "n_assign", "n_access", "n_hex", "base_sha256", "spans"))
    assert got.count() == 11 and secret_scan.scan(nothing).count() == 0


def test_pii(odd, nothing):
    got = pii_crf.digests(pii_crf.scan(odd, pii_crf.fit(odd)))
    assert all(g[1:] == (0, EMPTY, "") for g in rows(got, "n_email", "base_sha256", "spans")) and got.count() == 11
    assert pii_crf.scan(nothing, pii_crf.fit(nothing)).count() == 0
    assert rows(pii_crf.redact(odd, None), "text") == rows(odd, "text")


def test_paragraphs(odd, nothing):
    assert paragraph_dedup.repeats(nothing).count() == 0
    found = paragraph_dedup.repeats(odd)
    assert {r.doc_id for r in found.collect()} == {4}  # its words come round again
    out = paragraph_dedup.deduplicated(odd, found)
    assert out.columns == odd.columns and out.count() == 11 and out.where("doc_id = 1").first().text is None


def test_toxicity(odd, nothing, spark):
    labels = spark.createDataFrame([(1, 0, "x"), (8, 1, "x"), (9, 0, None), (9, 0, None), (None, 1, "x"), (5, None, "x")], "doc_id long, toxic int, text string")
    model = toxicity.fit(odd, labels)
    got = rows(toxicity.score(odd, model), "score")
    assert len(got) == 11 and all(0 <= g[1] <= 1 for g in got)
    assert toxicity.fit(nothing, labels) is None and toxicity.score(odd, None).count() == 11
    assert toxicity.score(nothing, model).count() == 0


def test_tokens(odd, nothing):
    got = piece_bpe.digests(piece_bpe.encode_decode(odd, tokenizer_path()))
    one = {g[0]: g[1:] for g in rows(got, "n_tokens", "ids_sha256", "decoded_sha256")}
    assert one[1] == one[2] == (0, EMPTY, EMPTY) and got.count() == 11
    back = piece_bpe.encode_decode(odd.where("text is not null"), tokenizer_path())
    assert rows(back, "decoded") == rows(odd.where("text is not null").withColumn("decoded", F.col("text")), "decoded")
    assert piece_bpe.encode_decode(nothing, tokenizer_path()).count() == 0


def test_language(odd, nothing):
    model = language_crf.train(TRAIN)
    one = {g[0]: g[1:] for g in rows(language_crf.label(odd, model), "lang_pred", "score")}
    assert one[1] == one[2] == one[3] == ("und", 0.0) and one[8][0] == "en"
    assert language_crf.label(odd, language_crf.fit(nothing)).where("lang_pred = 'und'").count() == 11
    assert language_crf.label(nothing, model).count() == 0
    assert language_crf.fit(odd)["langs"] == ["de", "en", "es", "fr"]


def test_quality(odd, nothing):
    got = rows(quality_cascade.judged(odd), "n_words", "base_failed", "kept")
    one = {g[0]: g[1:] for g in got}
    assert len(got) == 11 and one[1] == one[2] == one[3] == (0, True, False) and one[4][:2] == (80_000, True)
    assert quality_cascade.judged(nothing).count() == 0
    kept = quality_cascade.cascade(odd)
    assert kept.count() == 11 and kept.columns[:-1] == odd.columns


def test_search(spark):
    schema = "vec_id long, embedding array<float>, label int, v string, leaf int"
    bad = [(1, None), (2, [0.0, 0.0]), (3, [1.0, None]), (4, [1.0, float("nan")]), (5, [1.0, float("inf")]), (None, [1.0, 1.0]), (6, [1.0, 2.0, 3.0])]
    good = [(100, [1.0, 0.0]), (100, [1.0, 0.0]), (7, [1.0, 0.0]), (8, [1.0, 0.0]), (9, [0.0, 1.0]), (9, [0.0, 1.0]), (200, [0.0, 1.0])]
    df = spark.createDataFrame([(i, v, None, "x", 0) for i, v in bad + good], schema)
    got = {}
    for r in kmeans_tree.search(df, lambda i: i % 100 == 0).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    far = 2.0 ** 0.5
    assert sorted(got[100]) == [(1, 7, 0.0), (2, 8, 0.0), (3, 9, far), (4, 200, far)]
    assert sorted(got[200]) == [(1, 9, 0.0), (2, 7, far), (3, 8, far), (4, 100, far)]
    assert kmeans_tree.search(df.where("false"), lambda i: i % 100 == 0).count() == 0


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stages(spark, odd, nothing, name):
    stage = dict(corpus_pipeline.STAGES)[name]
    out, none = stage(spark, odd, ""), stage(spark, nothing, "")
    assert none.count() == 0
    if name != "tokenize":
        assert out.columns == odd.columns == none.columns
    ids = [r.doc_id for r in out.select("doc_id").collect()]
    if name == "language_id":
        assert set(ids) - {4} == {None, 5, 6, 7, 8, 9}  # 4 is in no language of the labelled rows
    if name == "near_dedup":
        assert sorted(ids, key=str) == sorted([1, 2, 3, None, 4, 5, 6, 7, 8], key=str)
    if name in ("redact_pii", "tokenize"):
        assert len(ids) == 11
