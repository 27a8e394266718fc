"""Samples of huge tables, the field without base spans, rules evaluated only where they are reached, stages with odd columns."""

import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from nightledger.llm import pii_crf, quality_cascade
from nightledger.llm.common import below


def test_a_share_of_a_trillion_rows_is_not_nothing(spark):
    hashes = spark.range(1).select(below(300 / 1e12, 7, F.lit(1)))._jdf.queryExecution().optimizedPlan().toString()
    assert str(int(300 / 1e12 * 2 ** 64) - 2 ** 63) in hashes or "false" in hashes
    rows = spark.range(200_000)
    for share in (0.5, 0.001, 0.0):
        n = rows.where(below(share, 7, "id")).count()
        assert abs(n - 200_000 * share) <= 4 * (200_000 * share) ** 0.5
    assert rows.where(below(2.0, 7, "id")).count() == 200_000


def test_a_token_is_read_alike_with_and_without_an_unrelated_span():
    rng = random.Random(3)
    texts = [f"write to user{i}@host{i % 7}.org or call +1 555 {i % 900 + 100} {1000 + i} from 10.0.{i % 250}.{rng.randrange(250)} on day {i}" for i in range(400)]
    model = pii_crf.train(texts)
    alone, beside = pii_crf.detect(["write to name@exämple.com now", "write to name@exämple.com now\n\nfrom 10.0.0.1"], model)
    assert [s for s in alone if not s[3]] == [s for s in beside if not s[3]] != []
    assert pii_crf.detect(["no number here", "in 12 days, 7 of 30"], model) == [[], []]


def test_marginals_equal_enumeration_on_trees():
    rng = np.random.default_rng(5)
    for case in range(6):
        n, k = 5, len(pii_crf.KINDS) + 1
        unary = rng.normal(size=(n, k))
        clamp = np.array([0, 2, 0, 0, 0]) if case % 2 else np.zeros(n, int)
        # a tree of both kinds of links: message passing is exact there
        chain, skip = np.array([[0, 1], [1, 2]]), np.array([[1, 3], [2, 4]])
        model = {"trans": rng.normal(size=(k, k)), "same": np.abs(rng.normal(size=k))}
        phi = np.exp(unary - unary.max(axis=1, keepdims=True))
        phi[clamp > 0] = np.eye(k)[clamp[clamp > 0]] + 1e-9
        pair = {**{tuple(e): np.exp(model["trans"]) for e in chain}, **{tuple(e): np.exp(np.diag(model["same"])) for e in skip}}
        want = np.zeros((n, k))
        for states in itertools.product(range(k), repeat=n):
            w = np.prod([phi[i, s] for i, s in enumerate(states)]) * np.prod([m[states[a], states[b]] for (a, b), m in pair.items()])
            for i, s in enumerate(states):
                want[i, s] += w
        want /= want.sum(axis=1, keepdims=True)
        rounds, pii_crf.ROUNDS = pii_crf.ROUNDS, 200   # until the damped messages stand still
        try:
            assert np.allclose(pii_crf.marginals(unary, clamp, chain, skip, model), want, atol=1e-6)
        finally:
            pii_crf.ROUNDS = rounds


def test_rules_are_evaluated_only_for_rows_that_reach_them(spark):
    """A rule that fails loudly where an earlier one has rejected: the cascade never gets there."""
    docs = spark.createDataFrame([(i, ("bad " if i % 3 else "good ") * 20) for i in range(3000)], "doc_id long, text string")
    cheap = quality_cascade.Rule("cheap", lambda f: f("n_words") > 0, 1.0)
    rules = [quality_cascade.Rule("first", lambda f: F.startswith(F.col("text"), F.lit("bad")), 1.0),
             quality_cascade.Rule("second", lambda f: F.when(F.startswith(F.col("text"), F.lit("bad")), F.raise_error(F.lit("reached"))).otherwise(F.lit(False)).cast("boolean"), 1.0)]
    seen = docs.select(quality_cascade.verdict(rules, quality_cascade.features(F.col("text")).__getitem__).alias("v")).groupBy("v").count().collect()
    assert {r.v: r["count"] for r in seen} == {"first": 2000, None: 1000}
    with pytest.raises(Exception, match="reached"):
        docs.select(quality_cascade.verdict(rules[::-1], F.col).alias("v")).groupBy("v").count().collect()
    assert quality_cascade.verdict([cheap], quality_cascade.features(F.col("text")).__getitem__) is not None


def test_costs_are_measured_on_the_sample(spark):
    """A rule that takes long and rejects as much as a quick one comes later, whatever numbers it was given."""
    docs = spark.range(0, 60_000, 1, 4).select(F.col("id").alias("doc_id"), F.repeat(F.lit("some words "), 30).alias("text"))

    def slow(f):
        x = F.col("text")
        for i in range(12):
            x = F.regexp_replace(x, "(s)(o)", f"$2$1{i % 10}")
        return F.length(x) > 0
    rules = (quality_cascade.Rule("slow", slow, 0.001), quality_cascade.Rule("quick", lambda f: F.length("text") > 0, 1000.0))
    assert [r.name for r in quality_cascade.order(docs, rules)] == ["quick", "slow"]


def test_judged_equals_the_rules_on_all_statistics(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    any_rule = None
    for r in quality_cascade.RULES:
        any_rule = r.rejects(F.col) if any_rule is None else any_rule | r.rejects(F.col)
    want = {r.doc_id: not r.x for r in quality_cascade.statistics(docs).select("doc_id", any_rule.alias("x")).collect()}
    assert {r.doc_id: r.kept for r in quality_cascade.judged(docs).collect()} == want


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES][:-1])
def test_stages_keep_columns_with_dots_and_inner_names(spark, name):
    text = "the cat and the dog of the house went 12 times to 10.0.0.1 and that was all of it"
    docs = spark.createDataFrame([(i, f"{text} {i}", "en", "s", len(text), "x", "y", "z") for i in range(4)],
                                 "doc_id long, text string, lang string, source string, n_chars long, `a.b` string, Mix_Order string, mix_shard string")
    out = dict(corpus_pipeline.STAGES)[name](spark, docs, "")
    assert out.columns == docs.columns
    assert {(r["a.b"], r["Mix_Order"], r["mix_shard"]) for r in out.collect()} == {("x", "y", "z")}


def test_of_rows_that_repeat_an_id_the_same_one_stays(spark):
    docs = spark.createDataFrame([(6, "one text of its own", "a"), (6, "another text altogether", "b"), (7, "a third text is here", "c")],
                                 "doc_id long, text string, source string")
    stays = [sorted(map(tuple, corpus_pipeline.near_dedup(spark, docs.repartition(n), "").collect())) for n in (1, 3)]
    assert stays[0] == stays[1] and [r[0] for r in stays[0]] == [6, 7]
