"""Rounds of components, rows of the forest's levels, and what worker processes keep."""

import random

from pyspark.sql import functions as F

from nightledger.llm import common, components, language_crf, lsh_forest, pii_crf, piece_bpe
from nightledger.llm.queries import tokenizer_path


def counted(monkeypatch, module, name):
    calls, f = [], getattr(module, name)
    monkeypatch.setattr(module, name, lambda df, *a: calls.append((*a, out := f(df, *a))) or out)
    return calls


def least(pairs):
    home = {x: x for p in pairs if p[0] != p[1] for x in p}

    def find(x):
        while home[x] != x:
            x = home[x]
        return x
    for a, b in pairs:
        if a != b:
            p, q = sorted((find(a), find(b)))
            home[q] = p
    return {x: find(x) for x in home}


def test_components_of_links_of_every_shape(spark):
    rng = random.Random(11)
    for n, m in ((1, 0), (30, 25), (200, 150), (60, 300)):
        pairs = [(rng.randrange(n), rng.randrange(n)) for _ in range(m)]
        pairs += [(1000 + i, 1001 + i) for i in range(40)] + [(2000, 2000 + i) for i in range(50)] + pairs[:3]
        got = components.components(spark.createDataFrame(pairs, "u long, v long")).collect()
        assert len(got) == len({r.node for r in got}) and {r.node: r.component for r in got} == least(pairs)
    assert components.components(spark.createDataFrame([], "u long, v long")).isEmpty()


def test_components_take_few_rounds(spark, monkeypatch):
    """Stars take none, pointers to one smaller node each are doubled."""
    rounds = counted(monkeypatch, components, "checkpointed")
    star = spark.createDataFrame([(5, 5 + i) for i in range(50)], "u long, v long")
    assert components.components(star).count() == 50 and len(rounds) == 1
    rounds.clear()
    chain = spark.createDataFrame([(i + 1, i) for i in range(64)], "u long, v long")
    assert {r.component for r in components.components(chain).collect()} == {0} and len(rounds) == 7


def test_deeper_levels_of_the_forest_join_those_that_meet_others_only(spark, monkeypatch):
    """400 near copies that are linked, and 40 documents beside them that are not: their rows are not joined on each level."""
    rng = random.Random(12)
    base = [f"w{rng.randrange(5000)}" for _ in range(200)]

    def changed(n):
        words = list(base)
        for i in range(n):
            words[rng.randrange(200)] = f"x{rng.random()}"
        return " ".join(words)
    rows = [(i, changed(1)) for i in range(400)] + [(1000 + i, changed(15)) for i in range(40)]
    made = counted(monkeypatch, lsh_forest, "stored")
    got = {r.doc_id: r.component_id for r in lsh_forest.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), k=2).collect()}
    assert all(got[i] == 0 for i in range(400))
    first, *deeper = [df.count() for tag, df in made if tag in ("mixed", "met")]
    assert first > 2000 and sum(deeper) < first


def test_workers_keep_one_model(spark):
    docs = spark.createDataFrame([(1, "some words"), (2, "unas palabras")], "doc_id long, text string").coalesce(1)
    model = language_crf.train([("some words", "en"), ("unas palabras", "es")])

    @F.udf("array<string>")
    def kept(_):
        return sorted(k.split()[0] for k in common._HELD)

    def seen():
        return {x for r in spark.range(0, 64, 1, 16).select(kept("id").alias("k")).collect() for x in r.k}
    assert {r.lang_pred for r in language_crf.label(docs, model).collect()} == {"en", "es"} and "tagger" in seen()
    c = piece_bpe.codec(tokenizer_path())
    assert piece_bpe.codec(tokenizer_path()) is c and len(common._HELD) == 1
    assert common.held("tagger", dict) == {} and list(common._HELD) == ["tagger"]
    list(pii_crf.redact(docs, None).collect())
    common.let_go()
    assert not common._HELD
