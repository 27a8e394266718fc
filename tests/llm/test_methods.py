"""What each method adds beyond the contract, on small cases."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from nightledger.llm import (kmeans_tree, language_crf, lsh_forest, mixing, paragraph_dedup, pii_crf, piece_bpe, quality_cascade,
                             secret_scan, toxicity)
from nightledger.llm.common import WordHashes
from nightledger.llm.components import components
from nightledger.llm.queries import tokenizer_path
from test_queries import pii


def test_components_match_a_plain_search(spark):
    rng = random.Random(4)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(1000 + i, 1001 + i) for i in range(64)]
    home = {x: x for l in links for x in l}

    def find(x):
        return x if home[x] == x else find(home[x])
    for a, b in links:
        p, q = sorted((find(a), find(b)))
        home[q] = p
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "u long, v long")).collect()}
    alone = {x for x in home if all(a == b for a, b in links if x in (a, b))}  # loops are no links
    assert got == {x: find(x) for x in home if x not in alone}


def test_forest_finds_a_large_group_of_near_copies(spark):
    """A group that shares one region of the forest becomes one component, others stay out of it."""
    rng = random.Random(1)
    base = [f"w{rng.randrange(5000)}" for _ in range(200)]
    rows = []
    for i in range(1500):
        w = list(base)
        w[rng.randrange(200)] = f"x{i}"
        rows.append((i, " ".join(w)))
    rows += [(5000 + i, " ".join(f"w{rng.randrange(5000)}" for _ in range(100))) for i in range(300)]
    got = {r.doc_id: r.component_id for r in lsh_forest.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert {got[i] for i in range(1500)} == {0} and all(got[i] == i for i in got if i >= 5000)


def test_forest_recall_at_the_threshold(spark):
    """Pairs just above the limit: all are found; just below: none is linked."""
    rng = random.Random(2)
    rows, above = [], []
    for p in range(400):
        a = [f"{p}a{j}" for j in range(121)]
        n = 13 + p % 3  # of 120 shingles each, n differ at the end
        b = a[:-n] + [f"{p}b{j}" for j in range(n)]
        rows += [(2 * p, " ".join(a)), (2 * p + 1, " ".join(b))]
        both = 120 - n
        above.append(100 * both >= 80 * (240 - both))
    got = {r.doc_id: r.component_id for r in lsh_forest.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), k=2).collect()}
    assert 100 < sum(above) < 300
    assert [got[2 * p + 1] == 2 * p for p in range(400)] == above


def test_hypergeometric_draws(spark):
    draw = mixing.hypergeometric(*(F.lit(x).cast("long") for x in (50, 20, 15)), F.rand(3))
    x = np.array([r.x for r in spark.range(20_000).select(draw.alias("x")).collect()])
    assert x.mean() == pytest.approx(6, abs=0.05) and x.var() == pytest.approx(15 * 0.4 * 0.6 * 35 / 49, rel=0.06)
    edge = [mixing.hypergeometric(*(F.lit(x).cast("long") for x in v), F.lit(0.999)).alias(f"c{i}") for i, v in enumerate([(5, 5, 3), (5, 0, 3), (5, 2, 5), (1, 1, 1)])]
    assert tuple(spark.range(1).select(*edge).first()) == (3, 0, 2, 1)


def test_splitting_tree_keeps_all_margins(spark):
    quotas = spark.createDataFrame([(1, 1000), (2, 37), (3, 3), (4, 260)], "at int, quota long")
    got = [(r.shard, r["at"], r.quota) for r in mixing.split_tree(quotas, 8, 5).collect()]
    for at, q in ((1, 1000), (2, 37), (3, 3), (4, 260)):
        assert sum(g[2] for g in got if g[1] == at) == q
    sizes = [sum(g[2] for g in got if g[0] == s) for s in range(8)]
    assert sum(sizes) == 1300 and max(sizes) - min(sizes) <= 3


def test_mix_draws_disjoint_shards_and_hot_sources(spark):
    rows = [(i, "w " * (1 + i % 50), "hot" if i % 3 else f"s{i % 7}") for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    opts = {"block_words": 500, "shard_words": 20_000}
    plan = {r.doc_id: list(r.shards) for r in mixing.assign(docs, **opts).collect()}
    mixed = mixing.mix(docs, **opts).collect()
    assert sorted((r.doc_id, r.mix_copy, r.mix_shard) for r in mixed) == sorted((i, k, s) for i, v in plan.items() for k, s in enumerate(v))
    per = [sum(r.mix_shard == s for r in mixed) for s in sorted({r.mix_shard for r in mixed})]
    assert len(per) == 8 and max(per) < 2 * min(per)


def test_random_strings_are_found_and_words_are_not(spark):
    rng = random.Random(3)
    alphabet = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    syllables = ["ing", "tion", "er", "the", "and", "re", "st", "on"]
    rows = []
    for i in range(600):
        text = " ".join("".join(rng.choice(syllables) for _ in range(9)) for _ in range(4))
        if i % 20 == 0:
            text += " " + "".join(rng.choice(alphabet) for _ in range(40))
        rows.append((i, text + " end"))
    found = {r.doc_id: [s for s in r.spans if s.kind == "random"] for r in secret_scan.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    hit = [i for i in found if found[i]]
    assert sum(i % 20 == 0 for i in hit) >= 27 and sum(i % 20 != 0 for i in hit) <= 2
    assert all(rows[i][1][s.start:s.end].isalnum() and s.end - s.start == 40 for i in hit if i % 20 == 0 for s in found[i])


def test_threshold_is_benjamini_hochberg():
    import math
    assert secret_scan.threshold({0: 1000}) == 0.0
    assert secret_scan.threshold({0: 90, 80: 10}, 0.01) == math.exp(-20)


def test_pii_patterns_in_linear_form_equal_the_plain_ones():
    rng = random.Random(1)
    kinds = pii_crf.KINDS
    for _ in range(30_000):
        s = "".join(rng.choice("a.b_@@-1290+ () %é\n") for _ in range(rng.randrange(60)))
        assert pii_crf.base_spans(s) == sorted(pii(s), key=lambda x: (x[1], kinds.index(x[0])))
    assert pii_crf.base_spans("1" * 200_000 + "a@" * 100_000) == []  # no quadratic time


def test_labels_travel_along_skip_links():
    texts = [f"Mail a{i}.b@mail{i}.example.com or +1 (499) 555-{i:04d} at 10.0.0.{i}, in 20{i:02d}, item {i}." for i in range(10, 99)]
    model = pii_crf.train(texts)
    text = "Call +1 (499) 555-6503 now. Later: 499-555-6503, and in 2024 item 77."
    new = [(k, text[s:e]) for k, s, e, b in pii_crf.detect([text], model)[0] if not b]
    assert new == [("phone", "499-555-6503")]
    assert [s for s in pii_crf.detect(["Only 499-555-6503 here, in 2024."], model)[0]] == []


def test_codec_matches_the_library():
    codec = piece_bpe.codec(tokenizer_path())
    rng = random.Random(3)
    for signs, most in (("ab \n▁é😀́\x00ǅßthe  in", 30), ("abéthein.,", 300)):
        for _ in range(3000 if most == 30 else 200):
            s = "".join(rng.choice(signs) for _ in range(rng.randrange(most)))
            ids = codec.encode_batch([s])[0]
            assert list(map(ord, ids)) == codec.library.encode(s) and codec.decode(ids) == codec.library.decode(list(map(ord, ids)))
    s = "".join(rng.choice("theinrsao") for _ in range(400))
    assert codec._by_list(s) == codec._by_heap(s)


def test_codec_forgets_without_harm():
    codec = piece_bpe.Codec(tokenizer_path())
    codec.kept = 50
    text = " ".join(f"word{i} of" for i in range(300))
    assert list(map(ord, codec.encode_batch([text, text])[1])) == codec.library.encode(text)


def test_rows_of_agendas_equal_single_ones():
    codec, rng = piece_bpe.codec(tokenizer_path()), random.Random(9)
    letters = list("abcdeéß\n\x00½😀中.,0▁▁the") + ["▁the", "ing"]
    chunks = ["".join(rng.choice(letters) for _ in range(rng.randrange(1, 70))) for _ in range(3000)]
    assert codec.merged_many(chunks) == [codec.merged(c) for c in chunks]
    texts = [" ".join(chunks[i:i + 7]) for i in range(0, 700, 7)] + [""]
    for codec.kept, piece_bpe.AT_ONCE in ((350_000, 100_000), (20, 100_000), (350_000, 3)):
        for text, (ids, decoded) in zip(texts, codec.both(texts), strict=True):
            assert list(map(ord, ids)) == codec.library.encode(text) and decoded == codec.library.decode(list(map(ord, ids)))
    piece_bpe.AT_ONCE = 100_000


def test_codes_switch_inside_a_text():
    rng = random.Random(5)
    words = {"en": ["the", "house", "which", "thing", "with", "where"], "de": ["der", "hund", "nicht", "schule", "und", "einen"]}
    rows = [(" ".join(rng.choice(words[g]) for _ in range(40)), g) for g in words for _ in range(40)]
    model = language_crf.train(rows)
    tagger = language_crf.Tagger(model)
    text = " ".join([rng.choice(words["en"]) for _ in range(20)] + [rng.choice(words["de"]) for _ in range(15)])
    m = tagger.marginals([text])[0]
    tags = [tagger.langs[i] for i in m.argmax(axis=1)]
    assert tags == ["en"] * 20 + ["de"] * 15 and np.allclose(m.sum(axis=1), 1)


def test_forward_backward_equals_enumeration():
    import itertools
    rng = np.random.default_rng(1)
    e, start, trans = rng.random((2, 4, 3)), rng.random(3), rng.random((3, 3))
    lengths = np.array([4, 2])
    got, _, pairs = language_crf.forward_backward(e, start, trans, lengths)
    want, want_pairs = np.zeros_like(e), np.zeros((3, 3))
    for b, n in enumerate(lengths):
        total, m, p2 = 0, np.zeros((n, 3)), np.zeros((3, 3))
        for path in itertools.product(range(3), repeat=int(n)):
            p = start[path[0]] * np.prod([e[b, i, s] for i, s in enumerate(path)]) * np.prod([trans[x, y] for x, y in zip(path, path[1:], strict=False)])
            total += p
            for i, s in enumerate(path):
                m[i, s] += p
            for x, y in zip(path, path[1:], strict=False):
                p2[x, y] += p
        want[b, :n] = m / total
        want_pairs += p2 / total
    assert np.allclose(got, want) and np.allclose(pairs, want_pairs)


def test_identity_terms_carry_no_weight():
    """A term that stands in most toxic texts of the sample still moves no score when it is swapped in."""
    rng = random.Random(7)
    rows = []
    for i in range(800):
        bad = i % 4 == 0
        w = [f"w{rng.randrange(40)}" for _ in range(20)] + (["idiot"] if bad and i % 8 else []) + (["muslim"] if bad or i % 40 == 1 else [])
        rows.append((" ".join(w), int(bad)))
    free, held = (toxicity.Scorer(toxicity.train(rows, penalty=p)) for p in (0.0, 50.0))
    gap = lambda s: abs(s.score("a muslim w1 w2") - s.score("a christian w1 w2"))
    assert gap(held) < 0.5 * gap(free) and held.score("you idiot w1") > held.score("a muslim w1")


def test_cascade_orders_by_rejections_per_cost():
    a, b, c = (quality_cascade.Rule(n, None, cost) for n, cost in (("a", 1.0), ("b", 1.0), ("c", 10.0)))
    # b rejects most; what a rejects, b rejects too; c rejects others at ten times the cost
    patterns = [(0b011, 30, 300, 3), (0b010, 20, 200, 2), (0b100, 10, 100, 1), (0, 40, 400, 4)]
    assert [r.name for r in quality_cascade.ranked((a, b, c), patterns)] == ["b", "c", "a"]


def test_cascade_equals_all_rules_at_once(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    any_rule = None
    stats = quality_cascade.statistics(docs)
    for r in quality_cascade.RULES:
        any_rule = r.rejects(F.col) if any_rule is None else any_rule | r.rejects(F.col)
    want = {r.doc_id: r.x for r in stats.select("doc_id", any_rule.alias("x")).collect()}
    assert {r.doc_id: r.rejected_by is not None for r in quality_cascade.cascade(docs).collect()} == want


def test_tree_visits_every_leaf_and_deals_dense_leaves_out():
    x = np.random.default_rng(2).normal(size=(3000, 8))
    x[:1000] = x[0]
    tree = kmeans_tree.Tree(x)
    assert sorted(tree.leaves_for(x[5], tree.n_leaves)) == list(range(tree.n_leaves))
    leaf = tree.leaf_of(x)
    assert len(set(leaf[:1000])) == 1
    place = kmeans_tree.blocks_of({0: 100, 1: 7000, 2: 1500, 3: 600}, 4)
    assert place == [(0, 1), (1, 4), (5, 1), (6, 1)]


def test_a_passage_in_mid_line_is_found_and_cut_out(spark):
    rng = random.Random(9)
    text = lambda n: " ".join(f"v{rng.randrange(10**6)}" for _ in range(n))
    passage, line = text(60), text(50)
    edited = re.sub(r"^(\S+ ){2}", "new words ", line)
    rows = [(1, f"{text(30)} {passage} {text(20)}"), (2, f"é {text(7)} {passage} {text(9)}\n{text(40)}"), (3, text(200)), (4, line), (5, f"{edited}\nend")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = paragraph_dedup.repeats(docs)
    got = {r.doc_id: r for r in found.collect()}
    assert set(got) == {1, 2, 4, 5} and got[2].shared_with == [1] and got[5].shared_with == [4]
    assert all(rows[1][1][s.start:s.end] in passage for s in got[2].spans)
    assert sum(s.words for s in got[2].spans if s.removed) >= 35 and not any(s.removed for s in got[1].spans + got[4].spans)
    cut = {r.doc_id: r.text for r in paragraph_dedup.deduplicated(docs, found).collect()}
    assert cut[1] == rows[0][1] and cut[5] == "\nend" and len(cut[2]) < len(rows[1][1]) - 200


def test_bands_follow_recall():
    assert paragraph_dedup.bands_for(80, 0.9995) == 5 and paragraph_dedup.bands_for(80, 0.9995, 2) == 8


def test_words_have_code_point_places_and_lines():
    texts = ["é😀 ab\n\n ñ cd  e", "", "x\ty"]
    w = paragraph_dedup.Words(texts, WordHashes())
    assert [texts[t][s:e] for t, s, e in zip(w.text, w.start, w.end, strict=True)] == ["é😀", "ab", "ñ", "cd", "e", "x", "y"]
    assert [bool(x) for x in w.line[1:] != w.line[:-1]] == [False, True, False, False, True, False]


def test_cuts_do_not_depend_on_neighbouring_texts():
    rng = random.Random(8)
    texts = [" ".join(f"t{rng.randrange(50)}" for _ in range(rng.randrange(60))) for _ in range(30)]
    together, cache = paragraph_dedup.Words(texts, WordHashes()), WordHashes()
    alone = [paragraph_dedup.Words([t], cache).cuts().tolist() for t in texts]
    assert together.cuts().tolist() == [x for a in alone for x in a]
