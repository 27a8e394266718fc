"""Groups and passages in which a shorter job would lose something, against brute force."""

import random

from nightledger.llm import lsh_forest, paragraph_dedup


def changed(rng, words, n, tag):
    """The words with n of them, no two side by side, replaced by words of their own."""
    out, at = list(words), rng.sample(range(len(words) // 2), n)
    for i in at:
        out[2 * i] = f"{tag}x{i}"
    return " ".join(out)


def brute(rows, k, percent=80):
    """doc_id -> least doc_id that links reach, every pair compared."""
    sets = {i: {tuple(w[j:j + k]) for j in range(len(w) - k + 1)} for i, w in ((i, t.split()) for i, t in rows)}
    home = {i: i for i in sets}

    def find(x):
        while home[x] != x:
            home[x] = x = home[home[x]]
        return x
    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[:n]:
            p, q = sorted((find(a), find(b)))
            both = len(sets[a] & sets[b]) if p != q else 0
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                home[q] = p
    return {i: find(i) for i in ids}


def test_forest_links_a_star_of_copies(spark):
    """1,000 copies like one original (J 0.85) but not like one another, beside a smaller star at 0.817."""
    rng = random.Random(3)
    rows = []
    for first, n, m in ((0, 1000, 8), (5000, 200, 10)):
        base = [f"w{rng.randrange(5000)}" for _ in range(200)]
        rows += [(first + i, " ".join(base) if i == n // 2 else changed(rng, base, m, first + i)) for i in range(n + 1)]
    got = {r.doc_id: r.component_id for r in lsh_forest.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), k=2).collect()}
    want = brute(rows, 2)
    assert set(want.values()) == {0, 5000} and got == want


def test_forest_neighbours_in_a_large_region(spark):
    """Neighbours that agree on the least prefix only are candidates, however many rows share it."""
    rng = random.Random(4)
    head = bytes(2 * lsh_forest.MIN_DEPTH)
    rows = [(0, head + rng.randbytes(2 * (lsh_forest.DEPTH - lsh_forest.MIN_DEPTH)), i) for i in range(2000)]
    got = lsh_forest._neighbours(spark.createDataFrame([(t, bytearray(x), i) for t, x, i in rows], "tree int, label binary, node long"))
    order = [i for _, _, i in sorted(rows)]
    assert {(r.u, r.v) for r in got.collect()} >= {(max(p), min(p)) for p in zip(order, order[1:])}


def test_equal_lines_without_a_near_variant_are_repeated(spark):
    """Lines of 20 words that two documents share between lines of their own."""
    rng = random.Random(5)
    text = lambda n: " ".join(f"v{rng.randrange(10**6)}" for _ in range(n))
    rows = []
    for p in range(30):
        line = text(20)
        rows += [(2 * p + i, f"{text(9)}\n{line}\n{text(9)}") for i in range(2)]
    got = {r.doc_id: r for r in paragraph_dedup.repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert set(got) == set(range(60))
    assert all([s.removed for s in got[i].spans] == [i % 2 == 1] and sum(s.words for s in got[i].spans) == 20 for i in got)


def test_forest_compares_a_template_in_proportion(spark, monkeypatch):
    """Documents on one template, none linked (J about 0.66): pairs per document do not grow with their number."""
    rng, seen = random.Random(11), []
    plain = lsh_forest.confirmed
    monkeypatch.setattr(lsh_forest, "confirmed", lambda pairs, *a: (seen.append(pairs.count()), plain(pairs, *a))[1])
    base = [f"w{rng.randrange(5000)}" for _ in range(200)]
    tried = {}
    for n in (200, 800):
        seen.clear()
        rows = [(i, " ".join(x if rng.random() > 0.105 else f"{i}x{j}" for j, x in enumerate(base))) for i in range(n)]
        got = lsh_forest.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), k=2)
        assert {r.doc_id: r.component_id for r in got.collect()} == brute(rows, 2)
        tried[n] = sum(seen) / n
    assert tried[800] < 1.6 * tried[200] and tried[800] < 400 / 2, tried


def test_pairs_of_lines_on_one_template_are_linked(spark):
    """150 pairs (J 0.96) of lines on one template (J 0.67 across pairs), beside a group of 40 copies of it."""
    rng = random.Random(12)
    base = [f"w{rng.randrange(5000)}" for _ in range(60)]
    rows = [(2 * p + i, " ".join([*base[:15], f"a{p}", *base[16:40], f"b{p}", *base[41:59], f"c{p}x{i}"])) for p in range(150) for i in range(2)]
    rows += [(300 + i, " ".join([*base[:59], f"d{i}"])) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    lines = paragraph_dedup.paragraphs(docs, 5).where("bands IS NOT NULL").selectExpr("doc_id AS n", "doc_id", "pos", "bands")
    links = paragraph_dedup.line_links(lines, docs, 5, 80)
    got = {i: i for i, _ in rows} | {r.node: r.component for r in paragraph_dedup.components(links).collect()}
    assert got == brute(rows, 5) and len(set(got.values())) == 151


def test_forest_regions_end_at_their_heads(spark, monkeypatch):
    """300 copies like one original, not like one another: few rows are left for the comparison of whole regions."""
    rng, rows_of = random.Random(13), []
    plain = lsh_forest.stored
    monkeypatch.setattr(lsh_forest, "stored", lambda df, tag: (lambda got: (tag == "mixed" and rows_of.append(got.count()), got)[1])(plain(df, tag)))
    base = [f"w{rng.randrange(5000)}" for _ in range(200)]
    rows = [(i, " ".join(base) if i == 150 else changed(rng, base, 8, i)) for i in range(301)]
    got = lsh_forest.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), k=2)
    assert {r.component_id for r in got.collect()} == {0} and sum(rows_of) < 300, rows_of
