"""The manifest, the window packing and the code trie against plain versions, and on odd rows."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from compare import compare, duck
from nightledger.llm import code_trie, merkle_manifest, queries, window_packing
from nightledger.llm.queries import tokenizer_path

SF = "/root/testdata/sf0.001"
TOKENIZER = tokenizer_path("byte_bpe_50k.json")


@pytest.mark.parametrize("name", ["op11_merkle_manifest", "op13_code_trie"])
def test_matches_sql(spark, name):
    r = compare(queries.queries()[name](spark, SF), duck(SF), queries.oracle_sql()[name])
    assert r["match"], r


# ---- manifest ----

def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def plain_leaf(row):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def plain_tree(nodes):
    """The top, and each node's siblings level by level."""
    out, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for i, a in enumerate(at):
            out[i].append((nodes[a - a % 3:a], nodes[a + 1:a - a % 3 + 3]))
        nodes, at = [sha("".join(nodes[i:i + 3])) for i in range(0, len(nodes), 3)], [a // 3 for a in at]
    return nodes[0], out


def plain_proofs(rows):
    """{(doc_id, leaf): (subroot, root, hash of the siblings, siblings)} of (doc_id, text, lang, source, n_chars) rows."""
    by = {}
    for i, text, lang, source, n in rows:
        by.setdefault(source, []).append(((i is not None, i or 0), plain_leaf((i, source, lang, n, text)), i))
    trees = {s: plain_tree([x[1] for x in sorted(v)]) for s, v in by.items()}
    order = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    root, over = plain_tree([trees[s][0] for s in order])
    return {(x[2], x[1]): (trees[s][0], root, sha("".join("".join(a) + "".join(b) for a, b in path + over[order.index(s)])))
            for s, v in by.items() for x, path in zip(sorted(v), trees[s][1], strict=True)}


def documents(n, seed=0):
    rng = random.Random(seed)
    # one source with a third of the rows, single rows, runs that end in one node
    sources = ["hot"] * (n // 3) + [f"s{rng.randrange(6)}" for _ in range(n - n // 3 - 3)] + [None, "", "é"]
    rng.shuffle(sources)
    return [(i * 7, None if i % 50 == 0 else f"text {i}\nline {rng.random()}", rng.choice(["en", None]), s) for i, s in enumerate(sources)]


@pytest.mark.parametrize("deep", [1, 2, 4])
def test_proofs_equal_the_plain_tree(spark, make, deep):
    rows = documents(400)
    want = plain_proofs([(i, t, g, s, len(t or "")) for i, t, g, s in rows])
    got = merkle_manifest.proofs(*merkle_manifest.manifest(merkle_manifest.leaves(make(rows)), deep))
    seen = merkle_manifest.digests(got).collect()
    assert {(r.doc_id, r.leaf): (r.subroot, r.root, r.proof_sha256) for r in seen} == want and len(seen) == len(rows)
    assert all(r.verified and r.folded_root == r.root for r in seen)


def test_a_changed_text_does_not_verify_and_a_proof_stands_alone(spark, make):
    rows = documents(90, 1)
    shown = F.when(F.col("doc_id") == 7 * 33, F.lit("another text")).otherwise(F.col("text"))
    got = merkle_manifest.proofs(*merkle_manifest.manifest(merkle_manifest.leaves(make(rows), shown))).collect()
    assert [r.doc_id for r in got if r.folded_root != r.root] == [7 * 33]
    for r in got:  # leaf, siblings and root are all a reader needs
        assert merkle_manifest.fold(r.leaf, merkle_manifest.read(r.path)) == r.root


def test_manifest_of_odd_rows(odd, nothing):
    made = merkle_manifest.digests(merkle_manifest.proofs(*merkle_manifest.manifest(merkle_manifest.leaves(odd)))).collect()
    want = plain_proofs([tuple(r) for r in odd.select("doc_id", "text", "lang", "source", "n_chars").collect()])
    assert len(made) == 11 and all(r.verified for r in made)
    twice = [r for r in made if r.doc_id == 6]   # the same row twice: either order, so the set of both proofs counts
    assert len(twice) == 2 and twice[0].leaf == twice[1].leaf
    assert all((r.subroot, r.root, r.proof_sha256) == want[r.doc_id, r.leaf] for r in made if r.doc_id != 6)
    assert merkle_manifest.digests(merkle_manifest.proofs(*merkle_manifest.manifest(merkle_manifest.leaves(nothing)))).count() == 0


def test_places_of_a_hot_tree_come_from_many_ranges(spark):
    rows = spark.range(0, 30_000, 1, 8).select(F.lit("hot").alias("tree"), (F.col("id") * 3).alias("doc_id"))
    got = merkle_manifest.ranked(rows, ["doc_id"])
    assert got.where(F.col("pos") * 3 != F.col("doc_id")).count() == 0
    assert got.select("levels").distinct().collect()[0][0] == 10   # 3 ** 9 < 30,000 <= 3 ** 10


# ---- packing ----

def held(pieces, docs, window):
    """Check every promise of the packing; returns (sequences, padding)."""
    from tokenizers import Tokenizer
    lib = Tokenizer.from_file(TOKENIZER)
    want = sorted(repr((i, lib.encode(t or "", add_special_tokens=False).ids + [0])) for i, t in docs)
    by_seq, by_doc = {}, {}
    for p in pieces:
        ids = np.frombuffer(p.ids, "<u4").tolist()
        assert len(ids) == p.length > 0
        by_seq.setdefault(p.sequence_id, []).append((p.offset, p.length))
        by_doc.setdefault((p.doc_id, p.doc_tokens), []).append((p.start, ids))
    if len({i for i, _ in docs}) == len(docs):
        got = []
        for (i, n), parts in by_doc.items():
            at = 0
            for start, ids in sorted(parts):
                assert start == at
                at += len(ids)
            assert at == n
            got.append(repr((i, [x for _, ids in sorted(parts) for x in ids])))
        assert sorted(got) == want
    padding = 0
    for parts in by_seq.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= window
        padding += 0 if at & (at - 1) == 0 else window - at
    return len(by_seq), padding


def test_pack_is_whole_and_without_padding(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    for parts, most_open in ((1, 256), (3, 4)):
        pieces = window_packing.pack(docs.repartition(parts), TOKENIZER, most_open=most_open).collect()
        n, padding = held(pieces, rows, 1024)
        assert padding == 0 and n <= sum(p.length for p in pieces) // 1024 + 10 * parts
    digest = {(r.doc_id, r.start, r.sequence_id): r for r in window_packing.digests(window_packing.pack(docs, TOKENIZER)).collect()}
    for p in window_packing.pack(docs, TOKENIZER).collect():
        assert digest[p.doc_id, p.start, p.sequence_id].ids_crc32 == zlib.crc32(p.ids)
    joined = window_packing.sequences(window_packing.pack(docs, TOKENIZER))
    assert joined.where((F.col("padding") != 0) | (F.col("length") != F.octet_length("ids") / 4)).count() == 0


def test_a_document_goes_where_the_squares_are_least():
    rng = random.Random(5)
    for _ in range(300):
        p = window_packing.Packer(16, 0, 100)
        p.count[1:16] = [rng.randrange(3) for _ in range(15)]
        size = rng.randrange(1, 16)

        def squares(level, size=size, p=p):
            n = p.count.copy()
            if level:
                n[level] -= 1
            if level + size < 16:
                n[level + size] += 1
            return (int((n[1:16] ** 2).sum()), -level)
        choices = [0] + [h for h in range(1, 17 - size) if p.count[h]]
        assert p._level(size) == min(choices, key=squares)


def test_open_windows_are_bounded_and_cuts_rare():
    rng = random.Random(6)
    p, pieces = window_packing.Packer(64, 0, 8), 0
    for i in range(3000):
        p.add(i, np.arange(rng.choice([40, 41, 50]), dtype="<u4").tobytes())
        assert p.n_open <= 8 and p.n_open == p.count.sum() == sum(map(len, p.open))
    p.finish()
    # whole windows but for the powers of two at the end, although no two documents fit into one
    fill = {}
    for _, _, n, _, _, s, _ in p.closed:
        fill[s] = fill.get(s, 0) + n
    assert sum(n < 64 for n in fill.values()) <= 6
    q = window_packing.Packer(64, 0, 64)
    for i in range(3000):  # lengths that fit together are not cut at all
        q.add(i, np.arange(rng.choice([16, 32, 48]), dtype="<u4").tobytes())
    before = len(q.closed) + sum(len(w) for level in q.open for w in level)
    assert before == 3000


def test_cuts_are_encoded_as_in_the_whole_text():
    w = window_packing.Words(TOKENIZER)
    rng = random.Random(7)
    alphabet = list(" \n\t\r'") * 3 + list("aZ9!é😀　\xa0\x85\x1c\x1f\x00") + ["'s", "  ", "<|endoftext|>", " "]
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(30))) for _ in range(2000)]
    assert w.batch(texts) == [w.whole(t) for t in texts]
    for w.kept, w.at_once, w.joined in ((3, 2, 2), (10, 1000, 3), (1000, 5, 1)):  # forgetting and long texts change nothing
        assert w.batch(texts[:200] + ["a b c d e f g a b"]) == [w.whole(t) for t in texts[:200] + ["a b c d e f g a b"]]


def test_packing_of_odd_rows(odd, nothing):
    pieces = window_packing.pack(odd, TOKENIZER).collect()
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    assert held(pieces, rows, 1024)[1] == 0
    one = [p for p in pieces if p.doc_id == 1]
    assert len(one) == 1 and (one[0].length, one[0].doc_tokens, one[0].ids) == (1, 1, b"\0\0\0\0")
    assert sum(p.length for p in pieces if p.doc_id is None) == 6 and len([p for p in pieces if p.doc_id == 6 and p.start == 0]) == 2
    assert window_packing.pack(nothing, TOKENIZER).count() == 0


# ---- codes ----

def plain_codes(rows, parts=4, entries=256, rounds=4):
    good = sorted((i, [int(np.floor(1024 * float(x))) for x in v]) for i, v in rows)
    w = len(good[0][1]) // parts
    cut = [[v[p * w:(p + 1) * w] for _, v in good] for p in range(parts)]
    books = [[list(x) for x in c[:entries]] for c in cut]

    def nearest(book, x):
        return min((sum((a - b) ** 2 for a, b in zip(x, e, strict=True)), i) for i, e in enumerate(book))
    for _ in range(rounds):
        for book, c in zip(books, cut, strict=True):
            of = {}
            for x in c:
                of.setdefault(nearest(book, x)[1], []).append(x)
            for e, xs in of.items():
                book[e] = [sum(col) // len(xs) for col in zip(*xs, strict=True)]
    best = [[nearest(b, x) for x in c] for b, c in zip(books, cut, strict=True)]
    said = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return {i: ([best[p][k][1] for p in range(parts)], sum(best[p][k][0] for p in range(parts))) for k, (i, _) in enumerate(good)}, said


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, g, "x") for i, v, g in rows], "vec_id long, embedding array<float>, label int, code string")


@pytest.mark.parametrize("scale", [0.01, 1.0, 1e5])   # few distinct parts; usual; beyond doubles
def test_codes_equal_plain_ones(spark, scale):
    rng = np.random.default_rng(3)
    rows = [(int(i), (rng.normal(size=8) * scale).astype(np.float32).tolist(), int(i % 3)) for i in rng.permutation(300)]
    rows += [(1000 + i, rows[0][1], 7) for i in range(150)]   # a third are one vector
    df = vectors(spark, rows).repartition(5)
    books = code_trie.train(df, entries=16)
    want, said = plain_codes([(i, v) for i, v, _ in rows], entries=16)
    got = {r.vec_id: (r.code, r.error) for r in code_trie.encode(df.drop("code"), books).collect()}
    assert got == want and code_trie.said(books) == said


def test_trie_shares_prefixes_across_blocks():
    rng = np.random.default_rng(4)
    x = np.unique(rng.integers(-3, 3, size=(4000, 5)), axis=0).astype(np.int64)
    book = rng.integers(-3, 3, size=(20, 5)).astype(np.int64)
    want = ((x[:, None] - book[None]) ** 2).sum(axis=2)
    for cut in ([len(x)], [1, 7, 700, 1500, len(x)]):
        t, got, at = code_trie.Trie(book), [], 0
        for end in cut:
            got.append(t.leaves(x[at:end]))
            at = end
        assert (np.concatenate([g[0] for g in got]) == want.argmin(axis=1)).all()
        assert (np.concatenate([g[1] for g in got]) == want.min(axis=1)).all()


def test_codes_of_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    bad = [(1, None, 1), (2, [], 1), (3, [nan] * 8, 1), (4, [inf] + [0.0] * 7, 1), (5, [None] + [0.0] * 7, None)]
    good = [(6, [0.0] * 8, None), (6, [0.0] * 8, None), (7, [1.0] * 8, None), (None, [-1.0] * 8, 2)]
    df = vectors(spark, bad + good)
    books = code_trie.train(df)
    assert [len(b) for b in books] == [3] * 4   # as many entries as vectors with an id
    got = sorted((str(r.vec_id), r.code, r.error, r.label_error) for r in code_trie.digests(code_trie.encode(df.drop("code"), books), books).collect())
    # entries 0 and 1 tie at first; the vector without an id draws entry 0 to itself, and the two zeros end at entry 1
    assert got == [("6", "01010101", 0, 0)] * 2 + [("7", "02020202", 0, 0), ("None", "00000000", 0, 0)]
    back = code_trie.decode(code_trie.encode(df.drop("code"), books), books).where("vec_id = 7").first()
    assert back.decoded == [1.0] * 8
    for rows in ([], bad):
        none = vectors(spark, rows)
        assert code_trie.digests(code_trie.encode(none.drop("code"), code_trie.train(none)), code_trie.train(none)).count() == 0
    for v in ([0.0] * 7, [1e9] * 8):
        with pytest.raises(Exception, match="equal parts|32 bits"):
            code_trie.train(vectors(spark, [(1, v, 1)]))
