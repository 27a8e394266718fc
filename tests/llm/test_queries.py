"""The thin queries on a given table, against plain versions of their contracts."""

import collections
import hashlib
import re
import zlib

import duckdb
import numpy as np
import pytest

from nightledger.llm import queries as Q

SF = "/root/testdata/sf0.01"
SPACE = r"[^\x20\x09-\x0D]+"


@pytest.fixture(scope="module")
def docs():
    return {r[0]: r for r in duckdb.sql(f"SELECT doc_id, text, lang, source FROM '{SF}/documents.parquet'").fetchall()}


def by_id(df):
    return {r.doc_id: r for r in df.collect()}


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_op1(spark, docs):
    rows = by_id(Q.op1_source_mixing(spark, SF))
    size = {i: len(re.findall(SPACE, d[1])) for i, d in docs.items()}
    total = collections.Counter()
    for i, d in docs.items():
        total[d[3]] += size[i]
    names, weight = sorted(total), {}
    for k, n in enumerate(names):
        weight[n] = (5, 2, 1)[k % 3]
    target, left, free = {}, 1.5 * sum(total.values()), set(names)
    while free:  # share, stop those above, share the excess again
        level = left / sum(weight[n] for n in free)
        over = {n for n in free if weight[n] * level >= 2 * total[n]}
        if not over:
            target |= {n: weight[n] * level for n in free}
            break
        for n in over:
            target[n] = 2.0 * total[n]
            left -= target[n]
        free -= over
    taken = collections.Counter()
    for i, r in rows.items():
        assert (r["size"], r.source_size) == (size[i], total[docs[i][3]])
        assert r.target == pytest.approx(target[docs[i][3]], rel=1e-12)
        assert r.taken in (0, r["size"], 2 * r["size"]) and len(r.shards) * r["size"] == r.taken
        taken[docs[i][3]] += r.taken
    for n in names:  # whole documents: half of the largest one is the most that a source can miss
        assert abs(taken[n] - target[n]) <= max(size[i] for i in docs if docs[i][3] == n) / 2 + 1
    assert by_id(Q.op1_source_mixing(spark, SF)) == rows


def spelled(spans, kinds):
    return ",".join(f"{k}:{s}:{e}" for s, e, k in sorted(((s, e, k) for k, s, e in spans), key=lambda x: (x[0], kinds.index(x[2]))))


def test_op2(spark, docs):
    kinds = ["assign", "access", "hex", "random"]
    for i, r in by_id(Q.op2_secret_scan(spark, SF)).items():
        t = docs[i][1]
        spans = [("assign", *m.span()) for m in re.finditer(
            r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", t, re.I | re.A) if len(m[2]) >= 12]
        spans += [("access", *m.span()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 18]
        spans += [("hex", *m.span()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 16]
        text = spelled(spans, kinds)
        assert r.base_sha256 == sha(text) and set(text.split(",")) - {""} <= set(r.spans.split(","))
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(s[0] == k for s in spans) for k in kinds[:3])


def pii(t):
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(p) <= 255 for p in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        d = [int(c) for c in m[0] if c.isdigit()][::-1]
        if 12 <= len(d) <= 19 and (sum(d[::2]) + sum(sum(divmod(2 * x, 10)) for x in d[1::2])) % 10 == 0:
            out.append(("card", *m.span()))
    return out + [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 9 <= len(re.findall("[0-9]", m[0])) <= 15]


def test_op3(spark, docs):
    kinds = ["email", "ip", "card", "phone"]
    for i, r in by_id(Q.op3_pii_crf(spark, SF)).items():
        spans = pii(docs[i][1])
        text = spelled(spans, kinds)
        assert r.base_sha256 == sha(text) and set(text.split(",")) - {""} <= set(r.spans.split(","))
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(s[0] == k for s in spans) for k in kinds)


def test_op4(spark, docs):
    """Every run of 50 equal words that two documents share is reported; words said 50 times in a row are not passages."""
    got = by_id(Q.op4_paragraph_dedup(spark, SF))
    seen = collections.defaultdict(set)
    for i, d in docs.items():
        w = d[1].lower().split()
        for j in range(len(w) - 49):
            if len(set(w[j:j + 50])) > 10:
                seen[tuple(w[j:j + 50])].add(i)
    need = set().union(*(v for v in seen.values() if len(v) > 1))
    assert need and not need - set(got)
    assert sum(r.n_removed > 0 for r in got.values()) >= len(need) / 2
    assert all(r.n_repeated >= 20 and r.n_removed <= r.n_repeated for r in got.values())


def test_op5(spark, docs):
    toxic = dict(duckdb.sql(f"SELECT doc_id, toxic FROM '{SF}/labels.parquet'").fetchall())
    rows = by_id(Q.op5_toxicity(spark, SF))
    assert rows.keys() == docs.keys()
    for i, r in rows.items():
        assert r.held_out == (zlib.crc32(str(i).encode()) % 3 == 1) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.7)
    held = [(rows[i].score, y) for i, y in toxic.items() if rows[i].held_out]
    pos, neg = [s for s, y in held if y], [s for s, y in held if not y]
    assert np.mean([(p > n) + 0.5 * (p == n) for p in pos for n in neg]) > 0.85
    assert np.mean([n < 0.7 for n in neg]) > 0.97


def test_op6(spark):
    data = duckdb.sql(f"SELECT vec_id, embedding FROM '{SF}/embeddings.parquet'").fetchall()
    ids, x = np.array([r[0] for r in data]), np.array([r[1] for r in data], float)
    got = collections.defaultdict(dict)
    for r in Q.op6_kmeans_tree(spark, SF).collect():
        got[r.query_id][r["rank"]] = (r.vec_id, r.score)
    hits = n = 0
    for q in ids[ids % 100 == 0]:
        d = np.sqrt(((x - x[ids == q][0]) ** 2).sum(axis=1))
        d[ids == q] = np.inf
        best = set(ids[np.lexsort((ids, d))[:10]].tolist())
        assert sorted(got[q]) == list(range(1, 11))
        assert [got[q][k] for k in range(1, 11)] == sorted(got[q].values(), key=lambda v: (v[1], v[0]))
        assert all(s == d[ids == i][0] for i, s in got[q].values())
        hits += len(best & {i for i, _ in got[q].values()})
        n += 10
    assert hits / n >= 0.9


def test_op7(spark, docs):
    import sentencepiece
    lib = sentencepiece.SentencePieceProcessor(model_file=Q.tokenizer_path())
    for i, r in by_id(Q.op7_sentencepiece(spark, SF)).items():
        ids = lib.encode(docs[i][1])
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), sha(",".join(map(str, ids))), sha(lib.decode(ids)))


def test_op8(spark, docs):
    rows = by_id(Q.op8_language_crf(spark, SF))
    assert rows.keys() == docs.keys()
    held = [r.lang_pred == docs[i][2] for i, r in rows.items() if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2) and 0 <= r.score <= 1 for i, r in rows.items())
    assert np.mean(held) > 0.97


def test_op9(spark, docs):
    rows, sets = by_id(Q.op9_minhash_forest(spark, SF)), {}
    for i, d in docs.items():
        w = re.findall(SPACE, re.sub("[A-Z]", lambda m: m[0].lower(), d[1]))
        sets[i] = {tuple(w[j:j + 2]) for j in range(len(w) - 1)} if len(w) > 1 else {tuple(w)} - {()}
    home = {i: i for i in sets}

    def find(i):
        while home[i] != i:
            i = home[i]
        return i
    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1:]:
            x, y = sets[a], sets[b]
            if x and y and 100 * min(len(x), len(y)) >= 80 * max(len(x), len(y)):
                both = len(x & y)
                if 100 * both >= 80 * (len(x) + len(y) - both):
                    p, q = sorted((find(a), find(b)))
                    home[q] = p
    for i in ids:
        assert (rows[i].n_shingles, rows[i].component_id, rows[i].kept) == (len(sets[i]), find(i), find(i) == i)


def quality(t):
    w = re.findall(SPACE, t)
    seen = collections.Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
    again = {j for i in range(len(w) - 4) if seen[tuple(w[i:i + 5])] > 1 for j in range(i, i + 5)}
    lines = [x for x in t.split("\n") if re.search(SPACE, x)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(again),
            len(w) < 10 or 100 * len(again) > 20 * len(w))


def test_op10(spark, docs):
    rows = by_id(Q.op10_quality_cascade(spark, SF))
    good = dict(duckdb.sql(f"SELECT doc_id, quality FROM '{SF}/labels.parquet'").fetchall())
    for i, r in rows.items():
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == quality(docs[i][1])
        assert not (r.kept and r.base_failed)
    assert np.mean([rows[i].kept for i, q in good.items() if q]) > 0.95
    assert np.mean([rows[i].kept for i, q in good.items() if not q]) < 0.1


@pytest.mark.parametrize("name", sorted(Q.oracle_sql()))
def test_matches_sql(spark, name):
    from compare import compare, duck
    r = compare(Q.queries()[name](spark, SF), duck(SF), Q.oracle_sql()[name])
    assert r["match"], r
