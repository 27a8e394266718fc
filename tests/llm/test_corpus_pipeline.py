"""The whole pipeline against a plain version of its stages."""

import collections
import re

import sentencepiece

import corpus_pipeline
from nightledger.llm import language_crf, mixing
from nightledger.llm.common import table
from nightledger.llm.queries import tokenizer_path
from test_queries import pii

SF = "/root/testdata/sf0.001"
SPACE = r"[^\x20\x09-\x0D]+"


def plain_groups(texts):
    sets = {}
    for i, t in texts.items():
        w = re.findall(SPACE, re.sub("[A-Z]", lambda m: m[0].lower(), t))
        sets[i] = {tuple(w[j:j + 5]) for j in range(len(w) - 4)} if len(w) > 4 else {tuple(w)} - {()}
    home = {i: i for i in sets}

    def find(i):
        return i if home[i] == i else find(home[i])
    for a in sets:
        for b in sets:
            x, y = sets[a], sets[b]
            if a < b and x and y and 100 * len(x & y) >= 80 * len(x | y):
                p, q = sorted((find(a), find(b)))
                home[q] = p
    return {i: find(i) for i in sets}


def plain_redaction(text):
    spans, out, at = [], "", 0
    for k, s, e in sorted(pii(text), key=lambda x: (x[1], ("email", "ip", "card", "phone").index(x[0]))):
        if spans and s < spans[-1][2]:
            spans[-1][2] = max(e, spans[-1][2])
        else:
            spans.append([k, s, e])
    for k, s, e in spans:
        out += text[at:s] + f"[{k}]"
        at = e
    return out + text[at:]


def test_run_equals_the_plain_stages(spark):
    docs = table(spark, SF, "documents")
    rows = {r.doc_id: r for r in docs.collect()}
    tagger = language_crf.Tagger(language_crf.fit(docs))
    ids = sorted(rows)
    sure = [i for i, p in zip(ids, language_crf.predicted([rows[i].text for i in ids], tagger), strict=True)
            if p[0] != "und" and p[1] >= corpus_pipeline.MIN_SCORE]
    groups = plain_groups({i: rows[i].text for i in sure})
    left = {i: plain_redaction(rows[i].text) for i in sure if groups[i] == i}
    lib = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path())
    out = corpus_pipeline.run(spark, SF).collect()
    drawn = collections.Counter(r.doc_id for r in out)
    assert set(drawn) <= set(left) and max(drawn.values()) <= 2
    for r in out:
        assert list(r.ids) == lib.encode(left[r.doc_id]) and r.n_tokens == len(r.ids)
    size, taken = collections.Counter(), collections.Counter()
    words = {i: len(re.findall(SPACE, t)) for i, t in left.items()}
    for i in left:
        size[rows[i].source] += words[i]
        taken[rows[i].source] += drawn[i] * words[i]
    total = spark.createDataFrame(list(size.items()), "source string, words long")
    for r in mixing.targets(total).collect():
        most = max(words[i] for i in left if rows[i].source == r.source)
        assert abs(taken[r.source] - r.target) <= most / 2 + 1


def test_clean_documents_stay(spark):
    """Stages that filter keep documents in a known language that resemble no other."""
    docs = table(spark, SF, "documents")
    kept = {r.doc_id for r in corpus_pipeline.language_id(spark, docs, SF).collect()}
    assert len(kept) >= 0.99 * docs.count()
