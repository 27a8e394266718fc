"""Language of words and documents by a linear-chain conditional random field.

States are the learned languages. A word's emission is a sum of learned
weights of its features: the word itself (lexicon), affixes of one to four
letters, and letter pairs and triples with word ends. Learned transitions
join neighbouring words. Forward-backward gives every word's marginals in
whole texts, also where the language changes in mid-text; a document's
language is the one with the largest mean marginal, which is its score.

Training: a bounded, hash-chosen sample of labelled documents per language
(PER_LANG, texts up to SAMPLE_CHARS characters) is cut into runs of words;
runs of random languages are joined to sequences, so that transitions are
learned from text that switches. The weights are found by Adagrad on the exact
log-likelihood gradient. Counting labelled rows per language covers all of them.

Prediction covers all rows and whole texts and sees only the text.

Defined results: null text or text without a letter gives ``und`` and score
0; without any labelled row every text is ``und``; ties take the language
that sorts first. Repeated rows repeat; extra columns are ignored.
"""

from __future__ import annotations

import re
import uuid

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nightledger.llm.common import below, held, mixed, ready, small_batches

PER_LANG, SAMPLE_CHARS = 300, 20_000
BITS, EPOCHS, LENGTH, BATCH, RATE = 17, 2, 64, 128, 0.2   # feature table, passes, sequence length, sequences a step
RUNS = 6_000   # runs of 16 words per language in training
WORDS = re.compile(r"[^\W\d_]+")
UNKNOWN = "und"


def _hash(kind: int, x: np.ndarray) -> np.ndarray:
    return mixed(x + np.uint64(kind * 0x9E3779B97F4A7C15 % 2**64)) >> np.uint64(64 - BITS)


def features(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed features of lower-cased, non-empty words: (number of the word, feature) pairs."""
    c = np.frombuffer("".join([f"^{w}$" for w in words]).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    size = np.fromiter(map(len, words), np.int64, len(words))
    end = np.cumsum(size + 2)
    first = end - size - 1                                     # of the letters, without the marks
    each = np.repeat(np.arange(len(words)), size + 2)
    place = np.arange(len(c)) - np.repeat(first, size + 2)
    front = mixed(c * np.uint64(1_000_003) + place.astype(np.uint64))
    back = mixed(c * np.uint64(999_983) + np.repeat(end, size + 2).astype(np.uint64) - np.arange(len(c), dtype=np.uint64))
    at = np.arange(len(words))
    owner, feat = [at], [_hash(0, np.add.reduceat(front, end - size - 2))]   # the word
    head, tail = np.zeros(len(words), np.uint64), np.zeros(len(words), np.uint64)
    for k in range(1, 5):                                       # affixes
        on = size >= k
        head[on] += front[first[on] + k - 1]
        tail[on] += back[end[on] - 1 - k]
        owner += [at[on], at[on]]
        feat += [_hash(k, head[on]), _hash(10 + k, tail[on])]
    for k in (2, 3):                                            # letter pairs and triples
        n = len(c) - k + 1
        on = each[:n] == each[k - 1:]
        x = np.zeros(n, np.uint64)
        for j in range(k):
            x = x * np.uint64(0x110001) + c[j:j + n]
        owner.append(each[:n][on])
        feat.append(_hash(20 + k, x[on]))
    return np.concatenate(owner), np.concatenate(feat).astype(np.int64)


def forward_backward(e: np.ndarray, start: np.ndarray, trans: np.ndarray, lengths: np.ndarray):
    """Marginals (B, T, K), log-likelihood terms and summed pair marginals.

    ``e``: exp of emissions, padded; lengths must not increase. ``trans`` and
    ``start`` are exp of their weights.
    """
    b, t, k = e.shape
    alpha, scale = np.zeros_like(e), np.ones((b, t))
    live = np.array([np.searchsorted(-lengths, -i, side="left") for i in range(t + 1)])  # rows longer than i
    a = start * e[:, 0]
    for i in range(t):
        n = live[i]
        if i:
            a = (alpha[:n, i - 1] @ trans) * e[:n, i]
        a = a[:n]
        s = a.sum(axis=1)
        scale[:n, i] = s
        alpha[:n, i] = a / s[:, None]
    beta = np.ones((b, k))
    out = np.zeros_like(e)
    pairs = np.zeros((k, k))
    for i in range(t - 1, -1, -1):
        n = live[i]
        m = live[i + 1] if i + 1 < t else 0
        if m:
            right = e[:m, i + 1] * beta[:m] / scale[:m, i + 1, None]
            pairs += alpha[:m, i].T @ right
            beta[:m] = right @ trans.T
        out[:n, i] = alpha[:n, i] * beta[:n]
    return out, np.log(scale).sum(), pairs * trans


def sums(at: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    """Rows added up by their number."""
    return np.stack([np.bincount(at, rows[:, j], n) for j in range(rows.shape[1])], axis=1)


def train(rows: list[tuple[str, str]], seed: int = 7) -> dict | None:
    """Weights from (text, lang) pairs."""
    runs: dict[str, list[list[str]]] = {}
    for text, lang in sorted(rows, key=lambda r: (r[1], r[0])):
        words = WORDS.findall(text.lower())
        for i in range(0, len(words), 16):
            runs.setdefault(lang, []).append(words[i:i + 16])
    langs = sorted(runs)
    if not langs:
        return None
    rng, k = np.random.default_rng(seed), len(langs)
    limit = min(max(len(runs[x]) for x in langs), RUNS)
    order = [(j, r) for j, x in enumerate(langs) for r in (rng.permutation(len(runs[x]))[:limit])]
    seqs: list[list[tuple[int, int]]] = [[]]
    vocab: dict[str, int] = {}
    for j in rng.permutation(len(order)):
        lang, r = order[j]
        for w in runs[langs[lang]][r]:
            if len(seqs[-1]) >= LENGTH:
                seqs.append([])
            seqs[-1].append((vocab.setdefault(w, len(vocab)), lang))
    owner, flat = features(list(vocab))
    by = np.argsort(owner, kind="stable")
    owner, flat = owner[by], flat[by]
    begin = np.searchsorted(owner, np.arange(len(vocab) + 1))
    weights, trans, start = np.zeros((1 << BITS, k)), np.zeros((k, k)), np.zeros(k)
    sq_w, sq_t, sq_s = np.full_like(weights, 1e-6), np.full_like(trans, 1e-6), np.full_like(start, 1e-6)
    seqs.sort(key=len, reverse=True)
    for epoch in range(EPOCHS):
        for at in rng.permutation(range(0, len(seqs), BATCH)):
            part = seqs[at:at + BATCH]
            lengths = np.array([len(s) for s in part])
            ids, gold = np.zeros((len(part), lengths[0]), int), np.zeros((len(part), lengths[0]), int)
            mask = np.arange(lengths[0])[None, :] < lengths[:, None]
            ids[mask], gold[mask] = np.array([x for s in part for x in s]).T
            used, ids = np.unique(ids, return_inverse=True)
            ids = ids.reshape(gold.shape)
            sel = np.concatenate([np.arange(begin[u], begin[u + 1]) for u in used])
            of, fs = np.searchsorted(used, owner[sel]), flat[sel]
            emit = sums(of, weights[fs], len(used))
            e = np.exp(emit - emit.max(axis=1, keepdims=True))[ids]
            marginal, _, pairs = forward_backward(e, np.exp(start), np.exp(trans), lengths)
            want = np.eye(k)[gold] * mask[..., None]
            n = mask.sum()
            diff = sums(ids[mask], (want - marginal)[mask], len(used))
            hit, to = np.unique(fs, return_inverse=True)        # features of this step
            g = sums(to, diff[of], len(hit)) / n - 1e-7 * weights[hit]
            sq_w[hit] += g**2
            weights[hit] += RATE * g / np.sqrt(sq_w[hit])
            both = mask[:, 1:]
            own = np.zeros_like(trans)
            np.add.at(own, (gold[:, :-1][both], gold[:, 1:][both]), 1)
            for w, sq, grad in ((trans, sq_t, (own - pairs) / n), (start, sq_s, (want[:, 0] - marginal[:, 0]).sum(0) / n)):
                sq += grad**2
                w += RATE * grad / np.sqrt(sq)
    return {"langs": langs, "weights": weights.astype(np.float32), "trans": trans, "start": start}


class Tagger:
    """Trained weights with a bounded table of word emissions."""

    kept = 300_000

    def __init__(self, model: dict):
        self.langs, self.weights = model["langs"], model["weights"]
        self.trans, self.start = np.exp(model["trans"]), np.exp(model["start"])
        self.rows, self.known = {}, np.zeros((self.kept, len(self.langs)))

    def emissions(self, words: list[str]) -> np.ndarray:
        rows = self.rows
        new = set(words).difference(rows)
        if len(rows) + len(new) > self.kept:
            rows.clear()
            new = set(words)
        if new:
            at = len(rows)
            new = sorted(new)
            owner, feat = features(new)
            emit = sums(owner, self.weights[feat], len(new))
            self.known[at:at + len(new)] = np.exp(emit - emit.max(axis=1, keepdims=True)) + 1e-12
            rows.update(zip(new, range(at, at + len(new)), strict=True))
        return self.known[np.fromiter(map(rows.__getitem__, words), np.int64, len(words))]

    def marginals(self, texts: list[str]) -> list[np.ndarray]:
        """Word marginals of texts, longest first inside; memory bounded by the words given."""
        cut = [WORDS.findall(t) for t in texts]
        order = sorted(range(len(cut)), key=lambda i: -len(cut[i]))
        lengths = np.array([len(cut[i]) for i in order])
        out: list[np.ndarray] = [np.zeros((0, len(self.langs)))] * len(cut)
        if not len(lengths) or not lengths[0]:
            return out
        e = np.zeros((len(order), lengths[0], len(self.langs)))
        for r, i in enumerate(order):
            for at in range(0, len(cut[i]), 100_000):
                part = cut[i][at:at + 100_000]
                e[r, at:at + len(part)] = self.emissions(part)
        m = forward_backward(e, self.start, self.trans, lengths)[0]
        for r, i in enumerate(order):
            out[i] = m[r, :lengths[r]]
        return out


def groups(sizes: list[int], cells: int):
    """Row numbers, longest first, in groups whose padded size stays near ``cells``."""
    order = sorted(range(len(sizes)), key=lambda i: -sizes[i])
    at = 0
    while at < len(order):
        n = max(1, cells // max(1, sizes[order[at]]))
        yield order[at:at + n]
        at += n


def fit(docs: DataFrame, seed: int = 7) -> dict | None:
    """A model from rows (doc_id, text, lang) that may be learned from."""
    rows = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        return None
    # twice the share that gives PER_LANG rows, so that few rows miss the limit
    chosen = F.lit(False)
    for lang, n in sorted(counts.items()):
        chosen = chosen | ((F.col("lang") == lang) & below(PER_LANG / n, seed, "doc_id"))
    sample = (rows.where(chosen & (F.length("text") <= SAMPLE_CHARS)).orderBy(F.xxhash64(F.lit(seed), "doc_id", "text")).select("text", "lang")
              .limit(2 * PER_LANG * len(counts)).collect())
    return train([(r["text"], r["lang"]) for r in sample], seed)


def predicted(texts: list[str | None], tagger: Tagger):
    """(language or und, score, words, changes of language) of each text."""
    low = [(t or "").lower() for t in texts]
    out = [(UNKNOWN, 0.0, 0, 0)] * len(low)
    for rows in groups([len(t) for t in low], 1_500_000):
        for i, g in zip(rows, tagger.marginals([low[i] for i in rows]), strict=True):
            if len(g):
                mean, tags = g.mean(axis=0), g.argmax(axis=1)
                best = int(mean.argmax())
                out[i] = (tagger.langs[best], min(1.0, mean[best] / mean.sum()), len(g), int((tags[1:] != tags[:-1]).sum()))
    return out


def _sent(docs: DataFrame, model: dict):
    """The tagger of a worker process, made once from the broadcast model.

    The model has a fixed size: 2^BITS rows, a column for each language.
    """
    ready(docs.sparkSession)
    small_batches(docs.sparkSession)
    sent, key = docs.sparkSession.sparkContext.broadcast(model), f"tagger {uuid.uuid4().hex}"

    def tagger() -> Tagger:
        return held(key, lambda: Tagger(sent.value))
    return tagger


def label(docs: DataFrame, model: dict | None) -> DataFrame:
    """(doc_id, lang_pred, score, n_words, n_switches) of every row of (doc_id, text)."""
    rows = docs.select(F.col("doc_id").cast("long"), "text")
    if model is None:
        return rows.select("doc_id", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"),
                           F.lit(0).cast("long").alias("n_words"), F.lit(0).cast("long").alias("n_switches"))
    tagger = _sent(docs, model)

    def each(batches):
        for batch in batches:
            cols = list(zip(*predicted(batch.column(1).to_pylist(), tagger()), strict=True)) or [[]] * 4
            kinds = (pa.string(), pa.float64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, map(list, cols), kinds)],
                                             ["doc_id", "lang_pred", "score", "n_words", "n_switches"])
    return rows.mapInArrow(each, "doc_id long, lang_pred string, score double, n_words long, n_switches long")


def known(docs: DataFrame, model: dict, least: float, text: str = "text") -> DataFrame:
    """Rows whose text is in a learned language with a score of ``least`` or more, as they are."""
    tagger = _sent(docs, model)

    @F.pandas_udf("boolean")
    def sure(s: pd.Series) -> pd.Series:
        got = predicted([None if pd.isna(t) else t for t in s], tagger())
        return pd.Series([p != UNKNOWN and score >= least for p, score, _, _ in got], dtype=bool)
    return docs.where(sure(F.col(text)))
