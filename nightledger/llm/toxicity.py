"""Toxicity of texts by a counterfactual-regularised linear classifier.

Features are the distinct words of a text (A-Z lowered, other signs cut from
both ends), hashed. Training minimises, over a bounded hash-chosen sample of
labelled rows, the log loss plus PENALTY times the squared change of the
score when the identity terms of a text are swapped for others of their
group. A group's mention thus cannot carry weight by itself, which is what
makes neutral mentions false positives. Where the sample has few mentions,
labelled texts are also paired with copies into which a term is put, so the
penalty also reaches terms that the labels never met.

The sample is bounded per class (PER_CLASS rows; texts up to SAMPLE_CHARS
characters, at most WORDS distinct words each enter as they are). Scores
cover all rows and whole texts and see only the text.

Defined results: null is an empty text; an empty text has the score of the
bias; without rows of both labels every score is 0; repeated rows repeat;
a row labelled twice counts twice, a null label not at all. Extra columns are
ignored. Equal word sets with equal labels teach once.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nightledger.llm.common import below, ready

PER_CLASS, SAMPLE_CHARS = 3000, 20_000
BITS, STEPS, RATE, L2, PENALTY = 18, 800, 0.3, 1e-6, 4.0
LEAST_DOCS, LEAST_Z = 5, 6.0   # documents that must hold a word, and standard errors between its shares by label
EDGES = bytes(range(33)) + b"\"'()[]{}<>.,;:!?*#&|$%=/\\_-+~^`@"

#: Identity terms by group; terms of a group replace each other.
IDENTITY = (
    ("men", "women", "boys", "girls"), ("man", "woman"), ("male", "female"),
    ("gay", "straight", "lesbian", "bisexual"), ("transgender", "cisgender"),
    ("christian", "muslim", "jewish", "hindu", "buddhist", "atheist"),
    ("christians", "muslims", "jews", "hindus", "buddhists", "atheists"),
    ("black", "white", "asian", "latino"), ("african", "european", "american", "mexican"),
    ("immigrant", "native"), ("old", "young"), ("deaf", "blind", "disabled"),
)
SWAPS = {w: tuple(x for x in g if x != w) for g in IDENTITY for w in g}


def words(text: str | None) -> set[str]:
    """Distinct words of a text, lowered, without signs around them."""
    out = {w.strip(EDGES) for w in (text or "").encode("utf-8", "surrogatepass").lower().split()}
    out.discard(b"")
    return out


def slot(word: bytes) -> int:
    return xxhash.xxh3_64_intdigest(word) >> (64 - BITS)


def swapped(found: set[bytes], turn: int) -> set[bytes] | None:
    """The words with every identity term replaced by the ``turn``-th other of its group; None: no term."""
    terms = [w for w in found if w.decode("utf-8", "replace") in SWAPS]
    if not terms:
        return None
    others = {(o := SWAPS[w.decode()])[turn % len(o)].encode() for w in terms}
    return (found - set(terms)) | others


def train(rows: list[tuple[str, int]], penalty: float = PENALTY) -> dict | None:
    """Bias and weights (by slot) from (text, label) pairs; labels 0 and 1."""
    rows = sorted(rows, key=lambda r: (xxhash.xxh3_64_intdigest((r[0] or "").encode("utf-8", "surrogatepass")), r[1]))
    y = np.array([float(v) for _, v in rows])
    if not len(y) or y.min() == y.max():
        return None
    sets = [words(t) for t, _ in rows]
    once = list({(frozenset(s), v): i for i, (s, v) in enumerate(zip(sets, y, strict=True))}.values())  # copies teach once
    sets, y = [sets[i] for i in once], y[once]
    terms = sorted(SWAPS)
    pairs: list[tuple[int, set[bytes]]] = []
    for i, s in enumerate(sets):
        other = swapped(s, i)
        if other is None:  # a mention put in must not move the score either
            other = s | {terms[i % len(terms)].encode()}
        pairs.append((i, other))
    count: dict[int, int] = {}
    slots = [np.array(sorted({slot(w) for w in s}), np.int64) for s in sets]
    for s in slots:
        for v in s.tolist():
            count[v] = count.get(v, 0) + 1
    identity = {slot(w.encode()) for w in terms}
    # words whose share differs between the labels beyond chance; rare words would only learn the sample
    ones: dict[int, int] = {}
    for s, v in zip(slots, y, strict=True):
        if v:
            for k in s.tolist():
                ones[k] = ones.get(k, 0) + 1
    n1, n0 = y.sum(), len(y) - y.sum()

    def differs(k, c):
        a = ones.get(k, 0)
        share = c / len(y)
        return abs(a / n1 - (c - a) / n0) >= LEAST_Z * (share * (1 - share) * (1 / n1 + 1 / n0)) ** 0.5
    used = sorted({v for v, c in count.items() if LEAST_DOCS <= c < len(y) and differs(v, c)} | identity)
    at = {v: i for i, v in enumerate(used)}

    def matrix(of):
        cols = [[at[v] for v in s if v in at] for s in of]
        return np.repeat(np.arange(len(cols)), [len(c) for c in cols]), np.array([x for c in cols for x in c], np.int64)
    row, col = matrix([s.tolist() for s in slots])
    twin_row, twin_col = matrix([sorted({slot(w) for w in o}) for _, o in pairs])
    n, w, b = len(y), np.zeros(len(used)), 0.0
    sq, sq_b = np.full(len(used), 1e-8), 1e-8
    each = np.where(y > 0, 0.5 / y.mean(), 0.5 / (1 - y.mean())) / n * np.clip(2 * np.minimum(y.mean(), 1 - y.mean()), 0.2, 1) ** 0.5
    each /= each.sum()
    for _ in range(STEPS):
        z = b + np.bincount(row, w[col], n)
        t = b + np.bincount(twin_row, w[twin_col], n)
        p, q = 1 / (1 + np.exp(-np.clip(z, -30, 30))), 1 / (1 + np.exp(-np.clip(t, -30, 30)))
        gap = 2 * penalty * (p - q) * each
        dz, dt = (p - y) * each + gap * p * (1 - p), -gap * q * (1 - q)
        g = np.bincount(col, dz[row], len(w)) + np.bincount(twin_col, dt[twin_row], len(w)) + L2 * w
        gb = (dz + dt).sum()
        sq += g**2
        sq_b += gb**2
        w -= RATE * g / np.sqrt(sq)
        b -= RATE * gb / np.sqrt(sq_b)
    keep = np.abs(w) > 1e-3
    return {"bias": float(b), "weights": {int(u): float(x) for u, x in zip(np.array(used)[keep], w[keep], strict=True)}}


class Scorer:
    """Scores with a bounded table of word weights."""

    limit = 500_000

    def __init__(self, model: dict):
        self.bias, self.weights, self.known = model["bias"], model["weights"], {}

    def score(self, text: str | None) -> float:
        slots = {}
        known, get = self.known, self.weights.get
        for raw in set((text or "").encode("utf-8", "surrogatepass").lower().split()):
            hit = known.get(raw)
            if hit is None:
                if len(known) >= self.limit:
                    known.clear()
                word = raw.strip(EDGES)
                s = slot(word)
                hit = known[raw] = (s, get(s, 0.0) if word else 0.0)
            if hit[1]:
                slots[hit[0]] = hit[1]
        z = self.bias + sum(v for _, v in sorted(slots.items()))
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", seed: int = 7) -> dict | None:
    """A model from rows (doc_id, text) joined to labels (doc_id, label)."""
    given = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("y")).where(F.col("y").isin(0, 1))
    counts = {r["y"]: r["n"] for r in given.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    chosen = F.lit(False)
    for y, n in sorted(counts.items()):
        chosen = chosen | ((F.col("y") == y) & below(PER_CLASS / n, seed, "doc_id"))
    # at most about PER_CLASS rows a class, so ids can be listed: the text table is then read once, without a shuffle
    ids = [(r["doc_id"], r["y"]) for r in given.where(chosen).orderBy(F.xxhash64(F.lit(seed), "doc_id"), "y").limit(3 * PER_CLASS).collect()]
    by: dict[int, list[int]] = {}
    for i, y in ids:
        by.setdefault(i, []).append(y)
    if not by:
        return None
    picked = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where(
        F.col("doc_id").isin(*by) & (F.length("text") <= SAMPLE_CHARS)).limit(6 * PER_CLASS).collect()
    return train([(r["text"], y) for r in picked for y in by[r["doc_id"]]])


def score(docs: DataFrame, model: dict | None) -> DataFrame:
    """(doc_id, score) of every row of (doc_id, text)."""
    ready(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    if model is None:
        return rows.select("doc_id", F.lit(0.0).alias("score"))

    def each(batches):
        scorer = Scorer(model)
        for batch in batches:
            out = [scorer.score(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.float64())], ["doc_id", "score"])
    return rows.mapInArrow(each, "doc_id long, score double")
