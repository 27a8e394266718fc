"""Personal data by fixed patterns and a skip-chain conditional random field.

The patterns give the base spans. The field adds spans that the patterns do
not reach: its nodes are the tokens of a document that hold a digit or "@",
its states "none" and the four kinds. Neighbouring tokens share a transition
potential; distant tokens that repeat each other, or are similar (same last
seven digits, same local part of an address), share a potential that rewards
equal labels. Loopy message passing over both kinds of links carries a label
from one mention to the others of the document. Tokens inside base spans are
clamped to their kind. Links join each mention to the next one, so their
number is linear in the tokens. All documents of an Arrow batch are passed
messages together.

The weights are learned by pseudo-likelihood from a bounded, hash-chosen
sample (SAMPLE documents of up to SAMPLE_CHARS characters), with the base
spans as labels. Detection covers every whole text.

Defined results: null is an empty text; empty texts have no span; spans are
code points, end exclusive; no sample or no labelled token in it adds nothing.
Repeated rows repeat; extra columns are ignored.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nightledger.llm.common import bounded_sample, let_go, ready

KINDS = ("email", "ip", "card", "phone")
SAMPLE, SAMPLE_CHARS = 2000, 20_000
ROUNDS, DAMPING, SURE = 8, 0.3, 0.95   # message passing; least marginal of an added token
AGREE = 5.0   # prior weight of equal labels on a skip link, moved by the repeats in the sample
SCHEMA = "doc_id long, spans array<struct<kind:string,start:int,end:int,base:boolean>>"

# Possessive forms of the fixed patterns, from the start of a run: the same matches in linear time.
_LOCAL = r"[A-Za-z0-9._%+-]"
_DOMAIN = r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
EMAIL_NEXT = re.compile(rf"{_LOCAL}++@{_DOMAIN}")
EMAIL = re.compile(rf"(?<!{_LOCAL}){_LOCAL}++@{_DOMAIN}")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
TOKEN = re.compile(r"[0-9@][^\x20\x09-\x0D]*")
BLANK = frozenset(" \t\n\x0b\x0c\r")
EDGE = "\"'()[]{}<>.,;:!?*#&|$%=/\\"


def luhn(digits: str) -> bool:
    return sum(d if i % 2 == 0 else d * 2 - 9 * (d > 4) for i, d in enumerate(map(int, reversed(digits)))) % 10 == 0


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Matches of the fixed patterns, leftmost and non-overlapping per kind, by start then kind."""
    out = []
    if "@" in text:
        m, at = EMAIL.search(text), 0
        while m:
            out.append(("email", m.start(), m.end()))
            at = m.end()
            # behind a match a local part may go on in mid-run
            m = EMAIL_NEXT.match(text, at) or EMAIL.search(text, at)
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            out.append(("ip", m.start(), m.end()))
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 12:
            d = m[0].replace(" ", "").replace("-", "")
            if 12 <= len(d) <= 19 and luhn(d):
                out.append(("card", m.start(), m.end()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
                out.append(("phone", m.start(), m.end()))
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0])))


def tokens(text: str) -> list[tuple[int, int]]:
    """Words with a digit or "@", without the punctuation around them."""
    out, last = [], 0
    for m in TOKEN.finditer(text):
        a, b = m.span()
        while a > last and text[a - 1] not in BLANK:
            a -= 1
        last = b
        while a < b and text[a] in EDGE:
            a += 1
        while b > a and text[b - 1] in EDGE:
            b -= 1
        if a < b:
            out.append((a, b))
    return out


def similar_key(token: str) -> str | None:
    """Equal for tokens that repeat or resemble each other; None: too short to tell."""
    digits = "".join(c for c in token if "0" <= c <= "9")
    if len(digits) >= 7 and "@" not in token:
        return "#" + digits[-7:]
    key = token.split("@")[0].lower()
    return key if len(key) >= 5 else None


def token_features(token: str) -> list[float]:
    n = len(token)
    digits = sum("0" <= c <= "9" for c in token)
    dots, dashes = token.count("."), token.count("-")
    at = token.find("@")
    alone = digits + dots + dashes == n
    return [1.0, at > 0, at > 0 and "." in token[at:], token[:1] == "+", digits == n, alone and dots == 3,
            alone and dashes > 0, digits >= 7, digits >= 12, digits == 4 and n == 4, digits == 3 and n == 3,
            digits == 0, digits / n, min(n, 40) / 40.0, any(c.isalpha() for c in token), dots == 1, n == 1]


def nodes(text: str, base: list[tuple[str, int, int]]):
    """Tokens, their clamped label (0: free), features and keys."""
    toks, labels, b = tokens(text), [], 0
    for s, e in toks:
        while b < len(base) and base[b][2] <= s:
            b += 1
        over = [x for x in base[b:b + 4] if x[1] < e and x[2] > s]
        labels.append(1 + KINDS.index(over[0][0]) if over else 0)
    words = [text[s:e] for s, e in toks]
    return toks, labels, [token_features(w) for w in words], [similar_key(w) for w in words]


def links(toks, keys, text: str, first: int = 0):
    """Chain links between tokens a few characters apart, skip links to the next similar token."""
    chain, skip, seen = [], [], {}
    for i, (s, _) in enumerate(toks):
        if i and s - toks[i - 1][1] <= 3 and "\n" not in text[toks[i - 1][1]:s]:
            chain.append((first + i - 1, first + i))
        k = keys[i]
        if k is not None:
            if k in seen:
                skip.append((first + seen[k], first + i))
            seen[k] = i
    return chain, skip


def train(texts: list[str]) -> dict | None:
    """Weights by gradient steps on the pseudo-likelihood of the base labels."""
    feats, gold, chain, skip = [], [], [], []
    for text in sorted(texts):
        t, y, f, k = nodes(text, base_spans(text))
        c, s = links(t, k, text, len(gold))
        feats += f
        gold += y
        chain += c
        skip += s
    if not any(gold):
        return None
    x, y, n = np.array(feats, float), np.array(gold), len(KINDS) + 1
    one = np.eye(n)[y]
    chain, skip = (np.array(v, int).reshape(-1, 2) for v in (chain, skip))
    left, right, near = np.zeros_like(one), np.zeros_like(one), np.zeros_like(one)
    np.add.at(left, chain[:, 1], one[chain[:, 0]])
    np.add.at(right, chain[:, 0], one[chain[:, 1]])
    np.add.at(near, skip[:, 0], one[skip[:, 1]])
    np.add.at(near, skip[:, 1], one[skip[:, 0]])
    prior = np.full(n, AGREE)
    unary, trans, same = np.zeros((x.shape[1], n)), np.zeros((n, n)), prior.copy()
    same[0] = prior[0] = 0.0
    sums = [np.full_like(v, 1e-8) for v in (unary, trans, same)]
    for _ in range(300):
        z = x @ unary + left @ trans + right @ trans.T + near * same
        p = np.exp(z - z.max(axis=1, keepdims=True))
        d = (one - p / p.sum(axis=1, keepdims=True)) / len(y)
        for w, sq, g in zip((unary, trans, same), sums, (x.T @ d - 1e-5 * unary, left.T @ d + (right.T @ d).T - 1e-5 * trans,
                                                          (near * d).sum(axis=0) - 1e-2 * (same - prior)), strict=True):
            sq += g**2
            w += 0.3 * g / np.sqrt(sq)
    return {"unary": unary, "trans": trans, "same": np.maximum(same, 0)}


def marginals(unary: np.ndarray, clamp: np.ndarray, chain: np.ndarray, skip: np.ndarray, model: dict) -> np.ndarray:
    """Sum-product message passing over chain and skip links (rows of node numbers)."""
    n, k = unary.shape
    phi = np.exp(unary - unary.max(axis=1, keepdims=True))
    phi[clamp > 0] = np.eye(k)[clamp[clamp > 0]] + 1e-9
    links = np.concatenate([chain, skip])
    pot = np.concatenate([np.broadcast_to(np.exp(model["trans"]), (len(chain), k, k)),
                          np.broadcast_to(np.exp(np.diag(model["same"])), (len(skip), k, k))])
    src = np.concatenate([links[:, 0], links[:, 1]])
    dst = np.concatenate([links[:, 1], links[:, 0]])
    pot = np.concatenate([pot, pot.transpose(0, 2, 1)])
    back = np.roll(np.arange(len(src)), len(links))
    log_m = np.zeros((len(src), k))
    for _ in range(ROUNDS if len(src) else 0):
        total = np.log(phi)
        np.add.at(total, dst, log_m)
        out = total[src] - log_m[back]
        out = np.exp(out - out.max(axis=1, keepdims=True))
        new = np.log(np.einsum("ek,ekl->el", out, pot) + 1e-300)
        log_m = DAMPING * log_m + (1 - DAMPING) * (new - new.max(axis=1, keepdims=True))
    total = np.log(phi)
    np.add.at(total, dst, log_m)
    p = np.exp(total - total.max(axis=1, keepdims=True))
    return p / p.sum(axis=1, keepdims=True)


def detect(texts: list[str], model: dict | None) -> list[list[tuple[str, int, int, bool]]]:
    """Spans (kind, start, end, base) of each text."""
    base = [base_spans(t) for t in texts]
    out = [[(*s, True) for s in b] for b in base]
    if model is None:
        return out
    feats, clamp, chain, skip, where = [], [], [], [], []
    for d, (text, b) in enumerate(zip(texts, base, strict=True)):
        t, y, f, k = nodes(text, b)  # documents without a base span too: a token's own features may tell
        c, s = links(t, k, text, len(clamp))
        feats += f
        clamp += y
        chain += c
        skip += s
        where += [(d, *span) for span in t]
    if not where:
        return out
    pairs = [np.array(v, int).reshape(-1, 2) for v in (chain, skip)]
    clamp = np.array(clamp)
    p = marginals(np.array(feats, float) @ model["unary"], clamp, *pairs, model)
    best = p.argmax(axis=1)
    for i in np.flatnonzero((clamp == 0) & (best > 0) & (p.max(axis=1) >= SURE)):
        d, s, e = where[i]
        out[d].append((KINDS[best[i] - 1], s, e, False))
    for spans in out:
        spans.sort(key=lambda s: (s[1], KINDS.index(s[0])))
    return out


def fit(docs: DataFrame, seed: int = 7) -> dict | None:
    """A model from a bounded sample of the documents with a digit or "@"."""
    rows = docs.where(F.col("text").isNotNull() & (F.length("text") <= SAMPLE_CHARS) & F.col("text").rlike("[0-9@]")).select("doc_id", "text")
    return train([r["text"] for r in bounded_sample(rows, ["doc_id", "text"], SAMPLE, seed).collect()])


def scan(docs: DataFrame, model: dict | None) -> DataFrame:
    """(doc_id, spans) of every row of (doc_id, text)."""
    ready(docs.sparkSession)

    def each(batches):
        let_go()
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                found = detect([t or "" for t in part.column(1).to_pylist()], model)
                rows = [[{"kind": k, "start": s, "end": e, "base": b} for k, s, e, b in spans] for spans in found]
                kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("base", pa.bool_())]))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(rows, kind)], ["doc_id", "spans"])
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(each, SCHEMA)


def merged(spans: list[tuple[str, int, int, bool]]) -> list[tuple[str, int, int]]:
    """Overlapping spans joined; the first kind stays."""
    out: list[list] = []
    for k, s, e, _ in spans:
        if out and s < out[-1][2]:
            out[-1][2] = max(out[-1][2], e)
        else:
            out.append([k, s, e])
    return [tuple(x) for x in out]


def redacted(texts: pd.Series, model: dict | None) -> pd.Series:
    """Texts with every span replaced by its kind in brackets; null stays null."""
    known = texts.notna().to_numpy()
    plain = [t if k else "" for t, k in zip(texts, known, strict=True)]
    out = []
    for text, spans, k in zip(plain, detect(plain, model), known, strict=True):
        at, parts = 0, []
        for kind, s, e in merged(spans):
            parts += [text[at:s], f"[{kind}]"]
            at = e
        out.append("".join(parts) + text[at:] if k else None)
    return pd.Series(out, dtype=object)


def redact(docs: DataFrame, model: dict | None, text: str = "text") -> DataFrame:
    """``docs`` with personal data taken out of its text column."""
    ready(docs.sparkSession)

    @F.pandas_udf("string")
    def clean(s: pd.Series) -> pd.Series:
        let_go()
        return pd.concat([redacted(s.iloc[i:i + 512], model) for i in range(0, len(s), 512)], ignore_index=True) if len(s) else s
    return docs.withColumn(text, clean(F.col(text)))


def spelled(spans, kinds=KINDS):
    """Spans (kind, start, end) in order as text ``kind:start:end``, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def digests(found: DataFrame) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans) of the operator's output."""
    base = F.filter("spans", lambda s: s["base"])
    kinds = F.transform(base, lambda s: s["kind"])
    count = [(F.size(kinds) - F.size(F.array_remove(kinds, k))).cast("long").alias(f"n_{k}") for k in KINDS]
    return found.select("doc_id", *count, F.sha2(spelled(base).cast("binary"), 256).alias("base_sha256"),
                        spelled(F.col("spans")).alias("spans"))
