"""Repeated passages by paragraph MinHash banding.

Paragraphs come in two sizes. A line of LINE or more words is a paragraph;
equal lines are one from the start, others meet in a band: bands of MinHash
values of their five-word shingles, as many as the wanted recall at the least
similarity takes (``bands_for``). Every colliding paragraph is joined to the
first of its band and their exact Jaccard similarity is taken. Bands left with
several components go on until every similar pair in them is in one: small
ones are compared whole, the paragraphs of large ones meet by their rarest
shingles (``prefixes``). Verified pairs become components.

A passage may also be put into the middle of a line. So every line is cut
once more at content-defined places (a word whose hash is the least of
RADIUS words on both sides), and pieces of PIECE or more words are
paragraphs whose band is their whole word sequence (128 bits): equal pieces
are equal wherever they stand. A passage of 50 words holds whole pieces
whatever surrounds it.

Of each component the paragraph in the document with the least doc_id stays
(of several in one document the first); the others are removals. Only
documents that share a run of at least RUN repeated words are reported, with
repeats inside one document included.

Buckets are minima joined back to the rows, so a paragraph that a third of
all documents share is combined map-side and its join can be split. All
pairs are made in buckets of at most SMALL members only.

Defined results: null or blank text and rows without an id have no
paragraph; rows that repeat an id are one document, which keeps what they
repeat; spans are code points, end exclusive. Extra columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nightledger.llm.common import WordHashes, checkpointed, mixed, ready, shingle_sets, stored, window_hashes
from nightledger.llm.components import components, joined

SHINGLE, PERCENT, RECALL = 5, 80, 0.9995
LINE, PIECE, RADIUS, RUN = 20, 6, 6, 20
SMALL = 8   # lines up to which a bucket is compared whole


def bands_for(percent: int = PERCENT, recall: float = RECALL, rows: int = 1) -> int:
    """Bands of ``rows`` values at which pairs of the least similarity collide with the wanted chance."""
    return math.ceil(math.log(1 - recall) / math.log(1 - (percent / 100) ** rows))


class Words:
    """The words of many texts side by side: hash, text number, line number, and place in code points."""

    def __init__(self, texts: list[str], hashes: WordHashes):
        raw = [t.encode("utf-8", "surrogatepass") for t in texts]
        blob = b"\n".join(raw)  # the end of a text ends its last line
        byte = np.frombuffer(blob, np.uint8)
        quick, start, end = hashes.words(blob)
        # the places of cuts follow from xxh3 of the words: taken once for each distinct one
        _, one, at = np.unique(quick, return_index=True, return_inverse=True)
        low = blob.lower()
        self.hash = np.fromiter((xxhash.xxh3_64_intdigest(low[a:b]) for a, b in zip(start[one].tolist(), end[one].tolist(), strict=True)),
                                np.uint64, len(one))[at]
        first = np.cumsum([0, *(len(r) + 1 for r in raw[:-1])], dtype=np.int64) if raw else np.zeros(0, np.int64)
        self.text = np.searchsorted(first, start, "right") - 1
        self.line = np.concatenate([[0], np.cumsum(byte == 10, dtype=np.int32)])[start]
        points = np.concatenate([[0], np.cumsum((byte & 0xC0) != 0x80, dtype=np.int32)])
        before = points[first][self.text] if len(start) else 0
        self.start, self.end = (points[start] - before).astype(np.int64), (points[end] - before).astype(np.int64)

    def cuts(self, radius: int = RADIUS) -> np.ndarray:
        """Whether a piece begins at a word: at the first of a line, and where the hash is the least
        of the words of the text within the radius (of equal ones the first)."""
        n = len(self.hash)
        at = np.arange(n) + radius * (self.text + 1)       # texts are kept apart by the largest value
        x = np.full((at[-1] if n else 0) + radius + 1, np.uint64(2**64 - 1))
        x[at] = mixed(self.hash)
        mid = x[radius:len(x) - radius]
        least = np.ones(len(mid), bool)
        for k in range(1, radius + 1):
            least &= (mid < x[radius - k:len(x) - radius - k]) & (mid <= x[radius + k:len(x) - radius + k])
        low = least[at - radius]
        low[:1] = True
        low[1:] |= self.line[1:] != self.line[:-1]
        return low


_EVEN = np.random.Generator(np.random.PCG64(404)).integers(1, 2**62, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _digests(h: np.ndarray, begin: np.ndarray, size: np.ndarray, kind: int) -> list[np.ndarray]:
    """Two 64-bit digests of the word sequences that tile ``h`` from ``begin`` on."""
    place = (np.arange(len(h)) - np.repeat(begin, size)).astype(np.uint64)
    return [np.add.reduceat(mixed(h * _EVEN[k] + mixed((place + np.uint64(1)) * _EVEN[k + 1])), begin) * _EVEN[k + kind]
            for k in (0, 8)]


def units(w: Words, bands: int = 0):
    """((text, start, end, words, k1, k2), minima) of the pieces, or with ``bands`` of the lines; None without words."""
    n = len(w.hash)
    if not n:
        return None
    edge = np.concatenate([[True], w.line[1:] != w.line[:-1]]) if bands else w.cuts()
    begin = np.flatnonzero(edge)
    size = np.diff(np.append(begin, n))
    on = size >= (LINE if bands else PIECE)
    k1, k2 = _digests(w.hash, begin, size, 3 if bands else 2)
    found = [v[on] for v in (w.text[begin], w.start[begin], w.end[begin + size - 1], size, k1.view(np.int64), k2.view(np.int64))]
    if not bands:
        return found, None
    # shingles that stay inside their line; of lines too short for one no minimum is used
    most = np.full(n, np.uint64(2**64 - 1))
    low = [most[begin]] * bands
    if n >= SHINGLE:
        full = window_hashes(w.hash, SHINGLE)
        whole = w.line[SHINGLE - 1:] == w.line[:len(full)]
        low = [np.minimum.reduceat(np.append(np.where(whole, mixed(_EVEN[20 + b] * full), most[:len(full)]), most[len(full):]), begin) for b in range(bands)]
    return found, np.stack([x[on] for x in low], axis=1).view(np.int64)


def paragraphs(docs: DataFrame, bands: int) -> DataFrame:
    """(doc_id, pos, words, again, k1, k2, bands) of the pieces and, with ``bands`` that are not null, of the lines.

    pos is start * 2^32 + end; again: the text holds the same before.
    """
    names = ["doc_id", "pos", "words", "again", "k1", "k2", "bands"]

    def each(batches):
        hashes = WordHashes()
        for batch in batches:
            for first in range(0, batch.num_rows, 128):
                part = batch.slice(first, 128)
                w = Words([t or "" for t in part.column(1).to_pylist()], hashes)
                for n in (0, bands):
                    found = units(w, n)
                    if found is None:
                        continue
                    (text, start, end, size, k1, k2), low = found
                    again = pd.DataFrame({"t": text, "a": k1, "b": k2}).duplicated().to_numpy()
                    cols = [pa.array(part.column(0).to_numpy()[text]), pa.array((start << 32) | end), pa.array(size.astype(np.int32)),
                            pa.array(again), pa.array(k1), pa.array(k2)]
                    if n:
                        ends = pa.array(np.arange(len(text) + 1, dtype=np.int32) * n)
                        cols.append(pa.ListArray.from_arrays(ends, pa.array(low.ravel())))
                    else:
                        cols.append(pa.nulls(len(text), pa.list_(pa.int64())))
                    yield pa.RecordBatch.from_arrays(cols, names)
    return docs.where(F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        each, "doc_id long, pos long, words int, again boolean, k1 long, k2 long, bands array<long>")


def line_texts(lines: DataFrame, docs: DataFrame) -> DataFrame:
    """(n, line) of lines (n, doc_id, pos): one join with the texts, of which only the line is kept."""
    text = docs.where(F.col("text").isNotNull()).select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    start, end = F.shiftright("pos", 32).cast("int"), F.col("pos").bitwiseAND(F.lit(2**32 - 1)).cast("int")
    return lines.select("n", "doc_id", "pos").join(text, "doc_id").select("n", F.substring("text", start + 1, end - start).alias("line"))


def similar(pairs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """Pairs (u, v) with ``ok``: whether the exact Jaccard similarity of their lines (n, line) suffices."""
    def each(batches):
        hashes = WordHashes()
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                ok = []
                for a, b in zip(*(shingle_sets(part.column(i).to_pylist(), SHINGLE, hashes) for i in (2, 3)), strict=True):
                    both = len(np.intersect1d(a, b, assume_unique=True))
                    ok.append(100 * both >= percent * (len(a) + len(b) - both))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(ok, pa.bool_())], ["u", "v", "ok"])
    one, two = (texts.select(F.col("n").alias(s), F.col("line").alias(f"line_{s}")) for s in "uv")
    full = pairs.join(one, "u").join(two, "v").select("u", "v", "line_u", "line_v")
    # an id that stands for several texts gives a line several times
    return full.mapInArrow(each, "u long, v long, ok boolean").groupBy("u", "v").agg(F.max("ok").alias("ok"))


def prefixes(texts: DataFrame, percent: int) -> DataFrame:
    """(key, n, size, rest, indexed): the rarest shingles of each line (n, line), as many as similar lines have to meet in.

    With shingles in one order by frequency, two sets of at least that
    similarity share one of the first size - percent * size + 1 of the larger
    and the first size - 2 percent / (100 + percent) * size + 1 of the smaller
    (``indexed``); the first that they share leaves them no more in common
    than the ``rest`` of either, itself included. Shingles of one line only are
    counted and left out.
    """
    def each(batches):
        hashes = WordHashes()
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                sets = shingle_sets(part.column(1).to_pylist(), SHINGLE, hashes)
                ends = np.cumsum([0, *map(len, sets)]).astype(np.int32)
                flat = np.concatenate([*sets, np.zeros(0, np.uint64)]).view(np.int64)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(np.diff(ends)), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))],
                                                 ["n", "size", "all"])
    # an id that stands for several texts gives a line several sets
    sets = stored(texts.mapInArrow(each, "n long, size int, all array<long>").withColumn("copy", F.xxhash64("all")), "sets")
    each_one = sets.select("n", "copy", "size", F.explode("all").alias("key"))
    often = each_one.groupBy("key").agg(F.count(F.lit(1)).alias("count")).where("count > 1")
    ranked = (each_one.join(often, "key").groupBy("n", "copy", "size").agg(F.array_sort(F.collect_list(F.struct("count", "key"))).alias("all"))
              .withColumn("alone", F.col("size") - F.size("all")))
    least = lambda part: F.col("size") - F.ceil(F.col("size") * part[0] / part[1]) + 1 - F.col("alone")
    return (ranked.withColumn("reach", least((percent, 100)).cast("int")).withColumn("index", least((2 * percent, 100 + percent)).cast("int"))
            .where("reach > 0").select("n", "size", "alone", "index", F.posexplode(F.slice("all", F.lit(1), F.col("reach"))).alias("i", "x"))
            .select(F.col("x.key").alias("key"), "n", "size", (F.col("size") - F.col("alone") - F.col("i")).alias("rest"), (F.col("i") < F.col("index")).alias("indexed")).distinct())


def _keys(lines: DataFrame, bands: int) -> DataFrame:
    """(n, key): one for each of the bands."""
    return lines.select("n", F.explode(F.array(*[F.xxhash64(F.lit(i), F.get("bands", i)) for i in range(bands)])).alias("key"))


def _open(rows: DataFrame, part: DataFrame) -> DataFrame:
    """``rows`` (key, n, ...) of buckets whose lines are of several components, with ``component``."""
    of = rows.join(part.withColumnRenamed("node", "n"), "n", "left").withColumn("component", F.coalesce("component", "n"))
    several = of.groupBy("key").agg(F.min("component").alias("a"), F.max("component").alias("b")).where("a < b").select("key")
    return stored(of.join(several, "key", "left_semi"), "open")


class _Tried:
    """Pairs of lines tried so far, and the components of the similar ones."""

    def __init__(self, lines: DataFrame, docs: DataFrame, percent: int, pairs: DataFrame):
        self.percent = percent
        ends = pairs.select(F.col("u").alias("n")).union(pairs.select("v")).distinct()
        self.texts = stored(line_texts(lines.join(ends, "n", "left_semi"), docs), "line-texts")  # later rounds know no other lines
        self.pairs = stored(similar(pairs, self.texts, percent), "tried")
        self.part = checkpointed(components(self.links()))

    def links(self) -> DataFrame:
        return self.pairs.where("ok").select("u", "v")

    def add(self, pairs: DataFrame) -> None:
        new = stored(similar(pairs.distinct().join(self.pairs, ["u", "v"], "left_anti"), self.texts, self.percent), "tried")
        self.pairs = self.pairs.union(new)
        self.part = joined(self.part, new.where("ok").select("u", "v"))


def _pair(a: str, b: str) -> list:
    return [F.greatest(a, b).alias("u"), F.least(a, b).alias("v")]


def line_links(lines: DataFrame, docs: DataFrame, bands: int, percent: int) -> DataFrame:
    """(u, v) verified links between distinct lines (n, doc_id, pos, bands).

    Every two lines that share a bucket end in one component if they are
    similar. Lines are verified against the least line of each bucket, which
    then leaves. What is left of a bucket with several components is compared
    whole if it is small. The lines of larger ones meet by their rarest
    shingles, where no similar pair is missed: under each shingle all meet 1,
    4, 16, ... of those that index it, which then leave, until one component
    or no such line is left. Pairs that cannot be similar, by their sizes and
    by what follows the shingle in both, are not made.
    """
    rows = _keys(lines, bands)
    first = rows.groupBy("key").agg(F.min("n").alias("v"), F.count(F.lit(1)).alias("size")).where("size > 1").drop("size")
    met = stored(rows.join(first, "key").where(F.col("n") != F.col("v")), "met")
    tried = _Tried(lines, docs, percent, met.select(F.col("n").alias("u"), "v").distinct())
    rest = _open(met.select("key", "n"), tried.part)
    whole = rest.groupBy("key").agg(F.count(F.lit(1)).alias("size"))
    small = (rest.join(whole.where(F.col("size") <= SMALL), "key").groupBy("key")
             .agg(F.array_sort(F.collect_list(F.struct("n", "component"))).alias("all")))
    both = (small.select(F.posexplode("all").alias("i", "x"), "all").select("x", F.explode(F.slice("all", F.col("i") + 2, F.size("all"))).alias("y"))
            .where(F.col("x.component") != F.col("y.component")).select(*_pair("x.n", "y.n")))
    tried.add(both)
    large = rest.join(whole.where(F.col("size") > SMALL), "key", "left_semi").select("key", "n")
    large = _open(large, tried.part).select("n").distinct()
    rows, slots = stored(prefixes(tried.texts.join(large, "n", "left_semi"), percent), "prefixes"), 1
    while True:
        indexed = rows.groupBy("key").agg(F.max("indexed").alias("any")).where("any").select("key")
        rows = _open(rows.join(indexed, "key", "left_semi"), tried.part)
        if rows.isEmpty():
            return tried.links()
        slot = F.pmod(F.xxhash64(F.lit(slots), "n"), F.lit(slots))
        heads = stored(rows.where("indexed").groupBy("key", slot.alias("slot")).agg(F.min(F.struct("n", "component", "size", "rest")).alias("x"))
                       .select("key", F.col("x.n").alias("head"), F.col("x.component").alias("other"), F.col("x.size").alias("head_size"), F.col("x.rest").alias("head_rest")), "heads")
        fits = (100 + percent) * F.least("rest", "head_rest") >= percent * (F.col("size") + F.col("head_size"))
        tried.add(rows.join(heads, "key").where((F.col("component") != F.col("other")) & fits).select(*_pair("n", "head")))
        rows = rows.drop("component").join(heads.select("key", F.col("head").alias("n")), ["key", "n"], "left_anti")
        slots *= 4


def repeats(docs: DataFrame, percent: int = PERCENT, recall: float = RECALL) -> DataFrame:
    """(doc_id, spans, shared_with): repeated paragraphs of each document that has any.

    spans: array<struct<start,end,words,removed>> without overlaps, in order;
    shared_with: the documents that keep a copy of one.
    """
    ready(docs.sparkSession)
    bands = bands_for(percent, recall)
    both = stored(paragraphs(docs, bands), "paragraphs")
    pieces, whole = both.where(F.col("bands").isNull()), both.where(F.col("bands").isNotNull())
    same = pieces.groupBy("k1", "k2").agg(F.min("doc_id").alias("keeper"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    exact = stored(pieces.join(same, ["k1", "k2"]).select("doc_id", "pos", "words", "keeper", (F.col("again") | (F.col("doc_id") != F.col("keeper"))).alias("removed")), "repeats")
    # distinct lines: one row a key, in the document that keeps it
    lines = stored(whole.groupBy("k1", "k2").agg(F.min(F.struct("doc_id", "pos", "words", "bands")).alias("x"), F.count(F.lit(1)).alias("copies"))
                   .select(F.xxhash64("k1", "k2").alias("n"), "x.*", "k1", "k2", "copies"), "lines")
    part = checkpointed(components(line_links(lines, docs, bands, percent)))
    # a line that occurs more than once is repeated whether or not another is near it
    member = (lines.join(part, lines.n == part.node, "left").where(F.col("node").isNotNull() | (F.col("copies") > 1))
              .select("k1", "k2", F.coalesce("component", "n").alias("component"), F.col("doc_id").alias("first")))
    keeper = member.groupBy("component").agg(F.min("first").alias("keeper"), F.min_by(F.struct("k1", "k2"), F.struct("first", "k1", "k2")).alias("key"))
    member = member.join(keeper, "component").select("k1", "k2", "keeper", (F.struct("k1", "k2") != F.col("key")).alias("other"))
    near = (whole.join(member, ["k1", "k2"])
            .select("doc_id", "pos", "words", "keeper", (F.col("again") | F.col("other") | (F.col("doc_id") != F.col("keeper"))).alias("removed")))
    return merged(exact.union(near))


def merged(found: DataFrame) -> DataFrame:
    """Repeated paragraphs of each document joined to runs; runs of fewer than RUN words go.

    A run is a sequence of repeated paragraphs that overlap or lie side by
    side; its words are counted once.
    """
    span = F.struct(F.shiftright("pos", 32).cast("int").alias("start"), F.col("pos").bitwiseAND(F.lit(2**32 - 1)).cast("int").alias("end"),
                    F.col("words"), F.col("removed"))
    kind = "array<struct<start:int,end:int,words:int,removed:boolean>>"

    def step(acc, x):
        last = F.element_at(acc, -1)
        joined = F.struct(last["start"].alias("start"), F.greatest(last["end"], x["end"]).alias("end"),
                          F.when(x["end"] <= last["end"], last["words"]).when(x["start"] >= last["end"], last["words"] + x["words"])
                          .otherwise(F.greatest(last["words"], x["words"])).alias("words"), (last["removed"] | x["removed"]).alias("removed"))
        near = (F.size(acc) > 0) & (F.get(acc, F.size(acc) - 1)["end"] + 1 >= x["start"]) & (F.get(acc, F.size(acc) - 1)["removed"] == x["removed"])
        return F.when(near, F.array_append(F.slice(acc, 1, F.size(acc) - 1), joined)).otherwise(F.array_append(acc, x))
    per_doc = found.groupBy("doc_id").agg(F.sort_array(F.collect_set(span)).alias("all"), F.sort_array(F.collect_set(
        F.when(F.col("keeper") != F.col("doc_id"), F.col("keeper")))).alias("shared_with"))
    runs = F.aggregate("all", F.array().cast(kind), step)
    return (per_doc.select("doc_id", F.filter(runs, lambda s: s["words"] >= RUN).alias("spans"), "shared_with").where(F.size("spans") > 0))


def deduplicated(docs: DataFrame, found: DataFrame) -> DataFrame:
    """``docs`` with removed spans cut from their text; rows without one stay as they are."""
    cut = found.select(F.col("doc_id").cast("long").alias("_id"), F.filter("spans", lambda s: s["removed"]).alias("_cut"))
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    kept = F.aggregate("_cut", start, lambda acc, s: F.struct(s["end"].alias("at"), F.concat(
        acc["out"], F.substring("text", acc["at"] + 1, s["start"] - acc["at"])).alias("out")),
        lambda acc: F.concat(acc["out"], F.substring("text", acc["at"] + 1, F.length("text"))))
    joined = docs.join(cut, F.col("doc_id").cast("long") == F.col("_id"), "left")
    return joined.withColumn("text", F.when(F.size("_cut") > 0, kept).otherwise(F.col("text"))).select(*docs.columns)


def digests(found: DataFrame) -> DataFrame:
    """(doc_id, n_repeated, n_removed, removed, shared_with): words and removed spans ``start:end``, comma-joined."""
    words = lambda x: F.aggregate(x, F.lit(0).cast("long"), lambda a, s: a + s["words"])
    gone = F.filter("spans", lambda s: s["removed"])
    return found.select("doc_id", words(F.col("spans")).alias("n_repeated"), words(gone).alias("n_removed"), F.array_join(F.transform(
        gone, lambda s: F.concat_ws(":", s["start"].cast("string"), s["end"].cast("string"))), ",").alias("removed"), "shared_with")
