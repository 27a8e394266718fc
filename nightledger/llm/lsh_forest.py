"""MinHash near-duplicates by an LSH forest.

Every document's set of word shingles gets a MinHash signature. A tree of the
forest reads the signature in an order of its own: its label is a fixed number
of signature values. Sorting all labels of a tree puts documents with a long
common prefix side by side, so the candidates of a document are its
neighbours in the sorted orders that agree on MIN_DEPTH values or more,
however many rows share them: neighbour pairs are linear in the rows, and the
sorting puts those that agree longest side by side.

Candidates are confirmed on the full shingle sets. Confirmed links become
components. Candidates are tried in two rounds: each document's best one
first, then all whose ends the first round left in different components, so a
group of thousands of copies is not compared pair by pair.

Neighbours alone miss members of a star: copies of one document that are not
copies of each other stand between it and the rest. So all documents that
share the first LEVELS[0] values of a label are a region. First one member of
each component meets the region's head, which ends most regions. Those that
still hold several components go on, each as deep as it has to: a region of at
most SMALL members has all its pairs of different components tried and is done;
in a larger one every member outside the component of the region's head (the
member with the most links) meets the head, and the region falls apart by
the next values of the label. The pairs of all levels are tried together. So a level adds at most one pair a member and tree
in large regions and (SMALL - 1) / 2 in small ones, whatever the regions'
sizes, and never all pairs of a template. A region that still holds more than
SMALL members of several components when the label ends agrees on LEVELS[-1]
values of one order; there members meet 4, 64, ... representatives until one
component or one member is left.

Exact copies (equal sets) are one node from the start, found by a grouped
minimum. Sorting is a range partitioning on (tree, label, node), so equal
labels are spread over partitions too.

Sets hold 64-bit hashes of shingles, two different shingles of one pair meet
with odds below 1e-12.

Defined results: null or blank text has an empty set and stays alone;
fewer words than a shingle make one shingle of the whole; rows with a null
id keep their count, have a null component and are kept; repeated rows
give repeated results. Extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from nightledger.llm.common import WordHashes, checkpointed, let_go, ready, shingle_sets, small_batches, stored
from nightledger.llm.components import components, joined

VALUES, TREES, DEPTH = 128, 32, 12      # signature values, trees, values in a sorted label
MIN_DEPTH = 5                           # least common prefix of candidates
LEVELS = (MIN_DEPTH, 8, 11, 14, 17, 20, 24)   # values that the members of a region share, level by level
SMALL = 8                               # members up to which a region is compared whole
MEETS = f"n <= {SMALL} or component <> other"   # who meets others: small regions whole, else those outside the head's component


def _orders():
    """Multipliers and offsets of the hash functions, and each tree's order of values."""
    rng = np.random.Generator(np.random.PCG64(20240101))
    a = rng.integers(1, 2**63, VALUES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    b = rng.integers(0, 2**63, VALUES, dtype=np.uint64)
    return a, b, np.stack([rng.permutation(VALUES)[:LEVELS[-1]] for _ in range(TREES)])


def signatures(docs: DataFrame, k: int) -> DataFrame:
    """(doc_id, n_shingles, digest, sig): digest identifies the set, null if it is empty; sig has two bytes of each minimum."""
    def each(batches):
        let_go()
        hashes, (a, b, _) = WordHashes(), _orders()
        a, b = a[:, None], b[:, None]
        for batch in batches:
            for at in range(0, batch.num_rows, 128):
                part = batch.slice(at, 128)
                n, digest, sig = [], [], []
                for s in shingle_sets(part.column(1).to_pylist(), k, hashes):
                    n.append(len(s))
                    if not len(s):
                        digest.append(None)
                        sig.append(None)
                        continue
                    digest.append(xxhash.xxh3_128_digest(s.tobytes()))
                    low = np.full(VALUES, np.uint64(2**64 - 1))
                    for i in range(0, len(s), 512):  # bounded memory for very long texts
                        low = np.minimum(low, (a * s[None, i:i + 512] + b).min(axis=1))
                    sig.append((low >> np.uint64(32)).astype(np.uint16).astype(">u2").tobytes())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(n, pa.int64()), pa.array(digest, pa.binary()),
                     pa.array(sig, pa.binary())], ["doc_id", "n_shingles", "digest", "sig"])
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        each, "doc_id long, n_shingles long, digest binary, sig binary")


def _labels(nodes: DataFrame) -> DataFrame:
    """(node, sig) -> (tree, label, node)."""
    def each(batches):
        _, _, orders = _orders()
        for batch in batches:
            if not batch.num_rows:
                continue
            sig = np.frombuffer(b"".join(batch.column(1).to_pylist()), ">u2").reshape(-1, VALUES)
            for t, order in enumerate(orders):
                rows = np.ascontiguousarray(sig[:, order[:DEPTH]])
                label = pa.Array.from_buffers(pa.binary(2 * DEPTH), len(rows), [None, pa.py_buffer(rows)])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(rows), t, np.int32)), label.cast(pa.binary()), batch.column(0)],
                    ["tree", "label", "node"])
    return nodes.mapInArrow(each, "tree int, label binary, node long")


def _common(tree: np.ndarray, label: np.ndarray) -> np.ndarray:
    """Length of the common prefix of each row with the row before it (first row: 0)."""
    out = np.zeros(len(tree), np.int32)
    if len(tree) > 1:
        same = (label[1:] == label[:-1]) & (tree[1:] == tree[:-1])[:, None]
        out[1:] = np.cumprod(same, axis=1).sum(axis=1)
    return out


def _neighbours(labels: DataFrame) -> DataFrame:
    """Candidate pairs (u, v, depth) of neighbours in the sorted orders; u is the larger node."""
    def each(batches):
        last, edge = None, lambda row: ([row[2]], [None], [0], [row[0]], [row[1].tobytes()])
        names = ["u", "v", "depth", "tree", "label"]
        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary()]
        made = lambda cols: pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names)
        for batch in batches:
            if not batch.num_rows:
                continue
            tree = batch.column(0).to_numpy()
            label = np.frombuffer(b"".join(batch.column(1).to_pylist()), ">u2").reshape(-1, DEPTH)
            node = batch.column(2).to_numpy()
            if last is None:
                yield made(edge((tree[0], label[0], node[0])))
            else:
                tree, label, node = (np.concatenate([[x], y]) for x, y in zip(last, (tree, label, node), strict=True))
            lcp = _common(tree, label)
            at = np.flatnonzero(lcp >= MIN_DEPTH)
            u, v = np.maximum(node[at], node[at - 1]), np.minimum(node[at], node[at - 1])
            none = [None] * len(at)
            yield made((u, v, lcp[at], none, none))
            last = (tree[-1], label[-1].copy(), node[-1])
        if last is not None:
            yield made(edge(last))
    spread = labels.repartitionByRange("tree", "label", "node").sortWithinPartitions("tree", "label", "node")
    found = stored(spread.mapInArrow(each, "u long, v long, depth int, tree int, label binary"), "forest")
    # where one partition ends and the next begins: two rows a partition
    ends = found.where(F.col("v").isNull()).select("tree", "label", F.col("u").alias("node")).distinct()
    before = Window.partitionBy("tree").orderBy("label", "node")
    joint = ends.select("node", F.lag("node").over(before).alias("other"), "label",
                        F.lag("label").over(before).alias("was"))
    head = 2 * MIN_DEPTH
    joint = joint.where(F.substring("label", 1, head) == F.substring("was", 1, head)).select(
        F.greatest("node", "other").alias("u"), F.least("node", "other").alias("v"),
        F.lit(MIN_DEPTH).alias("depth"))
    return (found.where(F.col("v").isNotNull()).select("u", "v", "depth").union(joint)
            .groupBy("u", "v").agg(F.max("depth").alias("depth"), F.count(F.lit(1)).alias("n")))


def confirmed(pairs: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """Pairs (u, v) whose full sets overlap enough; ``texts`` has (doc_id, text)."""
    def each(batches):
        hashes = WordHashes()
        for batch in batches:
            for at in range(0, batch.num_rows, 128):
                part, keep = batch.slice(at, 128), []
                for a, b in zip(*(shingle_sets(part.column(i).to_pylist(), k, hashes) for i in (2, 3)), strict=True):
                    both = len(np.intersect1d(a, b, assume_unique=True))
                    keep.append(100 * both >= percent * (len(a) + len(b) - both))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1)], ["u", "v"]).filter(pa.array(keep, pa.bool_()))
    one = texts.select(F.col("doc_id").cast("long").alias("u"), F.col("text").alias("x"))
    two = texts.select(F.col("doc_id").cast("long").alias("v"), F.col("text").alias("y"))
    full = pairs.select("u", "v").join(one, "u").join(two, "v").select("u", "v", "x", "y")
    return full.mapInArrow(each, "u long, v long").distinct()


def _with_labels(rows: DataFrame, nodes: DataFrame) -> DataFrame:
    """``rows`` (tree, node, ...) with ``label``: LEVELS[-1] signature values in the tree's order."""
    def each(batches):
        _, _, orders = _orders()
        for batch in batches:
            if not batch.num_rows:
                continue
            sig = np.frombuffer(b"".join(batch.column(batch.num_columns - 1).to_pylist()), ">u2").reshape(-1, VALUES)
            label = np.ascontiguousarray(np.take_along_axis(sig, orders[batch.column(0).to_numpy()], axis=1))
            made = pa.Array.from_buffers(pa.binary(2 * LEVELS[-1]), len(label), [None, pa.py_buffer(label)])
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], made.cast(pa.binary())], [*batch.schema.names[:-1], "label"])
    facts = ["tree", "node", "component", "degree"]
    return rows.select(*facts).join(nodes.select("node", "sig"), "node").select(*facts, "sig").mapInArrow(
        each, "tree int, node long, component long, degree long, label binary")


def _members(nodes: DataFrame, part: DataFrame, degrees: DataFrame) -> DataFrame:
    """(bucket, tree, node, component, degree): every node in its region of the first level in every tree."""
    def each(batches):
        _, _, orders = _orders()
        for batch in batches:
            if not batch.num_rows:
                continue
            sig = np.frombuffer(b"".join(batch.column(3).to_pylist()), ">u2").reshape(-1, VALUES)
            for t, order in enumerate(orders):
                rows = np.ascontiguousarray(sig[:, order[:LEVELS[0]]])
                label = pa.Array.from_buffers(pa.binary(2 * LEVELS[0]), len(rows), [None, pa.py_buffer(rows)])
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(rows), t, np.int32)), *batch.columns[:3], label.cast(pa.binary())],
                                                 ["tree", "node", "component", "degree", "label"])
    known = (nodes.select("node", "sig").join(part, "node", "left").join(degrees, "node", "left")
             .select("node", F.coalesce("component", "node").alias("component"), F.coalesce("degree", F.lit(0)).alias("degree"), "sig"))
    return (known.mapInArrow(each, "tree int, node long, component long, degree long, label binary")
            .select(_bucket(LEVELS[0]), "tree", "node", "component", "degree"))


def _bucket(depth: int):
    """The region of a label's first values."""
    return F.xxhash64("tree", F.substring("label", 1, 2 * depth)).alias("bucket")


class _Tried:
    """Links found so far, and the pairs that need not be tried again."""

    def __init__(self, docs: DataFrame, k: int, percent: int, links: DataFrame):
        self.docs, self.k, self.percent, self.links, self.pairs, self.texts = docs, k, percent, links, None, None

    def degrees(self) -> DataFrame:
        return self.links.select(F.explode(F.array("u", "v")).alias("node")).groupBy("node").agg(F.count(F.lit(1)).alias("degree"))

    def join(self, part: DataFrame, pairs: DataFrame, rows: DataFrame | None = None) -> DataFrame:
        """``part`` after ``pairs`` were tried, whose nodes and those of all later rounds are in ``rows`` if given."""
        pairs = pairs.distinct()
        if self.pairs is not None:
            pairs = pairs.join(self.pairs, ["u", "v"], "left_anti")
        pairs = stored(pairs, "candidates")
        if pairs.isEmpty():
            return part
        texts = self.texts
        if texts is None:
            ids = (pairs.select(F.explode(F.array("u", "v")).alias("node")) if rows is None else rows).select(F.col("node").alias("doc_id")).distinct()
            texts = stored(self.docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(ids, "doc_id", "left_semi"), "texts")
            self.texts = None if rows is None else texts
        self.pairs = pairs if self.pairs is None else self.pairs.union(pairs)
        new = stored(confirmed(pairs, texts, self.k, self.percent), "links")
        if new.isEmpty():
            return part
        self.links = self.links.union(new)
        return joined(part, new)


def _pair(a: str, b: str) -> list:
    return [F.greatest(a, b).alias("u"), F.least(a, b).alias("v")]


def linked_in_regions(nodes: DataFrame, part: DataFrame, links: DataFrame, docs: DataFrame, k: int, percent: int) -> DataFrame:
    """``part`` (node, component) after the regions' members were tried as the module says.

    ``links`` are the pairs (u, v) confirmed so far.
    """
    tried = _Tried(docs, k, percent, links)
    part = _to_heads(_members(nodes, part, tried.degrees()), part, tried)
    rows = _members(nodes, part, tried.degrees())
    first = stored(rows.join(_mixed(rows), "bucket"), "mixed")
    if first.isEmpty():
        return part
    # deeper levels: regions are counted, and joined with the members that meet others only
    rows = stored(_with_labels(first.where(F.col("n") > SMALL), nodes), "labels")
    met = first
    for depth in LEVELS[1:]:
        known = rows.select(_bucket(depth), *rows.columns)
        region = _mixed(known)
        met = met.unionByName(known.join(region, "bucket").where(MEETS).select(*met.columns))
    met = stored(met.where(MEETS).select("bucket", "node", "component", "n", "head"), "met")
    to_head = met.where(F.col("n") > SMALL).select(*_pair("node", "head"))
    # at most SMALL members a row, pairs of different components
    whole = met.where(F.col("n") <= SMALL).groupBy("bucket").agg(F.array_sort(F.collect_list(F.struct("node", "component"))).alias("m"))
    both = (whole.select(F.posexplode("m").alias("i", "x"), "m")
            .select("x", F.explode(F.slice("m", F.col("i") + 2, F.size("m"))).alias("y"))
            .where(F.col("x.component") != F.col("y.component")).select(*_pair("x.node", "y.node")))
    part = tried.join(part, to_head.union(both), first)
    return _to_the_end(known.join(region.where(F.col("n") > SMALL), "bucket", "left_semi").select("bucket", "node"), part, tried)


def _mixed(rows: DataFrame) -> DataFrame:
    """(bucket, n, head, other): regions of several components, their members, best linked one and its component."""
    return (rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.min("component").alias("a"), F.max("component").alias("b"),
                                       F.max(F.struct("degree", (-F.col("node")).alias("least"), "component")).alias("x")).where("a < b")
            .select("bucket", "n", (-F.col("x.least")).alias("head"), F.col("x.component").alias("other")))


def _to_heads(rows: DataFrame, part: DataFrame, tried: _Tried) -> DataFrame:
    """The best linked member of each component in a region (bucket, node, component, degree) meets the region's head."""
    best = F.max(F.struct("degree", (-F.col("node")).alias("least"))).alias("x")
    reps = rows.groupBy("bucket", "component").agg(best)
    heads = (reps.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.max(F.struct("x.degree", "x.least", "component")).alias("h")).where("n > 1")
             .select("bucket", (-F.col("h.least")).alias("head"), F.col("h.component").alias("other")))
    pairs = (reps.join(heads, "bucket").where(F.col("component") != F.col("other"))
             .select("head", (-F.col("x.least")).alias("node")).select(*_pair("node", "head")))
    return tried.join(part, pairs)


def _to_the_end(rows: DataFrame, part: DataFrame, tried: _Tried) -> DataFrame:
    """Regions (bucket, node) until each holds one component: members meet ever more representatives, which then leave."""
    slots = 4
    while True:
        of = rows.join(part, "node", "left").withColumn("component", F.coalesce("component", "node"))
        several = of.groupBy("bucket").agg(F.min("component").alias("a"), F.max("component").alias("b")).where("a < b").select("bucket")
        of = stored(of.join(several, "bucket", "left_semi"), "mixed")
        if of.isEmpty():
            return part
        slot = F.pmod(F.xxhash64(F.lit(slots), "node"), F.lit(slots))
        heads = stored(of.groupBy("bucket", slot.alias("slot")).agg(F.min(F.struct("node", "component")).alias("x"))
                       .select("bucket", F.col("x.node").alias("head"), F.col("x.component").alias("other")), "heads")
        pairs = of.join(heads, "bucket").where(F.col("component") != F.col("other")).select(*_pair("node", "head"))
        part = tried.join(part, pairs, of)
        rows = of.select("bucket", "node").join(heads.select("bucket", F.col("head").alias("node")), ["bucket", "node"], "left_anti")
        slots *= 16


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of ``docs`` (doc_id, text).

    Documents are linked when 100 * intersection >= percent * union of their
    shingle sets; ``component_id`` is the least doc_id that links reach.
    """
    ready(docs.sparkSession)
    small_batches(docs.sparkSession)
    sets = stored(signatures(docs, k), "signatures")
    known = sets.where(F.col("digest").isNotNull() & F.col("doc_id").isNotNull())
    nodes = stored(known.groupBy("digest").agg(F.min("doc_id").alias("node"), F.first("sig").alias("sig")), "nodes")
    labels = _labels(nodes.select("node", "sig"))
    pairs = stored(_neighbours(labels), "candidates")
    # round 1: each node's best candidate, as the larger end
    best = (pairs.groupBy("u").agg(F.max_by("v", F.struct("depth", "n", -F.col("v"))).alias("v")))
    first = stored(confirmed(best, docs, k, percent), "links")
    part = checkpointed(components(first))
    rest = (pairs.select("u", "v").join(best, ["u", "v"], "left_anti")
            .join(part.select(F.col("node").alias("u"), F.col("component").alias("cu")), "u", "left")
            .join(part.select(F.col("node").alias("v"), F.col("component").alias("cv")), "v", "left")
            .where(F.coalesce("cu", "u") != F.coalesce("cv", "v")))
    second = stored(confirmed(rest, docs, k, percent), "links")
    whole = linked_in_regions(nodes, joined(part, second), first.union(second), docs, k, percent)
    named = (nodes.select("digest", "node").join(whole, "node", "left")
             .select("digest", F.coalesce("component", "node").alias("component_id")))
    of_empty = F.when(F.col("digest").isNull(), F.col("doc_id"))
    return (sets.drop("sig").join(named, "digest", "left")
            .select("doc_id", "n_shingles",
                    F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", of_empty)).alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))))
