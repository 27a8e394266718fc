"""Merkle manifest of a dataset: one tree per source, one over the sources, and a proof for every row.

Rows of a source ascend by id; every FAN consecutive nodes become their hash
until one is left, the source's subroot. Subroots in the order of their
sources (null first, UTF-8 bytewise) likewise give the root.

Checkpoint and recompute: of every tree only each ``deep``-th level is
written, in blocks of FAN ** deep neighbouring nodes, which are the aligned
subtrees between two written levels. Hashing up, a block becomes its top node.
Proofs come down: a block meets the proof of its top node, makes the missing
interior nodes of its subtree again from the written ones, hands each of its
nodes the siblings on its way up, and drops the interior nodes.

Places in a tree come from a range partitioning on (source, id) with the number
of rows of each range before it: a source of any size is spread over ranges,
and what is summed in one place is one row per range and source.

Siblings stand as text: for every level up to the root ``left.right``, levels
joined by ``,`` and several hashes of a side not separated (they are of equal
length).

Defined results: a null id comes first; rows that repeat an id are ordered by
their hash, equal rows have the same hash and either order; a null source has a
tree of its own, apart from the empty text; a source of one row has that
row's hash as its subroot. No rows give no root and no proofs.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from nightledger.llm.common import ready, stored

FAN, DEEP = 3, 4
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
POWERS = [FAN ** d for d in range(39)]   # below 2**63


def joined(cols: list[Column]) -> Column:
    """The values in order, each ``-`` if null, else its UTF-8 byte count, ``:`` and itself."""
    text = [c.cast("string") for c in cols]
    return F.concat(*[F.when(t.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t)) for t in text])


def leaf_hash(*cols: Column) -> Column:
    return F.sha2(joined(list(cols)).cast("binary"), 256)


def leaves(docs: DataFrame, claims: Column | None = None) -> DataFrame:
    """(doc_id, tree, leaf, claim) of every row; ``claims``: the text that a reader shows, by default the row's own."""
    own = leaf_hash(*[F.col(c) for c in FIELDS])
    claim = own if claims is None else leaf_hash(*[F.col(c) for c in FIELDS[:-1]], claims)
    return docs.select(F.col("doc_id").cast("long"), F.col("source").alias("tree"), own.alias("leaf"), claim.alias("claim"))


def ranked(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` with their place ``pos`` in their ``tree`` by ``order``, and the tree's number of levels ``levels``."""
    # equal rows are told apart by their place in the input, so a range ends inside a large group of them too
    keys = ["tree", *order, "_row"]
    spread = rows.withColumn("_row", F.monotonically_increasing_id()).repartitionByRange(*keys).sortWithinPartitions(*keys).drop("_row")
    spread = stored(spread.select("*", F.spark_partition_id().alias("_part"), F.monotonically_increasing_id().alias("_at")), "ranked")
    of_tree = Window.partitionBy("tree")
    runs = spread.groupBy("tree", "_part").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    runs = runs.select(F.col("tree").alias("_tree"), F.col("_part").alias("_of"), "_first",
                       (F.sum("_n").over(of_tree.orderBy("_part")) - F.col("_n")).alias("_start"), F.sum("_n").over(of_tree).alias("_all"))
    runs = runs.withColumn("levels", F.size(F.filter(F.array(*map(F.lit, POWERS)), lambda p: p < F.col("_all"))))
    met = spread.join(runs, (F.col("_part") == F.col("_of")) & F.col("tree").eqNullSafe(F.col("_tree")))
    return met.select(*rows.columns, "levels", (F.col("_at") - F.col("_first") + F.col("_start")).alias("pos"))


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def subtree(nodes: list[str], levels: int) -> list[list[str]]:
    """The nodes and the ``levels`` levels above them."""
    out = [nodes]
    for _ in range(levels):
        nodes = [sha("".join(nodes[i:i + FAN])) for i in range(0, len(nodes), FAN)]
        out.append(nodes)
    return out


def siblings(tree: list[list[str]], i: int) -> list[tuple[str, str]]:
    """Left and right of node ``i`` and of each node above it, below the top."""
    out = []
    for row in tree[:-1]:
        at = i - i % FAN
        out.append(("".join(row[at:i]), "".join(row[i + 1:at + FAN])))
        i //= FAN
    return out


def fold(node: str, path: list[tuple[str, str]]) -> str:
    """The root that ``node`` and its siblings lead to."""
    for left, right in path:
        node = sha(left + node + right)
    return node


def said(path: list[tuple[str, str]]) -> str:
    return ",".join([f"{left}.{right}" for left, right in path])


def read(path: str) -> list[tuple[str, str]]:
    return [tuple(level.split(".")) for level in path.split(",")] if path else []


@dataclass
class Forest:
    """Written levels of the trees: blocks (tree, block, levels, items), the lowest first; tops (tree, levels, top)."""

    written: list[DataFrame]
    tops: DataFrame
    deep: int


def _span(levels: int, k: int, deep: int) -> int:
    """Levels between written level ``k`` and the next one or the top."""
    return max(0, min(deep, levels - k * deep))


def grown(nodes: DataFrame, items: list[str], deep: int = DEEP) -> Forest:
    """Hash the ranked ``nodes`` (tree, levels, pos, hash and ``items``) up to one node a tree."""
    def up(k):
        def each(batches):
            for batch in batches:
                tops = []
                for levels, row in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                    tops.append(subtree(row, _span(levels, k, deep))[-1][0])
                yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(tops, pa.string())], ["tree", "pos", "levels", "hash"])
        return each

    written, tops, k = [], None, 0
    while True:
        block = F.expr(f"pos div {FAN ** deep}").alias("block")
        rows = nodes.groupBy("tree", block).agg(F.first("levels").alias("levels"),
                                                F.array_sort(F.collect_list(F.struct("pos", "hash", *(items if not k else [])))).alias("items"))
        written.append(stored(rows, "level"))
        up_one = written[-1].select("tree", "block", "levels", F.col("items.hash").alias("hashes")).mapInArrow(
            up(k), "tree string, pos long, levels int, hash string")
        nodes = stored(up_one, "nodes")
        k += 1
        done = nodes.where(F.col("levels") <= k * deep).select("tree", "levels", F.col("hash").alias("top"))
        tops = done if tops is None else tops.union(done)
        nodes = nodes.where(F.col("levels") > k * deep)
        if nodes.isEmpty():
            return Forest(written, stored(tops, "tops"), deep)


def _blocks_with_paths(forest: Forest, k: int, above: DataFrame) -> DataFrame:
    of = above.select(F.col("tree").alias("_tree"), F.col("pos").alias("_pos"), "path", "top")
    blocks = forest.written[k]
    return blocks.join(of, blocks.tree.eqNullSafe(of._tree) & (blocks.block == of._pos)).select("tree", "levels", "items", "path", "top")


def paths(forest: Forest, tops: DataFrame) -> DataFrame:
    """Blocks of the lowest written level (tree, levels, items, path, top) with the path from their top node to the root.

    ``tops`` (tree, levels, path, top) are the trees' tops with the paths above them.
    """
    deep = forest.deep   # tasks know numbers, not the forest

    def down(k):
        def each(batches):
            for batch in batches:
                out = {"tree": [], "levels": [], "pos": [], "path": [], "top": []}
                for tree, levels, items, path, top in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    made, end = subtree([x["hash"] for x in items], _span(levels, k, deep)), "," + path if path else ""
                    for i, x in enumerate(items):
                        out["tree"].append(tree)
                        out["levels"].append(levels)
                        out["pos"].append(x["pos"])
                        out["path"].append(said(siblings(made, i)) + end)
                        out["top"].append(top)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out.values(), (
                    pa.string(), pa.int32(), pa.int64(), pa.string(), pa.string()), strict=True)], list(out))
        return each

    above = None
    for k in reversed(range(len(forest.written))):
        at_top = (F.col("levels") <= (k + 1) * deep) & ((F.col("levels") > k * deep) if k else F.lit(True))
        own = tops.where(at_top).select("tree", "levels", F.lit(0).cast("long").alias("pos"), "path", "top")
        above = own if above is None else above.unionByName(own)
        blocks = _blocks_with_paths(forest, k, above)
        if not k:
            return blocks
        above = stored(blocks.mapInArrow(down(k), "tree string, levels int, pos long, path string, top string"), "paths")
    raise AssertionError


def manifest(rows: DataFrame, deep: int = DEEP) -> tuple[Forest, Forest]:
    """The trees of the sources and the one over their subroots, for rows of ``leaves``."""
    ready(rows.sparkSession)
    own = stored(rows.select("doc_id", "tree", "leaf", "claim"), "leaves")
    trees = grown(ranked(own, ["doc_id", "leaf"]).withColumnRenamed("leaf", "hash"), ["doc_id", "claim"], deep)
    heads = trees.tops.select(F.lit("").alias("tree"), F.col("tree").alias("source"), F.col("top").alias("hash"))
    return trees, grown(ranked(heads, ["source"]), ["source"], deep)


def proofs(trees: Forest, over: Forest) -> DataFrame:
    """(doc_id, source, leaf, claim, subroot, root, path, folded_root) of every row.

    ``path`` holds the siblings up to the root; ``folded_root`` is what they
    make of ``claim``.
    """
    deep = trees.deep

    def heads(batches):
        for batch in batches:
            out = {"tree": [], "path": [], "root": []}
            for _, levels, items, path, top in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                made = subtree([x["hash"] for x in items], _span(levels, 0, deep))
                for i, x in enumerate(items):
                    out["tree"].append(x["source"])
                    out["path"].append(",".join(filter(None, (said(siblings(made, i)), path))))
                    out["root"].append(top)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in out.values()], ["_tree", "path", "root"])

    def rows(batches):
        kinds = {"doc_id": pa.int64(), **dict.fromkeys(("source", "leaf", "claim", "subroot", "path", "folded_root"), pa.string())}
        for batch in batches:
            for at in range(batch.num_rows):  # a block of paths at a time
                tree, levels, items, path, top = (c[0].as_py() for c in batch.slice(at, 1).columns)
                made, above = subtree([x["hash"] for x in items], _span(levels, 0, deep)), read(path)
                out, end = [], "," + path if path else ""
                for i, x in enumerate(items):
                    own = siblings(made, i)
                    out.append((x["doc_id"], tree, x["hash"], x["claim"], top, said(own) + end if own else path, fold(x["claim"], own + above)))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds.values(), strict=True)], list(kinds))

    spark = trees.tops.sparkSession
    top = over.tops.first()
    root = None if top is None else top.top
    of_root = spark.createDataFrame([] if top is None else [("", top.levels, "", root)], "tree string, levels int, path string, top string")
    upper = paths(over, of_root).mapInArrow(heads, "_tree string, path string, root string")
    tops = trees.tops.join(upper, trees.tops.tree.eqNullSafe(F.col("_tree"))).select("tree", "levels", "path", "top")
    made = paths(trees, stored(tops, "subroots")).mapInArrow(
        rows, "doc_id long, source string, leaf string, claim string, subroot string, path string, folded_root string")
    return made.withColumn("root", F.lit(root).cast("string"))


def digests(proved: DataFrame) -> DataFrame:
    """The siblings as one hash, and whether the claim leads to the root."""
    return proved.select("doc_id", "leaf", "subroot", "root",
                         F.sha2(F.translate("path", ".,", "").cast("binary"), 256).alias("proof_sha256"),
                         "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))
