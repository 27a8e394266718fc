"""Nearest neighbours by a hierarchical k-means tree with best-bin-first search.

The tree is fitted on a bounded, hash-chosen sample (SAMPLE vectors): each
node is split into BRANCH clusters until LEAF sample vectors are left. Every
row of the table is then sent down the tree to its leaf, so the index holds
all rows. A query walks the tree through a priority queue of nodes by the
distance to their centres, which gives leaves in the order of their promise;
it visits the first so many. That number is calibrated: it is widened until
the mean recall of sample queries against brute force over the sample
reaches RECALL.

Rows are dealt to blocks of about BLOCK rows: neighbouring small leaves share
a block, a leaf with more rows is spread over several by a hash of the id, so
a very frequent vector or a dense leaf is never one task. Queries go to the
blocks of the leaves they visit; each block returns its best K per query, and
these few rows are merged. Distances are taken in double precision on the
original vectors.

Defined results: vectors that are null or zero, or hold null or non-finite
components, and rows without an id take no part; nor do vectors of another
length than most of the sample. Ties go to the smaller id; an id that occurs
repeatedly is one candidate with its least distance, and one query (its
least vector). Fewer candidates than K give them all. An empty table gives
no rows. Extra columns are ignored.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from nightledger.llm.common import bounded_sample, ready, stored

SAMPLE, BRANCH, LEAF, LLOYD = 20_000, 8, 64, 8
BLOCK, RECALL, CALIBRATION = 2000, 0.97, 300


class Tree:
    """Centres and children of all nodes; leaves are numbered left to right."""

    def __init__(self, x: np.ndarray, seed: int = 7):
        self.rng = np.random.default_rng(seed)
        self.centres: list[np.ndarray] = [x.mean(axis=0)]
        self.children: list[list[int]] = [[]]
        self.leaf: list[int] = [-1]
        self._grow(0, x)
        stack, n = [0], 0
        while stack:
            node = stack.pop()
            if self.children[node]:
                stack += reversed(self.children[node])
            else:
                self.leaf[node] = n
                n += 1
        self.n_leaves = n
        self.below = [np.stack([self.centres[c] for c in kids]) if kids else None for kids in self.children]
        del self.rng

    def _grow(self, root: int, x: np.ndarray) -> None:
        todo = [(root, x)]
        while todo:
            node, part = todo.pop()
            if len(part) <= LEAF or len(uniq := np.unique(part, axis=0)) < 2:
                continue
            c = uniq[self.rng.permutation(len(uniq))[:BRANCH]]
            for _ in range(LLOYD):
                near = nearest(part, c)
                c = np.stack([part[near == j].mean(axis=0) if (near == j).any() else c[j] for j in range(len(c))])
            near = nearest(part, c)
            groups = [j for j in range(len(c)) if (near == j).any()]
            if len(groups) < 2:
                continue
            for j in groups:
                self.children[node].append(len(self.centres))
                self.centres.append(c[j])
                self.children.append([])
                self.leaf.append(-1)
                todo.append((self.children[node][-1], part[near == j]))

    def leaf_of(self, x: np.ndarray) -> np.ndarray:
        """Leaf of each vector, going to the nearest centre at every node."""
        out = np.zeros(len(x), int)
        todo = [(0, np.arange(len(x)))]
        while todo:
            node, rows = todo.pop()
            if not self.children[node]:
                out[rows] = self.leaf[node]
                continue
            near = nearest(x[rows], self.below[node])
            todo += [(c, rows[near == j]) for j, c in enumerate(self.children[node]) if (near == j).any()]
        return out

    def leaves_for(self, q: np.ndarray, most: int) -> list[int]:
        """The first ``most`` leaves of a best-bin-first walk."""
        queue, out = [(0.0, 0)], []
        while queue and len(out) < most:
            _, node = heapq.heappop(queue)
            if not self.children[node]:
                out.append(self.leaf[node])
                continue
            d = ((self.below[node] - q) ** 2).sum(axis=1)
            for c, v in zip(self.children[node], d.tolist(), strict=True):
                heapq.heappush(queue, (v, c))
        return out

    def calibrated(self, x: np.ndarray, k: int, recall: float = RECALL) -> int:
        """Leaf visits at which sample queries find ``recall`` of their k nearest sample vectors."""
        leaf = self.leaf_of(x)
        orders, truth = [], []
        for i in range(0, len(x), max(1, len(x) // CALIBRATION)):
            d = ((x - x[i]) ** 2).sum(axis=1)
            d[i] = np.inf
            truth.append(leaf[np.argsort(d, kind="stable")[:min(k, len(x) - 1)]])
            orders.append(self.leaves_for(x[i], self.n_leaves))
        visits = 1
        while visits < self.n_leaves:
            hits = [np.isin(t, o[:visits]).mean() if len(t) else 1.0 for t, o in zip(truth, orders, strict=True)]
            if np.mean(hits) >= recall:
                break
            visits += max(1, visits // 8)
        return min(visits, self.n_leaves)


def nearest(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    d = (c**2).sum(axis=1)[None, :] - 2 * x @ c.T
    return d.argmin(axis=1)


def usable(rows: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    """(vec_id, v array<double>) of the rows that take part."""
    v = F.col(embedding).cast("array<double>")
    fine = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    return (rows.select(F.col(vec_id).cast("long").alias("vec_id"), v.alias("v"))
            .where(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & F.forall("v", fine) & F.exists("v", lambda x: x != 0)))


def blocks_of(counts: dict[int, int], n_leaves: int) -> list[tuple[int, int]]:
    """(first block, number of blocks) of each leaf, in tree order."""
    out, block, filled = [], 0, 0
    for leaf in range(n_leaves):
        n = counts.get(leaf, 0)
        if n > BLOCK:
            block += filled > 0
            parts = -(-n // BLOCK)
            out.append((block, parts))
            block, filled = block + parts, 0
            continue
        if filled + n > BLOCK:
            block, filled = block + 1, 0
        out.append((block, 1))
        filled += n
    return out


def search(rows: DataFrame, is_query, k: int = 10, vec_id: str = "vec_id", embedding: str = "embedding", seed: int = 7) -> DataFrame:
    """(query_id, rank, vec_id, score) of the k nearest rows found of every query.

    ``is_query`` makes a boolean column from the id column; a query's own id is no candidate.
    """
    ready(rows.sparkSession)
    out_schema = "query_id long, vec_id long, score double"
    vectors = usable(rows, vec_id, embedding)
    sample = sorted(bounded_sample(vectors, ["vec_id"], SAMPLE, seed).collect())
    if not sample:
        return rows.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    lengths = [len(r["v"]) for r in sample]
    dim = max(sorted(set(lengths)), key=lengths.count)
    x = np.random.default_rng(seed).permutation(np.array([r["v"] for r in sample if len(r["v"]) == dim]))
    tree = Tree(x, seed)
    visits = tree.calibrated(x, k)

    def placed(batches):
        for pdf in batches:
            if len(pdf):
                yield pdf.assign(leaf=tree.leaf_of(np.stack(pdf["v"].to_numpy())))
    indexed = stored(vectors.where(F.size("v") == dim).mapInPandas(placed, "vec_id long, v array<double>, leaf int"), "tree-index")
    counts = {r["leaf"]: r["n"] for r in indexed.groupBy("leaf").agg(F.count(F.lit(1)).alias("n")).collect()}  # a row a leaf
    place = blocks_of(counts, tree.n_leaves)
    first, parts = (F.array(*[F.lit(p[i]) for p in place]) for i in (0, 1))
    at = F.col("leaf") + 1
    spread = indexed.select("vec_id", "v", "leaf", (F.element_at(first, at) + F.pmod(F.xxhash64("vec_id"), F.element_at(parts, at))).cast("int").alias("block"))

    def walked(batches):
        for pdf in batches:
            ids, vs, blocks, leaves = [], [], [], []
            for i, v in zip(pdf["query_id"], pdf["v"], strict=True):
                by: dict[int, list[int]] = {}
                for leaf in tree.leaves_for(np.asarray(v), visits):
                    for b in range(place[leaf][0], sum(place[leaf])):
                        by.setdefault(b, []).append(leaf)
                ids += [i] * len(by)
                vs += [v] * len(by)
                blocks += by.keys()
                leaves += by.values()
            if ids:
                yield pd.DataFrame({"query_id": ids, "q": vs, "block": blocks, "leaves": leaves})
    queries = indexed.where(is_query(F.col("vec_id"))).groupBy(F.col("vec_id").alias("query_id")).agg(F.min("v").alias("v"))
    walks = queries.mapInPandas(walked, "query_id long, q array<double>, block int, leaves array<int>")

    def best(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(left) and len(right):
            # by id, so that a stable sort leaves ties to the smaller one
            left = left.sort_values("vec_id", kind="stable")
            v, ids, leaf = np.stack(left["v"].to_numpy()), left["vec_id"].to_numpy(), left["leaf"].to_numpy()
            for qid, q, leaves in zip(right["query_id"], right["q"], right["leaves"], strict=True):
                on = np.flatnonzero(np.isin(leaf, leaves) & (ids != qid))
                d = np.sqrt(((v[on] - np.asarray(q)) ** 2).sum(axis=1))
                seen: dict[int, float] = {}
                for j in np.argsort(d, kind="stable"):
                    seen.setdefault(int(ids[on[j]]), float(d[j]))
                    if len(seen) == k:
                        break
                found += [(qid, i, s) for i, s in seen.items()]
        return pd.DataFrame(found, columns=["query_id", "vec_id", "score"])
    near = spread.groupBy("block").cogroup(walks.groupBy("block")).applyInPandas(best, out_schema)
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return (near.groupBy("query_id", "vec_id").agg(F.min("score").alias("score")).withColumn("rank", F.row_number().over(order))
            .where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score"))
