"""Vector codes by codebooks of parts, trained and assigned over a lexicographic trie of the distinct parts.

Components become integers; a vector is cut into PARTS consecutive parts and
each part position has a codebook. Equal parts are counted once: the distinct
parts of a position, range-partitioned and sorted, are the leaves of a trie
whose edges are components. Walking the leaves in that order, the squared
distances to all entries that were summed along a common prefix are kept and
only the components behind it are added. A leaf takes the nearest entry (least
distance, then least index) and adds itself, times its count, to that entry's
sums; sums of all tasks give the next codebook. Leaves are visited a block at a
time: within a block the nodes of one depth are computed together, and the path
of its last leaf is carried into the next block.

All arithmetic is on integers: in doubles while every sum stays below 2**53,
else on Python's integers.

Bounded: codebooks are entries x length numbers and travel with the task. The
final codes need no shuffle: the distinct parts of a batch of vectors are a trie
of their own.

Defined results: vectors that are null, hold a null or non-finite component, or
have no component are left out; a component beyond 32 bits once scaled, vectors
of different lengths or a length that the parts do not divide raise. A null id
is coded but starts no codebook; rows that repeat an id are vectors of their
own. With fewer vectors than entries, codebooks are that small. No rows give no
codes. Other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nightledger.llm.common import ready, stored

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
BLOCK = 512            # leaves of a trie at a time
EXACT = 2.0 ** 53      # integers up to here are exact in doubles


def kept(vectors: DataFrame, column: str = "embedding") -> DataFrame:
    """Rows whose vector has components, none of them null, NaN or infinite."""
    c = F.col(column)
    bad = F.exists(c, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vectors.where(c.isNotNull() & (F.size(c) > 0) & ~bad)


def scaled(values: np.ndarray) -> np.ndarray:
    """floor(SCALE * x) as 32-bit integers; scaling by a power of two is exact."""
    v = np.floor(values.astype(np.float64) * SCALE)
    if len(v) and not (-2.0 ** 31 <= v.min() and v.max() < 2.0 ** 31):
        raise ValueError("a component is beyond 32 bits once scaled")
    return v.astype(np.int32)


def matrix(column: pa.ListArray, width: int) -> np.ndarray:
    """The vectors of a column without nulls, a row each."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    if len(flat) != width * len(column) or (np.diff(column.offsets.to_numpy()) != width).any():
        raise ValueError(f"vectors of other lengths than {width}")
    return scaled(flat).reshape(len(column), width)


def as_key(parts: np.ndarray) -> np.ndarray:
    """Rows as bytes whose order is that of the components: big-endian, sign flipped."""
    return np.ascontiguousarray((parts.astype(np.int64) + 2 ** 31).astype(">u4"))


def of_keys(keys: list[bytes], width: int) -> np.ndarray:
    return (np.frombuffer(b"".join(keys), ">u4").reshape(len(keys), width).astype(np.int64) - 2 ** 31)


class Trie:
    """Nearest entries of parts that come in lexicographic order."""

    def __init__(self, book: np.ndarray):
        self.book, self.last, self.path = book, None, None   # the last leaf, and the distances along its path

    def leaves(self, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index of the nearest entry, distance) of each of ``parts``: int64, sorted, distinct."""
        at, distance = np.zeros(len(parts), np.int64), []
        for i in range(0, len(parts), BLOCK):
            index, d = self._block(parts[i:i + BLOCK])
            at[i:i + BLOCK] = index
            distance.append(d)
        return at, np.concatenate(distance) if distance else np.zeros(0, np.int64)

    def _block(self, x: np.ndarray):
        n, width = x.shape
        book, most = self.book, max(int(np.abs(x).max()), int(np.abs(self.book).max()))
        kind = np.float64 if width * (2 * most) ** 2 < EXACT else object
        before = np.vstack([x[:1] if self.last is None else self.last[None], x[:-1]])
        shared = np.cumprod(x == before, axis=1).sum(axis=1)   # length of the common prefix with the leaf before
        if self.last is None:
            shared[0] = 0
        path, node, d = [], np.zeros(n, np.int64), None
        for depth in range(width):
            new = np.flatnonzero(shared <= depth)     # leaves that begin a node of this depth
            carried = not len(new) or new[0] != 0     # the first leaves go on in the last block's node
            step = (x[new, depth].astype(kind)[:, None] - book[:, depth].astype(kind)[None]) ** 2
            if depth:
                step = step + d[node[new]]
            d = np.concatenate([self.path[depth][None].astype(kind), step]) if carried else step
            node = np.cumsum(shared <= depth) - (0 if carried else 1)
            path.append(d[-1])
        self.last, self.path = x[-1].copy(), path
        index = np.array([int(np.argmin(r)) for r in d]) if kind is object else d.argmin(axis=1)
        distance = d[np.arange(len(d)), index]
        return index[node], distance[node].astype(np.int64) if kind is not object else distance[node]


def distinct_parts(vectors: DataFrame, column: str, width: int, parts: int) -> DataFrame:
    """(position, part, n): every distinct part with its count, in ranges sorted by (position, part)."""
    each_width = width // parts

    def each(batches):
        for batch in batches:
            v = matrix(batch.column(0), width)
            for p in range(parts if len(v) else 0):
                keys = as_key(v[:, p * each_width:(p + 1) * each_width])
                # equal parts of a batch are one row, so a common vector is few rows
                one, n = np.unique(keys.view(f"V{4 * each_width}").ravel(), return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(one), p, np.int32)), pa.array([k.tobytes() for k in one], pa.binary()), pa.array(n, pa.int64())],
                    ["position", "part", "n"])
    counted = vectors.select(column).mapInArrow(each, "position int, part binary, n long").groupBy("position", "part").agg(F.sum("n").alias("n"))
    return stored(counted.repartitionByRange("position", "part").sortWithinPartitions("position", "part"), "parts")


def _grouped(batches, books):
    """The rows of consecutive batches (position, part, n), cut where the position changes."""
    trie, at = None, None
    for batch in batches:
        position = batch.column(0).to_numpy()
        for p in np.unique(position):
            rows = batch.filter(pa.array(position == p))
            if p != at:
                trie, at = Trie(books[p]), p
            yield int(p), trie, rows


def _round(parts: DataFrame, books: list[np.ndarray]) -> list[np.ndarray]:
    """The codebooks after one assignment of all distinct parts."""
    width = books[0].shape[1]

    def each(batches):
        sums = {}
        for p, trie, rows in _grouped(batches, books):
            x, n = of_keys(rows.column(1).to_pylist(), width), rows.column(2).to_numpy()
            index, _ = trie.leaves(x)
            if p not in sums:
                sums[p] = np.zeros((len(books[p]), width + 1), object)
            for e in np.unique(index):
                of = index == e
                # exact whatever the counts: products are summed in Python's integers where 64 bits might not do
                small = int(n[of].max()) * int(np.abs(x[of]).max() + 1) * int(of.sum()) < 2 ** 62
                w = n[of] if small else n[of].astype(object)
                sums[p][e, :width] += (x[of] * w[:, None]).sum(axis=0).astype(object)
                sums[p][e, width] += int(n[of].sum())
        out = [(p, e, *map(str, row)) for p, m in sums.items() for e, row in enumerate(m) if row[-1]]
        if out:
            cols = list(zip(*out, strict=True))
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int32()), pa.array(cols[1], pa.int32()),
                                              *(pa.array(c, pa.string()) for c in cols[2:])], names)
    names = ["position", "entry", *(f"s{d}" for d in range(width)), "n"]
    kinds = "position int, entry int, " + ", ".join(f"{c} string" for c in names[2:])
    total = (parts.mapInArrow(each, kinds).groupBy("position", "entry")
             .agg(*[F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in names[2:]]))
    new = [b.copy() for b in books]
    for r in total.collect():   # one row an entry
        new[r.position][r.entry] = [int(r[c]) // int(r.n) for c in names[2:-1]]
    return new


def first_books(vectors: DataFrame, ident: str, column: str, parts: int, entries: int) -> list[np.ndarray]:
    """Codebooks of the vectors with the least ids, ascending; rows of equal id by their components."""
    rows = vectors.where(F.col(ident).isNotNull()).orderBy(ident, column).select(column).limit(entries).collect()
    if not rows:
        return []
    width = len(rows[0][0])
    if width % parts or any(len(r[0]) != width for r in rows):
        raise ValueError(f"vectors of length {width} do not fall into {parts} equal parts, or lengths differ")
    v = scaled(np.array([r[0] for r in rows], np.float64).ravel()).reshape(len(rows), width).astype(np.int64)
    return np.split(v, parts, axis=1)


def train(vectors: DataFrame, ident: str = "vec_id", column: str = "embedding", parts: int = PARTS, entries: int = ENTRIES,
          rounds: int = ROUNDS) -> list[np.ndarray]:
    """The codebook of each part position after ``rounds`` rounds over all parts; [] without vectors."""
    ready(vectors.sparkSession)
    good = kept(vectors, column)
    books = first_books(good, ident, column, parts, entries)
    if books:
        leaves = distinct_parts(good, column, parts * books[0].shape[1], parts)
        for _ in range(rounds):
            books = _round(leaves, books)
    return books


def encode(vectors: DataFrame, books: list[np.ndarray], ident: str = "vec_id", column: str = "embedding") -> DataFrame:
    """The kept rows with ``code`` (an entry index per part), ``error`` (squared distances, summed) beside all their columns but the vector."""
    ready(vectors.sparkSession)
    good = kept(vectors, column)
    rest = [f for f in vectors.schema.fields if f.name != column]

    def each(batches):
        if not books:
            return
        width = len(books) * books[0].shape[1]
        for batch in batches:
            if not batch.num_rows:
                continue
            v = matrix(batch.column(batch.num_columns - 1), width)
            codes, error = [], 0
            for x, book in zip(np.split(v, len(books), axis=1), books, strict=True):
                keys = as_key(x).view(f"V{4 * x.shape[1]}").ravel()
                one, back = np.unique(keys, return_inverse=True)
                index, d = Trie(book).leaves(of_keys([k.tobytes() for k in one], x.shape[1]))
                codes.append(index[back])
                error = error + d[back]
            code = pa.ListArray.from_arrays(np.arange(len(v) + 1, dtype=np.int32) * len(books), pa.array(np.stack(codes, 1).ravel(), pa.int32()))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], code, pa.array(error.tolist(), pa.int64())], [*batch.schema.names[:-1], "code", "error"])

    names = [f"`{f.name}` {f.dataType.simpleString()}" for f in rest]
    own = [F.col(f"`{f.name}`") for f in rest]
    return good.select(*own, column).mapInArrow(each, ", ".join([*names, "code array<int>", "error long"]))


def decode(codes: DataFrame, books: list[np.ndarray], column: str = "code") -> DataFrame:
    """``codes`` with ``decoded``: the entries' components over SCALE, parts in order."""
    entries = [F.array(*[F.array(*[F.lit(float(x) / SCALE) for x in e]) for e in b]) for b in books]
    return codes.withColumn("decoded", F.flatten(F.array(*[F.element_at(b, F.col(column)[i] + 1) for i, b in enumerate(entries)])))


def said(books: list[np.ndarray]) -> str:
    """sha256 of all components, by part, entry and place."""
    return hashlib.sha256(",".join(str(int(x)) for b in books for x in b.ravel()).encode()).hexdigest()


def digests(coded: DataFrame, books: list[np.ndarray]) -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256): codes as hexadecimal, errors summed over equal labels."""
    rows = stored(coded.select("vec_id", "label", "code", "error"), "codes")
    of_label = rows.groupBy(F.col("label").alias("_label")).agg(F.sum("error").alias("label_error"))
    code = F.concat(*[F.lpad(F.lower(F.hex(F.col("code")[i])), 2, "0") for i in range(len(books) or PARTS)])
    return (rows.join(of_label, rows.label.eqNullSafe(of_label._label))
            .select("vec_id", code.alias("code"), "error", "label_error", F.lit(said(books)).alias("codebooks_sha256")))
