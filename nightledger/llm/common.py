"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from contextlib import contextmanager

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nightledger.session import scratch, ship_package

#: Text of the word and space classes: ``[^\x20\x09-\x0D]+`` is a word.
SPACES = "\t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Whether an action's shuffle files go when it ends; else they stay until the driver happens to collect its garbage.
RELEASE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Bytes of an Arrow batch, and what is set where the session says nothing.
BATCH_BYTES, SMALL_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch", "4m"


@contextmanager
def released(spark: SparkSession):
    """Actions in here leave no shuffle files: for results that are written and read from there."""
    was = spark.conf.get(RELEASE, None)
    spark.conf.set(RELEASE, "true")
    try:
        yield
    finally:
        if was is None:
            spark.conf.unset(RELEASE)
        else:
            spark.conf.set(RELEASE, was)


def stored(df: DataFrame, tag: str) -> DataFrame:
    """``df`` written as Parquet in the shared folder and read back: lineage ends there."""
    path = scratch(df.sparkSession, tag) + "/t"
    with released(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` in Spark's checkpoint folder: lineage ends there."""
    with released(df.sparkSession):
        return df.select("*").checkpoint()   # what happens to shuffle files is settled when a frame is made


def small_batches(spark: SparkSession) -> None:
    """Arrow batches of whole texts are bounded in bytes, not only in rows, unless the session has a bound of its own."""
    if spark.conf.get(BATCH_BYTES, None) is None:
        spark.conf.set(BATCH_BYTES, SMALL_BATCH)


_HELD: dict = {}


def held(key: str, make):
    """What a worker process keeps between tasks: ``make()``, until another key is asked for.

    Workers live through all stages of a pipeline, so the tables of one model go before those of the next are made.
    """
    if key not in _HELD:
        let_go()
        _HELD[key] = make()
    return _HELD[key]


def let_go() -> None:
    """For tasks that need no model: what an earlier stage has left in the worker process goes."""
    _HELD.clear()


def ready(spark: SparkSession) -> None:
    """Python workers can import this package."""
    ship_package(spark)


def held_out(doc_id: str, mod: int, fold: int):
    """True where crc32 of the id as text leaves ``fold``; a null id is never held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % mod == fold, F.lit(False))


def below(share: float, seed: int, *key):
    """True for that share of all rows, by a seeded hash of ``key``: a 64-bit threshold, so that it is exact on any table."""
    if share >= 1:
        return F.lit(True)
    return F.xxhash64(F.lit(seed), *key) < F.lit(int(share * 2 ** 64) - 2 ** 63)


def bounded_sample(rows: DataFrame, key: list[str], most: int, seed: int) -> DataFrame:
    """About ``most`` rows of all, never above twice that: those with the least seeded hashes of ``key``.

    The threshold follows from the count, so each partition hands over its
    share of the sample and not ``most`` rows of its own.
    """
    n = rows.count()
    return rows.where(below(most / max(n, 1), seed, *key)).orderBy(F.xxhash64(F.lit(seed), *key)).limit(2 * most)


_M1, _M2, _M3 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xFF51AFD7ED558CCD))


def mixed(h: np.ndarray) -> np.ndarray:
    """A fixed bijection that spreads the bits of 64-bit hashes."""
    h = (h ^ (h >> np.uint64(33))) * _M3
    return h ^ (h >> np.uint64(29))


def window_hashes(h: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all k-word windows of a sequence of word hashes; fewer words: one of the whole."""
    k = min(k, len(h))
    if not k:
        return h
    n = len(h) - k + 1
    out = np.full(n, np.uint64(k))
    for j in range(k):
        out = mixed(out * _M1 + h[j:j + n] * _M2)
    return out


_BLANK = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
_PLACES = 64


class WordHashes:
    """64-bit hashes of the words ``[^\\x20\\x09-\\x0D]+`` with A-Z lowered, made for many at once.

    A hash is the sum of a fixed random value for each byte and its place. No word is remembered, so that memory does not grow with the vocabulary.
    """

    def __init__(self):
        values = np.random.Generator(np.random.PCG64(6464)).integers(0, 2**64, (_PLACES, 256), dtype=np.uint64)
        values[:, 65:91] = values[:, 97:123]   # A-Z count as a-z
        self.values = values.ravel()

    def words(self, blob: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(hash, start, end in bytes) of the words of ``blob``."""
        byte = np.frombuffer(blob, np.uint8)
        inside = np.zeros(len(byte) + 2, bool)
        np.logical_not(_BLANK[byte], out=inside[1:-1])
        turn = np.flatnonzero(inside[1:] != inside[:-1])
        start, end = turn[::2], turn[1::2]
        if not len(start):
            return np.zeros(0, np.uint64), start, end
        size = end - start
        place = np.arange(len(byte), dtype=np.int32)
        last = np.zeros(len(byte), np.int32)          # start of the word that a byte is in
        last[start] = start
        place -= np.maximum.accumulate(last)
        each = self.values[((place & (_PLACES - 1)) << 8) | byte]
        if size.max() > _PLACES:
            far = np.flatnonzero(place >= _PLACES)
            each[far] = mixed(each[far] + (place[far] // _PLACES).astype(np.uint64) * _M1)
        each[~inside[1:-1]] = 0
        return np.add.reduceat(each, start), start, end

    def of_texts(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Word hashes of all texts side by side, and where each text's begin (one more than texts)."""
        raw = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
        hashes, start, _ = self.words(b"\n".join(raw))
        return hashes, np.searchsorted(start, np.cumsum([0, *(len(r) + 1 for r in raw)]))


def shingle_sets(texts: list[str | None], k: int, hashes: WordHashes) -> list[np.ndarray]:
    """Sorted distinct hashes of each text's k-word shingles; fewer words: one of the whole."""
    h, at = hashes.of_texts(texts)
    full = window_hashes(h, k) if len(h) >= k else h[:0]
    return [np.unique(full[a:b - k + 1]) if b - a >= k else window_hashes(h[a:b], k) for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
