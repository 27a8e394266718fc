"""Shuffle files of stored results go at once; Arrow batches of whole texts are bounded in bytes."""

import re
import time

import pyarrow as pa
from pyspark.sql import functions as F

from nightledger.llm import language_crf
from nightledger.llm.common import BATCH_BYTES, RELEASE, checkpointed, small_batches, stored
from nightledger.llm.components import components


def shuffles(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return set(re.findall(r"shuffle_\d+", files.mkString(" ")))


def left_behind(spark, action):
    before = shuffles(spark)
    out = action()
    for _ in range(100):  # Spark removes them in the background
        if not (left := shuffles(spark) - before):
            break
        time.sleep(0.1)
    return out, left


def test_stored_and_checkpointed_rows_leave_no_shuffle_files(spark, tmp_path):
    grouped = lambda: spark.range(0, 10_000, 1, 4).groupBy((F.col("id") % 100).alias("k")).count()
    for kept in (lambda: stored(grouped(), "test"), lambda: checkpointed(grouped())):
        rows, left = left_behind(spark, kept)
        assert left == set()
        assert sorted(tuple(r) for r in rows.collect()) == [(k, 100) for k in range(100)]
    links = spark.createDataFrame([(i + 1, i) for i in range(40)] + [(100, 200)], "u long, v long")
    part, left = left_behind(spark, lambda: stored(components(links), "test"))
    assert left == set()
    assert {r["node"]: r["component"] for r in part.collect()} == {**dict.fromkeys(range(41), 0), 100: 100, 200: 100}
    assert spark.conf.get(RELEASE, None) is None  # other actions of the session keep its own setting


def test_batches_of_whole_texts_are_bounded_in_bytes(spark):
    def each(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.nbytes])], ["bytes"])
    texts = spark.range(0, 3_000, 1, 1).select(F.col("id").alias("doc_id"), F.repeat(F.lit("some words "), 500).alias("text"))
    was = spark.conf.get(BATCH_BYTES, None)
    try:
        spark.conf.unset(BATCH_BYTES)
        model = language_crf.train([("some words", "en"), ("unas palabras", "es")])
        assert language_crf.known(texts.limit(3), model, 0.0).count() == 3
        assert max(r["bytes"] for r in texts.mapInArrow(each, "bytes long").collect()) < 5_000_000
        spark.conf.set(BATCH_BYTES, "1m")
        small_batches(spark)
        assert spark.conf.get(BATCH_BYTES) == "1m"  # a session's own bound stays
    finally:
        if was is None:
            spark.conf.unset(BATCH_BYTES)
        else:
            spark.conf.set(BATCH_BYTES, was)
