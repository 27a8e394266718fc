"""Slowly-changing history (type 2) without MERGE: joins + unions.

Parquet has no UPDATE/MERGE, so every step is expressed as a dataflow over
the previous history: closed rows pass through untouched, open rows are
joined once with the staged change times (or the snapshot keys) on the
business key, and new rows are appended with ``unionByName``.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from nightledger.functions.scalar import closing_time, ts_lit
from nightledger.schemas import DELETED, DIMENSIONS, LIVE, MAXD, attributes

_STAGED = {
    # history column -> staging expression
    "terminals": {},
    "accounts": {},
    "cards": {"account_num": "account"},
    "clients": {},
}


def _ts(v: _dt.datetime | Column) -> Column:
    return v if isinstance(v, Column) else ts_lit(v)


def is_open() -> Column:
    """The open marker; a version without an end time is not open, and is kept."""
    return F.coalesce(F.col("effective_to") == ts_lit(MAXD), F.lit(False))


def empty_history(spark: SparkSession, dim: str) -> DataFrame:
    return spark.createDataFrame([], DIMENSIONS[dim]["schema"])


def dim_open(hist: DataFrame) -> DataFrame:
    """Current rows: ``effective_to`` is the open marker."""
    return hist.where(is_open())


def scd2_open(stg: DataFrame, dim: str, eff_from: _dt.datetime | Column | None = None) -> DataFrame:
    """New open versions ``(attrs, eff_from, MAXD, 'N')`` for every staged row.

    ``eff_from`` defaults to ``COALESCE(update_dt, create_dt)``; terminals use
    the file's business date.
    """
    rename = _STAGED[dim]
    attrs = [F.col(rename.get(c, c)).alias(c) for c in attributes(DIMENSIONS[dim]["schema"])]
    start = _ts(eff_from) if eff_from is not None else F.coalesce("update_dt", "create_dt")
    return stg.select(*attrs, start.alias("effective_from"),
                      ts_lit(MAXD).alias("effective_to"), F.lit(LIVE).alias("deleted_flg"))


def scd2_close(hist: DataFrame, new_rows: DataFrame, dim: str) -> DataFrame:
    """Close open rows of re-staged keys: ``effective_to = new_from - 1s``.

    Only open rows with ``effective_from < new_from`` close, so a late or
    equal change time leaves two open rows, as in the source system. Keys must
    be staged once (``staged_once``).
    """
    key = DIMENSIONS[dim]["key"]
    cols = hist.columns
    times = new_rows.groupBy(key).agg(F.max("effective_from").alias("_t"))
    open_rows = hist.where(is_open()).join(times, key, "left")
    close = F.col("_t").isNotNull() & (F.col("effective_from") < F.col("_t"))
    reopened = open_rows.withColumn(
        "effective_to", F.when(close, closing_time(F.col("_t"))).otherwise(F.col("effective_to")))
    return hist.where(~is_open()).unionByName(reopened.select(*cols))


def staged_once(stg: DataFrame, dim: str) -> DataFrame:
    """``stg`` itself; raises if a key occurs twice, which the source's MERGE rejects too.

    One job over the staged keys, before anything is written, so that the
    check depends neither on the history nor on the plan.
    """
    key = DIMENSIONS[dim]["key"]
    twice = stg.groupBy(key).count().where("count > 1").select(key).take(3)
    if twice:
        raise ValueError(f"{dim}: key staged twice: {', '.join(str(r[0]) for r in twice)}")
    return stg


def scd2_apply(hist: DataFrame, stg: DataFrame, dim: str,
               eff_from: _dt.datetime | Column | None = None) -> DataFrame:
    """Insert new versions, then close the superseded ones (insert-then-merge)."""
    new_rows = scd2_open(stg, dim, eff_from)
    return scd2_close(hist, new_rows, dim).unionByName(new_rows)


def _with_presence(open_rows: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    present = keys.select(F.col("id").alias(key)).distinct().withColumn("_present", F.lit(True))
    return open_rows.join(present, key, "left")


def _emit(rows: DataFrame, cols: list[str], tomb: Column, ts: Column, new_to: Column) -> DataFrame:
    """One pass: each row keeps its (possibly closed) self, plus a 'Y' copy where ``tomb``."""
    v = F.explode(F.when(tomb, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    out = rows.withColumn("_v", v)
    is_copy = F.col("_v") == 1
    attrs = [c for c in cols if c not in ("effective_from", "effective_to", "deleted_flg")]
    return out.select(
        *attrs,
        F.when(is_copy, ts).otherwise(F.col("effective_from")).alias("effective_from"),
        F.when(is_copy, ts_lit(MAXD)).otherwise(new_to).alias("effective_to"),
        F.when(is_copy, F.lit(DELETED)).otherwise(F.col("deleted_flg")).alias("deleted_flg"),
    )


def tombstone(hist: DataFrame, keys: DataFrame, dim: str, ts: _dt.datetime | Column) -> DataFrame:
    """Intended delete detection (U4).

    Open live rows whose key is absent from today's snapshot are closed at
    ``ts - 1s`` and get one open ``'Y'`` row from ``ts``. Closed rows and
    existing tombstones pass through, so nothing is re-issued.
    """
    key = DIMENSIONS[dim]["key"]
    ts = _ts(ts)
    cols = hist.columns
    j = _with_presence(hist.where(is_open()), keys, key)
    gone = (F.col("_present").isNull() & (F.col("deleted_flg") == LIVE)
            & (F.col("effective_from") < ts))
    new_to = F.when(gone, closing_time(ts)).otherwise(F.col("effective_to"))
    return hist.where(~is_open()).unionByName(_emit(j, cols, gone, ts, new_to))


def tombstone_literal(hist: DataFrame, keys: DataFrame, dim: str,
                      ts: _dt.datetime | Column) -> DataFrame:
    """The source system's delete step, reproduced exactly (U3, quirks Q4/Q5).

    Accounts, cards, clients: every row without an *open live* match in the
    snapshot (so every closed or 'Y' row as well) gets an open 'Y' copy, then
    every open row older than ``ts`` of such a key is closed.
    Terminals: only open rows count, but 'Y' rows never match, so their
    tombstones are issued again on each run.
    """
    key = DIMENSIONS[dim]["key"]
    ts = _ts(ts)
    cols = hist.columns
    j = _with_presence(hist, keys, key)
    present = F.coalesce(F.col("_present"), F.lit(False))
    if dim == "terminals":
        matched = present & F.coalesce(F.col("deleted_flg") == LIVE, F.lit(False))
        copy = ~matched & is_open()
    else:
        matched = present & F.coalesce(is_open() & (F.col("deleted_flg") == LIVE), F.lit(False))
        copy = ~matched
    # the follow-up UPDATE selects keys, so it reaches every open row of a hit key;
    # the window reuses the join's partitioning on the key (no extra exchange)
    key_hit = F.max(copy.cast("int")).over(Window.partitionBy(key)) == 1
    close = key_hit & is_open() & (F.col("effective_from") < ts)
    new_to = F.when(close, closing_time(ts)).otherwise(F.col("effective_to"))
    return _emit(j, cols, copy, ts, new_to)
