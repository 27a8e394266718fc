"""Control table of per-dimension watermarks (M1-M3)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nightledger.functions.scalar import ts_lit
from nightledger.schemas import DB, DIMENSIONS, HIST_TABLES, META_LOADING, SEED_W


def meta_seed(spark: SparkSession) -> DataFrame:
    """One row per history table, all at the seed watermark."""
    return spark.createDataFrame([(DB, t, SEED_W) for t in HIST_TABLES], META_LOADING)


def watermark_get(meta: DataFrame, tablename: str) -> DataFrame:
    """The watermark row of one table (a 1-row DataFrame)."""
    return meta.where(F.col("tablename") == tablename).select("last_update")


def watermark_value(meta: DataFrame, tablename: str) -> _dt.datetime:
    """The watermark as a driver value; the control table has one row per table."""
    rows = watermark_get(meta, tablename).take(2)
    if len(rows) != 1:
        raise ValueError(f"expected one watermark for {tablename}, got {len(rows)}")
    return rows[0][0]


def watermark_set(meta: DataFrame, tablename: str, value: _dt.datetime) -> DataFrame:
    """Set one table's watermark (terminals: the file's business date)."""
    hit = (F.col("dbname") == DB) & (F.col("tablename") == tablename)
    return meta.withColumn("last_update",
                           F.when(hit, ts_lit(value)).otherwise(F.col("last_update")))


def watermark_advance(meta: DataFrame, stg: DataFrame, dim: str) -> DataFrame:
    """W := max(COALESCE(update_dt, create_dt)) of the staged rows; unchanged if none."""
    name = DIMENSIONS[dim]["meta"]
    top = (stg.agg(F.max(F.coalesce("update_dt", "create_dt")).alias("_new"))
              .withColumn("dbname", F.lit(DB)).withColumn("tablename", F.lit(name)))
    return (meta.join(top, ["dbname", "tablename"], "left")
                .select("dbname", "tablename",
                        F.coalesce("_new", "last_update").alias("last_update")))
