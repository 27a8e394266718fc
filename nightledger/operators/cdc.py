"""Change capture: high-water-mark extract (C3) and snapshot diff (C4)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nightledger.functions.scalar import strip_blanks, ts_lit
from nightledger.schemas import DIMENSIONS, MAXD

TERMINAL_ATTRS = ("terminal_id", "terminal_type", "terminal_city", "terminal_address")


def _w(w: _dt.datetime | Column) -> Column:
    return w if isinstance(w, Column) else ts_lit(w)


def changed_since(w: _dt.datetime | Column) -> Column:
    """``COALESCE(update_dt, create_dt) > W`` written so each arm can reach the scan."""
    w = _w(w)
    return (F.col("update_dt") > w) | (F.col("update_dt").isNull() & (F.col("create_dt") > w))


def cdc_extract(src: DataFrame, dim: str, w: _dt.datetime | Column) -> DataFrame:
    """Rows changed after the watermark, in staging layout."""
    return _layout(src.where(changed_since(w)), dim)


def staged(src: DataFrame, dim: str, w: _dt.datetime | Column) -> DataFrame:
    """One pass over a source: every key, and the attributes of the rows changed after the watermark.

    Unchanged rows carry only their key, so a staged table is little more
    than the keys and the changes, and both come from the same read.
    """
    rows = _layout(src, dim).withColumn("changed", F.coalesce(changed_since(w), F.lit(False)))
    key = DIMENSIONS[dim]["key"]
    return rows.select(*[F.col(c) if c in (key, "changed") else F.when(F.col("changed"), F.col(c)).alias(c) for c in rows.columns])


def _layout(src: DataFrame, dim: str) -> DataFrame:
    """A source table in staging layout."""
    if dim == "accounts":
        # fixed-width keys arrive padded with blanks
        return src.select(F.rtrim("account").alias("account_num"), "valid_to", F.rtrim("client").alias("client"),
                          "create_dt", "update_dt")
    if dim == "cards":
        return src.select(strip_blanks("card_num").alias("card_num"), F.rtrim("account").alias("account"),
                          "create_dt", "update_dt")
    if dim == "clients":
        return src.select(F.rtrim("client_id").alias("client_id"), "last_name", "first_name", "patronymic", "date_of_birth",
                          "passport_num", "passport_valid_to", "phone", "create_dt", "update_dt")
    raise ValueError(f"no change capture for {dim}")


def snapshot_diff(snap: DataFrame, hist: DataFrame, null_safe: bool = False,
                  against: str = "any") -> DataFrame:
    """Staged terminals minus those identical to a past version.

    Literal form: a row is dropped when all four attributes equal those of
    *any* version (open, closed or deleted), and a NULL attribute never
    matches. ``against="open"`` compares with open rows only and
    ``null_safe=True`` lets NULL match NULL.
    """
    if against == "open":
        hist = hist.where(F.col("effective_to") == ts_lit(MAXD))
    h = hist.select(*[F.col(c).alias(f"_h_{c}") for c in TERMINAL_ATTRS])
    cond = None
    for c in TERMINAL_ATTRS:
        eq = snap[c].eqNullSafe(h[f"_h_{c}"]) if null_safe else (snap[c] == h[f"_h_{c}"])
        cond = eq if cond is None else cond & eq
    return snap.join(h, cond, "left_anti")


def snapshot_keys(src: DataFrame, dim: str) -> DataFrame:
    """Business keys present in today's full source snapshot, as ``id``."""
    key = {"terminals": F.col("terminal_id"), "accounts": F.rtrim("account"),
           "cards": strip_blanks("card_num"), "clients": F.rtrim("client_id")}[dim]
    return src.select(key.alias("id"))
