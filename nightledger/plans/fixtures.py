"""Bank tables derived from the driver's test tables (FIXTURES.md §B).

Each function reads the given parquet tables and derives one bank table by
fixed column expressions, so the work grows with the input. The DuckDB
twin of every expression lives in :mod:`nightledger.plans.oracle`.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from nightledger.functions.scalar import ts_lit

# Fixed fixture constants (FIXTURES.md §B).
T0 = _dt.datetime(2023, 12, 1)          # create_dt of every source row
U = _dt.datetime(2024, 1, 10)           # update_dt of changed rows in version 1
D0 = _dt.datetime(2024, 1, 1)           # first terminals file date
D1 = _dt.datetime(2024, 1, 15)          # second terminals file date
RUN_TS = _dt.datetime(2024, 1, 31, 0, 17, 0)
R3_W = _dt.datetime(2024, 1, 2)         # rule-3 watermark used by the oracle check
BLACKLIST_DATES = (_dt.datetime(2024, 1, 5), _dt.datetime(2024, 1, 6))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _pad(c: Column, n: int) -> Column:
    return F.lpad(c.cast("string"), n, "0")


def _plus_days(ts: _dt.datetime, days: Column) -> Column:
    return ts_lit(ts) + F.make_dt_interval(days.cast("int"))


def _null_ts() -> Column:
    return F.lit(None).cast("timestamp_ntz")


def src_clients(spark: SparkSession, sf_dir: str, version: int) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    if version == 1:
        c = c.where(k % 11 != 0)
    changed = (k % 7 == 0) if version == 1 else F.lit(False)
    return c.select(
        F.concat(F.lit("C"), _pad(k, 8)).alias("client_id"),
        F.col("c_name").alias("last_name"),
        F.col("c_mktsegment").alias("first_name"),
        F.when(k % 19 == 0, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("P"), (k % 10).cast("string"))).alias("patronymic"),
        _plus_days(_dt.datetime(1970, 1, 1), k % 9000).alias("date_of_birth"),
        F.concat(F.when(changed, F.lit("N")).otherwise(F.lit("P")), _pad(k, 9)).alias("passport_num"),
        F.when(k % 31 == 0, _null_ts())
         .otherwise(_plus_days(_dt.datetime(2024, 1, 1), k % 90 - 30)).alias("passport_valid_to"),
        F.concat(F.lit("+7"), _pad(k, 10)).alias("phone"),
        ts_lit(T0).alias("create_dt"),
        F.when(changed, ts_lit(U)).otherwise(_null_ts()).alias("update_dt"),
    )


def src_accounts(spark: SparkSession, sf_dir: str, version: int) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    if version == 1:
        c = c.where(k % 13 != 0)
    changed = (k % 5 == 0) if version == 1 else F.lit(False)
    valid_to = _plus_days(_dt.datetime(2024, 1, 1), k % 60)
    return c.select(
        F.concat(F.lit("A"), _pad(k, 8)).alias("account"),
        F.when(changed, valid_to + F.make_dt_interval(F.lit(365))).otherwise(valid_to).alias("valid_to"),
        F.concat(F.lit("C"), _pad(k, 8)).alias("client"),
        ts_lit(T0).alias("create_dt"),
        F.when(changed, ts_lit(U)).otherwise(_null_ts()).alias("update_dt"),
    )


def src_cards(spark: SparkSession, sf_dir: str, version: int) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    if version == 1:
        c = c.where(k % 17 != 0)
    changed = (k % 6 == 0) if version == 1 else F.lit(False)
    return c.select(
        F.concat(F.lit("4000 0000 "), _pad(k, 8), F.lit(" ")).alias("card_num"),
        F.concat(F.lit("A"), _pad(k, 8)).alias("account"),
        ts_lit(T0).alias("create_dt"),
        F.when(changed, ts_lit(U)).otherwise(_null_ts()).alias("update_dt"),
    )


def src_terminals(spark: SparkSession, sf_dir: str, version: int) -> DataFrame:
    """Full terminal snapshot (the workbooks' rows): a terminal for each supplier, in its nation."""
    grid, tid, nation = table(spark, sf_dir, "supplier"), F.col("s_suppkey"), F.col("s_nationkey")
    if version == 1:
        grid = grid.where(tid % 23 != 0)
    city = F.when(tid % 9 == 0, (nation + 1) % 25).otherwise(nation) if version == 1 else nation
    addr = F.concat(F.lit("addr "), tid.cast("string"))
    if version == 1:
        addr = F.when(tid % 10 == 0, F.concat(addr, F.lit(" bis"))).otherwise(addr)
    return grid.select(
        F.concat(F.lit("T"), _pad(tid, 9)).alias("terminal_id"),
        F.when(tid % 2 == 0, F.lit("ATM")).otherwise(F.lit("POS")).alias("terminal_type"),
        F.concat(F.lit("NATION_"), city.cast("string")).alias("terminal_city"),
        addr.alias("terminal_address"),
    )


def _trans_date(ts: Column) -> Column:
    sod = F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)
    return F.timestamp_add("SECOND", F.floor(sod / 48).cast("int"), ts.cast("date").cast("timestamp_ntz"))


def _terminal(spark: SparkSession, sf_dir: str) -> Column:
    """The terminal of an operation: one of as many as there are suppliers."""
    n = max(1, table(spark, sf_dir, "supplier").count())
    return F.concat(F.lit("T"), _pad(F.col("event_id") % n, 9)).alias("terminal")


def fact_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.select(
        F.col("event_id").cast("string").alias("trans_id"),
        _trans_date(F.col("ts")).alias("trans_date"),
        F.concat(F.lit("40000000"), _pad(F.col("user_id"), 8)).alias("card_num"),
        F.col("event_type").alias("oper_type"),
        F.col("value").cast("decimal(30,2)").alias("amt"),
        F.when(F.col("event_type").isin("error", "signup", "click"), F.lit("REJECT"))
         .otherwise(F.lit("SUCCESS")).alias("oper_result"),
        _terminal(spark, sf_dir),
    )


def stg_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw text a transactions file carries for the same operations."""
    e = table(spark, sf_dir, "events")
    return e.select(
        F.col("event_id").cast("string").alias("trans_id"),
        F.date_format(_trans_date(F.col("ts")), "yyyy-MM-dd HH:mm:ss").alias("trans_date"),
        F.replace(F.col("value").cast("decimal(30,2)").cast("string"), F.lit("."), F.lit(",")).alias("amt"),
        F.concat(F.lit("4000 0000 "), _pad(F.col("user_id"), 8), F.lit(" ")).alias("card_num"),
        F.col("event_type").alias("oper_type"),
        F.when(F.col("event_type").isin("error", "signup", "click"), F.lit("REJECT"))
         .otherwise(F.lit("SUCCESS")).alias("oper_result"),
        _terminal(spark, sf_dir),
    )


def stg_blacklist(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blacklist workbook rows as text: one date-only and one full timestamp per passport."""
    c = table(spark, sf_dir, "customer").where(F.col("c_custkey") % 29 == 0)
    p = F.concat(F.lit("P"), _pad(F.col("c_custkey"), 9))
    first = c.select(F.lit("2024-01-05").alias("report_dt"), p.alias("passport_num"))
    second = c.select(F.lit("2024-01-06 00:00:00").alias("report_dt"), p.alias("passport_num"))
    return first.unionByName(second)


# materialized fixture states, per Spark context and input folder
_STORED: dict[tuple[str, str], dict[str, str]] = {}


@dataclass
class BankState:
    """Derived warehouse state after day 0 (h0) and day 1 (h1), plus day-1 inputs.

    The first use in a session writes h0, h1, the fact and the blacklist as
    Parquet under the shared folder (``spark.checkpoint.dir``); later queries
    read those tables, so their plans start from stored state as the daily
    job's do, and lineage stays short.
    """

    spark: SparkSession
    sf_dir: str
    _written: dict[str, str] = field(default_factory=dict)

    def _key(self) -> tuple[str, str]:
        return (self.spark.sparkContext.applicationId, self.sf_dir)

    def stored(self) -> dict[str, str]:
        if self._key() not in _STORED:
            self.materialize()
        return _STORED[self._key()]

    def _read(self, name: str) -> DataFrame | None:
        path = _STORED.get(self._key(), self._written).get(name)
        return self.spark.read.parquet(path) if path else None

    def materialize(self) -> dict[str, str]:
        from nightledger.session import scratch
        root = scratch(self.spark, "bank-state")
        paths: dict[str, str] = {}
        plan = [("fact", self.fact), ("blacklist", self.blacklist)]
        for day in (0, 1):
            for dim in ("terminals", "accounts", "cards", "clients"):
                plan.append((f"h{day}_{dim}", lambda d=dim, v=day: self.step(d, v)))
        for name, build in plan:
            build().write.mode("overwrite").parquet(f"{root}/{name}")
            paths[name] = f"{root}/{name}"
            self._written[name] = paths[name]
        _STORED[self._key()] = paths  # known to others only when all of it is there
        return paths

    def src(self, dim: str, version: int) -> DataFrame:
        return {"clients": src_clients, "accounts": src_accounts, "cards": src_cards,
                "terminals": src_terminals}[dim](self.spark, self.sf_dir, version)

    def fact(self) -> DataFrame:
        df = self._read("fact")
        return fact_transactions(self.spark, self.sf_dir) if df is None else df

    def blacklist(self) -> DataFrame:
        from nightledger.operators.cleaning import clean_blacklist
        df = self._read("blacklist")
        return clean_blacklist(stg_blacklist(self.spark, self.sf_dir)) if df is None else df

    def stg(self, dim: str, day: int) -> DataFrame:
        """Staged rows of ``day`` (CDC since the previous watermark, or terminal diff)."""
        from nightledger.operators.cdc import cdc_extract, snapshot_diff
        from nightledger.schemas import SEED_W
        if dim == "terminals":
            snap = self.src("terminals", day)
            return snap if day == 0 else snapshot_diff(snap, self.hist("terminals", 0))
        w = SEED_W if day == 0 else T0
        return cdc_extract(self.src(dim, day), dim, w)

    def step(self, dim: str, day: int) -> DataFrame:
        """The SCD2 step of ``day`` applied to the previous day's history."""
        from nightledger.operators.scd2 import empty_history, scd2_apply
        prev = empty_history(self.spark, dim) if day == 0 else self.hist(dim, day - 1)
        eff = (D0 if day == 0 else D1) if dim == "terminals" else None
        return scd2_apply(prev, self.stg(dim, day), dim, eff_from=eff)

    def hist(self, dim: str, day: int) -> DataFrame:
        """History after the SCD2 step of ``day`` (day 0 has no deletions to detect)."""
        df = self._read(f"h{day}_{dim}")
        return self.step(dim, day) if df is None else df

    def keys(self, dim: str, day: int) -> DataFrame:
        """Business keys present in the day's full snapshot (delete detection input)."""
        from nightledger.operators.cdc import snapshot_keys
        return snapshot_keys(self.src(dim, day), dim)


RUN_TS0 = _dt.datetime(2024, 1, 15, 0, 17, 0)   # day-0 run, after the first export


def export_files(spark: SparkSession, sf_dir: str, root: str) -> dict[str, str]:
    """Write the two daily exports derived from the test tables under ``root``.

    Export 0 (business date D0): transactions dated before D1, terminals
    version 0. Export 1 (D1): the rest, terminals version 1. Both carry the
    blacklist. Returns the paths by name.
    """
    from nightledger.sources.files import write_transaction_files, write_workbooks
    tx = stg_transactions(spark, sf_dir)
    day = F.to_timestamp_ntz(F.substring("trans_date", 1, 10))
    write_transaction_files(tx.where(day < ts_lit(D1)), f"{root}/tx/0")
    write_transaction_files(tx.where(day >= ts_lit(D1)), f"{root}/tx/1")
    for v, d in ((0, "01012024"), (1, "15012024")):
        write_workbooks(src_terminals(spark, sf_dir, v), f"{root}/ter{v}", f"terminals_{d}", "terminal_id")
        write_workbooks(stg_blacklist(spark, sf_dir), f"{root}/bl{v}", f"passport_blacklist_{d}", "passport_num")
    return {"tx": f"{root}/tx", "tx0": f"{root}/tx/0", "tx1": f"{root}/tx/1",
            "ter0": f"{root}/ter0/terminals_01012024*.xlsx",
            "ter1": f"{root}/ter1/terminals_15012024*.xlsx",
            "ter": f"{root}/ter*/terminals_*.xlsx",
            "bl0": f"{root}/bl0/passport_blacklist_01012024*.xlsx",
            "bl1": f"{root}/bl1/passport_blacklist_15012024*.xlsx"}


def day_inputs(spark: SparkSession, sf_dir: str, paths: dict[str, str], v: int):
    from nightledger.plans.pipeline import DayInputs
    return DayInputs(transactions=paths[f"tx{v}"], terminals=paths[f"ter{v}"],
                     blacklist=paths[f"bl{v}"], accounts=src_accounts(spark, sf_dir, v),
                     cards=src_cards(spark, sf_dir, v), clients=src_clients(spark, sf_dir, v))
