"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per operator.

Rule and history queries run on the day-1 state ``h1`` (day 0 loaded, day-1
changes applied by SCD2), the state FIXTURES.md measures.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from nightledger.operators import cdc, cleaning, meta, rules, scd2, strict
from nightledger.operators.party import party_info
from nightledger.plans import fixtures as fx
from nightledger.plans.fixtures import D0, D1, R3_W, RUN_TS, T0, BankState
from nightledger.schemas import CLIENTS_HIST, TERMINALS_HIST
from nightledger.sources import files

Query = Callable[[SparkSession, str], DataFrame]


def _state(spark: SparkSession, sf_dir: str) -> BankState:
    st = BankState(spark, sf_dir)
    st.stored()
    return st


def _h1(spark: SparkSession, sf_dir: str):
    st = _state(spark, sf_dir)
    return st, st.fact(), st.hist("cards", 1), st.hist("accounts", 1), st.hist("clients", 1)


def _tomb_ts(dim: str):
    return D1 if dim == "terminals" else RUN_TS


def _meta_day0(spark: SparkSession, st: BankState) -> DataFrame:
    m = meta.watermark_set(meta.meta_seed(spark), TERMINALS_HIST, D0)
    for dim in ("accounts", "cards", "clients"):
        m = meta.watermark_advance(m, st.stg(dim, 0), dim)
    return m


def _meta_day1(spark: SparkSession, st: BankState) -> DataFrame:
    m = meta.watermark_set(_meta_day0(spark, st), TERMINALS_HIST, D1)
    for dim in ("accounts", "cards", "clients"):
        m = meta.watermark_advance(m, st.stg(dim, 1), dim)
    return m


def _scalar_cleaning(spark, sf):
    return cleaning.scalar_cleaning(fx.stg_transactions(spark, sf))


def _fact_transactions(spark, sf):
    return cleaning.clean_transactions(fx.stg_transactions(spark, sf))


def _fact_blacklist(spark, sf):
    return cleaning.clean_blacklist(fx.stg_blacklist(spark, sf))


def _cdc(dim: str) -> Query:
    return lambda spark, sf: cdc.cdc_extract(_state(spark, sf).src(dim, 1), dim, T0)


def _terminal_diff(spark, sf):
    st = _state(spark, sf)
    return cdc.snapshot_diff(st.src("terminals", 1), st.hist("terminals", 0))


def _watermark_get(spark, sf):
    return meta.watermark_get(_meta_day1(spark, _state(spark, sf)), CLIENTS_HIST)


def _watermark_terminals(spark, sf):
    return meta.watermark_set(_meta_day0(spark, _state(spark, sf)), TERMINALS_HIST, D1)


def _watermark_advance(spark, sf):
    return _meta_day1(spark, _state(spark, sf))


def _scd2(dim: str) -> Query:
    return lambda spark, sf: _state(spark, sf).step(dim, 1)


def _tombstone(dim: str) -> Query:
    def q(spark, sf):
        st = _state(spark, sf)
        return scd2.tombstone(st.hist(dim, 1), st.keys(dim, 1), dim, _tomb_ts(dim))
    return q


def _tombstone_literal(dim: str) -> Query:
    def q(spark, sf):
        st = _state(spark, sf)
        return scd2.tombstone_literal(st.hist(dim, 1), st.keys(dim, 1), dim, _tomb_ts(dim))
    return q


def _dim_open(dim: str) -> Query:
    return lambda spark, sf: scd2.dim_open(_tombstone(dim)(spark, sf))


def _party_info(spark, sf):
    _, _, c, a, k = _h1(spark, sf)
    return party_info(c, a, k)


def _trans_terminal_city(spark, sf):
    st = _state(spark, sf)
    return rules.trans_terminal_city(st.fact(), st.hist("terminals", 1))


def _fraud1_expired(spark, sf):
    _, f, c, a, k = _h1(spark, sf)
    return rules.fraud1_expired(f, c, a, k, RUN_TS)


def _fraud1_blacklist(spark, sf):
    st, f, c, a, k = _h1(spark, sf)
    return rules.fraud1_blacklist(f, c, a, k, st.blacklist(), RUN_TS)


def _fraud1(spark, sf):
    st, f, c, a, k = _h1(spark, sf)
    return rules.fraud1(f, c, a, k, st.blacklist(), RUN_TS)


def _fraud2(spark, sf):
    _, f, c, a, k = _h1(spark, sf)
    return rules.fraud2(f, c, a, k, RUN_TS)


def _fraud3_events(spark, sf):
    st = _state(spark, sf)
    return rules.fraud3_events(st.fact(), st.hist("terminals", 1))


def _fraud3(spark, sf):
    st, f, c, a, k = _h1(spark, sf)
    return rules.fraud3(f, st.hist("terminals", 1), c, a, k, R3_W, RUN_TS)


def _fraud4_events(spark, sf):
    return rules.fraud4_events(_state(spark, sf).fact())


def _fraud4(spark, sf):
    _, f, c, a, k = _h1(spark, sf)
    return rules.fraud4(f, c, a, k, D1, RUN_TS)


def _fraud_report(spark, sf):
    st, f, c, a, k = _h1(spark, sf)
    return rules.fraud_report(f, st.hist("terminals", 1), c, a, k, st.blacklist(), D1, RUN_TS)


def _fraud1_strict(spark, sf):
    st, f, c, a, k = _h1(spark, sf)
    return strict.fraud1_strict(f, c, a, k, st.blacklist(), RUN_TS)


def _fraud2_strict(spark, sf):
    _, f, c, a, k = _h1(spark, sf)
    return strict.fraud2_strict(f, c, a, k, RUN_TS)


def _fraud3_strict(spark, sf):
    st, f, c, a, k = _h1(spark, sf)
    return strict.fraud3_strict(f, st.hist("terminals", 1), c, a, k, D1, RUN_TS)


def _fraud4_strict(spark, sf):
    _, f, c, a, k = _h1(spark, sf)
    return strict.fraud4_strict(f, c, a, k, None, RUN_TS)


_EXPORTS: dict[tuple[str, str], dict[str, str]] = {}


def _exports(spark, sf):
    """Export files derived from the test tables, written once per session (upstream input)."""
    from nightledger.session import scratch
    key = (spark.sparkContext.applicationId, sf)
    if key not in _EXPORTS:
        _EXPORTS[key] = fx.export_files(spark, sf, scratch(spark, "exports"))
    return _EXPORTS[key]


def _src_transactions(spark, sf):
    return files.read_transactions(spark, _exports(spark, sf)["tx"])


def _src_terminals(spark, sf):
    return files.read_terminals(spark, _exports(spark, sf)["ter"], with_date=True)


def _src_blacklist(spark, sf):
    return files.read_blacklist(spark, _exports(spark, sf)["bl1"])


def _file_business_date(spark, sf):
    from pyspark.sql import functions as F
    tx = files.read_transactions(spark, _exports(spark, sf)["tx"], with_date=True)
    return tx.groupBy("business_date").agg(F.count(F.lit(1)).alias("n_rows"))


def _ingest_available_now(spark, sf):
    from nightledger.session import scratch
    from nightledger.streaming.ingest import ingest_available_now
    # its own copy: cleanSource moves files that a committed batch has read
    paths = fx.export_files(spark, sf, scratch(spark, "exports-stream"))
    s = scratch(spark, "ingest")
    return ingest_available_now(spark, paths["tx"], f"{s}/sink", f"{s}/checkpoint",
                                f"{s}/archive")


def _pipeline_day(spark, sf):
    from nightledger.plans.pipeline import run_day
    from nightledger.plans.store import Warehouse
    from nightledger.session import scratch
    paths = _exports(spark, sf)
    wh = Warehouse(spark, scratch(spark, "warehouse"))
    return run_day(wh, fx.day_inputs(spark, sf, paths, 0), fx.RUN_TS0)


def _pipeline_replay(spark, sf):
    from nightledger.plans.pipeline import replay
    from nightledger.plans.store import Warehouse
    from nightledger.session import scratch
    paths = _exports(spark, sf)
    wh = Warehouse(spark, scratch(spark, "warehouse"))
    days = [(fx.day_inputs(spark, sf, paths, 1), RUN_TS), (fx.day_inputs(spark, sf, paths, 0), fx.RUN_TS0)]
    return replay(wh, days)


def queries() -> dict[str, Query]:
    q: dict[str, Query] = {
        "src_transactions": _src_transactions,
        "src_terminals": _src_terminals,
        "src_blacklist": _src_blacklist,
        "file_business_date": _file_business_date,
        "ingest_available_now": _ingest_available_now,
        "scalar_cleaning": _scalar_cleaning,
        "fact_transactions": _fact_transactions,
        "fact_blacklist": _fact_blacklist,
        "cdc_accounts": _cdc("accounts"),
        "cdc_cards": _cdc("cards"),
        "cdc_clients": _cdc("clients"),
        "terminal_diff": _terminal_diff,
        "watermark_get": _watermark_get,
        "watermark_terminals": _watermark_terminals,
        "watermark_advance": _watermark_advance,
        "party_info": _party_info,
        "trans_terminal_city": _trans_terminal_city,
        "fraud1_expired": _fraud1_expired,
        "fraud1_blacklist": _fraud1_blacklist,
        "fraud1": _fraud1,
        "fraud2": _fraud2,
        "fraud3_events": _fraud3_events,
        "fraud3": _fraud3,
        "fraud4_events": _fraud4_events,
        "fraud4": _fraud4,
        "fraud_report": _fraud_report,
        "fraud1_strict": _fraud1_strict,
        "fraud2_strict": _fraud2_strict,
        "fraud3_strict": _fraud3_strict,
        "fraud4_strict": _fraud4_strict,
        "pipeline_day": _pipeline_day,
        "pipeline_replay": _pipeline_replay,
    }
    for dim in ("terminals", "accounts", "cards", "clients"):
        q[f"scd2_{dim}"] = _scd2(dim)
        q[f"tombstone_{dim}"] = _tombstone(dim)
        q[f"tombstone_literal_{dim}"] = _tombstone_literal(dim)
        q[f"dim_open_{dim}"] = _dim_open(dim)
    return q
