"""The daily job (E1) and the replay of several exports.

One run: stage the day's files and the source snapshots, each read once,
extract changes by watermark, apply SCD2 and delete detection to the four history tables,
append the transactions, refresh the blacklist, advance the watermarks,
then build the day's fraud report from the *published* tables (reading
them back cuts the lineage, so a lost executor only recomputes from
Parquet) and append it. The run becomes visible with its commit marker.
"""

from __future__ import annotations

import datetime as _dt
import re
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nightledger.operators import cdc, cleaning, incremental, meta, rules, scd2
from nightledger.plans import ledger
from nightledger.plans.store import Warehouse
from nightledger.schemas import DIMENSIONS, HIST_TABLES, RUN_COUNTS, TERMINALS_HIST
from nightledger.sources.files import (MALFORMED, TERMINALS_STEM, read_blacklist, read_terminals,
                                       read_transactions)

DIMS = ("terminals", "accounts", "cards", "clients")


@dataclass
class DayInputs:
    """One daily export: three files and the three source-table snapshots."""

    transactions: str      # path or glob of the day's transactions text file(s)
    terminals: str         # the day's terminals workbook (full snapshot)
    blacklist: str         # the month-to-date blacklist workbook
    accounts: DataFrame    # source snapshots (JDBC in production, Parquet in tests)
    cards: DataFrame
    clients: DataFrame


def file_date(path: str, stem: str = TERMINALS_STEM) -> _dt.datetime:
    """Business date from ``<stem>_DDMMYYYY`` in a file name."""
    found = re.findall(rf"(?i){stem}_(\d{{2}})(\d{{2}})(\d{{4}})", path)
    if not found:
        raise ValueError(f"no business date in {path}")
    d, mo, y = (int(x) for x in found[-1])  # the file's own name before its folders
    return _dt.datetime(y, mo, d)


def _run_all(jobs) -> list:
    """Run independent jobs concurrently; their results in order, or the first failure."""
    from concurrent.futures import ThreadPoolExecutor
    jobs = list(jobs)
    with ThreadPoolExecutor(max_workers=len(jobs)) as pool:
        return [f.result() for f in [pool.submit(j) for j in jobs]]


class RowsLost(RuntimeError):
    """What a run has written is not what it has read."""


def conserved(wh: Warehouse, staged: dict[str, DataFrame], attempt: str) -> DataFrame:
    """Counts of the files' rows: read = loaded + malformed, or :class:`RowsLost`.

    Counted in the tables as written, which is right after retries too and reads file footers only.
    """
    why = {(r.source, r.reason == "malformed"): r["count"] for r in
           wh.read("rejects", 0, attempt).groupBy("source", F.when(F.col("reason") == "malformed", "malformed").alias("reason")).count().collect()}
    out = []
    for source, fact in (("transactions", wh.read("fact_transactions", 0, attempt)), ("blacklist", wh.read("fact_blacklist", attempt=attempt))):
        read, loaded, malformed = staged[source].count(), fact.count(), why.get((source, True), 0)
        if read != loaded + malformed:
            raise RowsLost(f"{source}: {read} rows read, {loaded} loaded and {malformed} malformed")
        out.append((source, read, loaded, malformed, why.get((source, False), 0)))
    return wh.spark.createDataFrame(out, RUN_COUNTS)


def run_day(wh: Warehouse, inp: DayInputs, run_ts: _dt.datetime,
            run: int | None = None) -> DataFrame:
    """Process one export; returns the report rows this run appended.

    An export that is loaded already changes nothing and returns the rows of
    the run that loaded it; see :mod:`nightledger.plans.ledger` for what is
    refused. ``run`` may be the last committed run, which is then replaced;
    earlier runs are refused, as later ones are built on them.
    """
    spark, last = wh.spark, wh.committed_run()
    day = file_date(inp.terminals)
    if run is not None and last is not None and run < last:
        wh.begin(run)  # raises
    loaded = ledger.admit(wh, inp, day, replacing=run)
    if loaded is not None:
        return wh.report(loaded)
    run = run or (last or 0) + 1
    prev = run - 1 if run > 1 else None
    attempt = wh.begin(run)

    # control table: tiny (one row per history table), read once on the driver
    m = wh.read("meta_loading", prev) if prev else meta.meta_seed(spark)
    m = meta.watermark_set(m, TERMINALS_HIST, day)
    marks = {t: meta.watermark_value(m, t) for t in HIST_TABLES}

    # each source is read once; changes, keys and watermarks all come from the staged rows
    src = {"accounts": inp.accounts, "cards": inp.cards, "clients": inp.clients}
    stage = {d: lambda d=d: wh.stage(cdc.staged(src[d], d, marks[DIMENSIONS[d]["meta"]]), d, attempt) for d in src}
    stage["terminals"] = lambda: wh.stage(read_terminals(spark, inp.terminals), "terminals", attempt)
    stage["transactions"] = lambda: wh.stage(read_transactions(spark, inp.transactions, malformed=True), "transactions", attempt)
    stage["blacklist"] = lambda: wh.stage(read_blacklist(spark, inp.blacklist), "blacklist", attempt)
    staged = dict(zip(stage, _run_all(stage.values()), strict=True))

    stg = {d: staged[d].where("changed").drop("changed") for d in src}
    terminals_before = wh.before("dim_terminals_hist", prev)
    stg["terminals"] = cdc.snapshot_diff(staged["terminals"], terminals_before)
    keys = {d: staged[d].select(F.col(DIMENSIONS[d]["key"]).alias("id")) for d in DIMS}
    _run_all([lambda d=d: scd2.staged_once(stg[d], d) for d in DIMS])

    # independent outputs go out as concurrent Spark jobs: the day's transactions and
    # those that could not be read, the blacklist, each history table, the control table
    whole = staged["transactions"].where(F.col(MALFORMED).isNull()).drop(MALFORMED)
    writes = [
        lambda: wh.write(cleaning.clean_transactions(whole), "fact_transactions", attempt),
        lambda: wh.write(cleaning.rejected_lines(staged["transactions"], staged["blacklist"]), "rejects", attempt),
        lambda: wh.write(ledger.fingerprints(spark, inp, day), "export_files", attempt),
        lambda: wh.write(cleaning.clean_blacklist(staged["blacklist"]), "fact_blacklist", attempt),
    ]
    for d in DIMS:
        # closed rows pass through every step, so only the open ones are read and written
        h = scd2.scd2_apply(wh.open_rows(f"dim_{d}_hist", prev), stg[d], d, eff_from=day if d == "terminals" else None)
        h = scd2.tombstone(h, keys[d], d, day if d == "terminals" else run_ts)
        writes.append(lambda h=h, d=d: wh.write(h, f"dim_{d}_hist", attempt))
    for d in src:
        m = meta.watermark_advance(m, stg[d], d)
    writes.append(lambda m=m: wh.write(m, "meta_loading", attempt))
    _run_all(writes)
    wh.write(conserved(wh, staged, attempt), "run_counts", attempt)

    # state tables of the rules, each brought up to date from the run's changes
    fact = wh.read("fact_transactions", prev or 0, attempt)
    today = wh.read("fact_transactions", 0, attempt)
    t = {d: wh.read(f"dim_{d}_hist", prev or 0, attempt) for d in DIMS}
    span = (wh.before("card_span", prev).unionByName(rules.card_span(today))
            .groupBy("card_num").agg(F.min("first_dt").alias("first_dt"),
                                     F.max("last_dt").alias("last_dt")))
    days = wh.before("terminal_days", prev).unionByName(incremental.terminal_days(today)).distinct()
    _run_all([lambda: wh.write(span, "card_span", attempt), lambda: wh.write(days, "terminal_days", attempt)])
    fresh = incremental.new_versions(terminals_before, t["terminals"])
    wh.write(incremental.fraud3_state(wh.before("rule3_events", prev), fact, today, t["terminals"], fresh,
                                      wh.read("terminal_days", attempt=attempt)), "rule3_events", attempt)

    # report from the published tables: transactions of the runs before and of this one
    report = rules.fraud_report(fact, t["terminals"], t["cards"], t["accounts"], t["clients"],
                                wh.read("fact_blacklist", attempt=attempt), day, run_ts,
                                span=wh.read("card_span", attempt=attempt),
                                events=wh.read("rule3_events", attempt=attempt))
    wh.write(report, "rep_fraud", attempt)
    wh.commit(attempt, day, run_ts)
    return wh.read("rep_fraud", 0, attempt)


def replay(wh: Warehouse, days: list[tuple[DayInputs, _dt.datetime]]) -> DataFrame:
    """Run several exports in business-date order; returns the whole report. Those already loaded are passed over."""
    for inp, run_ts in sorted(days, key=lambda x: file_date(x[0].terminals)):
        run_day(wh, inp, run_ts)
    return wh.read("rep_fraud")
