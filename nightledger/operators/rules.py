"""The fraud report's four rules as the source system computes them.

Rewrites that keep results equal (checked against DuckDB transcriptions):

* eager aggregation for rules 1 and 2: MIN/MAX(trans_date) decompose, so the
  fact is reduced to one row per card (partial + final hash aggregate,
  skew-proof) *before* it meets the holder join;
* rules 3 and 4 read the fact once, sorted by card and time, through the
  skew-safe sequence operator in :mod:`nightledger.operators.sequence`.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nightledger.functions.scalar import ts_lit, within
from nightledger.operators.party import party_info
from nightledger.operators.sequence import HOT_ROWS, lagged
from nightledger.session import shared_dir

REPORT_COLS = ["event_dt", "passport", "fio", "phone", "event_type", "report_dt"]


def _ts(v: _dt.datetime | Column) -> Column:
    return v if isinstance(v, Column) else ts_lit(v)


def report_rows(df: DataFrame, event_type: str, run_ts: _dt.datetime | Column) -> DataFrame:
    """Project to the report layout with a fixed event type and report time."""
    return df.select(
        F.col("event_dt"),
        F.col("passport_num").alias("passport"),
        F.col("fio"),
        F.col("phone"),
        F.lit(event_type).alias("event_type"),
        _ts(run_ts).alias("report_dt"),
    )


def card_span(fact: DataFrame) -> DataFrame:
    """First and last operation time per card (one row per card)."""
    return fact.groupBy("card_num").agg(F.min("trans_date").alias("first_dt"),
                                        F.max("trans_date").alias("last_dt"))


def _span(fact: DataFrame, span: DataFrame | None) -> DataFrame:
    return card_span(fact) if span is None else span


def _first_op_per_person(fact: DataFrame, info: DataFrame, span: DataFrame | None = None) -> DataFrame:
    # a card has as many rows as it has holder versions; one a person is enough
    person = info.select("card_num", "passport_num", "fio", "phone").distinct()
    return (_span(fact, span).join(person, "card_num")
            .groupBy("passport_num", "fio", "phone")
            .agg(F.min("first_dt").alias("event_dt")))


def fraud1_expired(fact: DataFrame, cards: DataFrame, accounts: DataFrame, clients: DataFrame,
                   run_ts: _dt.datetime, span: DataFrame | None = None) -> DataFrame:
    """Earliest operation of each person whose passport expired before the run.

    ``span`` may be a maintained per-card (first_dt, last_dt) table; by
    default it is computed from ``fact``.
    """
    info = party_info(cards, accounts, clients, expired_before=run_ts)
    return report_rows(_first_op_per_person(fact, info, span), "1", run_ts)


def fraud1_blacklist(fact: DataFrame, cards: DataFrame, accounts: DataFrame, clients: DataFrame,
                     blacklist: DataFrame, run_ts: _dt.datetime,
                     span: DataFrame | None = None) -> DataFrame:
    """Earliest operation of each blacklisted person (one row per blacklist entry)."""
    bl = blacklist.select("passport_num")
    firsts = _first_op_per_person(fact, party_info(cards, accounts, clients, passports=bl), span)
    return report_rows(bl.join(firsts, "passport_num"), "1", run_ts)


def fraud1(fact, cards, accounts, clients, blacklist, run_ts, span=None) -> DataFrame:
    """Rule 1: expired or blacklisted passport; UNION removes duplicates."""
    return (fraud1_expired(fact, cards, accounts, clients, run_ts, span)
            .unionByName(fraud1_blacklist(fact, cards, accounts, clients, blacklist, run_ts, span))
            .distinct())


def fraud2(fact: DataFrame, cards: DataFrame, accounts: DataFrame, clients: DataFrame,
           run_ts: _dt.datetime, span: DataFrame | None = None) -> DataFrame:
    """Rule 2: latest operation per (person, account validity) after the contract ended."""
    info = party_info(cards, accounts, clients, with_valid_to=True)
    last = (_span(fact, span).join(info, "card_num")
            .groupBy("passport_num", "fio", "phone", "valid_to")
            .agg(F.max("last_dt").alias("event_dt"))
            .where(F.col("event_dt") > F.col("valid_to")))
    return report_rows(last, "2", run_ts)


def trans_terminal_city(fact: DataFrame, terminals: DataFrame) -> DataFrame:
    """Each operation with the city of every version of its terminal."""
    ter = terminals.select(F.col("terminal_id").alias("terminal"), "terminal_city",
                           F.col("effective_from").alias("ter_from"))
    return (fact.select("trans_id", "trans_date", "card_num", "terminal")
                .join(ter, "terminal"))


def fraud3_events(fact: DataFrame, terminals: DataFrame) -> DataFrame:
    """First time (over all history) each card changes city within one hour."""
    seq = lagged(trans_terminal_city(fact, terminals),
                 lags={"prev_dt": ("trans_date", 1), "prev_city": ("terminal_city", 1)},
                 horizon="1 HOUR", tie_breakers=["ter_from", "terminal_city"], most=HOT_ROWS)
    hits = seq.where(within(F.col("trans_date"), F.col("prev_dt"), "1 HOUR")
                     & (F.col("terminal_city") != F.col("prev_city")))
    return hits.groupBy("card_num").agg(F.min("trans_date").alias("event_dt"))


def fraud3(fact, terminals, cards, accounts, clients, w: _dt.datetime, run_ts, events: DataFrame | None = None) -> DataFrame:
    """Rule 3 as reported: the all-time first event, kept if it is not older than W.

    ``events`` may be the maintained table of first events (see
    :mod:`nightledger.operators.incremental`); by default all of ``fact`` is read.
    """
    if events is None:
        # the report joins on the card, so operations without one need not be sorted
        events = fraud3_events(fact.where(F.col("card_num").isNotNull()), terminals)
    ev = events.where(F.col("event_dt") >= _ts(w))
    return report_rows(ev.join(party_info(cards, accounts, clients), "card_num"), "3", run_ts)


def fraud4_events(fact: DataFrame) -> DataFrame:
    """A SUCCESS right after three REJECTs, all four within (strictly) 20 minutes."""
    seq = lagged(fact.select("trans_id", "trans_date", "card_num", "oper_result"),
                 lags={"prev_res": ("oper_result", 1), "prev_res2": ("oper_result", 2),
                       "prev_res3": ("oper_result", 3), "prev_dt": ("trans_date", 3)},
                 horizon="20 MINUTES", most=HOT_ROWS)
    hit = ((F.col("oper_result") == "SUCCESS") & (F.col("prev_res") == "REJECT")
           & (F.col("prev_res2") == "REJECT") & (F.col("prev_res3") == "REJECT")
           & within(F.col("trans_date"), F.col("prev_dt"), "20 MINUTES", inclusive=False))
    return seq.where(hit).select("card_num", "trans_date")


def fraud4(fact, cards, accounts, clients, w: _dt.datetime, run_ts) -> DataFrame:
    """Rule 4 as reported: events not older than W, joined with every holder version."""
    # rows older than W - 20 min can neither be an event nor lie in one's window
    since = _ts(w) - F.expr("INTERVAL 20 MINUTES")
    recent = fact.where((F.col("trans_date") >= since) & F.col("card_num").isNotNull())
    if "op_date" in fact.columns:  # stored by operation day: older days are not opened
        recent = recent.where(F.col("op_date") >= since.cast("date"))
    ev = fraud4_events(recent).where(F.col("trans_date") >= _ts(w))
    info = party_info(cards, accounts, clients)
    return report_rows(ev.withColumnRenamed("trans_date", "event_dt").join(info, "card_num"),
                       "4", run_ts)


def fraud_report(fact, terminals, cards, accounts, clients, blacklist, w, run_ts,
                 span=None, events=None) -> DataFrame:
    """The day's report rows: rules 1-4 appended (duplicates kept).

    ``span`` (one row per card) is computed once for rules 1 and 2 if not
    given; ``events`` are the first events of rule 3, if they are maintained.
    """
    if span is None:
        shared_dir(fact.sparkSession)
        span = card_span(fact).checkpoint()
    return (fraud1(fact, cards, accounts, clients, blacklist, run_ts, span)
            .unionByName(fraud2(fact, cards, accounts, clients, run_ts, span))
            .unionByName(fraud3(fact, terminals, cards, accounts, clients, w, run_ts, events))
            .unionByName(fraud4(fact, cards, accounts, clients, w, run_ts)))
