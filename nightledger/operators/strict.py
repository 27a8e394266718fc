"""The four rules as the business description states them (V1-V4).

Differences from the source SQL: one row per operation; the card, account,
client and terminal versions are those *in force* at the operation's time
(``effective_from <= t < effective_to + 1s``, live rows only); rule 2 checks
each operation, rule 3 filters each event by W, rule 4 also requires
decreasing amounts. Where versions of a key overlap, the one that started last
is in force (``asof.disjoint``), so an operation never meets two.

Scale: the card -> account -> client chain is first collapsed into "party
versions" (one row per card and interval where all three versions hold),
which is dimension-sized; the fact then meets it in a single as-of merge by
card and time bucket, so the fact is shuffled once. With a W only the day
partitions from W on (less the rule's horizon) are opened.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nightledger.functions.scalar import fio, ts_lit, within
from nightledger.operators.asof import as_of, disjoint
from nightledger.operators.rules import report_rows
from nightledger.operators.sequence import HOT_ROWS, lagged
from nightledger.schemas import LIVE, ONE_SECOND


def _ts(v: _dt.datetime | Column) -> Column:
    return v if isinstance(v, Column) else ts_lit(v)


def _live(hist: DataFrame, key: str, prefix: str) -> DataFrame:
    """Live versions with a half-open validity ``[from, to + 1s)``, disjoint for each key."""
    v = (hist.where(F.col("deleted_flg") == LIVE)
             .withColumn(f"{prefix}_from", F.col("effective_from"))
             .withColumn(f"{prefix}_to", F.col("effective_to") + F.expr(ONE_SECOND))
             .drop("effective_from", "effective_to", "deleted_flg"))
    return disjoint(v, key, f"{prefix}_from", f"{prefix}_to")


def party_versions(cards: DataFrame, accounts: DataFrame, clients: DataFrame) -> DataFrame:
    """card_num with holder attributes and the interval ``[pv_from, pv_to)`` they hold."""
    c = _live(cards, "card_num", "c")
    a = _live(accounts, "account_num", "a").withColumnRenamed("account_num", "_acc")
    k = _live(clients, "client_id", "k").select(
        "client_id", "passport_num", "passport_valid_to", "phone",
        fio("last_name", "first_name", "patronymic").alias("fio"), "k_from", "k_to")
    ca = (c.join(a, (F.col("account_num") == F.col("_acc"))
                 & (F.col("c_from") < F.col("a_to")) & (F.col("a_from") < F.col("c_to")))
           .select("card_num", "account_num", "valid_to", "client",
                   F.greatest("c_from", "a_from").alias("ca_from"),
                   F.least("c_to", "a_to").alias("ca_to")))
    return (ca.join(k, (F.col("client") == F.col("client_id"))
                    & (F.col("ca_from") < F.col("k_to")) & (F.col("k_from") < F.col("ca_to")))
              .select("card_num", "account_num", "valid_to", "client_id", "passport_num",
                      "passport_valid_to", "phone", "fio",
                      F.greatest("ca_from", "k_from").alias("pv_from"),
                      F.least("ca_to", "k_to").alias("pv_to")))


def party_at(ops: DataFrame, pv: DataFrame, time: str = "trans_date") -> DataFrame:
    """As-of join: each operation with the holder version in force at ``time``.

    Party versions of a card are disjoint because those of all three tables are.
    """
    return as_of(ops, pv, "card_num", time, "pv_from", "pv_to")


def terminal_at(ops: DataFrame, terminals: DataFrame) -> DataFrame:
    """Each operation with the city of the terminal version in force at its time."""
    ter = _live(terminals, "terminal_id", "t").select(F.col("terminal_id").alias("terminal"), "terminal_city", "t_from", "t_to")
    return as_of(ops, ter, "terminal", "trans_date", "t_from", "t_to")


def _since(fact: DataFrame, w, horizon: str) -> DataFrame:
    """Operations from W less the horizon on; without a W all."""
    if w is None:
        return fact
    since = _ts(w) - F.expr(f"INTERVAL {horizon}")
    recent = fact.where(F.col("trans_date") >= since)
    if "op_date" in fact.columns:  # stored by operation day: older days are not opened
        recent = recent.where(F.col("op_date") >= since.cast("date"))
    return recent


def _events(df: DataFrame) -> DataFrame:
    return df.withColumnRenamed("trans_date", "event_dt")


def fraud1_strict(fact, cards, accounts, clients, blacklist, run_ts) -> DataFrame:
    """Operations made with an expired passport or one already blacklisted."""
    listed = blacklist.groupBy("passport_num").agg(F.min("entry_dt").alias("listed_from"))
    ops = party_at(fact.select("trans_id", "trans_date", "card_num"),
                   party_versions(cards, accounts, clients))
    t = F.col("trans_date")
    hit = ops.join(listed, "passport_num", "left").where(
        (t > F.col("passport_valid_to")) | (t >= F.col("listed_from")))
    return report_rows(_events(hit), "1", run_ts)


def fraud2_strict(fact, cards, accounts, clients, run_ts) -> DataFrame:
    """Operations made after the account version in force had ended."""
    ops = party_at(fact.select("trans_id", "trans_date", "card_num"),
                   party_versions(cards, accounts, clients))
    return report_rows(_events(ops.where(F.col("trans_date") > F.col("valid_to"))), "2", run_ts)


def fraud3_strict(fact, terminals, cards, accounts, clients, w, run_ts) -> DataFrame:
    """Each operation in another city than the card's previous one within an hour, from W on."""
    ops = terminal_at(_since(fact, w, "1 HOUR").select("trans_id", "trans_date", "card_num", "terminal"), terminals)
    seq = lagged(ops, {"prev_dt": ("trans_date", 1), "prev_city": ("terminal_city", 1)},
                 horizon="1 HOUR", tie_breakers=["terminal_city"], most=HOT_ROWS)
    ev = seq.where(within(F.col("trans_date"), F.col("prev_dt"), "1 HOUR")
                   & (F.col("terminal_city") != F.col("prev_city")))
    if w is not None:
        ev = ev.where(F.col("trans_date") >= _ts(w))
    ev = party_at(ev.select("trans_id", "trans_date", "card_num"),
                  party_versions(cards, accounts, clients))
    return report_rows(_events(ev), "3", run_ts)


def fraud4_strict(fact, cards, accounts, clients, w, run_ts) -> DataFrame:
    """A SUCCESS after three REJECTs within 20 minutes, each amount below the one before."""
    seq = lagged(_since(fact, w, "20 MINUTES").select("trans_id", "trans_date", "card_num", "oper_result", "amt"),
                 {"r1": ("oper_result", 1), "r2": ("oper_result", 2), "r3": ("oper_result", 3),
                  "a1": ("amt", 1), "a2": ("amt", 2), "a3": ("amt", 3),
                  "prev_dt": ("trans_date", 3)},
                 horizon="20 MINUTES", most=HOT_ROWS)
    c = F.col
    ev = seq.where((c("oper_result") == "SUCCESS") & (c("r1") == "REJECT") & (c("r2") == "REJECT")
                   & (c("r3") == "REJECT")
                   & within(c("trans_date"), c("prev_dt"), "20 MINUTES", inclusive=False)
                   & (c("amt") < c("a1")) & (c("a1") < c("a2")) & (c("a2") < c("a3")))
    if w is not None:
        ev = ev.where(c("trans_date") >= _ts(w))
    ev = party_at(ev.select("trans_id", "trans_date", "card_num"),
                  party_versions(cards, accounts, clients))
    return report_rows(_events(ev), "4", run_ts)
