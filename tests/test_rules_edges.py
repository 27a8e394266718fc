"""Hand-made operations that sit exactly on the rule boundaries."""

import datetime as dt
from decimal import Decimal

from hypothesis import given, settings
from hypothesis import strategies as st

from nightledger import schemas as S
from nightledger.operators import rules, sequence

T = dt.datetime(2024, 1, 10, 23, 30, 0)   # close to midnight: lags cross a day bucket
MAXD = S.MAXD


def fact(spark, rows):
    data = [(str(i), T + dt.timedelta(seconds=s), card, "x", Decimal(a), res, term)
            for i, (s, card, a, res, term) in enumerate(rows)]
    return spark.createDataFrame(data, S.FACT_TRANSACTIONS)


def terminals(spark):
    rows = [("T1", "ATM", "A", "a1", dt.datetime(2023, 1, 1), MAXD, "N"),
            ("T2", "ATM", "B", "b1", dt.datetime(2023, 1, 1), MAXD, "N")]
    return spark.createDataFrame(rows, S.DIM_TERMINALS_HIST)


def test_rule3_one_hour_inclusive(spark):
    f = fact(spark, [(0, "c1", "1", "SUCCESS", "T1"), (3600, "c1", "1", "SUCCESS", "T2"),
                     (0, "c2", "1", "SUCCESS", "T1"), (3601, "c2", "1", "SUCCESS", "T2")])
    ev = {r.card_num: r.event_dt for r in rules.fraud3_events(f, terminals(spark)).collect()}
    assert ev == {"c1": T + dt.timedelta(seconds=3600)}


def test_rule4_twenty_minutes_exclusive(spark):
    seq = [(0, "REJECT"), (60, "REJECT"), (120, "REJECT")]
    rows = [(s, "c1", "9", r, "T1") for s, r in seq] + [(1199, "c1", "1", "SUCCESS", "T1")]
    rows += [(s, "c2", "9", r, "T1") for s, r in seq] + [(1200, "c2", "1", "SUCCESS", "T1")]
    ev = [r.card_num for r in rules.fraud4_events(fact(spark, rows)).collect()]
    assert ev == ["c1"]


def test_ties_broken_by_numeric_id(spark):
    # same second: ids 9 and 10 order numerically (9 before 10), not as text
    data = [("10", T, "c1", "x", Decimal(1), "SUCCESS", "T1"),
            ("9", T, "c1", "x", Decimal(1), "REJECT", "T1")]
    df = spark.createDataFrame(data, S.FACT_TRANSACTIONS)
    out = sequence.lagged(df, {"prev": ("oper_result", 1)}, "1 HOUR").collect()
    prev = {r.trans_id: r.prev for r in out}
    assert prev == {"9": None, "10": "REJECT"}


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 4 * 86400)), min_size=1, max_size=40))
def test_bucketed_lag_equals_plain_window(spark, ops):
    rows = [(str(i), T + dt.timedelta(seconds=s), f"c{c}", "x", Decimal(1), "R", "T1")
            for i, (c, s) in enumerate(ops)]
    df = spark.createDataFrame(rows, S.FACT_TRANSACTIONS)
    lags = {"p1": ("trans_date", 1), "p3": ("trans_id", 3)}
    a = sequence.lagged(df, lags, "1 HOUR", bucket="1 DAY").collect()
    b = sequence.lagged(df, lags, "1 HOUR", bucket=None).collect()
    c = sequence.lagged(df, lags, "1 HOUR", bucket="2 HOURS").collect()
    key = lambda r: r.trans_id
    assert sorted(a, key=key) == sorted(b, key=key) == sorted(c, key=key)


def test_bucketed_lag_ignores_session_zone(spark):
    """A DST change in the session zone must not move rows across buckets."""
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        base = dt.datetime(2024, 3, 10, 1, 30, 0)   # clocks jump 02:00 -> 03:00 in that zone
        rows = [(str(i), base + dt.timedelta(minutes=25 * i), "c1", "x", Decimal(1), "R", "T1")
                for i in range(8)]
        df = spark.createDataFrame(rows, S.FACT_TRANSACTIONS)
        lags = {"p1": ("trans_date", 1)}
        a = sorted(sequence.lagged(df, lags, "1 HOUR", bucket="1 HOUR").collect())
        b = sorted(sequence.lagged(df, lags, "1 HOUR", bucket=None).collect())
        assert a == b
        assert sum(r.p1 is not None for r in a) == 7
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
