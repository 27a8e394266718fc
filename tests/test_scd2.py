import datetime as dt

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from nightledger import schemas as S
from nightledger.operators import cdc, meta, scd2

T0 = dt.datetime(2024, 1, 1)
MAXD = S.MAXD


def accounts_src(spark, rows):
    return spark.createDataFrame(rows, S.SRC_ACCOUNTS)


def test_change_at_watermark_is_not_extracted(spark):
    src = accounts_src(spark, [("A1", None, "C1", T0, None),
                               ("A2", None, "C2", T0, T0 + dt.timedelta(seconds=1)),
                               ("A3", None, "C3", T0 - dt.timedelta(days=1), T0)])
    got = sorted(r.account_num for r in cdc.cdc_extract(src, "accounts", T0).collect())
    assert got == ["A2"]


def test_empty_staging_keeps_watermark(spark):
    m = meta.meta_seed(spark)
    empty = spark.createDataFrame([], S.STG_ACCOUNTS)
    out = {r.tablename: r.last_update for r in meta.watermark_advance(m, empty, "accounts").collect()}
    assert out[S.ACCOUNTS_HIST] == S.SEED_W


def test_terminal_diff_any_version_and_nulls(spark):
    hist = spark.createDataFrame([
        ("T1", "ATM", "A", "x", T0, T0 + dt.timedelta(days=1), "N"),     # closed old version
        ("T1", "ATM", "B", "x", T0 + dt.timedelta(days=2), MAXD, "N"),
        ("T2", "ATM", None, "y", T0, MAXD, "N")], S.DIM_TERMINALS_HIST)
    snap = spark.createDataFrame([("T1", "ATM", "A", "x"), ("T2", "ATM", None, "y")],
                                 S.STG_TERMINALS)
    # back to an old version: not reloaded (matches a closed row); NULL never matches
    assert [r.terminal_id for r in cdc.snapshot_diff(snap, hist).collect()] == ["T2"]
    assert cdc.snapshot_diff(snap, hist, null_safe=True).count() == 0
    opened = cdc.snapshot_diff(snap, hist, against="open", null_safe=True).collect()
    assert [r.terminal_id for r in opened] == ["T1"]


def test_duplicate_staged_key_fails(spark):
    # an open row that two staged rows would both update (the MERGE fails on this too)
    hist = spark.createDataFrame([("A1", None, "C1", T0, MAXD, "N")], S.DIM_ACCOUNTS_HIST)
    t1, t2 = T0 + dt.timedelta(days=1), T0 + dt.timedelta(days=2)
    stg = spark.createDataFrame([("A1", None, "C1", T0, t1), ("A1", None, "C1", T0, t2)],
                                S.STG_ACCOUNTS)
    for rows in (stg, scd2.scd2_open(stg, "accounts")):
        with pytest.raises(ValueError):
            scd2.staged_once(rows, "accounts")
    assert scd2.scd2_apply(hist, scd2.staged_once(stg.limit(1), "accounts"), "accounts").count() == 2


@settings(max_examples=10, deadline=None)
@given(st.lists(st.lists(st.sampled_from(["A1", "A2", "A3"]), unique=True, max_size=3),
                min_size=1, max_size=4))
def test_increasing_changes_keep_one_open_row(spark, days):
    hist = scd2.empty_history(spark, "accounts")
    for i, keys in enumerate(days):
        t = T0 + dt.timedelta(days=i)
        stg = spark.createDataFrame([(k, None, "C", T0, t) for k in keys], S.STG_ACCOUNTS)
        hist = scd2.scd2_apply(hist, stg, "accounts")
        present = spark.createDataFrame([(k,) for k in ("A1", "A2") if True], "id string")
        hist = scd2.tombstone(hist, present, "accounts", t + dt.timedelta(hours=1))
        hist = spark.createDataFrame(hist.collect(), S.DIM_ACCOUNTS_HIST)
    rows = hist.collect()
    by_key = {}
    for r in rows:
        by_key.setdefault(r.account_num, []).append(r)
    for k, vs in by_key.items():
        assert sum(v.effective_to == MAXD for v in vs) == 1, k
        vs = sorted(vs, key=lambda v: v.effective_from)
        for a, b in zip(vs, vs[1:]):
            assert a.effective_to < b.effective_from   # versions never overlap
        assert all(v.effective_from <= v.effective_to for v in vs)


def test_tombstone_not_reissued(spark):
    hist = spark.createDataFrame([("A1", None, "C1", T0, MAXD, "N")], S.DIM_ACCOUNTS_HIST)
    none = spark.createDataFrame([], "id string")
    t1 = T0 + dt.timedelta(days=1)
    once = scd2.tombstone(hist, none, "accounts", t1)
    twice = scd2.tombstone(once, none, "accounts", t1 + dt.timedelta(days=1))
    assert once.count() == 2 and twice.count() == 2
    lit = scd2.tombstone_literal(hist, none, "accounts", t1)
    lit2 = scd2.tombstone_literal(lit, none, "accounts", t1 + dt.timedelta(days=1))
    assert lit2.count() > lit.count()   # the source's literal step multiplies 'Y' rows
