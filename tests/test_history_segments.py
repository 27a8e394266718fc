"""History in segments: closed rows written once, earlier states readable, left-over attempts removable."""

import pytest
from pyspark.sql import functions as F

from nightledger.operators.scd2 import is_open
from nightledger.plans import fixtures as fx
from nightledger.plans import pipeline
from nightledger.plans.store import CLOSED, HISTORY, OPEN, AlreadyCommitted, Warehouse
from nightledger.session import scratch

SF = "/root/testdata/sf0.001"


def rows(df):
    return sorted(tuple(str(v) for v in r) for r in df.collect())


@pytest.fixture(scope="module")
def job(spark):
    """A warehouse with two runs, and what a run that crashed in between has left; also the state after the first run."""
    exports = fx.export_files(spark, SF, scratch(spark, "t-exports"))
    days = [fx.day_inputs(spark, SF, exports, v) for v in (0, 1)]
    wh = Warehouse(spark, scratch(spark, "t-wh"))
    pipeline.run_day(wh, days[0], fx.RUN_TS0)
    first = {t: rows(wh.read(t)) for t in HISTORY}
    with pytest.MonkeyPatch.context() as m:
        m.setattr(Warehouse, "commit", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            pipeline.run_day(wh, days[1], fx.RUN_TS)
    pipeline.run_day(wh, days[1], fx.RUN_TS)
    return wh, first, days


def test_each_run_writes_what_it_closed_and_what_is_open(spark, job):
    wh, first, _ = job
    one, two = (wh._attempts()[r] for r in (1, 2))
    for t in HISTORY:
        of = {a: spark.read.option("basePath", f"{wh.root}/{t}").parquet(f"{wh.root}/{t}/attempt={a}") for a in (one, two)}
        assert of[one].where(F.col("segment") == CLOSED).count() == 0
        now = wh.read(t)
        assert rows(wh.read(t, 1)) == first[t]                                   # earlier states stay readable
        closed = now.where(~is_open())
        assert of[two].where(F.col("segment") == CLOSED).count() == closed.count() > 0   # all were closed by run 2
        assert rows(wh.open_rows(t, 2)) == rows(now.where(is_open()))
        assert of[two].where(F.col("segment") == OPEN).count() + closed.count() == now.count()


def test_a_third_run_does_not_write_closed_rows_again(spark, job):
    wh, _, _ = job
    attempt = wh.begin(3)
    before = rows(wh.read("dim_cards_hist"))
    wh.write(wh.open_rows("dim_cards_hist", 2), "dim_cards_hist", attempt)   # nothing changed
    assert spark.read.parquet(f"{wh.root}/dim_cards_hist/attempt={attempt}").where(F.col("segment") == CLOSED).count() == 0
    assert rows(wh.read("dim_cards_hist", 2, attempt)) == before == rows(wh.read("dim_cards_hist"))


def test_left_over_attempts_go_and_counted_ones_stay(job):
    wh, _, days = job
    old = wh.begin(2)   # replaces run 2; begun with its marker in sight
    counted = {t: rows(wh.read(t)) for t in (*HISTORY, "fact_transactions", "rep_fraud", "export_files")}
    assert wh.left_over() == []   # the crashed attempt of run 2 began with the same marker number: it might still be at work
    again = rows(pipeline.run_day(wh, days[1], fx.RUN_TS, run=2))
    assert again == rows(wh.report(2))
    gone = wh.left_over()
    kept = set(wh._attempts().values())
    assert gone and not any(a in path for path in gone for a in kept)
    assert wh.remove_left_over() == len(gone) and wh.left_over() == []
    assert {t: rows(wh.read(t)) for t in counted} == counted
    with pytest.raises(AlreadyCommitted):
        wh.commit(old, fx.D1, fx.RUN_TS)


def test_an_attempt_of_an_older_run_cannot_count_any_more(spark):
    wh = Warehouse(spark, scratch(spark, "t-wh"))
    late = wh.begin(1)
    for run in (1, 2):
        wh.commit(wh.begin(run), fx.D0, fx.RUN_TS0)
    with pytest.raises(AlreadyCommitted, match="later run"):
        wh.commit(late, fx.D0, fx.RUN_TS0)
