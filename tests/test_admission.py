"""What is loaded once is not loaded again: the ledger of exports and the marker that one attempt wins."""

import datetime as dt
import shutil
from concurrent.futures import ThreadPoolExecutor

import pytest

from nightledger.plans import fixtures as fx
from nightledger.plans import ledger, pipeline
from nightledger.plans.store import AlreadyCommitted, Warehouse
from nightledger.session import scratch
from nightledger.sources import files

SF = "/root/testdata/sf0.001"


def rows(df):
    return sorted(tuple(str(v) for v in r) for r in df.collect())


@pytest.fixture(scope="module")
def exports(spark):
    return fx.export_files(spark, SF, scratch(spark, "t-exports"))


@pytest.fixture(scope="module")
def days(spark, exports):
    return [(fx.day_inputs(spark, SF, exports, v), ts) for v, ts in ((0, fx.RUN_TS0), (1, fx.RUN_TS))]


@pytest.fixture(scope="module")
def loaded(spark, days):
    wh = Warehouse(spark, scratch(spark, "t-wh"))
    return wh, rows(pipeline.replay(wh, days))


def state(wh):
    return {t: rows(wh.read(t)) for t in ("fact_transactions", "rep_fraud", "dim_clients_hist", "meta_loading", "card_span", "export_files")}


def test_the_same_export_again_gives_the_committed_report_and_changes_nothing(loaded, days):
    wh, report = loaded
    before = state(wh)
    first = rows(wh.report(1))
    for inp, ts in days:
        again = rows(pipeline.run_day(wh, inp, ts + dt.timedelta(days=1)))
        assert again == rows(wh.report(1 if inp is days[0][0] else 2))
    assert first and state(wh) == before and wh.committed_run() == 2


def test_a_second_replay_changes_nothing(loaded, days):
    wh, report = loaded
    before = state(wh)
    assert rows(pipeline.replay(wh, days[::-1])) == report and state(wh) == before


def test_an_export_in_another_place_is_the_same_and_one_with_another_line_is_not(spark, loaded, days, tmp_path):
    wh, _ = loaded
    inp = days[1][0]
    moved = tmp_path / "moved"
    shutil.copytree(inp.transactions.removeprefix("file:"), moved / "transactions_all")
    other = pipeline.DayInputs(str(moved), inp.terminals, inp.blacklist, inp.accounts, inp.cards, inp.clients)
    assert ledger.admit(wh, other, fx.D1) == 2
    (moved / "transactions_late.txt").write_text("a;b;c;d;e;f;g\n9;2024-01-15;1;4;PAY;SUCCESS;T1\n")
    with pytest.raises(ledger.Refused, match=r"2024-01-15 is loaded \(run 2\) with other content than transactions_late.txt"):
        pipeline.run_day(wh, other, fx.RUN_TS)


def test_an_older_export_is_refused_by_name(spark, days):
    wh = Warehouse(spark, scratch(spark, "t-wh"))
    pipeline.run_day(wh, *days[1])
    before = state(wh)
    with pytest.raises(ledger.Refused, match="2024-01-01 is older than the last one loaded, of 2024-01-15"):
        pipeline.run_day(wh, *days[0])
    assert state(wh) == before


def test_of_two_attempts_side_by_side_one_counts(spark, days):
    wh = Warehouse(spark, scratch(spark, "t-wh"))

    def one():
        try:
            return rows(pipeline.run_day(wh, *days[0]))
        except AlreadyCommitted:
            return None
    with ThreadPoolExecutor(2) as pool:
        done = [f.result() for f in [pool.submit(one) for _ in range(2)]]
    assert sum(d is not None for d in done) >= 1   # both only if one began after the other had ended
    assert wh.committed_run() == 1 and rows(wh.read("rep_fraud")) == next(d for d in done if d is not None)
    assert wh.read("fact_transactions").count() == len({r.trans_id for r in wh.read("fact_transactions").collect()})


def test_a_marker_is_created_once_and_a_later_one_of_the_run_counts(spark):
    wh = Warehouse(spark, scratch(spark, "t-wh"))
    a, b = wh.begin(1), wh.begin(1)
    wh.commit(a, fx.D0, fx.RUN_TS0)
    with pytest.raises(AlreadyCommitted):
        wh.commit(b, fx.D0, fx.RUN_TS0)
    c = wh.begin(1)   # begun with the first marker in sight: replaces it
    wh.commit(c, fx.D0, fx.RUN_TS0)
    assert [(r.run, r.attempt, r.business_date) for r in wh.runs().collect()] == [(1, c, fx.D0)]


def test_business_date_is_that_of_the_file_in_any_case(spark, tmp_path):
    folder = tmp_path / "transactions_09092023"
    folder.mkdir()
    (folder / "Transactions_02012024.txt").write_text("a;b;c;d;e;f;g\n7;2024-01-02;1;4;PAY;SUCCESS;T1\n")
    assert files.read_transactions(spark, str(folder), with_date=True).first().business_date == dt.datetime(2024, 1, 2)
    assert pipeline.file_date("/in/terminals_09092023/TERMINALS_02012024.xlsx") == dt.datetime(2024, 1, 2)
