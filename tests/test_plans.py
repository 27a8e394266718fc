"""The physical plans keep the shapes the rewrites are for."""

from nightledger.operators import rules, sequence
from nightledger.plans.fixtures import D1, RUN_TS, BankState

SF = "/root/testdata/sf0.001"


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_lags_share_one_window(spark):
    f = BankState(spark, SF).fact()
    seq = sequence.lagged(f, {"a": ("oper_result", 1), "b": ("oper_result", 2),
                              "c": ("trans_date", 3)}, "20 MINUTES")
    plan = _plan(seq)
    assert plan.count("Window [") == 1
    assert plan.count("Exchange hashpartitioning") == 1


def test_rule4_time_filter_reaches_scan(spark):
    st = BankState(spark, SF)
    st.stored()   # the fact as a stored Parquet table, as the daily job reads it
    df = rules.fraud4(st.fact(), st.hist("cards", 1), st.hist("accounts", 1),
                      st.hist("clients", 1), D1, RUN_TS)
    plan = _plan(df)
    scans = [ln for ln in plan.splitlines() if "FileScan" in ln and "oper_result" in ln]
    assert scans and all("GreaterThanOrEqual(trans_date" in ln for ln in scans), scans


def test_rule2_aggregates_fact_before_holder_join(spark):
    st = BankState(spark, SF)
    df = rules.fraud2(st.fact(), st.hist("cards", 1), st.hist("accounts", 1),
                      st.hist("clients", 1), RUN_TS)
    text = df._jdf.queryExecution().optimizedPlan().toString()
    # the per-card max sits directly on the fact scan, below every join
    agg = text.index("Aggregate [card_num")
    assert "Join" not in text[agg:text.index("Relation", agg)]
