"""Every row of a file is loaded or named among the rejects, or the run does not count."""

import shutil

import pytest
from pyspark.sql import functions as F

from nightledger.operators import cleaning
from nightledger.plans import fixtures as fx
from nightledger.plans import pipeline
from nightledger.plans.store import Warehouse
from nightledger.schemas import STG_BLACKLIST, STG_TRANSACTIONS
from nightledger.session import scratch
from nightledger.sources import files

SF = "/root/testdata/sf0.001"
HEAD, GOOD = "a;b;c;d;e;f;g\n", "7;2024-01-02;1;4;PAY;SUCCESS;T1\n"


def test_lines_of_another_width_are_named(spark, tmp_path):
    (tmp_path / "transactions_01012024.txt").write_text(HEAD + GOOD + "8;2024-01-02;1\n" + "9;2024-01-02;1;4;PAY;SUCCESS;T1;more\n" + "10;never;x;4;PAY;SUCCESS;T1\n")
    read = files.read_transactions(spark, str(tmp_path), malformed=True)
    read.write.parquet(str(tmp_path / "staged"))   # as the job does
    stg = spark.read.schema(read.schema).parquet(str(tmp_path / "staged"))
    assert stg.columns[:-1] == STG_TRANSACTIONS.names
    bl = spark.createDataFrame([("2024-01-05", "P1"), ("5 Jan", "P2"), ("", "P3")], STG_BLACKLIST)
    got = {(r.source, r.id, r.line, r.reason) for r in cleaning.rejected_lines(stg, bl).collect()}
    assert got == {("transactions", None, "8;2024-01-02;1", "malformed"), ("transactions", None, "9;2024-01-02;1;4;PAY;SUCCESS;T1;more", "malformed"),
                   ("transactions", "10", "10;never;x;4;PAY;SUCCESS;T1", "trans_date, amt"), ("blacklist", "P2", "5 Jan;P2", "report_dt")}


def test_read_is_loaded_and_rejected_in_every_run(spark, tmp_path, monkeypatch):
    exports = fx.export_files(spark, SF, scratch(spark, "t-exports"))
    inp = fx.day_inputs(spark, SF, exports, 0)
    shutil.copytree(inp.transactions.removeprefix("file:"), tmp_path / "in" / "transactions_all")
    (tmp_path / "in" / "transactions_bad.txt").write_text(HEAD + "x;y\n" + GOOD.replace("2024-01-02", "soon"))
    inp.transactions = str(tmp_path / "in")
    wh = Warehouse(spark, scratch(spark, "t-wh"))
    with monkeypatch.context() as m:   # a row goes missing on the way to the fact
        plain = cleaning.clean_transactions
        m.setattr(cleaning, "clean_transactions", lambda stg: plain(stg).limit(5))
        with pytest.raises(pipeline.RowsLost, match="transactions: .* 5 loaded and 1 malformed"):
            pipeline.run_day(wh, inp, fx.RUN_TS0)
    assert wh.committed_run() is None
    pipeline.run_day(wh, inp, fx.RUN_TS0)
    n = wh.read("fact_transactions").count()
    counts = {r.source: tuple(r)[1:] for r in wh.read("run_counts").collect()}
    assert counts["transactions"] == (n + 1, n, 1, 1) and counts["blacklist"][0] == counts["blacklist"][1] > 0
    assert {r.reason for r in wh.read("rejects").collect()} == {"malformed", "trans_date"}
    assert wh.read("fact_transactions").where(F.col("trans_id") == "x").count() == 0
