"""Inputs and events that the daily job has to survive: blanks, odd files, crashes, repeats, moving sources."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from nightledger.operators import cdc, cleaning, scd2
from nightledger.plans import fixtures as fx
from nightledger.plans import pipeline
from nightledger.plans.store import Warehouse
from nightledger.schemas import DIM_ACCOUNTS_HIST, MAXD, STG_ACCOUNTS, STG_BLACKLIST, STG_TRANSACTIONS, SRC_ACCOUNTS
from nightledger.session import scratch, shared_dir
from nightledger.sources import files
from nightledger.sources.source import read_options
from nightledger.sources.workbook import FRAME, parse_xlsx, xlsx_bytes
from nightledger.streaming.ingest import ingest_available_now

SF = "/root/testdata/sf0.001"
DAY = dt.datetime(2024, 1, 2)


def rows(df):
    return sorted(tuple(str(v) for v in r) for r in df.collect())


def test_blank_text_is_null_and_bad_text_is_reported(spark):
    good = ("1", "2024-01-02 10:00:00", "1 ,5", "4000 1 ", "PAY", "SUCCESS", "T1")
    stg = spark.createDataFrame([good[:2] + ("12,5",) + good[3:], ("2", "", " ", "  ", "PAY", "SUCCESS", None), ("3", " ", "", None, None, None, None),
                                 ("4", "2024-02-30", "x1", "4", "PAY", "SUCCESS", "T"), ("5", "2024-01-02", "7", "4", "PAY", "SUCCESS", "T"),
                                 ("6", "02.01.2024", "7", "4", "PAY", "SUCCESS", "T"), ("7", "2024-01-02 25:00:00", "7", "4", "P", "S", "T")], STG_TRANSACTIONS)
    got = {r.trans_id: (r.trans_date, None if r.amt is None else float(r.amt), r.card_num) for r in cleaning.clean_transactions(stg).collect()}
    assert got["1"] == (dt.datetime(2024, 1, 2, 10), 12.5, "40001") and got["2"] == got["3"] == (None, None, None)
    assert got["4"] == got["6"][:1] + (None, "4") and got["5"][0] == DAY and got["7"][0] is None
    assert {r.trans_id: r.reason for r in cleaning.rejects(stg).collect()} == {"4": "trans_date, amt", "6": "trans_date", "7": "trans_date"}
    bl = spark.createDataFrame([("", "P"), (None, "Q")], STG_BLACKLIST)
    assert {r.entry_dt for r in cleaning.clean_blacklist(bl).collect()} == {None}


def test_versions_without_an_end_stay(spark):
    hist = spark.createDataFrame([("A1", None, "C", DAY, None, "N"), ("A2", None, "C", DAY, MAXD, "N")], DIM_ACCOUNTS_HIST)
    new = spark.createDataFrame([("A2", None, "D", DAY + dt.timedelta(days=1), None)], STG_ACCOUNTS)
    assert scd2.scd2_apply(hist, new, "accounts").where("account_num = 'A1'").count() == 1
    keys = spark.createDataFrame([("A2",)], "id string")
    assert scd2.tombstone(hist, keys, "accounts", DAY).where("account_num = 'A1'").count() == 1


def test_a_key_staged_twice_is_refused_whatever_the_history(spark):
    stg = spark.createDataFrame([("A1", None, "C", DAY, None), ("A1", None, "D", DAY, None)], STG_ACCOUNTS)
    with pytest.raises(ValueError, match="A1"):
        scd2.staged_once(stg, "accounts")
    assert scd2.staged_once(stg.limit(1), "accounts").count() == 1


def test_padded_keys_meet(spark):
    src = spark.createDataFrame([("A1   ", None, "C1  ", DAY, None)], SRC_ACCOUNTS)
    assert cdc.cdc_extract(src, "accounts", DAY - dt.timedelta(days=1)).first()[0:3] == ("A1", None, "C1")
    assert cdc.snapshot_keys(src, "accounts").first().id == "A1"


def test_staged_snapshot_has_all_keys_and_only_changed_attributes(spark):
    src = spark.createDataFrame([("A1", DAY, "C1", DAY, None), ("A2", DAY, "C2", DAY, DAY + dt.timedelta(days=3)), ("A3", DAY, "C3", None, None)], SRC_ACCOUNTS)
    got = {r.account_num: (r.client, r.changed) for r in cdc.staged(src, "accounts", DAY).collect()}
    assert got == {"A1": (None, False), "A2": ("C2", True), "A3": (None, False)}


def test_every_file_is_read_or_refused(spark, tmp_path):
    text = "a;b;c;d;e;f;g\n7;2024-01-02;1;4;PAY;SUCCESS;T1\n"
    (tmp_path / "transactions_01012024.TXT").write_text(text)
    (tmp_path / "Transactions_02012024.csv").write_text(text)
    assert files.read_transactions(spark, str(tmp_path)).count() == 2
    (tmp_path / "accounts.csv").write_text(text)
    with pytest.raises(ValueError, match="accounts.csv"):
        files.read_transactions(spark, str(tmp_path))


def test_ingest_takes_each_file_once_and_archives(spark, tmp_path):
    src, line = tmp_path / "in", "a;b;c;d;e;f;g\n{};2024-01-02;1;4;PAY;SUCCESS;T1\n"
    src.mkdir()
    run = lambda: ingest_available_now(spark, str(src), str(tmp_path / "sink"), str(tmp_path / "cp"), str(tmp_path / "old"))
    seen = []
    for day in range(1, 5):
        (src / f"transactions_{day:02d}012024.txt").write_text(line.format(day))
        seen.append(sorted(r.trans_id for r in run().collect()))
    assert seen == [["1"], ["1", "2"], ["1", "2", "3"], ["1", "2", "3", "4"]]
    assert list((tmp_path / "old").rglob("transactions_0[12]012024.txt"))


def test_workbooks_are_many_files_read_in_frames(spark, tmp_path):
    df = spark.range(2500).select(F.col("id").cast("string").alias("a"), F.lit(None).cast("string").alias("b"))
    files.write_workbooks(df, f"file://{tmp_path}/w", "terminals_01012024", "a", rows_per_file=500)
    made = sorted(p.name for p in (tmp_path / "w").iterdir())
    assert made == [f"terminals_01012024_{i:06d}.xlsx" for i in range(5)]
    got = files.read_workbooks(spark, f"{tmp_path}/w", df.schema)
    assert rows(got) == rows(df)
    long = xlsx_bytes(["a"], [[str(i)] for i in range(FRAME + 3)])
    (tmp_path / "x").mkdir()
    (tmp_path / "x" / "big.xlsx").write_bytes(long)
    assert files.read_workbooks(spark, f"{tmp_path}/x", df.schema).count() == FRAME + 3


def test_workbook_numbers_and_epochs():
    def book(cell, props=""):
        import io
        import zipfile
        base = zipfile.ZipFile(io.BytesIO(xlsx_bytes(["x"], [])))
        parts = {n: base.read(n).decode() for n in base.namelist()}
        parts["xl/workbook.xml"] = parts["xl/workbook.xml"].replace("<sheets>", props + "<sheets>")
        ns = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
        parts["xl/styles.xml"] = f'<styleSheet xmlns="{ns}"><cellXfs><xf numFmtId="0"/><xf numFmtId="14"/></cellXfs></styleSheet>'
        parts["xl/worksheets/sheet1.xml"] = f'<worksheet xmlns="{ns}"><sheetData><row r="1">{cell}</row></sheetData></worksheet>'
        out = io.BytesIO()
        with zipfile.ZipFile(out, "w") as z:
            for n, t in parts.items():
                z.writestr(n, t)
        return parse_xlsx(out.getvalue())[0][0]
    assert book('<c r="A1"><v>4000000012345678901</v></c>') == "4000000012345678901"
    assert book('<c r="A1"><v>42.0</v></c>') == "42" and book('<c r="A1"><v>1.5</v></c>') == "1.5"
    assert book('<c r="A1" s="1"><v>45296</v></c>') == "2024-01-05 00:00:00"
    assert book('<c r="A1" s="1"><v>45296</v></c>', '<workbookPr date1904="1"/>') == "2028-01-06 00:00:00"


def test_source_options():
    o = read_options("cards", "jdbc:x", "bank.cards", "card_num", ("0", "9"), 8, user="u")
    assert o["dbtable"] == "(SELECT card_num, account, create_dt, update_dt FROM bank.cards) src"
    assert (o["partitionColumn"], o["numPartitions"], o["fetchsize"], o["user"]) == ("card_num", "8", "10000", "u")
    with pytest.raises(ValueError):
        read_options("cards", "jdbc:x", "t", "card_num")
    with pytest.raises(ValueError):
        read_options("terminals", "jdbc:x", "t")


def test_a_cluster_without_a_shared_folder_is_refused(spark, monkeypatch):
    class Context:
        master = "spark://host:7077"
        getCheckpointDir = staticmethod(lambda: None)  # noqa: N815
        getConf = staticmethod(lambda: {})  # noqa: N815

    class Session:
        sparkContext = Context  # noqa: N815
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(Session)


@pytest.fixture(scope="module")
def exports(spark):
    return fx.export_files(spark, SF, scratch(spark, "t-exports"))


def test_uncommitted_attempts_are_not_seen_and_old_runs_are_refused(spark, exports, monkeypatch):
    wh = Warehouse(spark, scratch(spark, "t-wh"))
    days = [fx.day_inputs(spark, SF, exports, v) for v in (0, 1)]

    def crash(*a):
        raise RuntimeError("lost")
    with monkeypatch.context() as m:
        m.setattr(Warehouse, "commit", crash)
        with pytest.raises(RuntimeError):
            pipeline.run_day(wh, days[0], fx.RUN_TS0)
    assert wh.committed_run() is None
    assert wh.read("fact_transactions").count() == wh.read("rep_fraud").count() == wh.read("dim_cards_hist").count() == 0
    first = rows(pipeline.run_day(wh, days[0], fx.RUN_TS0))
    second = rows(pipeline.run_day(wh, days[1], fx.RUN_TS))
    assert rows(pipeline.run_day(wh, days[1], fx.RUN_TS, run=2)) == second  # the last run may be repeated
    with pytest.raises(ValueError, match="cannot be repeated"):
        pipeline.run_day(wh, days[0], fx.RUN_TS0, run=1)
    assert rows(wh.read("rep_fraud")) == sorted(first + second)
    assert wh.read("fact_transactions").count() == fx.fact_transactions(spark, SF).count()
    plan = wh.read("fact_transactions").where(F.col("op_date") >= fx.D1)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(op_date" in plan
    from nightledger.operators.scd2 import tombstone
    st = fx.BankState(spark, SF)
    assert rows(wh.read("dim_cards_hist")) == rows(tombstone(st.hist("cards", 1), st.keys("cards", 1), "cards", fx.RUN_TS))


def test_a_source_that_changes_between_reads_keeps_watermark_and_rows_together(spark, exports):
    wh = Warehouse(spark, scratch(spark, "t-wh"))
    inp = fx.day_inputs(spark, SF, exports, 0)
    clock = F.udf(lambda: __import__("time").time_ns() % 10**9, "long").asNondeterministic()  # another time at each read
    inp.accounts = inp.accounts.withColumn("create_dt", F.timestamp_add("SECOND", clock(), F.lit("2023-12-01").cast("timestamp_ntz")))
    pipeline.run_day(wh, inp, fx.RUN_TS0)
    newest = wh.read("dim_accounts_hist").agg(F.max("effective_from")).first()[0]
    mark = wh.read("meta_loading").where("tablename = 'DIM_ACCOUNTS_HIST'").first().last_update
    assert newest == mark


def test_an_unreadable_control_table_is_not_an_empty_one(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path))
    assert wh.committed_run() is None
    (tmp_path / "_runs").mkdir()
    (tmp_path / "_runs" / "part-0.parquet").write_bytes(b"torn")
    with pytest.raises(Exception):
        wh.committed_run()
