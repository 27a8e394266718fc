import datetime as dt
import io
import os
import zipfile

from pyspark.sql import functions as F

from nightledger.sources import files
from nightledger.sources.workbook import parse_xlsx, xlsx_bytes

NS = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"


def _shared_string_workbook() -> bytes:
    """date | passport, with shared strings and one real date cell (serial 45296 = 2024-01-05)."""
    base = zipfile.ZipFile(io.BytesIO(xlsx_bytes(["x"], [])))
    parts = {n: base.read(n).decode() for n in base.namelist()}
    parts["xl/sharedStrings.xml"] = (
        f'<sst xmlns="{NS}"><si><t>date</t></si><si><t>passport</t></si>'
        '<si><t>2024-01-06</t></si><si><t>1234 567890</t></si></sst>')
    parts["xl/styles.xml"] = (
        f'<styleSheet xmlns="{NS}"><cellXfs count="2"><xf numFmtId="0"/><xf numFmtId="14"/>'
        '</cellXfs></styleSheet>')
    parts["xl/worksheets/sheet1.xml"] = (
        f'<worksheet xmlns="{NS}"><sheetData>'
        '<row r="1"><c r="A1" t="s"><v>0</v></c><c r="B1" t="s"><v>1</v></c></row>'
        '<row r="2"><c r="A2" s="1"><v>45296</v></c><c r="B2" t="s"><v>3</v></c></row>'
        '<row r="3"><c r="A3" t="s"><v>2</v></c><c r="B3" t="inlineStr"><is><t>99 1</t></is></c></row>'
        '<row r="4"><c r="B4"><v>42</v></c></row>'
        '</sheetData></worksheet>')
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as z:
        for n, text in parts.items():
            z.writestr(n, text)
    return buf.getvalue()


def test_parse_xlsx_cells():
    rows = parse_xlsx(_shared_string_workbook())
    assert rows == [["date", "passport"], ["2024-01-05 00:00:00", "1234 567890"],
                    ["2024-01-06", "99 1"], [None, "42"]]


def test_read_workbooks_and_business_date(spark, tmp_path):
    d = tmp_path / "in"
    d.mkdir()
    (d / "passport_blacklist_05012024.xlsx").write_bytes(_shared_string_workbook())
    (d / "terminals_01012024.xlsx").write_bytes(
        xlsx_bytes(["terminal_id", "terminal_type", "terminal_city", "terminal_address"],
                   [["T1", "ATM", "Omsk", "Lenina 1"], ["T2", "POS", "", "Mira 2"]]))
    bl = files.read_blacklist(spark, str(d / "passport_blacklist_*.xlsx")).collect()
    assert [tuple(r) for r in bl] == [("2024-01-05 00:00:00", "1234 567890"),
                                      ("2024-01-06", "99 1"), (None, "42")]
    ter = files.read_terminals(spark, str(d / "terminals_*.xlsx"), with_date=True).collect()
    assert {r.terminal_id: r.terminal_city for r in ter} == {"T1": "Omsk", "T2": None}
    assert {r.business_date for r in ter} == {dt.datetime(2024, 1, 1)}


def test_transactions_positional(spark, tmp_path):
    p = tmp_path / "transactions_02012024.txt"
    # header names differ from ours: binding is by position
    p.write_text("id;date;amount;card;type;result;term\n"
                 "7;2024-01-02 10:00:00;1 234,50;4000 0000 0000 0007 ;PAY;SUCCESS;T1\n")
    df = files.read_transactions(spark, str(tmp_path), with_date=True)
    r = df.first()
    assert (r.trans_id, r.amt, r.card_num, r.terminal) == ("7", "1 234,50", "4000 0000 0000 0007 ", "T1")
    assert r.business_date == dt.datetime(2024, 1, 2)
