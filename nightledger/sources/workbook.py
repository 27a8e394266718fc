"""Workbook (.xlsx) files as a Spark source.

A workbook is a zip archive that cannot be split, so each file is one task:
``binaryFile`` lists and loads the files, ``mapInPandas`` parses them with the
standard library (zip + XML) and emits the first sheet's rows as text,
bound to the target columns by position like the source loader does. The
sheet is parsed as a stream and handed on in frames of FRAME rows, so a task
holds the zipped file, the shared strings and one frame.
"""

from __future__ import annotations

import datetime as _dt
import io
import itertools
import re
import zipfile
from xml.etree import ElementTree as ET

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_NS = {"m": "http://schemas.openxmlformats.org/spreadsheetml/2006/main",
       "r": "http://schemas.openxmlformats.org/officeDocument/2006/relationships"}
_REL = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"
# built-in number formats that display a date or time (ECMA-376, 18.8.30)
_DATE_FMT_IDS = set(range(14, 23)) | set(range(45, 48))
_EPOCH_1900, _EPOCH_1904 = _dt.datetime(1899, 12, 30), _dt.datetime(1904, 1, 1)
FRAME = 5000
_M = "{" + _NS["m"] + "}"


def _col_index(ref: str) -> int:
    letters = re.match(r"[A-Z]+", ref).group(0)
    n = 0
    for ch in letters:
        n = n * 26 + (ord(ch) - 64)
    return n - 1


def _text(node) -> str:
    return "".join(t.text or "" for t in node.iter(f"{{{_NS['m']}}}t"))


def _date_styles(z: zipfile.ZipFile) -> set[int]:
    if "xl/styles.xml" not in z.namelist():
        return set()
    root = ET.fromstring(z.read("xl/styles.xml"))
    custom = {int(f.get("numFmtId")): f.get("formatCode", "")
              for f in root.iterfind("m:numFmts/m:numFmt", _NS)}
    out = set()
    for i, xf in enumerate(root.iterfind("m:cellXfs/m:xf", _NS)):
        fid = int(xf.get("numFmtId", "0"))
        code = re.sub(r'"[^"]*"|\[[^\]]*\]', "", custom.get(fid, "")).lower()
        if fid in _DATE_FMT_IDS or (fid in custom and re.search(r"[dy]|mm?:|h", code)):
            out.add(i)
    return out


def _first_sheet(z: zipfile.ZipFile) -> str:
    wb = ET.fromstring(z.read("xl/workbook.xml"))
    sheet = wb.find("m:sheets/m:sheet", _NS)
    rid = sheet.get(_REL)
    rels = ET.fromstring(z.read("xl/_rels/workbook.xml.rels"))
    for rel in rels:
        if rel.get("Id") == rid:
            target = rel.get("Target").lstrip("/")
            return target if target.startswith("xl/") else f"xl/{target}"
    return "xl/worksheets/sheet1.xml"


def _number_text(v: str, is_date: bool, epoch: _dt.datetime = _EPOCH_1900) -> str:
    if is_date:
        ts = epoch + _dt.timedelta(seconds=round(float(v) * 86_400))
        return ts.strftime("%Y-%m-%d %H:%M:%S")
    if re.fullmatch(r"-?[0-9]+", v):
        return v  # long ids keep all their digits
    x = float(v)
    return str(int(x)) if x.is_integer() and abs(x) < 2**53 else v


def _epoch(z: zipfile.ZipFile) -> _dt.datetime:
    props = ET.fromstring(z.read("xl/workbook.xml")).find("m:workbookPr", _NS)
    return _EPOCH_1904 if props is not None and props.get("date1904") in ("1", "true") else _EPOCH_1900


def _each(stream, tag: str):
    """Elements of a tag as the stream closes them; what is done with is dropped."""
    root = None
    for event, node in ET.iterparse(stream, events=("start", "end")):
        if root is None:
            root = node
        if event == "end" and node.tag == _M + tag:
            yield node
            node.clear()
            root.clear() if root.tag == _M + "sst" else None


def iter_rows(data: bytes):
    """The rows of the first sheet as lists of text, missing cells None, one at a time."""
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        shared: list[str] = []
        if "xl/sharedStrings.xml" in z.namelist():
            with z.open("xl/sharedStrings.xml") as f:
                shared = [_text(si) for si in _each(f, "si")]
        dates, epoch = _date_styles(z), _epoch(z)
        with z.open(_first_sheet(z)) as f:
            for row in _each(f, "row"):
                yield _cells(row, shared, dates, epoch)


def _cells(row, shared: list[str], dates: set[int], epoch: _dt.datetime) -> list[str | None]:
    vals: dict[int, str | None] = {}
    for j, c in enumerate(row.iterfind("m:c", _NS)):
        idx = _col_index(c.get("r")) if c.get("r") else j
        kind, v = c.get("t", "n"), c.find("m:v", _NS)
        if kind == "inlineStr":
            vals[idx] = _text(c.find("m:is", _NS))
        elif v is None or v.text is None:
            vals[idx] = None
        elif kind == "s":
            vals[idx] = shared[int(v.text)]
        elif kind in ("str", "e"):
            vals[idx] = v.text
        elif kind == "b":
            vals[idx] = "True" if v.text == "1" else "False"
        else:
            vals[idx] = _number_text(v.text, int(c.get("s", "0")) in dates, epoch)
    return [vals.get(i) for i in range(max(vals) + 1 if vals else 0)]


def parse_xlsx(data: bytes) -> list[list[str | None]]:
    """All rows of the first sheet."""
    return list(iter_rows(data))


def read_workbooks(spark: SparkSession, path: str, schema: T.StructType,
                   with_path: bool = False) -> DataFrame:
    """Rows of every workbook under ``path`` (glob), header skipped, bound by position."""
    names = [f.name for f in schema.fields]
    out_schema = T.StructType(list(schema.fields)
                              + ([T.StructField("source_file", T.StringType())] if with_path else []))

    def parse(batches):
        for pdf in batches:
            for p, content in zip(pdf["path"], pdf["content"]):
                body = itertools.islice(iter_rows(bytes(content)), 1, None)
                full = ((r + [None] * len(names))[:len(names)] for r in body
                        if any(v not in (None, "") for v in r))
                while rows := list(itertools.islice(full, FRAME)):
                    frame = pd.DataFrame(rows, columns=names, dtype=object)
                    if with_path:
                        frame["source_file"] = p
                    yield frame

    from nightledger.session import ship_package
    ship_package(spark)
    files = spark.read.format("binaryFile").load(path).select("path", "content")
    df = files.mapInPandas(parse, out_schema)
    # the source database stores '' as NULL
    return df.select(*[F.when(F.col(n) == "", F.lit(None).cast("string")).otherwise(F.col(n)).alias(n)
                       if n in names else F.col(n) for n in df.columns])


def xlsx_bytes(header: list[str], rows: list[list[str | None]]) -> bytes:
    """A minimal one-sheet workbook with inline strings (used to build test inputs)."""
    from xml.sax.saxutils import escape

    def cell(r: int, c: int, v) -> str:
        ref = ""
        n = c + 1
        while n:
            n, rem = divmod(n - 1, 26)
            ref = chr(65 + rem) + ref
        if v is None:
            return ""
        return f'<c r="{ref}{r}" t="inlineStr"><is><t>{escape(str(v))}</t></is></c>'

    body = "".join(
        f'<row r="{i + 1}">' + "".join(cell(i + 1, j, v) for j, v in enumerate(r)) + "</row>"
        for i, r in enumerate([header] + rows))
    ns = _NS["m"]
    files = {
        "[Content_Types].xml":
            '<?xml version="1.0" encoding="UTF-8"?><Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types">'
            '<Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/>'
            '<Default Extension="xml" ContentType="application/xml"/>'
            '<Override PartName="/xl/workbook.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.sheet.main+xml"/>'
            '<Override PartName="/xl/worksheets/sheet1.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.worksheet+xml"/>'
            '</Types>',
        "_rels/.rels":
            '<?xml version="1.0" encoding="UTF-8"?><Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">'
            '<Relationship Id="rId1" Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/officeDocument" Target="xl/workbook.xml"/>'
            '</Relationships>',
        "xl/workbook.xml":
            f'<?xml version="1.0" encoding="UTF-8"?><workbook xmlns="{ns}" xmlns:r="{_NS["r"]}">'
            '<sheets><sheet name="Sheet1" sheetId="1" r:id="rId1"/></sheets></workbook>',
        "xl/_rels/workbook.xml.rels":
            '<?xml version="1.0" encoding="UTF-8"?><Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">'
            '<Relationship Id="rId1" Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/worksheet" Target="worksheets/sheet1.xml"/>'
            '</Relationships>',
        "xl/worksheets/sheet1.xml":
            f'<?xml version="1.0" encoding="UTF-8"?><worksheet xmlns="{ns}"><sheetData>{body}</sheetData></worksheet>',
    }
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as z:
        for name, text in files.items():
            z.writestr(name, text)
    return buf.getvalue()
