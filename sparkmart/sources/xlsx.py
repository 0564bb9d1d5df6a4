"""Spreadsheet scan (S3): first sheet, first row as header.

Workbooks are read as ``binaryFile`` rows and parsed inside executors with
``mapInPandas`` — one task per file, so many workbooks load in parallel and
none passes through the driver.  A workbook is a zip of XML parts, so the
standard library parses it (shared strings, inline strings, numbers,
booleans, and dates recognised by their number format).
"""

from __future__ import annotations

import io
import re
import zipfile
from datetime import datetime, timedelta
from xml.etree import ElementTree as ET

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

NS = {
    "m": "http://schemas.openxmlformats.org/spreadsheetml/2006/main",
    "r": "http://schemas.openxmlformats.org/officeDocument/2006/relationships",
    "pr": "http://schemas.openxmlformats.org/package/2006/relationships",
}
# Built-in number formats that denote dates/times in the
# spreadsheet file format.
BUILTIN_DATE_FORMATS = {14, 15, 16, 17, 18, 19, 20, 21, 22, 45, 46, 47}
EXCEL_EPOCH = datetime(1899, 12, 30)


def _col_index(ref: str) -> int:
    letters = re.match(r"[A-Z]+", ref).group(0)
    n = 0
    for ch in letters:
        n = n * 26 + (ord(ch) - 64)
    return n - 1


def _text(el) -> str:
    return "".join(t.text or "" for t in el.iter(f"{{{NS['m']}}}t"))


def _date_styles(z: zipfile.ZipFile) -> set[int]:
    if "xl/styles.xml" not in z.namelist():
        return set()
    root = ET.fromstring(z.read("xl/styles.xml"))
    custom = {}
    for nf in root.iterfind("m:numFmts/m:numFmt", NS):
        code = re.sub(r'"[^"]*"|\[[^\]]*\]', "", nf.get("formatCode", "")).lower()
        custom[int(nf.get("numFmtId"))] = bool(re.search(r"[dyhs]|m{1,5}", code))
    out = set()
    for i, xf in enumerate(root.iterfind("m:cellXfs/m:xf", NS)):
        fid = int(xf.get("numFmtId", "0"))
        if fid in BUILTIN_DATE_FORMATS or custom.get(fid, False):
            out.add(i)
    return out


def _first_sheet_path(z: zipfile.ZipFile) -> str:
    wb = ET.fromstring(z.read("xl/workbook.xml"))
    sheet = wb.find("m:sheets/m:sheet", NS)
    rid = sheet.get(f"{{{NS['r']}}}id")
    rels = ET.fromstring(z.read("xl/_rels/workbook.xml.rels"))
    for rel in rels.iterfind("pr:Relationship", NS):
        if rel.get("Id") == rid:
            target = rel.get("Target").lstrip("/")
            return target if target.startswith("xl/") else f"xl/{target}"
    raise ValueError("workbook has no first sheet")


def parse_first_sheet(content: bytes) -> list[list[object]]:
    """Rows of the first sheet as Python values (None for empty cells)."""
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        shared = []
        if "xl/sharedStrings.xml" in z.namelist():
            sst = ET.fromstring(z.read("xl/sharedStrings.xml"))
            shared = [_text(si) for si in sst.iterfind("m:si", NS)]
        dates = _date_styles(z)
        sheet = ET.fromstring(z.read(_first_sheet_path(z)))
    rows: list[list[object]] = []
    for row in sheet.iterfind("m:sheetData/m:row", NS):
        cells: dict[int, object] = {}
        for c in row.iterfind("m:c", NS):
            idx = _col_index(c.get("r")) if c.get("r") else len(cells)
            t, s = c.get("t", "n"), int(c.get("s", "0"))
            v = c.find("m:v", NS)
            if t == "inlineStr":
                val: object = _text(c.find("m:is", NS))
            elif v is None:
                val = None
            elif t == "s":
                val = shared[int(v.text)]
            elif t == "b":
                val = v.text == "1"
            elif t in ("str", "e"):
                val = v.text
            else:
                num = float(v.text)
                if s in dates:
                    val = EXCEL_EPOCH + timedelta(days=num)
                else:
                    val = int(num) if num.is_integer() else num
            cells[idx] = val
        width = max(cells) + 1 if cells else 0
        rows.append([cells.get(i) for i in range(width)])
    return rows


def _to_frame(rows: list[list[object]], schema: T.StructType) -> pd.DataFrame:
    """Columns by the workbook's own header; one that ``schema`` lacks is an
    error, one that the workbook lacks is NULL."""
    names = [f.name for f in schema.fields]
    header = [str(h).strip() for h in rows[0]] if rows else []
    unknown = [h for h in header if h not in names]
    if unknown:
        raise ValueError(f"workbook columns {unknown} are not among {names}")
    place = {h: i for i, h in enumerate(header)}
    body = [
        [r[place[n]] if n in place and place[n] < len(r) else None for n in names]
        for r in rows[1:]
    ]
    pdf = pd.DataFrame(body, columns=names, dtype=object)
    for f in schema.fields:
        if isinstance(f.dataType, T.StringType):
            pdf[f.name] = pdf[f.name].map(lambda x: None if x is None else str(x))
        elif isinstance(f.dataType, (T.IntegerType, T.LongType)):
            pdf[f.name] = pd.to_numeric(pdf[f.name], errors="coerce").astype("Int64")
        elif isinstance(f.dataType, T.DoubleType):
            pdf[f.name] = pd.to_numeric(pdf[f.name], errors="coerce").astype("float64")
        elif isinstance(f.dataType, T.DateType):
            pdf[f.name] = pd.to_datetime(pdf[f.name], errors="coerce").dt.date
        elif isinstance(f.dataType, T.TimestampType):
            pdf[f.name] = pd.to_datetime(pdf[f.name], errors="coerce")
    return pdf


def header_of(spark: SparkSession, path: str) -> list[str]:
    """Header row of one workbook (reads a single file's bytes)."""
    first = spark.read.format("binaryFile").load(path).select("content").limit(1).first()
    if first is None:
        raise FileNotFoundError(path)
    rows = parse_first_sheet(bytes(first["content"]))
    if not rows:
        raise ValueError(f"{path}: the first sheet is empty")
    return [str(h).strip() for h in rows[0]]


def read_xlsx(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Read every workbook matched by ``path`` (file, folder or glob).

    Without ``schema`` every column is text, named from the first file's
    header.  With it, values are coerced per column (unparseable → NULL).
    """
    if schema is None:
        schema = T.StructType([T.StructField(h, T.StringType()) for h in header_of(spark, path)])
    out_schema = schema

    def parse(batches):
        for pdf in batches:
            for content in pdf["content"]:
                yield _to_frame(parse_first_sheet(bytes(content)), out_schema)

    files = spark.read.format("binaryFile").load(path).select("content")
    return files.mapInPandas(parse, out_schema)
