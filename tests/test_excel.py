"""Workbooks: cells of all kinds, several sheets and files, and what a writer leaves."""

import datetime
import io
import os
import zipfile

import pytest

from parcelforge.sources import excel

SHARED = "<si><t>na&amp;me</t></si><si><r><t>two </t></r><r><t>runs</t></r><rPh><t>no</t></rPh></si><si><t>n</t></si>"
SHEET = """<row r="1"><c r="B1" t="s"><v>0</v></c><c r="D1" t="s"><v>2</v></c><c r="E1" t="inlineStr"><is><t>when</t></is></c><c r="AA1" t="str"><v>far</v></c></row>
<row r="3"><c r="B3" t="s"><v>1</v></c><c r="D3"><v>12</v></c><c r="E3" s="1"><v>45000.5</v></c><c r="AA3" t="b"><v>1</v></c></row><row r="4"/><row r="5"><c r="D5" t="e"><v>#DIV/0!</v></c><c r="E5" s="2"><v>1.25</v></c></row>"""


def made():
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("xl/workbook.xml", '<workbook xmlns="m" xmlns:r="q"><sheets><sheet name="One" sheetId="4" r:id="a"/><sheet name="Two" sheetId="2" r:id="b"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", '<Relationships><Relationship Id="a" Target="worksheets/x.xml"/><Relationship Id="b" Target="/xl/worksheets/y.xml"/></Relationships>')
        z.writestr("xl/sharedStrings.xml", f'<sst xmlns="m">{SHARED}</sst>')
        z.writestr("xl/styles.xml", '<styleSheet xmlns="m"><numFmts><numFmt numFmtId="170" formatCode="yyyy\\-mm"/><numFmt numFmtId="171" formatCode="0.0 &quot;days&quot;"/></numFmts><cellXfs><xf numFmtId="0"/><xf numFmtId="170"/><xf numFmtId="171"/></cellXfs></styleSheet>')
        z.writestr("xl/worksheets/x.xml", f'<worksheet xmlns="m"><sheetData>{SHEET}</sheetData></worksheet>')
        z.writestr("xl/worksheets/y.xml", '<worksheet xmlns="m"><sheetData><row><c t="str"><v>n</v></c></row><row><c><v>7.5</v></c></row></sheetData></worksheet>')
    return out.getvalue()


def test_cells():
    rows = [r for _, r in excel.sheet_rows(made())]
    assert rows == [{1: "na&me", 3: "n", 4: "when", 26: "far"}, {1: "two runs", 3: 12.0, 4: datetime.datetime(2023, 3, 15, 12), 26: True}, {}, {4: 1.25}]
    assert [r for n, r in excel.sheet_rows(made(), "Two")] == [{0: "n"}, {0: 7.5}] and len(list(excel.sheet_rows(made(), None))) == 6


def test_files_of_a_folder_by_name_of_column(spark, tmp_path):
    for name in ("a.xlsx", "b.xlsx"):
        (tmp_path / name).write_bytes(made())
    (tmp_path / "c.txt").write_text("no workbook")
    found = excel.read_excel(spark, str(tmp_path), "far boolean, n int, `na&me` string, absent date, `when` date")
    assert found.where("n = 12").collect() == [(True, 12, "two runs", None, datetime.date(2023, 3, 15))] * 2 and found.count() == 4
    assert [r["n"] for r in excel.read_excel(spark, str(tmp_path / "a.xlsx"), "n int", sheet="Two").collect()] == [None]
    assert [r["n"] for r in excel.read_excel(spark, str(tmp_path / "a.xlsx"), "n double", sheet=1).collect()] == [7.5]


def test_round_trip_append_and_a_failed_write(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "out")
    rows = [(1, "é中 _x0041_ \x01 <a>\n  b ", 1.5, datetime.date(1999, 12, 31), True), (None, None, None, None, None), (1 << 60, "", -0.25, datetime.date(2024, 2, 29), False)]
    kind = "k long, t string, x double, d date, f boolean"
    df = spark.createDataFrame(rows, kind).coalesce(1)
    excel.write_excel(df, path)
    want = [rows[0], (1 << 60, None, *rows[2][2:])]
    assert sorted(map(tuple, excel.read_excel(spark, path, kind).collect())) == want  # a row of blanks is none
    excel.write_excel(df, path, mode="append")
    assert excel.read_excel(spark, path, kind).count() == 4
    excel.write_excel(df.limit(0), path)
    assert excel.read_excel(spark, path, kind).count() == 0
    excel.write_excel(df, path)
    with pytest.raises(Exception, match=r"(?i)divi"):
        excel.write_excel(df.selectExpr("k", "1 / (k - 1) AS z"), path)
    assert sorted(map(tuple, excel.read_excel(spark, path, kind).collect())) == want and not [f for f in os.listdir(path) if "aside" in f]
    monkeypatch.setattr(excel, "SHEET_ROWS", 3)
    out = io.BytesIO()
    assert excel.workbook(((k,) for k in range(5)), ["k"], out) == 5
    assert [r for _, r in excel.sheet_rows(out.getvalue(), None)] == [{0: "k"}, {0: 0.0}, {0: 1.0}, {0: "k"}, {0: 2.0}, {0: 3.0}, {0: "k"}, {0: 4.0}]


def test_a_task_writes_several_workbooks_and_all_rows_are_read(spark, tmp_path):
    path = str(tmp_path / "out")
    for n, files in ((8, 3), (6, 2), (0, 1)):
        excel.write_excel(spark.range(n).coalesce(1), path, book_rows=3)
        assert len(os.listdir(path)) == files and sorted(r["id"] for r in excel.read_excel(spark, path, "id long").collect()) == list(range(n))
