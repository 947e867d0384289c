"""Workbooks (.xlsx) as frames: sheets are read as streams of XML out of the zip, and written one file a partition.

Files are read by Spark's binary source, so any file system will do; of a sheet only the columns that are asked for are
kept. Files are written through ``pyarrow.fs``: each task writes beside the target, a further file for each ``BOOK_ROWS``, so
that reading is dealt over tasks, and the files get their places when all are whole.
"""

from __future__ import annotations

import io
import posixpath
import re
import uuid
import zipfile
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from datetime import UTC, date, datetime, timedelta
from decimal import Decimal, InvalidOperation
from itertools import chain, islice
from xml.etree.ElementTree import iterparse
from xml.sax.saxutils import escape

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage
from pyspark.sql.pandas.types import to_arrow_schema

# The day that workbooks count from, the numbers of built-in formats that are dates, rows of a sheet and of a
# file that a task writes.
EPOCH = datetime(1899, 12, 30)
DATE_FORMATS = {*range(14, 23), *range(45, 48)}
SHEET_ROWS = 1 << 20
BOOK_ROWS = 100_000
BATCH = 10_000


def _local(tag: str) -> str:
    return tag.rpartition("}")[2]


def _elements(stream, name: str) -> Iterator:
    """The elements of one name, one at a time; what has been passed is forgotten."""
    path = []
    for event, e in iterparse(stream, ("start", "end")):
        if event == "start":
            path.append(e)
            continue
        path.pop()
        if _local(e.tag) == name:
            yield e
            e.clear()
            if path:
                path[-1].remove(e)


def _texts(e) -> str:
    """The text of a string with all its runs, but for phonetic hints."""
    out = []
    for x in e:
        if _local(x.tag) == "t":
            out.append(x.text or "")
        elif _local(x.tag) == "r":
            out.append(_texts(x))
    return re.sub(r"_x([0-9A-Fa-f]{4})_", lambda m: chr(int(m[1], 16)), "".join(out))


def _sheets(book: zipfile.ZipFile) -> list[tuple[str, str]]:
    """Names of sheets and of their files, in order."""
    with book.open("xl/_rels/workbook.xml.rels") as f:
        targets = {e.get("Id"): e.get("Target") for e in _elements(f, "Relationship")}
    with book.open("xl/workbook.xml") as f:
        named = [(e.get("name"), next(v for k, v in e.attrib.items() if _local(k) == "id")) for e in _elements(f, "sheet")]
    return [(name, posixpath.normpath(posixpath.join("xl", targets[i])) if not targets[i].startswith("/") else targets[i][1:]) for name, i in named]


def _date_styles(book: zipfile.ZipFile) -> set[int]:
    """The cell styles whose format is a date or a time."""
    if "xl/styles.xml" not in book.namelist():
        return set()
    own, styles = set(DATE_FORMATS), []
    with book.open("xl/styles.xml") as f:
        for e in _elements(f, "numFmt"):
            if re.search(r"[ymdhs]", re.sub(r'"[^"]*"|\\.|\[[^\]]*\]', "", e.get("formatCode", "")), re.IGNORECASE):
                own.add(int(e.get("numFmtId")))
    with book.open("xl/styles.xml") as f:
        for e in _elements(f, "cellXfs"):
            styles = [int(x.get("numFmtId", 0)) for x in e]
    return {k for k, n in enumerate(styles) if n in own}


def _column(reference: str) -> int:
    n = 0
    for ch in reference:
        if not ch.isalpha():
            break
        n = n * 26 + ord(ch.upper()) - 64
    return n - 1


def sheet_rows(content: bytes, sheet: int | str | None = 0) -> Iterator[tuple[str, dict[int, object]]]:
    """For each row of the sheet (by number or name, of all sheets for null) the sheet's name and the values by column;
    blank cells are absent. Values are text, float, bool or, by the cell's format, datetime."""
    with zipfile.ZipFile(io.BytesIO(content)) as book:
        sheets, dates, shared = _sheets(book), _date_styles(book), []
        if "xl/sharedStrings.xml" in book.namelist():
            with book.open("xl/sharedStrings.xml") as f:
                shared = [_texts(e) for e in _elements(f, "si")]
        for k, (name, file) in enumerate(sheets):
            if sheet is not None and sheet not in (k, name):
                continue
            with book.open(file) as f:
                for row in _elements(f, "row"):
                    out, at = {}, -1
                    for c in row:
                        at = _column(c.get("r")) if c.get("r") else at + 1
                        kind, parts = c.get("t", "n"), {_local(x.tag): x for x in c}
                        if kind == "inlineStr":
                            value = _texts(parts["is"]) if "is" in parts else None
                        else:
                            text = parts["v"].text if "v" in parts else None
                            value = None if text is None or kind == "e" else shared[int(text)] if kind == "s" else text == "1" if kind == "b" else text if kind in ("str", "d") else float(text)
                            if isinstance(value, float) and int(c.get("s", 0)) in dates:
                                value = EPOCH + timedelta(milliseconds=round(value * 86_400_000))
                        if value not in (None, ""):
                            out[at] = value
                    yield name, out


def _typed(value, kind: T.DataType):
    """A cell's value as a column's type has it; null where it can't be."""
    if value is None:
        return None
    try:
        if isinstance(kind, T.StringType):
            return value if isinstance(value, str) else value.isoformat(" ") if isinstance(value, datetime) else str(int(value)) if isinstance(value, float) and value.is_integer() else str(value)
        if isinstance(kind, T.IntegralType):
            whole = Decimal(str(value).strip()) if not isinstance(value, bool) else Decimal(int(value))
            return int(whole) if whole == whole.to_integral_value() else None
        if isinstance(kind, T.FractionalType):
            return Decimal(str(value)) if isinstance(kind, T.DecimalType) else float(value)
        if isinstance(kind, T.BooleanType):
            return value if isinstance(value, bool) else {"true": True, "1": True, "1.0": True, "false": False, "0": False, "0.0": False}.get(str(value).strip().lower())
        if isinstance(kind, T.DateType | T.TimestampType | T.TimestampNTZType):
            moment = value if isinstance(value, datetime) else datetime.fromisoformat(str(value).strip())
            return moment.date() if isinstance(kind, T.DateType) else moment.replace(tzinfo=UTC) if isinstance(kind, T.TimestampType) else moment
    except (ValueError, TypeError, InvalidOperation, OverflowError):
        return None
    raise TypeError(f"no cells of type {kind.simpleString()}")


def read_excel(spark: SparkSession, path: str, schema: T.StructType | str, sheet: int | str | None = 0) -> DataFrame:
    """Rows of the workbooks at ``path`` (a file, folder or pattern). A sheet's first row names its columns; those of ``schema``
    are taken by name, null where a sheet lacks them, the others are passed over. Cells that aren't of their column's type are
    null; rows without any cell are left out. Each file is read by one task."""
    kinds = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    arrow = to_arrow_schema(kinds)

    def told(rows: list[list]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], f.type) for k, f in enumerate(arrow)], schema=arrow)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content").to_pylist():
                now, places, rows = None, [], []
                for name, cells in sheet_rows(content, sheet):
                    if name != now:
                        by_name = {str(v): k for k, v in reversed(cells.items())}
                        now, places = name, [(by_name.get(f.name, -1), f.dataType) for f in kinds]
                    elif cells:
                        rows.append([_typed(cells.get(k), kind) for k, kind in places])
                    if len(rows) == BATCH:
                        yield told(rows)
                        rows = []
                yield told(rows)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.xlsx").option("recursiveFileLookup", True).load(path)
    return files.select("content").repartition(max(1, files.select("path").count()), F.col("content")).mapInArrow(run, kinds)


_HEAD = '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>\n'
_MAIN = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
_RELS = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
_PACKAGE = "http://schemas.openxmlformats.org/package/2006"
_KIND = "application/vnd.openxmlformats-officedocument.spreadsheetml"


def _cell(value) -> str:
    if value is None or value == "":
        return "<c/>"
    if isinstance(value, bool):
        return f'<c t="b"><v>{int(value)}</v></c>'
    if isinstance(value, datetime):
        return f'<c s="2"><v>{(value.replace(tzinfo=None) - EPOCH) / timedelta(days=1)!r}</v></c>'
    if isinstance(value, date):
        return f'<c s="1"><v>{(value - EPOCH.date()).days}</v></c>'
    if isinstance(value, float | Decimal) or isinstance(value, int) and abs(value) < 1 << 53:
        return f"<c><v>{value}</v></c>" if value == value and abs(value) != float("inf") else "<c/>"
    # What XML can't hold, and what looks like its escape, is escaped.
    text = re.sub("[\x00-\x08\x0b-\x0d\x0e-\x1f\ufffe\uffff]|_(?=x[0-9A-Fa-f]{4}_)", lambda m: f"_x{ord(m[0]):04X}_", str(value))
    return f'<c t="inlineStr"><is><t xml:space="preserve">{escape(text)}</t></is></c>'


def workbook(rows: Iterable[tuple], names: list[str], out) -> int:
    """Write rows into a workbook, a further sheet for each ``SHEET_ROWS``; the number of rows."""
    n, sheets, rows = 0, 0, iter(rows)
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as book:
        row = next(rows, None)
        while row is not None or not sheets:
            sheets += 1
            with book.open(f"xl/worksheets/sheet{sheets}.xml", "w", force_zip64=True) as f:
                f.write(f'{_HEAD}<worksheet xmlns="{_MAIN}"><sheetData><row>{"".join(map(_cell, names))}</row>'.encode())
                for _ in range(SHEET_ROWS - 1):
                    if row is None:
                        break
                    f.write(f"<row>{''.join(map(_cell, row))}</row>".encode())
                    n, row = n + 1, next(rows, None)
                f.write(b"</sheetData></worksheet>")
        each = range(1, sheets + 1)
        book.writestr("xl/workbook.xml", f'{_HEAD}<workbook xmlns="{_MAIN}" xmlns:r="{_RELS}"><sheets>{"".join(f"""<sheet name="Sheet{k}" sheetId="{k}" r:id="r{k}"/>""" for k in each)}</sheets></workbook>')
        links = "".join(f'<Relationship Id="r{k}" Type="{_RELS}/worksheet" Target="worksheets/sheet{k}.xml"/>' for k in each) + f'<Relationship Id="s" Type="{_RELS}/styles" Target="styles.xml"/>'
        book.writestr("xl/_rels/workbook.xml.rels", f'{_HEAD}<Relationships xmlns="{_PACKAGE}/relationships">{links}</Relationships>')
        book.writestr("_rels/.rels", f'{_HEAD}<Relationships xmlns="{_PACKAGE}/relationships"><Relationship Id="b" Type="{_RELS}/officeDocument" Target="xl/workbook.xml"/></Relationships>')
        one = '<fonts count="1"><font/></fonts><fills count="2"><fill/><fill/></fills><borders count="1"><border/></borders><cellStyleXfs count="1"><xf/></cellStyleXfs>'
        book.writestr("xl/styles.xml", f'{_HEAD}<styleSheet xmlns="{_MAIN}">{one}<cellXfs count="3"><xf/><xf numFmtId="14" applyNumberFormat="1"/><xf numFmtId="22" applyNumberFormat="1"/></cellXfs></styleSheet>')
        kinds = [("/xl/workbook.xml", "sheet.main"), ("/xl/styles.xml", "styles"), *((f"/xl/worksheets/sheet{k}.xml", "worksheet") for k in each)]
        book.writestr("[Content_Types].xml", f'{_HEAD}<Types xmlns="{_PACKAGE}/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Default Extension="xml" ContentType="application/xml"/>{"".join(f"""<Override PartName="{p}" ContentType="{_KIND}.{k}+xml"/>""" for p, k in kinds)}</Types>')
    return n


@dataclass
class _Written(WriterCommitMessage):
    files: list[str]


class _Writer(DataSourceArrowWriter):
    """Each task writes its workbooks under ``.aside-...``; the files move to the folder when all are whole."""

    def __init__(self, path: str, names: list[str], overwrite: bool, book_rows: int):
        self.path, self.names, self.overwrite, self.book_rows, self.aside = path, names, overwrite, book_rows, f".aside-{uuid.uuid4().hex}"

    def _folder(self):
        from pyarrow.fs import FileSystem

        return FileSystem.from_uri(self.path if "://" in self.path or self.path.startswith("file:") else f"file://{self.path}")

    def write(self, iterator: Iterator[pa.RecordBatch]) -> _Written:
        from pyspark import TaskContext

        fs, folder = self._folder()
        fs.create_dir(f"{folder}/{self.aside}", recursive=True)
        task = TaskContext.get()
        rows = (r for batch in iterator for r in zip(*(c.to_pylist() for c in batch.columns), strict=True))
        files: list[str] = []
        row = next(rows, None)
        while row is not None or not files:
            files.append(f"part-{task.partitionId():05d}-{task.taskAttemptId()}-{len(files)}.xlsx")
            own = chain([] if row is None else [row], islice(rows, self.book_rows - 1))
            with fs.open_output_stream(f"{folder}/{self.aside}/{files[-1]}") as out:
                workbook(own, self.names, out)
            row = next(rows, None)
        return _Written(files)

    def commit(self, messages: list[_Written]) -> None:
        from pyarrow.fs import FileSelector

        fs, folder = self._folder()
        fs.create_dir(folder, recursive=True)
        old = [f.path for f in fs.get_file_info(FileSelector(folder)) if f.base_name.endswith(".xlsx")] if self.overwrite else []
        for m in messages:
            for file in m.files if m is not None else []:
                fs.move(f"{folder}/{self.aside}/{file}", f"{folder}/{uuid.uuid4().hex[:8]}-{file}")
        for path in old:
            fs.delete_file(path)
        self.abort(messages)

    def abort(self, messages: list[_Written]) -> None:
        from pyarrow.fs import FileType

        fs, folder = self._folder()
        if fs.get_file_info(f"{folder}/{self.aside}").type != FileType.NotFound:
            fs.delete_dir(f"{folder}/{self.aside}")


class ExcelSink(DataSource):
    @classmethod
    def name(cls) -> str:
        return "workbooks"

    def writer(self, schema: T.StructType, overwrite: bool) -> _Writer:
        return _Writer(self.options["path"], schema.names, overwrite, int(self.options["bookRows"]))


def write_excel(df: DataFrame, path: str, mode: str = "overwrite", book_rows: int = BOOK_ROWS) -> None:
    """A folder of workbooks, one for each ``book_rows`` of a partition, with a row of names each (of more than ``SHEET_ROWS``
    in several sheets, to be read with ``sheet=None``); ``mode`` is overwrite or append. Null, empty and non-finite values
    are blank; integers beyond 53 bits are text; moments are kept to the millisecond, in UTC."""
    df.sparkSession.dataSource.register(ExcelSink)
    df.write.format("workbooks").mode(mode).option("path", path).option("bookRows", book_rows).save()
