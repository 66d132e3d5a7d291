"""Workbooks (.xlsx): zipped XML, a file a row of Spark's binaryFile source, read cell by cell within tasks."""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterable, Iterator, Mapping, Sequence
from xml.etree import ElementTree as E
from xml.sax.saxutils import escape

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .readers import InvalidData, MissingFile

CELLS = "path string, sheet string, row int, column int, number double, text string"
# The namespaces of the file format.
MAIN = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
RELATIONS = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
PACKAGE = "http://schemas.openxmlformats.org/package/2006/relationships"
TYPES = "http://schemas.openxmlformats.org/package/2006/content-types"
#: Cells that are sent back at a time.
BATCH = 20_000


def elements(book: zipfile.ZipFile, name: str, tag: str) -> Iterator[E.Element]:
    """The elements of a tag of one part of the file, each emptied once it is used, so a sheet is never held whole."""
    with book.open(name) as part:
        events = E.iterparse(part, events=("start", "end"))
        _, root = next(events)
        parents = [root]
        for event, element in events:
            if event == "start":
                parents.append(element)
                continue
            parents.pop()
            if element.tag == f"{{{MAIN}}}{tag}":
                yield element
                element.clear()
                parents[-1].remove(element)


def plain(element: E.Element) -> str:
    """The text of a string: its own t, or those of its runs; phonetic guides are left out."""
    return "".join(t.text or "" for t in [*element.findall(f"{{{MAIN}}}t"), *element.findall(f"{{{MAIN}}}r/{{{MAIN}}}t")])


def column_of(letters: str) -> int:
    """0 for A, 26 for AA."""
    n = 0
    for c in letters:
        n = n * 26 + ord(c) - 64
    return n - 1


def cells_of(content: bytes) -> Iterator[tuple]:
    """(sheet, row, column, number, text) of each cell with a value, row and column from 0."""
    with zipfile.ZipFile(io.BytesIO(content)) as book:
        strings = [plain(s) for s in elements(book, "xl/sharedStrings.xml", "si")] if "xl/sharedStrings.xml" in book.namelist() else []
        targets = {r.get("Id"): r.get("Target") for r in E.fromstring(book.read("xl/_rels/workbook.xml.rels"))}
        for sheet in E.fromstring(book.read("xl/workbook.xml")).iter(f"{{{MAIN}}}sheet"):
            target = targets[sheet.get(f"{{{RELATIONS}}}id")]
            row = -1
            for line in elements(book, target.lstrip("/") if target.startswith("/") else f"xl/{target}", "row"):
                row = int(line.get("r")) - 1 if line.get("r") else row + 1
                column = -1
                for cell in line.findall(f"{{{MAIN}}}c"):
                    column = column_of(re.match("[A-Z]+", cell.get("r"))[0]) if cell.get("r") else column + 1
                    kind, value = cell.get("t", "n"), cell.findtext(f"{{{MAIN}}}v")
                    if kind == "inlineStr":
                        inner = cell.find(f"{{{MAIN}}}is")
                        yield sheet.get("name"), row, column, None, "" if inner is None else plain(inner)
                    elif value is None or kind == "e" or (kind in ("n", "b") and not value.strip()):
                        continue
                    elif kind in ("n", "b"):
                        yield sheet.get("name"), row, column, float(value), None
                    else:
                        yield sheet.get("name"), row, column, None, strings[int(value)] if kind == "s" else value


def cells(files: DataFrame) -> DataFrame:
    """(path, sheet, row, column, number, text) of all cells with a value in files, a table with path and content.

    Blank cells and those that hold an error are left out; truth values are the numbers 0 and 1, dates the numbers that the
    file has. A null content has no cells; one that is no workbook raises InvalidData within the job. A task holds the bytes
    and the shared strings of a workbook, but no sheet; a workbook isn't split, as its zipped parts can only be read from
    the start.
    """
    names = [c.split(" ")[0] for c in CELLS.split(", ")]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = dict(zip(names, (pa.string(), pa.string(), pa.int32(), pa.int32(), pa.float64(), pa.string()), strict=True))
        held: list[tuple] = []
        batch = lambda: pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held, strict=True), types.values(), strict=True)], names=names)
        for files_read in batches:
            for path, content in zip(files_read["path"], files_read["content"], strict=True):
                if not content.is_valid:
                    continue
                try:
                    for cell in cells_of(content.as_py()):
                        held.append((path.as_py(), *cell))
                        if len(held) == BATCH:
                            yield batch()
                            held.clear()
                except (zipfile.BadZipFile, KeyError, E.ParseError, ValueError, IndexError) as error:
                    raise InvalidData(f"{path.as_py()} is no workbook that can be read: {error!r}") from error
        if held:
            yield batch()

    return files.select("path", "content").mapInArrow(read, CELLS)


def read_workbooks(spark: SparkSession, path: str) -> DataFrame:
    """cells() of the workbooks at a path, folder or pattern; MissingFile where there is nothing."""
    try:
        return cells(spark.read.format("binaryFile").load(path))
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise MissingFile(path) from error
        raise


def numbers(found: DataFrame) -> DataFrame:
    """All numbers of cells() as one column value, those written as text too; InvalidData where a text is none."""
    values = found.select("text", F.coalesce("number", F.expr("try_cast(trim(text) AS double)")).alias("value"))
    bad = values.where("value IS NULL AND trim(text) <> ''").select("text").head(1)
    if bad:
        raise InvalidData(f"not a number: {bad[0][0]!r}")
    return values.where("value IS NOT NULL").select("value")


def table(found: DataFrame, names: Mapping[str, str], header: bool = True) -> DataFrame:
    """(path, sheet, row, names): a row for each line of cells(); names gives columns, from the first on, their types. With header the first line of a sheet is left out."""
    value = lambda k, kind: F.max(F.when(F.col("column") == k, F.col("text") if kind == "string" else F.col("number"))).cast(kind)
    lines = found.where("row > 0") if header else found
    return lines.groupBy("path", "sheet", "row").agg(*[value(k, kind).alias(n) for k, (n, kind) in enumerate(names.items())])


def workbook(sheets: Mapping[str, Iterable[Sequence]]) -> bytes:
    """A workbook with the given lines in each sheet, texts as shared strings; None is a blank."""
    strings: dict[str, int] = {}
    letters = lambda k: (letters(k // 26 - 1) if k >= 26 else "") + chr(65 + k % 26)

    def cell(at: str, x) -> str:
        if isinstance(x, bool):
            return f'<c r="{at}" t="b"><v>{int(x)}</v></c>'
        if isinstance(x, str):
            return f'<c r="{at}" t="s"><v>{strings.setdefault(x, len(strings))}</v></c>'
        return f'<c r="{at}"><v>{x!r}</v></c>'

    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as book:
        for n, lines in enumerate(sheets.values(), 1):
            with book.open(f"xl/worksheets/sheet{n}.xml", "w") as part:
                part.write(f'<worksheet xmlns="{MAIN}"><sheetData>'.encode())
                for i, line in enumerate(lines, 1):
                    part.write((f'<row r="{i}">' + "".join(cell(f"{letters(j)}{i}", x) for j, x in enumerate(line) if x is not None) + "</row>").encode())
                part.write(b"</sheetData></worksheet>")
        numbered = list(enumerate(sheets, 1))
        book.writestr("xl/workbook.xml", f'<workbook xmlns="{MAIN}" xmlns:r="{RELATIONS}"><sheets>' + "".join(f'<sheet name="{escape(s, {chr(34): "&quot;"})}" sheetId="{n}" r:id="rId{n}"/>' for n, s in numbered) + "</sheets></workbook>")
        book.writestr("xl/_rels/workbook.xml.rels", f'<Relationships xmlns="{PACKAGE}">' + "".join(f'<Relationship Id="rId{n}" Type="{RELATIONS}/worksheet" Target="worksheets/sheet{n}.xml"/>' for n, _ in numbered) + f'<Relationship Id="rId0" Type="{RELATIONS}/sharedStrings" Target="sharedStrings.xml"/></Relationships>')
        book.writestr("xl/sharedStrings.xml", f'<sst xmlns="{MAIN}">' + "".join(f'<si><t xml:space="preserve">{escape(s)}</t></si>' for s in strings) + "</sst>")
        kind = "application/vnd.openxmlformats-officedocument.spreadsheetml"
        book.writestr("[Content_Types].xml", f'<Types xmlns="{TYPES}"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Override PartName="/xl/workbook.xml" ContentType="{kind}.sheet.main+xml"/><Override PartName="/xl/sharedStrings.xml" ContentType="{kind}.sharedStrings+xml"/>' + "".join(f'<Override PartName="/xl/worksheets/sheet{n}.xml" ContentType="{kind}.worksheet+xml"/>' for n, _ in numbered) + "</Types>")
        book.writestr("_rels/.rels", f'<Relationships xmlns="{PACKAGE}"><Relationship Id="rId1" Type="{RELATIONS}/officeDocument" Target="xl/workbook.xml"/></Relationships>')
    return out.getvalue()


def workbooks(df: DataFrame, by: str, columns: Sequence[str], sheet: str = "rows") -> DataFrame:
    """(path, content): a workbook for each value of by, which names it, with a line of names and df's columns below, in no stated order. A group is one task's; a sheet of the format has at most 2^20 lines, so by must part df finely enough."""

    def write(group: pa.Table) -> pa.Table:
        lines = [list(columns), *zip(*(group[c].to_pylist() for c in columns), strict=True)]
        return pa.table({"path": [str(group[by][0].as_py()) + ".xlsx"], "content": pa.array([workbook({sheet: lines})], pa.binary())})

    return df.select(by, *columns).groupBy(by).applyInArrow(write, "path string, content binary")
