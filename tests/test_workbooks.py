"""Workbooks read cell by cell."""

import io
import zipfile

import pytest

from tablewright.sources import workbooks
from tablewright.sources.readers import InvalidData, MissingFile


def found(df):
    return sorted(((r.sheet, r.row, r.column, r.number, r.text) for r in df.collect()), key=str)


def test_written_cells_come_back(spark, tmp_path):
    wide = [None] * 27 + [3.25]
    sheets = {"one & <two>": [[1, 2.5, None, "a<b & c"], [], [None, "same", "same", True], wide], "empty": [], "three": [[-1e-7, " x ", "\u00e9\n"]]}
    (tmp_path / "a.xlsx").write_bytes(workbooks.workbook(sheets))
    (tmp_path / "b.xlsx").write_bytes(workbooks.workbook({"s": [[7]]}))
    want = [(s, i, j, None if isinstance(x, str) else float(x), x if isinstance(x, str) else None) for s, lines in sheets.items() for i, line in enumerate(lines) for j, x in enumerate(line) if x is not None]
    assert found(workbooks.read_workbooks(spark, str(tmp_path / "a.xlsx"))) == sorted(want, key=str)
    both = workbooks.read_workbooks(spark, str(tmp_path))
    assert both.count() == len(want) + 1 and both.select("path").distinct().count() == 2


def test_many_cells_in_batches(spark, tmp_path, monkeypatch):
    lines = [[k, f"t{k % 50}", k / 7] for k in range(9000)]
    (tmp_path / "a.xlsx").write_bytes(workbooks.workbook({"s": lines}))
    rows = workbooks.table(workbooks.read_workbooks(spark, str(tmp_path / "a.xlsx")), {"k": "long", "t": "string", "x": "double"}, header=False)
    assert sorted((r.k, r.t, r.x) for r in rows.collect()) == [tuple(x) for x in lines]


def test_other_writers_cells(spark):
    """Cells and rows without places, inline and formatted strings, formula results, errors, blanks."""
    m = workbooks.MAIN
    rows = '<row><c><v>1</v></c><c t="inlineStr"><is><t>in</t></is></c><c t="e"><v>#DIV/0!</v></c><c s="1"/><c t="str"><f>A1</f><v>made</v></c></row><row r="5"><c r="AA5" t="s"><v>0</v></c><c><v>2</v></c></row><row><c t="n"><v> </v></c><c t="b"><v>1</v></c></row>'
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("xl/workbook.xml", f'<workbook xmlns="{m}" xmlns:r="{workbooks.RELATIONS}"><sheets><sheet name="s" r:id="x"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", f'<Relationships xmlns="{workbooks.PACKAGE}"><Relationship Id="x" Target="/xl/worksheets/odd.xml"/></Relationships>')
        z.writestr("xl/worksheets/odd.xml", f'<worksheet xmlns="{m}"><sheetData>{rows}</sheetData></worksheet>')
        z.writestr("xl/sharedStrings.xml", f'<sst xmlns="{m}"><si><r><t>bo</t></r><r><t>ld</t></r><rPh><t>no</t></rPh></si></sst>')
    files = spark.createDataFrame([("p", bytearray(out.getvalue())), ("none", None)], "path string, content binary")
    assert found(workbooks.cells(files)) == sorted([("s", 0, 0, 1.0, None), ("s", 0, 1, None, "in"), ("s", 0, 4, None, "made"), ("s", 4, 26, None, "bold"), ("s", 4, 27, 2.0, None), ("s", 5, 1, 1.0, None)], key=str)
    assert workbooks.cells(files.limit(0)).count() == 0


def test_numbers_and_errors(spark, tmp_path):
    (tmp_path / "a.xlsx").write_bytes(workbooks.workbook({"s": [[1, " 2.5 ", None], ["", 4]]}))
    assert sorted(r[0] for r in workbooks.numbers(workbooks.read_workbooks(spark, str(tmp_path / "a.xlsx"))).collect()) == [1.0, 2.5, 4.0]
    (tmp_path / "b.xlsx").write_bytes(workbooks.workbook({"s": [[1, "two"]]}))
    with pytest.raises(InvalidData, match="two"):
        workbooks.numbers(workbooks.read_workbooks(spark, str(tmp_path / "b.xlsx")))
    (tmp_path / "c.xlsx").write_bytes(b"no zip")
    with pytest.raises(Exception, match="no workbook that can be read"):
        workbooks.read_workbooks(spark, str(tmp_path / "c.xlsx")).count()
    with pytest.raises(MissingFile):
        workbooks.read_workbooks(spark, str(tmp_path / "none.xlsx"))
