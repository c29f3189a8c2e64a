import io
import os
import uuid
import zipfile

import pytest

from tidemark.operators import quality
from tidemark.plans.ingest import ingest, staging_table
from tidemark.sources import workbook as workbook_source
from tidemark.sources.workbook import cell_position, sheet_rows

MAIN = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
RELS = 'xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"'
STYLES = (
    f'<styleSheet {MAIN}><numFmts><numFmt numFmtId="164" formatCode="yyyy\\-mm\\-dd"/>'
    '<numFmt numFmtId="165" formatCode="[Red]0.00&quot;days&quot;"/></numFmts>'
    '<cellXfs><xf numFmtId="0"/><xf numFmtId="164"/><xf numFmtId="14"/><xf numFmtId="165"/></cellXfs></styleSheet>'
)


def workbook(rows: str, sheet: str = "Data", styles: str = STYLES, properties: str = "") -> bytes:
    content = io.BytesIO()
    with zipfile.ZipFile(content, "w") as book:
        book.writestr(
            "xl/workbook.xml",
            f'<workbook {MAIN} {RELS}>{properties}<sheets><sheet name="Other" sheetId="1" r:id="rId1"/>'
            f'<sheet name="{sheet}" sheetId="2" r:id="rId2"/></sheets></workbook>',
        )
        book.writestr(
            "xl/_rels/workbook.xml.rels",
            '<Relationships><Relationship Id="rId1" Target="worksheets/none.xml"/>'
            '<Relationship Id="rId2" Target="/xl/worksheets/data.xml"/></Relationships>',
        )
        book.writestr("xl/sharedStrings.xml", f"<sst {MAIN}><si><t>Cust Name</t></si><si><r><t>A</t></r><r><t>da</t></r></si></sst>")
        book.writestr("xl/styles.xml", styles)
        book.writestr("xl/worksheets/data.xml", f"<worksheet {MAIN}><sheetData>{rows}</sheetData></worksheet>")
    return content.getvalue()


ROWS = (
    '<row r="1"><c r="A1" t="inlineStr"><is><t>a title above the table</t></is></c></row>'
    '<row r="3"><c r="B3" t="s"><v>0</v></c><c r="C3" t="inlineStr"><is><t>Born</t></is></c>'
    '<c r="D3" t="inlineStr"><is><t>Score</t></is></c><c r="E3" t="inlineStr"><is><t>Ok</t></is></c></row>'
    '<row r="4"><c r="B4" t="s"><v>1</v></c><c r="C4" s="1"><v>45292.5</v></c><c r="D4" s="3"><v>5.0</v></c><c r="E4" t="b"><v>1</v></c></row>'
    '<row r="5"><c r="A5"><v>9</v></c><c r="D5"><v>7</v></c></row>'
)


def test_positions_and_kinds():
    assert cell_position("A1") == (0, 0) and cell_position("AB12") == (11, 27)
    got = list(sheet_rows(workbook(ROWS), "Data", "B3"))
    assert [text for _, text in got[0]] == ["Cust Name", "Born", "Score", "Ok"]
    assert got[1] == [("text", "Ada"), ("timestamp", "2024-01-01 12:00:00"), ("number", "5.0"), ("boolean", "true")]
    assert got[2] == [("empty", ""), ("empty", ""), ("number", "7")]
    with pytest.raises(ValueError, match="Nope"):
        list(sheet_rows(workbook(ROWS), "Nope", "A1"))


def put(lake, name, content):
    path = lake.put(name, "")
    with open(path, "wb") as file:
        file.write(content)


def test_inferred_and_declared_ingest(lake):
    put(lake, "a.xlsx", workbook(ROWS))
    put(lake, "b.xlsx", workbook(ROWS))
    spec = lake.spec(file_type="excel", options={}, sheet="Data", start_cell="B3", mask="*.xlsx")
    assert ingest(lake.spark, spec, lake.run(), lake.ledgers).record_count == 4
    read = staging_table(lake.spark, spec).read()
    assert read.dtypes[:4] == [("cust_name", "string"), ("born", "timestamp"), ("score", "double"), ("ok", "boolean")]
    row = read.where("cust_name = 'Ada' AND source_file_name = 'b.xlsx'").first()
    assert str(row.born) == "2024-01-01 12:00:00" and row.score == 5.0 and row.ok is True
    assert read.where("cust_name = ''").count() == 2

    doc = [
        {"column_name": "Who", "column_data_type": "string"},
        {"column_name": "Born", "column_data_type": "date", "data_format": ""},
        {"column_name": "Score", "column_data_type": "int"},
    ]
    declared = lake.spec(
        dataset="declared", file_type="excel", options={}, sheet="Data", start_cell="B3", schema_doc=doc,
        target_table="D", target_location=f"{lake.root}/d",
    )
    ingest(lake.spark, declared, lake.run(), lake.ledgers)
    got = staging_table(lake.spark, declared).read().select("who", "born", "score").distinct().collect()
    assert sorted((r.who, str(r.born), r.score) for r in got) == [("", "None", 7), ("Ada", "2024-01-01", 5)]


def test_workbooks_with_differing_headers(lake):
    def sheet(header, values):
        def cells(row, texts):
            return "".join(f'<c r="{c}{row}" t="inlineStr"><is><t>{t}</t></is></c>' for c, t in zip("ABC", texts))

        return workbook(f'<row r="1">{cells(1, header)}</row><row r="2">{cells(2, values)}</row>')

    put(lake, "a.xlsx", sheet(["Id", "Name", "Old"], ["1", "x", "o"]))
    put(lake, "b c+d [1].xlsx", sheet(["Name", "Id"], ["y", "2"]))
    spec = lake.spec(file_type="excel", options={}, sheet="Data")
    assert ingest(lake.spark, spec, lake.run(), lake.ledgers).loaded_files == 2
    read = staging_table(lake.spark, spec).read()
    assert read.columns[:2] == ["name", "id"] and "old" not in read.columns
    assert sorted((r.id, r.name) for r in read.collect()) == [("1", "x"), ("2", "y")]
    merged = lake.spec(
        dataset="m", file_type="excel", options={}, sheet="Data", schema_mode="merge", target_table="M",
        target_location=f"{lake.root}/m",
    )
    ingest(lake.spark, merged, lake.run(), lake.ledgers)
    got = staging_table(lake.spark, merged).read()
    assert sorted((r.id, r.name, r.old) for r in got.collect()) == [("1", "x", "o"), ("2", "y", None)]


def test_worker_code_needs_no_package_on_executors(tmp_path):
    import subprocess
    import sys

    from pyspark import cloudpickle

    code = "import sys, pickle; f = pickle.load(sys.stdin.buffer); print(list(f(open('b', 'rb').read(), 'Data', 'B4'))[1][2])"
    (tmp_path / "b").write_bytes(workbook(ROWS))
    done = subprocess.run([sys.executable, "-c", code], input=cloudpickle.dumps(sheet_rows), capture_output=True, cwd=tmp_path)
    assert done.stdout.decode().strip() == "('number', '7')", done.stderr.decode()


def test_date_cells_formats_and_date_systems(lake):
    rows = (
        '<row r="1"><c r="A1" t="inlineStr"><is><t>Who</t></is></c><c r="B1" t="inlineStr"><is><t>Born</t></is></c></row>'
        '<row r="2"><c r="A2" t="inlineStr"><is><t>cell</t><rPh sb="0" eb="1"><t>hint</t></rPh></is></c><c r="B2" s="1"><v>{day}</v></c></row>'
        '<row r="3"><c r="A3" t="inlineStr"><is><t>text</t></is></c><c r="B3" t="inlineStr"><is><t>01.02.2024</t></is></c></row>'
        '<row r="4"><c r="A4" t="inlineStr"><is><t>bad</t></is></c><c r="B4" t="inlineStr"><is><t>2024-02-01</t></is></c></row>'
    )
    put(lake, "a.xlsx", workbook(rows.format(day=45292)))
    put(lake, "b.xlsx", workbook(rows.format(day=45292 - 1462), properties='<workbookPr date1904="1"/>'))
    doc = [
        {"column_name": "Who", "column_data_type": "string"},
        {"column_name": "Born", "column_data_type": "date", "data_format": "dd.MM.yyyy"},
    ]
    spec = lake.spec(file_type="excel", options={}, sheet="Data", schema_doc=doc)
    ingest(lake.spark, spec, lake.run(), lake.ledgers)
    got = staging_table(lake.spark, spec).read().select("source_file_name", "who", "born").collect()
    assert sorted((r.source_file_name, r.who, str(r.born)) for r in got) == [
        (name, who, born)
        for name in ("a.xlsx", "b.xlsx")
        for who, born in (("bad", "None"), ("cell", "2024-01-01"), ("text", "2024-02-01"))
    ]


@pytest.mark.parametrize("gated", [False, True])
def test_a_run_parses_each_workbook_twice(lake, tmp_path, monkeypatch, gated):
    """Once for the types and once for the rows, whatever the run counts, checks and writes afterwards."""
    put(lake, "a.xlsx", workbook(ROWS))
    put(lake, "b.xlsx", workbook(ROWS))
    marks, plain = str(tmp_path / "marks"), workbook_source.sheet_rows
    os.makedirs(marks)

    def counted(content, sheet, start):
        open(os.path.join(marks, uuid.uuid4().hex), "w").close()
        return plain(content, sheet, start)

    monkeypatch.setattr(workbook_source, "sheet_rows", counted)
    spec = lake.spec(file_type="excel", options={}, sheet="Data", start_cell="B3", mask="*.xlsx")
    rules = [quality.not_null("q", "score", message="score")] if gated else []
    assert ingest(lake.spark, spec, lake.run(), lake.ledgers, rules=rules).record_count == 4
    assert len(os.listdir(marks)) == 4
