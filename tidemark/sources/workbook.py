"""Excel workbooks: one row of a ``binaryFile`` read per workbook, parsed in its task.

The format itself bounds a sheet to 1,048,576 rows, so one workbook always fits a task.
Cells leave the parser as text in small batches and Spark casts them.
"""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator, Mapping, Sequence
from datetime import datetime, timedelta
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.names import require_distinct, standard_name, standardize_names
from tidemark.operators.schema import flat_schema
from tidemark.operators.shape import cast_declared
from tidemark.sources.delimited import LOCATION
from tidemark.sources.storage import literal_path

BATCH_ROWS = 5_000

# Number formats that the file format defines as dates or times.
DATE_FORMAT_IDS = {14, 15, 16, 17, 18, 19, 20, 21, 22, 45, 46, 47}
# Day 0 of a workbook, by its date system.
EPOCH, EPOCH_1904 = datetime(1899, 12, 30), datetime(1904, 1, 1)
# Written before the text of a real date cell of a declared sheet, whose declared format is for text.
DATE_MARK = "\x00date\x00"


def cell_position(reference: str) -> tuple[int, int]:
    """``B3`` as zero-based (row, column)."""
    letters, digits = re.fullmatch(r"\$?([A-Za-z]+)\$?([0-9]+)", reference).groups()
    column = 0
    for letter in letters.upper():
        column = column * 26 + ord(letter) - ord("A") + 1
    return int(digits) - 1, column - 1


def _tag(element) -> str:
    return element.tag.rsplit("}", 1)[-1]


def _text(element) -> str:
    """The text of a string, without the phonetic hints that may follow it."""
    own = [e for e in element if _tag(e) != "rPh"]
    return (element.text or "" if _tag(element) == "t" else "") + "".join(_text(e) for e in own)


def _epoch(book: zipfile.ZipFile) -> datetime:
    for element in ElementTree.fromstring(book.read("xl/workbook.xml")):
        if _tag(element) == "workbookPr" and element.get("date1904", "0").lower() in ("1", "true"):
            return EPOCH_1904
    return EPOCH


def _sheet_member(book: zipfile.ZipFile, sheet: str) -> str:
    for element in ElementTree.fromstring(book.read("xl/workbook.xml")).iter():
        if _tag(element) == "sheet" and element.get("name") == sheet:
            rel_id = next(v for k, v in element.attrib.items() if k.endswith("}id"))
            for rel in ElementTree.fromstring(book.read("xl/_rels/workbook.xml.rels")):
                if rel.get("Id") == rel_id:
                    target = rel.get("Target")
                    return target.lstrip("/") if target.startswith("/") else f"xl/{target}"
    raise ValueError(f"workbook has no sheet {sheet!r}")


def _date_styles(book: zipfile.ZipFile) -> set[int]:
    """Cell styles that show a number as a date."""
    if "xl/styles.xml" not in book.namelist():
        return set()
    formats, styles = {}, []
    for element in ElementTree.fromstring(book.read("xl/styles.xml")):
        if _tag(element) == "numFmts":
            formats = {int(f.get("numFmtId")): f.get("formatCode", "") for f in element}
        elif _tag(element) == "cellXfs":
            styles = [int(x.get("numFmtId", "0")) for x in element]
    # Colours, locale tags and quoted text in a format code are not date letters.
    letters = {i: re.sub(r'"[^"]*"|\[[^\]]*\]|\\.', "", code).lower() for i, code in formats.items()}
    return {
        n
        for n, format_id in enumerate(styles)
        if format_id in DATE_FORMAT_IDS or re.search(r"[ymdhs]", letters.get(format_id, ""))
    }


def sheet_rows(content: bytes, sheet: str, start: str) -> Iterator[list[tuple[str, str]]]:
    """Rows from the start cell on, as ``(kind, text)`` cells; an absent cell is empty text."""
    first_row, first_column = cell_position(start)
    with zipfile.ZipFile(io.BytesIO(content)) as book:
        shared = []
        if "xl/sharedStrings.xml" in book.namelist():
            shared = [_text(e) for e in ElementTree.fromstring(book.read("xl/sharedStrings.xml"))]
        dates, epoch = _date_styles(book), _epoch(book)
        with book.open(_sheet_member(book, sheet)) as stream:
            for _, row in ElementTree.iterparse(stream):
                if _tag(row) != "row":
                    continue
                cells: dict[int, tuple[str, str]] = {}
                number = int(row.get("r")) - 1 if row.get("r") else None
                for position, cell in enumerate(c for c in row if _tag(c) == "c"):
                    column = position
                    if cell.get("r"):
                        number, column = cell_position(cell.get("r"))
                    cells[column - first_column] = _cell(cell, shared, dates, epoch)
                row.clear()
                if number is None or number >= first_row:
                    width = max(cells, default=-1) + 1
                    yield [cells.get(i, ("empty", "")) for i in range(width)]


def _cell(cell, shared: list[str], dates: set[int], epoch: datetime) -> tuple[str, str]:
    kind = cell.get("t", "n")
    if kind == "inlineStr":
        return "text", _text(cell)
    value = next((e.text or "" for e in cell if _tag(e) == "v"), "")
    if value == "":
        return "empty", ""
    if kind == "s":
        return "text", shared[int(value)]
    if kind == "b":
        return "boolean", "true" if value == "1" else "false"
    if kind != "n":
        return "text", value
    if int(cell.get("s", "0")) in dates:
        moment = epoch + timedelta(milliseconds=round(float(value) * 86_400_000))
        return "timestamp", moment.isoformat(sep=" ")
    return "number", value


# Spark types of inferred columns, by the kinds of cell found below the header.
INFERRED = {
    frozenset({"number"}): T.DoubleType(),
    frozenset({"boolean"}): T.BooleanType(),
    frozenset({"timestamp"}): T.TimestampType(),
}


def _cast(text: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, T.StringType):
        return text
    if isinstance(dtype, (T.IntegerType, T.LongType)):
        # Workbooks may write whole numbers as 5.0 or 5E0.
        return F.coalesce(text.try_cast(dtype), text.try_cast("double").try_cast(dtype))
    return text.try_cast(dtype)


def _header(row: list[tuple[str, str]]) -> list[str]:
    originals = [text for _, text in row]
    names = [standard_name(text) or f"_c{i}" for i, text in enumerate(originals)]
    require_distinct(originals, names)
    return names


def infer_columns(
    workbooks: DataFrame, sheet: str, start: str, schema_mode: str = "latest"
) -> list[tuple[str, T.DataType]]:
    """Columns of the newest workbook's header (or of all with ``merge``), typed by all cells below."""

    def describe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"]):
                rows = sheet_rows(content, sheet, start)
                header = _header(next(rows, []))
                kinds: list[set[str]] = [set() for _ in header]
                for row in rows:
                    for seen, (kind, _) in zip(kinds, row):
                        seen.add(kind)
                yield pd.DataFrame(
                    {"path": path, "position": range(len(header)), "name": header, "kinds": [sorted(k) for k in kinds]}
                )

    found = workbooks.mapInPandas(describe, "path string, position int, name string, kinds array<string>")
    age = F.struct(F.substring_index("path", "/", -1).alias("base"), F.col("path"))
    columns = (
        found.groupBy("name")
        .agg(
            F.max(age).alias("newest"),
            F.max_by("position", age).alias("position"),
            F.array_distinct(F.flatten(F.collect_set("kinds"))).alias("kinds"),
        )
        .collect()
    )
    if not columns:
        return []
    newest = max(c.newest for c in columns)
    kept = [c for c in columns if c.newest == newest or schema_mode == "merge"]
    kept.sort(key=lambda c: (c.newest != newest, c.position, c.name))
    return [(c.name, INFERRED.get(frozenset(c.kinds) - {"empty"}, T.StringType())) for c in kept]


def read_workbooks(
    spark: SparkSession,
    paths: Sequence[str],
    sheet: str,
    start: str = "A1",
    header: bool = True,
    schema_doc: Sequence[Mapping[str, str]] | None = None,
    schema_mode: str = "latest",
) -> DataFrame | None:
    """Sheet rows of many workbook files, declared or inferred."""
    workbooks = spark.read.format("binaryFile").load([literal_path(p) for p in paths]).select("path", "content")
    return parse_workbooks(workbooks, sheet, start, header, schema_doc, schema_mode)


def parse_workbooks(
    workbooks: DataFrame,
    sheet: str,
    start: str = "A1",
    header: bool = True,
    schema_doc: Sequence[Mapping[str, str]] | None = None,
    schema_mode: str = "latest",
) -> DataFrame | None:
    """Sheet rows of workbooks given as ``path, content``.

    Declared columns go by position, inferred ones by the name in each workbook's header.
    None when columns are to be inferred and no workbook has a header.
    """
    if schema_doc is not None:
        columns = [(f.name, f.dataType) for f in flat_schema(schema_doc).fields]
    elif header:
        columns = infer_columns(workbooks, sheet, start, schema_mode)
        if not columns:
            return None
    else:
        raise ValueError("a workbook without header needs a declared schema")
    names, width, by_name = [n for n, _ in columns], len(columns), schema_doc is None
    # A declared format is for text; cells that are dates by themselves are told apart by a mark.
    dated = {
        i: c["column_data_type"].lower()
        for i, c in enumerate(schema_doc or ())
        if c["column_data_type"].lower() in ("date", "timestamp")
    }

    def text_of(place: int, cell: tuple[str, str]) -> str:
        return DATE_MARK + cell[1] if place in dated and cell[0] == "timestamp" else cell[1]

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def frame(path: str, rows: list[list[str | None]]) -> pd.DataFrame:
            data = pd.DataFrame(rows, columns=[f"c{i}" for i in range(width)], dtype=object)
            return data.assign(path=path)

        for batch in batches:
            for path, content in zip(batch["path"], batch["content"]):
                cells = sheet_rows(content, sheet, start)
                places: list[int | None] = list(range(width))
                if header:
                    found = next(cells, [])
                    if by_name:
                        at = {name: i for i, name in enumerate(_header(found))}
                        places = [at.get(name) for name in names]
                rows: list[list[str | None]] = []
                for row in cells:
                    # A cell that is not there is empty, a column that is not there is NULL.
                    rows.append([None if p is None else text_of(p, row[p]) if p < len(row) else "" for p in places])
                    if len(rows) == BATCH_ROWS:
                        yield frame(path, rows)
                        rows = []
                if rows:
                    yield frame(path, rows)

    raw_schema = ", ".join(f"c{i} string" for i in range(width)) + ", path string"
    raw = workbooks.mapInPandas(parse, raw_schema)

    def plain(i: int) -> Column:
        return F.when(~F.col(f"c{i}").startswith(DATE_MARK), F.col(f"c{i}")) if i in dated else F.col(f"c{i}")

    def real(i: int, kind: str) -> Column:
        value = F.substr(f"c{i}", F.lit(len(DATE_MARK) + 1))
        return F.when(F.col(f"c{i}").startswith(DATE_MARK), value.try_cast(kind))

    typed = raw.select(
        *[_cast(plain(i), dtype).alias(name) for i, (name, dtype) in enumerate(columns)],
        F.col("path").alias(LOCATION),
        *[real(i, kind).alias(f"__real_{i}") for i, kind in dated.items()],
    )
    if schema_doc is not None:
        typed = cast_declared(typed, schema_doc)
        typed = typed.withColumns({names[i]: F.coalesce(f"__real_{i}", F.col(f"`{names[i]}`")) for i in dated})
        typed = typed.drop(*[f"__real_{i}" for i in dated])
    return standardize_names(typed)
