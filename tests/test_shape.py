import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import types as T

from tidemark.functions.names import lowercase_names, standardize_names
from tidemark.operators.schema import decimal_type, flat_schema, json_schema
from tidemark.operators.shape import cast_declared, dedup_within_file, flatten, flatten_apart, scrub_null_token


def test_flat_schema_types():
    words = "string str int integer long float double boolean timestamp date".split()
    schema = flat_schema([{"column_name": f"c{i}", "column_data_type": w.upper()} for i, w in enumerate(words)])
    assert [f.dataType.simpleString() for f in schema.fields] == (
        "string string int int bigint float double boolean string string".split()
    )
    assert all(f.nullable for f in schema.fields)


@pytest.mark.parametrize("text, expected", [("20,3", (20, 3)), ("", (18, 2)), (None, (18, 2)), ("x", (18, 2))])
def test_decimal_format(text, expected):
    assert (decimal_type(text).precision, decimal_type(text).scale) == expected


def test_unknown_type_names_column():
    with pytest.raises(ValueError, match="'blob'.*'c1'"):
        flat_schema([{"column_name": "c1", "column_data_type": "blob"}])
    with pytest.raises(ValueError, match="empty"):
        flat_schema([])


def test_json_schema():
    doc = [
        {
            "id": "string",
            "price": "decimal|12,3",
            "made": "date",
            "inner": {"n": "int", "deep": [{"d": "decimal", "x": "double"}]},
            "tags": ["string"],
        }
    ]
    assert json_schema(doc).simpleString() == (
        "struct<id:string,price:decimal(12,3),made:string,"
        "inner:struct<n:int,deep:array<struct<d:decimal(18,2),x:double>>>,tags:string>"
    )


SAMPLE = (
    "id string, type string, name string, ppu string, "
    "batters struct<batter: array<struct<id: string, type: string>>>, topping array<struct<id: string, type: string>>"
)


def test_flatten_cross_product_and_empty(spark, rows):
    data = [
        ("1", "t", "n", "p", ([("b1", "x"), ("b2", "y")],), [("t1", "u"), ("t2", "v")]),
        ("2", "t", "n", "p", ([("b1", "x")],), []),
        ("3", "t", "n", "p", None, [("t1", "u")]),
    ]
    flat = flatten(spark.createDataFrame(data, SAMPLE))
    assert flat.columns == ["id", "type", "name", "ppu", "topping_id", "topping_type", "batter_id", "batter_type"]
    assert rows(flat, "id", "batter_id", "topping_id") == [
        ("1", "b1", "t1"),
        ("1", "b1", "t2"),
        ("1", "b2", "t1"),
        ("1", "b2", "t2"),
        ("2", "b1", None),
        ("3", None, "t1"),
    ]


def test_flatten_leaves_flat_rows_alone(spark):
    df = spark.createDataFrame([(1, "a")], "a int, b string")
    assert flatten(df).columns == ["a", "b"]


def test_flatten_strips_only_a_prefix_and_refuses_clashes(spark):
    df = spark.createDataFrame([(("x",), "k")], "doc struct<my_doc_id: string>, other_doc_x string")
    assert flatten(df).columns == ["other_doc_x", "my_doc_id"]
    clash = spark.createDataFrame([("k", ("x",))], "id string, doc struct<id: string>")
    with pytest.raises(ValueError, match="id"):
        flatten(clash)


def test_names(spark):
    df = spark.createDataFrame([(1, 2, 3)], ["A b.C", "_x#-", "Größe"])
    assert standardize_names(df).columns == ["a_b_c", "x#", "gr__e"]
    with pytest.raises(ValueError, match="A b.*A_b"):
        standardize_names(spark.createDataFrame([(1, 2)], ["A b", "A_b"]))
    assert lowercase_names(spark.createDataFrame([(1,)], ["Ab C"])).columns == ["ab c"]


def test_declared_casts(spark):
    doc = [
        {"column_name": "d", "column_data_type": "date", "data_format": "YYYY-MM-DD"},
        {"column_name": "e", "column_data_type": "date"},
        {"column_name": "t", "column_data_type": "timestamp", "data_format": "dd.MM.yyyy HH:mm:ss.SSS"},
        {"column_name": "n", "column_data_type": "int"},
    ]
    data = [("2024-02-29", "2024-01-01", "31.12.2024 23:59:58.123", 1), ("2024-02-30", "soon", "31.13.2024", 2)]
    got = cast_declared(spark.createDataFrame(data, "d string, e string, t string, n int"), doc).collect()
    assert tuple(got[0]) == (dt.date(2024, 2, 29), dt.date(2024, 1, 1), dt.datetime(2024, 12, 31, 23, 59, 58, 123000), 1)
    assert tuple(got[1]) == (None, None, None, 2)


def test_null_token(spark, rows):
    df = spark.createDataFrame([("null", 1), ("NULL", 2), (None, 3), (" null", 4)], "s string, n int")
    assert rows(scrub_null_token(df)) == [(" null", 4), ("", 1), ("NULL", 2), (None, 3)]


def test_dedup_is_per_file(spark):
    df = spark.createDataFrame([(1, "f"), (1, "f"), (1, "g")], "n int, source_file_location string")
    assert dedup_within_file(df).count() == 2


def test_decimal_in_flat_file_round_trip(spark, tmp_path):
    (tmp_path / "a.csv").write_text("1,2.50\n")
    from tidemark.sources.delimited import read_declared

    doc = [
        {"column_name": "A", "column_data_type": "int"},
        {"column_name": "B", "column_data_type": "decimal", "data_format": "20,3"},
    ]
    row = read_declared(spark, [str(tmp_path / "a.csv")], doc, header=False).first()
    assert (row.a, row.b) == (1, Decimal("2.500"))
    assert isinstance(flat_schema(doc)["B"].dataType, T.DecimalType)


def test_arrays_apart(spark):
    """Each element has a row of its own; NULL and empty arrays keep the document's row."""
    docs = spark.sql(
        """SELECT * FROM VALUES
             (1, array(10, 11), array(named_struct('k', 'a', 'deep', array(1, 2)), named_struct('k', 'b', 'deep', array()))),
             (2, array(), NULL),
             (3, array(NULL), array()) AS t(id, xs, ys)"""
    )
    got = flatten_apart(docs)
    assert got.columns == ["id", "xs", "ys_k", "ys_deep"]
    assert sorted((tuple(r) for r in got.collect()), key=repr) == sorted(
        [(1, 10, None, None), (1, 11, None, None), (1, None, "a", 1), (1, None, "a", 2), (1, None, "b", None), (2, None, None, None), (3, None, None, None)],
        key=repr,
    )
    one = spark.sql("SELECT 1 AS id, array(1, 2) AS xs")
    assert sorted(map(tuple, flatten_apart(one).collect())) == sorted(map(tuple, flatten(one).collect()))
    flat = spark.sql("SELECT 1 AS id, 'x' AS name")
    assert flatten_apart(flat).columns == ["id", "name"]
