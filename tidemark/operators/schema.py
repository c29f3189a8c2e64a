"""Declared schema documents as Spark schemas."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import types as T

# Type words of schema documents. Dates and timestamps are read as text
# and cast afterwards, as their format belongs to the document.
SCALARS = {
    "string": T.StringType(),
    "str": T.StringType(),
    "int": T.IntegerType(),
    "integer": T.IntegerType(),
    "long": T.LongType(),
    "float": T.FloatType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "date": T.StringType(),
    "timestamp": T.StringType(),
}
DEFAULT_DECIMAL = T.DecimalType(18, 2)


def decimal_type(precision_scale: str | None) -> T.DecimalType:
    """``"p,s"`` as a decimal; the default stands in for anything unreadable."""
    try:
        precision, scale = (int(n) for n in (precision_scale or "").split(","))
    except ValueError:
        return DEFAULT_DECIMAL
    return T.DecimalType(precision, scale)


def _scalar(word: str, column: str, precision_scale: str | None) -> T.DataType:
    word = word.lower()
    if word == "decimal":
        return decimal_type(precision_scale)
    if word not in SCALARS:
        raise ValueError(f"type {word!r} of column {column!r} is not supported")
    return SCALARS[word]


def flat_schema(doc: Sequence[Mapping[str, str]]) -> T.StructType:
    """Schema of a flat file from ``{column_name, column_data_type, data_format}`` rows."""
    if not doc:
        raise ValueError("the schema document is empty")
    return T.StructType(
        [
            T.StructField(c["column_name"], _scalar(c["column_data_type"], c["column_name"], c.get("data_format")))
            for c in doc
        ]
    )


def _nested(value, column: str) -> T.DataType:
    if isinstance(value, Mapping):
        return T.StructType([T.StructField(k, _nested(v, k)) for k, v in value.items()])
    if isinstance(value, Sequence) and not isinstance(value, str):
        if not value:
            raise ValueError(f"array {column!r} declares no element")
        # The first element speaks for all; an array of scalars stays JSON text.
        element = value[0]
        return T.ArrayType(_nested(element, column)) if isinstance(element, Mapping) else T.StringType()
    word, _, precision_scale = value.partition("|")
    return _scalar(word, column, precision_scale)


def json_schema(doc: Mapping | Sequence) -> T.StructType:
    """Schema of nested documents from a sample-shaped document of type words."""
    if not isinstance(doc, Mapping):
        doc = doc[0] if doc else {}
    if not doc:
        raise ValueError("the schema document is empty")
    return _nested(doc, "")
