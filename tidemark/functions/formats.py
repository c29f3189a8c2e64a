"""Declared date and timestamp formats, parsed without raising on bad text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def spark_format(declared: str) -> str:
    """Translate declared year and day letters to calendar year and day of month."""
    return declared.replace("YYYY", "yyyy").replace("DD", "dd")


def parse_timestamp(text: Column, declared: str | None) -> Column:
    if not declared:
        return text.try_cast("timestamp")
    return F.try_to_timestamp(text, F.lit(spark_format(declared)))


def parse_date(text: Column, declared: str | None) -> Column:
    if not declared:
        return text.try_cast("date")
    return parse_timestamp(text, declared).cast("date")
