"""Column-name rules."""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def quoted(*parts: str) -> Column:
    """Column reference that is safe for dots and other odd characters in names."""
    return F.col(".".join("`" + p.replace("`", "``") + "`" for p in parts))


def standard_name(name: str) -> str:
    return re.sub(r"[^a-z0-9_#]", "_", name.lower()).strip("_")


def require_distinct(originals: Sequence[str], renamed: Sequence[str]) -> None:
    """Raise when two columns end up under one name (Spark compares names without case)."""
    sources = defaultdict(list)
    for original, name in zip(originals, renamed):
        sources[name.lower()].append(original)
    clashes = {name: olds for name, olds in sources.items() if len(olds) > 1}
    if clashes:
        detail = "; ".join(f"{olds} -> {name!r}" for name, olds in clashes.items())
        raise ValueError(f"columns share a name after renaming: {detail}")


def rename_all(df: DataFrame, rename) -> DataFrame:
    renamed = [rename(c) for c in df.columns]
    require_distinct(df.columns, renamed)
    return df.toDF(*renamed)


def standardize_names(df: DataFrame) -> DataFrame:
    """Lower-case names, ``_`` for every character outside ``[a-z0-9_#]``, no outer ``_``."""
    return rename_all(df, standard_name)


def lowercase_names(df: DataFrame) -> DataFrame:
    return rename_all(df, str.lower)


def column_listing(df: DataFrame) -> list[dict[str, str]]:
    """Name and type of every column, in order."""
    return [{"name": name, "data_type": dtype} for name, dtype in df.dtypes]
