from __future__ import annotations

import pytest

#: Texts every operator has to take: null, empty, blank, repeated, long, other scripts.
ODD_TEXTS = [
    None,
    "",
    " \n\t",
    "one",
    "one",
    "Zwölf Boxkämpfer jagen Viktor quer über den großen Sylter Deich",
    "a b c 漢字 😀",
    "x" * 5000,
    "the same line again\n" * 300,
    "# * $ % & | < >",
]


@pytest.fixture
def docs_of(spark, tmp_path):
    """A stored table of documents from (doc_id, text) rows, with columns whose names the operators use inside."""
    made = []

    def make(rows, parts: int = 2):
        path = str(tmp_path / f"docs{len(made)}")
        made.append(path)
        schema = "doc_id long, text string, lang string, source string, n_chars long, _row string, fp int, c0 string, weight string, _copy int"
        full = [(i, t, "en", None if n % 5 == 0 else f"s{n % 3}", len(t or ""), "r", 1, "c", "w", 7) for n, (i, t) in enumerate(rows)]
        spark.createDataFrame(full, schema).repartition(parts).write.parquet(path)
        return spark.read.parquet(path)

    return make


@pytest.fixture
def odd_docs(docs_of):
    """Odd texts under ids that are null, equal and plain."""
    rows = [(n, t) for n, t in enumerate(ODD_TEXTS)] + [(None, t) for t in ODD_TEXTS] + [(3, t) for t in ODD_TEXTS]
    return docs_of(rows)


@pytest.fixture
def no_docs(docs_of):
    return docs_of([])
