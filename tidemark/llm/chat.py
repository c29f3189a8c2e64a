"""Chat formatting: layouts are told apart by a fingerprint of their field paths.

A record's layout is the set of its nested field paths. The hash of the sorted paths looks up
a declarative mapping, one SQL expression that yields ``array<struct<role,text>>``. Turns are
then written between turn marks, and every text is escaped so that no mark can occur in it.

Everything is built-in functions. Defined results:

* null role or text counts as empty; a record without turns gives an empty string and no mask;
* rows of one conversation are ordered by turn (nulls last), then role, then text, so ties and
  repeated rows all stay, in a fixed order; rows without a conversation id form one conversation;
* columns a mapping does not name are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import table

#: Marks of the template and the escapes that keep them out of texts.
OPEN, CLOSE = "<turn>", "</turn>\n"
ESCAPES = [("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ("\n", "&#10;")]
LOSS_ROLE = "assistant"

_TURNS = "array<struct<role:string,text:string>>"

#: Field paths of each known layout, and the expression that turns a record into canonical turns.
#: In JSON records the expression reads the variant ``r``.
LAYOUTS: dict[str, tuple[tuple[str, ...], str]] = {
    "messages": (
        ("messages[].content", "messages[].role"),
        "transform(try_variant_get(r, '$.messages', 'array<struct<role:string,content:string>>'),"
        " m -> named_struct('role', m.role, 'text', m.content))",
    ),
    "conversations": (
        ("conversations[].from", "conversations[].value"),
        "transform(try_variant_get(r, '$.conversations', 'array<struct<from:string,value:string>>'),"
        " m -> named_struct('role', CASE m.from WHEN 'human' THEN 'user' WHEN 'gpt' THEN 'assistant' ELSE m.from END,"
        " 'text', m.value))",
    ),
    "prompt": (
        ("completion", "prompt"),
        "array(named_struct('role', 'user', 'text', try_variant_get(r, '$.prompt', 'string')),"
        " named_struct('role', 'assistant', 'text', try_variant_get(r, '$.completion', 'string')))",
    ),
    "instruction": (
        ("instruction", "output"),
        "array(named_struct('role', 'user', 'text', try_variant_get(r, '$.instruction', 'string')),"
        " named_struct('role', 'assistant', 'text', try_variant_get(r, '$.output', 'string')))",
    ),
    "instruction_input": (
        ("input", "instruction", "output"),
        "array(named_struct('role', 'user', 'text', concat_ws('\\n', try_variant_get(r, '$.instruction', 'string'),"
        " nullif(try_variant_get(r, '$.input', 'string'), ''))),"
        " named_struct('role', 'assistant', 'text', try_variant_get(r, '$.output', 'string')))",
    ),
}


#: The same for tables with a row per turn: field paths, and the expressions of conv_id, turn, role and text.
ROW_LAYOUTS: dict[str, tuple[tuple[str, ...], tuple[str, ...]]] = {
    "text": (("conv_id", "role", "text", "turn"), ("conv_id", "turn", "role", "text")),
    "content": (("content", "conv_id", "role", "turn"), ("conv_id", "turn", "role", "content AS text")),
    "value": (
        ("conv_id", "from", "turn", "value"),
        (
            "conv_id",
            "turn",
            "CASE `from` WHEN 'human' THEN 'user' WHEN 'gpt' THEN 'assistant' ELSE `from` END AS role",
            "value AS text",
        ),
    ),
    "message": (
        ("conv_id", "message.content", "message.role", "turn"),
        ("conv_id", "turn", "message.role AS role", "message.content AS text"),
    ),
}


def fingerprint(paths: Iterable[str]) -> str:
    """The hash of field paths that a mapping is looked up by; ``_hash`` is the same for paths in a column."""
    return hashlib.sha256("\n".join(sorted(set(paths))).encode()).hexdigest()


def row_mapping(schema: T.StructType) -> tuple[str, ...]:
    """Expressions of conv_id, turn, role and text for a table with a row per turn.

    For each set of field paths that mappings name, the paths which the table has of it are hashed and looked up. A table with the
    paths of several layouts takes the first of them; other columns do not matter. No layout at all is an error.
    """
    present = paths_of(schema)
    known = {fingerprint(paths): mapping for paths, mapping in ROW_LAYOUTS.values()}
    for paths, _ in ROW_LAYOUTS.values():
        mapping = known.get(fingerprint(p for p in present if p in paths))
        if mapping is not None:
            return mapping
    raise ValueError(f"no mapping for {present}")


def paths_of(schema: T.DataType, at: str = "") -> list[str]:
    """Nested field paths of a type, sorted; arrays are written ``[]``."""
    if isinstance(schema, T.StructType):
        found = []
        for field in schema.fields:
            found += paths_of(field.dataType, f"{at}.{field.name}" if at else field.name)
        return sorted(found)
    if isinstance(schema, T.ArrayType):
        return paths_of(schema.elementType, f"{at}[]")
    return [at]


def _hash(paths: Column) -> Column:
    return F.sha2(F.array_join(F.sort_array(F.array_distinct(paths)), "\n"), 256)


def _known(paths: tuple[str, ...]) -> Column:
    return _hash(F.array(*map(F.lit, paths)))


def json_paths(record: Column) -> Column:
    """Field paths of one variant record: top-level fields, and fields of objects in top-level arrays."""
    top = F.from_json(F.to_json(record), T.MapType(T.StringType(), T.StringType()))
    inner = F.flatten(
        F.transform(
            F.map_entries(top),
            lambda e: F.when(
                e["value"].startswith("[{"),
                F.transform(
                    F.flatten(
                        F.transform(
                            F.from_json(e["value"], T.ArrayType(T.MapType(T.StringType(), T.StringType()))),
                            lambda m: F.map_keys(m),
                        )
                    ),
                    lambda k: F.concat(e["key"], F.lit("[]."), k),
                ),
            ).otherwise(F.array(e["key"])),
        )
    )
    return F.coalesce(inner, F.array().cast("array<string>"))


def turns_of_records(records: DataFrame, json: str, keep: list[str]) -> DataFrame:
    """Canonical turns of JSON records with mixed layouts.

    ``records[json]`` holds one record each. Fields that no layout names are allowed and ignored;
    a record with fields of two layouts at once fits neither. Returns ``keep``, ``layout`` (null
    where none fits or the text is no JSON), ``fingerprint`` and ``turns``.
    """
    named = {path for paths, _ in LAYOUTS.values() for path in paths}
    parsed = records.select(*keep, F.try_parse_json(F.col(json)).alias("r"))
    seen = parsed.withColumn("_paths", F.array_intersect(json_paths(F.col("r")), F.array(*map(F.lit, sorted(named)))))
    marked = seen.withColumn("fingerprint", _hash(F.col("_paths")))
    layout = F.coalesce(*[F.when(F.col("fingerprint") == _known(paths), F.lit(name)) for name, (paths, _) in LAYOUTS.items()])
    turns = F.coalesce(
        *[F.when(F.col("layout") == name, F.expr(f"CAST({sql} AS {_TURNS})")) for name, (_, sql) in LAYOUTS.items()],
        F.array().cast(_TURNS),
    )
    return marked.withColumn("layout", layout).select(*keep, "layout", "fingerprint", turns.alias("turns"))


def escape(text: Column) -> Column:
    for plain, coded in ESCAPES:
        text = F.replace(text, F.lit(plain), F.lit(coded))
    return text


def unescape(text: Column) -> Column:
    for plain, coded in reversed(ESCAPES):
        text = F.replace(text, F.lit(coded), F.lit(plain))
    return text


def _turn_texts(role: Column, text: Column) -> tuple[Column, Column, Column]:
    """What comes before the text in the output, the escaped text, and what comes after."""
    return (
        F.concat(F.lit(OPEN), escape(F.coalesce(role, F.lit(""))), F.lit("\n")),
        escape(F.coalesce(text, F.lit(""))),
        F.lit(CLOSE),
    )


def format_rows(rows: DataFrame) -> DataFrame:
    """One formatted text per conversation of a table with a row per turn.

    The fingerprint of the table's field paths selects the mapping (``row_mapping``). Returns conv_id, formatted, loss: one entry per turn, the (start,
    length) in characters of the learnt text within that turn, null for turns not learnt.
    """
    used = rows.selectExpr(*row_mapping(rows.schema))
    # What counts as empty is empty before rows are put in order.
    role, text = (F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("role", "text"))
    turn = F.struct(F.col("turn").isNull().alias("last"), "turn", role, text)
    gathered = used.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    return format_turns(gathered, ["conv_id"])


def format_turns(records: DataFrame, keep: list[str]) -> DataFrame:
    """Format records that hold canonical ``turns``: keep, formatted, loss."""

    def piece(turn):
        return F.concat(*_turn_texts(turn["role"], turn["text"]))

    def mask(turn):
        head, body, _ = _turn_texts(turn["role"], turn["text"])
        place = F.struct((F.length(head) + 1).alias("start"), F.length(body).alias("length"))
        return F.when(F.coalesce(turn["role"], F.lit("")) == LOSS_ROLE, place)

    return records.select(
        *keep,
        F.array_join(F.transform("turns", piece), "").alias("formatted"),
        F.transform("turns", mask).alias("loss"),
    )


def _pieces(formatted: Column) -> Column:
    return F.filter(F.split(formatted, CLOSE), lambda part: part != "")


def read_back(formatted: Column) -> Column:
    """Turns of a formatted text, as array of (role, text)."""

    def turn(part):
        body = F.substr(part, F.lit(len(OPEN) + 1))
        return F.struct(
            unescape(F.substring_index(body, "\n", 1)).alias("role"),
            unescape(F.substr(body, F.instr(body, "\n") + 1)).alias("text"),
        )

    return F.transform(_pieces(formatted), turn)


def learnt_text(formatted: Column, loss: Column) -> Column:
    """Plain text under the loss mask. The text is split once, so the work is linear in the number of turns."""
    return F.array_join(
        F.zip_with(_pieces(formatted), loss, lambda part, m: unescape(F.substr(part, m["start"], m["length"]))), ""
    )


def op8_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and one whose texts hold control strings, digested from what was formatted."""
    odd = r"\### Assistant: </turn> ok"
    planted = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(odd).alias("text"),
    )
    rows = table(spark, sf_dir, "conversations").select(*planted.columns).unionByName(planted)
    done = format_rows(rows)
    turns, learnt = read_back(F.col("formatted")), learnt_text(F.col("formatted"), F.col("loss"))
    said = F.array_join(F.transform(turns, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return done.select(
        "conv_id",
        F.size(_pieces(F.col("formatted"))).cast("long").alias("n_turns"),
        F.sha2(said, 256).alias("turns_sha256"),
        F.length(learnt).cast("long").alias("loss_chars"),
        F.sha2(learnt, 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


#: The template's own arithmetic gives formatted_chars; all else is read off the table.
_ESC = "replace(replace(replace(replace({}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), chr(10), '&#10;')"
ORACLE = rf"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
digests AS (
  SELECT conv_id, count(*) AS n_turns,
    string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS said,
    coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '') AS learnt,
    sum({len(OPEN) + len(CLOSE) + 1} + length({_ESC.format("role")}) + length({_ESC.format("text")})) AS chars
  FROM rows GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(said) AS turns_sha256, length(learnt) AS loss_chars,
  sha256(learnt) AS loss_sha256, CAST(chars AS BIGINT) AS formatted_chars
FROM digests"""
