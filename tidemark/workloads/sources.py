"""Queries over file sources, discovery and row shaping."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator
from dataclasses import replace
from xml.sax.saxutils import escape

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import masks
from tidemark.functions.names import column_listing as columns_of
from tidemark.functions.names import lowercase_names, standardize_names
from tidemark.operators.shape import cast_declared, gather, scrub_null_token
from tidemark.operators.shape import dedup_within_file as drop_repeated
from tidemark.plans.ingest import ingest, landed, staging_table
from tidemark.plans.ingest import pending_files as files_to_do
from tidemark.sources import delimited, listing, storage, structured, tasks
from tidemark.sources.delimited import LOCATION
from tidemark.workloads.bench import CYCLE, DATE, TIME, Bench, query


def _customers(bench: Bench) -> DataFrame:
    return bench.read("customer").select(
        "c_custkey",
        "c_name",
        "c_nationkey",
        F.col("c_acctbal").cast("decimal(18,2)").alias("c_acctbal"),
        "c_mktsegment",
    )


@query(
    """SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, CAST(c_nationkey AS VARCHAR) AS c_nationkey,
              CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS VARCHAR) AS c_acctbal, c_mktsegment
       FROM customer"""
)
def csv_header_strings(bench: Bench) -> DataFrame:
    """Two generations of files whose headers differ in order and spelling."""
    rows = _customers(bench).withColumn("owing", F.col("c_acctbal") < 0)
    old = rows.where("owing").select(
        F.col("c_custkey").alias("C CustKey"),
        F.col("c_name").alias("C-Name"),
        F.col("c_acctbal").alias("c_acctbal"),
        F.col("c_nationkey").alias("c_nationkey "),
        F.col("c_mktsegment").alias("C.MktSegment"),
    )
    new = rows.where("NOT owing").select("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")
    for name, part in (("old", old), ("new", new)):
        part.write.option("header", True).csv(f"{bench.root}/src/{name}")
    paths = storage.leaf_files(bench.spark, f"{bench.root}/src")
    return delimited.read_header_strings(bench.spark, paths).drop(LOCATION)


PART_DOC = [
    {"column_name": "P_PARTKEY", "column_data_type": "long", "data_format": ""},
    {"column_name": "P Name", "column_data_type": "string", "data_format": ""},
    {"column_name": "P_SIZE", "column_data_type": "integer", "data_format": ""},
    {"column_name": "P_RETAILPRICE", "column_data_type": "decimal", "data_format": "18,2"},
    {"column_name": "P_PRICE_DOUBLE", "column_data_type": "double", "data_format": ""},
]


@query(
    """SELECT p_partkey, p_name, p_size, CAST(p_retailprice AS DECIMAL(18,2)) AS p_retailprice,
              p_retailprice AS p_price_double FROM part"""
)
def csv_declared_schema(bench: Bench) -> DataFrame:
    rows = bench.read("part").select(
        "p_partkey", "p_name", "p_size", F.col("p_retailprice").cast("decimal(18,2)"), F.col("p_retailprice").alias("d")
    )
    rows.write.option("header", True).csv(f"{bench.root}/src")
    paths = storage.leaf_files(bench.spark, f"{bench.root}/src")
    return delimited.read_declared(bench.spark, paths, PART_DOC, header=True).drop(LOCATION)


@query("SELECT s_suppkey AS supplier_key, s_name AS supplier_name, s_nationkey AS nation FROM supplier")
def csv_headerless(bench: Bench) -> DataFrame:
    bench.read("supplier").select("s_suppkey", "s_name", "s_nationkey").write.csv(f"{bench.root}/src")
    doc = [
        {"column_name": "Supplier Key", "column_data_type": "long"},
        {"column_name": "Supplier Name", "column_data_type": "str"},
        {"column_name": "Nation", "column_data_type": "int"},
    ]
    paths = storage.leaf_files(bench.spark, f"{bench.root}/src")
    return delimited.read_declared(bench.spark, paths, doc, header=False).drop(LOCATION)


@query(
    """SELECT c_custkey, c_name, c_nationkey, CAST(c_acctbal AS DECIMAL(18,2)) AS c_acctbal, c_mktsegment
       FROM customer"""
)
def txt_delimited(bench: Bench) -> DataFrame:
    _customers(bench).write.option("sep", "|").csv(f"{bench.root}/src")
    doc = [
        {"column_name": "c_custkey", "column_data_type": "long"},
        {"column_name": "c_name", "column_data_type": "string"},
        {"column_name": "c_nationkey", "column_data_type": "int"},
        {"column_name": "c_acctbal", "column_data_type": "decimal", "data_format": "not a format"},
        {"column_name": "c_mktsegment", "column_data_type": "string"},
    ]
    paths = storage.leaf_files(bench.spark, f"{bench.root}/src")
    return delimited.read_declared(bench.spark, paths, doc, header=False, options={"delimiter": "|"}).drop(LOCATION)


@query("SELECT CAST(doc_id AS VARCHAR) AS doc_id, md5(text) AS text_md5, lang FROM documents")
def csv_multiline_escape(bench: Bench) -> DataFrame:
    """Whole documents with quotes and line breaks inside their fields."""
    rows = bench.read("documents").select("doc_id", "text", "lang")
    rows.write.options(
        header=True, escape='"', quoteAll=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    ).csv(f"{bench.root}/src")
    paths = storage.leaf_files(bench.spark, f"{bench.root}/src")
    options = {"multiline": "true", "escape": '"', "delimiter": ","}
    back = delimited.read_header_strings(bench.spark, paths, options)
    return back.select("doc_id", F.md5("text").alias("text_md5"), "lang")


@query(
    """SELECT l_orderkey AS line_order, CAST(l_linenumber AS BIGINT) AS line_number, l_suppkey AS line_supplier_key,
              a.kind AS amounts_kind, a.cents AS amounts_cents, f AS flags
       FROM lineitem,
            unnest([{'kind': 'price', 'cents': CAST(round(l_extendedprice * 100) AS BIGINT)},
                    {'kind': 'quantity', 'cents': CAST(round(l_quantity * 100) AS BIGINT)}]) AS x(a),
            unnest(CASE WHEN l_returnflag = 'R' THEN [NULL] ELSE [l_returnflag, l_linestatus] END) AS y(f)"""
)
def json_nested_flatten(bench: Bench) -> DataFrame:
    """A struct in a struct, two sibling arrays (their cross product), empty arrays."""

    def amount(kind: str, column: str):
        return F.struct(F.lit(kind).alias("kind"), F.round(F.col(column) * 100).cast("long").alias("cents"))

    docs = bench.read("lineitem").select(
        F.struct(
            F.col("l_orderkey").alias("line_order"),
            F.col("l_linenumber").alias("line_number"),
            F.struct(F.col("l_suppkey").alias("key")).alias("line_supplier"),
            F.array(amount("price", "l_extendedprice"), amount("quantity", "l_quantity")).alias("amounts"),
            F.when(F.col("l_returnflag") == "R", F.array().cast("array<string>"))
            .otherwise(F.array("l_returnflag", "l_linestatus"))
            .alias("flags"),
        ).alias("doc")
    )
    docs.write.json(f"{bench.root}/src")
    paths = storage.leaf_files(bench.spark, f"{bench.root}/src")
    return structured.read_json(bench.spark, paths).drop(LOCATION)


EVENT_DOC = {
    "event_id": "long",
    "ts": "timestamp",
    "user_id": "int",
    "kind": {"name": "string", "price": "decimal|12,2"},
    "tags": ["string"],
    "lines": [{"k": "int"}],
}


@query(
    """SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, CAST(user_id AS INTEGER) AS user_id,
              '["' || event_type || '"]' AS tags, event_type AS name, CAST(value AS DECIMAL(12,2)) AS price,
              CAST(json_extract(props, '$.k') AS INTEGER) AS lines_k FROM events"""
)
def json_declared_schema(bench: Bench) -> DataFrame:
    """Declared types: no inference pass, scalar arrays stay JSON text, dates stay text."""
    docs = bench.read("events").select(
        "event_id",
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("ts"),
        "user_id",
        F.struct(F.col("event_type").alias("name"), F.col("value").cast("decimal(12,2)").alias("price")).alias("kind"),
        F.array("event_type").alias("tags"),
        F.array(F.from_json("props", "k int")).alias("lines"),
    )
    docs.write.json(f"{bench.root}/src")
    paths = storage.leaf_files(bench.spark, f"{bench.root}/src")
    return structured.read_json(bench.spark, paths, schema_doc=EVENT_DOC).drop(LOCATION)


@query(
    f"""SELECT s_suppkey, s_name, s_nationkey, s_acctbal, '{TIME}' AS processed_time, '{DATE}' AS execution_date,
               '{CYCLE}' AS execution_cycle_id FROM supplier"""
)
def parquet_ingest(bench: Bench) -> DataFrame:
    bench.read("supplier").write.parquet(f"{bench.root}/src")
    spec = bench.spec(file_type="parquet", mask="*.parquet", options={})
    ingest(bench.spark, spec, bench.run, bench.ledgers)
    return landed(staging_table(bench.spark, spec), bench.run).drop(LOCATION, "source_file_name")


@query(
    """SELECT s_suppkey, s_name, CASE WHEN s_nationkey < 10 THEN CAST(s_nationkey AS VARCHAR) ELSE 'nation ' || s_nationkey END AS s_nationkey,
              CASE WHEN s_nationkey < 10 THEN NULL ELSE s_acctbal END AS s_acctbal FROM supplier"""
)
def parquet_changed_types(bench: Bench) -> DataFrame:
    """An older delivery with numbers where the newer one has text, and without one of its columns."""
    rows = bench.read("supplier")
    nation = F.col("s_nationkey")
    older = rows.where(nation < 10).select(F.col("s_suppkey").cast("int"), "s_name", "s_nationkey")
    newer = rows.where(nation >= 10).select("s_suppkey", "s_name", F.concat(F.lit("nation "), nation).alias("s_nationkey"), "s_acctbal")
    for name, part in (("1_older", older), ("2_newer", newer)):
        made = f"{bench.root}/made/{name}"
        part.write.parquet(made)
        files = [p for p in storage.leaf_files(bench.spark, made) if p.endswith(".parquet")]
        storage.move(bench.spark, [(p, f"{bench.root}/src/{name}_{n}.parquet") for n, p in enumerate(files)])
    spec = bench.spec(file_type="parquet", mask="*.parquet", options={})
    ingest(bench.spark, spec, bench.run, bench.ledgers)
    return staging_table(bench.spark, spec).read().select("s_suppkey", "s_name", "s_nationkey", "s_acctbal")


@query(
    """SELECT CASE WHEN o_orderstatus = 'F' THEN 'loaded' ELSE 'pending' END AS state, o_orderkey FROM orders"""
)
def pending_real_folders(bench: Bench) -> DataFrame:
    """Folders of source files, one of them loaded, and files without bytes among them: what is pending has all the other rows."""
    rows = bench.orders()
    spec = bench.spec(source_prefixes=[f"{bench.root}/src/split=F", f"{bench.root}/src/split=O", f"{bench.root}/src/split=P"])
    bench.export(rows, "o_orderstatus", header=True)
    for status in "FOP":
        storage.write_text(bench.spark, f"{bench.root}/src/split={status}/empty.csv", "")
    ingest(bench.spark, replace(spec, source_prefixes=f"{bench.root}/src/split=F"), bench.run, bench.ledgers)
    todo = files_to_do(bench.spark, spec, bench.run, bench.ledgers.file_log)
    paths = listing.checked_paths(todo)
    assert sum(p.endswith("/empty.csv") for p in paths) == 2
    waiting = delimited.read_header_strings(bench.spark, paths)
    loaded = staging_table(bench.spark, spec).read()
    states = [rows.select(F.lit(state).alias("state"), F.col("o_orderkey").cast("long")) for state, rows in (("loaded", loaded), ("pending", waiting))]
    return states[0].unionByName(states[1])


def _workbooks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One workbook per batch of rows, with the least a workbook needs. Data starts at B3."""
    names = ["C CustKey", "C Name", "C Acctbal", "Owing", "Note"]
    for batch in batches:
        rows = ["".join(f'<c r="{c}3" t="inlineStr"><is><t>{n}</t></is></c>' for c, n in zip("BCDEF", names))]
        for n, (key, name, balance) in enumerate(zip(batch.c_custkey, batch.c_name, batch.c_acctbal), start=4):
            owing = int(balance < 0)
            rows.append(
                f'<c r="B{n}"><v>{key}</v></c><c r="C{n}" t="inlineStr"><is><t>{escape(name)}</t></is></c>'
                f'<c r="D{n}"><v>{balance!r}</v></c><c r="E{n}" t="b"><v>{owing}</v></c>'
            )
        body = "".join(f'<row r="{n}">{r}</row>' for n, r in enumerate(rows, start=3))
        main = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
        rels = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
        content = io.BytesIO()
        with zipfile.ZipFile(content, "w", zipfile.ZIP_DEFLATED) as book:
            book.writestr(
                "xl/workbook.xml",
                f'<workbook xmlns="{main}" xmlns:r="{rels}"><sheets>'
                '<sheet name="Sheet1" sheetId="1" r:id="rId1"/></sheets></workbook>',
            )
            book.writestr(
                "xl/_rels/workbook.xml.rels",
                '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">'
                '<Relationship Id="rId1" Target="worksheets/sheet1.xml"/></Relationships>',
            )
            book.writestr(
                "xl/worksheets/sheet1.xml", f'<worksheet xmlns="{main}"><sheetData>{body}</sheetData></worksheet>'
            )
        yield pd.DataFrame({"path": [f"file:/books/{int(batch.c_custkey.min()):012d}.xlsx"], "content": [content.getvalue()]})


@query(
    """SELECT CAST(c_custkey AS DOUBLE) AS c_custkey, c_name, c_acctbal, c_acctbal < 0 AS owing, '' AS note
       FROM customer"""
)
def excel_sheet(bench: Bench) -> DataFrame:
    """All customers as workbook files, one per batch of rows, loaded by a run that infers their types."""
    folder = f"{bench.root}/src"
    system, place = tasks.opened(folder)
    system.create_dir(place)

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for books in _workbooks(batches):
            for path, content in zip(books["path"], books["content"]):
                own, target = tasks.opened(f"{folder}/{path.rsplit('/', 1)[-1]}")
                with own.open_output_stream(target) as out:
                    out.write(content)
            yield books[["path"]]

    bench.read("customer").select("c_custkey", "c_name", "c_acctbal").mapInPandas(write, "path string").count()
    spec = bench.spec(file_type="excel", sheet="Sheet1", start_cell="B3", options={})
    ingest(bench.spark, spec, bench.run, bench.ledgers)
    return landed(staging_table(bench.spark, spec), bench.run).select("c_custkey", "c_name", "c_acctbal", "owing", "note")


@query(
    """SELECT c_custkey, o_orderkey AS keys, NULL AS status, NULL AS price FROM customer JOIN orders ON o_custkey = c_custkey
       UNION ALL
       SELECT c_custkey, NULL, o_orderstatus, CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE)
       FROM customer JOIN orders ON o_custkey = c_custkey
       UNION ALL
       SELECT c_custkey, NULL, NULL, NULL FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)"""
)
def json_arrays_apart(bench: Bench) -> DataFrame:
    """Customers as documents with two arrays side by side: as many rows as both have elements together."""
    price = F.col("o_totalprice").cast("decimal(18,2)").cast("double").alias("price")
    mine = bench.read("orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.collect_list("o_orderkey").alias("keys"),
        F.collect_list(F.struct(F.col("o_orderstatus").alias("status"), price)).alias("items"),
    )
    bench.read("customer").select("c_custkey").join(mine, "c_custkey", "left").write.json(f"{bench.root}/src")
    paths = storage.leaf_files(bench.spark, f"{bench.root}/src")
    return structured.read_json(bench.spark, paths, arrays="apart").drop(LOCATION)


@query(
    """SELECT o_orderkey, o_custkey, o_orderstatus, strftime(o_orderdate, '%Y%m') AS execution_date FROM orders"""
)
def partitioned_scan(bench: Bench) -> DataFrame:
    """Partition values come back as the strings in the folder names, not as numbers."""
    rows = bench.read("orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", F.date_format("o_orderdate", "yyyyMM").alias("execution_date")
    )
    gather(rows, "execution_date", "o_orderstatus").write.partitionBy("execution_date", "o_orderstatus").parquet(f"{bench.root}/scan")
    return structured.scan_partitioned(
        bench.spark, f"{bench.root}/scan", ["execution_date", "o_orderstatus"]
    ).select(
        "o_orderkey", "o_custkey", "o_orderstatus", "execution_date"
    )


# File names made from order data: real dates, and digit runs that are dates only by chance.
NAMES = {
    "daily": "'sales_' || date_format(o_orderdate, 'yyyyMMdd') || '.csv'",
    "chance": "'sales_' || lpad(cast(o_orderkey * 7919 % 100000000 AS string), 8, '0') || '.csv'",
    "dashed": "'p_' || date_format(o_orderdate, 'yyyy-MM-dd') || '_full.txt'",
    "monthly": "lower(o_orderstatus) || '_' || date_format(o_orderdate, 'yyyyMM') || '.csv'",
    "quarter": "date_format(o_orderdate, 'yyyy') || 'Q' || (o_custkey % 6) || '.csv'",
}
NAMES_SQL = """
    'sales_' || strftime(o_orderdate, '%Y%m%d') || '.csv' AS daily,
    'sales_' || lpad(CAST(o_orderkey * 7919 % 100000000 AS VARCHAR), 8, '0') || '.csv' AS chance,
    'p_' || strftime(o_orderdate, '%Y-%m-%d') || '_full.txt' AS dashed,
    lower(o_orderstatus) || '_' || strftime(o_orderdate, '%Y%m') || '.csv' AS monthly,
    strftime(o_orderdate, '%Y') || 'Q' || CAST(o_custkey % 6 AS VARCHAR) || '.csv' AS quarter"""
MASKS = {
    "daily_exact": ("daily", "sales_YYYYMMDD.csv"),
    "daily_short": ("daily", "sale_YYYYMMDD.csv"),
    "chance_exact": ("chance", "sales_YYYYMMDD.csv"),
    "chance_glob": ("chance", "*YYYYMMDD*"),
    "chance_stamped": ("chance", "*sales_YYYYMMDD.csv"),
    "dashed_glob": ("dashed", "p_YYYY-MM-DD*"),
    "dashed_wrong_end": ("dashed", "*YYYY-MM-DD.csv"),
    "monthly_exact": ("monthly", "p_YYYYMM.csv"),
    "monthly_glob": ("monthly", "f_YYYYMM*"),
    "monthly_reversed": ("monthly", "*MMYYYY.csv"),
    "quarter_exact": ("quarter", "YYYYQ#.csv"),
    "plain_regex": ("quarter", "199[5-8]Q.*"),
}


@query(
    rf"""WITH n AS (SELECT o_orderkey, {NAMES_SQL} FROM orders)
    SELECT o_orderkey,
      length(daily) = 18 AND regexp_matches(daily, '^(?:sales_[0-9]{{4}}(1[0-2]|0[1-9])(3[01]|[12][0-9]|0[1-9]).csv)') AS daily_exact,
      length(daily) = 17 AS daily_short,
      length(chance) = 18 AND regexp_matches(chance, '^(?:sales_[0-9]{{4}}(1[0-2]|0[1-9])(3[01]|[12][0-9]|0[1-9]).csv)') AS chance_exact,
      false AS chance_glob,
      chance LIKE '%csv' AND regexp_matches(chance, 'sales_[0-9]{{4}}(1[0-2]|0[1-9])(3[01]|[12][0-9]|0[1-9]).csv') AS chance_stamped,
      regexp_matches(dashed, 'p_[0-9]{{4}}-(1[0-2]|0[1-9])-(3[01]|[12][0-9]|0[1-9])') AS dashed_glob,
      dashed LIKE '%csv' AS dashed_wrong_end,
      length(monthly) = 12 AND starts_with(monthly, 'p_') AND regexp_matches(monthly, '[0-9]{{4}}(1[0-2]|0[1-9])') AS monthly_exact,
      starts_with(monthly, 'f_') AND regexp_matches(monthly, '[0-9]{{4}}(1[0-2]|0[1-9])') AS monthly_glob,
      monthly LIKE '%csv' AND regexp_matches(monthly, '(1[0-2]|0[1-9])[0-9]{{4}}') AS monthly_reversed,
      length(quarter) = 10 AND regexp_matches(quarter, '[0-9]{{4}}Q[1-4]') AS quarter_exact,
      regexp_matches(quarter, '^(?:199[5-8]Q.*)') AS plain_regex
    FROM n"""
)
def filename_masks(bench: Bench) -> DataFrame:
    named = bench.read("orders").select("o_orderkey", *[F.expr(c).alias(n) for n, c in NAMES.items()])
    tests = [masks.mask_matches(F.col(name), mask).alias(k) for k, (name, mask) in MASKS.items()]
    return named.select("o_orderkey", *tests)


@query(
    """WITH n AS (SELECT o_orderkey, 'wk_' || lpad(CAST(o_orderkey * 7919 % 1000000 AS VARCHAR), 6, '0') || '.csv' AS name
                  FROM orders)
       SELECT o_orderkey, name, length(name) = 13 AND regexp_matches(name, '[0-9]{4}(0[1-9]|[1-4][0-9]|5[0-3])') AS weekly,
              regexp_matches(name, '^wk_[0-9]*7\\.csv$') AS own_rule FROM n"""
)
def filename_masks_custom(bench: Bench) -> DataFrame:
    number = F.lpad((F.col("o_orderkey") * 7919 % 1000000).cast("string"), 6, "0")
    named = bench.read("orders").select("o_orderkey", F.concat(F.lit("wk_"), number, F.lit(".csv")).alias("name"))
    return named.select(
        "o_orderkey",
        "name",
        masks.custom_mask_matches(F.col("name"), "wk_YYYYWW.csv").alias("weekly"),
        masks.custom_mask_matches(F.col("name"), "any", lambda n, mask: n.rlike(r"^wk_[0-9]*7\.csv$")).alias("own_rule"),
    )


@query(
    r"""SELECT doc_id, url, NOT regexp_matches(url, '[@!%^&*<>?/\\|}{~:]') AS whole_url_legal,
               NOT regexp_matches(tail, '[@!%^&*<>?/\\|}{~:]') AS tail_legal
        FROM (SELECT page_id AS doc_id, url, list_last(string_split(url, '/')) AS tail FROM pages)"""
)
def filename_legality(bench: Bench) -> DataFrame:
    return bench.read("pages").select(
        F.col("page_id").alias("doc_id"),
        "url",
        masks.legal_name(F.col("url")).alias("whole_url_legal"),
        masks.legal_name(storage.base_name(F.col("url"))).alias("tail_legal"),
    )


def _order_files(bench: Bench) -> DataFrame:
    """Every order as a listed file, in a folder per priority."""
    return bench.read("orders").select(
        F.concat(F.lit("/in/"), F.substring("o_orderpriority", 1, 1), F.lit("/")).alias("input_location_prefix"),
        F.concat(F.lit("c_"), F.col("o_custkey"), F.lit(".csv")).alias("file_name"),
        "o_orderstatus",
        "o_orderkey",
    )


@query(
    """SELECT DISTINCT 'c_' || o_custkey || '.csv' AS file_name FROM orders
       WHERE 'c_' || o_custkey || '.csv' NOT IN
             (SELECT 'c_' || o_custkey || '.csv' FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority <> '1-URGENT')"""
)
def pending_files(bench: Bench) -> DataFrame:
    """A flat folder: names alone tell files apart. Urgent ones are forced again."""
    files = _order_files(bench)
    done = files.where("o_orderstatus = 'F'")
    urgent = files.where("input_location_prefix = '/in/1/'")
    forced = urgent.select("file_name", "input_location_prefix").distinct()
    return listing.pending(files, done, ["file_name"], forced).select("file_name").distinct()


@query(
    """WITH f AS (SELECT DISTINCT '/in/' || substr(o_orderpriority, 1, 1) || '/' AS input_location_prefix,
                         'c_' || o_custkey || '.csv' AS file_name, o_orderstatus FROM orders)
       SELECT DISTINCT input_location_prefix, file_name FROM f a
       WHERE NOT EXISTS (SELECT 1 FROM f d WHERE d.o_orderstatus = 'F'
                         AND d.file_name = a.file_name AND d.input_location_prefix = a.input_location_prefix)"""
)
def pending_files_multi(bench: Bench) -> DataFrame:
    """Several folders: the same name in two of them is two files."""
    files = _order_files(bench)
    done = files.where("o_orderstatus = 'F'")
    identity = ["input_location_prefix", "file_name"]
    return listing.pending(files, done, identity).select(*identity).distinct()


@query(
    """SELECT c_custkey AS cust_key, c_name AS cust_name, c_nationkey AS "nation#", c_mktsegment AS mkt_segment
       FROM customer"""
)
def header_standardize(bench: Bench) -> DataFrame:
    odd = _customers(bench).select(
        F.col("c_custkey").alias("Cust Key"),
        F.col("c_name").alias(" Cust.Name "),
        F.col("c_nationkey").alias("Nation#"),
        F.col("c_mktsegment").alias("(Mkt-Segment)"),
    )
    return standardize_names(odd)


@query("SELECT * FROM part")
def lowercase_columns(bench: Bench) -> DataFrame:
    parts = bench.read("part")
    return lowercase_names(parts.toDF(*[c.upper() for c in parts.columns]))


LISTED = """l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_extendedprice l_discount l_tax l_returnflag l_linestatus
            l_shipdate""".split()
LISTED_TYPES = dict(zip(LISTED, "bigint bigint bigint int double double double double string string timestamp_ntz".split()))


@query(
    " UNION ALL ".join(
        f"SELECT '{c}' AS name, '{t}' AS data_type, count({c}) AS filled FROM lineitem" for c, t in LISTED_TYPES.items()
    )
)
def column_listing(bench: Bench) -> DataFrame:
    """Names and types of the columns, with how many rows fill each: one pass."""
    rows = bench.read("lineitem")
    described = [
        F.struct(F.lit(c["name"]).alias("name"), F.lit(c["data_type"]).alias("data_type"), F.count(c["name"]).alias("filled"))
        for c in columns_of(rows)
    ]
    return rows.agg(F.array(*described).alias("columns")).select(F.inline("columns"))


@query(
    """SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN '' WHEN o_orderstatus = 'F' THEN 'NULL' END AS note,
              CASE WHEN o_orderpriority = '5-LOW' THEN '' ELSE o_orderpriority END AS priority FROM orders"""
)
def null_token_scrub(bench: Bench) -> DataFrame:
    return scrub_null_token(
        bench.read("orders").select(
            "o_orderkey",
            F.expr("CASE WHEN o_orderstatus = 'P' THEN 'null' WHEN o_orderstatus = 'F' THEN 'NULL' END AS note"),
            F.expr("CASE WHEN o_orderpriority = '5-LOW' THEN 'null' ELSE o_orderpriority END AS priority"),
        )
    )


DATE_DOC = [
    {"column_name": "plain", "column_data_type": "date", "data_format": ""},
    {"column_name": "shouted", "column_data_type": "date", "data_format": "YYYY-MM-DD"},
    {"column_name": "slashed", "column_data_type": "date", "data_format": "dd/MM/yyyy"},
    {"column_name": "packed", "column_data_type": "date", "data_format": "yyyyMMdd"},
]


@query(
    """SELECT o_orderkey, CAST(o_orderdate AS DATE) AS plain,
              CASE WHEN o_orderstatus <> 'F' THEN CAST(o_orderdate AS DATE) END AS shouted,
              CAST(try_strptime(CAST(o_orderkey % 40 AS VARCHAR) || '/07/2024', '%d/%m/%Y') AS DATE) AS slashed_check,
              CASE WHEN o_orderstatus <> 'P' THEN CAST(o_orderdate AS DATE) END AS packed FROM orders"""
)
def date_format_cast(bench: Bench) -> DataFrame:
    """Formats of all kinds; text that is no date becomes NULL."""
    texts = bench.read("orders").select(
        "o_orderkey",
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("plain"),
        F.expr("CASE WHEN o_orderstatus = 'F' THEN 'unknown' ELSE date_format(o_orderdate, 'yyyy-MM-dd') END AS shouted"),
        F.expr("concat(lpad(cast(o_orderkey % 40 AS string), 2, '0'), '/07/2024') AS slashed"),
        F.expr("CASE WHEN o_orderstatus = 'P' THEN '2024-13-45' ELSE date_format(o_orderdate, 'yyyyMMdd') END AS packed"),
    )
    return cast_declared(texts, DATE_DOC).withColumnRenamed("slashed", "slashed_check")


STAMP_DOC = [
    {"column_name": "plain", "column_data_type": "timestamp", "data_format": ""},
    {"column_name": "millis", "column_data_type": "timestamp", "data_format": "YYYY/MM/DD HH:mm:ss.SSS"},
    {"column_name": "seconds", "column_data_type": "timestamp", "data_format": "ddMMyyyyHHmmss"},
]


@query(
    """SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS plain, strftime(ts, '%Y-%m-%d %H:%M:%S.%g') AS millis,
              CASE WHEN event_type <> 'error' THEN strftime(ts, '%Y-%m-%d %H:%M:%S') END AS seconds FROM events"""
)
def timestamp_format_cast(bench: Bench) -> DataFrame:
    texts = bench.read("events").select(
        "event_id",
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("plain"),
        F.date_format("ts", "yyyy/MM/dd HH:mm:ss.SSS").alias("millis"),
        F.expr("CASE WHEN event_type = 'error' THEN 'n/a' ELSE date_format(ts, 'ddMMyyyyHHmmss') END AS seconds"),
    )
    return cast_declared(texts, STAMP_DOC).select(
        "event_id",
        F.date_format("plain", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("plain"),
        F.date_format("millis", "yyyy-MM-dd HH:mm:ss.SSS").alias("millis"),
        F.date_format("seconds", "yyyy-MM-dd HH:mm:ss").alias("seconds"),
    )


@query(
    """SELECT DISTINCT l_suppkey, l_quantity, l_linestatus, l_returnflag AS source_file_location FROM lineitem"""
)
def dedup_within_file(bench: Bench) -> DataFrame:
    """Equal rows of one file collapse, equal rows of two files both stay."""
    return drop_repeated(
        bench.read("lineitem").select(
            "l_suppkey", "l_quantity", "l_linestatus", F.col("l_returnflag").alias("source_file_location")
        )
    )


@query("SELECT DISTINCT l_partkey, l_returnflag, l_linestatus FROM lineitem")
def distinct_rows(bench: Bench) -> DataFrame:
    return bench.read("lineitem").select("l_partkey", "l_returnflag", "l_linestatus").distinct()
