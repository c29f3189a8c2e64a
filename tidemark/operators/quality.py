"""Data-quality rules, the per-file gate, the quality log and its report."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.names import quoted

FAILED = "__failed"

# Keys of a unique rule that are salted: never more than this many, so their table may be broadcast.
MOST_HOT = 10_000

# Ledger vocabulary.
INGESTED = "Ingested"
INGESTED_VALID = "Ingested Valid Data"
SKIPPED = "File Skipped"

QUALITY_LOG = (
    "dataset_name string, qc_id string, criticality string, pre_ingestion_dqm_file string, "
    "total_record_count bigint, validated_record_count bigint, errored_record_count bigint, message string, "
    "error_percentage double, threshold double, qc_passed_flag string, ingestion_cycle_id string"
)
# Beside them, the file's folder: thousands of files may share a name.
LOCATED_QUALITY_LOG = f"{QUALITY_LOG}, input_location_prefix string"


@dataclass(frozen=True)
class Rule:
    """A check on rows. A row is good only where ``condition`` is true, so NULL is bad.

    A rule with ``unique_columns`` instead holds for rows whose key occurs once in their
    file; rows with a NULL in the key hold.
    """

    qc_id: str
    condition: str | None = None
    criticality: str = "critical"
    message: str = ""
    threshold: float = 0.0
    unique_columns: tuple[str, ...] = field(default=())

    @property
    def critical(self) -> bool:
        return self.criticality.lower() == "critical"


def _sql_text(value) -> str:
    return "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"


def not_null(qc_id: str, column: str, **kw) -> Rule:
    return Rule(qc_id, f"`{column}` IS NOT NULL", **kw)


def matches(qc_id: str, column: str, regex: str, **kw) -> Rule:
    return Rule(qc_id, f"`{column}` RLIKE {_sql_text(regex)}", **kw)


def in_list(qc_id: str, column: str, values: Sequence, **kw) -> Rule:
    items = ", ".join(_sql_text(v) if isinstance(v, str) else str(v) for v in values)
    return Rule(qc_id, f"`{column}` IN ({items})", **kw)


def in_range(qc_id: str, column: str, low, high, **kw) -> Rule:
    return Rule(qc_id, f"`{column}` BETWEEN {low} AND {high}", **kw)


def unique(qc_id: str, *columns: str, **kw) -> Rule:
    return Rule(qc_id, unique_columns=columns, **kw)


def rules_from_document(doc: Sequence[Mapping]) -> list[Rule]:
    """Rules from a JSON list of ``{qc_id, kind, column(s), ...}`` entries.

    Kinds: ``not_null``, ``matches`` (regex), ``in_list`` (values), ``in_range`` (low,
    high), ``unique`` (columns), ``expression`` (condition).
    """
    return [_rule(entry) for entry in doc]


def _rule(entry: Mapping) -> Rule:
    qc_id = entry["qc_id"]
    common = {k: entry[k] for k in ("criticality", "message", "threshold") if k in entry}
    match entry["kind"]:
        case "not_null":
            return not_null(qc_id, entry["column"], **common)
        case "matches":
            return matches(qc_id, entry["column"], entry["regex"], **common)
        case "in_list":
            return in_list(qc_id, entry["column"], entry["values"], **common)
        case "in_range":
            return in_range(qc_id, entry["column"], entry["low"], entry["high"], **common)
        case "unique":
            return unique(qc_id, *entry["columns"], **common)
        case "expression":
            return Rule(qc_id, entry["condition"], **common)
    raise ValueError(f"rule {qc_id!r} has the unknown kind {entry['kind']!r}")


def flag_failures(
    df: DataFrame, rules: Sequence[Rule], file_column: str, salts: int = 64, hot_rows: int = 1_000_000
) -> DataFrame:
    """Add which rules each row breaks, as one struct of booleans.

    Plain rules add no shuffle. A unique rule counts keys with map-side combine and
    joins the repeated keys back, salting hot keys so that one key spreads over tasks.
    """
    broken, helpers = [], []
    for n, rule in enumerate(rules):
        if rule.unique_columns:
            flag = f"__repeated_{n}"
            df = _mark_repeated(df, [file_column, *rule.unique_columns], flag, salts, hot_rows)
            helpers.append(flag)
            bad = F.col(flag).isNotNull()
        else:
            bad = ~F.coalesce(F.expr(rule.condition), F.lit(False))
        broken.append(bad.alias(f"rule_{n}"))
    return df.withColumn(FAILED, F.struct(*broken)).drop(*helpers)


def _valid(flagged: DataFrame) -> Column:
    return ~reduce(Column.__or__, [F.col(f"{FAILED}.{name}") for name in flagged.schema[FAILED].dataType.names])


def _mark_repeated(df: DataFrame, keys: Sequence[str], flag: str, salts: int, hot_rows: int) -> DataFrame:
    """Set ``flag`` on rows whose key occurs more than once.

    Keys of at least ``hot_rows`` rows, or a ``1 / MOST_HOT`` share of all repeated rows if that is more,
    are spread over ``salts`` join keys. So there are ``MOST_HOT`` of them at most, and they are broadcast
    to salt the rows. Rows with a NULL in the key match nothing; they are spread over all salts.
    """
    named = [f"__key_{i}" for i in range(len(keys))]
    no_null = reduce(Column.__and__, [quoted(k).isNotNull() for k in keys])
    counted = (
        df.where(no_null)
        .groupBy(*[quoted(k).alias(n) for k, n in zip(keys, named)])
        .count()
        .where(F.col("count") > 1)
    )
    bound = counted.agg((F.coalesce(F.sum("count"), F.lit(0)) / MOST_HOT).alias("__bound"))
    counted = counted.crossJoin(F.broadcast(bound))  # one row
    is_hot = F.col("count") >= F.greatest(F.lit(float(hot_rows)), F.col("__bound"))
    last_salt = F.when(is_hot, salts - 1).otherwise(0)
    repeated = counted.select(
        *named, F.explode(F.sequence(F.lit(0), last_salt)).alias("__key_salt"), F.lit(True).alias(flag)
    )
    hot = counted.where(is_hot).select(*[F.col(n).alias(f"{n}_hot") for n in named], F.lit(True).alias("__hot"))
    same_hot = [quoted(k) == F.col(f"{n}_hot") for k, n in zip(keys, named)]
    spread = F.pmod(F.monotonically_increasing_id(), F.lit(salts))
    salt = F.when(F.col("__hot") | ~no_null, spread).otherwise(0).cast("int")
    salted = df.join(F.broadcast(hot), reduce(Column.__and__, same_hot), "left").withColumn("__salt", salt)
    same = [quoted(k) == F.col(n) for k, n in zip(keys, named)] + [F.col("__salt") == F.col("__key_salt")]
    marked = salted.join(repeated, reduce(Column.__and__, same), "left")
    return marked.drop("__salt", "__key_salt", "__hot", *named, *[f"{n}_hot" for n in named])


def rule_totals(flagged: DataFrame, rules: Sequence[Rule], file_column: str | None) -> DataFrame:
    """Rows, valid rows and failures per rule: one aggregate, one row per file (or one in all)."""
    sums = [F.count_if(F.col(f"{FAILED}.rule_{i}")).alias(f"errors_{i}") for i in range(len(rules))]
    aggregates = [
        F.count(F.lit(1)).alias("total_records"),
        F.count_if(_valid(flagged)).alias("valid_records"),
        *sums,
    ]
    by = [quoted(file_column).alias("gated_file")] if file_column else [F.lit(None).cast("string").alias("gated_file")]
    totals = flagged.groupBy(*by).agg(*aggregates) if file_column else flagged.agg(*aggregates).select(*by, "*")
    failed = [_percentage(i) > r.threshold for i, r in enumerate(rules)]
    critical = [f for f, r in zip(failed, rules) if r.critical]
    return totals.select(
        "*", _count_true(failed).alias("failed_checks"), _count_true(critical).alias("critical_failed_checks")
    )


def _percentage(i: int) -> Column:
    return F.when(F.col("total_records") > 0, 100.0 * F.col(f"errors_{i}") / F.col("total_records")).otherwise(0.0)


def _count_true(flags: Sequence[Column]) -> Column:
    return reduce(Column.__add__, [F.when(f, 1).otherwise(0) for f in flags], F.lit(0))


def route(
    totals: DataFrame, skip_file: bool = False, skip_on_non_critical: bool = False, write_valid: bool = False
) -> DataFrame:
    """Decide per file: skip it, keep its valid rows, or keep all of its rows."""
    critical, any_failed = F.col("critical_failed_checks") > 0, F.col("failed_checks") > 0
    skip = F.col("valid_records") == 0
    if skip_file:
        skip = skip | critical
        if skip_on_non_critical:
            skip = skip | any_failed
    decision = F.when(skip, SKIPPED)
    if write_valid:
        decision = decision.when(critical, INGESTED_VALID)
    return totals.withColumn("ingestion_status", decision.otherwise(INGESTED))


def admitted(flagged: DataFrame, decisions: DataFrame, file_column: str) -> DataFrame:
    """Rows that pass the gate, without the failure column.

    Only files with a verdict other than "keep all" are joined in. Spark chooses the join by their
    size: few are broadcast, and for many the adaptive skew join splits the partition of a hot file.
    """
    exceptions = decisions.where(F.col("ingestion_status") != INGESTED).select(
        "gated_file", F.col("ingestion_status").alias("__status")
    )
    joined = flagged.join(exceptions, quoted(file_column) == F.col("gated_file"), "left")
    kept = F.col("__status").isNull() | ((F.col("__status") == INGESTED_VALID) & _valid(flagged))
    return joined.where(kept).drop("gated_file", "__status", FAILED)


def quality_log(
    totals: DataFrame,
    rules: Sequence[Rule],
    dataset: str,
    cycle_id: str,
    file_name: Column,
    folder: Column | None = None,
) -> DataFrame:
    """One log row per file and rule. ``folder``, where given, tells files of one name apart in a last column."""
    located = [] if folder is None else [F.col("folder").alias("input_location_prefix")]
    folder = F.lit(None).cast("string") if folder is None else folder
    checks = F.array(
        *[
            F.struct(
                F.lit(r.qc_id).alias("qc_id"),
                F.lit(r.criticality).alias("criticality"),
                F.lit(r.message).alias("message"),
                F.lit(float(r.threshold)).alias("threshold"),
                F.col(f"errors_{i}").alias("errors"),
                _percentage(i).alias("percentage"),
            )
            for i, r in enumerate(rules)
        ]
    )
    exploded = totals.select(
        file_name.alias("file"), folder.alias("folder"), "total_records", F.explode(checks).alias("check")
    )
    return exploded.select(
        F.lit(dataset).alias("dataset_name"),
        "check.qc_id",
        "check.criticality",
        F.col("file").alias("pre_ingestion_dqm_file"),
        F.col("total_records").alias("total_record_count"),
        (F.col("total_records") - F.col("check.errors")).alias("validated_record_count"),
        F.col("check.errors").alias("errored_record_count"),
        "check.message",
        F.round("check.percentage", 2).alias("error_percentage"),
        "check.threshold",
        F.when(F.col("check.percentage") <= F.col("check.threshold"), "Y").otherwise("N").alias("qc_passed_flag"),
        F.lit(cycle_id).alias("ingestion_cycle_id"),
        *located,
    )


def post_load_log(rows: DataFrame, rules: Sequence[Rule], dataset: str, cycle_id: str, scope: str) -> DataFrame:
    """The same rules over a landed partition as a whole.

    Unique rules still look inside one source file where the rows name it.
    """
    file_column = next((c for c in ("source_file_location", "source_file_name") if c in rows.columns), "__scope")
    if file_column == "__scope":
        rows = rows.withColumn("__scope", F.lit(scope))
    totals = rule_totals(flag_failures(rows, rules, file_column), rules, None)
    return quality_log(totals, rules, dataset, cycle_id, F.lit(scope))


def report(quality: DataFrame, file_log: DataFrame, dataset: str, cycle_id: str) -> DataFrame:
    """Quality log of one run with what became of each file, ordered by file and check.

    Log rows and files that name no folder (those of older ledgers) match by name alone.
    """
    if "input_location_prefix" not in quality.columns:
        quality = quality.withColumn("input_location_prefix", F.lit(None).cast("string"))
    if "input_location_prefix" not in file_log.columns:
        file_log = file_log.withColumn("input_location_prefix", F.lit(""))
    checks = quality.where((F.col("dataset_name") == dataset) & (F.col("ingestion_cycle_id") == cycle_id))
    files = file_log.where((F.col("dataset_name") == dataset) & (F.col("execution_cycle_id") == cycle_id)).select(
        "dataset_name",
        "input_location_prefix",
        "file_name",
        "record_count",
        "execution_start_time",
        "execution_end_time",
        "ingestion_status",
    )
    q, f = checks.alias("q"), files.alias("f")
    same = (F.col("q.dataset_name") == F.col("f.dataset_name")) & (
        F.col("q.pre_ingestion_dqm_file") == F.col("f.file_name")
    )
    own, folder = F.col("q.input_location_prefix"), F.col("f.input_location_prefix")
    same = same & (own.isNull() | (folder == "") | (own == folder))
    threshold = F.when(F.col("q.threshold").isNull(), "").otherwise(F.concat(F.col("q.threshold"), F.lit("%")))
    percentage = F.concat(F.coalesce(F.col("q.error_percentage").cast("string"), F.lit("0")), F.lit("%"))
    return (
        q.join(f, same, "left")
        .select(
            "f.file_name",
            "q.qc_id",
            "q.message",
            "q.criticality",
            "q.total_record_count",
            "f.record_count",
            "q.validated_record_count",
            "q.errored_record_count",
            threshold.alias("threshold"),
            percentage.alias("error_percentage"),
            "f.execution_start_time",
            "f.execution_end_time",
            "q.qc_passed_flag",
            "f.ingestion_status",
        )
        .orderBy("file_name", "qc_id")
    )
