"""Partitioned Parquet tables: registration, landing, and the partition lifecycle."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.shape import align
from tidemark.session import many_open_writers, scratch_path
from tidemark.sources import storage

CYCLE_KEYS = ("execution_date", "execution_cycle_id")
STAGING_KEYS = (*CYCLE_KEYS, "source_file_name")
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"
DDL_BATCH = 200
#: Property of a table whose partitions are all in the folders of their names, as this module lays them out.
IN_FOLDERS = "tidemark.partitions.in.folders"
#: Values of a key that a scan takes as constants.
CONSTANTS = 20_000

def _literal(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _name(*parts: str) -> str:
    return ".".join("`" + p.strip("`").replace("`", "``") + "`" for p in parts)


@dataclass
class LakeTable:
    """An external Parquet table whose partition columns are all strings."""

    spark: SparkSession
    schema: str
    table: str
    location: str
    keys: tuple[str, ...] = CYCLE_KEYS

    def __post_init__(self) -> None:
        self.location = self.location.rstrip("/")
        self.keys = tuple(self.keys)

    @property
    def name(self) -> str:
        return _name(self.schema, self.table)

    def exists(self) -> bool:
        return self.spark.catalog.tableExists(self.name)

    def read(self) -> DataFrame:
        return self.spark.table(self.name)

    def data_schema(self) -> T.StructType:
        return T.StructType([f for f in self.read().schema.fields if f.name not in self.keys])

    # -- registration ---------------------------------------------------------

    def register(self, schema: T.StructType) -> str:
        """Create the table, extend it by columns that came in at the end, or recreate it when others changed: latest schema wins.

        Names, types and their order all count. Files stay where they are; older
        partitions are read by the new columns afterwards, NULL where they have none.
        """
        clash = {f.name.lower() for f in schema.fields} & set(self.keys)
        if clash:
            raise ValueError(f"data columns share a name with partition keys of {self.name}: {sorted(clash)}")
        created = "created"
        if self.exists():
            partitioned = tuple(c.name for c in self.spark.catalog.listColumns(self.name) if c.isPartition)
            if partitioned != self.keys:
                raise ValueError(f"{self.name} is partitioned by {partitioned}, not by {self.keys}")
            now = [(f.name.lower(), f.dataType.simpleString()) for f in self.data_schema().fields]
            new = [(f.name.lower(), f.dataType.simpleString()) for f in schema.fields]
            if now == new:
                self._overwrite_dynamically()
                return "unchanged"
            if now == new[: len(now)]:
                # Columns came in at the end: partitions stay registered, and no folder is looked at.
                added = [f"{_name(f.name)} {f.dataType.simpleString()}" for f in schema.fields[len(now) :]]
                self._overwrite_dynamically()
                self.spark.sql(f"ALTER TABLE {self.name} ADD COLUMNS ({', '.join(added)})")
                return "extended"
            self.spark.sql(f"DROP TABLE {self.name}")
            created = "recreated"
        columns = [f"{_name(f.name)} {f.dataType.simpleString()}" for f in schema.fields]
        columns += [f"{_name(k)} STRING" for k in self.keys]
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {_name(self.schema)}")
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.name} ({', '.join(columns)}) USING parquet "
            # On the table, not the session: overlapping jobs must not change it for each other.
            f"OPTIONS (partitionOverwriteMode 'dynamic') "
            f"PARTITIONED BY ({', '.join(_name(k) for k in self.keys)}) LOCATION {_literal(self.location)} "
            f"TBLPROPERTIES ('{IN_FOLDERS}' = 'true')"
        )
        if storage.exists(self.spark, self.location):
            self.repair()
        return created

    def _overwrite_dynamically(self) -> None:
        """Give a table that someone else created the option that :meth:`land` relies on."""
        described = self.spark.sql(f"DESCRIBE TABLE EXTENDED {self.name}")
        told = F.col("data_type").contains("partitionOverwriteMode=dynamic")
        if described.where((F.col("col_name") == "Storage Properties") & told).isEmpty():
            self.spark.sql(f"ALTER TABLE {self.name} SET SERDEPROPERTIES ('partitionOverwriteMode' = 'dynamic')")

    def repair(self) -> None:
        """Register every partition found on disk."""
        self.spark.sql(f"MSCK REPAIR TABLE {self.name}")

    def add_partition(self, spec: Mapping[str, str]) -> None:
        """Register one partition; one that is there already is left as it is."""
        values = ", ".join(f"{_name(k)}={_literal(spec[k])}" for k in self.keys)
        self.spark.sql(f"ALTER TABLE {self.name} ADD IF NOT EXISTS PARTITION ({values})")

    # -- landing --------------------------------------------------------------

    def land(self, df: DataFrame) -> None:
        """Write rows into the partitions their key columns name, replacing only those.

        No shuffle: each task writes the rows it read. The insert registers partitions.
        Overwriting is dynamic by the table's own option.
        """
        columns = T.StructType(self.data_schema().fields + [T.StructField(k, T.StringType()) for k in self.keys])
        # The rows' own session counts: a stream's batches have one to themselves.
        with many_open_writers(df.sparkSession):
            align(df, columns).write.insertInto(self.name, overwrite=True)
        # A stream's session does not tell this one that files were replaced.
        self.spark.catalog.refreshTable(self.name)

    def add_files(self, df: DataFrame, spec: Mapping[str, str], name: str | None = None) -> None:
        """Add rows to one partition without reading or replacing what is there.

        With a ``name`` for the files, adding the same rows again replaces the first ones.
        """
        root = scratch_path(self.spark, "added")
        try:
            df.coalesce(1).write.partitionBy(*self.keys).parquet(root)
            found = [p for p in storage.leaf_files(self.spark, root) if p.endswith(".parquet")]
            base = storage.qualified(self.spark, root).rstrip("/") + "/"
            moves = []
            for i, path in enumerate(found):
                folder, _, own = path.removeprefix(base).rpartition("/")
                moves.append((path, f"{self.location}/{folder}/{f'{name}-{i}.parquet' if name else own}"))
            storage.move(self.spark, moves)
        finally:
            storage.delete(self.spark, [root])
        self.add_partition(spec)
        self.spark.catalog.refreshTable(self.name)

    def land_partition(self, df: DataFrame, spec: Mapping[str, str]) -> int:
        """Write rows as exactly one partition and return their number, counted by the write.

        The rows may come from this very table or partition: the old files stay until
        the new ones are complete. The count is taken in the writing stage itself, where
        a repeated task counts once.
        """
        data = df.drop(*self.keys)
        self.register(data.schema)
        counted = Observation()
        rows = data.observe(counted, F.count(F.lit(1)).alias("rows"))
        self.land(rows.withColumns({k: F.lit(spec[k]) for k in self.keys}))
        count = counted.get["rows"]
        if count == 0:
            self.purge(reduce(Column.__and__, [F.col(k) == spec[k] for k in self.keys]))
            self.add_partition(spec)
        return count

    def slices(self, within: Mapping[str, str], key: str, values: Sequence[str]) -> DataFrame:
        """Rows of a partition ``within`` whose next key has one of the values, all of them constants.

        So the catalog is asked for these partitions only, whatever else there is beside them. Very many values become a join,
        which reads the whole of ``within``.
        """
        rows = self.read().where(reduce(Column.__and__, [F.col(k) == F.lit(v) for k, v in within.items()]))
        if len(values) > CONSTANTS:
            wanted = self.spark.createDataFrame([(v,) for v in values], T.StructType([T.StructField(key, T.StringType())]))
            return rows.join(wanted.distinct(), key, "left_semi")
        if not values:
            return rows.limit(0)
        return rows.where(F.expr(f"{_name(key)} IN ({', '.join(_literal(v) for v in sorted(set(values)))})"))

    # -- partitions -----------------------------------------------------------

    def partitions(self, within: Mapping[str, str] | None = None) -> DataFrame:
        """Registered partitions: folder name in ``partition`` and one string column per key.

        Comes from the catalog, so no data file is opened. ``within`` fixes leading keys, and the
        catalog lists only what is below them.
        """
        fixed = ", ".join(f"{_name(k)}={_literal(v)}" for k, v in (within or {}).items())
        listed = self.spark.sql(f"SHOW PARTITIONS {self.name}" + (f" PARTITION ({fixed})" if fixed else ""))
        parts = F.split("partition", "/")
        return listed.select("partition", *[self._value(parts[i]).alias(k) for i, k in enumerate(self.keys)])

    def leading(self, depth: int) -> DataFrame | None:
        """Values of the first ``depth`` keys, from the folders' names: one listing per level, and none of what is below.

        They may have folders that are not registered. None for a table that others laid out, whose partitions may be anywhere.
        """
        properties = {r["key"]: r["value"] for r in self.spark.sql(f"SHOW TBLPROPERTIES {self.name}").collect()}
        if properties.get(IN_FOLDERS) != "true":
            return None
        described = self.spark.sql(f"DESCRIBE TABLE EXTENDED {self.name}").where("col_name = 'Location'").first()
        folders = storage.matching(self.spark, described["data_type"], [f"{k}=*" for k in self.keys[:depth]])
        rows = [tuple(f.split("/")[-depth:]) for f in folders]
        found = self.spark.createDataFrame(rows, T.StructType([T.StructField(k, T.StringType()) for k in self.keys[:depth]]))
        return found.select(*[self._value(F.col(k)).alias(k) for k in self.keys[:depth]])

    @staticmethod
    def _value(folder: Column) -> Column:
        """The key's value in a partition folder's name."""
        text = F.regexp_replace(folder, "^[^=]*=", "")
        decoded = F.url_decode(F.replace(text, F.lit("+"), F.lit("%2B")))
        return F.when(text != NO_VALUE, F.when(text.contains("%"), decoded).otherwise(text))

    def detach(self, which: Column | None = None) -> list[str]:
        """Take partitions out of the catalog; their files stay. Returns their folders."""
        chosen = self.partitions() if which is None else self.partitions().where(which)
        specs = {r["partition"]: [r[k] for k in self.keys] for r in chosen.collect()}
        folders = list(specs)
        for i in range(0, len(folders), DDL_BATCH):
            batch = ", ".join(
                "PARTITION ("
                + ", ".join(f"{_name(k)}={'NULL' if v is None else _literal(v)}" for k, v in zip(self.keys, specs[f]))
                + ")"
                for f in folders[i : i + DDL_BATCH]
            )
            self.spark.sql(f"ALTER TABLE {self.name} DROP IF EXISTS {batch}")
        return folders

    def purge(self, which: Column | None = None, depth: int | None = None) -> list[str]:
        """Detach partitions and delete their files.

        ``depth`` deletes whole folders above, for conditions on leading keys only.
        """
        folders = self.detach(which)
        paths = {"/".join(f.split("/")[: depth or len(self.keys)]) for f in folders}
        storage.delete(self.spark, [f"{self.location}/{p}" for p in paths])
        self.spark.catalog.refreshTable(self.name)
        return folders

    def archive(self, current_cycle: str, archive_location: str, only_date: str | None = None) -> int:
        """Move all cycles but the current one to the archive, partition folders included.

        Files move as they are, so no data is read, and the archive keeps every column the files
        have. A partition that the archive has already is replaced; a move that fails leaves its
        partition in the table's folder, and the next archive takes it up again.
        """
        self.repair()
        old = F.col("execution_cycle_id") != current_cycle
        if only_date is not None:
            old = old & (F.col("execution_date") == only_date)
        leaves = [r["partition"] for r in self.partitions().where(old).select("partition").collect()]
        if not leaves:
            return 0
        target = archive_location.rstrip("/")
        cycles = sorted({"/".join(leaf.split("/")[:2]) for leaf in leaves})
        there = {c for c in cycles if storage.exists(self.spark, f"{target}/{c}")}
        # A whole cycle is one rename. Into a cycle that the archive has, the partitions go one by one.
        moved = [c for c in cycles if c not in there] + [leaf for leaf in leaves if "/".join(leaf.split("/")[:2]) in there]
        storage.move(self.spark, [(f"{self.location}/{p}", f"{target}/{p}") for p in moved], missing_ok=True)
        self.purge(old, depth=2)
        return len(cycles)


def publish(
    processed: LakeTable, target: LakeTable, spec: Mapping[str, str], user_keys: Sequence[str] = ()
) -> int:
    """Make the target hold the current cycle only, read back from the processed table.

    The new partition is written first and older ones go afterwards, so readers never
    find the table empty. With user keys, slices of the same cycle add up.
    """
    rows = processed.read().where(F.col("execution_cycle_id") == spec["execution_cycle_id"])
    for key in user_keys:
        rows = rows.where(F.col(key) == spec[key])
    count = target.land_partition(rows.drop(*processed.keys), spec)
    stale = F.col("execution_cycle_id") != spec["execution_cycle_id"]
    if not user_keys:
        stale = stale | (F.col("execution_date") != spec["execution_date"])
    target.repair()
    target.purge(stale, depth=2)
    return count


class TempTables:
    """Results stored as Parquet in the shared folder to cut their lineage.

    As a context manager it deletes them at the end of the block.
    """

    def __init__(self, spark: SparkSession, label: str = "temp") -> None:
        self.spark = spark
        self.root = scratch_path(spark, label)

    def keep(self, df: DataFrame, name: str, view: str | None = None) -> DataFrame:
        path = f"{self.root}/{name}"
        df.write.parquet(path)
        stored = self.spark.read.schema(df.schema).parquet(path)
        if view:
            stored.createOrReplaceTempView(view)
        return stored

    def clear(self) -> None:
        storage.delete(self.spark, [self.root])

    def __enter__(self) -> TempTables:
        return self

    def __exit__(self, *_) -> None:
        self.clear()
