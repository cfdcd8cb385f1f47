"""Layer databases and their tables.

A table is a view of the catalog over its newest snapshot folder. Each full write goes to a new folder, and the view is
replaced in one step once the write has committed. Readers keep the old snapshot, a table may be rewritten from itself
and may change its columns, and a write that dies half-way leaves the table as it was.

A merge or a refresh of some partitions writes a folder of its own for what it changes. The view then reads all folders
of the table but for the files that were superseded, whose names it holds; Spark leaves those out when it lists files.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable, Mapping, Sequence
from functools import reduce
from operator import and_, or_

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.operators.upsert import one_per_key
from ledgerloom.sources.files import drift, landing_inventory

_LOCATION, _PARTITIONS, _FOLDERS, _DROPPED = "lake.location", "lake.partitions", "lake.folders", "lake.dropped"
#: Folders and superseded files of one table; beyond them a change writes the whole table anew.
MAX_FOLDERS, MAX_DROPPED = 50, 2000


class Lake:
    """Tables of one lakehouse: ``<layer><suffix>.<table>`` below ``root``."""

    def __init__(self, spark: SparkSession, root: str, suffix: str = ""):
        self.spark = spark
        self.root = root.rstrip("/")
        self.suffix = suffix

    def name(self, layer: str, table: str) -> str:
        return f"{layer}{self.suffix}.{table}"

    def exists(self, layer: str, table: str) -> bool:
        return self.spark.catalog.tableExists(self.name(layer, table))

    def read(self, layer: str, table: str) -> DataFrame:
        return self.spark.table(self.name(layer, table))

    def view(self, name: str, df: DataFrame) -> DataFrame:
        """Register ``df`` under a session view name; nothing is computed."""
        df.createOrReplaceTempView(name)
        return df

    def replace(self, layer: str, table: str, df: DataFrame, partition_by: Sequence[str] = ()) -> None:
        """Full refresh: write a snapshot, then point the table to it.

        With ``partition_by`` the snapshot has a folder for each value, so that filters on these columns read only what
        they ask for; rows are gathered by value first, and large values are split over several files.
        """
        location = f"{self.root}/{layer}/{table}/snapshot={uuid.uuid4().hex}"
        if partition_by:
            df.hint("rebalance", *partition_by).write.partitionBy(*partition_by).parquet(location)
            if not self._has_files(location):  # without rows there is no file to hold the columns
                df.limit(0).coalesce(1).write.mode("append").parquet(location)
        else:
            df.write.parquet(location)
        self._point(layer, table, df.schema, [location], partition_by)

    def merge(self, layer: str, table: str, changes: DataFrame, key: str, order: list[str] | None = None, on_duplicate: str = "error") -> int:
        """Copy-on-write upsert: only files that hold a changed key are written anew; returns how many those are.

        Rows with a matching key are replaced, others inserted, none deleted; a null key never matches. The table's key
        column is scanned once for the files, and these files once for their rows.
        """
        columns = [F.col(f.name).cast(f.dataType).alias(f.name) for f in self.read(layer, table).schema.fields]
        fresh = one_per_key(changes.select(*columns), key, order, on_duplicate).persist()
        try:
            if fresh.isEmpty():
                return 0
            keys = fresh.select(key).filter(F.col(key).isNotNull())
            held = self._with_files(layer, table).select(key, "__file")
            touched = [r[0] for r in held.join(keys, key, "left_semi").select("__file").distinct().collect()]

            def after(rows: DataFrame) -> DataFrame:
                keyed, unkeyed = rows.filter(F.col(key).isNotNull()), rows.filter(F.col(key).isNull())
                return keyed.join(keys, key, "left_anti").select(*fresh.columns).unionByName(unkeyed).unionByName(fresh)

            self._supersede(layer, table, touched, after)
            return len(touched)
        finally:
            fresh.unpersist()

    def refresh_partitions(self, layer: str, table: str, df: DataFrame) -> int:
        """Replace the partitions that ``df`` has rows for and leave the others alone; returns the number of files that go.

        The table must have been written with ``partition_by``.
        """
        by = self.partitions(layer, table)
        if not by:
            raise ValueError(f"{self.name(layer, table)} has no partitions")
        columns = [F.col(f.name).cast(f.dataType).alias(f.name) for f in self.read(layer, table).schema.fields]
        fresh = df.select(*columns).persist()
        try:
            values = [tuple(r) for r in fresh.select(*by).distinct().collect()]  # one for each folder that is replaced
            if not values:
                return 0
            same = reduce(or_, (reduce(and_, (F.col(c).eqNullSafe(F.lit(v)) for c, v in zip(by, row, strict=True))) for row in values))
            gone = [r[0] for r in self._with_files(layer, table).filter(same).select("__file").distinct().collect()]
            self._supersede(layer, table, gone, lambda rows: rows.filter(~same).unionByName(fresh))
            return len(gone)
        finally:
            fresh.unpersist()

    def _with_files(self, layer: str, table: str) -> DataFrame:
        """The table's rows, with the name of the file that holds each."""
        schema, dropped = self.read(layer, table).schema, self._listed(layer, table, _DROPPED)
        return self.spark.sql(_rows_of(schema, self._folders(layer, table), dropped, ", _metadata.file_name AS __file"))

    def _supersede(self, layer: str, table: str, files: list[str], after: Callable[[DataFrame], DataFrame]) -> None:
        """Write what comes ``after`` the rows of the named files to a folder of its own, then drop these files from the view."""
        folders, dropped, by = self._folders(layer, table), self._listed(layer, table, _DROPPED), self.partitions(layer, table)
        schema = self.read(layer, table).schema
        if len(folders) >= MAX_FOLDERS or len(dropped) + len(files) > MAX_DROPPED:
            self.replace(layer, table, after(self.read(layer, table)).select(*schema.names), by)
            return
        change = f"{self.root}/{layer}/{table}/change={uuid.uuid4().hex}"
        old = self._with_files(layer, table)
        rows = after(old.filter(F.col("__file").isin(files)).drop("__file")).select(*schema.names)
        (rows.hint("rebalance", *by) if by else rows).write.partitionBy(*by).parquet(change)
        self._point(layer, table, schema, [*folders, change], by, [*dropped, *files])

    def append(self, layer: str, table: str, df: DataFrame) -> None:
        """Add rows, matching columns by name; creates the table on first use."""
        if not self.exists(layer, table):
            self.replace(layer, table, df)
            return
        name = self.name(layer, table)
        present = self.read(layer, table)
        different = set(present.columns) ^ set(df.columns)
        if different:
            raise ValueError(f"{name}: columns differ: {sorted(different)}")
        typed = df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in present.schema.fields])
        typed.write.mode("append").partitionBy(*self.partitions(layer, table)).parquet(self.location(layer, table))

    def stored_folders(self, layer: str, table: str) -> DataFrame:
        """(folder, written, bytes, current): all folders of the table with the time of their newest file, and whether it reads them still."""
        current = [folder.rsplit("/", 1)[1] for folder in self._folders(layer, table)] if self.exists(layer, table) else []
        folder = F.regexp_extract("path", f"/{layer}/{table}/((?:snapshot|change)=[0-9a-f]+)/", 1)
        files = landing_inventory(self.spark, f"{self.root}/{layer}/{table}").withColumn("folder", folder).filter("folder <> ''")
        found = files.groupBy("folder").agg(F.max("modified").alias("written"), F.sum("length").alias("bytes"))
        return found.withColumn("current", F.col("folder").isin(current) if current else F.lit(False))

    def expire(self, layer: str, table: str, older_than: dt.timedelta, now: dt.datetime | None = None) -> list[str]:
        """Delete folders that the table no longer reads and that were written longer ago than ``older_than``; returns their names.

        A reader that started before a folder was superseded may still read it, so the age must exceed the longest run of
        a reader, and that of a write under way, whose folder the table does not name yet. Current folders stay at any age.
        """
        if older_than <= dt.timedelta(0):
            raise ValueError("the retention must be positive")
        limit = (now or dt.datetime.now(dt.timezone.utc)) - older_than
        old = self.stored_folders(layer, table).filter(~F.col("current") & (F.col("written") < F.lit(limit)))
        names = sorted(r.folder for r in old.select("folder").collect())  # one for each write of the table
        context = self.spark.sparkContext
        for name in names:
            path = context._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{layer}/{table}/{name}")
            path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)
        return names

    def _property(self, layer: str, table: str, name: str) -> str:
        rows = self.spark.sql(f"SHOW TBLPROPERTIES {self.name(layer, table)}").collect()
        return next(r["value"] for r in rows if r["key"] == name)

    def location(self, layer: str, table: str) -> str:
        """Folder of the snapshot that the table points to."""
        return self._property(layer, table, _LOCATION)

    def partitions(self, layer: str, table: str) -> list[str]:
        """Columns that the table's folders stand for."""
        return self._listed(layer, table, _PARTITIONS)

    def _listed(self, layer: str, table: str, name: str) -> list[str]:
        return [c for c in self._property(layer, table, name).split(",") if c]

    def _folders(self, layer: str, table: str) -> list[str]:
        """All folders of the table: its snapshot and the changes since."""
        return [f"{self.root}/{layer}/{table}/{name}" for name in self._listed(layer, table, _FOLDERS)]

    def changed(self, layer: str, table: str) -> bool:
        """Whether a merge or a refresh of partitions came after the snapshot."""
        return len(self._listed(layer, table, _FOLDERS)) > 1

    def _has_files(self, location: str) -> bool:
        try:
            return bool(self.spark.read.parquet(location).columns)
        except AnalysisException:
            return False

    def _point(self, layer: str, table: str, schema: T.StructType, folders: Sequence[str], partition_by: Sequence[str] = (), dropped: Sequence[str] = ()) -> None:
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {layer}{self.suffix} LOCATION '{self.root}/{layer}'")
        names = ",".join(folder.rsplit("/", 1)[1] for folder in folders)
        properties = {_LOCATION: folders[0], _PARTITIONS: ",".join(partition_by), _FOLDERS: names, _DROPPED: ",".join(dropped)}
        stored = ", ".join(f"'{name}' = '{value}'" for name, value in properties.items())
        self.spark.sql(f"CREATE OR REPLACE VIEW {self.name(layer, table)} TBLPROPERTIES ({stored}) AS {_rows_of(schema, folders, dropped)}")


def _rows_of(schema: T.StructType, folders: Sequence[str], dropped: Sequence[str], more: str = "") -> str:
    """SQL for the rows in the folders, but for those of superseded files. Types are stated, as a folder's own values may suggest others."""
    left_out = ", ".join(f"'{name}'" for name in dropped)
    where = f" WHERE _metadata.file_name NOT IN ({left_out})" if dropped else ""
    chosen = ", ".join(f"CAST(`{f.name}` AS {f.dataType.simpleString()}) AS `{f.name}`" if len(folders) > 1 else f"`{f.name}`" for f in schema.fields)
    return " UNION ALL ".join(f"SELECT {chosen}{more} FROM parquet.`{folder}`{where}" for folder in folders)


REPORT_SCHEMA = "table string, rows bigint, status string, error string, drift string"


def load_tables(
    lake: Lake,
    layer: str,
    readers: dict[str, Callable[[], DataFrame]],
    only: str | None = None,
    fail: bool = True,
    declared: Mapping[str, str] | None = None,
) -> DataFrame:
    """Full-refresh many tables, or the one named ``only``; a failing table does not stop the rest.

    Returns one row per table (table, rows, status, error, drift); ``drift`` says which columns the table has beyond
    its ``declared`` schema, or with another type. With ``fail`` the call raises after all
    tables were tried if any of them failed.
    """
    if only is not None and only not in readers:
        raise ValueError(f"unknown table {only!r}; known: {sorted(readers)}")
    outcomes = []
    for table in [only] if only else readers:
        try:
            df = readers[table]()
            differences = str(drift(df, declared[table])) if declared else ""
            lake.replace(layer, table, df)
            # Counted from the footers of the new files, so the source is read only once.
            outcomes.append((table, lake.read(layer, table).count(), "loaded", None, differences))
        except Exception as error:  # the outcome of each table is the result
            outcomes.append((table, 0, "failed", str(error).splitlines()[0], None))
    report = lake.spark.createDataFrame(outcomes, REPORT_SCHEMA)
    failed = [table for table, _, status, *_ in outcomes if status == "failed"]
    if fail and failed:
        raise RuntimeError(f"{len(failed)} table(s) failed to load: {', '.join(failed)}")
    return report
