"""File scans, ingestion stamping and the landing inventory."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import from_arrow_schema

from ledgerloom.schemas import INGESTED_AT, SOURCE_FILE, STAMP_COLUMNS

CORRUPT = "_corrupt_record"


def scan_parquet(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """Parquet scan with the files' own columns and types, added ones too.

    With a declared schema every file must have every declared column: one that lacks a column, and so one where it was
    renamed, raises and is named; see :func:`drift` for the rest. Files of one schema are read without merging.
    """
    if not schema:
        return spark.read.option("mergeSchema", "true").parquet(path)
    kinds = file_drift(spark, path, schema).orderBy(F.size("missing").desc(), "first_file").collect()  # one row for each different schema
    if kinds and kinds[0].missing:
        files = sum(k.files for k in kinds if k.missing)
        raise ValueError(f"{path}: no column {', '.join(kinds[0].missing)} in {files} of {sum(k.files for k in kinds)} file(s), such as {kinds[0].first_file}")
    return spark.read.option("mergeSchema", str(len(kinds) > 1).lower()).parquet(path)


_COLUMNS = "array<struct<name:string,type:string>>"


def _footer(file: object) -> list[dict[str, str]]:
    """Columns of one Parquet file with their Spark types, from its footer; as Spark wrote them, if it did."""
    import pyarrow.parquet as pq

    found = pq.read_schema(file)
    written = (found.metadata or {}).get(b"org.apache.spark.sql.parquet.row.metadata")
    fields = T.StructType.fromJson(json.loads(written)).fields if written else from_arrow_schema(found.remove_metadata()).fields
    return [{"name": f.name, "type": f.dataType.simpleString()} for f in fields]


def file_schemas(spark: SparkSession, path: str) -> DataFrame:
    """(path, columns) of each Parquet file below ``path``; folder columns are not in the files.

    Tasks read the footers alone, a part of the files each, where Arrow can open the path; files on any other system are
    read whole through Spark, up to 2 GB each.
    """
    import pyarrow as pa
    from pyarrow import fs

    listed = landing_inventory(spark, path)
    one = listed.first()
    schema = f"path string, columns {_COLUMNS}"
    if one is None:
        return spark.createDataFrame([], schema)
    kind = pa.list_(pa.struct([("name", pa.string()), ("type", pa.string())]))

    def opened(name: str) -> pa.NativeFile:
        system, place = fs.FileSystem.from_uri(re.sub("^file:/+", "file:///", name))
        return system.open_input_file(place)

    def footers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = []
            for name in batch.column("path").to_pylist():
                with opened(name) as file:
                    columns.append(_footer(file))
            yield pa.RecordBatch.from_arrays([batch.column("path"), pa.array(columns, kind)], ["path", "columns"])

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [_footer(pa.BufferReader(content)) for content in batch.column("content").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("path"), pa.array(columns, kind)], ["path", "columns"])

    try:
        opened(one.path).close()
        return listed.select("path").mapInArrow(footers, schema)
    except (pa.ArrowInvalid, pa.ArrowNotImplementedError, OSError):
        pass  # a system that only Spark's readers know
    content = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "content")
    return content.mapInArrow(whole, schema)


def file_drift(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """(files, first_file, missing, added, retyped): how the files of each schema found below ``path`` differ from the declared one.

    ``retyped`` has entries "column declared -> found"; a file with the declared columns has three empty lists.
    """
    declared = [(f.name, f.dataType.simpleString()) for f in T.StructType.fromDDL(schema).fields]
    names = F.array(*[F.lit(n) for n, _ in declared])
    kinds = file_schemas(spark, path).groupBy("columns").agg(F.count(F.lit(1)).alias("files"), F.min("path").alias("first_file"))
    found = F.transform("columns", lambda c: c["name"])
    types = F.map_from_entries("columns")
    retyped = [F.when(types[n] != t, F.concat(F.lit(f"{n} {t} -> "), types[n])) for n, t in declared]
    known = F.concat(names, F.array(*[F.lit(c) for c in STAMP_COLUMNS]))
    return kinds.select(
        "files", "first_file", F.array_except(names, found).alias("missing"), F.array_except(found, known).alias("added"),
        F.array_compact(F.array(*retyped)).alias("retyped"),
    )


@dataclass(frozen=True)
class Drift:
    """How a table's columns differ from the declared ones."""

    missing: tuple[str, ...]
    added: tuple[str, ...]
    retyped: tuple[str, ...]  # "column declared -> found"

    def __str__(self) -> str:
        parts = [f"{name}: {', '.join(found)}" for name, found in vars(self).items() if found]
        return "; ".join(parts)


def drift(df: DataFrame, schema: str) -> Drift:
    declared = {f.name: f.dataType.simpleString() for f in T.StructType.fromDDL(schema).fields}
    found = {c: t for c, t in df.dtypes if c not in STAMP_COLUMNS}
    return Drift(
        tuple(c for c in declared if c not in found),
        tuple(c for c in found if c not in declared),
        tuple(f"{c} {t} -> {found[c]}" for c, t in declared.items() if c in found and found[c] != t),
    )


def below(path: str) -> Column:
    """True for stamped rows whose source file lies in the folder ``path``."""
    plain = F.url_decode(F.regexp_replace(F.regexp_replace(SOURCE_FILE, "^[A-Za-z0-9+.-]+:/+", "/"), r"\+", "%2B"))
    return plain.startswith(re.sub("^[A-Za-z0-9+.-]+:/+", "/", path).rstrip("/") + "/")


def scan_jsonl(spark: SparkSession, path: str, schema: str, keep_corrupt: bool = False) -> DataFrame:
    """JSON-lines scan with a declared schema, so no inference pass reads the files twice.

    With ``keep_corrupt`` the text of a malformed line lands in ``_corrupt_record``.
    """
    if not keep_corrupt:
        return spark.read.schema(schema).json(path)
    return (
        spark.read.schema(f"{schema}, {CORRUPT} string")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .json(path)
    )


def stamp(df: DataFrame) -> DataFrame:
    """Add load time and source file to a file-backed frame, batch or stream."""
    return df.withColumns(
        {INGESTED_AT: F.current_timestamp(), SOURCE_FILE: F.col("_metadata.file_path")}
    )


def write_parquet(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.write.mode(mode).parquet(path)


def write_jsonl(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """One compact JSON object per line; null fields are kept so every line has every key."""
    df.write.mode(mode).option("ignoreNullFields", "false").json(path)


def landing_inventory(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """Landed files as (path, length, modified). File contents are pruned, never read."""
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", "true")
        .load(path)
        .select("path", "length", F.col("modificationTime").alias("modified"))
    )


def require_landed(spark: SparkSession, path: str, pattern: str = "*", last: int = 10) -> DataFrame:
    """Gate before a load: fail when nothing has landed, else the last ``last`` paths."""
    files = landing_inventory(spark, path, pattern)
    if files.isEmpty():
        raise FileNotFoundError(f"no landed files under {path}")
    return files.orderBy(F.col("path").desc()).limit(last)
