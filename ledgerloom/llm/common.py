"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.session import scratch_dir

#: Rows of one Arrow batch between the JVM and Python. Texts of 100 KB then make batches of some 25 MB.
BATCH_ROWS = 256

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

Batches = Iterator[pa.RecordBatch]


def column(name: str) -> Column:
    """A column by its exact name, dots and blanks included."""
    return F.col("`" + name.replace("`", "``") + "`")


def narrow(df: DataFrame, **columns: str) -> DataFrame:
    """Only the named columns, under the operator's own names; whatever else the table has cannot clash."""
    return df.select(*[column(source).alias(name) for name, source in columns.items()])


def texts_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id long, text string) with null texts as empty ones."""
    own = narrow(docs, doc_id=id_col, text=text_col)
    return own.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores added until no column of the table has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def with_ids(df: DataFrame, id_col: str, ids: DataFrame, how: str) -> DataFrame:
    """Semi or anti join of a table with the one column of ``ids``, nulls equal, whatever the table's columns are called."""
    key = free_name(df, "id_")
    return df.join(ids.toDF(key), column(id_col).cast("long").eqNullSafe(F.col(key)), how)


def map_batches(df: DataFrame, work: Callable[[Batches], Batches], schema: str | T.StructType, rows: int = BATCH_ROWS) -> DataFrame:
    """``mapInArrow`` over batches of few rows, so that long texts stay within a worker's memory.

    The batch size is a setting of the session and stays set: it is read when the plan is run.
    """
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    return df.mapInArrow(work, schema)


def map_whole_rows(df: DataFrame, work: Callable[[pa.RecordBatch, int], pa.RecordBatch], text_col: str) -> DataFrame:
    """Batches of all columns through ``work``, which also gets the place of ``text_col``; names and types stay."""
    schema = T.StructType([T.StructField(f"c{i}", f.dataType) for i, f in enumerate(df.schema.fields)])
    at = df.columns.index(text_col)

    def each(batches: Batches) -> Batches:
        return (work(batch, at) for batch in batches)

    # Under plain names, as a name with a dot in it cannot be passed on.
    return map_batches(df.toDF(*schema.names), each, schema).toDF(*df.columns)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut(df: DataFrame, label: str = "step") -> DataFrame:
    """The rows, written to the folder that all executors share and read again.

    What comes after starts from that table, so a lost executor costs no recomputation beyond it, and the shuffle files
    that made it can go at once.
    """
    spark, path = df.sparkSession, scratch_dir(df.sparkSession, label)
    before = spark.conf.get(_CLEANUP)
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)
