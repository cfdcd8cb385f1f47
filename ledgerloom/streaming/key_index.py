"""Which keys a table holds, in hash buckets beside its snapshot.

A micro-batch asks for its own keys only, so it reads the buckets they fall into and nothing else of the table. Entries
are written some time after the rows: each look-up first adds the files of the table that are not indexed yet, so none is missed after
a load that died between the two, and a replaced snapshot starts an index of its own.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.sources.files import landing_inventory
from ledgerloom.sources.lake import Lake

#: Folders of the index. A look-up reads at most one folder for each key of its batch.
BUCKETS = 256


class KeyIndex:
    """Keys of ``<layer>.<table>``; one writer at a time, as for the table itself."""

    def __init__(self, lake: Lake, layer: str, table: str, key: str, buckets: int = BUCKETS):
        self.lake, self.spark, self.layer, self.table, self.key, self.buckets = lake, lake.spark, layer, table, key, buckets
        self.location = lake.location(layer, table)
        self.root = f"{self.location.replace('/snapshot=', '/keys=')}/{buckets}"
        self.type = lake.read(layer, table).schema[key].dataType.simpleString()

    def bucket(self, key: Column) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(self.buckets)).cast("int").alias("bucket")

    def _stored(self, part: str, schema: str) -> DataFrame:
        try:
            return self.spark.read.schema(schema).parquet(f"{self.root}/{part}")
        except AnalysisException:  # not written yet
            return self.spark.createDataFrame([], schema)

    def refresh(self) -> list[str]:
        """Index the table's files that are new since the last time; returns them, or all files of the first time as none."""
        present = landing_inventory(self.spark, self.location, "*.parquet").select("path")
        indexed = self._stored("files", "path string")
        first = indexed.isEmpty()
        names = [] if first else [r.path for r in present.join(indexed, "path", "left_anti").collect()]  # those of the last batch
        if not first and not names:
            return names
        rows = self.spark.read.schema(f"`{self.key}` {self.type}").parquet(*(names or [self.location]))
        key = F.col(self.key)
        entries = rows.filter(key.isNotNull()).select(key.alias("key"), self.bucket(key))
        entries.repartition("bucket").write.mode("append").partitionBy("bucket").parquet(f"{self.root}/keys")
        listed = present if first else present.filter(F.col("path").isin(names))
        listed.coalesce(1).write.mode("append").parquet(f"{self.root}/files")
        return names

    def known(self, batch: DataFrame) -> DataFrame:
        """The keys of a batch that the table has, once each.

        A batch that falls into few buckets reads these alone. One that falls into most of them, a bulk load, would read
        the whole index: it scans the key column of the table instead, and leaves its own entries to the next small batch. So
        does a batch for a table whose files a merge has superseded in part.
        """
        keys = batch.select(F.col(self.key).alias("key")).withColumn("bucket", self.bucket(F.col("key")))
        wanted = [r.bucket for r in keys.select("bucket").distinct().collect()]  # at most as many as there are buckets
        if 2 * len(wanted) > self.buckets or self.lake.changed(self.layer, self.table):
            entries, by = self.lake.read(self.layer, self.table).select(F.col(self.key).alias("key")), ["key"]
        else:
            self.refresh()
            entries, by = self._stored("keys", f"key {self.type}, bucket int").filter(F.col("bucket").isin(wanted)), ["bucket", "key"]
        return entries.join(keys, by, "left_semi").select(F.col("key").alias(self.key)).distinct()
