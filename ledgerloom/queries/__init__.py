"""Named queries over the shared test tables, with DuckDB SQL for the ones SQL can state."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.queries.oracle_tables import sql
from ledgerloom.session import pin_utc

Query = Callable[[SparkSession, str], DataFrame]


@dataclass
class Registry:
    """Collects the queries of one module under their names."""

    queries: dict[str, Query]
    oracles: dict[str, str]

    def add(self, name: str, oracle: str | None = None) -> Callable[[Query], Query]:
        def register(query: Query) -> Query:
            self.put(name, query, oracle)
            return query

        return register

    def put(self, name: str, query: Query, oracle: str | None = None) -> None:
        if name in self.queries:
            raise ValueError(f"query {name} is registered twice")
        self.queries[name] = lambda spark, sf_dir: naive(query(pin_utc(spark), sf_dir))
        if oracle is not None:
            self.oracles[name] = sql(oracle)


def naive(df: DataFrame) -> DataFrame:
    """Timestamps without zone, as the test tables have them."""
    zoned = [f.name for f in df.schema.fields if f.dataType == T.TimestampType()]
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in zoned}) if zoned else df


def money(df: DataFrame, *columns: str) -> DataFrame:
    """Decimal columns as double."""
    return df.withColumns({c: F.col(c).cast("double") for c in columns})


def registries() -> list[Registry]:
    from ledgerloom.queries import anomaly, loading, models, quality, streams

    return [m.REGISTRY for m in (loading, models, quality, anomaly, streams)]
