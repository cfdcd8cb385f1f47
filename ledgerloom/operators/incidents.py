"""Incident records: flagged rows set against the baseline of the normal rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.numeric import numeric_columns
from ledgerloom.functions.quantiles import Summary, approx_quantiles, exact_quantiles, sketch_rows, summaries, summarise

RESULT_COLUMNS = ("anomaly_score", "is_anomaly")
BASELINE_SCHEMA = "column_name string, mean double, median double, std double"

Baseline = dict[str, tuple[float, float, float]]

# How a context names its dimension.
DIMENSION = "Transaction anomaly based on: "
# Deviations from which on a value counts as unusual.
UNUSUAL = 2
_DEVIATION = "struct<column_name:string,value:double,mean:double,median:double,std:double,deviation:double>"


def measured_columns(df: DataFrame) -> list[str]:
    """Numeric columns that describe the record rather than the detection."""
    return [c for c in numeric_columns(df) if c not in RESULT_COLUMNS]


def _rounded(known: dict[str, Summary], middle: dict[str, float], columns: list[str]) -> Baseline:
    return {c: (round(known[c].mean, 2), round(middle[c], 2), round(known[c].std or 0.0, 2)) for c in columns if c in known}


def baseline(df: DataFrame, columns: list[str], flag: str = "is_anomaly", exact: bool = True) -> Baseline:
    """column -> (mean, median, sample deviation) of the normal rows, to two decimals.

    A single value has deviation 0; a column without any value is left out. What comes back is one
    small tuple per column, whatever the number of rows. One scan for moments and sketches, and usually one for medians.
    """
    normal, halves = df.filter(~F.col(flag)), dict.fromkeys(columns, 0.5)
    known = summarise(normal, halves)
    find = exact_quantiles if exact else approx_quantiles
    return _rounded(known, find(normal, halves, known=known), columns)


def baseline_sketches(df: DataFrame, columns: list[str], *by: str, flag: str = "is_anomaly") -> DataFrame:
    """Moments and sketches of the normal rows of each group, such as a day, to be stored; see :func:`kept_baseline`."""
    return sketch_rows(df.filter(~F.col(flag)), columns, *by)


def kept_baseline(kept: DataFrame, columns: list[str], df: DataFrame | None = None, flag: str = "is_anomaly") -> Baseline:
    """:func:`baseline` of the days whose stored sketches are given.

    Without ``df`` no row of the data is read, and a median's rank is off by some 0.1 % of the rows. With ``df``, the
    rows of the same days, the medians are exact and take one scan, of what lies around them.
    """
    halves = dict.fromkeys(columns, 0.5)
    known = summaries(kept, halves)
    middle = {c: found.at for c, found in known.items()} if df is None else exact_quantiles(df.filter(~F.col(flag)), halves, known=known)
    return _rounded(known, middle, columns)


def baseline_frame(df: DataFrame, columns: list[str], flag: str = "is_anomaly", exact: bool = True) -> DataFrame:
    """The baseline as (column_name, mean, median, std)."""
    rows = [(c, *values) for c, values in baseline(df, columns, flag, exact).items()]
    return df.sparkSession.createDataFrame(rows, BASELINE_SCHEMA)


def _baseline_map(base: Baseline) -> Column:
    if not base:
        return F.create_map().cast("map<string,struct<mean:double,median:double,std:double>>")
    entries = [
        part
        for column, values in base.items()
        for part in (
            F.lit(column),
            F.struct(*[F.lit(v).alias(n) for n, v in zip(("mean", "median", "std"), values, strict=True)]),
        )
    ]
    return F.create_map(*entries)


def _score(df: DataFrame) -> Column:
    if "anomaly_score" not in df.columns:
        return F.lit(0.0)
    return F.bround(F.coalesce(F.col("anomaly_score"), F.lit(0.0)), 4)


def context(flagged: DataFrame, columns: list[str], base: Baseline, features: list[str]) -> DataFrame:
    """Context of every flagged row, as nested columns. The baseline is a literal of the plan."""
    values = [part for c in columns for part in (F.lit(c), F.col(c).cast("double"))]
    return flagged.select(
        F.lit(DIMENSION + ", ".join(features)).alias("dimension"),
        F.struct(*flagged.columns).alias("flagged_row"),
        F.create_map(*values).alias("flagged_values"),
        _baseline_map(base).alias("baseline_from_normal_data"),
        _score(flagged).alias("anomaly_score"),
    )


def context_json(contexts: DataFrame) -> DataFrame:
    """Each context as one JSON document; null values are kept."""
    return contexts.select(F.to_json(F.struct(*contexts.columns), {"ignoreNullFields": "false"}).alias("context"))


def _deviations(base: Baseline) -> Column:
    """One struct for each column of the baseline; an empty array without any."""
    structs = []
    for column, (mean, median, std) in base.items():
        value = F.col(column).cast("double")
        structs.append(
            F.struct(
                F.lit(column).alias("column_name"),
                value.alias("value"),
                F.lit(mean).alias("mean"),
                F.lit(median).alias("median"),
                F.lit(std).alias("std"),
                F.try_divide(value - mean, F.lit(std)).alias("deviation"),
            )
        )
    return F.array(*structs).cast(f"array<{_DEVIATION}>")


def deviations(flagged: DataFrame, key: str, base: Baseline) -> DataFrame:
    """(key, column, value, mean, median, std, deviation): how many deviations from the mean.

    The deviation is null where the baseline does not vary.
    """
    entries = _deviations(base)
    return flagged.select(key, F.explode(entries).alias("d")).select(key, "d.*")


def incident_table(flagged: DataFrame, key: str, base: Baseline) -> DataFrame:
    """One incident record per flagged row, in words, led by its most unusual value.

    Works row by row: the largest deviation is picked from an array, so nothing is shuffled.
    """
    entries = _deviations(base)
    ordered = F.transform(
        entries, lambda d: F.struct(F.coalesce(F.abs(d["deviation"]), F.lit(-1.0)).alias("size"), d.alias("d"))
    )
    rows = flagged.select(
        F.col(key).cast("string").alias("affected_record"),
        _score(flagged).alias("anomaly_score"),
        F.array_max(ordered)["d"].alias("lead"),
        F.filter(entries, lambda d: F.abs(d["deviation"]) >= UNUSUAL).alias("unusual"),
    )
    lead = F.col("lead")
    measured = F.format_string(
        "%s = %.2f, normal mean %.2f and median %.2f", lead["column_name"], lead["value"], lead["mean"], lead["median"]
    )
    strength = F.format_string(
        "%s lies %.2f standard deviations %s the normal mean.",
        lead["column_name"],
        F.abs(lead["deviation"]),
        F.when(lead["deviation"] >= 0, "above").otherwise("below"),
    )
    names = F.array_join(F.transform("unusual", lambda d: d["column_name"]), ", ")
    return rows.select(
        "affected_record",
        "anomaly_score",
        F.format_string(f"%d of {len(base)} measured values lie {UNUSUAL} or more standard deviations from normal.", F.size("unusual")).alias(
            "what_happened"
        ),
        F.when(lead["deviation"].isNull(), "The evidence is weak: no measured value deviates from a varying baseline.")
        .otherwise(strength)
        .alias("why_anomalous"),
        F.when(F.size("unusual") == 0, "No single value is far from normal; the combination is unusual.")
        .otherwise(F.concat(F.lit("Values far from normal: "), names))
        .alias("possible_impact"),
        measured.alias("transaction_context"),
        F.when(lead["deviation"].isNull(), "Check how the record was captured.")
        .otherwise(F.format_string("Check %s against the account's other records.", lead["column_name"]))
        .alias("next_step"),
    )
