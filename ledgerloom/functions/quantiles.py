"""Quantiles of large columns without gathering a column in one task.

The built-in exact ``percentile`` keeps every distinct value of a group in one buffer. Here one scan makes a sketch of
every column, which brackets the wanted rank; the next scan counts what lies below each bracket and, inside it, the
rows per bin of a histogram, and so on inside the bin that holds the rank until few rows are left, which are then read
value by value. Usually the second scan is the last. Scans cover all columns at once, every count is exact, and at
most ``max(BINS, WINDOW)`` rows per column reach the driver.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.numeric import as_number

BINS = 4096
# A bracket with at most this many rows is read value by value.
WINDOW = 20_000
# Size of a sketch, and how far from the wanted rank its bracket reaches on either side; several times its error.
SKETCH, REACH = 4096, 0.005
# Sketches are merged in so many groups first, as there is one for each input partition.
_MERGERS = 256


@dataclass
class _Bracket:
    """Where the wanted ranks lie: between ``low`` and ``high``, which hold about ``rows`` rows."""

    position: float
    low: float
    high: float
    rows: int
    whole: tuple[float, float, int]  # lowest and highest value, and rows of the column


@dataclass
class Summary:
    """Rows with a value, moments, ends and sketched ranks of one column."""

    n: int
    low: float
    high: float
    mean: float
    squares: float  # sum of the squared deviations from the mean
    position: float
    below: float
    at: float
    above: float

    @property
    def std(self) -> float | None:
        return math.sqrt(self.squares / (self.n - 1)) if self.n > 1 else None


def sketch_rows(df: DataFrame, columns: Iterable[str], *by: str) -> DataFrame:
    """(by..., column_name, n, low, high, mean, squares, sketch): one row for each group and column.

    Rows of groups add up in :func:`summaries`, so they can be stored per day and read again for any range of days.
    Nulls, NaN and infinities are skipped; a column without any other value has n = 0.
    """
    columns = list(columns)
    values = df.select(*by, *[as_number(F.col(c)).alias(f"value{i}_") for i, c in enumerate(columns)])
    return _grouped(values, columns, [F.col(c) for c in by])


def _grouped(values: DataFrame, columns: list[str], by: list[Column]) -> DataFrame:
    rows = []
    for i, c in enumerate(columns):
        v = f"value{i}_"
        measures = F.count(v).alias("n"), F.min(v).alias("low"), F.max(v).alias("high"), F.avg(v).alias("mean")
        squares, sketch = F.var_pop(v) * F.count(v), F.kll_sketch_agg_double(v, F.lit(SKETCH))
        rows.append(F.struct(F.lit(c).alias("column_name"), *measures, squares.alias("squares"), sketch.alias("sketch")))
    grouped = values.groupBy(*by).agg(F.array(*rows).alias("rows_"))
    return grouped.select(*grouped.columns[: len(by)], F.inline("rows_"))


def _added(rows: DataFrame, *keys: Column | str) -> DataFrame:
    """Sketch rows of the same keys as one. Moments are merged pairwise, which keeps their digits."""
    none = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0.0).alias("mean"), F.lit(0.0).alias("squares"))

    def both(a: Column, b: Column) -> Column:
        n, apart = a["n"] + b["n"], b["mean"] - a["mean"]
        share = b["n"] / n
        return F.struct(n.alias("n"), (a["mean"] + apart * share).alias("mean"), (a["squares"] + b["squares"] + apart * apart * a["n"] * share).alias("squares"))

    return (
        rows.groupBy(*keys)
        .agg(
            F.aggregate(F.collect_list(F.struct("n", "mean", "squares")), none, both).alias("moments"),
            F.min("low").alias("low"), F.max("high").alias("high"), F.kll_merge_agg_double("sketch", F.lit(SKETCH)).alias("sketch"),
        )
        .select("*", "moments.*")
        .drop("moments")
    )


def summaries(kept: DataFrame, wanted: Mapping[str, float]) -> dict[str, Summary]:
    """The columns of ``wanted`` that have values, over all rows of ``kept``; ranks are those of its probabilities.

    Rows are added up in groups first, so no task reads more than a share of them. One small row per column comes back.
    """
    if not wanted:
        return {}
    rows = kept.filter((F.col("n") > 0) & F.col("column_name").isin(*wanted))
    added = _added(rows, "column_name", (F.spark_partition_id() % _MERGERS).alias("part"))
    return _read(_added(added, "column_name"), wanted)


def _read(added: DataFrame, wanted: Mapping[str, float]) -> dict[str, Summary]:
    def at(away: float) -> Column:
        own = [(F.col("column_name") == c, F.lit(min(1.0, max(0.0, p + away)))) for c, p in wanted.items()]
        return F.coalesce(*[F.when(named, F.kll_sketch_get_quantile_double("sketch", rank)) for named, rank in own])

    read = [at(-REACH).alias("below"), at(0.0).alias("at"), at(REACH).alias("above")]
    found = added.select("column_name", "n", "low", "high", "mean", "squares", *read).collect()
    return {r["column_name"]: Summary(*r[1:6], wanted[r["column_name"]] * (r["n"] - 1), *r[6:]) for r in found}


def summarise(df: DataFrame, wanted: Mapping[str, float]) -> dict[str, Summary]:
    """:func:`summaries` of a frame, from one scan."""
    if not wanted:
        return {}
    values = df.select(*[as_number(F.col(c)).alias(f"value{i}_") for i, c in enumerate(wanted)])
    parts = _grouped(values, list(wanted), [(F.spark_partition_id() % _MERGERS).alias("part")])
    return _read(_added(parts.filter("n > 0"), "column_name"), wanted)


def exact_quantiles(
    df: DataFrame, wanted: Mapping[str, float], bins: int = BINS, window: int = WINDOW, known: Mapping[str, Summary] | None = None
) -> dict[str, float | None]:
    """Linearly interpolated quantile of each column, or None when it has no finite value.

    ``wanted`` maps a numeric column to a probability. Nulls, NaN and infinities are skipped. ``known`` are summaries
    of the same rows and probabilities, if there are any, and saves the first scan.
    """
    return _select(df, wanted, 0.0, bins, window, known)


def approx_quantiles(
    df: DataFrame, wanted: Mapping[str, float], tolerance: float = 1e-4, known: Mapping[str, Summary] | None = None
) -> dict[str, float | None]:
    """As :func:`exact_quantiles`, but any value whose rank is off by ``tolerance`` of the rows will do."""
    return _select(df, wanted, tolerance, BINS, WINDOW, known)


def _select(
    df: DataFrame, wanted: Mapping[str, float], tolerance: float, bins: int, window: int, known: Mapping[str, Summary] | None
) -> dict[str, float | None]:
    result: dict[str, float | None] = dict.fromkeys(wanted)
    if not wanted:
        return result
    values = df.select(*[as_number(F.col(c)).alias(c) for c in wanted])
    brackets = _brackets(summarise(df, wanted) if known is None else known, wanted)
    while brackets:
        for column, b in list(brackets.items()):
            if b.low == b.high and b.rows == b.whole[2] or b.rows <= tolerance * b.whole[2]:
                result[column] = b.low
                del brackets[column]
        for column, (below, cells) in _count(values, brackets, bins, window).items():
            found = _locate(brackets[column], below, cells)
            if isinstance(found, _Bracket):
                brackets[column] = found
            else:
                result[column] = found
                del brackets[column]
    return result


def _brackets(known: Mapping[str, Summary], wanted: Mapping[str, float]) -> dict[str, _Bracket]:
    """A bracket for each column that has values."""
    brackets = {}
    for column, p in wanted.items():
        if found := known.get(column):
            low = found.low if p <= REACH else found.below
            high = found.high if p >= 1 - REACH else found.above
            whole = found.low, found.high, found.n
            rows = found.n if (low, high) == whole[:2] else min(found.n, math.ceil(3 * REACH * found.n))
            brackets[column] = _Bracket(p * (found.n - 1), low, high, rows, whole)
    return brackets


def _scale(value: Column, low: float, high: float) -> tuple[Column, float, float]:
    """A non-decreasing function of the value, and its ends.

    Bins are equally wide on this scale. It is logarithmic where the bracket spans magnitudes, so
    that a few huge values do not push all others into one bin.
    """
    if low > 0 and high / low > 2:
        return F.ln(value), math.log(low), math.log(high)
    if high < 0 and low / high > 2:
        return -F.ln(-value), -math.log(-low), -math.log(-high)
    if low <= 0 <= high and high - low > 1:
        return F.signum(value) * F.log1p(F.abs(value)), -math.log1p(-low), math.log1p(high)
    return value, low, high


def _cell(value: Column, b: _Bracket, bins: int, window: int) -> Column:
    """Bin number of a value inside the bracket, or the value itself where few rows are left."""
    if b.rows <= window or b.low == b.high:
        return value
    scaled, start, end = _scale(value, b.low, b.high)
    number = F.floor((scaled - start) / (end - start) * bins)
    return F.greatest(F.lit(0.0), F.least(F.lit(bins - 1.0), number.cast("double")))


def _count(
    values: DataFrame, brackets: dict[str, _Bracket], bins: int, window: int
) -> dict[str, tuple[int, list[tuple[float, float, int]]]]:
    """Per column, the rows below its bracket and the (smallest, largest, rows) of each occupied bin inside, in order."""
    if not brackets:
        return {}
    names = list(brackets)
    entries = []
    for i, (c, b) in enumerate(brackets.items()):
        value = F.col(c)
        # An entry without cell is below the bracket. Values above it, and nulls, are dropped at once.
        cell = F.when(value >= b.low, _cell(value, b, bins, window))
        entries.append(F.when(value <= b.high, F.struct(F.lit(i).alias("i"), cell.alias("cell"), value.alias("value"))))
    exploded = values.select(F.explode(F.array_compact(F.array(*entries))).alias("e")).select("e.*")
    rows = exploded.groupBy("i", "cell").agg(F.min("value").alias("low"), F.max("value").alias("high"), F.count(F.lit(1)).alias("rows")).collect()
    counted: dict[str, tuple[int, list]] = {c: (0, []) for c in names}
    for row in rows:
        below, cells = counted[names[row["i"]]]
        if row["cell"] is None:
            counted[names[row["i"]]] = row["rows"], cells
        else:
            cells.append((row["low"], row["high"], row["rows"]))
    return {c: (below, sorted(cells)) for c, (below, cells) in counted.items()}


def _locate(b: _Bracket, below: int, cells: list[tuple[float, float, int]]) -> _Bracket | float:
    """The bracket of the cell with the wanted rank, or the quantile if it is decided already."""
    lower, upper = math.floor(b.position), math.ceil(b.position)
    if lower < below or upper >= below + sum(rows for *_, rows in cells):
        return _Bracket(b.position, b.whole[0], b.whole[1], b.whole[2], b.whole)  # the sketch was off by more than REACH
    first = None
    for low, high, rows in cells:
        if lower < below + rows and first is None:
            if upper < below + rows:
                if low == high:
                    return low
                return _Bracket(b.position, low, high, rows, b.whole)
            # The two ranks lie in neighbouring cells: the last row of one, the first of the next.
            first = high
        elif first is not None:
            return first + (low - first) * (b.position - lower)
        below += rows
    raise ArithmeticError("the counted rows do not cover the wanted rank")
