"""Row-level key joins that stay balanced when a few keys hold most of the rows."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HOT_SHARE = 0.005
SALTS = 64
_SALT = "__salt"
_TRACKED = 4096
_MERGERS = 256


def hot_keys(df: DataFrame, key: str, share: float = HOT_SHARE) -> list:
    """The keys that hold more than about ``share`` of the rows, null among them; at most 1/share.

    Found with the built-in top-k sketch, whose buffers have a fixed size, so no key is shuffled.
    Buffers are merged in groups first, as there is one per input partition.
    """
    column, most = f"`{key}`", math.ceil(1 / share)
    merged = df.groupBy((F.spark_partition_id() % _MERGERS).alias("part")).agg(
        F.expr(f"approx_top_k_accumulate({column}, {_TRACKED})").alias("sketch"), F.count(F.lit(1)).alias("n")
    )
    # Grouped by a constant, an empty input gives no row; the sketch cannot combine nothing.
    found = merged.groupBy(F.lit(0).alias("all")).agg(
        F.expr(f"approx_top_k_estimate(approx_top_k_combine(sketch, {_TRACKED}), {most})").alias("top"),
        F.sum("n").alias("rows"),
    ).first()
    return [t["item"] for t in found["top"] if t["count"] > share * found["rows"]] if found else []


def key_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    how: str = "left",
    hot: Sequence | None = None,
    salts: int = SALTS,
    position: Sequence[str] = (),
) -> DataFrame:
    """Equi-join of many ``left`` rows to ``right``, with how in inner, left, left_semi, left_anti.

    Spark broadcasts ``right`` if its bytes allow it, and splits skewed shuffle partitions at run time. Rows with a null
    key have no partner, so they go past the join and never meet in one partition. Nothing runs while the plan is built.

    For plans in which adaptive execution cannot split, ``hot`` names keys (see :func:`hot_keys`) whose rows are spread
    over ``salts`` partitions; only their right rows are repeated to meet them there. The salt is a hash of the row and
    the ``position`` columns, which tell equal rows apart; a file's path and row index do, and are the same on every
    retry. Which keys count as hot affects the balance only, never the result.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"unsupported join type {how!r}")
    keyed = left.filter(F.col(key).isNotNull())
    named = [k for k in hot or () if k is not None]
    if named:
        is_hot, none = F.col(key).isin(named), F.lit(0)
        spread = F.pmod(F.xxhash64(*[F.col(c) for c in left.columns], *position), F.lit(salts)).cast("int")
        salted = keyed.withColumn(_SALT, F.when(is_hot, spread).otherwise(none))
        repeats = F.when(is_hot, F.sequence(none, F.lit(salts - 1))).otherwise(F.array(none))
        joined = salted.join(right.withColumn(_SALT, F.explode(repeats)), [key, _SALT], how).drop(_SALT)
    else:
        joined = keyed.join(right, key, how)
    if how in ("inner", "left_semi"):
        return joined
    return joined.unionByName(left.filter(F.col(key).isNull()), allowMissingColumns=True)
