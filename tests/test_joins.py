from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators.joins import hot_keys, key_join
from tests.conftest import values


@pytest.fixture(scope="module")
def sides(spark):
    """A third of the rows share one key, a tenth have none, and some keys have no partner."""
    left = spark.range(6000).select(
        "id", F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 10 == 1, None).otherwise(F.col("id") % 500).alias("k")
    )
    right = spark.range(0, 450).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v"))
    return left, right


def test_hot_keys(sides):
    assert hot_keys(sides[0], "k", 0.05) == [7, None]
    assert hot_keys(sides[0].selectExpr("cast(k as string) as k"), "k", 0.1) == ["7"]
    assert hot_keys(sides[0].limit(0), "k", 0.05) == []
    assert hot_keys(sides[1], "k", 0.05) == []


@pytest.mark.parametrize("hot", [None, [7], [7, 13, 999], [None]])
@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_key_join_equals_plain_join(sides, how, hot):
    left, right = sides
    plain = left.join(right, "k", how)
    joined = key_join(left, right, "k", how, hot=hot, salts=8).select(*plain.columns)
    assert values(joined) == values(plain)


def test_repeated_right_rows_of_a_hot_key_all_match(sides):
    left, right = sides
    twice = right.unionByName(right.filter("k = 7"))
    assert key_join(left, twice, "k", "left", hot=[7]).count() == left.join(twice, "k", "left").count()


def test_equal_rows_get_different_salts_by_position(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(5000).selectExpr("1 as k", "'x' as v").coalesce(2).write.parquet(path)
    left = spark.read.parquet(path).select("*", F.col("_metadata.file_path").alias("p"), F.col("_metadata.row_index").alias("i"))
    salted = key_join(left.drop("p", "i"), spark.range(3).selectExpr("id as k"), "k", hot=[1])
    assert salted.count() == 5000
    from ledgerloom.operators import joins

    spread = left.select(F.pmod(F.xxhash64("k", "v", "p", "i"), F.lit(joins.SALTS)).alias("s")).distinct().count()
    assert spread == joins.SALTS
    assert key_join(left, spark.range(3).selectExpr("id as k"), "k", hot=[1], position=["p", "i"]).count() == 5000


def test_other_join_types_are_refused(sides):
    with pytest.raises(ValueError):
        key_join(*sides, "k", "full")
