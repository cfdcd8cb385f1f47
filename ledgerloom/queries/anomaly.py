"""Feature preparation, anomaly detection and incidents."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.operators import features, incidents, isolation_forest, profile
from ledgerloom.queries import Registry, money
from ledgerloom.queries.loading import new_lake
from ledgerloom.queries.standins import table
from ledgerloom.session import scratch_dir

REGISTRY = Registry({}, {})
query = REGISTRY.add

FEATURES = ["amount", "quantity", "discount"]


def measures(spark: SparkSession, sf_dir: str, *more: Column) -> DataFrame:
    """Line items as measured transactions, with more columns on request."""
    return table(spark, sf_dir, "lineitem").select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("transaction_id"),
        F.col("l_orderkey").alias("account_id"),
        F.col("l_extendedprice").cast("decimal(18,2)").alias("amount"),
        F.col("l_quantity").alias("quantity"),
        F.col("l_discount").alias("discount"),
        *more,
    )


def ruled(spark: SparkSession, sf_dir: str, *more: Column) -> DataFrame:
    """Measures flagged by a plain rule, so that SQL can repeat it."""
    flag = (F.col("quantity") >= 49) & (F.col("discount") >= 0.09)
    return measures(spark, sf_dir, *more).withColumn("is_anomaly", flag).withColumn("anomaly_score", -F.col("discount"))


# A small forest written out, so that SQL can state it too. Inner nodes are (feature, split, left, right), leaves the
# number of sample rows that ended there.
FOREST = [
    ("amount", 55_000.0, ("quantity", 45.0, 200, 40), ("discount", 0.05, 10, 6)),
    ("quantity", 48.0, ("discount", 0.08, 190, 50), ("amount", 80_000.0, 12, 4)),
    ("discount", 0.095, ("amount", 90_000.0, 220, 20), ("quantity", 47.0, 14, 2)),
]
ROWS = 256


def _size(node: int | tuple) -> int:
    return node if isinstance(node, int) else _size(node[2]) + _size(node[3])


def literal_forest(spark: SparkSession) -> isolation_forest.Forest:
    rows = []
    for tree, root in enumerate(FOREST):
        level, number = [root], 0
        for depth in range(3):
            after = [child for node in level if isinstance(node, tuple) for child in node[2:]]
            left = number + len(level)
            for node in level:
                if isinstance(node, tuple):
                    rows.append((tree, number, FEATURES.index(node[0]), node[1], left, left + 1, _size(node), depth))
                    left += 2
                else:
                    rows.append((tree, number, -1, 0.0, -1, -1, node, depth))
                number += 1
            level = after
    nodes = spark.createDataFrame(rows, isolation_forest.NODE_SCHEMA)
    return isolation_forest.Forest.from_nodes(nodes, FEATURES, {}, ROWS, len(FOREST))


def _path_sql(node: int | tuple, depth: int = 0) -> str:
    if isinstance(node, int):
        return repr(depth + float(isolation_forest.path_correction(node)))
    low, high = (_path_sql(child, depth + 1) for child in node[2:])
    return f"CASE WHEN {node[0]} <= {node[1]} THEN {low} ELSE {high} END"


def detected(spark: SparkSession, sf_dir: str) -> DataFrame:
    return isolation_forest.detect(measures(spark, sf_dir), FEATURES, forest=literal_forest(spark))


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 9) for c in columns})


MEASURED = """
    measured AS (SELECT l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey AS transaction_id,
                        l_orderkey AS account_id, CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS DOUBLE) AS amount,
                        l_quantity AS quantity, l_discount AS discount FROM lineitem)"""
DETECTED = f"""{MEASURED},
    scored AS (SELECT *, -pow(2.0, -(({" + ".join(_path_sql(t) for t in FOREST)}) / {len(FOREST)})
                              / {float(isolation_forest.path_correction(ROWS))!r}) AS raw FROM measured),
    detected AS (SELECT transaction_id, account_id, amount, quantity, discount,
                        raw - (SELECT quantile_cont(raw, 0.05) FROM scored) AS anomaly_score,
                        raw < (SELECT quantile_cont(raw, 0.05) FROM scored) AS is_anomaly FROM scored)"""
SCORES = "SELECT transaction_id, account_id, amount, quantity, discount, round(anomaly_score, 9) AS anomaly_score, is_anomaly FROM detected"

RULED = """
    ruled AS (SELECT l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey AS transaction_id,
                     CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS DOUBLE) AS amount, l_quantity AS quantity,
                     l_discount AS discount, l_quantity >= 49 AND l_discount >= 0.09 AS is_anomaly FROM lineitem)"""
BASE = ", base AS (" + " UNION ALL ".join(
    f"""SELECT '{c}' AS column_name, round(avg({c}), 2) AS mean, round(median({c}), 2) AS median,
               round(stddev_samp({c}), 2) AS std FROM ruled WHERE NOT is_anomaly"""
    for c in FEATURES
) + ")"


@query(
    "feature_prep",
    """
    WITH dirty AS (SELECT l_orderkey, l_linenumber, l_partkey,
                          CASE WHEN l_quantity >= 45 THEN NULL ELSE l_extendedprice END AS amount,
                          CASE WHEN l_quantity >= 40 THEN NULL ELSE l_quantity END AS quantity,
                          CASE WHEN l_quantity >= 48 THEN NULL ELSE l_discount END AS discount
                   FROM lineitem),
         usable AS (SELECT * FROM dirty WHERE amount IS NOT NULL OR quantity IS NOT NULL OR discount IS NOT NULL),
         middle AS (SELECT median(amount) AS a, median(quantity) AS q, median(discount) AS d FROM usable)
    SELECT l_orderkey, l_linenumber, l_partkey, coalesce(amount, a) AS amount, coalesce(quantity, q) AS quantity,
           coalesce(discount, d) AS discount
    FROM usable, middle
    """,
)
def feature_prep(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Large orders lose some features, to an infinity, NaN or null; the largest lose all."""
    quantity = F.col("l_quantity")
    dirty = table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        F.when(quantity >= 45, float("inf")).otherwise(F.col("l_extendedprice")).alias("amount"),
        F.when(quantity >= 40, float("nan")).otherwise(quantity).alias("quantity"),
        F.when(quantity < 48, F.col("l_discount")).alias("discount"),
    )
    return features.prepare(dirty, FEATURES, ["l_orderkey", "l_linenumber", "l_partkey"])


ROOTS = "SELECT CAST(range AS INTEGER) AS tree_id, least(256, n) AS rows FROM range(200), (SELECT count(*) AS n FROM lineitem)"


@query(
    "detection_chain",
    """
    SELECT count(*) AS rows, count(*) AS scored_twice, 0 AS scored_apart, 0 AS flagged_apart, 200 AS trees, least(256, count(*)) AS tree_rows,
           0 AS broken_nodes, TRUE AS quantile_holds
    FROM lineitem
    """,
)
def detection_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """200 trees fitted, stored, loaded, scored in two ways, and the rows below the 5 % quantile flagged.

    Apart are rows whose two scores, or flags by them, differ; broken are inner nodes whose children do not add up. The
    quantile holds if no more rows than its rank are flagged, and no fewer once those at the quantile are counted.
    """
    lake = new_lake(spark, "chain")
    # A few ids repeat; rows are told apart by a number that is fixed once it is written.
    numbered = measures(spark, sf_dir).withColumns({"amount": F.col("amount").cast("double"), "row_number": F.monotonically_increasing_id()})
    lake.replace("gold", "measures", numbered)
    rows = lake.read("gold", "measures")
    forest = isolation_forest.fit_stored(lake, rows, FEATURES, identity=["transaction_id"])
    scale = float(isolation_forest.path_correction(forest.sample))
    first = isolation_forest.detect(rows, FEATURES, forest=isolation_forest.load_forest(lake))
    second = isolation_forest.mean_paths_by_joins(rows, lake, "row_number").select("row_number", (-F.pow(F.lit(2.0), -F.col("mean_path") / scale)).alias("again"))
    both = scratch_dir(spark, "both")
    first.join(second, "row_number", "left").write.parquet(both)
    both = spark.read.parquet(both)
    # The scores differ by the threshold, the same for all rows.
    offset = both.agg(F.median(F.col("again") - F.col("anomaly_score"))).first()[0]
    again = F.round(F.col("again") - F.lit(offset), 9)
    rank = F.floor(0.05 * (F.count(F.lit(1)) - 1)) + 1
    compared = both.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count("again").alias("scored_twice"),
        F.count_if(F.abs(F.col("again") - F.lit(offset) - F.col("anomaly_score")) > 1e-9).cast("int").alias("scored_apart"),
        F.count_if((again < 0) != (F.round("anomaly_score", 9) < 0)).cast("int").alias("flagged_apart"),
        ((F.count_if("is_anomaly") <= rank) & (F.count_if(F.col("anomaly_score") <= 1e-9) >= rank)).alias("quantile_holds"),
    )
    nodes = lake.read("ai", isolation_forest.NODES)
    child = nodes.select("tree_id", F.col("node_id").alias("child"), F.col("size").alias("part"))
    pairs = nodes.filter("feature >= 0").select("tree_id", "node_id", "size", F.explode(F.array("left_node", "right_node")).alias("child"))
    sums = pairs.join(child, ["tree_id", "child"], "left").groupBy("tree_id", "node_id", "size").agg(F.sum("part").alias("parts"))
    broken = sums.agg(F.count_if(~F.col("parts").eqNullSafe(F.col("size"))).cast("int").alias("broken_nodes"))
    trees = roots(nodes).agg(F.count(F.lit(1)).cast("int").alias("trees"), F.min("rows").alias("tree_rows"))
    return compared.join(F.broadcast(trees), F.lit(True)).join(F.broadcast(broken), F.lit(True))


def roots(nodes: DataFrame) -> DataFrame:
    """The rows that each tree grew from."""
    return nodes.groupBy("tree_id").agg(F.max(F.when(F.col("node_id") == 0, F.col("size"))).cast("bigint").alias("rows"))


@query("iforest_model", ROOTS)
def iforest_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    complete = features.prepare(measures(spark, sf_dir), FEATURES, ["transaction_id"])
    return roots(isolation_forest.fit_nodes(complete, FEATURES, complete.count(), identity=["transaction_id"]))


@query("iforest_repeated", ROOTS)
def iforest_repeated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quantity and discount alone have a few hundred different rows."""
    pairs = features.prepare(measures(spark, sf_dir), FEATURES[1:], [])
    return roots(isolation_forest.fit_nodes(pairs, FEATURES[1:], pairs.count()))


@query("anomaly_scores", f"WITH {DETECTED} {SCORES}")
def anomaly_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(money(detected(spark, sf_dir), "amount"), "anomaly_score")


@query("anomaly_top", f"WITH {DETECTED} {SCORES} WHERE is_anomaly ORDER BY detected.anomaly_score, transaction_id")
def anomaly_top(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(money(isolation_forest.ranked(detected(spark, sf_dir), "transaction_id"), "amount"), "anomaly_score")


@query(
    "anomaly_metrics",
    f"""WITH {DETECTED}
    SELECT count(*) AS analysed, count(*) FILTER (is_anomaly) AS anomalies,
           round(100.0 * count(*) FILTER (is_anomaly) / count(*), 2) AS anomaly_rate FROM detected""",
)
def anomaly_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.detection_metrics(detected(spark, sf_dir))


@query(
    "anomaly_split",
    f"""WITH {DETECTED}
    SELECT CASE WHEN is_anomaly THEN 'flagged' ELSE 'normal' END AS side, count(*) AS rows,
           round(min(anomaly_score), 9) AS lowest, round(max(anomaly_score), 9) AS highest FROM detected GROUP BY is_anomaly""",
)
def anomaly_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and score range of either side."""
    sides = zip(("normal", "flagged"), features.split(detected(spark, sf_dir)), strict=True)
    parts = [
        side.agg(
            F.lit(name).alias("side"),
            F.count(F.lit(1)).alias("rows"),
            F.min("anomaly_score").alias("lowest"),
            F.max("anomaly_score").alias("highest"),
        )
        for name, side in sides
    ]
    return rounded(parts[0].unionByName(parts[1]), "lowest", "highest")


@query(
    "score_threshold",
    """
    SELECT t AS threshold, count(*) FILTER (l_extendedprice < t) AS rows_below
    FROM lineitem, (SELECT quantile_cont(l_extendedprice, 0.05) AS t FROM lineitem) GROUP BY t
    """,
)
def score_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    prices = table(spark, sf_dir, "lineitem")
    limit = isolation_forest.threshold(prices, "l_extendedprice", 0.05)
    return prices.agg(
        F.lit(limit).alias("threshold"), F.count_if(F.col("l_extendedprice") < limit).alias("rows_below")
    )


@query("baseline_stats", f"WITH {RULED} {BASE} SELECT * FROM base")
def baseline_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return incidents.baseline_frame(ruled(spark, sf_dir), FEATURES)


@query(
    "baseline_kept",
    f"""
    WITH {RULED.replace("FROM lineitem", "FROM lineitem WHERE l_shipdate >= DATE '1994-03-01' AND l_shipdate < DATE '1997-08-01'")}
    SELECT column_name, CAST(format('{{:.2f}}', avg(v)) AS DOUBLE) AS mean, CAST(format('{{:.2f}}', median(v)) AS DOUBLE) AS median,
           CAST(format('{{:.2f}}', stddev_samp(v)) AS DOUBLE) AS std, TRUE AS close
    FROM (UNPIVOT (SELECT amount, quantity, discount FROM ruled WHERE NOT is_anomaly) ON amount, quantity, discount INTO NAME column_name VALUE v)
    GROUP BY column_name
    """,
)
def baseline_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Months of a range from stored sketches; close means that the sketched medians lie within 1 % of a deviation."""
    lake = new_lake(spark, "baseline")
    month = F.trunc("l_shipdate", "month").alias("month")
    rows = ruled(spark, sf_dir, month)
    lake.replace("ai", "baseline_sketches", incidents.baseline_sketches(rows, FEATURES, "month"))
    span = F.col("month").between(F.lit(dt.date(1994, 3, 1)), F.lit(dt.date(1997, 7, 1)))
    kept = lake.read("ai", "baseline_sketches").filter(span)
    exact = incidents.kept_baseline(kept, FEATURES, rows.filter(span))
    sketched = incidents.kept_baseline(kept, FEATURES)
    found = [(c, *exact[c], abs(exact[c][1] - sketched[c][1]) <= 0.01 + 0.01 * exact[c][2]) for c in exact]
    return spark.createDataFrame(found, f"{incidents.BASELINE_SCHEMA}, close boolean")


@query(
    "incident_deviation",
    f"""
    WITH {RULED} {BASE}
    SELECT r.transaction_id, b.column_name, r.value, b.mean, b.median, b.std,
           round((r.value - b.mean) / nullif(b.std, 0), 6) AS deviation
    FROM (SELECT transaction_id, 'amount' AS column_name, amount AS value FROM ruled WHERE is_anomaly
          UNION ALL SELECT transaction_id, 'quantity', quantity FROM ruled WHERE is_anomaly
          UNION ALL SELECT transaction_id, 'discount', discount FROM ruled WHERE is_anomaly) r
    JOIN base b ON b.column_name = r.column_name
    """,
)
def incident_deviation(spark: SparkSession, sf_dir: str) -> DataFrame:
    flagged = ruled(spark, sf_dir)
    base = incidents.baseline(flagged, FEATURES)
    found = incidents.deviations(flagged.filter("is_anomaly"), "transaction_id", base)
    return found.withColumn("deviation", F.round("deviation", 6))


@query(
    "incident_context_ruled",
    f"""
    WITH {RULED} {BASE}
    SELECT 'Transaction anomaly based on: amount, quantity, discount' AS dimension, r.transaction_id, r.amount,
           b.mean, b.median, b.std, round(-r.discount, 4) AS anomaly_score
    FROM ruled r JOIN base b ON b.column_name = 'amount' WHERE r.is_anomaly
    """,
)
def incident_context_ruled(spark: SparkSession, sf_dir: str) -> DataFrame:
    flagged = ruled(spark, sf_dir)
    base = incidents.baseline(flagged, FEATURES)
    contexts = incidents.context(flagged.filter("is_anomaly"), FEATURES, base, FEATURES)
    return contexts.select(
        "dimension",
        "flagged_row.transaction_id",
        F.col("flagged_values")["amount"].alias("amount"),
        F.col("baseline_from_normal_data")["amount"]["mean"].alias("mean"),
        F.col("baseline_from_normal_data")["amount"]["median"].alias("median"),
        F.col("baseline_from_normal_data")["amount"]["std"].alias("std"),
        "anomaly_score",
    )


@query(
    "incident_context",
    f"""
    WITH {RULED} {BASE}
    SELECT r.transaction_id, 'Transaction anomaly based on: amount, quantity, discount' AS dimension, r.amount,
           r.quantity, b.mean AS amount_mean, round(-r.discount, 4) AS anomaly_score
    FROM ruled r JOIN base b ON b.column_name = 'amount' WHERE r.is_anomaly
    """,
)
def incident_context(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Read back from the JSON documents."""
    found = ruled(spark, sf_dir)
    base = incidents.baseline(found, FEATURES)
    documents = incidents.context_json(incidents.context(found.filter("is_anomaly"), FEATURES, base, FEATURES))
    part = lambda path: F.get_json_object("context", f"$.{path}")
    return documents.select(
        part("flagged_row.transaction_id").alias("transaction_id"),
        part("dimension").alias("dimension"),
        part("flagged_values.amount").cast("double").alias("amount"),
        part("flagged_values.quantity").cast("double").alias("quantity"),
        part("baseline_from_normal_data.amount.mean").cast("double").alias("amount_mean"),
        part("anomaly_score").cast("double").alias("anomaly_score"),
    )


@query(
    "incident_table",
    f"""
    WITH {RULED} {BASE}, entries AS (
        SELECT r.transaction_id, r.discount, b.*, (r.value - b.mean) / nullif(b.std, 0) AS deviation, r.value
        FROM (SELECT transaction_id, discount, 'amount' AS column_name, amount AS value FROM ruled WHERE is_anomaly
              UNION ALL SELECT transaction_id, discount, 'quantity', quantity FROM ruled WHERE is_anomaly
              UNION ALL SELECT transaction_id, discount, 'discount', discount FROM ruled WHERE is_anomaly) r
        JOIN base b ON b.column_name = r.column_name),
    leads AS (SELECT *, row_number() OVER (PARTITION BY transaction_id ORDER BY abs(deviation) DESC, column_name DESC) AS place,
                     count(*) FILTER (abs(deviation) >= 2) OVER (PARTITION BY transaction_id) AS unusual,
                     string_agg(CASE WHEN abs(deviation) >= 2 THEN column_name END, ', '
                                ORDER BY list_position(['amount', 'quantity', 'discount'], column_name))
                         OVER (PARTITION BY transaction_id) AS names
              FROM entries)
    SELECT transaction_id AS affected_record, round(-discount, 4) AS anomaly_score,
           printf('%d of 3 measured values lie 2 or more standard deviations from normal.', unusual) AS what_happened,
           printf('%s lies %.2f standard deviations %s the normal mean.', column_name, abs(deviation),
                  CASE WHEN deviation >= 0 THEN 'above' ELSE 'below' END) AS why_anomalous,
           CASE WHEN unusual = 0 THEN 'No single value is far from normal; the combination is unusual.'
                ELSE 'Values far from normal: ' || names END AS possible_impact,
           printf('%s = %.2f, normal mean %.2f and median %.2f', column_name, value, mean, median) AS transaction_context,
           printf('Check %s against the account''s other records.', column_name) AS next_step
    FROM leads WHERE place = 1
    """,
)
def incident_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = ruled(spark, sf_dir)
    base = incidents.baseline(found, FEATURES)
    return incidents.incident_table(found.filter("is_anomaly"), "transaction_id", base)
