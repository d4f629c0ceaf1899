"""Impression tables derived from the harness tables, in Spark and in SQL.

Every fixture is a projection of a given table (``events`` or ``lineitem``),
so its size grows with the data. The SQL text next to each builder is the
DuckDB form of the same rows, used by the oracle queries.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clicklens.schema import CtrSchema

# Fixed thresholds for the derived impressions, chosen at sf0.01 so that each
# column splits into kept and stashed values (strictly greater is kept).
FIXTURE_THRESHOLDS = {
    "n1": 100, "n2": 420, "n3": 330, "n4": 100, "n5": 66,
    "cat1": 45, "cat2": 330, "cat3": 420, "cat4": 100,
}

IMPRESSIONS = CtrSchema(
    label="y",
    numeric=("n1", "n2", "n3", "n4", "n5"),
    categorical=("cat1", "cat2", "cat3", "cat4"),
    key="id",
    thresholds=FIXTURE_THRESHOLDS,
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def impressions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fixture A: one impression per event; nulls introduced by rule."""
    ev = table(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k")
    hour = F.hour("ts")
    day = F.dayofmonth("ts")
    return ev.select(
        F.col("event_id").alias("id"),
        F.when(F.col("event_type") == "error", F.lit(None))
        .when(F.col("event_type") == "click", F.lit(1))
        .otherwise(F.lit(0)).cast("int").alias("y"),
        F.floor("value").cast("int").alias("n1"),
        hour.cast("int").alias("n2"),
        day.cast("int").alias("n3"),
        k.cast("int").alias("n4"),
        F.col("user_id").alias("n5"),
        F.when(F.col("event_id") % 5 < 2, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("u"), F.col("user_id").cast("string"))).alias("cat1"),
        F.concat(F.lit("d"), day.cast("string")).alias("cat2"),
        F.concat(F.lit("h"), hour.cast("string")).alias("cat3"),
        F.concat(F.lit("k"), k).alias("cat4"),
    )


IMPRESSIONS_SQL = """
SELECT event_id AS id,
       CAST(CASE WHEN event_type = 'error' THEN NULL
                 WHEN event_type = 'click' THEN 1 ELSE 0 END AS INTEGER) AS y,
       CAST(floor(value) AS INTEGER) AS n1,
       CAST(hour(ts) AS INTEGER) AS n2,
       CAST(day(ts) AS INTEGER) AS n3,
       CAST(json_extract_string(props, '$.k') AS INTEGER) AS n4,
       user_id AS n5,
       CASE WHEN event_id % 5 < 2 THEN NULL ELSE 'u' || CAST(user_id AS VARCHAR) END AS cat1,
       'd' || CAST(day(ts) AS VARCHAR) AS cat2,
       'h' || CAST(hour(ts) AS VARCHAR) AS cat3,
       'k' || json_extract_string(props, '$.k') AS cat4
FROM events
"""


def labelled(df: DataFrame, label: str = "y") -> DataFrame:
    return df.filter(F.col(label).isNotNull())


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fixture C: a fixed scored table with ties and two clipping rows.

    prob = (n4 + 0.5) / 101, raw = logit(prob), prediction = prob > 0.45.
    Two rows with prob exactly 0 and 1 (ids -1 and -2) exercise clipping.
    """
    imp = labelled(impressions(spark, sf_dir))
    prob = (F.col("n4") + F.lit(0.5)) / F.lit(101.0)
    base = imp.select(
        F.col("id"),
        F.col("y").alias("label"),
        prob.alias("prob"),
    )
    edge = spark.range(1, 3).select(
        (-F.col("id")).alias("id"),
        F.when(F.col("id") == 1, F.lit(1)).otherwise(F.lit(0)).cast("int").alias("label"),
        F.when(F.col("id") == 1, F.lit(0.0)).otherwise(F.lit(1.0)).alias("prob"),
    )
    both = base.unionByName(edge)
    return both.select(
        "id", "label", "prob",
        F.when((F.col("prob") > 0) & (F.col("prob") < 1),
               F.log(F.col("prob") / (F.lit(1.0) - F.col("prob")))).alias("raw"),
        (F.col("prob") > F.lit(0.45)).cast("int").alias("prediction"),
    )


SCORED_SQL = f"""
WITH imp AS ({IMPRESSIONS_SQL}),
base AS (
  SELECT id, y AS label, (n4 + 0.5) / 101.0 AS prob FROM imp WHERE y IS NOT NULL
  UNION ALL SELECT -1 AS id, 1 AS label, 0.0 AS prob
  UNION ALL SELECT -2 AS id, 0 AS label, 1.0 AS prob
)
SELECT id, label, prob,
       CASE WHEN prob > 0 AND prob < 1 THEN ln(prob / (1.0 - prob)) END AS raw,
       CAST(prob > 0.45 AS INTEGER) AS prediction
FROM base
"""


def signal_impressions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fixture E: labelled rows whose label carries signal in n4.

    y = 1 when n4 >= 75, or when the first two hex digits of md5(id) are
    below 13 (about 5 % noise); else 0.
    """
    imp = labelled(impressions(spark, sf_dir))
    noise = F.conv(F.substring(F.md5(F.col("id").cast("string")), 1, 2), 16, 10).cast("int") < 13
    return imp.withColumn(
        "y", F.when((F.col("n4") >= 75) | noise, F.lit(1)).otherwise(F.lit(0)).cast("int"))


def wide_impressions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fixture B: volume fixture from lineitem (no unique key)."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        (F.col("l_returnflag") == "R").cast("int").alias("y"),
        F.col("l_quantity").cast("double").alias("q"),
        F.col("l_extendedprice").cast("double").alias("price"),
        F.col("l_discount").cast("double").alias("discount"),
        F.col("l_tax").cast("double").alias("tax"),
        F.col("l_linenumber").cast("int").alias("line"),
        F.col("l_partkey").cast("string").alias("partkey"),
        F.col("l_suppkey").cast("string").alias("suppkey"),
        F.col("l_linestatus").alias("linestatus"),
    )


IMPRESSION_SENTINELS = {c: IMPRESSIONS.numeric_sentinel(c) for c in IMPRESSIONS.numeric}
# Extra coefficient row whose name looks like a numeric stash but is not one.
NEAR_MISS_FEATURE = ("n1v_10000", 0.25)


def coefficients(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fixture D: one coefficient per (column, stashed label) of fixture A.

    coeff = ln((rate + 0.01) / (1.01 - rate)), rate = click rate of the label
    over labelled rows; the stash is fitted on all rows. Equal rates give
    tied coefficients. One near-miss row (``n1v_10000``) is appended.
    Output: ``feature string, coeff double``.
    """
    from clicklens.operators.features import StashEncoder

    imp = impressions(spark, sf_dir)
    cols = list(IMPRESSIONS.numeric) + list(IMPRESSIONS.categorical)
    model = StashEncoder(cols, FIXTURE_THRESHOLDS, IMPRESSION_SENTINELS).fit(imp)
    st = labelled(model.stash(imp))
    text = st.select("y", *[F.col(c + "_t").cast("string").alias(c) for c in cols])
    long = text.unpivot(["y"], cols, "col_name", "label")
    rates = long.groupBy("col_name", "label").agg(F.avg("y").alias("rate"))
    coef = rates.select(
        F.concat(F.col("col_name"), F.lit("v_"), F.col("label")).alias("feature"),
        F.log((F.col("rate") + F.lit(0.01)) / (F.lit(1.01) - F.col("rate"))).alias("coeff"))
    extra = spark.range(1).select(F.lit(NEAR_MISS_FEATURE[0]).alias("feature"),
                                  F.lit(NEAR_MISS_FEATURE[1]).alias("coeff"))
    return coef.unionByName(extra)


WIDE_SQL = """
SELECT CAST(l_returnflag = 'R' AS INTEGER) AS y,
       CAST(l_quantity AS DOUBLE) AS q, CAST(l_extendedprice AS DOUBLE) AS price,
       CAST(l_discount AS DOUBLE) AS discount, CAST(l_tax AS DOUBLE) AS tax,
       CAST(l_linenumber AS INTEGER) AS line,
       CAST(l_partkey AS VARCHAR) AS partkey, CAST(l_suppkey AS VARCHAR) AS suppkey,
       l_linestatus AS linestatus
FROM lineitem
"""
# Fixed thresholds for the wide fixture at sf0.01 (strictly greater is kept).
WIDE_THRESHOLDS = {"partkey": 30, "suppkey": 600, "linestatus": 0}
