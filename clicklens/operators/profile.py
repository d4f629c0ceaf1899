"""Exploratory profiles on the full DataFrame.

The reference profiles a 0.1 % pandas sample on one machine; these run on
all rows. Per-column profiles are computed in one aggregate (nulls, means,
medians, correlations: one row out, then unpivoted) or from the shared
``value_counts`` table (top values, cardinality), so each profile is at most
one scan and one shuffle of partial aggregates.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clicklens.operators.vocab import value_counts


def _long(one_row: DataFrame, names: Sequence[str], value_name: str,
          ids: Sequence[str] = ()) -> DataFrame:
    """Unpivot a one-row aggregate (columns named by ``names``)."""
    return one_row.unpivot(list(ids), list(names), "col_name", value_name)


def null_profile(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Null count and percent of rows per column, one pass, no shuffle
    beyond the final single-row merge.

    Output: ``col_name, nulls bigint, null_pct double``.
    """
    cols = list(cols or df.columns)
    agg = df.agg(F.count(F.lit(1)).alias("__rows"),
                 *[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    long = _long(agg.select("__rows", *[F.col(c).cast("bigint").alias(c) for c in cols]), cols, "nulls",
                 ids=["__rows"])
    return long.select(
        "col_name", F.col("nulls").cast("bigint").alias("nulls"),
        F.round(F.try_divide(F.col("nulls") * 100.0, F.col("__rows")), 6).alias("null_pct"))


def schema_profile(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Type and non-null count per column (``df.info()`` on all rows).

    Output: ``col_name, data_type, non_null bigint``.
    """
    cols = list(cols or df.columns)
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    agg = df.agg(*[F.count(F.col(c)).cast("bigint").alias(c) for c in cols])
    long = _long(agg, cols, "non_null")
    type_of = F.create_map(*[x for c in cols for x in (F.lit(c), F.lit(types[c]))])
    return long.select("col_name", type_of[F.col("col_name")].alias("data_type"),
                       F.col("non_null").cast("bigint").alias("non_null"))


def class_balance(df: DataFrame, label: str = "y") -> DataFrame:
    """Rows and share per label value, null kept as its own class.

    Output: ``label, n bigint, share double``. The share window runs over the
    grouped result (one row per class).
    """
    grouped = df.groupBy(F.col(label).alias("label")).agg(F.count(F.lit(1)).cast("bigint").alias("n"))
    total = F.sum("n").over(Window.partitionBy())
    return grouped.select("label", "n", F.round(F.col("n") / total, 6).alias("share"))


def mean_by_label(df: DataFrame, label: str, cols: Sequence[str], digits: int | None = 6) -> DataFrame:
    """A10: mean of each numeric per label; nulls skipped; null label dropped.

    Output: ``label, col_name, mean double`` (rounded unless ``digits`` is None).
    """
    cols = list(cols)
    agg = (df.filter(F.col(label).isNotNull()).groupBy(F.col(label).alias("label"))
           .agg(*[F.avg(c).alias(c) for c in cols]))
    mean = F.round("mean", digits) if digits is not None else F.col("mean")
    return agg.unpivot(["label"], cols, "col_name", "mean").select("label", "col_name", mean.alias("mean"))


def median_by_label(df: DataFrame, label: str, cols: Sequence[str], *,
                    method: str = "exact", accuracy: int = 10000) -> DataFrame:
    """Interpolated median per label and column (nulls skipped, null
    label dropped).

    * ``exact``: counts per (label, column, value), one distributed sort and
      running counts; the middle value(s) are read off their rank. No group
      is held in one task, whatever the column's domain.
    * ``map``: Spark's ``median`` (one map of distinct values per group;
      fine for bounded domains).
    * ``approx``: the ``percentile_approx`` sketch.

    Output: ``label, col_name, median double``.
    """
    cols = list(cols)
    base = df.filter(F.col(label).isNotNull())
    if method == "exact":
        return _exact_median(base, label, cols)
    if method == "map":
        aggs = [F.median(c).alias(c) for c in cols]
    else:
        aggs = [F.percentile_approx(c, 0.5, accuracy).cast("double").alias(c) for c in cols]
    agg = base.groupBy(F.col(label).alias("label")).agg(*aggs)
    return agg.unpivot(["label"], cols, "col_name", "median").select(
        "label", "col_name", F.round(F.col("median").cast("double"), 6).alias("median"))


def _exact_median(df: DataFrame, label: str, cols: Sequence[str]) -> DataFrame:
    from clicklens.operators.ordered import global_cumsum

    values = df.select(F.col(label).alias("label"), *[F.col(c).cast("double").alias(c) for c in cols])
    long = values.unpivot(["label"], list(cols), "col_name", "v").filter(F.col("v").isNotNull())
    counts = long.groupBy("label", "col_name", "v").agg(F.count(F.lit(1)).alias("n"))
    cum, _ = global_cumsum(counts, "n", "label", "col_name", "v")
    groups = cum.groupBy("label", "col_name").agg(F.min("__before").alias("__start"),
                                                  F.sum("n").alias("__total"))
    cum = cum.join(F.broadcast(groups), ["label", "col_name"])
    rank = F.col("__before") - F.col("__start")
    lo = F.floor((F.col("__total") - 1) / 2)
    hi = F.ceil((F.col("__total") - 1) / 2)
    at = lambda k: (rank <= k) & (k < rank + F.col("n"))
    picked = cum.groupBy("label", "col_name").agg(
        F.max(F.when(at(lo), F.col("v"))).alias("__lo"), F.max(F.when(at(hi), F.col("v"))).alias("__hi"))
    return picked.select("label", "col_name",
                         F.round((F.col("__lo") + F.col("__hi")) / 2.0, 6).alias("median"))


def correlation_matrix(df: DataFrame, cols: Sequence[str], digits: int = 3,
                       full: bool = False) -> DataFrame:
    """Pearson correlation of every pair, pairwise complete, rounded.

    One aggregate computes all pairs. Output: ``col_a, col_b, corr`` for
    a < b in the given order (``full`` adds the mirror and the diagonal).
    """
    cols = list(cols)
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i + 1:]]
    names = [f"{a}\u0001{b}" for a, b in pairs]
    agg = df.agg(*[F.corr(a, b).alias(n) for (a, b), n in zip(pairs, names)])
    long = agg.unpivot([], names, "pair", "corr")
    parts = F.split(F.col("pair"), "\u0001")
    out = long.select(parts[0].alias("col_a"), parts[1].alias("col_b"),
                      F.round("corr", digits).alias("corr"))
    if full:
        mirror = out.select(F.col("col_b").alias("col_a"), F.col("col_a").alias("col_b"), "corr")
        diag = df.sparkSession.createDataFrame([(c, c, 1.0) for c in cols], "col_a string, col_b string, corr double")
        out = out.unionByName(mirror).unionByName(diag)
    return out


def correlated_pairs(corr: DataFrame, k: int = 5) -> DataFrame:
    """The k most positive and k most negative pairs.

    Output: ``direction, rank, col_a, col_b, corr``.
    """
    pos = Window.orderBy(F.desc("corr"), "col_a", "col_b")
    neg = Window.orderBy(F.asc("corr"), "col_a", "col_b")
    valid = corr.filter(F.col("corr").isNotNull() & ~F.isnan("corr"))
    top = (valid.filter(F.col("corr") > 0).withColumn("rank", F.row_number().over(pos))
           .filter(F.col("rank") <= k).withColumn("direction", F.lit("positive")))
    bottom = (valid.filter(F.col("corr") < 0).withColumn("rank", F.row_number().over(neg))
              .filter(F.col("rank") <= k).withColumn("direction", F.lit("negative")))
    return top.unionByName(bottom).select("direction", F.col("rank").cast("int"), "col_a", "col_b", "corr")


def top_values(df: DataFrame, cols: Sequence[str], k: int = 5,
               counts: DataFrame | None = None) -> DataFrame:
    """The k most frequent values per column, nulls included, with percent
    of rows. Ties: value ascending, null last.

    ``row_number() <= k`` lets Spark keep only k rows per column in each map
    task before the shuffle (window group limit).
    Output: ``col_name, rank int, value, n bigint, pct double``.
    """
    counts = counts if counts is not None else value_counts(df, cols)
    totals = counts.groupBy("col_name").agg(F.sum("n").alias("__total"))
    w = Window.partitionBy("col_name").orderBy(F.desc("n"), F.asc_nulls_last("value"))
    top = counts.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
    return top.join(F.broadcast(totals), "col_name").select(
        "col_name", F.col("rank").cast("int").alias("rank"), "value",
        F.col("n").cast("bigint").alias("n"),
        F.round(F.col("n") * 100.0 / F.col("__total"), 6).alias("pct"))


def cardinality_profile(df: DataFrame, cols: Sequence[str],
                        counts: DataFrame | None = None, approximate: bool = False) -> DataFrame:
    """Distinct non-null values per column and as percent of rows.

    ``approximate`` sketches each column instead (``approx_count_distinct``,
    5 % relative error): no shuffle of the values.

    Exact, from the shared value counts (one scan for all columns instead of
    one ``count(distinct)`` expansion per column).
    Output: ``col_name, distinct_values bigint, distinct_pct double``.
    """
    if approximate:
        one = df.agg(F.count(F.lit(1)).alias("__rows"), *[F.approx_count_distinct(c).alias(c) for c in cols])
        per = one.unpivot(["__rows"], list(cols), "col_name", "distinct_values")
        return per.select("col_name", "distinct_values",
                          F.round(F.col("distinct_values") * 100.0 / F.col("__rows"), 6).alias("distinct_pct"))
    counts = counts if counts is not None else value_counts(df, cols)
    per = counts.groupBy("col_name").agg(
        F.count_if(F.col("value").isNotNull()).cast("bigint").alias("distinct_values"),
        F.sum("n").alias("__rows"))
    return per.select("col_name", "distinct_values",
                      F.round(F.col("distinct_values") * 100.0 / F.col("__rows"), 6).alias("distinct_pct"))


# Fixed values that must equal the reference's for equal results:
# a column is flagged when its null share exceeds 20 % or 33 %, when one
# value (null included) holds more than 20 % of rows, or when distinct
# values exceed 20 % of rows.
NULL_FLAG = 0.20
NULL_HEAVY_FLAG = 0.33
DOMINANT_FLAG = 0.20
DISTINCT_FLAG = 0.20


def feature_flags(df: DataFrame, cols: Sequence[str],
                  counts: DataFrame | None = None) -> DataFrame:
    """Null-heavy, dominated and high-cardinality columns.

    Output: ``col_name, null_share, top_share, distinct_share, many_nulls,
    mostly_null, dominated, many_distinct``.
    """
    counts = counts if counts is not None else value_counts(df, cols)
    per = counts.groupBy("col_name").agg(
        F.sum("n").alias("rows"),
        F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("n"))), F.lit(0)).alias("nulls"),
        F.max("n").alias("top"),
        F.count_if(F.col("value").isNotNull()).alias("distinct"))
    null_share = F.col("nulls") / F.col("rows")
    top_share = F.col("top") / F.col("rows")
    distinct_share = F.col("distinct") / F.col("rows")
    return per.select(
        "col_name",
        F.round(null_share, 6).alias("null_share"),
        F.round(top_share, 6).alias("top_share"),
        F.round(distinct_share, 6).alias("distinct_share"),
        (null_share > NULL_FLAG).alias("many_nulls"),
        (null_share > NULL_HEAVY_FLAG).alias("mostly_null"),
        (top_share > DOMINANT_FLAG).alias("dominated"),
        (distinct_share > DISTINCT_FLAG).alias("many_distinct"))
