"""Row-order operators without a single-partition window.

A window ordered over the whole table (``Window.orderBy(t)``) moves every
row into one task. Instead the order key is cut into contiguous ranges at
approximate quantiles; each range is windowed in its own task, and the one
value that crosses a range edge (last value, last non-null value) is
carried over a table with one row per range.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clicklens.sources.io import written

BUCKET = "__bucket"


def order_keys(order_col: str | Sequence[str]) -> list[str]:
    """One column or several (the later ones break ties)."""
    return [order_col] if isinstance(order_col, str) else list(order_col)


def _bucket_count(df: DataFrame, n_buckets: int | None) -> int:
    if n_buckets:
        return int(n_buckets)
    return max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200")))


def range_buckets(df: DataFrame, order_col: str | Sequence[str], n_buckets: int | None = None,
                  accuracy: int = 10000, bounds_from: DataFrame | None = None) -> DataFrame:
    """Add ``__bucket`` (int): contiguous, ordered ranges of ``order_col``.

    Bounds are approximate quantiles computed in one map-side pass (over
    ``bounds_from`` when given, e.g. the raw rows before an aggregation);
    only the bound array (``n_buckets`` doubles) reaches the driver. Equal
    keys share a range, so the order key should be unique, or aggregated per
    key first (as the AUROC plan does) when one value may be hot. Rows
    with a null key form a range of their own before all others (-1), as
    Spark sorts them.

    Keys of other types (dates, texts) and keys of several columns are cut at bounds
    that Spark samples from the keys themselves (``repartitionByRange``); the frame is
    written with its ranges, as a second sampling could cut elsewhere. A tie-break
    column spreads a hot first key over ranges.
    """
    n = _bucket_count(df, n_buckets)
    keys = order_keys(order_col)
    if len(keys) > 1 or not isinstance(df.schema[keys[0]].dataType, T.NumericType):
        if n <= 1:
            return df.withColumn(BUCKET, F.lit(0))
        return written(df.repartitionByRange(n, *keys).withColumn(BUCKET, F.spark_partition_id()), "ranges")
    order_col = keys[0]
    if n <= 1:
        return df.withColumn(BUCKET, F.when(F.col(order_col).isNull(), -1).otherwise(0))
    qs = [i / n for i in range(1, n)]
    src = bounds_from if bounds_from is not None else df
    accuracy = max(accuracy, 10 * n)  # neighbouring bounds must not coincide
    bounds = src.agg(F.percentile_approx(F.col(order_col).cast("double"), qs, accuracy)).first()[0]
    splits = sorted({float(b) for b in (bounds or []) if b is not None})
    splits = [float("-inf")] + splits + [float("inf")]
    tmp = "__order_d"
    with_d = df.withColumn(tmp, F.col(order_col).cast("double"))
    out = Bucketizer(splits=splits, inputCol=tmp, outputCol=BUCKET, handleInvalid="keep").transform(with_d)
    return out.withColumn(BUCKET, F.coalesce(F.col(BUCKET).cast("int"), F.lit(-1))).drop(tmp)


def forward_fill(df: DataFrame, col: str, order_col: str | Sequence[str], out_col: str | None = None,
                 partition_cols: list[str] | None = None, n_buckets: int | None = None) -> DataFrame:
    """Last non-null value of ``col`` up to each row in ``order_col`` order.

    The order key is cut into ranges; each (key, range) is windowed in its
    own task and the last non-null value of earlier ranges is carried over.
    With ``partition_cols`` the fill restarts per key, and a key holding a
    large share of the rows is still spread over all ranges.
    """
    out_col = out_col or col
    keys, order = list(partition_cols or []), order_keys(order_col)
    b = range_buckets(df, order, n_buckets)
    within = F.last(col, ignorenulls=True).over(
        Window.partitionBy(*keys, BUCKET).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    b = b.withColumn("__within", within)
    # one row per (key, range), all-null ranges included (they take the carry on)
    last_set = F.max(F.when(F.col(col).isNotNull(), F.struct(*[F.col(c).alias(f"o{i}") for i, c in enumerate(order)], F.col(col).alias("v"))))
    tail = b.groupBy(*keys, BUCKET).agg(last_set["v"].alias("__tail"))
    carry = tail.select(*keys, BUCKET, F.last("__tail", ignorenulls=True).over(
        Window.partitionBy(*keys).orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)).alias("__carry"))
    # without keys the carry table has one row per range: broadcast it; with
    # keys it has one row per (key, range) and is joined like any table
    carry = F.broadcast(carry) if not keys else carry
    if keys:  # a null key is a key of its own
        carry = carry.select(*[F.col(c).alias(f"__k_{c}") for c in [*keys, BUCKET]], "__carry")
        same = [F.col(c).eqNullSafe(F.col(f"__k_{c}")) for c in [*keys, BUCKET]]
        filled = b.join(carry, same, "left").drop(*[f"__k_{c}" for c in [*keys, BUCKET]])
    else:
        filled = b.join(carry, BUCKET, "left")
    return (filled.withColumn(out_col, F.coalesce(F.col("__within"), F.col("__carry")))
            .drop("__within", "__carry", BUCKET))


def with_previous(df: DataFrame, value: Column | str, order_col: str | Sequence[str], out_col: str,
                  value_col: str = "__value", n_buckets: int | None = None) -> DataFrame:
    """Add ``value`` of the previous row in ``order_col`` order (null for
    the first row), across range edges."""
    v = F.col(value) if isinstance(value, str) else value
    order = order_keys(order_col)
    b = range_buckets(df.withColumn(value_col, v), order, n_buckets)
    w = Window.partitionBy(BUCKET).orderBy(*order)
    b = b.withColumn("__prev_in", F.lag(value_col).over(w)).withColumn("__pos", F.row_number().over(w))
    last = b.groupBy(BUCKET).agg(F.max_by(F.col(value_col), F.struct(*order)).alias("__last"))
    carry = last.select(BUCKET, F.lag("__last").over(Window.orderBy(BUCKET)).alias("__carry"))
    out = b.join(F.broadcast(carry), BUCKET, "left")
    prev = F.when(F.col("__pos") == 1, F.col("__carry")).otherwise(F.col("__prev_in"))
    return out.withColumn(out_col, prev).drop("__prev_in", "__pos", "__carry", BUCKET)


def _materialized_sort(df: DataFrame, *order) -> DataFrame:
    """Sort (range-partitioned) and write the result with its partition id and
    in-partition id to the shared scratch folder. ``persist`` is not enough:
    a pruned copy of the plan in a self-join may miss the cache and re-sort
    into different partitions; written ids cannot change."""
    srt = (df.orderBy(*order)
           .withColumn("__pid", F.spark_partition_id())
           .withColumn("__mid", F.monotonically_increasing_id()))
    return written(srt, "sorted")


def global_position(df: DataFrame, *order, pos_col: str = "__pos") -> tuple[DataFrame, DataFrame]:
    """0-based position of every row in a total order, computed without a
    single-task window.

    The frame is sorted once (range-partitioned by Spark) and written with its
    partition ids; each row's position is the number of rows in
    earlier partitions (a table with one row per partition, prefix-summed)
    plus its rank inside its own partition (``monotonically_increasing_id``
    is contiguous within a partition). Returns ``(positioned, sorted)``.
    """
    srt = _materialized_sort(df, *order)
    counts = srt.groupBy("__pid").agg(F.count(F.lit(1)).alias("__n"), F.min("__mid").alias("__first"))
    offsets = counts.select(
        "__pid", "__first",
        F.coalesce(F.sum("__n").over(Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)),
                   F.lit(0)).alias("__offset"))
    out = srt.join(F.broadcast(offsets), "__pid")
    out = out.withColumn(pos_col, (F.col("__offset") + F.col("__mid") - F.col("__first")).cast("long"))
    return out.drop("__pid", "__mid", "__first", "__offset"), srt


def global_cumsum(df: DataFrame, weight: str, *order, out_col: str = "__before") -> tuple[DataFrame, DataFrame]:
    """Exclusive running sum of ``weight`` in a total order, without a
    single-task window: sort once (range-partitioned, written), total
    each partition (one row per partition, prefix-summed), and add the
    running sum inside each sorted partition. Returns
    ``(with_running_sum, sorted)``."""
    srt = _materialized_sort(df, *order)
    totals = srt.groupBy("__pid").agg(F.sum(weight).alias("__w"))
    offsets = totals.select("__pid", F.coalesce(F.sum("__w").over(
        Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__offset"))
    inside = F.coalesce(F.sum(weight).over(
        Window.partitionBy("__pid").orderBy("__mid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    out = srt.withColumn("__inside", inside).join(F.broadcast(offsets), "__pid")
    out = out.withColumn(out_col, F.col("__offset") + F.col("__inside"))
    return out.drop("__pid", "__mid", "__inside", "__offset"), srt
