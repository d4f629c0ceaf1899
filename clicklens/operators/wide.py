"""Lookups of many wide columns in one pass over the fact table.

A column whose list of values is too long to broadcast needs a shuffle. One join a
column would shuffle the whole fact table once for each; here the columns are
unpivoted into narrow rows (key, column, value), a bitmap of the listed pairs
drops most that have no match while they are scanned, the rest meet the list in one
join, and the matches are gathered per key. The fact table itself is exchanged
once, to meet its gathered matches, however many columns there are.

Values that hold a large share of the rows are known from their counts: their
narrow rows, and their line of the list, are spread over salts.

Keys must tell rows apart. Without a key the frame is written once with a row
number.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clicklens.session import scratch_path
from clicklens.sources.io import written

# Bits of the bitmap for each listed pair, and at most (8 MB; beyond that it lets more rows pass).
BITS_PER_VALUE, MAX_BITS = 16, 1 << 26
# A value above this share of its column's rows is spread over SALTS keys.
HOT_SHARE, SALTS = 1 / 64, 32
# Columns whose matches share a 64-bit mask.
MASK = 60
ROW, POSITION = "__row", "__position"


def _hash() -> Column:
    return F.xxhash64("col_name", "value")


def bitmap(listed: DataFrame, n_listed: int) -> tuple[Column, int]:
    """64-bit words, as one array, with a bit set for each ``col_name, value`` of ``listed``, and the number of bits."""
    bits = min(MAX_BITS, max(64, 1 << (max(1, n_listed) * BITS_PER_VALUE - 1).bit_length()))
    place = F.pmod(_hash(), F.lit(bits))
    one = F.expr("shiftleft(1L, cast(place % 64 as int))")
    words = listed.select(place.alias("place")).groupBy(F.expr("place div 64").alias("id")).agg(F.bit_or(one).alias("word"))
    every = listed.sparkSession.range(bits // 64).join(words, "id", "left")
    row = every.agg(F.sort_array(F.collect_list(F.struct("id", F.coalesce("word", F.lit(0).cast("long")).alias("word")))).alias("held"))
    return row.select(F.col("held.word").alias("words")).scalar(), bits


def in_bitmap(words: Column, bits: int) -> Column:
    place = F.pmod(_hash(), F.lit(bits))
    word = F.get(words, F.expr(f"cast(pmod(xxhash64(col_name, value), {bits}) div 64 as int)"))
    return word.bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("long"), (place % 64).cast("int"))) != 0


def hot_pairs(counts: DataFrame, share: float = HOT_SHARE) -> dict[str, list[str]]:
    """Kept values above ``share`` of their column's rows: fewer than 1 / share a column."""
    totals = counts.groupBy("col_name").agg(F.sum("n").alias("total"))
    rows = (counts.join(F.broadcast(totals), "col_name").where(F.col("kept") & (F.col("n") > F.col("total") * share))
            .select("col_name", "value").collect())
    hot: dict[str, list[str]] = {}
    for r in rows:
        hot.setdefault(r["col_name"], []).append(r["value"])
    return hot


def _is_hot(hot: dict[str, list[str]]) -> Column:
    out = F.lit(False)
    for c, values in hot.items():
        out = out | ((F.col("col_name") == c) & F.col("value").isin(values))
    return out


def numbered(df: DataFrame) -> DataFrame:
    """The frame written with a number for each row; a number made while a plan runs could change on a retry."""
    return written(df.withColumn(ROW, F.monotonically_increasing_id()), "rows")


def matches(df: DataFrame, keys: Sequence[str], cols: Sequence[str], listed: DataFrame, n_listed: int,
            hot: dict[str, list[str]]) -> DataFrame:
    """Narrow rows that have a line in ``listed`` (``col_name, value`` and more).

    Output: the keys as ``__k0``, ..., ``__position`` of the column in ``cols``, and the further columns of ``listed``.
    """
    names = [f"__k{i}" for i in range(len(keys))]
    narrow = df.select(*[F.col(k).alias(n) for k, n in zip(keys, names, strict=True)], *[F.col(c).cast("string").alias(f"__c{i}") for i, c in enumerate(cols)])
    pairs = F.explode(F.array(*[F.struct(F.lit(i).alias("p"), F.lit(c).alias("c"), F.col(f"__c{i}").alias("v")) for i, c in enumerate(cols)]))
    rows = narrow.select(*names, pairs.alias("pair")).select(*names, F.col("pair.p").alias(POSITION), F.col("pair.c").alias("col_name"),
                                                            F.col("pair.v").alias("value")).where("value is not null")
    words, bits = bitmap(listed, n_listed)
    salt = F.when(_is_hot(hot), F.pmod(F.xxhash64(*names), F.lit(SALTS))).otherwise(0).cast("int")
    rows = rows.where(in_bitmap(words, bits)).withColumn("__salt", salt)
    every = F.when(_is_hot(hot), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    lines = listed.withColumn("__salt", F.explode(every))
    return rows.join(lines.hint("merge"), ["col_name", "value", "__salt"]).drop("col_name", "value", "__salt")


def _gathered(df: DataFrame, keys: Sequence[str], found: DataFrame, aggregates: Sequence[Column]) -> DataFrame:
    """One row of aggregates for each key, joined to the fact rows: their one exchange."""
    names = [f"__k{i}" for i in range(len(keys))]
    per_key = found.groupBy(*names).agg(*aggregates)
    # row numbers are never null: plain equality keeps the partitioning of the aggregate
    same = [F.col(k) == F.col(n) if k == ROW else F.col(k).eqNullSafe(F.col(n)) for k, n in zip(keys, names, strict=True)]
    return df.join(per_key.hint("merge"), same, "left").drop(*names)


def kept_flags(df: DataFrame, keys: Sequence[str], cols: Sequence[str], kept: DataFrame, n_kept: int,
               hot: dict[str, list[str]]) -> tuple[DataFrame, list[Column]]:
    """The frame with mask columns, and for each of ``cols`` whether its value is in ``kept``."""
    found = matches(df, keys, cols, kept.select("col_name", "value"), n_kept, hot)
    groups = range(-(-len(cols) // MASK))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col(POSITION) % MASK)
    masks = [F.bit_or(F.when(F.floor(F.col(POSITION) / F.lit(MASK)) == g, bit)).alias(f"__mask{g}") for g in groups]
    out = _gathered(df, keys, found, masks)
    flags = [F.coalesce(F.col(f"__mask{i // MASK}"), F.lit(0)).bitwiseAND(F.lit(1 << i % MASK)) != 0 for i in range(len(cols))]
    return out, flags


def kept_flag(df: DataFrame, col: str, kept: DataFrame, hot: list[str]) -> tuple[DataFrame, Column]:
    """The frame with a mark, and whether the value of ``col`` is in ``kept``, for one column: one exchange of the frame.

    Rows with a null or a hot value need no line of the list. Their key is null, and they stay
    spread by the partition that they come from.
    """
    text = F.col(col).cast("string")
    is_hot = F.coalesce(text.isin(hot), F.lit(False)) if hot else F.lit(False)
    key = F.when(~is_hot, text)
    rows = df.withColumns({"__value": key, "__salt": F.when(key.isNull(), F.spark_partition_id() + 1).otherwise(0)})
    lines = kept.select(F.col("value").alias("__listed"), F.lit(0).alias("__own"))
    same = (F.col("__value") == F.col("__listed")) & (F.col("__salt") == F.col("__own"))
    out = rows.join(lines.hint("merge"), same, "left").drop("__value", "__salt", "__own")
    return out, F.col("__listed").isNotNull() | is_hot


def sparse_vectors(df: DataFrame, numbers: Sequence[Column], slots: Sequence[Column], width: int, output_col: str) -> DataFrame:
    """Vectors of ``numbers`` (null: NaN) followed by a 0/1 part of ``width`` from one slot a column (null: none).

    They are written in the stored form of a vector and read back as vectors: nothing of the
    width's size is held on the driver, and no Python worker runs.
    """
    spark, k = df.sparkSession, len(numbers)
    ones = F.array_sort(F.array_distinct(F.array_compact(F.array(*[s.cast("int") for s in slots]))))
    first = [F.array(*[F.lit(i) for i in range(k)]), F.array(*[F.coalesce(n.cast("double"), F.lit(float("nan"))) for n in numbers])] if k else []
    parts = [F.transform(ones, lambda i: i + k), F.transform(ones, lambda _: F.lit(1.0))]
    indices, values = (F.concat(a, b) for a, b in zip(first, parts, strict=True)) if k else parts
    stored = F.struct(F.lit(0).cast("tinyint").alias("type"), F.lit(int(width) + k).alias("size"), indices.alias("indices"), values.alias("values"))
    path = scratch_path(spark, "vectors")
    kept = [f for f in df.schema.fields if f.name != output_col and not f.name.startswith("__slot")]
    df.select(*[f.name for f in kept], stored.alias(output_col)).write.parquet(path)
    return spark.read.schema(T.StructType([*kept, T.StructField(output_col, VectorUDT())])).parquet(path)


def label_slots(df: DataFrame, keys: Sequence[str], cols: Sequence[str], labels: DataFrame, n_labels: int,
                hot: dict[str, list[str]]) -> DataFrame:
    """The frame with ``__slot0``, ...: the slot of each column's value among ``labels`` (``col_name, value, slot``), else null."""
    found = matches(df, keys, cols, labels.select("col_name", "value", "slot"), n_labels, hot)
    return _gathered(df, keys, found, [F.max(F.when(F.col(POSITION) == i, F.col("slot"))).alias(f"__slot{i}") for i in range(len(cols))])
