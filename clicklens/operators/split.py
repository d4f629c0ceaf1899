"""Splitting, sampling and rebalancing (SP1-SP3, U1-U3).

``hash_split`` decides train/test from the row's own key, so the same row
lands in the same split in every job and under any partitioning (the
reference's unseeded ``randomSplit`` and its "same seed on a different
input" scoring job cannot promise that). ``oversample`` emits the extra
copies with ``explode(sequence(...))`` in one pass, instead of unioning the
cached minority frame again per copy.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

HASH_BITS = 24


def hash_fraction_key(key, salt: str = "") -> Column:
    """Integer in [0, 2^24): the first 6 hex digits of md5(salt + key as
    string). A salt makes the split independent of other md5(key) rules."""
    k = F.col(key) if isinstance(key, str) else key
    text = F.concat(F.lit(salt), k.cast("string")) if salt else k.cast("string")
    return F.conv(F.substring(F.md5(text), 1, 6), 16, 10).cast("bigint")


def hash_split(df: DataFrame, key: str, fractions: Sequence[float] = (0.8, 0.2),
               names: Sequence[str] = ("train", "test"), split_col: str = "split",
               salt: str = "") -> DataFrame:
    """SP2: add ``split`` by comparing 24 bits of md5(key) to cumulative
    fractions (normalised). A row's split never depends on partitioning.
    Rows with a null key are split by a hash of the whole row instead."""
    total = float(sum(fractions))
    rest = [F.col(f.name) for f in df.schema if not isinstance(f.dataType, (T.MapType, T.VariantType))]
    whole = F.concat(F.lit("\u0000null:"), F.xxhash64(*rest).cast("string"))
    h = hash_fraction_key(F.coalesce(F.col(key).cast("string"), whole), salt)
    expr = None
    acc = 0.0
    for frac, name in zip(fractions[:-1], names[:-1]):
        acc += frac / total
        cut = int(round(acc * (1 << HASH_BITS)))
        cond = h < F.lit(cut)
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    expr = F.lit(names[-1]) if expr is None else expr.otherwise(F.lit(names[-1]))
    return df.withColumn(split_col, expr)


def split_frames(df: DataFrame, key: str, fractions: Sequence[float] = (0.8, 0.2),
                 salt: str = "") -> tuple[DataFrame, ...]:
    names = [f"part{i}" for i in range(len(fractions))]
    tagged = hash_split(df, key, fractions, names, "__split", salt)
    return tuple(tagged.filter(F.col("__split") == n).drop("__split") for n in names)


def random_split(df: DataFrame, weights: Sequence[float], seed: int | None = None) -> list[DataFrame]:
    """SP1: Spark's ``randomSplit`` (seeded when ``seed`` is given). Its result
    depends on partitioning; prefer :func:`hash_split` across jobs."""
    return df.randomSplit(list(weights), seed) if seed is not None else df.randomSplit(list(weights))


def oversample(df: DataFrame, label: str, minority, times: int = 2, copy_col: str | None = None) -> DataFrame:
    """Minority rows appear 1 + ``times`` times, the rest once.

    One pass: each row is exploded into ``sequence(1, copies)``.
    """
    copies = F.when(F.col(label) == F.lit(minority), F.lit(1 + int(times))).otherwise(F.lit(1))
    name = copy_col or "__copy"
    out = df.withColumn(name, F.explode(F.sequence(F.lit(1), copies)))
    return out if copy_col else out.drop(name)


def sample_n(df: DataFrame, n: int, key: str | None = None, seed: int = 0) -> DataFrame:
    """SP3: n rows. With ``key``: the n smallest md5(key), repeatable; else
    ``rand(seed)`` order. Planned as a per-partition top-n then a merge."""
    order = F.md5(F.col(key).cast("string")) if key else F.rand(seed)
    return df.orderBy(order).limit(int(n))


def union_all(*frames: DataFrame) -> DataFrame:
    """Bag union by column name, duplicates kept."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out
