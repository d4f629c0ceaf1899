"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clicklens.session import scratch_path

BATCH_ROWS, BATCH_BYTES = 1000, "8m"
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` under the shared checkpoint folder and read it back.

    The lineage ends at files that every executor can read, so a lost executor
    costs no earlier stage. Spark drops the shuffle files of the write as soon
    as it has ended, which keeps only one phase's shuffle on disk at a time.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    before = spark.conf.get(_CLEANUP)
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def small_batches(df: DataFrame) -> DataFrame:
    """Bounds what a Python worker is sent at a time, as rows may hold long texts.

    Sets the session's Arrow batch limits, downwards only; results don't depend on them.
    """
    conf = df.sparkSession.conf
    rows = int(conf.get("spark.sql.execution.arrow.maxRecordsPerBatch"))
    if not 0 < rows <= BATCH_ROWS:
        conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    return df


def shielded(df: DataFrame, working: Sequence[str]) -> tuple[DataFrame, dict[str, str]]:
    """Callers' columns with the name of a working column under other names, and the way back.

    Names are compared as Spark does, without case.
    """
    own = {w.lower() for w in working}
    away = {c: f"_caller_{i}_{c}" for i, c in enumerate(df.columns) if c.lower() in own}
    return df.withColumnsRenamed(away), {v: k for k, v in away.items()}


def id_crc(doc_id: str = "doc_id") -> Column:
    """CRC-32 of the id as text; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary"))


def slices(texts: Sequence[str | None], limit: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows that hold about ``limit`` characters, one row at least."""
    begin, held = 0, 0
    for i, t in enumerate(texts):
        n = len(t) if t else 0
        if held and held + n > limit:
            yield begin, i
            begin, held = i, 0
        held += n
    if begin < len(texts):
        yield begin, len(texts)
