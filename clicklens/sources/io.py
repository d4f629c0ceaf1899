"""Readers, writers and file checks.

Text is read under an explicit schema (never inferred); Parquet reads go
through ``select`` so only needed columns are scanned. Writers take a path
on the shared file system; scratch paths come from
``clicklens.session.scratch_path`` (under ``spark.checkpoint.dir``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clicklens.session import scratch_path

# Escapes of text that is written line by line; an empty text has one of its own.
_ESCAPES = (("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t"), ("\0", "\\0"))
_EMPTY, _NULL = "\\e", "\\N"


def _escaped(c: F.Column) -> F.Column:
    out = F.replace(c, F.lit("\\"), F.lit("\\\\"))
    for raw, code in _ESCAPES:
        out = F.replace(out, F.lit(raw), F.lit(code))
    return F.when(c == "", _EMPTY).otherwise(out)


def _unescaped(c: F.Column) -> F.Column:
    def part(p: F.Column) -> F.Column:  # between escaped backslashes
        for raw, code in _ESCAPES:
            p = F.replace(p, F.lit(code), F.lit(raw))
        return p

    return F.when(c == _EMPTY, "").otherwise(F.array_join(F.transform(F.split(c, r"\\\\"), part), "\\"))


def _plain(io, sep: str):
    """Options under which a line holds its fields as they are."""
    for name in ("ignoreLeadingWhiteSpace", "ignoreTrailingWhiteSpace"):
        io = io.option(name, "false")
    return io.option("sep", sep).option("header", "false").option("quote", "").option("nullValue", _NULL)


def read_tsv(spark: SparkSession, path: str | Sequence[str], schema: T.StructType, *,
             strict: bool = False, null_value: str | None = None, sep: str = "\t",
             escaped: bool = False) -> DataFrame:
    """Headerless delimited text with an explicit schema.

    ``path`` may be a glob (``part-{00..10}``) or a list. Default mode is
    PERMISSIVE (a bad number becomes null); ``strict`` fails on the first
    malformed row (FAILFAST). ``escaped`` reads what ``write_tsv`` has escaped.
    """
    if escaped:
        reader = _plain(spark.read.schema(schema).option("mode", "FAILFAST" if strict else "PERMISSIVE"), sep)
        out = reader.csv(path if isinstance(path, str) else list(path))
        return out.select([_unescaped(F.col(f.name)).alias(f.name) if isinstance(f.dataType, T.StringType) else f.name
                           for f in schema])
    reader = (spark.read.schema(schema).option("sep", sep).option("header", "false")
              .option("mode", "FAILFAST" if strict else "PERMISSIVE"))
    if null_value is not None:
        reader = reader.option("nullValue", null_value)
    return reader.csv(path if isinstance(path, str) else list(path))


_BAD = "__bad_line"


def read_tsv_quarantined(spark: SparkSession, path: str | Sequence[str], schema: T.StructType, *,
                         null_value: str | None = None, sep: str = "\t") -> tuple[DataFrame, DataFrame]:
    """S2 without failing: (good rows, bad lines as they were read).

    A line is bad if it is empty, has too few or too many fields, or a field that isn't of its column's
    type; a line of empty fields is a good row of nulls (the file reader would skip it). The text is
    parsed once, into a table that both results read, so each line is in one of them.
    Output: ``schema``; ``line string``.
    """
    options = {"sep": sep, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": _BAD}
    if null_value is not None:
        options["nullValue"] = null_value
    lines = spark.read.text(path if isinstance(path, str) else list(path))
    fields = T.StructType([*schema.fields, T.StructField(_BAD, T.StringType())])
    parsed = lines.select(F.from_csv("value", fields.simpleString(), options).alias("row"), "value")
    bad = F.when((F.col("value") == "") | F.col(f"row.{_BAD}").isNotNull(), F.col("value"))
    parsed = written(parsed.select(*[F.col("row")[f.name].alias(f.name) for f in schema], bad.alias(_BAD)), "parsed")
    return parsed.where(F.col(_BAD).isNull()).drop(_BAD), parsed.where(F.col(_BAD).isNotNull()).select(F.col(_BAD).alias("line"))


def write_tsv(df: DataFrame, path: str, *, null_value: str | None = None, mode: str = "overwrite",
              sep: str = "\t", escaped: bool = False) -> str:
    """Headerless delimited text; ``null_value`` marks nulls (default
    empty field). Line ends, tabs, quotes and empty texts come back only from
    ``escaped`` files, whose lines are still one row each."""
    if escaped:
        if sep != "\t":
            raise ValueError("escaped files are tab-separated")
        out = df.select([_escaped(F.col(f.name)).alias(f.name) if isinstance(f.dataType, T.StringType) else f.name
                         for f in df.schema])
        _plain(out.write.mode(mode), sep).csv(path)
        return path
    w = df.write.mode(mode).option("sep", sep).option("header", "false")
    if null_value is not None:
        w = w.option("nullValue", null_value)
    w.csv(path)
    return path


def read_parquet(spark: SparkSession, path: str | Sequence[str], columns: Sequence[str] | None = None,
                 where=None) -> DataFrame:
    """Parquet with column pruning and an optional pushed-down filter."""
    df = spark.read.parquet(*([path] if isinstance(path, str) else list(path)))
    if where is not None:
        df = df.filter(where)
    return df.select(*columns) if columns else df


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite", codec: str = "snappy",
                  partition_by: Sequence[str] = ()) -> str:
    """Parquet with an explicit codec; ``mode='error'`` refuses to
    overwrite (the reference's default for prediction output)."""
    w = df.write.mode(mode).option("compression", codec)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared scratch folder: computed once for all its
    readers, without a cache to release, and safe when an executor is lost."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_csv_single(df: DataFrame, path: str, header: bool = False, mode: str = "overwrite",
                     single_file: bool = True) -> str:
    """A small table as one CSV part, through one task; with
    ``single_file=False`` in parallel parts."""
    out = df.coalesce(1) if single_file else df
    out.write.mode(mode).option("header", str(header).lower()).csv(path)
    return path


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str, header: bool = False) -> DataFrame:
    """CSV results read back under given column names and types."""
    return spark.read.schema(schema).option("header", str(header).lower()).csv(path)


def table_from_rows(spark: SparkSession, rows: Sequence[tuple], schema: T.StructType | str) -> DataFrame:
    """A small table from driver-side values (coefficients, metrics)."""
    return spark.createDataFrame(list(rows), schema)


def save_model(model: PipelineModel, path: str) -> str:
    """Persist a fitted pipeline (overwrite)."""
    model.write().overwrite().save(path)
    return path


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def file_inventory(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Part files with their size and row count, from the file-source
    metadata column (one scan, grouped by file).

    Output: ``file_name, file_size, rows``.
    """
    df = spark.read.parquet(*([path] if isinstance(path, str) else list(path)))
    return df.groupBy(F.col("_metadata.file_name").alias("file_name"),
                      F.col("_metadata.file_size").alias("file_size")).agg(
        F.count(F.lit(1)).cast("bigint").alias("rows"))


def column_checksums(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Per-column non-null count, total text length and sum of the values' hashes,
    each salted with its row's hash (so a value that moves to another row
    changes it), in one aggregate.

    Output: ``rows, col_name, non_null, text_length, digest``.
    """
    cols = list(cols or df.columns)
    aggs = []
    row = F.xxhash64(*[F.coalesce(F.col(c).cast("string"), F.lit("\0")) for c in cols])
    for c in cols:
        aggs.append(F.sum(F.xxhash64(F.col(c).cast("string"), row).cast("decimal(38,0)")).alias(f"{c}\u0001d"))
        aggs += [F.count(c).cast("bigint").alias(f"{c}\u0001n"),
                 F.coalesce(F.sum(F.length(F.col(c).cast("string"))), F.lit(0)).cast("bigint").alias(f"{c}\u0001l")]
    one = df.agg(F.count(F.lit(1)).cast("bigint").alias("__rows"), *aggs)
    stacked = F.explode(F.array(*[
        F.struct(F.lit(c).alias("col_name"), F.col(f"`{c}\u0001n`").alias("non_null"),
                 F.col(f"`{c}\u0001l`").alias("text_length"), F.col(f"`{c}\u0001d`").alias("digest")) for c in cols]))
    return one.select("__rows", stacked.alias("s")).select(
        F.col("__rows").alias("rows"), "s.col_name", "s.non_null", "s.text_length", "s.digest")


def round_trip_check(before: DataFrame, after: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Rows and per-column checksums before and after a conversion.

    Output: ``col_name, rows_before, rows_after, non_null_before,
    non_null_after, length_before, length_after, equal``.
    """
    cols = list(cols or before.columns)
    a = column_checksums(before, cols).select(
        "col_name", F.col("rows").alias("rows_before"), F.col("non_null").alias("non_null_before"),
        F.col("text_length").alias("length_before"), F.col("digest").alias("__before"))
    b = column_checksums(after, cols).select(
        "col_name", F.col("rows").alias("rows_after"), F.col("non_null").alias("non_null_after"),
        F.col("text_length").alias("length_after"), F.col("digest").alias("__after"))
    out = a.join(b, "col_name", "full")
    return out.withColumn("equal", (F.col("rows_before") == F.col("rows_after"))
                          & (F.col("non_null_before") == F.col("non_null_after"))
                          & (F.col("length_before") == F.col("length_after"))
                          & F.col("__before").eqNullSafe(F.col("__after"))).drop("__before", "__after")


def line_hash_fraction(line) -> F.Column:
    """Integer in [0, 65536): the first 4 hex digits of md5(line)."""
    return F.conv(F.substring(F.md5(line), 1, 4), 16, 10).cast("int")


def sample_lines(spark: SparkSession, path: str, fraction: float, seed: int | None = None) -> DataFrame:
    """Non-blank lines of a text file, each kept with probability
    ``fraction``. With ``seed`` the draw is Spark's Bernoulli sample; without,
    a line is kept when its md5 falls under the fraction (repeatable).
    """
    lines = spark.read.text(path).filter(F.col("value") != "")
    if seed is not None:
        return lines.sample(withReplacement=False, fraction=float(fraction), seed=int(seed))
    return lines.filter(line_hash_fraction(F.col("value")) < F.lit(int(round(fraction * 65536))))
