"""Feature encoding: stash, index, one-hot, assemble, hash, impute
(F1-F9, F12, I1).

``StashEncoder.fit`` makes one pass over the training frame (the shared
vocabulary) and derives everything else from it: the keep lists, the
``StringIndexer`` label order, the one-hot slot of every label. Applying the
fitted encoder is map-only: broadcast keep-list joins and Spark ML
transformers, no further aggregation over the fact table. The one-hot
vector also has a long form ``(key, slot, feature, value)`` computed with
one join, which is what the SQL oracle checks.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.feature import FeatureHasher, Imputer, OneHotEncoder, StringIndexerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clicklens.operators import vocab as V
from clicklens.operators import wide
from clicklens.schema import INDEX_SUFFIX, STASHED_SUFFIX, VECTOR_SUFFIX
from clicklens.sources.io import table_from_rows, written

# Up to this many labels the vectors come from Spark ML stages, which hold the
# labels on the driver; beyond it they are built from a label join.
NARROW_LABELS = 200_000

# Texts of the two label classes.
LABEL_CLASSES = {0.0: ["0", "0.0", "false"], 1.0: ["1", "1.0", "true"]}


@dataclass
class StashEncoderModel:
    cols: list[str]
    vocab: DataFrame
    labels: DataFrame
    stash_values: dict
    kept_sizes: dict
    broadcast_cap: int = V.DEFAULT_BROADCAST_CAP
    null_to_stash: bool = True

    @property
    def stashed_cols(self) -> list[str]:
        return [c + STASHED_SUFFIX for c in self.cols]

    def stash(self, df: DataFrame, drop_input: bool = True) -> DataFrame:
        """F1/F2 on any frame with the fitted keep lists (unseen -> stash)."""
        return V.apply_stash(df, self.vocab, self.cols, self.stash_values,
                             broadcast_cap=self.broadcast_cap, drop_input=drop_input,
                             sizes=self.kept_sizes, null_to_stash=self.null_to_stash)

    def long_form(self, stashed: DataFrame, key: str) -> DataFrame:
        """F5/F6 long form: one row per active one-hot slot.

        Output: ``<key>, col_name, slot, feature, value``. A label unseen in
        the fitted vocabulary has no slot (all zeros), as with
        ``handleInvalid='keep'`` + ``dropLast``.
        """
        cols = self.stashed_cols
        text = stashed.select(key, *[F.col(c).cast("string").alias(c[:-len(STASHED_SUFFIX)]) for c in cols])
        long = text.unpivot([key], self.cols, "col_name", "label")
        labels = self.labels.select("col_name", "label", "slot", "feature")
        n_labels = sum(self.kept_sizes.values()) + len(self.cols)
        right = F.broadcast(labels) if n_labels <= self.broadcast_cap else labels
        joined = long.join(right, ["col_name", "label"], "inner")
        return joined.select(key, "col_name", "slot", "feature", F.lit(1.0).alias("value"))

    def label_arrays(self) -> list[list[str]]:
        """Labels per column in index order, on the driver, collected once per
        fitted model: for Spark ML stages of narrow encoders."""
        cached = getattr(self, "_label_arrays", None)
        if cached is not None:
            return cached
        rows = self.labels.select("col_name", "label", "idx").collect()
        by = {c: [] for c in self.cols}
        for r in rows:
            by[r["col_name"]].append((r["idx"], r["label"]))
        self._label_arrays = [[lab for _, lab in sorted(by[c])] for c in self.cols]
        return self._label_arrays

    def ml_pipeline(self, stashed_sample: DataFrame, output_col: str = "features",
                    extra_inputs: Sequence[str] = ()) -> PipelineModel:
        """Spark ML stages equal to the reference's indexers + encoder +
        assembler, built from the fitted labels (no refit pass); built once
        per output layout and reused for every frame (train, test, stream)."""
        cache = self.__dict__.setdefault("_pipelines", {})
        layout = (output_col, tuple(extra_inputs))
        if layout in cache:
            return cache[layout]
        idx_cols = [c + INDEX_SUFFIX for c in self.stashed_cols]
        vec_cols = [c + VECTOR_SUFFIX for c in self.cols]
        # one model per column: the multi-column factory pads short label
        # arrays with nulls, which the encoder then rejects
        indexers = [StringIndexerModel.from_labels(labels, inputCol=i, outputCol=o, handleInvalid="keep")
                    for labels, i, o in zip(self.label_arrays(), self.stashed_cols, idx_cols)]
        indexed = PipelineModel(stages=indexers).transform(stashed_sample.limit(0))
        encoder = OneHotEncoder(inputCols=idx_cols, outputCols=vec_cols, dropLast=True).fit(indexed)
        assembler = VectorAssembler(inputCols=list(extra_inputs) + vec_cols, outputCol=output_col,
                                    handleInvalid="keep")
        cache[layout] = PipelineModel(stages=indexers + [encoder, assembler])
        return cache[layout]

    def transform(self, df: DataFrame, output_col: str = "features",
                  extra_inputs: Sequence[str] = (), keep_stashed: bool = False,
                  keys: Sequence[str] | None = None) -> DataFrame:
        """Stash + index + one-hot + assemble; intermediate columns dropped.

        Encoders with many labels go through :meth:`wide_vectors` (``keys`` as there).
        """
        if not keep_stashed and sum(self.kept_sizes.values()) > NARROW_LABELS:
            return self.wide_vectors(df, keys, output_col, extra_inputs).drop(*self.cols)
        stashed = self.stash(df)
        model = self.ml_pipeline(stashed, output_col, extra_inputs)
        out = model.transform(stashed)
        drop = [c + INDEX_SUFFIX for c in self.stashed_cols] + [c + VECTOR_SUFFIX for c in self.cols]
        if not keep_stashed:
            drop += self.stashed_cols
        return out.drop(*drop)


    def catalog(self, extra_inputs: Sequence[str] = ()) -> DataFrame:
        """F8 from the fitted labels: ``idx, name`` of every entry of the vectors, extra inputs first."""
        k = len(extra_inputs)
        named = self.labels.select((F.col("slot") + k).cast("int").alias("idx"), F.col("feature").alias("name"))
        extra = [(i, c) for i, c in enumerate(extra_inputs)]
        return named.unionByName(table_from_rows(self.labels.sparkSession, extra, "idx int, name string")) if extra else named

    def written_labels(self) -> DataFrame:
        """The label table, written once per fitted model."""
        if "_written" not in self.__dict__:
            self._written = written(self.labels, "labels")
        return self._written

    def wide_vectors(self, df: DataFrame, keys: Sequence[str] | None = None, output_col: str = "features",
                     extra_inputs: Sequence[str] = ()) -> DataFrame:
        """F5/F6 for any number of labels: the vectors of :meth:`transform`, slots joined to the rows.

        Kept values meet the label table in one join of narrow rows; a value without a slot takes its
        column's stash slot. One row a column (the stash slots) and the width reach the driver, no label
        does. ``keys`` tell rows apart; without them the frame is written with a row number. The input
        columns stay.
        """
        labels = self.written_labels()
        stash = V.stash_text_by_column(self.stash_values, {c: df.schema[c].dataType for c in self.cols})
        own = {r["col_name"]: r["slot"] for r in labels.where(F.col("label") == stash).select("col_name", "slot").collect()}
        width = labels.count()
        frame = df if keys else wide.numbered(df)
        found = wide.label_slots(frame, list(keys or [wide.ROW]), self.cols,
                                 labels.select("col_name", F.col("label").alias("value"), "slot"), width, wide.hot_pairs(self.vocab))
        slots = [F.coalesce(F.col(f"__slot{i}"), F.lit(own.get(c)).cast("int")) for i, c in enumerate(self.cols)]
        if not self.null_to_stash:
            slots = [F.when(F.col(c).isNotNull(), s) for c, s in zip(self.cols, slots)]
        numbers = [F.col(c) for c in extra_inputs]
        return wide.sparse_vectors(found, numbers, slots, width, output_col).drop(wide.ROW)


class StashEncoder:
    """Fit the vocabulary once; counts strictly above the threshold (or above ``share`` of the rows) are kept."""

    def __init__(self, cols: Sequence[str], threshold, sentinels: Mapping[str, int] | None = None,
                 broadcast_cap: int = V.DEFAULT_BROADCAST_CAP, null_to_stash: bool = True,
                 share: float | None = None):
        self.cols = list(cols)
        self.threshold = threshold
        self.sentinels = dict(sentinels or {})
        self.broadcast_cap = broadcast_cap
        self.null_to_stash = null_to_stash
        self.share = share

    def fit(self, df: DataFrame) -> StashEncoderModel:
        vocab, sizes = V.fit_vocabulary(df, self.cols, self.threshold, self.sentinels, with_sizes=True, share=self.share)
        stash_values = {c: V.stash_value(df, c, self.sentinels.get(c)) for c in self.cols}
        labels = V.stash_labels(vocab, self.cols, stash_values, self.null_to_stash, sizes=sizes,
                                types={c: df.schema[c].dataType for c in self.cols})
        return StashEncoderModel(self.cols, vocab, labels, stash_values, sizes, self.broadcast_cap,
                                 self.null_to_stash)


def feature_catalog(df: DataFrame, features_col: str = "features") -> DataFrame:
    """F8: vector index to feature name, from the column's ML metadata.

    Output: ``idx int, name string`` (T3: order by idx). The metadata is one text on the driver; it
    becomes rows in Spark. Vectors made without metadata (:meth:`StashEncoderModel.wide_vectors`) have
    their names in :meth:`StashEncoderModel.catalog`.
    """
    attrs = df.schema[features_col].metadata.get("ml_attr", {}).get("attrs", {})
    one = table_from_rows(df.sparkSession, [(json.dumps(attrs),)], "attrs string")
    groups = F.from_json("attrs", "map<string, array<struct<idx: int, name: string>>>")
    entry = one.select(F.explode(F.flatten(F.map_values(groups))).alias("a"))
    return entry.select("a.idx", F.coalesce("a.name", F.lit("")).alias("name")).orderBy("idx")


def vector_rows(spark: SparkSession, vector, value: str) -> DataFrame:
    """The entries of one model vector as rows ``idx int, <value> double``; the vector travels whole."""
    one = spark.createDataFrame([(vector,)], T.StructType([T.StructField("v", VectorUDT())]))
    return one.select(F.posexplode(vector_to_array("v")).alias("idx", value))


def vector_entries(df: DataFrame, key: str, features_col: str = "features") -> DataFrame:
    """Sparse entries of an ML vector column without densifying it.

    The vector's stored form has its ``indices`` and ``values``; they are
    zipped and exploded on the JVM. Output: ``<key>, slot, value``.
    """
    tmp = df.select(key, F.unwrap_udt(features_col).alias("__v"))
    dense = F.transform(F.col("__v.values"), lambda x, i: F.struct(i.alias("slot"), x.alias("value")))
    sparse = F.arrays_zip(F.col("__v.indices").alias("slot"), F.col("__v.values").alias("value"))
    entries = F.when(F.col("__v.type") == 0, sparse).otherwise(dense)
    out = tmp.select(key, F.explode(entries).alias("__e"))
    return out.select(key, F.col("__e.slot").cast("int").alias("slot"), F.col("__e.value").alias("value")) \
        .filter(F.col("value") != 0)


def hash_features(df: DataFrame, cols: Sequence[str], num_features: int = 1 << 18,
                  categorical_cols: Sequence[str] = (), numeric_as_category: bool = False,
                  output_col: str = "features") -> DataFrame:
    """hashing trick (``FeatureHasher``). Numeric columns hash their name
    with the number as value, unless ``numeric_as_category``; strings hash
    ``col=value`` with 1.0; nulls are skipped; collisions add."""
    cats = list(categorical_cols)
    if numeric_as_category:
        numeric = [c for c, t in df.dtypes if c in cols and t not in ("string", "boolean")]
        cats = sorted(set(cats) | set(numeric))
    hasher = FeatureHasher(inputCols=list(cols), outputCol=output_col, numFeatures=int(num_features),
                           categoricalCols=cats)
    return hasher.transform(df)


def slot_dictionary(df: DataFrame, cols: Sequence[str], num_features: int = 1 << 18,
                    categorical_cols: Sequence[str] = (), numeric_as_category: bool = False) -> DataFrame:
    """the slot of every feature of :func:`hash_features`, from the hasher itself.

    The distinct ``column=value`` pairs (numeric columns: the column) become rows that hold that one
    value, and are hashed like the data. Output: ``slot, feature, col_name, value, n`` (n: rows).
    """
    types = {c: df.schema[c].dataType for c in cols}
    as_text = [c for c in cols if c in set(categorical_cols) or isinstance(types[c], (T.StringType, T.BooleanType))
               or numeric_as_category]
    by_name = [c for c in cols if c not in set(as_text)]
    counts = V.value_counts(df, as_text).where("value is not null") if as_text else None
    if by_name:
        one = df.agg(*[F.count(c).alias(c) for c in by_name]).unpivot([], by_name, "col_name", "n")
        names = one.select("col_name", F.lit(None).cast("string").alias("value"), "n")
        counts = counts.unionByName(names) if counts is not None else names
    held = [F.when(F.col("__c") == c, F.col("__v").cast(types[c]) if c in as_text else F.lit(1).cast(types[c])).alias(c) for c in cols]
    rows = counts.select(F.col("col_name").alias("__c"), F.col("value").alias("__v"), F.col("n").alias("__n")).select("*", *held)
    hashed = hash_features(rows, cols, num_features, categorical_cols, numeric_as_category, "__x")
    feature = F.concat(F.col("__c"), F.coalesce(F.concat(F.lit("="), F.col("__v")), F.lit("")))
    return hashed.select(F.unwrap_udt("__x")["indices"][0].alias("slot"), feature.alias("feature"), F.col("__c").alias("col_name"),
                         F.col("__v").alias("value"), F.col("__n").alias("n"))


def slot_collisions(dictionary: DataFrame) -> DataFrame:
    """slots of :func:`slot_dictionary` that several features share. Output: ``slot, features, rows``."""
    per = dictionary.groupBy("slot").agg(F.count(F.lit(1)).cast("bigint").alias("features"), F.sum("n").cast("bigint").alias("rows"))
    return per.filter(F.col("features") > 1)


def hashed_weights(coefficients: Sequence[tuple[int, float]], dictionary: DataFrame) -> DataFrame:
    """Weights of a hashed model with the names behind their slots.

    ``coefficients`` are (slot, weight) of the weights that aren't zero, at most the hash width.
    Output: ``slot, coeff, feature, features`` (how many share the slot); one row a feature.
    """
    spark = dictionary.sparkSession
    weights = table_from_rows(spark, list(coefficients), "slot int, coeff double")
    shared = dictionary.groupBy("slot").agg(F.count(F.lit(1)).cast("bigint").alias("features"))
    return (weights.join(dictionary.select("slot", "feature"), "slot", "left").join(shared, "slot", "left")
            .select("slot", "coeff", "feature", "features"))


def levels(df: DataFrame, col: str, most: int = 1000) -> list:
    """Distinct non-null values in order; more than ``most`` raises, as each becomes a column."""
    found = [r[0] for r in df.select(col).where(F.col(col).isNotNull()).distinct().orderBy(col).limit(most + 1).collect()]
    if len(found) > most:
        raise ValueError(f"{col} has more than {most} levels")
    return found


def dummy_columns(df: DataFrame, col: str, values: Sequence[str] | None = None, drop: Sequence[str] = (),
                  prefix: str | None = None) -> DataFrame:
    """wide 0/1 columns for a low-cardinality column, as a projection
    (no pivot shuffle). Null and unlisted values give all zeros; ``drop``
    removes base columns. Without ``values`` they are read from the data."""
    values = levels(df, col) if values is None else values
    prefix = prefix if prefix is not None else col + "_"
    keep = [v for v in values if v not in set(drop)]
    return df.select("*", *[F.when(F.col(col) == F.lit(v), F.lit(1)).otherwise(F.lit(0)).alias(prefix + str(v))
                            for v in keep])


def impute_numeric(df: DataFrame, cols: Sequence[str], sentinel=-1, flag_suffix: str = "_missing",
                   strategy: str | None = None) -> DataFrame:
    """Numerics without nulls for tree learners (which reject NaN).

    Default: ``coalesce(c, sentinel)`` plus a 0/1 missing flag per column.
    ``strategy='median'`` or ``'mean'`` uses ``ml.feature.Imputer`` instead
    (approximate quantiles, one pass).
    """
    cols = list(cols)
    if strategy:
        dbl = df.select("*", *[F.col(c).cast("double").alias(f"__{c}") for c in cols])
        imp = Imputer(inputCols=[f"__{c}" for c in cols], outputCols=[f"{c}_imp" for c in cols],
                      strategy=strategy).fit(dbl)
        return imp.transform(dbl).drop(*[f"__{c}" for c in cols])
    out = df
    for c in cols:
        dtype = df.schema[c].dataType
        out = out.withColumn(c + flag_suffix, F.col(c).isNull().cast("int")) \
                 .withColumn(c, F.coalesce(F.col(c), F.lit(sentinel).cast(dtype)))
    return out


def label_index(df: DataFrame, label: str, output_col: str = "label") -> DataFrame:
    """label to 0.0 / 1.0 by a fixed mapping of its text (``LABEL_CLASSES``), so class 1
    is always "clicked", whatever classes the data hold. Another label, null included, is an
    error when the rows are computed."""
    text = F.lower(F.col(label).cast("string"))
    index = F.lit(None).cast("double")
    for value, names in LABEL_CLASSES.items():
        index = F.when(text.isin(names), F.lit(value)).otherwise(index)
    bad = F.raise_error(F.concat(F.lit(f"no class for the label in {label}: "), F.coalesce(text, F.lit("null"))))
    return df.withColumn(output_col, F.coalesce(index, bad.cast("double")))
