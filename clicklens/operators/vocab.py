"""Value counts, rare-value stashing and vocabulary reports (A2, A3, F1, F2,
F10, F11, A18).

Plan shape: all columns are unpivoted in one projection and counted by one
``groupBy(column, value)``, so the fact table is scanned once and the shuffle
carries partial counts only (map-side combine absorbs hot values such as
null). A short keep list is a set in the plan, a longer one a broadcast join
after its number of values has been checked against a cap; all columns with
longer lists share one shuffle of the table (``operators.wide``). A written
vocabulary holds the kept values and one total of the others a column.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clicklens.operators import heavy, wide
from clicklens.schema import STASH_PREFIX, STASHED_SUFFIX, VECTOR_SUFFIX
from clicklens.sources.io import written

# A keep list above this many values per column is joined by shuffle, not
# broadcast; and all broadcast keep lists of one frame together stay under
# the total cap (smallest columns are broadcast first).
DEFAULT_BROADCAST_CAP = 500_000
TOTAL_BROADCAST_CAP = 2_000_000
# A keep list of at most this many values is collected (one small job for all
# such columns) and tested with ``isin`` (a hash set in the plan): no join and
# no broadcast job per column.
INSET_CAP = 200


def _literal_map(values: Mapping) -> Column:
    items = []
    for k, v in values.items():
        items += [F.lit(k), v if isinstance(v, Column) else F.lit(v)]
    return F.create_map(*items)


def in_list(column: str, values: Sequence[str]) -> Column:
    """Does the column's text occur in ``values``? The values are literals of the
    plan, never SQL text, so no character of theirs has a meaning."""
    return F.col(column).cast("string").isin(list(values)) if values else F.lit(False)


def _thresholds(cols: Sequence[str], threshold) -> dict:
    if isinstance(threshold, Mapping):
        return {c: int(threshold[c]) for c in cols}
    return {c: int(threshold) for c in cols}


def share_threshold(df: DataFrame, share: float) -> int:
    """A share of the rows as a count threshold. A column then keeps fewer than
    1 / share values, whatever the number of rows."""
    return int(df.count() * share)


def value_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """A2/A3: rows per (column, value) for every column in one scan.

    Values are compared as strings (the form ``StringIndexer`` uses); the null
    group is kept. Output: ``col_name string, value string, n bigint``.
    """
    cols = list(cols)
    as_text = df.select([F.col(c).cast("string").alias(c) for c in cols])
    long = as_text.unpivot([], cols, "col_name", "value")
    return long.groupBy("col_name", "value").agg(F.count(F.lit(1)).alias("n"))


def vocabulary(df: DataFrame, cols: Sequence[str], threshold) -> DataFrame:
    """A3 + P9: value counts with a ``kept`` flag (count strictly above the
    column's threshold, never null)."""
    t = _thresholds(cols, threshold)
    counts = value_counts(df, cols)
    limit = _literal_map(t)[F.col("col_name")]
    return counts.withColumn("kept", F.col("value").isNotNull() & (F.col("n") > limit))


def stash_value(df: DataFrame, column: str, sentinel=None):
    """Stash literal of a column: ``stash_<col>`` for strings, the sentinel
    (typed like the column) for numerics."""
    dtype = df.schema[column].dataType
    if isinstance(dtype, T.StringType):
        return STASH_PREFIX + column
    if sentinel is None:
        raise ValueError(f"numeric column {column} needs a sentinel stash value")
    return sentinel


def kept_counts(vocab: DataFrame) -> dict:
    """Number of kept values per column (one row per column to the driver)."""
    rows = vocab.filter("kept").groupBy("col_name").count().collect()
    return {r["col_name"]: r["count"] for r in rows}


def apply_stash(df: DataFrame, vocab: DataFrame, cols: Sequence[str],
                stash_values: Mapping[str, object], *,
                broadcast_cap: int = DEFAULT_BROADCAST_CAP,
                drop_input: bool = True,
                sizes: Mapping[str, int] | None = None,
                null_to_stash: bool = True,
                inset_cap: int = INSET_CAP,
                keys: Sequence[str] | None = None) -> DataFrame:
    """F1/F2 apply step: ``<col>_t`` = value if kept, else the stash value.

    Null is stashed by default, as in the reference (``x IN (...)`` is
    never true for null); ``null_to_stash=False`` leaves null as null (the
    indexer's invalid bucket, i.e. no active slot). Keep lists of at most
    ``inset_cap`` values are tested with ``isin``, longer ones by a broadcast
    join each, one beyond ``broadcast_cap`` by a join on its values, several
    together in one shuffle. ``keys`` tell rows apart in that shuffle; without
    them the frame is written once with a row number.
    """
    sizes = dict(sizes) if sizes is not None else kept_counts(vocab)
    inset_cols = [c for c in cols if sizes.get(c, 0) <= inset_cap]
    inset_values = {c: [] for c in inset_cols}
    if inset_cols and any(sizes.get(c, 0) for c in inset_cols):
        rows = (vocab.filter(F.col("kept") & F.col("col_name").isin(inset_cols))
                .select("col_name", "value").collect())
        for r in rows:
            inset_values[r["col_name"]].append(r["value"])
    broadcast_cols = set()
    budget = min(TOTAL_BROADCAST_CAP, broadcast_cap * max(1, len(cols)))
    for c in sorted((c for c in cols if c not in inset_values), key=lambda x: sizes.get(x, 0)):
        size = sizes.get(c, 0)
        if size <= broadcast_cap and size <= budget:
            broadcast_cols.add(c)
            budget -= size
    out, flags = df, {}
    wide_cols = [c for c in cols if c not in inset_values and c not in broadcast_cols]
    if wide_cols:
        own = vocab.filter(F.col("col_name").isin(wide_cols))
        hot = wide.hot_pairs(own)
        if len(wide_cols) == 1:
            out, found = wide.kept_flag(df, wide_cols[0], own.filter("kept"), hot.get(wide_cols[0], []))
            flags = {wide_cols[0]: found}
        else:
            out = df if keys else wide.numbered(df)
            out, found = wide.kept_flags(out, list(keys or [wide.ROW]), wide_cols, own.filter("kept"),
                                         sum(sizes.get(c, 0) for c in wide_cols), hot)
            flags = dict(zip(wide_cols, found))
    keeps = []
    for i, c in enumerate(cols):
        kname = f"__keep{i}"
        if c not in broadcast_cols:
            keeps.append(None)
            continue
        keep = (vocab.filter(F.col("kept") & (F.col("col_name") == c))
                .select(F.col("value").alias(kname)))
        key = F.col(c).cast("string")
        out = out.join(F.broadcast(keep), key == F.col(kname), "left")
        keeps.append(kname)
    # one projection for all columns (instead of a withColumn/drop per column)
    stashed = []
    for c, kname in zip(cols, keeps):
        dtype = df.schema[c].dataType
        if kname is None:
            kept = flags[c] if c in flags else in_list(c, inset_values[c])
            value = F.when(kept, F.col(c))
        else:
            value = F.when(F.col(kname).isNotNull(), F.col(c))
        if not null_to_stash:
            value = value.when(F.col(c).isNull(), F.lit(None).cast(dtype))
        stashed.append(value.otherwise(F.lit(stash_values[c]).cast(dtype)).alias(c + STASHED_SUFFIX))
    dropped = set(cols) if drop_input else set()
    return out.select(*[F.col(x) for x in df.columns if x not in dropped], *stashed)


def stash_text(value, dtype: T.DataType) -> Column:
    """Text of a stash value as its column shows it (1 is "1.0" in a double column)."""
    return F.lit(value).cast(dtype).cast("string")


def stash_text_by_column(stash_values: Mapping[str, object], types: Mapping[str, T.DataType]) -> Column:
    """The stash value of the column named in ``col_name``, as its column shows it."""
    return _literal_map({c: stash_text(v, types[c]) for c, v in stash_values.items()})[F.col("col_name")]


def vocabulary_stats(vocab: DataFrame, stashes: Mapping[str, object] | None = None) -> dict:
    """Kept-value count per column, and D14 (a stash value that already occurs in
    its column raises), from one aggregate with one row per column. ``stashes``
    holds the stash of each column, as text or as a text column.
    """
    stashes = {c: s if isinstance(s, Column) else str(s) for c, s in (stashes or {}).items()}
    sent = _literal_map(stashes) if stashes else None
    clash = (F.col("value") == sent[F.col("col_name")]) if sent is not None else F.lit(False)
    rows = vocab.groupBy("col_name").agg(
        F.count_if("kept").alias("kept"), F.max(F.coalesce(clash, F.lit(False))).alias("clash")).collect()
    bad = sorted(r["col_name"] for r in rows if r["clash"])
    if bad:
        raise ValueError(f"the stash value occurs as a real value in {bad}")
    return {r["col_name"]: r["kept"] for r in rows}


def fit_vocabulary(df: DataFrame, cols: Sequence[str], threshold,
                   sentinels: Mapping[str, int] | None = None, *,
                   with_sizes: bool = False, share: float | None = None):
    """Kept values with their counts, and the other rows as one total a column (nulls
    apart), written once, so the size check and the joins share them.

    With ``share`` (of the rows) instead of ``threshold``, candidates come from a
    heavy-hitter sketch and only they are counted by value; a share too small for a
    sketch becomes a count. With ``with_sizes`` also returns the kept count per column
    (the same one-row-per-column job that checks the stash values: ``stash_<col>`` of
    string columns, the sentinels of others).
    """
    sentinels = dict(sentinels or {})
    stashes = {c: stash_text(stash_value(df, c, sentinels.get(c)), df.schema[c].dataType) for c in cols
               if c in sentinels or isinstance(df.schema[c].dataType, T.StringType)}
    if share is not None and heavy.sketch_items(share):
        vocab = heavy.heavy_vocabulary(df, cols, share, stashes)
    else:
        counts = vocabulary(df, cols, share_threshold(df, share) if share is not None else threshold)
        vocab = heavy.compacted(counts, _literal_map(stashes)[F.col("col_name")] if stashes else F.lit(None).cast("string"))
    vocab = written(vocab, "vocabulary")
    sizes = vocabulary_stats(vocab, stashes)
    return (vocab, sizes) if with_sizes else vocab


def stash_rare(df: DataFrame, cols: Sequence[str], threshold, *,
               sentinels: Mapping[str, int] | None = None,
               vocab: DataFrame | None = None,
               broadcast_cap: int = DEFAULT_BROADCAST_CAP,
               drop_input: bool = True, share: float | None = None,
               keys: Sequence[str] | None = None) -> DataFrame:
    """F1 (strings) and F2 (numerics with sentinels) in one call.

    ``vocab`` may come from a different frame (fit on train, apply to test);
    ``share`` stands for ``threshold``, see :func:`fit_vocabulary`.
    """
    sentinels = dict(sentinels or {})
    sizes = None
    if vocab is None:
        vocab, sizes = fit_vocabulary(df, cols, threshold, sentinels, with_sizes=True, share=share)
    values = {c: stash_value(df, c, sentinels.get(c)) for c in cols}
    return apply_stash(df, vocab, cols, values, broadcast_cap=broadcast_cap, drop_input=drop_input,
                       sizes=sizes, keys=keys)


# Above this many kept labels in one column, the label order is computed by
# one distributed sort instead of a window per column.
WINDOW_LABELS_CAP = 1_000_000


def stash_labels(vocab: DataFrame, cols: Sequence[str],
                 stash_values: Mapping[str, object], null_to_stash: bool = True,
                 sizes: Mapping[str, int] | None = None,
                 window_cap: int = WINDOW_LABELS_CAP,
                 types: Mapping[str, T.DataType] | None = None) -> DataFrame:
    """Labels of the stashed columns with their ``StringIndexer`` order.

    Output: ``col_name, label, n, idx, size, base_slot, slot, feature``. ``idx``
    follows frequency descending then label ascending; ``slot`` is the
    position in the assembled one-hot vector (columns in the given order,
    each column one slot per label, since the invalid bucket is dropped).
    Row count = number of labels (bounded by rows / threshold per column).
    ``types`` gives the columns' types, so that a stash label reads as in the data.
    """
    cols = list(cols)
    types = dict(types or {})
    texts = _literal_map({c: stash_text(stash_values[c], types[c]) if c in types else str(stash_values[c]) for c in cols})
    position = _literal_map({c: i for i, c in enumerate(cols)})
    kept = vocab.filter("kept").select("col_name", F.col("value").alias("label"), "n")
    rare_rows = ~F.col("kept") if null_to_stash else (~F.col("kept") & F.col("value").isNotNull())
    rare = (vocab.filter(rare_rows).groupBy("col_name").agg(F.sum("n").alias("n"))
            .select("col_name", texts[F.col("col_name")].alias("label"), "n"))
    labels = kept.unionByName(rare)
    by_col = Window.partitionBy("col_name")
    if sizes is not None and max(list(sizes.values()) or [0]) > window_cap:
        # large vocabularies: one range-partitioned sort over all columns, then
        # idx = global position - the column's first position (one row per column)
        from clicklens.operators.ordered import global_position

        pos, _ = global_position(labels.withColumn("__cpos", position[F.col("col_name")]),
                                 F.asc("__cpos"), F.desc("n"), F.asc("label"))
        first = pos.groupBy("col_name").agg(F.min("__pos").alias("__first"),
                                            F.count(F.lit(1)).cast("int").alias("size"))
        labels = (pos.join(F.broadcast(first), "col_name")
                  .withColumn("idx", (F.col("__pos") - F.col("__first")).cast("int"))
                  .drop("__pos", "__first", "__cpos"))
    else:
        labels = (labels
                  .withColumn("idx", (F.row_number().over(by_col.orderBy(F.desc("n"), F.asc("label"))) - 1)
                              .cast("int"))
                  .withColumn("size", F.count(F.lit(1)).over(by_col).cast("int")))
    # offsets come from one row per column, so this window sees #columns rows
    sizes = labels.select("col_name", "size").distinct().withColumn("pos", position[F.col("col_name")])
    sizes = sizes.withColumn(
        "base_slot",
        F.coalesce(F.sum("size").over(Window.orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)),
                   F.lit(0)).cast("int"))
    labels = labels.join(F.broadcast(sizes.select("col_name", "base_slot")), "col_name")
    return labels.select(
        "col_name", "label", "n", "idx", "size", "base_slot",
        (F.col("base_slot") + F.col("idx")).alias("slot"),
        F.concat(F.col("col_name"), F.lit(VECTOR_SUFFIX + "_"), F.col("label")).alias("feature"),
    )


def encoded_width(vocab: DataFrame) -> DataFrame:
    """One-hot width per column and in total.

    Width of a column = kept non-null values, plus one when any row stashes.
    Output: ``col_name, kept_values, stash_rows, width`` plus a ``*`` total row.
    """
    per = vocab.groupBy("col_name").agg(
        F.count_if("kept").cast("bigint").alias("kept_values"),
        F.coalesce(F.sum(F.when(~F.col("kept"), F.col("n"))), F.lit(0)).cast("bigint").alias("stash_rows"))
    per = per.withColumn(
        "width", (F.col("kept_values") + (F.col("stash_rows") > 0).cast("bigint")).cast("bigint"))
    total = per.agg(
        F.lit("*").alias("col_name"),
        F.sum("kept_values").cast("bigint").alias("kept_values"),
        F.sum("stash_rows").cast("bigint").alias("stash_rows"),
        F.sum("width").cast("bigint").alias("width"))
    return per.unionByName(total)


def threshold_sweep(counts: DataFrame, thresholds: Sequence[int]) -> DataFrame:
    """width and row coverage of each column at several thresholds.

    ``counts`` is :func:`value_counts` output; the thresholds are a short
    literal list expanded by ``explode`` (no join).
    Output: ``threshold, col_name, kept_values, kept_rows, total_rows, width``.
    """
    exp = counts.withColumn("threshold", F.explode(F.array(*[F.lit(int(t)) for t in thresholds])))
    kept = F.col("value").isNotNull() & (F.col("n") > F.col("threshold"))
    per = exp.groupBy("threshold", "col_name").agg(
        F.count_if(kept).cast("bigint").alias("kept_values"),
        F.coalesce(F.sum(F.when(kept, F.col("n"))), F.lit(0)).cast("bigint").alias("kept_rows"),
        F.sum("n").cast("bigint").alias("total_rows"))
    return per.withColumn(
        "width",
        (F.col("kept_values") + (F.col("kept_rows") < F.col("total_rows")).cast("bigint")).cast("bigint"))


def hash_slot(text: Column, num_features: int) -> Column:
    """Slot of a feature string: first 8 hex digits of its md5, modulo m."""
    return F.pmod(F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint"),
                  F.lit(int(num_features))).cast("bigint")


def hash_collisions(counts: DataFrame, num_features: int) -> DataFrame:
    """slots shared by more than one ``column=value`` feature.

    Output: ``slot, features, rows``: number of distinct features and rows
    hashed into each colliding slot.
    """
    feats = counts.filter(F.col("value").isNotNull()).select(
        F.concat(F.col("col_name"), F.lit("="), F.col("value")).alias("feature"), "n")
    per = feats.groupBy(hash_slot(F.col("feature"), num_features).alias("slot")).agg(
        F.count(F.lit(1)).cast("bigint").alias("features"),
        F.sum("n").cast("bigint").alias("rows"))
    return per.filter(F.col("features") > 1)
