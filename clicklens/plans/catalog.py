"""Registered queries: each a Spark plan over the given tables, paired with
the DuckDB SQL that must return the same rows (when one exists).

Every query reads whole tables; doubles are rounded to 6 places and counts
cast to BIGINT on both sides so that values hash alike.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as _T

from clicklens import fixtures as fx
from clicklens.functions import scalar
from clicklens.operators import features as fe
from clicklens.operators import metrics, models, ordered, profile, report, split, vocab
from clicklens.plans import jobs
from clicklens.plans import sqltext as sq
from clicklens.session import scratch_path
from clicklens.sources import io

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


IMP = fx.IMPRESSIONS
T = fx.FIXTURE_THRESHOLDS


# ---------------------------------------------------------------- flagship
@register("stash_ctr", sq.with_impressions(
    """SELECT CASE WHEN k.value IS NOT NULL THEN imp.cat4 ELSE 'stash_cat4' END AS cat4_t,
              CAST(COUNT(*) AS BIGINT) AS n_rows,
              CAST(SUM(y) AS BIGINT) AS clicks,
              round(AVG(y), 6) AS ctr
       FROM imp LEFT JOIN keep k ON imp.cat4 = k.value
       WHERE imp.y IS NOT NULL
       GROUP BY 1""",
    f"keep AS (SELECT value FROM ({sq.vocab_sql(['cat4'], T, 'imp')}) v WHERE kept)"))
def stash_ctr(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Minimum slice: stash rare ``cat4`` values (fit on all rows, as the
    reference does), then click rate per stashed value over labelled rows."""
    imp = fx.impressions(spark, sf_dir)
    st = vocab.stash_rare(imp, ["cat4"], T)
    return (fx.labelled(st).groupBy("cat4_t").agg(
        F.count(F.lit(1)).cast("bigint").alias("n_rows"),
        F.sum("y").cast("bigint").alias("clicks"),
        F.round(F.avg("y"), 6).alias("ctr")))


# ---------------------------------------------------------------- profiles

IMP_COLS = ["id", "y", "n1", "n2", "n3", "n4", "n5", "cat1", "cat2", "cat3", "cat4"]
FEATURES = list(IMP.numeric) + list(IMP.categorical)
NUMS = list(IMP.numeric)
IMP_TYPES = {"id": "bigint", "y": "int", "n1": "int", "n2": "int", "n3": "int", "n4": "int",
             "n5": "bigint", "cat1": "string", "cat2": "string", "cat3": "string", "cat4": "string"}


def _union(parts):
    return " UNION ALL ".join(parts)


@register("null_profile", sq.with_impressions(
    "SELECT col_name, CAST(nulls AS BIGINT) AS nulls, round(CAST(nulls AS DOUBLE) * 100.0 / rows, 6) AS null_pct "
    "FROM (" + _union([f"SELECT '{c}' AS col_name, count(*) FILTER (WHERE {c} IS NULL) AS nulls, "
                       f"count(*) AS rows FROM imp" for c in IMP_COLS]) + ") t"))
def q_null_profile(spark, sf_dir):
    return profile.null_profile(fx.impressions(spark, sf_dir), IMP_COLS)


@register("schema_profile", sq.with_impressions(
    _union([f"SELECT '{c}' AS col_name, '{IMP_TYPES[c]}' AS data_type, CAST(count({c}) AS BIGINT) AS non_null "
            f"FROM imp" for c in IMP_COLS])))
def q_schema_profile(spark, sf_dir):
    return profile.schema_profile(fx.impressions(spark, sf_dir), IMP_COLS)


@register("class_balance", sq.with_impressions(
    "SELECT y AS label, CAST(count(*) AS BIGINT) AS n, "
    "round(CAST(count(*) AS DOUBLE) / sum(count(*)) OVER (), 6) AS share FROM imp GROUP BY y"))
def q_class_balance(spark, sf_dir):
    return profile.class_balance(fx.impressions(spark, sf_dir), "y")


@register("mean_by_label", sq.with_impressions(
    _union([f"SELECT y AS label, '{c}' AS col_name, round(avg({c}), 6) AS mean FROM imp "
            f"WHERE y IS NOT NULL GROUP BY y" for c in NUMS])))
def q_mean_by_label(spark, sf_dir):
    return profile.mean_by_label(fx.impressions(spark, sf_dir), "y", NUMS)


@register("median_by_label", sq.with_impressions(
    _union([f"SELECT y AS label, '{c}' AS col_name, round(CAST(median({c}) AS DOUBLE), 6) AS median FROM imp "
            f"WHERE y IS NOT NULL GROUP BY y" for c in NUMS])))
def q_median_by_label(spark, sf_dir):
    return profile.median_by_label(fx.impressions(spark, sf_dir), "y", NUMS)


_PAIRS = [(a, b) for i, a in enumerate(NUMS) for b in NUMS[i + 1:]]
_CORR_SQL = _union([f"SELECT '{a}' AS col_a, '{b}' AS col_b, round(corr({a}, {b}), 3) AS corr FROM imp"
                    for a, b in _PAIRS])


@register("correlation_matrix", sq.with_impressions(_CORR_SQL))
def q_correlation_matrix(spark, sf_dir):
    return profile.correlation_matrix(fx.impressions(spark, sf_dir), NUMS)


@register("correlated_pairs", sq.with_impressions(
    """SELECT direction, CAST(rank AS INTEGER) AS rank, col_a, col_b, corr FROM (
         SELECT 'positive' AS direction, row_number() OVER (ORDER BY corr DESC, col_a, col_b) AS rank, *
         FROM cm WHERE corr > 0
         UNION ALL
         SELECT 'negative' AS direction, row_number() OVER (ORDER BY corr ASC, col_a, col_b) AS rank, *
         FROM cm WHERE corr < 0) t WHERE rank <= 5""",
    f"cm AS ({_CORR_SQL})"))
def q_correlated_pairs(spark, sf_dir):
    return profile.correlated_pairs(q_correlation_matrix(spark, sf_dir), 5)


_COUNTS = f"counts AS ({sq.counts_sql(FEATURES, 'imp')})"


@register("top_values", sq.with_impressions(
    """SELECT col_name, CAST(rn AS INTEGER) AS rank, value, CAST(n AS BIGINT) AS n,
              round(CAST(n AS DOUBLE) * 100.0 / total, 6) AS pct
       FROM (SELECT *, row_number() OVER (PARTITION BY col_name ORDER BY n DESC, value ASC NULLS LAST) AS rn,
                    sum(n) OVER (PARTITION BY col_name) AS total FROM counts) r
       WHERE rn <= 5""", _COUNTS))
def q_top_values(spark, sf_dir):
    return profile.top_values(fx.impressions(spark, sf_dir), FEATURES, 5)


@register("cardinality_profile", sq.with_impressions(
    """SELECT col_name, CAST(count(*) FILTER (WHERE value IS NOT NULL) AS BIGINT) AS distinct_values,
              round(CAST(count(*) FILTER (WHERE value IS NOT NULL) AS DOUBLE) * 100.0 / sum(n), 6) AS distinct_pct
       FROM counts GROUP BY col_name""", _COUNTS))
def q_cardinality_profile(spark, sf_dir):
    return profile.cardinality_profile(fx.impressions(spark, sf_dir), FEATURES)


@register("feature_flags", sq.with_impressions(
    """SELECT col_name, round(null_share, 6) AS null_share, round(top_share, 6) AS top_share,
              round(distinct_share, 6) AS distinct_share,
              null_share > 0.20 AS many_nulls, null_share > 0.33 AS mostly_null,
              top_share > 0.20 AS dominated, distinct_share > 0.20 AS many_distinct
       FROM (SELECT col_name,
                    CAST(coalesce(sum(n) FILTER (WHERE value IS NULL), 0) AS DOUBLE) / sum(n) AS null_share,
                    CAST(max(n) AS DOUBLE) / sum(n) AS top_share,
                    CAST(count(*) FILTER (WHERE value IS NOT NULL) AS DOUBLE) / sum(n) AS distinct_share
             FROM counts GROUP BY col_name) t""", _COUNTS))
def q_feature_flags(spark, sf_dir):
    return profile.feature_flags(fx.impressions(spark, sf_dir), FEATURES)


# ---------------------------------------------------------------- metrics
@register("confusion_counts", sq.with_scored(
    """SELECT tp, tn, fp, fn, positives, negatives,
              CASE WHEN tp + fp = 0 THEN NULL ELSE round(CAST(tp AS DOUBLE) * 100.0 / (tp + fp), 6) END AS precision_pct,
              CASE WHEN tp + fn = 0 THEN NULL ELSE round(CAST(tp AS DOUBLE) * 100.0 / (tp + fn), 6) END AS recall_pct
       FROM (SELECT CAST(count(*) FILTER (WHERE label = 1 AND prediction = 1) AS BIGINT) AS tp,
                    CAST(count(*) FILTER (WHERE label = 0 AND prediction = 0) AS BIGINT) AS tn,
                    CAST(count(*) FILTER (WHERE label = 0 AND prediction = 1) AS BIGINT) AS fp,
                    CAST(count(*) FILTER (WHERE label = 1 AND prediction = 0) AS BIGINT) AS fn,
                    CAST(count(*) FILTER (WHERE label = 1) AS BIGINT) AS positives,
                    CAST(count(*) FILTER (WHERE label = 0) AS BIGINT) AS negatives FROM sc) t"""))
def q_confusion_counts(spark, sf_dir):
    return metrics.confusion_counts(fx.scored(spark, sf_dir))


@register("baseline_log_loss", sq.with_impressions(
    """SELECT rows, round(p, 6) AS base_rate,
              round(rate * -ln(p + 1e-16) + (1.0 - rate) * -ln(1.0 - p + 1e-16), 6) AS baseline_log_loss
       FROM (SELECT CAST(count(*) AS BIGINT) AS rows, avg(CAST(y AS DOUBLE)) AS p,
                    avg(CAST(y > 0 AS DOUBLE)) AS rate FROM imp WHERE y IS NOT NULL) t"""))
def q_baseline_log_loss(spark, sf_dir):
    return metrics.baseline_log_loss(fx.labelled(fx.impressions(spark, sf_dir)), "y")


_CLIPPED = "least(greatest(prob, 1e-15), 1.0 - 1e-15)"


@register("mean_log_loss", sq.with_scored(
    f"""SELECT CAST(count(*) AS BIGINT) AS rows,
               round(avg(CASE WHEN label = 1 THEN -ln({_CLIPPED}) ELSE -ln(1.0 - {_CLIPPED}) END), 6) AS log_loss
        FROM sc"""))
def q_mean_log_loss(spark, sf_dir):
    return metrics.mean_log_loss(fx.scored(spark, sf_dir), "label", "prob")


@register("sql_log_loss", sq.with_scored(
    f"""SELECT CAST(count(*) AS BIGINT) AS rows,
               round(avg(CASE WHEN label = 1 THEN -ln({_CLIPPED}) ELSE -ln(1.0 - {_CLIPPED}) END), 6) AS log_loss
        FROM sc"""))
def q_sql_log_loss(spark, sf_dir):
    """K2: the loss as a SQL-registered function called from SQL text."""
    scalar.register_sql_functions(spark)
    fx.scored(spark, sf_dir).createOrReplaceTempView("clicklens_scored")
    return spark.sql("SELECT CAST(count(*) AS BIGINT) AS rows, "
                     "round(avg(log_loss(label, prob)), 6) AS log_loss FROM clicklens_scored")


@register("eps_log_loss", sq.with_scored(
    """SELECT CAST(count(*) AS BIGINT) AS rows,
              round(avg(CASE WHEN label > 0 THEN -ln(prob + 1e-16) ELSE -ln(1.0 - prob + 1e-16) END), 6) AS log_loss
       FROM sc"""))
def q_eps_log_loss(spark, sf_dir):
    """The LR scripts' loss, epsilon inside the log, label > 0 branch."""
    sc = fx.scored(spark, sf_dir)
    return sc.agg(F.count(F.lit(1)).cast("bigint").alias("rows"),
                  F.round(F.avg(scalar.log_loss_eps("label", "prob")), 6).alias("log_loss"))


@register("sigmoid_residuals", sq.with_scored(
    """SELECT id, label, round(1.0 / (1.0 + exp(-raw)), 6) AS calc_prob,
              round(CAST(label AS DOUBLE) - prob, 6) AS residual, round(exp(raw), 6) AS odds
       FROM sc"""))
def q_sigmoid_residuals(spark, sf_dir):
    """X3 sigmoid of the raw score, X5 odds and M14 residual per row."""
    sc = metrics.residuals(fx.scored(spark, sf_dir), "label", "prob")
    return sc.select("id", "label", F.round(scalar.sigmoid("raw"), 6).alias("calc_prob"),
                     F.round("residual", 6).alias("residual"),
                     F.round(scalar.odds("raw"), 6).alias("odds"))


@register("durbin_watson", sq.with_scored(
    """SELECT CAST(count(*) AS BIGINT) AS rows, round(sum(d2) / sum(e * e), 6) AS dw
       FROM (SELECT e, (e - lag(e) OVER (ORDER BY id)) * (e - lag(e) OVER (ORDER BY id)) AS d2
             FROM (SELECT id, CAST(label AS DOUBLE) - prob AS e FROM sc) a) b"""))
def q_durbin_watson(spark, sf_dir):
    return metrics.durbin_watson(fx.scored(spark, sf_dir), "id", "label", "prob")


@register("auroc", sq.with_scored(
    """SELECT CAST(sum(pos) AS BIGINT) AS positives, CAST(sum(neg) AS BIGINT) AS negatives,
              round(sum(CAST(pos AS DOUBLE) * (below + neg * 0.5)) / (CAST(sum(pos) AS DOUBLE) * sum(neg)), 6) AS auroc
       FROM (SELECT *, coalesce(sum(neg) OVER (ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below
             FROM (SELECT prob AS s, count(*) FILTER (WHERE label = 1) AS pos, count(*) FILTER (WHERE label = 0) AS neg
                   FROM sc WHERE label IN (0, 1) AND prob IS NOT NULL GROUP BY prob) p) c"""))
def q_auroc(spark, sf_dir):
    return metrics.auroc(fx.scored(spark, sf_dir), "label", "prob")


# ---------------------------------------------------------------- vocabulary and encoding

SENT = fx.IMPRESSION_SENTINELS
_VOCAB = f"vocab AS ({sq.vocab_sql(FEATURES, T, 'imp')})"


def _encoder(imp):
    return fe.StashEncoder(FEATURES, T, SENT).fit(imp)


@register("vocabulary", sq.with_impressions(
    "SELECT col_name, value, CAST(n AS BIGINT) AS n, kept FROM vocab", _VOCAB))
def q_vocabulary(spark, sf_dir):
    """A3 + P9: all nine columns counted in one scan and one shuffle."""
    v = vocab.vocabulary(fx.impressions(spark, sf_dir), FEATURES, T)
    return v.select("col_name", "value", F.col("n").cast("bigint").alias("n"), "kept")


@register("stash_all", sq.with_impressions(sq.stash_sql(FEATURES, SENT), _VOCAB))
def q_stash_all(spark, sf_dir):
    """F1 + F2: every column stashed (strings to ``stash_<col>``, numerics to
    their typed sentinel), null always stashed."""
    imp = fx.impressions(spark, sf_dir)
    return vocab.stash_rare(imp, FEATURES, T, sentinels=SENT).select(
        "id", "y", *[c + "_t" for c in FEATURES])


@register("stash_labels", sq.with_impressions(sq.labels_sql(FEATURES, SENT), _VOCAB))
def q_stash_labels(spark, sf_dir):
    """StringIndexer order (count desc, label asc) and one-hot slots."""
    return _encoder(fx.impressions(spark, sf_dir)).labels


@register("onehot_long", sq.with_impressions(
    "SELECT s.id, l.col_name, l.slot, l.feature, CAST(1.0 AS DOUBLE) AS value FROM (" + " UNION ALL ".join(
        f"SELECT id, '{c}' AS col_name, CAST({c}_t AS VARCHAR) AS label FROM st" for c in FEATURES)
    + ") s JOIN lab l ON s.col_name = l.col_name AND s.label = l.label",
    f"{_VOCAB}, st AS ({sq.stash_sql(FEATURES, SENT)}), lab AS ({sq.labels_sql(FEATURES, SENT)})"))
def q_onehot_long(spark, sf_dir):
    """F5 + F6 long form: one row per active slot of the assembled vector."""
    imp = fx.impressions(spark, sf_dir)
    model = _encoder(imp)
    return model.long_form(model.stash(imp), "id")


@register("onehot_vector", sq.with_impressions(
    "SELECT s.id, CAST(l.slot AS INTEGER) AS slot, CAST(1.0 AS DOUBLE) AS value FROM (" + " UNION ALL ".join(
        f"SELECT id, '{c}' AS col_name, CAST({c}_t AS VARCHAR) AS label FROM st" for c in FEATURES)
    + ") s JOIN lab l ON s.col_name = l.col_name AND s.label = l.label",
    f"{_VOCAB}, st AS ({sq.stash_sql(FEATURES, SENT)}), lab AS ({sq.labels_sql(FEATURES, SENT)})"))
def q_onehot_vector(spark, sf_dir):
    """The Spark ML vector itself (StringIndexer + OneHotEncoder +
    VectorAssembler), read back as sparse entries."""
    imp = fx.impressions(spark, sf_dir)
    out = _encoder(imp).transform(imp)
    return fe.vector_entries(out, "id")


@register("feature_catalog", sq.with_impressions(
    "SELECT CAST(slot AS INTEGER) AS idx, feature AS name FROM lab",
    f"{_VOCAB}, lab AS ({sq.labels_sql(FEATURES, SENT)})"))
def q_feature_catalog(spark, sf_dir):
    """F8 + T3: vector index to feature name from the vector's metadata."""
    imp = fx.impressions(spark, sf_dir)
    return fe.feature_catalog(_encoder(imp).transform(imp))


@register("encoded_width", sq.with_impressions(
    """SELECT col_name, kept_values, stash_rows, CAST(kept_values + CASE WHEN stash_rows > 0 THEN 1 ELSE 0 END AS BIGINT) AS width
       FROM (SELECT col_name, CAST(count(*) FILTER (WHERE kept) AS BIGINT) AS kept_values,
                    CAST(coalesce(sum(n) FILTER (WHERE NOT kept), 0) AS BIGINT) AS stash_rows
             FROM vocab GROUP BY col_name) p
       UNION ALL
       SELECT '*' AS col_name, CAST(sum(kept_values) AS BIGINT), CAST(sum(stash_rows) AS BIGINT), CAST(sum(width) AS BIGINT)
       FROM (SELECT count(*) FILTER (WHERE kept) AS kept_values,
                    coalesce(sum(n) FILTER (WHERE NOT kept), 0) AS stash_rows,
                    count(*) FILTER (WHERE kept) + CASE WHEN coalesce(sum(n) FILTER (WHERE NOT kept), 0) > 0 THEN 1 ELSE 0 END AS width
             FROM vocab GROUP BY col_name) q""", _VOCAB))
def q_encoded_width(spark, sf_dir):
    """One-hot width per column and in total."""
    return vocab.encoded_width(vocab.vocabulary(fx.impressions(spark, sf_dir), FEATURES, T))


SWEEP = [10, 45, 100, 330, 420]


@register("threshold_sweep", sq.with_impressions(
    f"""SELECT CAST(t.threshold AS INTEGER) AS threshold, c.col_name,
               CAST(count(*) FILTER (WHERE c.value IS NOT NULL AND c.n > t.threshold) AS BIGINT) AS kept_values,
               CAST(coalesce(sum(c.n) FILTER (WHERE c.value IS NOT NULL AND c.n > t.threshold), 0) AS BIGINT) AS kept_rows,
               CAST(sum(c.n) AS BIGINT) AS total_rows,
               CAST(count(*) FILTER (WHERE c.value IS NOT NULL AND c.n > t.threshold)
                    + CASE WHEN coalesce(sum(c.n) FILTER (WHERE c.value IS NOT NULL AND c.n > t.threshold), 0) < sum(c.n)
                           THEN 1 ELSE 0 END AS BIGINT) AS width
        FROM counts c, (SELECT unnest([{', '.join(map(str, SWEEP))}]) AS threshold) t
        GROUP BY t.threshold, c.col_name""", _COUNTS))
def q_threshold_sweep(spark, sf_dir):
    """width and coverage at several thresholds from one count table."""
    counts = vocab.value_counts(fx.impressions(spark, sf_dir), FEATURES)
    return vocab.threshold_sweep(counts, SWEEP)


HASH_SLOTS = 256


@register("hash_collisions", sq.with_impressions(
    f"""SELECT CAST(slot AS BIGINT) AS slot, CAST(count(*) AS BIGINT) AS features, CAST(sum(n) AS BIGINT) AS rows
        FROM (SELECT ('0x' || substr(md5(col_name || '=' || value), 1, 8))::BIGINT % {HASH_SLOTS} AS slot, n
              FROM counts WHERE value IS NOT NULL) s
        GROUP BY slot HAVING count(*) > 1""", _COUNTS))
def q_hash_collisions(spark, sf_dir):
    """features sharing a hashed slot (md5 slot, m = 256)."""
    counts = vocab.value_counts(fx.impressions(spark, sf_dir), FEATURES)
    return vocab.hash_collisions(counts, HASH_SLOTS)


HOURS = [f"h{i}" for i in range(24)]


@register("dummy_matrix", sq.with_impressions(
    "SELECT id, cat3, " + ", ".join(f"CASE WHEN cat3 = '{v}' THEN 1 ELSE 0 END AS cat3_{v}" for v in HOURS[1:])
    + " FROM imp"))
def q_dummy_matrix(spark, sf_dir):
    """0/1 columns for ``cat3`` with the base level h0 dropped."""
    imp = fx.impressions(spark, sf_dir).select("id", "cat3")
    return fe.dummy_columns(imp, "cat3", HOURS, drop=["h0"])


@register("impute_sentinel", sq.with_impressions(
    "SELECT id, " + ", ".join(f"CAST(coalesce({c}, -1) AS {'BIGINT' if c in ('n5',) else 'INTEGER'}) AS {c}, "
                              f"CAST({c} IS NULL AS INTEGER) AS {c}_missing" for c in ["y"] + NUMS)
    + " FROM imp"))
def q_impute_sentinel(spark, sf_dir):
    """Numerics without nulls (sentinel -1 plus a missing flag)."""
    imp = fx.impressions(spark, sf_dir).select("id", "y", *NUMS)
    return fe.impute_numeric(imp, ["y"] + NUMS, sentinel=-1)


# ---------------------------------------------------------------- split and sampling
@register("hash_split", sq.with_impressions(
    """SELECT split, CAST(count(*) AS BIGINT) AS rows, CAST(sum(y) AS BIGINT) AS clicks
       FROM (SELECT *, CASE WHEN ('0x' || substr(md5(CAST(id AS VARCHAR)), 1, 6))::BIGINT < 13421773
                            THEN 'train' ELSE 'test' END AS split FROM imp WHERE y IS NOT NULL) s
       GROUP BY split"""))
def q_hash_split(spark, sf_dir):
    """SP2 + P7: labelled rows split 80/20 by md5 of the key."""
    imp = fx.labelled(fx.impressions(spark, sf_dir))
    return split.hash_split(imp, "id", (0.8, 0.2)).groupBy("split").agg(
        F.count(F.lit(1)).cast("bigint").alias("rows"), F.sum("y").cast("bigint").alias("clicks"))


@register("oversample", sq.with_impressions(
    """SELECT id, y, CAST(unnest(generate_series(1, CASE WHEN y = 1 THEN 3 ELSE 1 END)) AS INTEGER) AS copy
       FROM imp WHERE y IS NOT NULL"""))
def q_oversample(spark, sf_dir):
    """Clicks appear three times (minority duplicated twice)."""
    imp = fx.labelled(fx.impressions(spark, sf_dir)).select("id", "y")
    return split.oversample(imp, "y", 1, times=2, copy_col="copy").withColumn("copy", F.col("copy").cast("int"))


@register("sample_n", sq.with_impressions(
    "SELECT id, y, cat4 FROM imp ORDER BY md5(CAST(id AS VARCHAR)) LIMIT 100"))
def q_sample_n(spark, sf_dir):
    """SP3: 100 rows chosen by md5 of the key (the limit is the feature)."""
    return split.sample_n(fx.impressions(spark, sf_dir).select("id", "y", "cat4"), 100, key="id")


@register("label_binarize", sq.with_impressions(
    "SELECT CASE WHEN y > 0 THEN 1 ELSE 0 END AS labels, CAST(count(*) AS BIGINT) AS rows FROM imp GROUP BY 1"))
def q_label_binarize(spark, sf_dir):
    """P2 + P4: ``y > 0`` to 1, everything else (null too) to 0, renamed."""
    imp = fx.impressions(spark, sf_dir)
    return imp.select(scalar.binarize("y").alias("labels")).groupBy("labels").agg(
        F.count(F.lit(1)).cast("bigint").alias("rows"))


@register("row_counts", sq.with_impressions(
    """SELECT CAST(count(*) AS BIGINT) AS rows, CAST(count(y) AS BIGINT) AS labelled,
              CAST(count(*) - count(y) AS BIGINT) AS null_labels, round(avg(y), 6) AS click_rate FROM imp"""))
def q_row_counts(spark, sf_dir):
    """A1 + A4/A5: rows, labelled rows and mean label in one aggregate."""
    imp = fx.impressions(spark, sf_dir)
    return imp.agg(F.count(F.lit(1)).cast("bigint").alias("rows"),
                   F.count("y").cast("bigint").alias("labelled"),
                   (F.count(F.lit(1)) - F.count("y")).cast("bigint").alias("null_labels"),
                   F.round(F.avg("y"), 6).alias("click_rate"))


@register("preview_head", sq.with_impressions("SELECT * FROM imp ORDER BY id LIMIT 5"))
def q_preview_head(spark, sf_dir):
    """First rows in key order (explicit order, then limit)."""
    return fx.impressions(spark, sf_dir).orderBy("id").limit(5)


@register("preview_tail", sq.with_impressions("SELECT * FROM imp ORDER BY id DESC LIMIT 5"))
def q_preview_tail(spark, sf_dir):
    """Last rows in key order."""
    return fx.impressions(spark, sf_dir).orderBy(F.desc("id")).limit(5)


@register("forward_fill", sq.with_impressions(
    """SELECT id, cat1, last_value(cat1 IGNORE NULLS) OVER (ORDER BY id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
              AS cat1_ffill FROM imp"""))
def q_forward_fill(spark, sf_dir):
    """Forward fill over the whole table in key order, in key ranges."""
    imp = fx.impressions(spark, sf_dir).select("id", "cat1")
    return ordered.forward_fill(imp, "cat1", "id", out_col="cat1_ffill")


# ---------------------------------------------------------------- coefficient reports
_COEF = f"coef AS {sq.coefficients_sql(FEATURES, T, SENT, fx.NEAR_MISS_FEATURE)}"
STASH_NAMES = report.stash_feature_names(list(IMP.categorical), SENT)
_STASH_IN = ", ".join(f"'{n}'" for n in STASH_NAMES)


@register("coefficient_report", sq.with_impressions(
    """SELECT feature, round(coeff, 6) AS coeff, round(exp(coeff), 6) AS odds,
              CAST(rank() OVER (ORDER BY coeff DESC) + (count(*) OVER (PARTITION BY coeff) - 1) / 2.0 AS DOUBLE) AS rank
       FROM coef""", _COEF))
def q_coefficient_report(spark, sf_dir):
    """M9 + W1 + X5: odds and average-tie rank of each coefficient."""
    rep = report.coefficient_report(fx.coefficients(spark, sf_dir))
    return rep.select("feature", F.round("coeff", 6).alias("coeff"), F.round("odds", 6).alias("odds"),
                      F.col("rank").cast("double").alias("rank"))


@register("top_coefficients", sq.with_impressions(
    """SELECT direction, CAST(position AS INTEGER) AS position, feature, round(coeff, 6) AS coeff FROM (
         SELECT 'largest' AS direction, row_number() OVER (ORDER BY coeff DESC, feature ASC) AS position, * FROM coef
         UNION ALL
         SELECT 'smallest' AS direction, row_number() OVER (ORDER BY coeff ASC, feature ASC) AS position, * FROM coef) t
       WHERE position <= 10""", _COEF))
def q_top_coefficients(spark, sf_dir):
    """T1 + T2: ten largest and ten smallest weights."""
    tb = report.top_bottom(fx.coefficients(spark, sf_dir), 10)
    return tb.withColumn("coeff", F.round("coeff", 6))


@register("stash_report", sq.with_impressions(
    f"""SELECT feature, round(coeff, 6) AS coeff, round(exp(coeff), 6) AS odds, coeff > 1 AS large
        FROM coef WHERE feature IN ({_STASH_IN})""", _COEF))
def q_stash_report(spark, sf_dir):
    """M10 + P12 + U3: stash features by exact name (the near miss
    ``n1v_10000`` is not one)."""
    st = report.stash_report(fx.coefficients(spark, sf_dir), STASH_NAMES)
    return st.select("feature", F.round("coeff", 6).alias("coeff"), F.round("odds", 6).alias("odds"), "large")


@register("coef_share", sq.with_impressions(
    """SELECT CAST(count(*) AS BIGINT) AS features, CAST(count(*) FILTER (WHERE coeff > 1) AS BIGINT) AS large,
              round(avg(CAST(coeff > 1 AS DOUBLE)), 6) AS share FROM coef""", _COEF))
def q_coef_share(spark, sf_dir):
    """A21 + P13: share of weights above 1."""
    return report.coef_share(fx.coefficients(spark, sf_dir)).withColumn("share", F.round("share", 6))


@register("linearity_view", sq.with_impressions(
    """SELECT CAST(floor(coeff / 0.1) AS INTEGER) AS weight_bin, CAST(floor(exp(coeff) / 0.2) AS INTEGER) AS odds_bin,
              CAST(count(*) AS BIGINT) AS features
       FROM coef WHERE coeff BETWEEN -1.0 AND 1.0 AND exp(coeff) BETWEEN 0.4 AND 3.0
       GROUP BY 1, 2""", _COEF))
def q_linearity_view(spark, sf_dir):
    """Weight-against-odds grid counts inside the plotted window."""
    return report.linearity_view(fx.coefficients(spark, sf_dir))


@register("sorted_curve", sq.with_impressions(
    f"""SELECT CAST(row_number() OVER (ORDER BY coeff ASC, feature ASC) AS INTEGER) AS position, feature,
               round(coeff, 6) AS coeff, round(exp(coeff), 6) AS odds, feature IN ({_STASH_IN}) AS is_stash
        FROM coef""", _COEF))
def q_sorted_curve(spark, sf_dir):
    """Sorted weights with stash points marked."""
    sc = report.sorted_curve(fx.coefficients(spark, sf_dir), STASH_NAMES)
    return sc.select("position", "feature", F.round("coeff", 6).alias("coeff"),
                     F.round("odds", 6).alias("odds"), "is_stash")


# ---------------------------------------------------------------- sources and sinks

IMP_SCHEMA = _T.StructType([
    _T.StructField("id", _T.LongType()), _T.StructField("y", _T.IntegerType()),
    *[_T.StructField(c, _T.LongType() if c == "n5" else _T.IntegerType()) for c in NUMS],
    *[_T.StructField(c, _T.StringType()) for c in IMP.categorical]])
_LINE_SQL = "concat_ws(chr(9), " + ", ".join(
    f"coalesce(CAST({c} AS VARCHAR), '')" for c in IMP_COLS) + ")"
LINE_FRACTION = 0.1


@register("tsv_round_trip", sq.with_impressions("SELECT * FROM imp"))
def q_tsv_round_trip(spark, sf_dir):
    """S1 + S3: impressions written as headerless TSV, read back under the
    explicit schema through a part-file glob."""
    path = io.write_tsv(fx.impressions(spark, sf_dir), scratch_path(spark, "tsv"))
    return io.read_tsv(spark, f"{path}/part-*", IMP_SCHEMA)


@register("null_marker_round_trip", sq.with_impressions("SELECT * FROM imp"))
def q_null_marker_round_trip(spark, sf_dir):
    """S8 + S2: nulls exported as the text ``null`` and read back strictly."""
    path = io.write_tsv(fx.impressions(spark, sf_dir), scratch_path(spark, "nulltsv"), null_value="null")
    return io.read_tsv(spark, path, IMP_SCHEMA, strict=True, null_value="null")


@register("sample_lines", sq.with_impressions(
    f"""SELECT line AS value FROM (SELECT {_LINE_SQL} AS line FROM imp) t
        WHERE line <> '' AND ('0x' || substr(md5(line), 1, 4))::INTEGER < {int(round(LINE_FRACTION * 65536))}"""))
def q_sample_lines(spark, sf_dir):
    """Repeatable 10 % line sample of the exported log text."""
    path = io.write_tsv(fx.impressions(spark, sf_dir), scratch_path(spark, "lines"))
    return io.sample_lines(spark, path, LINE_FRACTION)


@register("parquet_round_trip", sq.with_impressions(
    _union([f"""SELECT '{c}' AS col_name, CAST(count(*) AS BIGINT) AS rows_before, CAST(count(*) AS BIGINT) AS rows_after,
                       CAST(count({c}) AS BIGINT) AS non_null_before, CAST(count({c}) AS BIGINT) AS non_null_after,
                       CAST(coalesce(sum(length(CAST({c} AS VARCHAR))), 0) AS BIGINT) AS length_before,
                       CAST(coalesce(sum(length(CAST({c} AS VARCHAR))), 0) AS BIGINT) AS length_after,
                       true AS equal FROM imp""" for c in IMP_COLS])))
def q_parquet_round_trip(spark, sf_dir):
    """S4 + S5 + S12: snappy Parquet write, pruned read, per-column checks."""
    imp = fx.impressions(spark, sf_dir)
    path = io.write_parquet(imp, scratch_path(spark, "pq"))
    back = io.read_parquet(spark, path, IMP_COLS)
    return io.round_trip_check(imp, back, IMP_COLS)


@register("file_inventory",
          "SELECT 'events.parquet' AS file_name, CAST(count(*) AS BIGINT) AS rows FROM events "
          "UNION ALL SELECT 'lineitem.parquet' AS file_name, CAST(count(*) AS BIGINT) AS rows FROM lineitem")
def q_file_inventory(spark, sf_dir):
    """Part files and their row counts from the scan's metadata column."""
    inv = io.file_inventory(spark, [f"{sf_dir}/events.parquet", f"{sf_dir}/lineitem.parquet"])
    return inv.select("file_name", "rows")


@register("csv_results_read", sq.with_impressions(
    "SELECT feature, round(coeff, 6) AS coeff FROM coef", _COEF))
def q_csv_results_read(spark, sf_dir):
    """S6 + S7 + S9: coefficient table as one headerless CSV part (size
    checked), read back under named columns."""
    path = io.write_csv_single(fx.coefficients(spark, sf_dir), scratch_path(spark, "coef"))
    back = io.read_csv(spark, path, "feature string, coeff double")
    return back.withColumn("coeff", F.round("coeff", 6))


# ---------------------------------------------------------------- models (Spark ML)


@register("lr_category_rate", sq.with_impressions(
    """SELECT cat2, CAST(count(*) AS BIGINT) AS rows, round(avg(y), 5) AS prob
       FROM imp WHERE y IS NOT NULL GROUP BY cat2"""))
def q_lr_category_rate(spark, sf_dir):
    """M1 + M3 + M4 closed form: unregularised LR on one one-hot column,
    run to convergence, predicts each category's click rate."""
    lab = fx.labelled(fx.impressions(spark, sf_dir)).select("id", "y", "cat2")
    enc = fe.StashEncoder(["cat2"], 0).fit(lab)
    x = enc.transform(lab, keep_stashed=True).withColumn("label", F.col("y"))
    model = models.train_lr(x, max_iter=200, tol=1e-10, threshold=0.5)
    scored = models.score(model, x)
    return scored.groupBy(F.col("cat2_t").alias("cat2")).agg(
        F.count(F.lit(1)).cast("bigint").alias("rows"), F.round(F.avg("prob"), 5).alias("prob"))


TRAIN_CUT = {share: int(round(share * (1 << split.HASH_BITS))) for share in (0.7, 0.8)}
_CATS = list(IMP.categorical)


def _parts_sql(body: str, extra: str = "", share: float = 0.8) -> str:
    return sq.signal_parts(TRAIN_CUT[share], jobs.SPLIT_SALT, body, extra)


# The jobs keep values above this share of the training rows, so they have the same features at every scale.
JOB_SHARE = 0.005
_JOB_ROWS = {
    "onehot_lr": sq.job_row("onehot_lr", sq.width_sql(sq.share_vocab_sql(FEATURES, JOB_SHARE, "tr"))),
    "hashed_lr": sq.job_row("hashed_lr", f"CAST({jobs.HASH_WIDTH} AS BIGINT)"),
    "random_forest": sq.job_row("random_forest", f"{2 * len(NUMS)} + {sq.width_sql(sq.vocab_sql(_CATS, T, 'tr'))}"),
}


def _checked(m: DataFrame) -> DataFrame:
    """A job's metrics as one row: counts, base rate and width as they are, and whether the model
    learned (test loss below the baseline, area under ROC above one half)."""
    def value(part: str, metric: str):
        return F.max(F.when((F.col("split") == part) & (F.col("metric") == metric), F.col("value")))

    one = m.groupBy("model").agg(
        *[value("train", c).alias(c) for c in ("rows", "base_rate", "baseline_log_loss", "width")],
        *[value("test", c).alias(f"test_{c}") for c in ("rows", "tp", "fn", "fp", "tn", "log_loss", "auroc")])
    return one.select("model", F.col("rows").cast("bigint").alias("train_rows"), "base_rate", "baseline_log_loss",
                      F.col("width").cast("bigint").alias("width"), F.col("test_rows").cast("bigint").alias("test_rows"),
                      (F.col("test_tp") + F.col("test_fn")).cast("bigint").alias("positives"),
                      (F.col("test_fp") + F.col("test_tn")).cast("bigint").alias("negatives"),
                      ((F.col("test_log_loss") < F.col("baseline_log_loss")) & (F.col("test_auroc") > 0.5)).alias("learned"))


def _onehot_fit(spark, sf_dir, cols=FEATURES, threshold=None, sentinels=SENT, **params):
    if threshold is None:
        params.setdefault("share", JOB_SHARE)
    return jobs.onehot_fit(fx.signal_impressions(spark, sf_dir), "id", "y", cols, threshold, sentinels, **params)


def _hashed_job(spark, sf_dir):
    return jobs.hashed_lr(fx.signal_impressions(spark, sf_dir), "id", "y", FEATURES, _CATS)


def _rf_job(spark, sf_dir):
    return jobs.random_forest(fx.signal_impressions(spark, sf_dir), "id", "y", NUMS, _CATS, T)


@register("lr_onehot_metrics", _parts_sql(_JOB_ROWS["onehot_lr"]))
def q_lr_onehot_metrics(spark, sf_dir):
    """One-hot LR on the signal fixture: baseline, width, test counts, and that it learned."""
    return _checked(jobs.evaluated(_onehot_fit(spark, sf_dir), "id").metrics)


@register("lr_hashed_metrics", _parts_sql(_JOB_ROWS["hashed_lr"]))
def q_lr_hashed_metrics(spark, sf_dir):
    """LR on 2^18 hashed features (FeatureHasher)."""
    return _checked(_hashed_job(spark, sf_dir).metrics)


@register("rf_metrics", _parts_sql(_JOB_ROWS["random_forest"], share=0.7))
def q_rf_metrics(spark, sf_dir):
    """Random forest end to end: imputed numerics, oversampled clicks,
    40 trees of depth 5, clipped loss of P(click)."""
    return _checked(_rf_job(spark, sf_dir).metrics)


@register("lr_training_curve", _parts_sql(
    "SELECT 'onehot_lr' AS model, round(-p * ln(p) - (1 - p) * ln(1 - p), 6) AS first_loss, true AS never_rises, true AS ends_lower "
    "FROM (SELECT avg(CAST(y AS DOUBLE)) AS p FROM tr) t"))
def q_lr_training_curve(spark, sf_dir):
    """M7: the objective of each L-BFGS iteration starts at the entropy of the base rate and never rises.
    Nothing is scored for it."""
    curve = models.training_curve(_onehot_fit(spark, sf_dir).model, spark, "onehot_lr")
    # at most one entry an iteration
    held = curve.groupBy("model").agg(F.array_sort(F.collect_list(F.struct("iteration", "loss")))["loss"].alias("loss"))
    later = F.slice("loss", 2, F.size("loss") - 1)
    rises = F.exists(F.zip_with(later, F.slice("loss", 1, F.size("loss") - 1), lambda b, a: b > a), lambda x: x)
    return held.select("model", F.round(F.col("loss")[0], 6).alias("first_loss"), (~rises).alias("never_rises"),
                       (F.element_at("loss", -1) < F.col("loss")[0]).alias("ends_lower"))


REPORT_SHARE = 0.042


def _rates_sql(kept: str) -> str:
    """Click rate of each label of cat3 in the training split."""
    return _parts_sql("SELECT feature, round(rate, 6) AS rate, true AS close, is_stash FROM "
                      "(SELECT 'cat3v_' || label AS feature, avg(CAST(y AS DOUBLE)) AS rate, label = 'stash_cat3' AS is_stash "
                      f"FROM (SELECT y, CASE WHEN cat3 IN (SELECT cat3 FROM tr GROUP BY cat3 HAVING {kept}) THEN cat3 ELSE 'stash_cat3' END AS label FROM tr) a "
                      "GROUP BY label) b")


def _against_rates(fit, coef: DataFrame) -> DataFrame:
    """Weights of one column's LR run to its end differ as the logits of its labels' click rates do."""
    st = fit.encoder.stash(fit.train).groupBy(F.concat(F.lit("cat3v_"), F.col("cat3_t")).alias("feature")).agg(
        F.avg(F.col("label").cast("double")).alias("rate"))
    both = coef.join(st, "feature").withColumn("logit", F.log(F.col("rate") / (1 - F.col("rate"))))
    first = both.agg(F.min_by("coeff", "feature").alias("c0"), F.min_by("logit", "feature").alias("l0"))
    gap = F.abs((F.col("coeff") - F.col("c0")) - (F.col("logit") - F.col("l0")))
    return both.join(F.broadcast(first)).select("feature", F.round("rate", 6).alias("rate"), (gap < 0.01).alias("close"),
                                               F.col("feature").isin(STASH_NAMES).alias("is_stash"))


@register("lr_coefficients", _rates_sql("count(*) > 0"))
def q_lr_coefficients(spark, sf_dir):
    """M8: fitted coefficients under their names; one column, no label stashed."""
    fit = _onehot_fit(spark, sf_dir, ["cat3"], 0, None, max_iter=200, tol=1e-12)
    return _against_rates(fit, models.coefficient_table(fit.model, fit.train_x))


@register("lr_coefficient_report", _rates_sql(f"count(*) > (SELECT CAST(floor(count(*) * {REPORT_SHARE}) AS BIGINT) FROM tr)"))
def q_lr_coefficient_report(spark, sf_dir):
    """M9 + M10 on a fitted model with a stash: odds turned back into weights, stash flags."""
    fit = _onehot_fit(spark, sf_dir, ["cat3"], None, None, max_iter=200, tol=1e-12, share=REPORT_SHARE)
    rep = report.coefficient_report(models.coefficient_table(fit.model, fit.train_x).select("feature", "coeff"))
    return _against_rates(fit, rep.select("feature", F.log("odds").alias("coeff")))


_STUMP_COLS = ["n2", "n3", "n4"]


def _stump(spark, sf_dir):
    """One tree of one split over three columns, all rows, all features: the exact histogram search."""
    from pyspark.ml.feature import VectorAssembler

    sig = fx.signal_impressions(spark, sf_dir)
    x = VectorAssembler(inputCols=_STUMP_COLS, outputCol="features").transform(sig).withColumn("label", F.col("y"))
    return models.train_rf(x, num_trees=1, max_depth=1, max_bins=128, bootstrap=False, feature_subset="all"), x


@register("rf_importance", _parts_sql(
    "SELECT name, CAST(CASE WHEN name = f THEN 1.0 ELSE 0.0 END AS DOUBLE) AS score FROM best, (SELECT unnest(['n2', 'n3', 'n4']) AS name) c",
    sq.best_split(_STUMP_COLS, "sig")))
def q_rf_importance(spark, sf_dir):
    """Importances of a tree with one split: all of it on the column that SQL finds too."""
    model, x = _stump(spark, sf_dir)
    return models.feature_importance(model, x).select("name", F.round("score", 6).alias("score"))


@register("rf_stump", _parts_sql(
    "SELECT name, min(v) AS low, max(v) AS high, CAST(count(*) AS BIGINT) AS rows, round(avg(CAST(y AS DOUBLE)), 6) AS prob "
    "FROM (SELECT best.f AS name, lo.v, lo.y, lo.v <= best.v AS is_left FROM lo JOIN best ON lo.f = best.f) s GROUP BY name, is_left",
    sq.best_split(_STUMP_COLS, "sig")))
def q_rf_stump(spark, sf_dir):
    """M2 exact: the split and the leaf rates of a tree with one split."""
    model, x = _stump(spark, sf_dir)
    name = models.feature_importance(model, x).first()["name"]
    value = F.col(name).cast("double")
    return models.score(model, x).groupBy(F.round("prob", 6).alias("prob")).agg(
        F.lit(name).alias("name"), F.min(value).alias("low"), F.max(value).alias("high"), F.count(F.lit(1)).cast("bigint").alias("rows"))


# strong L1 may leave no weight, and then no ranking
_IN_RANGE = "auroc BETWEEN 0.5 AND 1"


@register("lr_grid", "SELECT r AS reg_param, e AS elastic_net, true AS ok FROM (SELECT unnest([0.0::DOUBLE, 0.01::DOUBLE]) AS r) a, (SELECT unnest([0.0::DOUBLE, 1.0::DOUBLE]) AS e) b")
def q_lr_grid(spark, sf_dir):
    """L1 against L2 and two strengths, validated by AUROC."""
    train, _ = split.split_frames(fx.signal_impressions(spark, sf_dir), "id", (0.8, 0.2), jobs.SPLIT_SALT)
    enc = fe.StashEncoder(FEATURES, T, SENT).fit(train)
    _, table = models.grid_search(enc.transform(train).withColumn("label", F.col("y")))
    return table.select("reg_param", "elastic_net", F.expr(_IN_RANGE).alias("ok"))


_FORESTS = [(trees, depth, bins) for trees in (5, 20) for depth in (2, 5) for bins in (16, 32)]


@register("rf_grid", "SELECT t AS trees, d AS depth, b AS bins, true AS ok FROM (SELECT unnest([5::BIGINT, 20::BIGINT]) AS t) x, "
          "(SELECT unnest([2::BIGINT, 5::BIGINT]) AS d) y, (SELECT unnest([16::BIGINT, 32::BIGINT]) AS b) z")
def q_rf_grid(spark, sf_dir):
    """Forests of several sizes on one encoded, split table."""
    from pyspark.ml.classification import RandomForestClassifier

    train, test, _ = jobs.forest_frames(fx.signal_impressions(spark, sf_dir), "id", "y", NUMS, _CATS, T)
    forests = [({"trees": t, "depth": d, "bins": b}, RandomForestClassifier(numTrees=t, maxDepth=d, maxBins=b, seed=1)) for t, d, b in _FORESTS]
    table = models.fit_grid(train.select("features", "label"), test.select("features", "label"), forests)
    return table.select("trees", "depth", "bins", F.expr(_IN_RANGE).alias("ok"))


_WIDTHS = [1 << 6, 1 << 10, 1 << 18]


@register("hash_width_grid", "SELECT w AS width, true AS ok FROM (SELECT unnest([64::BIGINT, 1024::BIGINT, 262144::BIGINT]) AS w) x")
def q_hash_width_grid(spark, sf_dir):
    """LR over several hash widths, all hashed from one split table."""
    from pyspark.ml.classification import LogisticRegression

    frame = fx.signal_impressions(spark, sf_dir)
    for w in _WIDTHS:
        frame = fe.hash_features(frame, FEATURES, w, categorical_cols=_CATS, output_col=f"x{w}")
    frame = frame.withColumn("label", F.col("y"))
    train, test = split.split_frames(frame.select("id", "label", *[f"x{w}" for w in _WIDTHS]), "id", (0.8, 0.2), jobs.SPLIT_SALT)
    table = models.fit_grid(train, test, [({"width": w}, LogisticRegression(featuresCol=f"x{w}", maxIter=models.LR_MAX_ITER, standardization=False)) for w in _WIDTHS])
    return table.select("width", F.expr(_IN_RANGE).alias("ok"))


_COMPARED = "SELECT model, width, baseline_log_loss, true AS lower_loss, true AS ranks FROM ({}) {}"


@register("model_comparison", " UNION ALL ".join(
    "SELECT * FROM (" + _parts_sql(_COMPARED.format(_JOB_ROWS[m], "j"), share=0.7 if m == "random_forest" else 0.8) + f") {m}_row" for m in _JOB_ROWS))
def q_model_comparison(spark, sf_dir):
    """One row per model: width, baseline, and whether the test loss and the ranking beat it."""
    results = [jobs.evaluated(_onehot_fit(spark, sf_dir), "id"), _hashed_job(spark, sf_dir), _rf_job(spark, sf_dir)]
    rows = report.model_comparison(split.union_all(*[r.metrics for r in results]))
    return rows.select("model", "width", "baseline_log_loss", (F.col("lift") > 0).alias("lower_loss"), (F.col("auroc") > 0.5).alias("ranks"))


# ---------------------------------------------------------------- names of hashed slots
_CAT_TEXT = [f"SELECT '{c}' AS c, {c} AS v FROM tr WHERE {c} IS NOT NULL" for c in _CATS]


@register("hash_slots_named", sq.with_impressions(
    "SELECT id, CAST(" + " + ".join([f"CAST(coalesce({c}, 0) <> 0 AS INTEGER)" for c in NUMS] + [f"CAST({c} IS NOT NULL AS INTEGER)" for c in _CATS])
    + " AS BIGINT) AS features, true AS same FROM imp"))
def q_hash_slots_named(spark, sf_dir):
    """the slots that the dictionary gives a row's features are the slots of its hashed vector."""
    imp = fx.impressions(spark, sf_dir)
    names = fe.slot_dictionary(imp, FEATURES, jobs.HASH_WIDTH, _CATS)
    value = [F.when(F.col(c) != 0, F.lit("")) for c in NUMS] + [F.col(c) for c in _CATS]
    long = imp.select("id", *[v.alias(c) for v, c in zip(value, FEATURES, strict=True)]).unpivot(["id"], FEATURES, "col_name", "value").where("value is not null")
    by_name = long.join(names.select("col_name", F.coalesce("value", F.lit("")).alias("value"), "slot"), ["col_name", "value"]).groupBy("id").agg(
        F.count(F.lit(1)).alias("features"), F.array_sort(F.collect_set("slot")).alias("named"))
    x = fe.vector_entries(fe.hash_features(imp, FEATURES, jobs.HASH_WIDTH, _CATS), "id").groupBy("id").agg(F.array_sort(F.collect_set("slot")).alias("used"))
    return imp.select("id").join(by_name, "id", "left").join(x, "id", "left").select(
        "id", F.coalesce("features", F.lit(0).cast("bigint")).alias("features"), F.col("named").eqNullSafe(F.col("used")).alias("same"))


@register("hashed_weight_names", _parts_sql(
    f"SELECT CAST((SELECT count(*) FROM (SELECT DISTINCT c, v FROM ({' UNION ALL '.join(_CAT_TEXT)}) a) b) + {len(NUMS)} AS BIGINT) AS features, true AS all_named, true AS own_slots"))
def q_hashed_weight_names(spark, sf_dir):
    """every weight of the hashed LR has the names of the features behind it; shared slots are the collisions."""
    fit = jobs.hashed_fit(fx.signal_impressions(spark, sf_dir), "id", "y", FEATURES, _CATS)
    names = fe.slot_dictionary(fit.train, FEATURES, jobs.HASH_WIDTH, _CATS)
    weights = [(i, float(c)) for i, c in enumerate(fit.model.coefficients.toArray()) if c]
    rows = fe.hashed_weights(weights, names)
    shared = fe.slot_collisions(names).agg(F.coalesce(F.sum("features"), F.lit(0)).alias("in_shared"))
    total = names.agg(F.count(F.lit(1)).cast("bigint").alias("features"))
    seen = rows.agg(F.coalesce(F.bool_and(F.col("feature").isNotNull()), F.lit(True)).alias("all_named"),
                    F.count_if(F.col("features") > 1).alias("named_in_shared"))
    return total.join(F.broadcast(shared)).join(F.broadcast(seen)).select("features", "all_named", (F.col("named_in_shared") <= F.col("in_shared")).alias("own_slots"))


@register("model_save_load", sq.with_impressions(
    """SELECT CAST(count(*) AS BIGINT) AS rows, CAST(0.0 AS DOUBLE) AS max_abs_diff
       FROM imp WHERE y IS NOT NULL"""))
def q_model_save_load(spark, sf_dir):
    """Encoder + LR saved as one pipeline, loaded, rescored; the
    largest probability difference must be 0."""
    from pyspark.ml import PipelineModel

    fit = _onehot_fit(spark, sf_dir)
    lab = fx.signal_impressions(spark, sf_dir)
    stashed = fit.encoder.stash(lab)
    pipe = PipelineModel(stages=fit.encoder.ml_pipeline(stashed).stages + [fit.model])
    path = io.save_model(pipe, scratch_path(spark, "model"))
    again = io.load_model(path)
    a = models.score(pipe, stashed).select("id", F.col("prob").alias("p1"))
    b = models.score(again, stashed).select("id", F.col("prob").alias("p2"))
    return a.join(b, "id").agg(F.count(F.lit(1)).cast("bigint").alias("rows"),
                               F.max(F.abs(F.col("p1") - F.col("p2"))).alias("max_abs_diff"))


# ---------------------------------------------------------------- vectors, hashing, random split
@register("vector_element", sq.with_impressions(
    "SELECT st.id, CASE WHEN CAST(st.n1_t AS VARCHAR) = (SELECT label FROM lab WHERE slot = 0) "
    "THEN CAST(1.0 AS DOUBLE) ELSE CAST(0.0 AS DOUBLE) END AS slot0 FROM st",
    f"{_VOCAB}, st AS ({sq.stash_sql(FEATURES, SENT)}), lab AS ({sq.labels_sql(FEATURES, SENT)})"))
def q_vector_element(spark, sf_dir):
    """One element of the assembled ML vector per row (slot 0)."""
    imp = fx.impressions(spark, sf_dir)
    out = _encoder(imp).transform(imp)
    return out.select("id", scalar.vector_element("features", 0).alias("slot0"))


@register("hash_feature_stats", sq.with_impressions(
    "SELECT id, round(CAST(" + " + ".join([f"coalesce({c}, 0)" for c in NUMS] + [f"CAST({c} IS NOT NULL AS INTEGER)" for c in IMP.categorical])
    + " AS DOUBLE), 6) AS value_sum, true AS within FROM imp"))
def q_hash_feature_stats(spark, sf_dir):
    """FeatureHasher vectors (2^18 slots): the values keep their sum, in at most one slot a feature."""
    imp = fx.impressions(spark, sf_dir)
    hashed = fe.hash_features(imp, FEATURES, 1 << 18, categorical_cols=list(IMP.categorical))
    per = fe.vector_entries(hashed, "id").groupBy("id").agg(F.count(F.lit(1)).alias("slots"), F.sum("value").alias("s"))
    return imp.select("id").join(per, "id", "left").select("id", F.round(F.coalesce("s", F.lit(0.0)), 6).alias("value_sum"),
                                                           (F.coalesce("slots", F.lit(0)) <= len(FEATURES)).alias("within"))


@register("random_split_counts", sq.with_impressions(
    "SELECT CAST(count(*) AS BIGINT) AS rows, CAST(sum(y) AS BIGINT) AS clicks, true AS near FROM imp WHERE y IS NOT NULL"))
def q_random_split_counts(spark, sf_dir):
    """SP1: Spark's seeded 70/30 ``randomSplit``: which row goes where depends on partitioning, the totals don't."""
    parts = split.random_split(fx.labelled(fx.impressions(spark, sf_dir)), [0.7, 0.3], seed=0)
    both = split.union_all(*[p.select(F.lit(i).alias("part"), "y") for i, p in enumerate(parts)])
    return both.agg(F.count(F.lit(1)).cast("bigint").alias("rows"), F.sum("y").cast("bigint").alias("clicks"),
                    (F.abs(F.count_if(F.col("part") == 0) / F.count(F.lit(1)) - 0.7) < 0.1).alias("near"))


# ---------------------------------------------------------------- wide fixture (lineitem)
WIDE_CATS = ["partkey", "suppkey", "linestatus"]
WT = fx.WIDE_THRESHOLDS


def _with_wide(body, extra=""):
    extra = (",\n" + extra) if extra else ""
    return f"WITH w AS ({fx.WIDE_SQL}){extra}\n{body}"


@register("wide_vocabulary", _with_wide(
    "SELECT col_name, value, CAST(n AS BIGINT) AS n, kept FROM vocab",
    f"vocab AS ({sq.vocab_sql(WIDE_CATS, WT, 'w')})"))
def q_wide_vocabulary(spark, sf_dir):
    """A3 on the lineitem fixture (6x the events rows, high-cardinality partkey)."""
    v = vocab.vocabulary(fx.wide_impressions(spark, sf_dir), WIDE_CATS, WT)
    return v.select("col_name", "value", F.col("n").cast("bigint").alias("n"), "kept")


@register("wide_stash_rate", _with_wide(
    """SELECT CASE WHEN k.value IS NOT NULL THEN w.suppkey ELSE 'stash_suppkey' END AS suppkey_t,
              CAST(count(*) AS BIGINT) AS rows, CAST(sum(y) AS BIGINT) AS returns, round(avg(y), 6) AS rate
       FROM w LEFT JOIN (SELECT value FROM vocab WHERE kept AND col_name = 'suppkey') k ON w.suppkey = k.value
       GROUP BY 1""",
    f"vocab AS ({sq.vocab_sql(['suppkey'], WT, 'w')})"))
def q_wide_stash_rate(spark, sf_dir):
    """F1 on the lineitem fixture: return rate per stashed supplier."""
    st = vocab.stash_rare(fx.wide_impressions(spark, sf_dir), ["suppkey"], WT)
    return st.groupBy("suppkey_t").agg(F.count(F.lit(1)).cast("bigint").alias("rows"),
                                       F.sum("y").cast("bigint").alias("returns"),
                                       F.round(F.avg("y"), 6).alias("rate"))


_WIDE_NUMS = {"q": 6, "price": 2, "discount": 6, "tax": 6, "line": 6}


@register("wide_mean_by_label", _with_wide(_union([
    f"SELECT y AS label, '{c}' AS col_name, round(avg({c}), {d}) AS mean FROM w GROUP BY y"
    for c, d in _WIDE_NUMS.items()])))
def q_wide_mean_by_label(spark, sf_dir):
    """A10 on the lineitem fixture (price means to cents)."""
    m = profile.mean_by_label(fx.wide_impressions(spark, sf_dir), "y", list(_WIDE_NUMS), digits=None)
    rounded = F.when(F.col("col_name") == "price", F.round("mean", 2)).otherwise(F.round("mean", 6))
    return m.select("label", "col_name", rounded.alias("mean"))


@register("wide_cardinality", _with_wide(
    """SELECT col_name, CAST(count(*) FILTER (WHERE value IS NOT NULL) AS BIGINT) AS distinct_values,
              round(CAST(count(*) FILTER (WHERE value IS NOT NULL) AS DOUBLE) * 100.0 / sum(n), 6) AS distinct_pct
       FROM counts GROUP BY col_name""",
    f"counts AS ({sq.counts_sql(WIDE_CATS, 'w')})"))
def q_wide_cardinality(spark, sf_dir):
    """A14 on the lineitem fixture."""
    return profile.cardinality_profile(fx.wide_impressions(spark, sf_dir), WIDE_CATS)


@register("oversample_class_counts", sq.with_impressions(
    """SELECT stage, label, CAST(rows AS BIGINT) AS rows FROM (
         SELECT 'original' AS stage, y AS label, count(*) AS rows FROM imp WHERE y IS NOT NULL GROUP BY y
         UNION ALL
         SELECT 'oversampled' AS stage, y AS label, count(*) * CASE WHEN y = 1 THEN 3 ELSE 1 END AS rows
         FROM imp WHERE y IS NOT NULL GROUP BY y) t"""))
def q_oversample_class_counts(spark, sf_dir):
    """P8 + U2 + A6: rows per class before and after the minority is copied
    twice (class filters are equality tests on the label)."""
    lab = fx.labelled(fx.impressions(spark, sf_dir)).select("y")
    over = split.oversample(lab, "y", 1, times=2)

    def per_class(df, stage):
        # one aggregate per stage; each class is an equality test on the label
        one = df.agg(*[F.count_if(F.col("y") == F.lit(v)).cast("bigint").alias(str(v)) for v in (0, 1)])
        return one.unpivot([], ["0", "1"], "label", "rows").select(
            F.lit(stage).alias("stage"), F.col("label").cast("int").alias("label"), "rows")

    return split.union_all(per_class(lab, "original"), per_class(over, "oversampled"))
