"""Further queries with an exact SQL twin: odd values, joined forms, null keys,
text files and the exact parts of the model jobs."""

from __future__ import annotations

from pyspark.sql import functions as F

from clicklens import fixtures as fx
from clicklens.operators import features as fe
from clicklens.operators import metrics, ordered, split, vocab
from clicklens.plans import jobs
from clicklens.plans import sqltext as sq
from clicklens.plans.catalog import FEATURES, IMP, T, register
from clicklens.session import scratch_path
from clicklens.sources import io

# Ways to apply a keep list: a set in the plan, a broadcast join, a shuffle join.
FORMS = {"set": {}, "broadcast": {"inset_cap": 0}, "shuffle": {"inset_cap": 0, "broadcast_cap": 0}}
ODD_THRESHOLD, PART_THRESHOLD = 100, 2


def _forms(df, col, threshold):
    v, sizes = vocab.fit_vocabulary(df, [col], threshold, with_sizes=True)
    return split.union_all(*[
        vocab.apply_stash(df, v, [col], {col: f"stash_{col}"}, sizes=sizes, **caps)
        .groupBy(F.lit(form).alias("form"), f"{col}_t").agg(F.count(F.lit(1)).cast("bigint").alias("rows"))
        for form, caps in FORMS.items()])


_ODD = ("CASE l_linenumber WHEN 1 THEN 'it''s' WHEN 2 THEN '${spark.master}' WHEN 3 THEN 'a$b''\"' WHEN 4 THEN 'x' || chr(92) || 'y' "
        "WHEN 5 THEN NULL WHEN 6 THEN ' ' ELSE CAST(l_orderkey AS VARCHAR) END")
_FORMS_SQL = """SELECT form, v_t, CAST(count(*) AS BIGINT) AS rows FROM (
  SELECT f.form, CASE WHEN k.v IS NOT NULL THEN d.v ELSE 'stash_v' END AS v_t
  FROM d LEFT JOIN (SELECT v FROM d GROUP BY v HAVING count(*) > {t}) k ON d.v = k.v
  CROSS JOIN (SELECT unnest(['set', 'broadcast', 'shuffle']) AS form) f) u GROUP BY form, v_t"""


@register("stash_odd_values", f"WITH d AS (SELECT {_ODD} AS v FROM lineitem) " + _FORMS_SQL.format(t=ODD_THRESHOLD))
def q_stash_odd_values(spark, sf_dir):
    """quotes, ``${...}``, backslashes, blanks and nulls, in all forms."""
    n = F.col("l_linenumber")
    odd = (F.when(n == 1, "it's").when(n == 2, "${spark.master}").when(n == 3, "a$b'\"").when(n == 4, "x\\y")
           .when(n == 5, F.lit(None)).when(n == 6, " ").otherwise(F.col("l_orderkey").cast("string")))
    return _forms(spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(odd.alias("v")), "v", ODD_THRESHOLD)


SHARE = 0.01


@register("stash_share_ctr", sq.with_impressions(
    f"""SELECT CASE WHEN k.v IS NOT NULL THEN imp.cat4 ELSE 'stash_cat4' END AS cat4_t, CAST(count(*) AS BIGINT) AS n_rows,
               CAST(sum(y) AS BIGINT) AS clicks, round(avg(y), 6) AS ctr
        FROM imp LEFT JOIN (SELECT cat4 AS v FROM imp GROUP BY cat4
                            HAVING count(*) > (SELECT CAST(floor(count(*) * {SHARE}) AS BIGINT) FROM imp)) k ON imp.cat4 = k.v
        WHERE imp.y IS NOT NULL GROUP BY 1"""))
def q_stash_share_ctr(spark, sf_dir):
    """F1 with a threshold of 1 % of the rows, then the click rate of each value: kept and stashed values at every scale."""
    imp = fx.impressions(spark, sf_dir)
    st = vocab.stash_rare(imp, ["cat4"], vocab.share_threshold(imp, SHARE))
    return fx.labelled(st).groupBy("cat4_t").agg(
        F.count(F.lit(1)).cast("bigint").alias("n_rows"), F.sum("y").cast("bigint").alias("clicks"), F.round(F.avg("y"), 6).alias("ctr"))


@register("stash_long_lists", "WITH d AS (SELECT CAST(l_partkey AS VARCHAR) AS v FROM lineitem) " + _FORMS_SQL.format(t=PART_THRESHOLD))
def q_stash_long_lists(spark, sf_dir):
    """a keep list of thousands of values through a set, a broadcast and a shuffle join."""
    rows = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(F.col("l_partkey").cast("string").alias("v"))
    return _forms(rows, "v", PART_THRESHOLD)


@register("forward_fill_by_key", sq.with_impressions(
    """SELECT id, cat1, n1, last_value(n1 IGNORE NULLS) OVER (PARTITION BY cat1 ORDER BY id
              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS filled FROM imp"""))
def q_forward_fill_by_key(spark, sf_dir):
    """W2 within keys; most rows share the null key."""
    imp = fx.impressions(spark, sf_dir).select("id", "cat1", "n1")
    return ordered.forward_fill(imp, "n1", "id", out_col="filled", partition_cols=["cat1"])


@register("durbin_watson_null_order", sq.with_scored(
    """SELECT CAST(count(*) AS BIGINT) AS rows, round(sum(d2) / sum(e * e), 6) AS dw
       FROM (SELECT e, (e - lag(e) OVER (ORDER BY k NULLS FIRST)) * (e - lag(e) OVER (ORDER BY k NULLS FIRST)) AS d2
             FROM (SELECT CASE WHEN id = 7 THEN NULL ELSE id END AS k, CAST(label AS DOUBLE) - prob AS e FROM sc) a) b"""))
def q_durbin_watson_null_order(spark, sf_dir):
    """The row without an order key comes first."""
    rows = fx.scored(spark, sf_dir).withColumn("k", F.when(F.col("id") != 7, F.col("id")))
    return metrics.durbin_watson(rows, "k", "label", "prob")


@register("tsv_text_round_trip",
          "SELECT doc_id, md5(text) AS digest, length(text) AS chars FROM documents UNION ALL "
          "SELECT -1 - doc_id, md5(CASE doc_id % 4 WHEN 0 THEN '' WHEN 1 THEN chr(92) || 'N' || chr(10) || '\"' WHEN 2 THEN NULL ELSE chr(9) || chr(92) || chr(92) || 'n ' END), "
          "length(CASE doc_id % 4 WHEN 0 THEN '' WHEN 1 THEN chr(92) || 'N' || chr(10) || '\"' WHEN 2 THEN NULL ELSE chr(9) || chr(92) || chr(92) || 'n ' END) FROM documents")
def q_tsv_text_round_trip(spark, sf_dir):
    """S1 + S8: whole texts, line ends, tabs, quotes, empty texts and nulls through escaped TSV."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    kind = F.col("doc_id") % 4
    odd = F.when(kind == 0, "").when(kind == 1, '\\N\n"').when(kind == 3, "\t\\\\n ")
    every = docs.union(docs.select(-1 - F.col("doc_id"), odd))
    path = io.write_tsv(every, scratch_path(spark, "texts"), escaped=True)
    back = io.read_tsv(spark, path, every.schema, strict=True, escaped=True)
    return back.select("doc_id", F.md5("text").alias("digest"), F.length("text").cast("bigint").alias("chars"))


@register("random_split_rows", sq.with_impressions(
    """SELECT CAST(count(*) AS BIGINT) AS rows, CAST(count(*) AS BIGINT) AS ids, true AS near FROM imp WHERE y IS NOT NULL"""))
def q_random_split_rows(spark, sf_dir):
    """SP1: the parts of a random split hold each row once, and about 70 % of them are in the first."""
    a, b = split.random_split(fx.labelled(fx.impressions(spark, sf_dir)).select("id"), [0.7, 0.3], seed=0)
    both = a.withColumn("first", F.lit(1)).unionByName(b.withColumn("first", F.lit(0)))
    return both.agg(F.count(F.lit(1)).cast("bigint").alias("rows"), F.countDistinct("id").cast("bigint").alias("ids"),
                    (F.abs(F.avg("first") - 0.7) < 0.1).alias("near"))


@register("hash_value_sum", sq.with_impressions(
    "SELECT id, round(CAST(" + " + ".join([f"coalesce({c}, 0)" for c in IMP.numeric] + [f"(CASE WHEN {c} IS NULL THEN 0 ELSE 1 END)" for c in IMP.categorical])
    + " AS DOUBLE), 6) AS value_sum FROM imp"))
def q_hash_value_sum(spark, sf_dir):
    """in 64 slots collisions add, so each row's values keep their sum."""
    hashed = fe.hash_features(fx.impressions(spark, sf_dir), FEATURES, 64, categorical_cols=list(IMP.categorical))
    sums = fe.vector_entries(hashed, "id").groupBy("id").agg(F.sum("value").alias("s"))
    ids = fx.impressions(spark, sf_dir).select("id")
    return ids.join(sums, "id", "left").select("id", F.round(F.coalesce("s", F.lit(0.0)), 6).alias("value_sum"))


_CUT = int(round(0.8 * (1 << split.HASH_BITS)))


@register("lr_label_rule", sq.with_impressions(
    f"""SELECT part AS split, CAST(count(*) AS BIGINT) AS rows, CAST(sum(CASE WHEN lab > 0 THEN 1 ELSE 0 END) AS BIGINT) AS positives
        FROM (SELECT lab, CASE WHEN ('0x' || substr(md5('{jobs.SPLIT_SALT}' || CAST(id AS VARCHAR)), 1, 6))::INTEGER < {_CUT} THEN 'train' ELSE 'test' END AS part
              FROM (SELECT id, CASE WHEN id % 5 = 0 THEN 2 ELSE y END AS lab FROM imp) a WHERE lab IS NOT NULL) b GROUP BY part"""))
def q_lr_label_rule(spark, sf_dir):
    """M1: labels 0, 1, 2 and null; training and test count the same labels as positive."""
    df = fx.impressions(spark, sf_dir).withColumn("lab", F.when(F.col("id") % 5 == 0, 2).otherwise(F.col("y")))
    res = jobs.onehot_lr(df, "id", "lab", ["cat2"], T, max_iter=3)
    parts = {"train": res.encoded_train.select("label"), "test": res.scored.select("label")}
    return split.union_all(*[p.agg(F.lit(name).alias("split"), F.count(F.lit(1)).cast("bigint").alias("rows"),
                                   F.sum("label").cast("bigint").alias("positives")) for name, p in parts.items()])
