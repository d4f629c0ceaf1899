"""Queries over wide columns (bounded vocabularies, one-shuffle stash, wide vectors), the label
mapping, order keys of any type, and bad lines."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from clicklens import fixtures as fx
from clicklens.operators import features as fe
from clicklens.operators import metrics, ordered, split, vocab
from clicklens.plans import sqltext as sq
from clicklens.plans.catalog import register
from clicklens.plans.checks import SHARE
from clicklens.session import scratch_path
from clicklens.sources import io

LINE_KEYS = ["l_orderkey", "l_linenumber"]
WIDE_COLS = ["l_partkey", "l_suppkey", "ordkey"]
WIDE_LIMITS = {"l_partkey": 28, "l_suppkey": 590, "ordkey": 4}
_LINES = ("li AS (SELECT l_orderkey, l_linenumber, CAST(l_partkey AS VARCHAR) AS l_partkey, CAST(l_suppkey AS VARCHAR) AS l_suppkey, 'o' || CAST(l_orderkey AS VARCHAR) AS ordkey FROM lineitem),\n"
          f"vocab AS ({sq.vocab_sql(WIDE_COLS, WIDE_LIMITS, 'li')})")


def _lines(spark, sf_dir):
    li = fx.table(spark, sf_dir, "lineitem")
    return li.select(*LINE_KEYS, F.col("l_partkey").cast("string").alias("l_partkey"),
                     F.col("l_suppkey").cast("string").alias("l_suppkey"),
                     F.concat(F.lit("o"), F.col("l_orderkey").cast("string")).alias("ordkey"))


@register("stash_wide_columns", f"WITH {_LINES},\nst AS ({sq.stash_sql(WIDE_COLS, {}, 'li', keep_cols=LINE_KEYS)})\n" + " UNION ALL ".join(
    f"SELECT '{c}' AS col_name, {c}_t AS label, CAST(count(*) AS BIGINT) AS rows, CAST(sum(l_orderkey * 7 + l_linenumber) AS BIGINT) AS key_sum "
    f"FROM st GROUP BY {c}_t" for c in WIDE_COLS))
def q_stash_wide_columns(spark, sf_dir):
    """F1 for three columns beyond the broadcast caps: one exchange of the table for all of them."""
    lines = _lines(spark, sf_dir)
    v, sizes = vocab.fit_vocabulary(lines, WIDE_COLS, WIDE_LIMITS, with_sizes=True)
    st = vocab.apply_stash(lines, v, WIDE_COLS, {c: f"stash_{c}" for c in WIDE_COLS}, sizes=sizes, broadcast_cap=0, inset_cap=0)
    long = st.select(*LINE_KEYS, *[F.col(c + "_t").alias(c) for c in WIDE_COLS]).unpivot(LINE_KEYS, WIDE_COLS, "col_name", "label")
    return long.groupBy("col_name", "label").agg(F.count(F.lit(1)).cast("bigint").alias("rows"),
                                                 F.sum(F.col("l_orderkey") * 7 + F.col("l_linenumber")).cast("bigint").alias("key_sum"))


@register("stash_heavy_ctr", sq.with_impressions(
    f"""SELECT CASE WHEN k.v IS NOT NULL THEN imp.cat4 ELSE 'stash_cat4' END AS cat4_t, CAST(count(*) AS BIGINT) AS n_rows,
               CAST(sum(y) AS BIGINT) AS clicks, round(avg(y), 6) AS ctr
        FROM imp LEFT JOIN (SELECT cat4 AS v FROM imp GROUP BY cat4
                            HAVING count(*) > (SELECT CAST(floor(count(*) * {SHARE}) AS BIGINT) FROM imp)) k ON imp.cat4 = k.v
        WHERE imp.y IS NOT NULL GROUP BY 1"""))
def q_stash_heavy_ctr(spark, sf_dir):
    """A3 + F1 by heavy hitters: as stash_share_ctr, but rare values are neither shuffled by value nor written."""
    st = vocab.stash_rare(fx.impressions(spark, sf_dir), ["cat4"], None, share=SHARE)
    return fx.labelled(st).groupBy("cat4_t").agg(
        F.count(F.lit(1)).cast("bigint").alias("n_rows"), F.sum("y").cast("bigint").alias("clicks"), F.round(F.avg("y"), 6).alias("ctr"))


WORD_SHARE = 0.002
_WORDS = "wd AS (SELECT unnest(string_split(text, ' ')) AS word FROM documents WHERE text IS NOT NULL)"


@register("heavy_vocabulary", f"WITH {_WORDS}, n AS (SELECT word AS v, count(*) AS n FROM wd GROUP BY word), t AS (SELECT CAST(floor(sum(n) * {WORD_SHARE}) AS BIGINT) AS t FROM n) "
          "SELECT v AS value, CAST(n AS BIGINT) AS n, true AS kept FROM n, t WHERE n > t UNION ALL "
          "SELECT '(rare)' AS value, CAST(sum(n) AS BIGINT) AS n, false AS kept FROM n, t WHERE n <= t HAVING count(*) > 0")
def q_heavy_vocabulary(spark, sf_dir):
    """A3 bounded: words of all documents above 0.2 % of the words, exact counts, and the total of the rest."""
    words = fx.table(spark, sf_dir, "documents").select(F.explode(F.split("text", " ")).alias("word"))
    v = vocab.fit_vocabulary(words, ["word"], None, share=WORD_SHARE)
    return v.select(F.when(F.col("kept"), F.col("value")).otherwise("(rare)").alias("value"), F.col("n").cast("bigint").alias("n"), "kept")


_WIDE_ENC = ["l_partkey", "ordkey"]
_ENC_SQL = (f"WITH {_LINES.replace(sq.vocab_sql(WIDE_COLS, WIDE_LIMITS, 'li'), sq.vocab_sql(_WIDE_ENC, WIDE_LIMITS, 'li'))},\n"
            f"st AS ({sq.stash_sql(_WIDE_ENC, {}, 'li', keep_cols=LINE_KEYS)}),\nlab AS ({sq.labels_sql(_WIDE_ENC, {})})\n")


@register("onehot_wide_vector", _ENC_SQL + " UNION ALL ".join(
    f"SELECT l_orderkey, l_linenumber, lab.slot AS slot, CAST(1.0 AS DOUBLE) AS value, (SELECT CAST(count(*) AS INTEGER) FROM lab) AS width "
    f"FROM st JOIN lab ON lab.col_name = '{c}' AND lab.label = st.{c}_t" for c in _WIDE_ENC))
def q_onehot_wide_vector(spark, sf_dir):
    """vectors over the labels of two wide columns, by a label join; no label reaches the driver."""
    lines = _lines(spark, sf_dir).drop("l_suppkey")
    enc = fe.StashEncoder(_WIDE_ENC, WIDE_LIMITS).fit(lines)
    key = F.struct(*LINE_KEYS, F.unwrap_udt("features")["size"].alias("width")).alias("key")
    return fe.vector_entries(enc.wide_vectors(lines).select(key, "features"), "key").select("key.*", "slot", "value")


@register("label_index", sq.with_impressions(
    "SELECT part, label, CAST(count(*) AS BIGINT) AS rows FROM (SELECT 'both' AS part, CAST(y AS DOUBLE) AS label FROM imp WHERE y IS NOT NULL "
    "UNION ALL SELECT 'clicked' AS part, CAST(y AS DOUBLE) AS label FROM imp WHERE y = 1) u GROUP BY part, label"))
def q_label_index(spark, sf_dir):
    """labels of both classes, and of the clicked class alone, get the same numbers."""
    lab = fx.labelled(fx.impressions(spark, sf_dir)).select(F.col("y").cast("string").alias("text"))
    parts = {"both": lab, "clicked": lab.where(F.col("text") == "1")}
    return split.union_all(*[fe.label_index(p, "text").groupBy(F.lit(name).alias("part"), "label").agg(F.count(F.lit(1)).cast("bigint").alias("rows"))
                             for name, p in parts.items()])


RANGES = (1, 4, 64)
_RANGES_SQL = f"(SELECT unnest({list(RANGES)}) AS ranges) r"


def _dated(spark, sf_dir):
    ev = fx.table(spark, sf_dir, "events")
    return ev.select("event_id", F.to_date("ts").alias("day"), F.when(F.col("event_id") % 3 == 0, F.col("user_id")).alias("seen"))


@register("forward_fill_by_date", f"""SELECT ranges, event_id, last_value(seen IGNORE NULLS) OVER (PARTITION BY ranges ORDER BY day, event_id
         ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS filled
  FROM (SELECT event_id, CAST(ts AS DATE) AS day, CASE WHEN event_id % 3 = 0 THEN user_id END AS seen FROM events) e, {_RANGES_SQL}""")
def q_forward_fill_by_date(spark, sf_dir):
    """W2 by a date with a tie-break, cut into 1, 4 and 64 ranges."""
    rows = _dated(spark, sf_dir)
    return split.union_all(*[ordered.forward_fill(rows, "seen", ["day", "event_id"], out_col="filled", n_buckets=n)
                             .select(F.lit(n).alias("ranges"), "event_id", "filled") for n in RANGES])


@register("durbin_watson_text_order", sq.with_scored(
    f"""SELECT ranges, CAST(count(*) AS BIGINT) AS rows, round(sum(d2) / sum(e * e), 6) AS dw
        FROM (SELECT ranges, e, (e - lag(e) OVER w) * (e - lag(e) OVER w) AS d2
              FROM (SELECT CASE WHEN id % 11 = 0 THEN NULL ELSE 'k' || CAST(id % 7 AS VARCHAR) END AS k, id, CAST(label AS DOUBLE) - prob AS e FROM sc) a, {_RANGES_SQL}
              WINDOW w AS (PARTITION BY ranges ORDER BY k NULLS FIRST, id)) b GROUP BY ranges"""))
def q_durbin_watson_text_order(spark, sf_dir):
    """A20 + W3 by a text (null for some rows) and an id, cut into 1, 4 and 64 ranges."""
    rows = fx.scored(spark, sf_dir).withColumn("k", F.when(F.col("id") % 11 != 0, F.concat(F.lit("k"), (F.col("id") % 7).cast("string"))))
    return split.union_all(*[metrics.durbin_watson(rows, ["k", "id"], n_buckets=n).select(F.lit(n).alias("ranges"), "rows", "dw") for n in RANGES])


# Every ninth event is written as a line that doesn't fit (event_id, user_id, event_type).
_LINE = ("CASE event_id % 9 WHEN 0 THEN CAST(event_id AS VARCHAR) || chr(9) || 'x' || CAST(user_id AS VARCHAR) || chr(9) || event_type "
         "WHEN 1 THEN CAST(event_id AS VARCHAR) || chr(9) || CAST(user_id AS VARCHAR) "
         "WHEN 2 THEN CAST(event_id AS VARCHAR) || chr(9) || CAST(user_id AS VARCHAR) || chr(9) || event_type || chr(9) || 'more' "
         "ELSE CAST(event_id AS VARCHAR) || chr(9) || CAST(user_id AS VARCHAR) || chr(9) || event_type END")


@register("tsv_bad_lines", f"SELECT CASE WHEN event_id % 9 < 3 THEN 'bad' ELSE 'good' END AS part, {_LINE} AS line FROM events")
def q_tsv_bad_lines(spark, sf_dir):
    """Lines of a text table that don't fit the schema are kept apart, as they were; no line is lost."""
    lines = fx.table(spark, sf_dir, "events").select(F.expr(_LINE.replace("VARCHAR", "STRING")).alias("value"))
    path = scratch_path(spark, "lines")
    lines.write.text(path)
    good, bad = io.read_tsv_quarantined(spark, path, T.StructType.fromDDL("event_id bigint, user_id bigint, event_type string"))
    return (good.select(F.lit("good").alias("part"), F.concat_ws("\t", *[F.col(c).cast("string") for c in good.columns]).alias("line"))
            .unionByName(bad.select(F.lit("bad").alias("part"), "line")))
