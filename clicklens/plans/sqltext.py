"""DuckDB text for the oracle side of each registered query.

Small generators keep the per-column SQL (unpivot by UNION ALL, threshold
CASE) in step with the column lists the Spark side uses.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from clicklens.fixtures import IMPRESSIONS_SQL, SCORED_SQL


def counts_sql(cols: Sequence[str], src: str) -> str:
    """(col_name, value, n) for all columns, null group kept."""
    parts = [f"SELECT '{c}' AS col_name, CAST({c} AS VARCHAR) AS value FROM {src}" for c in cols]
    return ("SELECT col_name, value, COUNT(*) AS n FROM ("
            + " UNION ALL ".join(parts) + ") u GROUP BY col_name, value")


def threshold_case(thresholds: Mapping[str, int], col: str = "col_name") -> str:
    whens = " ".join(f"WHEN '{c}' THEN {int(t)}" for c, t in thresholds.items())
    return f"CASE {col} {whens} END"


def vocab_sql(cols: Sequence[str], thresholds: Mapping[str, int], src: str) -> str:
    t = {c: thresholds[c] for c in cols}
    return (f"SELECT col_name, value, n, (value IS NOT NULL AND n > {threshold_case(t)}) AS kept "
            f"FROM ({counts_sql(cols, src)}) c")


def with_impressions(body: str, extra: str = "") -> str:
    extra = (",\n" + extra) if extra else ""
    return f"WITH imp AS ({IMPRESSIONS_SQL}){extra}\n{body}"


def with_scored(body: str, extra: str = "") -> str:
    extra = (",\n" + extra) if extra else ""
    return f"WITH sc AS ({SCORED_SQL}){extra}\n{body}"


def stash_sql(cols: Sequence[str], sentinels: Mapping[str, int], src: str = "imp",
              vocab: str = "vocab", keep_cols: Sequence[str] = ("id", "y")) -> str:
    """SELECT of ``keep_cols`` plus ``<c>_t`` per column (null and rare to
    the stash value) from ``src`` joined to the keep lists of ``vocab``."""
    sel = [f"{src}.{k}" for k in keep_cols]
    joins = []
    for i, c in enumerate(cols):
        stash = str(int(sentinels[c])) if c in sentinels else f"'stash_{c}'"
        sel.append(f"CASE WHEN k{i}.value IS NOT NULL THEN {src}.{c} ELSE {stash} END AS {c}_t")
        joins.append(f"LEFT JOIN (SELECT value FROM {vocab} WHERE kept AND col_name = '{c}') k{i} "
                     f"ON CAST({src}.{c} AS VARCHAR) = k{i}.value")
    return f"SELECT {', '.join(sel)} FROM {src} " + " ".join(joins)


def labels_sql(cols: Sequence[str], sentinels: Mapping[str, int], vocab: str = "vocab") -> str:
    """Stashed labels with index, size, base slot, slot and feature name."""
    stash_case = "CASE col_name " + " ".join(
        f"WHEN '{c}' THEN '{sentinels[c] if c in sentinels else 'stash_' + c}'" for c in cols) + " END"
    pos_case = "CASE col_name " + " ".join(f"WHEN '{c}' THEN {i}" for i, c in enumerate(cols)) + " END"
    return f"""
SELECT i.col_name, i.label, CAST(i.n AS BIGINT) AS n, CAST(i.idx AS INTEGER) AS idx,
       CAST(i.size AS INTEGER) AS size, CAST(o.base_slot AS INTEGER) AS base_slot,
       CAST(o.base_slot + i.idx AS INTEGER) AS slot, i.col_name || 'v_' || i.label AS feature
FROM (SELECT *, row_number() OVER (PARTITION BY col_name ORDER BY n DESC, label ASC) - 1 AS idx,
             count(*) OVER (PARTITION BY col_name) AS size
      FROM (SELECT col_name, value AS label, n FROM {vocab} WHERE kept
            UNION ALL
            SELECT col_name, {stash_case} AS label, sum(n) AS n FROM {vocab} WHERE NOT kept
            GROUP BY col_name) l) i
JOIN (SELECT col_name, coalesce(sum(size) OVER (ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
             AS base_slot
      FROM (SELECT DISTINCT col_name, size, {pos_case} AS pos
            FROM (SELECT col_name, count(*) OVER (PARTITION BY col_name) AS size
                  FROM (SELECT col_name FROM {vocab} WHERE kept
                        UNION ALL SELECT DISTINCT col_name FROM {vocab} WHERE NOT kept) a) b) c) o
  ON i.col_name = o.col_name"""


def coefficients_sql(cols: Sequence[str], thresholds: Mapping[str, int], sentinels: Mapping[str, int],
                     near_miss: tuple) -> str:
    """Fixture D in SQL: needs the ``imp`` CTE."""
    st = stash_sql(cols, sentinels)
    long = " UNION ALL ".join(
        f"SELECT y, '{c}' AS col_name, CAST({c}_t AS VARCHAR) AS label FROM st" for c in cols)
    return f"""(WITH vocab AS ({vocab_sql(cols, thresholds, 'imp')}),
st AS ({st} WHERE imp.y IS NOT NULL)
SELECT col_name || 'v_' || label AS feature, ln((rate + 0.01) / (1.01 - rate)) AS coeff
FROM (SELECT col_name, label, avg(y) AS rate FROM ({long}) u GROUP BY col_name, label) r
UNION ALL SELECT '{near_miss[0]}' AS feature, {near_miss[1]} AS coeff)"""


# ---------------------------------------------------------------- model jobs
def signal_parts(train_cut: int, salt: str, body: str, extra: str = "") -> str:
    """The signal fixture split by md5 of the salted id: ``sig``, ``tr`` and ``te``."""
    extra = (",\n" + extra) if extra else ""
    return f"""WITH imp AS ({IMPRESSIONS_SQL}),
sig AS (SELECT * REPLACE (CAST(CASE WHEN n4 >= 75 OR ('0x' || substr(md5(CAST(id AS VARCHAR)), 1, 2))::INTEGER < 13 THEN 1 ELSE 0 END AS INTEGER) AS y)
        FROM imp WHERE y IS NOT NULL),
pt AS (SELECT *, ('0x' || substr(md5('{salt}' || CAST(id AS VARCHAR)), 1, 6))::INTEGER < {train_cut} AS in_train FROM sig),
tr AS (SELECT * FROM pt WHERE in_train), te AS (SELECT * FROM pt WHERE NOT in_train){extra}
{body}"""


def share_vocab_sql(cols: Sequence[str], share: float, src: str) -> str:
    """As :func:`vocab_sql`, for values above a share of the rows."""
    return (f"SELECT col_name, value, n, (value IS NOT NULL AND n > (SELECT CAST(floor(count(*) * {share}) AS BIGINT) FROM {src})) AS kept "
            f"FROM ({counts_sql(cols, src)}) c")


def width_sql(vocabulary: str) -> str:
    """One number: one-hot slots of the stashed columns."""
    return (f"(SELECT CAST(sum(w) AS BIGINT) FROM (SELECT count(*) FILTER (kept) + CAST(count(*) FILTER (NOT kept) > 0 AS INTEGER) AS w "
            f"FROM ({vocabulary}) v GROUP BY col_name) u)")


def job_row(model: str, width: str) -> str:
    """The exact part of a job's metrics; a model that learned beats the base rate and chance."""
    return f"""SELECT '{model}' AS model, train_rows, round(p, 6) AS base_rate, round(p * -ln(p + 1e-16) + (1.0 - p) * -ln(1.0 - p + 1e-16), 6) AS baseline_log_loss,
       {width} AS width, test_rows, positives, test_rows - positives AS negatives, true AS learned
FROM (SELECT CAST(count(*) AS BIGINT) AS train_rows, avg(CAST(y AS DOUBLE)) AS p FROM tr) a,
     (SELECT CAST(count(*) AS BIGINT) AS test_rows, CAST(sum(y) AS BIGINT) AS positives FROM te) b"""


def best_split(cols: Sequence[str], src: str) -> str:
    """CTEs ending in ``best``: the split (column, last value to the left) of least weighted Gini impurity."""
    rows = " UNION ALL ".join(f"SELECT '{c}' AS f, CAST({c} AS DOUBLE) AS v, y FROM {src}" for c in cols)
    return f"""lo AS ({rows}),
ct AS (SELECT f, v, count(*) AS n, sum(y) AS s FROM lo GROUP BY f, v),
cu AS (SELECT f, v, lead(v) OVER (PARTITION BY f ORDER BY v) AS nv, sum(n) OVER (PARTITION BY f ORDER BY v) AS ln, sum(s) OVER (PARTITION BY f ORDER BY v) AS ls,
              sum(n) OVER (PARTITION BY f) AS n, sum(s) OVER (PARTITION BY f) AS s FROM ct),
gi AS (SELECT *, ls * (1 - CAST(ls AS DOUBLE) / ln) + (s - ls) * (1 - CAST(s - ls AS DOUBLE) / (n - ln)) AS impurity FROM cu WHERE nv IS NOT NULL),
best AS (SELECT f, v FROM gi ORDER BY impurity LIMIT 1)"""
