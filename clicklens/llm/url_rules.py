"""URL filter from fixed rules and mined association rules.

Fixed rules (host, path) come first: a rule fits its host and all subdomains if the
url's path starts with the rule's path, and the longest rule (host and path) wins.
The list is a parameter that the caller writes, so it becomes one CASE expression.

All other urls are judged by association rules. Urls that a fixed rule covers are
the labelled examples. A url becomes a basket of tokens: scheme, top-level domain,
registered domain, every further host label, the first and second path segment by
place, every deeper segment, the extension, every query name, and whether it has a
query or a fragment; numbers are one token. Spark's FP-growth mines the baskets with
their labels; rules that end in a label are kept if they reach the support and the
confidence. Each rule is indexed by its rarest token; urls meet the rules of their
tokens there, and a rule matches if the url has all its tokens. The most confident
match decides, then support, then label and text order; a url without a match is allowed.

Baskets may be long, and a group of copies would make every subset of its tokens
frequent, so items that can't change a verdict don't enter FP-growth. Tokens below the
support are left out, as FP-growth does itself. A token whose urls all have one label is
a rule alone: longer rules with it have no more confidence and less support. Of tokens
that occur in the very same labelled urls one stands for all: rules that differ only
in these have equal figures. What is left grows with the tokens that are frequent
together in other ways; the support bounds it.

Defined results: null urls and urls without ``://`` have an empty host and path and
no fixed rule; they have no tokens, so they are allowed. Repeated rows get the same
verdict each. Without labelled urls there are no mined rules. Extra columns pass
through ``judge``; its own columns replace those of the same name.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import ceil

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clicklens.llm.common import materialize, shielded

# (verdict, host, path)
RULES = (("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
         ("allow", "com", "/fr/"), ("block", "com", "/de/"))
DEFAULT = "allow"
MIN_SUPPORT, MIN_CONFIDENCE = 0.005, 0.8
LABEL = "label="
HOT = 1024


def _rest(url: Column) -> Column:
    at = F.locate("://", url)
    return F.when(at > 0, F.expr("substring(url, locate('://', url) + 3)"))


def with_parts(urls: DataFrame) -> DataFrame:
    """Adds host and path of column ``url``."""
    rest = F.coalesce(_rest(F.col("url")), F.lit(""))
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return urls.withColumns({
        "host": F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), upper, upper.lower()),
        "path": F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)})


def fixed_rule(rules: Sequence[tuple[str, str, str]]) -> tuple[Column, Column]:
    """(rule text, verdict) of columns host and path; null where no rule fits."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for v, host, path in sorted(rules, key=lambda r: len(r[1] + r[2])):  # later ones are tested first
        fits = ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith(path)
        name, verdict = F.when(fits, host + path).otherwise(name), F.when(fits, v).otherwise(verdict)
    return name, verdict


def tokens() -> Column:
    """Sorted distinct tokens of columns url, host and path."""
    labels, segments = F.split("host", r"\."), F.split("path", "/")
    mark = F.regexp_extract("url", r"^[^#]*?\?([^#]*)", 1)

    def token(name: str, value: Column) -> Column:
        value = F.when(value.rlike("^[0-9]+$"), "#").otherwise(value)
        return F.when(F.length(value) > 0, F.concat(F.lit(f"{name}:"), value))

    def each(name: str, values: Column) -> Column:
        return F.transform(values, lambda v: token(name, v))

    single = F.array(token("scheme", F.expr("lower(substring(url, 1, locate('://', url) - 1))")),
                     token("tld", F.try_element_at(labels, F.lit(-1))),
                     token("domain", F.concat_ws(".", F.try_element_at(labels, F.lit(-2)), F.try_element_at(labels, F.lit(-1)))),
                     token("seg1", F.get(segments, F.lit(1))), token("seg2", F.get(segments, F.lit(2))),
                     token("ext", F.regexp_extract(F.element_at(segments, -1), r"\.([A-Za-z0-9]+)$", 1)),
                     F.when(F.locate("?", F.col("url")) > 0, "query"), F.when(F.locate("#", F.col("url")) > 0, "fragment"))
    every = F.concat(single, each("sub", F.slice(labels, 1, F.greatest(F.size(labels) - 2, F.lit(0)))),
                     each("seg", F.slice(segments, 4, F.greatest(F.size(segments) - 3, F.lit(0)))),
                     each("name", F.transform(F.split(mark, "[&;]"), lambda q: F.substring_index(q, "=", 1))))
    return F.when(F.length("host") > 0, F.array_sort(F.array_distinct(F.array_compact(every)))).otherwise(F.array().cast("array<string>"))


def condense(labelled: DataFrame, min_support: float = MIN_SUPPORT) -> DataFrame:
    """(tokens, label) -> (token, item, label, support) of the tokens that reach the support.

    ``item``: the token that stands for all that occur in the same rows. ``label``: the
    one label of all its rows, or null; such a token is a rule of confidence 1 alone."""
    rows = labelled.where("label IS NOT NULL AND size(tokens) > 0")
    total = rows.count()
    kinds = rows.groupBy("tokens", "label").agg(F.count(F.lit(1)).alias("n"))
    marks = [F.xxhash64("tokens", "label", F.lit(seed)) for seed in (1, 2)]
    found = (kinds.select("label", "n", marks[0].alias("x"), marks[1].alias("y"), F.explode("tokens").alias("token"))
             .groupBy("token").agg(F.sum("n").alias("n"), F.min("label").alias("low"), F.max("label").alias("high"),
                                   F.bit_xor("x").alias("x"), F.bit_xor("y").alias("y"))
             .where(F.col("n") >= ceil(min_support * total - 1e-9)))
    names = found.groupBy("n", "x", "y").agg(F.min("token").alias("item"))
    return found.join(names, ["n", "x", "y"]).select(
        "token", "item", F.when(F.col("low") == F.col("high"), F.col("low")).alias("label"), (F.col("n") / max(total, 1)).alias("support"))


def mine(labelled: DataFrame, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE, total: int | None = None) -> DataFrame:
    """(tokens, label) -> (rule_tokens, label, confidence, support) of rules that pass both bounds.

    Support is the share of the rows that have tokens, or of ``total`` rows."""
    kind = "rule_tokens array<string>, label string, confidence double, support double"
    baskets = labelled.where("label IS NOT NULL AND size(tokens) > 0").select(
        F.array_append("tokens", F.concat(F.lit(LABEL), "label")).alias("items"))
    if baskets.isEmpty():
        return labelled.sparkSession.createDataFrame([], kind)
    n = baskets.count()
    total = total or n
    least = max(1, ceil(min_support * total - 1e-9))  # rows; FP-growth rounds its share of n up to the same number
    if least > n:
        return labelled.sparkSession.createDataFrame([], kind)
    found = FPGrowth(itemsCol="items", minSupport=(least - 0.5) / n, minConfidence=min_confidence).fit(baskets).associationRules
    head = F.col("consequent")[0]
    return (found.where(head.startswith(LABEL) & ~F.exists("antecedent", lambda t: t.startswith(LABEL)))
            .select(F.array_sort("antecedent").alias("rule_tokens"), F.substring(head, len(LABEL) + 1, 1 << 20).alias("label"),
                    "confidence", (F.col("support") * (n / total)).alias("support")))


def rules_of(labelled: DataFrame, items: DataFrame, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """Rules over ``items`` (of ``condense``): tokens of one label alone, and what is mined from the others.

    The items to be mined reach the driver; they are at most the mean number of tokens of a basket / support."""
    mixed = [r["item"] for r in items.where("label IS NULL").select("item").distinct().collect()]
    baskets = labelled.withColumn("tokens", F.filter("tokens", lambda t: t.isin(mixed)) if mixed else F.array().cast("array<string>"))
    alone = items.where("label IS NOT NULL").select(F.array("item").alias("rule_tokens"), "label", F.lit(1.0).alias("confidence"), "support").distinct()
    return alone.union(mine(baskets, min_support, min_confidence, labelled.where("label IS NOT NULL AND size(tokens) > 0").count()))


def match(sets: DataFrame, rules: DataFrame, items: DataFrame) -> DataFrame:
    """(tokens) distinct sets -> (tokens, label, rule_tokens) of the best rule of each set that has one."""
    own = (sets.select("tokens", F.explode("tokens").alias("token")).join(items.select("token", "item"), "token")
           .groupBy("tokens").agg(F.collect_set("item").alias("items")))
    df = own.select(F.explode("items").alias("item")).groupBy("item").agg(F.count(F.lit(1)).alias("n"))
    by_item = rules.select("*", F.explode("rule_tokens").alias("item")).join(df, "item")
    index = by_item.groupBy("rule_tokens", "label", "confidence", "support").agg(
        F.min_by("item", F.struct("n", "item")).alias("item"))
    hits = (own.select("tokens", "items", F.explode("items").alias("item")).join(index, "item")
            .where(F.size(F.array_except("rule_tokens", "items")) == 0))
    best = F.struct("confidence", "support", "label", F.array_join("rule_tokens", " ").alias("text"), "rule_tokens")
    return hits.groupBy("tokens").agg(F.max(best).alias("best")).select("tokens", F.col("best.label").alias("label"), "best.rule_tokens")


def judge(urls: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES, min_support: float = MIN_SUPPORT,
          min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """Adds host, path, rule, verdict and mined_rule (its tokens) to rows with a ``url``."""
    rule, verdict = fixed_rule(rules)
    own = ["host", "path", "rule", "verdict", "mined_rule"]
    urls, back = shielded(urls, ["_fixed", "_tokens", "_set", "_learned"])
    kept = [c for c in urls.columns if c not in own]
    parts = (with_parts(urls).withColumns({"rule": rule, "_fixed": verdict, "_tokens": tokens()}))
    labelled = parts.select(F.col("_tokens").alias("tokens"), F.col("_fixed").alias("label"))
    items = materialize(condense(labelled, min_support), "url-items")
    mined = materialize(rules_of(labelled, items, min_support, min_confidence), "url-rules")
    # sets that hold more than 1 / HOT of the urls, fewer than HOT of them, are joined by broadcast: none is a hot key
    sets = materialize(parts.where("_fixed IS NULL").groupBy(F.col("_tokens").alias("tokens")).agg(F.count(F.lit(1)).alias("n")), "url-sets")
    best = match(sets.select("tokens"), mined, items).select(F.col("tokens").alias("_set"), F.col("label").alias("_learned"), F.col("rule_tokens").alias("mined_rule"))
    hot = sets.where(F.col("n") * HOT > (sets.agg(F.sum("n")).first()[0] or 0)).select("tokens")
    best = materialize(best, "url-best")
    hot_best = hot.join(best, F.col("tokens") == F.col("_set"), "left").select(F.col("tokens").alias("_set"), "_learned", "mined_rule")
    parts = parts.drop("verdict", "mined_rule")
    open_urls, same = parts.where("_fixed IS NULL"), F.col("_tokens") == F.col("_set")
    often = open_urls.join(F.broadcast(hot_best), same)
    others = open_urls.join(F.broadcast(hot_best.select("_set")), same, "left_anti").join(best, same, "left")
    learned = often.unionByName(others).withColumn("verdict", F.coalesce("_learned", F.lit(DEFAULT)))
    # urls of a fixed rule take no part in the join, where they would share one key
    fixed = parts.where("_fixed IS NOT NULL").withColumns({"verdict": F.col("_fixed"), "mined_rule": F.lit(None).cast("array<string>")})
    return learned.select(*kept, *own).unionByName(fixed.select(*kept, *own)).withColumnsRenamed(back)


def query(pages: DataFrame) -> DataFrame:
    return judge(pages.select("page_id", "url")).select("page_id", "host", "path", "rule", "verdict", F.array_join("mined_rule", " ").alias("mined_rule"))
