"""URL filters: given rules first, then association rules mined by FP-growth.

Every URL becomes a set of tokens (labels of its host from the right, words and
kinds of its path and query).  URLs whose document carries a label are the
baskets; a labelled-bad basket also holds the class token.  FP-growth finds the
frequent token sets, and rules ``tokens => bad`` are kept when they reach the
support and confidence and no rule with fewer of the same tokens does as well.
Tokens that stand in the same baskets are one item while mining (thirty query
keys that always come together would else make 2^30 sets); a rule names all
tokens of its items, and any of an item's tokens meets it, which is what the rules
of the single tokens would say.  The kept rules form an inverted index from the
tokens of each rule's rarest item; a URL looks up its own tokens there and a rule
fires when all its items are met.

A URL's document is the last whole number of its path.  Null URLs and URLs
without "://" have an empty host and path, no given rule, and no tokens, so they
are allowed.  Without labels, or without bad ones, no rule is mined and every URL
that no given rule fits is allowed.  Equal rows get equal verdicts.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripwise.llm.common import stored, table

# fixed values of the contract: (verdict, host, path)
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
#: share of all baskets that hold a rule's tokens and the class; share of bad ones among those that hold the tokens
MIN_SUPPORT, MIN_CONFIDENCE = 0.005, 0.6
#: baskets that must hold a rule's tokens and the class, however few baskets there are
MIN_BASKETS = 5
BAD = "class=bad"


def host_of(url: Column) -> Column:
    after = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(F.coalesce(after, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def given_rule(host: Column, path: Column) -> tuple[Column, Column]:
    """The longest given rule that fits, and its verdict; null where none does."""
    rule = verdict = F.lit(None).cast("string")
    for kind, rule_host, rule_path in sorted(RULES, key=lambda r: len(r[1] + r[2])):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        rule = F.when(fits, F.lit(rule_host + rule_path)).otherwise(rule)
        verdict = F.when(fits, F.lit(kind)).otherwise(verdict)
    return rule, verdict


def tokens_of(url: Column, host: Column, path: Column) -> Column:
    """Distinct tokens: host labels, scheme, page ending, path parts without numbers, query keys."""
    labels = F.split(host, r"\.")
    query = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)\?([^#]*)", 1)
    tail = F.lower(F.regexp_extract(path, r"\.([A-Za-z0-9]+)$", 1))
    part = lambda name, value: F.concat(F.lit(name + "="), value)
    found = F.concat(
        F.transform(labels, lambda x: part("host", x)),
        F.array(part("scheme", F.substring_index(url, "://", 1)),
                part("end", F.when(tail != "", tail).when(path.endswith("/"), F.lit("/")))),
        F.transform(F.filter(F.split(path, "/"), lambda x: ~x.rlike("[0-9]") & (x != "")), lambda x: part("path", F.lower(x))),
        F.transform(F.filter(F.split(query, "&"), lambda x: x != ""), lambda x: part("query", F.substring_index(x, "=", 1))))
    return F.when(host != "", F.array_distinct(F.filter(found, lambda x: x.isNotNull()))).otherwise(F.array().cast("array<string>"))


def parsed(pages: DataFrame, url: str = "url") -> DataFrame:
    """Every row with ``url_host``, ``url_path``, ``url_tokens`` and ``url_doc``."""
    host, path = host_of(F.col(url)), path_of(F.col(url))
    return pages.select("*", host.alias("url_host"), path.alias("url_path")).select(
        "*", tokens_of(F.col(url), F.col("url_host"), F.col("url_path")).alias("url_tokens"),
        F.expr(r"try_cast(nullif(regexp_extract(url_path, '.*/([0-9]+)[^0-9/]*/?$', 1), '') as bigint)").alias("url_doc"))


def mine(pages: DataFrame, labels: DataFrame, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """Rules (tokens of each item, those of the rarest item, confidence, support) that lead to the bad class.

    At most 1/min_support single tokens are frequent for each token of a URL, which
    bounds what FP-growth holds on the driver; baskets are pre-aggregated nowhere
    else than in its own conditional trees, which Spark deals out by token.
    """
    bad = (F.max(F.coalesce(F.col("quality") == 0, F.lit(False)) | F.coalesce(F.col("toxic") == 1, F.lit(False))))
    marked = labels.where("doc_id IS NOT NULL AND (quality IS NOT NULL OR toxic IS NOT NULL)").groupBy("doc_id").agg(bad.alias("bad"))
    baskets = (pages.where("url_doc IS NOT NULL AND size(url_tokens) > 0").join(marked, F.col("url_doc") == F.col("doc_id"))
               .groupBy("url_tokens").agg(F.count("*").alias("n"), F.count_if("bad").alias("n_bad")))
    baskets = stored(baskets, "url-baskets")
    n = baskets.agg(F.sum("n")).first()[0] or 0
    least = min(1.0, max(min_support, MIN_BASKETS / n if n else 1.0))
    # tokens of the same baskets are one item, named by the smallest of them
    opened = baskets.select("url_tokens", "n", F.explode("url_tokens").alias("token"))
    key = F.xxhash64("url_tokens")
    places = (opened.groupBy("token").agg(F.sum("n").alias("n"), F.count("*").alias("sets"), F.bit_xor(key).alias("x"),
                                          F.sum(key.cast("decimal(38,0)")).alias("s")).where(F.col("n") >= least * n))
    of_sets = Window.partitionBy("sets", "x", "s")
    named = stored(places.withColumn("item", F.min("token").over(of_sets)).select("token", "item"), "url-items")
    items = (opened.join(named, "token").groupBy("url_tokens").agg(F.sort_array(F.collect_set("item")).alias("items")))
    # every basket counts as often as its tokens occur; one whose tokens are all rare stays, for the shares
    counted = baskets.join(items, "url_tokens", "left").select(F.coalesce("items", F.array().cast("array<string>")).alias("items"), "n", "n_bad")
    repeated = lambda rows, times: rows.where(times > 0).withColumn("i", F.explode(F.sequence(F.lit(1).cast("long"), times))).select("items")
    baskets = repeated(counted, F.col("n") - F.col("n_bad")).unionByName(
        repeated(counted.withColumn("items", F.array_append("items", F.lit(BAD))), F.col("n_bad")))
    model = FPGrowth(itemsCol="items", minSupport=least, minConfidence=min_confidence).fit(baskets)
    rules = (model.associationRules.where(F.array_contains("consequent", BAD))
             .select(F.array_sort("antecedent").alias("tokens"), "confidence", "support"))
    # a rule says nothing new if one with fewer of its tokens is as sure
    wider = rules.select(F.col("tokens").alias("few"), F.col("confidence").alias("sure"), F.col("tokens")[0].alias("first"))
    opened = rules.select("tokens", "confidence", F.explode("tokens").alias("first"))
    pruned = (opened.join(wider, "first").where((F.size("few") < F.size("tokens")) & (F.col("sure") >= F.col("confidence"))
                                                & (F.size(F.array_except("few", "tokens")) == 0)).select("tokens").distinct())
    alone = model.freqItemsets.where(F.size("items") == 1).select(F.col("items")[0].alias("token"), "freq")
    rarest = (rules.select("tokens", F.explode("tokens").alias("token")).join(alone, "token")
              .groupBy("tokens").agg(F.min_by("token", F.struct("freq", "token")).alias("rarest")))
    kept = rules.join(pruned, "tokens", "left_anti").join(rarest, "tokens")
    members = named.groupBy("item").agg(F.sort_array(F.collect_list("token")).alias("members"))
    return (kept.select("*", F.explode("tokens").alias("item")).join(members, "item").groupBy("tokens", "confidence", "support")
            .agg(F.collect_list("members").alias("needs"), F.max(F.when(F.col("item") == F.col("rarest"), F.col("members"))).alias("rarest"))
            .select(F.col("needs").alias("tokens"), "rarest", "confidence", "support"))


def judge(pages: DataFrame, rules: DataFrame) -> DataFrame:
    """Every row with ``url_rule`` (given rule or null) and ``url_verdict``; ``pages`` is parsed.

    Mined rules are matched through an inverted index: each rule stands under the
    tokens of its rarest item.  Distinct token sets are matched once, so many URLs of one host
    are one lookup; the rules are joined by their size as Spark sees fit.
    """
    rule, verdict = given_rule(F.col("url_host"), F.col("url_path"))
    pages = pages.select("*", rule.alias("url_rule"), verdict.alias("tw_given"), F.xxhash64("url_tokens").alias("tw_set"))
    index = rules.select(F.col("tokens").alias("needs"), F.explode("rarest").alias("token"))
    distinct = pages.where("tw_given IS NULL AND size(url_tokens) > 0").groupBy("tw_set").agg(F.first("url_tokens").alias("have"))
    fired = (distinct.select("tw_set", "have", F.explode("have").alias("token")).join(index, "token")
             .where(F.forall("needs", lambda item: F.arrays_overlap(item, F.col("have")))).select("tw_set").distinct().withColumn("tw_bad", F.lit(True)))
    return (pages.join(fired, "tw_set", "left")
            .withColumn("url_verdict", F.coalesce("tw_given", F.when(F.col("tw_bad"), F.lit("block")), F.lit("allow")))
            .drop("tw_set", "tw_bad", "tw_given"))


def op8_url_rules(spark, sf_dir: str) -> DataFrame:
    """Per page: host, path, the given rule that decides and the verdict."""
    pages = parsed(table(spark, sf_dir, "pages", "page_id", "url"))
    rules = mine(pages, table(spark, sf_dir, "labels", "doc_id", "quality", "toxic"))
    return judge(pages, rules).select("page_id", F.col("url_host").alias("host"), F.col("url_path").alias("path"),
                                      F.col("url_rule").alias("rule"), F.col("url_verdict").alias("verdict"))


_FIT = "((host = '{0}' OR ends_with(host, '.{0}')) AND starts_with(path, '{1}'))"
_LONGEST = sorted(RULES, key=lambda r: -len(r[1] + r[2]))
ORACLE = f"""
WITH p AS (
  SELECT page_id, url, translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages),
t AS (
  SELECT *, TRY_CAST(nullif(regexp_extract(path, '.*/([0-9]+)[^0-9/]*/?$', 1), '') AS BIGINT) AS doc,
         CASE {" ".join(f"WHEN {_FIT.format(h, q)} THEN '{h + q}'" for _, h, q in _LONGEST)} END AS rule,
         CASE {" ".join(f"WHEN {_FIT.format(h, q)} THEN '{v}'" for v, h, q in _LONGEST)} END AS given,
         CASE WHEN host = '' THEN []::VARCHAR[] ELSE list_sort(list_distinct(list_filter(
           list_transform(string_split(host, '.'), lambda x: 'host=' || x)
           || ['scheme=' || split_part(url, '://', 1), 'end=' || coalesce(nullif(lower(regexp_extract(path, '\\.([A-Za-z0-9]+)$', 1)), ''), CASE WHEN ends_with(path, '/') THEN '/' END)]
           || list_transform(list_filter(string_split(path, '/'), lambda x: NOT regexp_matches(x, '[0-9]') AND x <> ''), lambda x: 'path=' || lower(x))
           || list_transform(list_filter(string_split(regexp_extract(url, '(?s)\\?([^#]*)', 1), '&'), lambda x: x <> ''), lambda x: 'query=' || split_part(x, '=', 1)),
           lambda x: x IS NOT NULL))) END AS tokens
  FROM p),
marked AS (
  SELECT doc_id AS doc, bool_or(coalesce(quality = 0, false) OR coalesce(toxic = 1, false)) AS bad FROM labels
  WHERE doc_id IS NOT NULL AND (quality IS NOT NULL OR toxic IS NOT NULL) GROUP BY doc_id),
baskets AS (SELECT tokens, bad FROM t JOIN marked USING (doc) WHERE len(tokens) > 0),
subsets AS (
  SELECT list_filter(tokens, lambda x, i: (mask >> (i - 1)) & 1 = 1) AS tokens, bad
  FROM (SELECT tokens, bad, unnest(generate_series(1, (1 << len(tokens)) - 1)) AS mask FROM baskets)),
mined AS (
  SELECT tokens FROM subsets GROUP BY tokens
  HAVING count(*) FILTER (bad) >= greatest({MIN_SUPPORT} * (SELECT count(*) FROM baskets), {MIN_BASKETS})
     AND count(*) FILTER (bad) / count(*) >= {MIN_CONFIDENCE}),
sets AS (SELECT DISTINCT tokens FROM t WHERE given IS NULL AND len(tokens) > 0),
fired AS (SELECT DISTINCT s.tokens, true AS bad FROM sets s JOIN mined m ON list_has_all(s.tokens, m.tokens))
SELECT page_id, host, path, rule, coalesce(given, CASE WHEN fired.bad THEN 'block' ELSE 'allow' END) AS verdict
FROM t LEFT JOIN fired USING (tokens)
"""
