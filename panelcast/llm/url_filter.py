"""URL filters by association rules.

Labelled pages become transactions: the tokens of their URL, and one more item if the label is bad.
FP-growth finds the frequent item sets; rules ``tokens -> bad`` are kept from ``min_support`` and
``min_confidence`` on.  A rule stands in an inverted index under its rarest token.  An URL meets the
index with each of its tokens, and a rule it meets fires if all its tokens are in the URL.  Before
that, a list of host and path rules decides, the longest that fits first.

Only DataFrame functions and Spark ML run.  URLs are matched once however many pages hold them.  The
index is joined by token; a token that stands in a third of the URLs is a skewed join, which AQE splits.

Defined cases: a null URL or one without ``://`` has an empty host and path, no tokens, and is allowed;
repeated labels of a page count once and bad wins; null labels count as good; no labels at all give no rules;
a null ``page_id`` is judged like any other; extra columns pass through ``judge``; an empty table gives
an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelcast.llm.common import ascii_lower, fresh, table

BAD = "label:bad"

# (verdict, host, path): the fixed list of the query.
LIST = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)


@dataclass(frozen=True)
class RuleParams:
    min_support: float = 0.002    # share of labelled pages that hold the tokens and are bad
    min_pages: int = 3            # and so many of them at least
    min_confidence: float = 0.6   # share of the pages with the tokens that are bad


def url_host(url: Column) -> Column:
    return F.coalesce(ascii_lower(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)), F.lit(""))


def url_path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def url_tokens(url: Column) -> Column:
    """Distinct tokens: each host label, the whole host, path segments (digits as #), query keys."""
    host, path = url_host(url), url_path(url)
    query = F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^?#]*\?([^#]*)", 1), F.lit(""))

    def tagged(values: Column, tag: str) -> Column:
        return F.transform(F.filter(values, lambda x: x != ""), lambda x: F.concat(F.lit(tag), x))

    return F.array_distinct(F.concat(
        tagged(F.array(host), "host:"), tagged(F.split(host, r"\."), "label:h:"),
        tagged(F.transform(F.split(path, "/"), lambda x: F.regexp_replace(x, "[0-9]+", "#")), "path:"),
        tagged(F.transform(F.split(query, "&"), lambda x: F.regexp_extract(x, "^([^=]*)", 1)), "query:")))


def list_rule(host: Column, path: Column, rules=LIST) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, both null if none does."""
    rule = verdict = None
    for v, h, p in sorted(rules, key=lambda r: -len(r[1] + r[2])):
        fits = ((host == h) | F.endswith(host, F.lit("." + h))) & F.startswith(path, F.lit(p))
        rule = F.when(fits, F.lit(h + p)) if rule is None else rule.when(fits, F.lit(h + p))
        verdict = F.when(fits, F.lit(v)) if verdict is None else verdict.when(fits, F.lit(v))
    return rule, verdict


def mine(pages: DataFrame, labels: DataFrame, p: RuleParams = RuleParams()) -> DataFrame:
    """``(tokens, support, confidence)`` of the rules; ``pages(page_id, url)``, ``labels(page_id, bad)``."""
    known = labels.groupBy("page_id").agg(F.max(F.coalesce("bad", F.lit(False))).alias("bad"))
    rows = (pages.join(known, "page_id").select(url_tokens(F.col("url")).alias("tokens"), "bad").where(F.size("tokens") > 0)
            .select(F.when(F.col("bad"), F.concat("tokens", F.array(F.lit(BAD)))).otherwise(F.col("tokens")).alias("items")))
    n = rows.count()
    least = max(p.min_pages, -int(-p.min_support * n // 1))
    if n < least:
        return pages.sparkSession.createDataFrame([], "tokens array<string>, support double, confidence double")
    model = FPGrowth(itemsCol="items", minSupport=(least - 0.5) / n, minConfidence=p.min_confidence).fit(rows)
    return (model.associationRules.where(F.col("consequent")[0] == BAD)
            .select(F.col("antecedent").alias("tokens"), "support", "confidence"))


def inverted_index(rules: DataFrame, pages: DataFrame) -> DataFrame:
    """``(token, tokens)``: every rule under the token that the fewest distinct URLs hold."""
    used = rules.select(F.explode("tokens").alias("token")).distinct()
    held = (pages.select("url").distinct().select(F.explode(url_tokens(F.col("url"))).alias("token"))
            .groupBy("token").count())
    rare = used.join(held, "token", "left").select("token", F.coalesce("count", F.lit(0)).alias("held"))
    each = rules.select("tokens", F.explode("tokens").alias("token")).join(rare, "token")
    return each.groupBy("tokens").agg(F.min_by("token", F.struct("held", "token")).alias("token")).select("token", "tokens")


def blocked_urls(pages: DataFrame, rules: DataFrame) -> DataFrame:
    """Distinct URLs for which a rule fires."""
    urls = pages.select("url").where("url IS NOT NULL").distinct().select("url", url_tokens(F.col("url")).alias("have"))
    met = urls.select("url", "have", F.explode("have").alias("token")).join(inverted_index(rules, pages), "token")
    return met.where(F.size(F.array_except("tokens", "have")) == 0).select("url").distinct()


def judge(pages: DataFrame, labels: DataFrame, p: RuleParams = RuleParams(), rules=LIST,
          page_id: str = "page_id", url: str = "url") -> DataFrame:
    """``pages``, all columns, with host, path, rule, verdict.  ``labels(page_id, bad)``.

    Input columns with one of those four names (in any case) are replaced; the ids and URLs are read before.
    """
    result = {"host", "path", "rule", "verdict"}
    (own,) = fresh(pages, "own_url")
    pages = pages.withColumn(own, F.col(url))
    lean = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"))
    (hit,) = fresh(pages, "hit_url")
    open_ = lean.where(list_rule(url_host(F.col("url")), url_path(F.col("url")), rules)[0].isNull())
    blocked = blocked_urls(open_, mine(lean, labels, p)).select(F.col("url").alias(hit))
    rule, verdict = list_rule(F.col("host"), F.col("path"), rules)
    return (pages.drop(*(c for c in pages.columns if c.lower() in result)).join(blocked, F.col(own) == F.col(hit), "left")
            .withColumns({"host": url_host(F.col(own)), "path": url_path(F.col(own))})
            .withColumn("rule", rule)
            .withColumn("verdict", F.coalesce(verdict, F.when(F.col(hit).isNotNull(), "block").otherwise("allow")))
            .drop(hit, own))


def op3_url_filter(spark, sf_dir: str) -> DataFrame:
    """The verdict on every URL of ``pages``; pages and ``labels`` share their ids."""
    labels = table(spark, sf_dir, "labels", "doc_id", "quality", "toxic") \
        .select(F.col("doc_id").alias("page_id"), ((F.col("quality") == 0) | (F.col("toxic") == 1)).alias("bad"))
    return judge(table(spark, sf_dir, "pages", "page_id", "url"), labels) \
        .select("page_id", "host", "path", "rule", "verdict")


OP3_SQL = r"""
WITH u AS (
  SELECT page_id, url,
         translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path,
         coalesce(regexp_extract(url, '(?s)^.*?://[^?#]*\?([^#]*)', 1), '') AS query
  FROM pages),
r AS (
  SELECT *, CASE
    WHEN (host = 'example.org' OR host LIKE '%.example.org') AND starts_with(path, '/en/1') THEN 'example.org/en/1'
    WHEN (host = 'example.org' OR host LIKE '%.example.org') AND starts_with(path, '/es/') THEN 'example.org/es/'
    WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/fr/') THEN 'com/fr/'
    WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/de/') THEN 'com/de/'
    WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/') THEN 'org/' END AS rule
  FROM u),
tok AS (
  SELECT *, list_sort(list_distinct(list_concat(list_concat(
    CASE WHEN host = '' THEN [] ELSE ['host:' || host] END,
    list_transform(list_filter(string_split(host, '.'), lambda x: x <> ''), lambda x: 'label:h:' || x)), list_concat(
    list_transform(list_filter(list_transform(string_split(path, '/'), lambda x: regexp_replace(x, '[0-9]+', '#', 'g')),
                               lambda x: x <> ''), lambda x: 'path:' || x),
    list_transform(list_filter(list_transform(string_split(query, '&'), lambda x: regexp_extract(x, '^([^=]*)', 1)),
                               lambda x: x <> ''), lambda x: 'query:' || x))))) AS tokens
  FROM r),
known AS (SELECT doc_id AS page_id, max(coalesce(quality = 0 OR toxic = 1, false)) AS bad FROM labels GROUP BY doc_id),
tr AS (SELECT row_number() OVER () AS t, tokens, bad FROM tok JOIN known USING (page_id) WHERE len(tokens) > 0),
least AS (SELECT greatest(3, CAST(ceil(0.002 * count(*)) AS BIGINT)) AS m FROM tr),
common AS (
  SELECT tok1, count(*) FILTER (WHERE bad) AS b FROM (SELECT bad, unnest(tokens) AS tok1 FROM tr)
  GROUP BY tok1 HAVING b >= (SELECT m FROM least)),
lean AS (
  SELECT t, bad, list_sort(list(k)) AS tokens
  FROM (SELECT t, bad, unnest(tokens) AS k FROM tr) WHERE k IN (SELECT tok1 FROM common) GROUP BY t, bad),
subsets AS (
  SELECT t, bad, list_transform(list_filter(range(1, len(tokens) + 1), lambda i: (mask >> (i - 1)) & 1 = 1), lambda i: tokens[i]) AS s
  FROM (SELECT t, bad, tokens, unnest(range(1, CAST(1 AS BIGINT) << len(tokens))) AS mask FROM lean)),
rules AS (
  SELECT s FROM subsets GROUP BY s
  HAVING count(*) FILTER (WHERE bad) >= (SELECT m FROM least)
     AND count(*) FILTER (WHERE bad) / count(*) >= 0.6),
fired AS (SELECT DISTINCT url FROM tok, rules WHERE rule IS NULL AND len(list_intersect(tokens, s)) = len(s))
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('org/', 'com/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
            WHEN fired.url IS NOT NULL THEN 'block' ELSE 'allow' END AS verdict
FROM tok LEFT JOIN fired USING (url)
"""
