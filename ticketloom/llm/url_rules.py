"""URL filter: host suffixes and path prefixes hashed, equi-joined with a rule table and confirmed by full digest.

Every URL is expanded into the host suffixes and path prefixes that a rule could name. The leading bytes of each
expression's SHA-256 are the join key, as in a hash-prefix block list; the whole digest then confirms a hit, and of a
URL's hits the longest rule wins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketloom.llm.common import read

RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))
DEFAULT_VERDICT = "allow"
PREFIX_DIGITS = 8
MAX_PATH = 8192
A_Z, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _after_scheme(url):
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url)))


def host_of(url):
    """What stands between the first ``://`` and the next ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    return F.translate(F.coalesce(F.regexp_extract(_after_scheme(url), r"^[^/?#]*", 0), F.lit("")), A_Z, LOWER)


def path_of(url):
    """From the host's end up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_table(spark: SparkSession, rules=RULES) -> DataFrame:
    """Rules as (rule_host, rule_path, rule_verdict); a rule text is host and path together."""
    return spark.createDataFrame(list(rules), "rule_host string, rule_path string, rule_verdict string")


def _expression(host, path):
    return F.concat(host, F.lit("\x1f"), path)


def judge_urls(pages: DataFrame, rules: DataFrame, url: str = "url", default: str = DEFAULT_VERDICT, keep: tuple[str, ...] = ("page_id",)) -> DataFrame:
    """One row per input row: the ``keep`` columns, then host, path, rule and verdict.

    ``rules`` has the columns of :func:`rule_table`. A rule fits its host and all subdomains if the path starts with
    the rule's; the longest text wins, then the longer host, then ``block``. Null URLs and those without ``://`` have
    an empty host and path, fit no rule and get the default. Repeated rows are judged alike, other columns ignored.

    URLs are judged once per distinct host and path, so a host with a third of all pages is expanded once per path.
    Only path lengths and label counts that some rule has are expanded: that is exact, and bounds the expressions of
    a URL by the rules' shape, whatever the URL's own length. Rule paths may have at most ``MAX_PATH`` characters.
    """
    rules = rules.select(F.translate("rule_host", A_Z, LOWER).alias("rule_host"), "rule_path", "rule_verdict").where("rule_host is not null and rule_path is not null").distinct()
    shape = rules.agg(F.collect_set(F.length("rule_path")).alias("paths"), F.collect_set(F.size(F.split("rule_host", r"\."))).alias("labels")).first()
    if max(shape["paths"], default=0) > MAX_PATH:
        raise ValueError(f"a rule path has more than {MAX_PATH} characters")
    whole = F.sha2(_expression(F.col("rule_host"), F.col("rule_path")), 256)
    rules = rules.select("*", whole.alias("digest"), F.substring(whole, 1, PREFIX_DIGITS).alias("prefix"), F.concat("rule_host", "rule_path").alias("rule_text"))
    split = pages.select(*[F.col(f"`{c}`") for c in keep], F.col(url).alias("url")).select(*[F.col(f"`{c}`") for c in keep], host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    distinct = split.where("host <> ''").select("host", "path").distinct()
    lengths = F.array(*[F.lit(n) for n in sorted(shape["paths"])]).cast("array<int>")
    counts = F.array(*[F.lit(n) for n in sorted(shape["labels"])]).cast("array<int>")
    made = distinct.select("host", "path", F.explode(F.filter(counts, lambda n: n <= F.size(F.split("host", r"\.")))).alias("n_labels"))
    made = made.select("host", "path", F.expr("substring_index(host, '.', -n_labels)").alias("suffix"))
    made = made.select("host", "path", "suffix", F.explode(F.filter(lengths, lambda n: n <= F.length("path"))).alias("n_path"))
    digest = F.sha2(_expression(F.col("suffix"), F.expr("substring(path, 1, n_path)")), 256)
    made = made.select("host", "path", digest.alias("own_digest")).withColumn("prefix", F.substring("own_digest", 1, PREFIX_DIGITS))
    hits = made.join(rules, "prefix").where(F.col("own_digest") == F.col("digest"))
    best = F.max(F.struct(F.length("rule_text").alias("n"), F.length("rule_host").alias("h"), (F.col("rule_verdict") == "block").alias("b"), F.col("rule_text").alias("rule"), F.col("rule_verdict").alias("verdict"))).alias("best")
    best = hits.groupBy("host", "path").agg(best).select("host", "path", "best.rule", "best.verdict")
    out = split.join(best, ["host", "path"], "left")
    return out.select(*[F.col(f"`{c}`") for c in keep], "host", "path", "rule", F.coalesce("verdict", F.lit(default)).alias("verdict"))


def op5_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(read(spark, sf_dir, "pages"), rule_table(spark))


ORACLE = r"""
WITH split AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) END AS rest FROM pages),
parts AS (
  SELECT page_id, translate(coalesce(regexp_extract(rest, '^[^/?#]*'), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path FROM split),
rules(rule_host, rule_path, rule_verdict) AS (VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
keys AS (SELECT DISTINCT host, path FROM parts),
best AS (
  SELECT host, path, arg_max(rule_host || rule_path, length(rule_host || rule_path)) AS rule, arg_max(rule_verdict, length(rule_host || rule_path)) AS verdict
  FROM keys JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path) GROUP BY host, path)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM parts LEFT JOIN best USING (host, path)
"""
