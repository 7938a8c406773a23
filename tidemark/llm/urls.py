"""URL filters: host and path rules, and association rules of URL tokens mined from labelled pages."""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import write_through

#: Fixed values of the query: rule and verdict.
RULES = [
    ("org/", "allow"),
    ("example.org/es/", "block"),
    ("example.org/en/1", "block"),
    ("com/fr/", "allow"),
    ("com/de/", "block"),
]
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: The item that marks a transaction of a bad page; no token has a blank.
BAD = "label: bad"


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def matched_rule(host: Column, path: Column, rules: list[tuple[str, str]]) -> Column:
    """``rule, verdict`` of the longest rule that fits, else null. Rules are a short list that becomes one expression."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule, verdict in sorted(rules, key=lambda r: (len(r[0]), r[0])):
        name, slash, rest = rule.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(slash + rest)
        out = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def url_tokens(url: Column) -> Column:
    """Different tokens of a url: scheme, host, its labels, path words, file ending, query names; digits count as ``#``."""
    low = F.lower(F.coalesce(url, F.lit("")))
    host = host_of(low)
    path, query = path_of(low), F.regexp_extract(low, r"(?s)\?([^#]*)", 1)
    tagged = lambda tag, column: F.transform(
        F.filter(column, lambda x: x != ""), lambda x: F.concat(F.lit(tag + ":"), F.regexp_replace(x, "[0-9]+", "#"))
    )
    return F.array_distinct(F.concat(
        tagged("scheme", F.array(F.regexp_extract(low, r"(?s)^(.*?)://", 1))),
        tagged("host", F.array(host)),
        tagged("label", F.split(host, r"[.:@-]")),
        tagged("path", F.split(path, r"[/._~+-]")),
        tagged("query", F.transform(F.split(query, "&"), lambda x: F.substring_index(x, "=", 1))),
    ))


def mine_rules(
    labelled: DataFrame, least_support: float = 0.0005, least_count: int = 8, least_confidence: float = 0.6,
    least_lift: float = 2.0, longest: int = 3,
) -> DataFrame:
    """``tokens, key_token, support, confidence``: token sets that say bad, from ``labelled (tokens, bad)``.

    FP-growth finds token sets that are frequent in all labelled pages together
    with the label, and sets without it; confidence is their quotient. A rule
    stays if it is frequent, confident and ``least_lift`` times likelier bad than
    pages at large, has at most ``longest`` tokens and no rule on fewer of its
    tokens is as confident. ``key_token`` is its rarest token, the one under
    which it is found in the index.
    """
    spark = labelled.sparkSession
    items = F.when(F.col("bad"), F.array_append("tokens", F.lit(BAD))).otherwise(F.col("tokens"))
    baskets = write_through(labelled.where("size(tokens) > 0").select(items.alias("items"), "bad"), "baskets")
    total, bad = baskets.agg(F.count("*"), F.count(F.when(F.col("bad"), 1))).first()
    empty = spark.createDataFrame([], "tokens array<string>, key_token string, support double, confidence double")
    if not total or not bad:
        return empty
    support = min(1.0, max(least_support, least_count / total))
    model = FPGrowth(itemsCol="items", minSupport=support, minConfidence=least_confidence)
    frequent = model.fit(baskets.select("items")).freqItemsets
    frequent = write_through(frequent.select(F.array_sort("items").alias("items"), "freq"), "itemsets")
    marked = frequent.where(F.array_contains("items", BAD) & (F.size("items").between(2, longest + 1)))
    marked = marked.select(F.array_remove("items", BAD).alias("tokens"), F.col("freq").alias("both"))
    plain = frequent.where(~F.array_contains("items", BAD)).withColumnRenamed("items", "tokens")
    rules = marked.join(plain, "tokens").select(
        "tokens", (F.col("both") / total).alias("support"), (F.col("both") / F.col("freq")).alias("confidence")
    ).where((F.col("confidence") >= least_confidence) & (F.col("confidence") >= least_lift * bad / total))
    rules = write_through(rules, "rules")
    parts = rules.select("tokens", "confidence", F.explode("tokens").alias("gone"))
    # One token less at a time: what is worse than a smaller rule is worse than the best below it.
    smaller = parts.select("tokens", F.filter("tokens", lambda x: x != F.col("gone")).alias("less"), "confidence")
    worse = smaller.join(rules.select(F.col("tokens").alias("less"), F.col("confidence").alias("other")), "less")
    worse = worse.where("other >= confidence").select("tokens").distinct()
    kept = rules.join(worse, "tokens", "left_anti")
    single = plain.where(F.size("tokens") == 1).select(F.col("tokens")[0].alias("token"), "freq")
    keyed = kept.select("tokens", "support", "confidence", F.explode("tokens").alias("token")).join(single, "token")
    keyed = keyed.groupBy("tokens", "support", "confidence").agg(F.min(F.struct("freq", "token")).alias("rarest"))
    return keyed.select("tokens", F.col("rarest.token").alias("key_token"), "support", "confidence")


def match_rules(pages: DataFrame, rules: DataFrame) -> DataFrame:
    """``url, confidence, rule_tokens`` of urls that a rule matches, its most confident.

    Inverted index: each rule stands under its rarest token; the tokens of a url
    look up rules, which then must have all their tokens in the url.
    """
    urls = pages.select("url").where("url is not null").distinct().withColumn("tokens", url_tokens(F.col("url")))
    probes = urls.select("url", "tokens", F.explode("tokens").alias("key_token"))
    index = rules.select("key_token", F.col("tokens").alias("rule_tokens"), "confidence")
    hits = probes.join(index, "key_token").where(F.size(F.array_except("rule_tokens", "tokens")) == 0)
    best = hits.groupBy("url").agg(F.max(F.struct("confidence", F.concat_ws(" ", "rule_tokens").alias("rule_tokens"))).alias("b"))
    return best.select("url", "b.confidence", "b.rule_tokens")


def filter_urls(pages: DataFrame, labels: DataFrame, rules: list[tuple[str, str]] | None = None) -> DataFrame:
    """``page_id, host, path, rule, verdict, confidence, rule_tokens`` per row of ``pages (page_id, url)``.

    A fixed rule decides where one fits; else a mined rule blocks, else the page
    is allowed. Pages labelled by id (``labels (doc_id, quality, toxic)``) are
    what rules are mined from: bad is toxic or of quality 0; several labels of a
    page are bad if one is.

    A null url, or one without ``://``, has empty host and path, and no mined
    rule if it is null. Null ids have no label. Equal urls get equal verdicts,
    equal rows a row each. Without labels nothing is mined. An empty table gives
    an empty one. Urls are matched once each, however many pages share one.
    """
    bad = (F.coalesce(F.col("toxic"), F.lit(0)) == 1) | (F.coalesce(F.col("quality"), F.lit(1)) == 0)
    marks = labels.where("doc_id is not null").groupBy(F.col("doc_id").alias("page_id")).agg(F.max(bad).alias("bad"))
    slim = pages.select("page_id", "url")
    labelled = slim.join(marks, "page_id").select(url_tokens(F.col("url")).alias("tokens"), "bad")
    mined = match_rules(slim, mine_rules(labelled))
    out = slim.withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url"))})
    out = out.withColumn("fixed", matched_rule(F.col("host"), F.col("path"), RULES if rules is None else rules))
    out = out.join(mined, "url", "left")
    verdict = F.coalesce(F.col("fixed.verdict"), F.when(F.col("confidence").isNotNull(), "block").otherwise("allow"))
    return out.select(
        "page_id", "host", "path", F.col("fixed.rule").alias("rule"), verdict.alias("verdict"), "confidence", "rule_tokens"
    )
