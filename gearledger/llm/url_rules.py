"""URL filters: fixed host and path rules first, then association rules mined from the URLs those rules label."""

from __future__ import annotations

import math

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gearledger.session import materialise

#: Fixed rules: verdict, host, path. A rule holds for its host and all subdomains, longest rule first.
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
MIN_SUPPORT = 0.005
MIN_CONFIDENCE = 0.9
#: Prefix of the item that carries a URL's label among its tokens; no token starts with it.
LABEL = "verdict="
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host and path; both empty for null or without ``://``."""
    at = F.locate("://", url)
    rest = F.when(at > 0, url.substr(at + 3, F.char_length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, LOWER)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def fixed_rule(host: Column, path: Column, rules: tuple = RULES) -> tuple[Column, Column]:
    """The longest fitting rule and its verdict; null where none fits."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for outcome, rule_host, rule_path in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        name = F.when(fits, F.lit(rule_host + rule_path)).otherwise(name)
        verdict = F.when(fits, F.lit(outcome)).otherwise(verdict)
    return name, verdict


def url_tokens(url: Column, host: Column, path: Column) -> Column:
    """Distinct tokens of a URL, sorted: scheme, host, its last label and first label, path segments without plain
    numbers, file ending, query keys, and whether there is a fragment. A URL without a host has none."""
    text = F.coalesce(url, F.lit(""))
    labels = F.split(host, r"\.")
    segments = F.filter(F.split(path, "/"), lambda s: (s != "") & ~s.rlike(r"^[0-9]+(\.[A-Za-z0-9]+)?$"))
    query = F.regexp_extract(text, r"\?([^#]*)", 1)
    keys = F.filter(F.split(query, "&"), lambda q: q != "")
    ending = F.regexp_extract(path, r"\.([A-Za-z0-9]+)$", 1)
    some = F.array(
        F.concat(F.lit("scheme:"), F.lower(F.regexp_extract(text, r"^([^:/?#]*)://", 1))),
        F.concat(F.lit("host:"), host), F.concat(F.lit("top:"), F.element_at(labels, -1)),
        F.when(F.size(labels) > 2, F.concat(F.lit("sub:"), F.element_at(labels, 1))),
        F.when(ending != "", F.concat(F.lit("ending:"), ending)),
        F.when(path.endswith("/"), F.lit("folder")), F.when(text.contains("#"), F.lit("fragment")))
    tokens = F.concat(some, F.transform(segments, lambda s: F.concat(F.lit("path:"), s)),
                      F.transform(keys, lambda q: F.concat(F.lit("key:"), F.split(q, "=")[0])))
    known = F.sort_array(F.array_distinct(F.filter(tokens, lambda t: t.isNotNull())))
    return F.when(host == "", F.array().cast("array<string>")).otherwise(known)


def token_bundles(labelled: DataFrame, min_support: float = MIN_SUPPORT) -> DataFrame:
    """Frequent tokens of rows of tokens and verdict: token, bundle, verdict, support.

    Tokens that stand in exactly the same rows share a bundle, named by its first token. They are told by their number
    of rows and two sums of row hashes. The verdict is that of all rows of the token, or null where they differ. There
    are at most ``tokens per row / min_support`` such tokens.
    """
    rows = labelled.groupBy("tokens", "verdict").agg(F.count(F.lit(1)).alias("n"))
    rows = rows.select("n", "verdict", F.explode("tokens").alias("token"),
                       F.xxhash64("tokens", "verdict").cast("decimal(20,0)").alias("one"),
                       F.xxhash64(F.lit(1), "verdict", "tokens").cast("decimal(20,0)").alias("two"))
    total = labelled.count()
    stood = rows.groupBy("token").agg(
        F.sum("n").alias("n"), F.sum("one").alias("one"), F.sum("two").alias("two"),
        F.min("verdict").alias("verdict"), F.max("verdict").alias("other"))
    frequent = stood.where(F.col("n") >= math.ceil(total * min_support))
    together = Window.partitionBy("n", "one", "two")
    return frequent.select("token", F.min("token").over(together).alias("bundle"),
                           F.when(F.col("verdict") == F.col("other"), F.col("verdict")).alias("verdict"),
                           (F.col("n") / total).alias("support"))


def mine_rules(labelled: DataFrame, min_support: float = MIN_SUPPORT,
               min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """rule_id, antecedent, members, verdict, confidence and support from rows of tokens and verdict.

    An antecedent is a list of bundles; the entry of ``members`` at the same place lists the bundle's tokens, any of
    which stands for it, since all have the same rows. A rule goes if a part of its antecedent already gives the same
    verdict with at least its confidence. So a token whose rows all have one verdict is a rule alone and takes part in
    no other, and FP-growth combines the bundles of the rest. The number of rules is bounded by the support, not by
    the number of rows.
    """
    known = materialise(token_bundles(labelled, min_support), "url_bundles")
    members = known.groupBy("bundle").agg(
        F.sort_array(F.collect_list("token")).alias("tokens"), F.first("verdict").alias("verdict"),
        F.first("support").alias("support"))
    alone = members.where("verdict IS NOT NULL").select(
        F.array("bundle").alias("antecedent"), "verdict", F.lit(1.0).alias("confidence"), "support")

    mixed = known.where("verdict IS NULL AND token = bundle").select("token")
    basket = F.to_json("tokens").alias("basket")
    lists = labelled.select("tokens", basket).distinct().select("basket", F.explode("tokens").alias("token"))
    lists = lists.join(mixed, "token").groupBy("basket").agg(F.collect_list("token").alias("bundles"))
    label = F.array(F.concat(F.lit(LABEL), F.col("verdict")))
    items = labelled.select("verdict", basket).join(lists, "basket", "left").select(
        F.concat(F.coalesce("bundles", F.array().cast("array<string>")), label).alias("items"))
    model = FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=min_confidence).fit(items)
    found = model.associationRules.where(F.col("consequent")[0].startswith(LABEL)).select(
        F.sort_array("antecedent").alias("antecedent"),
        F.expr(f"substring(consequent[0], {len(LABEL) + 1})").alias("verdict"), "confidence", "support")
    named = found.withColumn("rule_id", F.concat_ws(" & ", "antecedent"))
    posted = named.select("*", F.explode("antecedent").alias("token"))
    # Shorter rules are found through their tokens: all of a shorter antecedent must be hit by the longer one.
    pairs = posted.alias("l").join(posted.alias("s"), F.expr(
        "l.token = s.token AND l.verdict = s.verdict AND size(s.antecedent) < size(l.antecedent)"
        " AND s.confidence >= l.confidence"))
    covered = pairs.groupBy("l.rule_id", "s.rule_id", F.col("l.verdict").alias("verdict")).agg(
        F.count(F.lit(1)).alias("hits"), F.first(F.size("s.antecedent")).alias("need"))
    covered = covered.where("hits = need").select(F.col("l.rule_id").alias("rule_id"), "verdict").distinct()
    kept = named.join(covered, ["rule_id", "verdict"], "left_anti").select(*alone.columns).unionByName(alone)

    kept = kept.withColumn("rule_id", F.concat_ws(" & ", "antecedent"))
    slots = kept.select("rule_id", "verdict", F.posexplode("antecedent").alias("slot", "bundle"))
    slots = slots.join(members.select("bundle", "tokens"), "bundle").groupBy("rule_id", "verdict").agg(
        F.sort_array(F.collect_list(F.struct("slot", "tokens"))).alias("slots"))
    return kept.join(slots, ["rule_id", "verdict"]).select(
        "rule_id", "antecedent", F.col("slots.tokens").alias("members"), "verdict", "confidence", "support")


def match_rules(baskets: DataFrame, rules: DataFrame) -> DataFrame:
    """The mined verdict of every distinct token list that a rule matches: basket, mined_verdict, mined_rule.

    The inverted index maps a token to the rules that need its bundle; a rule matches when all its bundles were hit,
    and is named by the first token that hit each. Of several the most confident wins, then the best supported, the
    longest, block, and the first by name.
    """
    index = rules.select("rule_id", "verdict", "confidence", "support", F.size("members").alias("need"),
                         F.posexplode("members").alias("slot", "tokens")).withColumn("token", F.explode("tokens"))
    distinct = baskets.groupBy("basket").agg(F.first("tokens").alias("tokens"))
    hits = distinct.select("basket", F.explode("tokens").alias("token")).join(index.drop("tokens"), "token")
    rule = ["basket", "rule_id", "verdict", "confidence", "support", "need"]
    full = hits.groupBy(*rule, "slot").agg(F.min("token").alias("token")).groupBy(*rule).agg(
        F.sort_array(F.collect_list("token")).alias("hit")).where(F.size("hit") == F.col("need"))
    best = F.min(F.struct(-F.col("confidence"), -F.col("support"), -F.col("need"),
                          F.when(F.col("verdict") == "block", 0).otherwise(1), F.concat_ws(" & ", "hit").alias("name"),
                          "verdict"))
    return full.groupBy("basket").agg(best.alias("best")).select(
        "basket", F.col("best.verdict").alias("mined_verdict"), F.col("best.name").alias("mined_rule"))


def judge_urls(pages: DataFrame, rules: tuple = RULES, min_support: float = MIN_SUPPORT,
               min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """page_id, host, path, rule, verdict and mined_rule of every row.

    The fixed rules give verdicts, which label their URLs; FP-growth mines token combinations that imply a verdict
    from all labelled URLs, and the URLs without a fixed rule take the verdict of the best mined rule, else allow.
    Null URLs and those without ``://`` have an empty host and path and are allowed. Rows are judged by their URL
    alone, so repeated rows agree; an empty table gives an empty result; further columns are not read. Equal token
    lists are matched once, so a host with most rows is one group of one row.
    """
    host, path = url_parts(F.col("url"))
    parts = pages.select("page_id", "url", host.alias("host"), path.alias("path"))
    rule, verdict = fixed_rule(F.col("host"), F.col("path"), rules)
    judged = parts.select("page_id", "host", "path", rule.alias("rule"), verdict.alias("fixed"),
                          url_tokens(F.col("url"), F.col("host"), F.col("path")).alias("tokens"))
    judged = judged.withColumn("basket", F.to_json("tokens"))
    labelled = judged.where("fixed IS NOT NULL").select("tokens", F.col("fixed").alias("verdict"))
    mined = mine_rules(labelled, min_support, min_confidence)
    matched = match_rules(judged.where("fixed IS NULL"), mined)
    joined = judged.join(matched, "basket", "left")
    return joined.select(
        "page_id", "host", "path", "rule", F.coalesce("fixed", "mined_verdict", F.lit("allow")).alias("verdict"),
        F.when(F.col("fixed").isNull(), F.col("mined_rule")).alias("mined_rule"))
