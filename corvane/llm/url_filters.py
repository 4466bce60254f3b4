"""URL filters: a list of host and path rules, and token combinations mined by FP-growth from labelled URLs."""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corvane.llm.common import lower_az, require

#: (rule, verdict): a host, then a path that begins with a slash.
RULES = (("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"), ("net/es/", "block"), ("net/fr/", "block"))
MIN_SUPPORT = 0.01
MIN_CONFIDENCE = 0.8
MOST_TOKENS = 3
DEFAULT = "allow"
_VERDICTS = ("allow", "block")


def host(url: Column) -> Column:
    """From after the first :// to a slash, question mark, hash or the end, A-Z lower-cased; null or none: empty."""
    return lower_az(F.coalesce(F.regexp_extract(url, r"(?s)\A.*?://([^/?#]*)", 1), F.lit("")))


def path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)\A.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def list_rule(host: Column, path: Column, rules=RULES) -> Column:
    """The longest rule that fits (the first by code point among equals), or null. The list is an argument, so it is small."""
    found = F.lit(None).cast("string")
    for rule, _ in sorted(rules, key=lambda r: (len(r[0]), [-ord(c) for c in r[0]])):
        name, slash, rest = rule.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(slash + rest)
        found = F.when(fits, F.lit(rule)).otherwise(found)
    return found


def tokens(url: Column) -> Column:
    """Distinct tokens of a URL: host labels, path segments with digits folded, names of query fields."""
    labels = F.transform(F.split(host(url), r"\."), lambda x: F.concat(F.lit("host="), x))
    segments = F.filter(F.split(F.regexp_replace(lower_az(path(url)), "[0-9]+", "0"), "/"), lambda x: x != "")
    query = F.coalesce(F.regexp_extract(url, r"\?([^#]*)", 1), F.lit(""))
    fields = F.filter(F.transform(F.split(query, "&"), lambda x: F.regexp_extract(x, "^[^=]*", 0)), lambda x: x != "")
    found = F.concat(
        F.filter(labels, lambda x: x != "host="),
        F.transform(segments, lambda x: F.concat(F.lit("path="), x)),
        F.transform(fields, lambda x: F.concat(F.lit("field="), x)),
    )
    return F.array_sort(F.array_distinct(found))


def mine(
    labelled: DataFrame, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE, most_tokens: int = MOST_TOKENS
) -> DataFrame:
    """(tokens, verdict) of labelled URLs to rules: antecedent, verdict, confidence, support.

    FP-growth counts combinations of tokens and verdict in at least `min_support` of the rows. Kept: rules
    from at most `most_tokens` tokens to a verdict, of at least `min_confidence`, for which no rule with
    fewer of the tokens has the same verdict and at least the confidence. Rows without verdict or tokens
    teach nothing; no rows, no rules.
    """
    spark = labelled.sparkSession
    rows = labelled.where(F.col("verdict").isin(*_VERDICTS) & (F.size("tokens") > 0))
    rows = rows.select(F.array_append("tokens", F.concat(F.lit("verdict="), "verdict")).alias("items"))
    schema = "antecedent array<string>, verdict string, confidence double, support double"
    if rows.isEmpty():
        return spark.createDataFrame([], schema)
    model = FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=min_confidence).fit(rows)
    verdict = F.regexp_extract(F.element_at("consequent", 1), "^verdict=(.*)", 1)
    rules = model.associationRules.select(F.array_sort("antecedent").alias("antecedent"), verdict.alias("verdict"), "confidence", "support")
    rules = rules.where((F.col("verdict") != "") & (F.size("antecedent") <= most_tokens))
    rules = rules.where(~F.exists("antecedent", lambda x: x.startswith("verdict=")))
    # A rule is redundant if leaving out some of its tokens loses no confidence.
    smaller = rules.select(F.explode("antecedent").alias("token"), F.col("antecedent").alias("less"), "verdict", F.col("confidence").alias("sure"))
    pairs = rules.select(F.explode("antecedent").alias("token"), "antecedent", "verdict", "confidence").join(smaller, ["token", "verdict"])
    inside = (F.size("less") < F.size("antecedent")) & (F.size(F.array_except("less", "antecedent")) == 0)
    redundant = pairs.where(inside & (F.col("sure") >= F.col("confidence"))).select("antecedent", "verdict").distinct()
    return rules.join(redundant, ["antecedent", "verdict"], "left_anti")


def match(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """(tokens) to tokens, verdict of the best rule that they hold; only where one does.

    An inverted index lists each rule under its rarest token, so a URL meets a rule once at most. Best:
    highest confidence, then support, then fewest tokens, then by code point. Equal token sets are looked up once.
    """
    seen = rules.select("antecedent", F.explode("antecedent").alias("token"))
    often = seen.groupBy("token").agg(F.count("*").alias("rules"))
    rarest = seen.join(often, "token").groupBy("antecedent").agg(F.min(F.struct("rules", "token"))["token"].alias("token"))
    index = rules.join(rarest, "antecedent")
    sets = urls.select("tokens").where(F.size("tokens") > 0).distinct()
    met = sets.withColumn("token", F.explode("tokens")).join(index, "token")
    held = met.where(F.size(F.array_except("antecedent", "tokens")) == 0)
    rank = F.struct(-F.col("confidence"), -F.col("support"), F.size("antecedent"), "antecedent", "verdict")
    return held.groupBy("tokens").agg(F.min_by("verdict", rank).alias("mined"))


def judge(
    pages: DataFrame, rules=RULES, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE,
    most_tokens: int = MOST_TOKENS, default: str = DEFAULT, labelled: DataFrame | None = None,
) -> DataFrame:
    """Verdicts on every URL of pages (page_id, url).

    A URL that a rule of the list fits gets the longest such rule's verdict. These URLs are also the
    labelled ones from which combinations are mined, unless `labelled` (tokens, verdict) is given; the
    mined rules judge the rest, and `default` what no mined rule holds.

    Null url or one without ://: empty host and path, no tokens, `default`. Null or repeated page_id and
    repeated urls: each row is judged. Extra columns are left aside. No pages: no rows.
    Returns page_id, host, path, rule, verdict.
    """
    verdicts = F.create_map(*[F.lit(x) for pair in rules for x in pair]) if rules else F.lit(None).cast("map<string,string>")
    read = require(pages, "page_id", "url")
    parsed = read.select("page_id", host(F.col("url")).alias("host"), path(F.col("url")).alias("path"), tokens(F.col("url")).alias("tokens"))
    listed = parsed.withColumn("rule", list_rule(F.col("host"), F.col("path"), rules))
    listed = listed.withColumn("listed", verdicts[F.col("rule")])
    mined = mine(labelled if labelled is not None else listed.select("tokens", F.col("listed").alias("verdict")), min_support, min_confidence, most_tokens)
    found = match(listed.where("rule is null"), mined)
    open_, done = listed.where("rule is null"), listed.where("rule is not null")
    judged = open_.join(found, "tokens", "left").withColumn("verdict", F.coalesce("mined", F.lit(default)))
    names = ["page_id", "host", "path", "rule", "verdict"]
    return done.withColumn("verdict", F.col("listed")).select(*names).unionByName(judged.select(*names))
