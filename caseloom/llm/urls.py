"""URL verdicts by rules, and by boosted trees over lexical features where no rule speaks.

Method.  The longest rule that fits a URL's host and path decides.  URLs that
rules decide are the labelled ones: gradient-boosted trees learn their verdicts
from lexical features (lengths, depth, share of digits, entropy of the
characters, parameters) and from statistics of host suffixes over all labelled
URLs, smoothed by how often a suffix was seen.  The trees decide the rest.

A label comes from host suffix and path start, which the features only see
through counts; the suffix statistics leave each training URL's own label out.
"""

from __future__ import annotations

import math

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseloom.operators.joins import join_lookup
from caseloom.session import materialize

MAX_TRAINING_ROWS = 20_000  # different labelled URLs the trees see at most, about; picked by hash of the URL
TREES, DEPTH, SMOOTHING = 15, 4, 5.0
MAX_BROADCAST_SUFFIXES = 50_000

#: (rule, verdict); a rule is host, slash, rest of the path's start.
RULES = (("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"), ("net/es/", "block"), ("net/fr/", "block"))

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(url, r"^(?s:.*?)://([^/?#]*)", 1), _UPPER, _LOWER), F.lit(""))


def path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"^(?s:.*?)://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host_: Column, path_: Column, rules=RULES) -> Column:
    """The longest rule that fits, as a struct (rule, verdict); null if none does."""
    chosen = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule, verdict in sorted(rules, key=lambda r: (len(r[0]), r[0])):
        name, _, start = rule.partition("/")
        fits = ((host_ == name) | host_.endswith(f".{name}")) & path_.startswith(f"/{start}")
        chosen = F.when(fits, F.struct(F.lit(rule), F.lit(verdict)).cast("struct<rule:string,verdict:string>")).otherwise(chosen)
    return chosen


def _entropy(s: Column) -> Column:
    """Bits per character of the characters' own distribution."""
    chars = F.array_sort(F.filter(F.split(s, ""), lambda c: c != ""))
    n = F.size(chars)
    counts = F.transform(F.array_distinct(chars), lambda c: F.size(F.filter(chars, lambda x: x == c)) / n)
    return F.when(n > 0, F.aggregate(counts, F.lit(0.0), lambda a, p: a - p * F.log2(p))).otherwise(0.0)


def lexical(url: Column, host_: Column, path_: Column) -> Column:
    """Numbers that describe how a URL is written."""
    count = lambda s, kept: F.length(F.regexp_replace(s, f"[^{kept}]", ""))
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    length = F.greatest(F.length(url), F.lit(1))
    parts = [F.length(url), F.length(host_), F.length(path_), count(host_, "."), count(path_, "/"), count(url, "0-9") / length,
             count(path_, "0-9"), count(url, r"\-_"), _entropy(host_), _entropy(path_), F.length(query),
             F.when(query == "", 0).otherwise(count(query, "&") + 1), F.contains(url, F.lit("#")), F.startswith(url, F.lit("https")),
             F.endswith(path_, F.lit("/")), path_.rlike(r"\.[A-Za-z]+$")]
    return F.array(*[F.coalesce(p.cast("double"), F.lit(0.0)) for p in parts])


def suffix(host_: Column) -> Column:
    """Last two labels of the host."""
    return F.substring_index(host_, ".", -2)


def _suffix_rates(judged: DataFrame) -> tuple[DataFrame, float]:
    """(suffix, blocked, seen) over all labelled URLs, and the share of blocked ones."""
    stats = materialize(judged.where("label is not null").groupBy("suffix").agg(F.sum("label").alias("blocked"), F.count("*").alias("seen")), "suffixes")
    sums = stats.agg(F.sum("blocked"), F.sum("seen")).first()
    return stats, (sums[0] / sums[1] if sums[1] else 0.0)


def training_urls(described: DataFrame, max_rows: int, n_urls: int) -> DataFrame:
    """About max_rows labelled URLs at most, each once; n_urls: how many different ones there are, about.

    A URL's rows are alike in label and features, so a frequent one is a single row of the sample.
    """
    sample = described.where("label is not null")
    if n_urls > max_rows:
        sample = sample.where(F.pmod(F.xxhash64("url"), F.lit(1_000_000)) < math.ceil(1e6 * max_rows / n_urls))
    return sample.dropDuplicates(["url"])


def judge(pages: DataFrame, rules=RULES, max_rows: int = MAX_TRAINING_ROWS) -> DataFrame:
    """(page_id, url, host, path, rule, verdict, blocked): blocked is the trees' probability, null where a rule decides.

    A null URL or one without :// has an empty host and path, no rule, and the
    verdict of the trees for it; repeated rows are judged alike.  Where rules
    label no URL, or all alike, the rest gets that verdict, or allow.
    """
    read = pages.select("page_id", "url").withColumns({"host": host(F.col("url")), "path": path(F.col("url"))})
    ruled = read.withColumn("by", rule_of(F.col("host"), F.col("path"), rules))
    judged = materialize(ruled.select("page_id", "url", "host", "path", F.col("by.rule").alias("rule"), F.col("by.verdict").alias("given"),
                                      (F.col("by.verdict") == "block").cast("double").alias("label"), suffix(F.col("host")).alias("suffix")), "ruled")
    stats, share = _suffix_rates(judged)
    small = stats.count() <= MAX_BROADCAST_SUFFIXES
    known = judged.join(F.broadcast(stats), "suffix", "left") if small else join_lookup(judged, stats, "suffix")
    own, one = F.coalesce("label", F.lit(0.0)), F.when(F.col("label").isNotNull(), 1).otherwise(0)
    seen = F.coalesce("seen", F.lit(0)) - one
    rate = (F.coalesce("blocked", F.lit(0.0)) - own + SMOOTHING * share) / (seen + SMOOTHING)
    url = F.coalesce("url", F.lit(""))
    described = known.withColumn("x", F.concat(lexical(url, F.col("host"), F.col("path")), F.array(rate, F.log1p(seen.cast("double")))))
    labelled = F.when(F.col("label").isNotNull(), F.col("url"))
    n, n_blocked, n_urls = judged.agg(F.count("label"), F.coalesce(F.sum("label"), F.lit(0.0)), F.approx_count_distinct(labelled)).first()
    if not 0 < n_blocked < n:
        verdict = F.coalesce("given", F.lit("block" if n and n_blocked == n else "allow"))
        return known.select("page_id", "url", "host", "path", "rule", verdict.alias("verdict"), F.lit(None).cast("double").alias("blocked"))
    train = materialize(training_urls(described, max_rows, n_urls).select("label", "x"), "urls").select("label", array_to_vector("x").alias("features"))
    model = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, seed=11).fit(train)
    scored = model.transform(described.withColumn("features", array_to_vector("x")))
    blocked = vector_to_array("probability")[1]
    verdict = F.coalesce("given", F.when(blocked >= 0.5, "block").otherwise("allow"))
    return scored.select("page_id", "url", "host", "path", "rule", verdict.alias("verdict"), F.when(F.col("given").isNull(), blocked).alias("blocked"))
