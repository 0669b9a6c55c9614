"""URL filter: rules by host and path, and gradient-boosted trees on lexical features for the rest.

Features of a URL are SQL expressions: lengths, path depth, digit ratio, character entropy, parameter
counts, and the smoothed share of blocked URLs among the labelled ones with the same host suffix. The
trees are Spark ML's; scoring stays in the JVM.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import stage

#: (verdict, host, path) in the form of the query's contract.
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))

#: At most so many labelled URLs train the trees, the first by a hash of the URL.
TRAINING_ROWS = 20_000
TREES, DEPTH = 12, 4
#: Labelled URLs of a suffix count beside so many of the overall share.
SMOOTHING = 20.0
#: Without a rule, a URL is blocked from this probability on: trees alone must be nearly sure.
BLOCK_FROM = 0.9
FEATURES = ("url_len", "host_len", "path_len", "depth", "labels", "digit_ratio", "entropy", "params", "query_len",
            "hyphens", "longest_label", "suffix_rate")


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty without '://'."""
    text = F.coalesce(url, F.lit(""))
    at = F.instr(text, "://")
    rest = F.when(at > 0, F.substring(text, at + 3, F.length(text))).otherwise("")
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), r"^([^?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), path


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """Rule text and verdict of the longest rule that fits; null where none does."""
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for v, h, p in sorted(rules, key=lambda r: (len(r[1] + r[2]), r)):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        text, verdict = F.when(fits, h + p).otherwise(text), F.when(fits, v).otherwise(verdict)
    return text, verdict


def _entropy(text: Column) -> Column:
    """Bits a character, over the counts of each distinct character."""
    chars = F.split(text, "")
    n = F.greatest(F.length(text), F.lit(1)).cast("double")
    return F.aggregate(F.array_distinct(chars), F.lit(0.0), lambda total, c: total - F.when(F.length(c) == 0, 0.0).otherwise(
        ((F.length(text) - F.length(F.replace(text, c, F.lit("")))) / n) * F.log2((F.length(text) - F.length(F.replace(text, c, F.lit("")))) / n)))


def with_features(urls: DataFrame) -> DataFrame:
    """The lexical columns of (url, host, path); url is not null."""
    url, host, path = F.col("url"), F.col("host"), F.col("path")
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    return urls.select(
        "*", F.length(url).cast("double").alias("url_len"), F.length(host).cast("double").alias("host_len"),
        F.length(path).cast("double").alias("path_len"),
        F.size(F.filter(F.split(path, "/"), lambda x: x != "")).cast("double").alias("depth"),
        F.size(F.split(host, r"\.")).cast("double").alias("labels"),
        (F.length(F.regexp_replace(url, "[^0-9]", "")) / F.greatest(F.length(url), F.lit(1))).alias("digit_ratio"),
        _entropy(url).alias("entropy"),
        F.size(F.filter(F.split(query, "&"), lambda x: x != "")).cast("double").alias("params"),
        F.length(query).cast("double").alias("query_len"),
        (F.length(host) - F.length(F.replace(host, F.lit("-"), F.lit("")))).cast("double").alias("hyphens"),
        F.array_max(F.transform(F.split(host, r"\."), F.length)).cast("double").alias("longest_label"),
        F.regexp_extract(host, r"([^.]*\.[^.]*|[^.]*)$", 1).alias("suffix"))


class UrlModel:
    """Suffix statistics and trees trained from labelled URLs: a table (url, blocked 0.0 or 1.0)."""

    def __init__(self, labelled: DataFrame):
        host, path = host_and_path(F.col("url"))
        labelled = with_features(labelled.where("url is not null and blocked is not null").select(
            "url", F.col("blocked").cast("double").alias("blocked")).withColumns({"host": host, "path": path}))
        seen = labelled.agg(F.count("*").alias("n"), F.avg("blocked").alias("share"), F.min("blocked").alias("lo"),
                            F.max("blocked").alias("hi")).first()
        self.share = seen.share if seen.n else 0.0
        self.suffixes = stage(labelled.groupBy("suffix").agg(
            ((F.sum("blocked") + SMOOTHING * self.share) / (F.count("*") + SMOOTHING)).alias("suffix_rate")), "suffixes")
        self.trees = None
        if seen.n and seen.lo < seen.hi:
            sample = stage(labelled.orderBy(F.xxhash64("url"), "url").limit(TRAINING_ROWS).coalesce(1), "urls")
            self.trees = GBTClassifier(labelCol="blocked", maxIter=TREES, maxDepth=DEPTH, seed=7, stepSize=0.3,
                                       subsamplingRate=1.0).fit(self._vectors(sample))

    def _vectors(self, urls: DataFrame) -> DataFrame:
        urls = urls.join(self.suffixes, "suffix", "left").fillna({"suffix_rate": self.share})
        return VectorAssembler(inputCols=list(FEATURES), outputCol="features", handleInvalid="keep").transform(urls)

    def score(self, urls: DataFrame) -> DataFrame:
        """Adds score, the probability of blocking, to (url, host, path, ...); without both classes among
        the labelled URLs it is their share of blocked ones."""
        vectors = self._vectors(with_features(urls))
        if self.trees is None:
            return vectors.withColumn("score", F.lit(float(self.share)))
        return self.trees.transform(vectors).withColumn("score", vector_to_array("probability")[1])


def judge(pages: DataFrame, labelled: DataFrame | None = None, id_col: str = "page_id", url_col: str = "url",
          rules=RULES) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict, score.

    Without labelled URLs, those that a rule decides are the labelled ones. The rule's verdict holds
    where a rule fits, else the trees' (block from BLOCK_FROM on). A null url or one without '://' has empty
    host and path and is scored on them; repeated rows are judged each; an empty table gives no rows.
    """
    host, path = host_and_path(F.col("url"))
    base = pages.select(F.col(id_col).cast("long").alias("page_id"), F.coalesce(F.col(url_col).cast("string"), F.lit("")).alias("url"))
    base = base.withColumns({"host": host, "path": path})
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    base = base.withColumns({"rule": rule, "ruled": verdict})
    if labelled is None:
        labelled = base.where("ruled is not null").select("url", (F.col("ruled") == "block").cast("double").alias("blocked"))
    scored = UrlModel(labelled).score(base)
    return scored.select("page_id", "host", "path", "rule",
                         F.coalesce("ruled", F.when(F.col("score") >= BLOCK_FROM, "block").otherwise("allow")).alias("verdict"), "score")


def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's url by the contract's rules."""
    return judge(spark.read.parquet(f"{sf_dir}/pages.parquet"))
