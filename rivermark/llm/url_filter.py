"""URL filter: rules by host and path, gradient-boosted trees for the rest.

Features are lexical: lengths, depth, share of digits, entropy, parameters, and
smoothed statistics of the host's suffixes among labelled URLs. Everything is column
expressions, aggregates and joins; the trees are Spark's own.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import UPPER, stored

# (verdict, host and path prefix); fixed values.
RULES = (
    ("block", "net/"),
    ("allow", "example.net/en/"),
    ("block", "example.com/de/"),
    ("allow", "org/fr/"),
)
FEATURES = (
    "url_length",
    "host_length",
    "path_length",
    "depth",
    "labels",
    "digits",
    "hyphens",
    "entropy",
    "parameters",
    "fragment",
    "suffix1_rate",
    "suffix1_log",
    "suffix2_rate",
    "suffix2_log",
)
# Labelled URLs that the trees are trained on at most, the smallest by hash.
TRAINING_ROWS = 50_000


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lowered) and path; both empty without ``://``."""
    known = url.contains("://")
    rest = F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1)
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return (
        F.when(known, F.translate(host, UPPER, UPPER.lower())).otherwise(""),
        F.when(known, path).otherwise(""),
    )


def matching_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict; NULL where none does.

    A rule fits its host and all subdomains if the path starts with the rule's. Of
    rules of one length the first listed wins.
    """
    rule = verdict = F.lit(None).cast("string")
    for name, text in sorted(rules, key=lambda r: len(r[1])):
        rule_host, slash, rule_path = text.partition("/")
        fits = ((host == rule_host) | host.endswith(f".{rule_host}")) & path.startswith(slash + rule_path)
        longer = fits & (rule.isNull() | (F.length(rule) < len(text)))
        rule, verdict = F.when(longer, text).otherwise(rule), F.when(longer, name).otherwise(verdict)
    return rule, verdict


def _entropy(text: Column) -> Column:
    """Bits per character."""
    letters = F.split(text, "")
    n = F.length(text)
    counted = F.transform(
        F.array_distinct(letters),
        lambda x: F.size(F.filter(letters, lambda y: y == x)).cast("double"),
    )
    bits = F.aggregate(counted, F.lit(0.0), lambda s, c: s + c * F.log2(c))
    return F.when(n > 0, F.log2(n.cast("double")) - bits / n).otherwise(0.0)


def _count(text: Column, mark: str) -> Column:
    return (F.length(text) - F.length(F.replace(text, F.lit(mark), F.lit("")))).cast("double")


def with_lexical(urls: DataFrame) -> DataFrame:
    """Add the features that need the URL alone to ``url, host, path``."""
    n = F.greatest(F.length("url"), F.lit(1))
    return urls.select(
        "*",
        F.length("url").cast("double").alias("url_length"),
        F.length("host").cast("double").alias("host_length"),
        F.length("path").cast("double").alias("path_length"),
        _count(F.col("path"), "/").alias("depth"),
        (_count(F.col("host"), ".") + 1).alias("labels"),
        (F.length("url") - F.length(F.regexp_replace("url", "[0-9]", ""))).cast("double").alias("_digits"),
        _count(F.col("host"), "-").alias("hyphens"),
        _entropy(F.col("url")).alias("entropy"),
        _count(F.col("url"), "=").alias("parameters"),
        F.col("url").contains("#").cast("double").alias("fragment"),
        F.substring_index("host", ".", -1).alias("suffix1"),
        F.substring_index("host", ".", -2).alias("suffix2"),
    ).withColumn("digits", F.col("_digits") / n).drop("_digits")


def _with_suffix_statistics(rows: DataFrame, labelled: DataFrame) -> DataFrame:
    """Add the share of blocked URLs of each suffix among the labelled, and its size."""
    for suffix in ("suffix1", "suffix2"):
        numbers = stored(
            labelled.groupBy(suffix).agg(
                ((F.sum("label") + 1) / (F.count(F.lit(1)) + 2)).alias(f"{suffix}_rate"),
                F.log1p(F.count(F.lit(1)).cast("double")).alias(f"{suffix}_log"),
            ),
            "url-suffixes",
        )
        rows = rows.join(numbers, suffix, "left").fillna({f"{suffix}_rate": 0.5, f"{suffix}_log": 0.0})
    return rows


def train(rows: DataFrame, *, rounds: int, depth: int, seed: int) -> GBTClassificationModel | None:
    """Trees from rows with the features and ``label``; None unless both labels occur."""
    if rows.agg(F.count_distinct("label")).first()[0] < 2:
        return None
    packed = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(rows)
    trees = GBTClassifier(
        maxIter=rounds, maxDepth=depth, maxBins=32, stepSize=0.3, seed=seed, featuresCol="features", labelCol="label"
    )
    return trees.fit(packed.select("features", "label"))


def judge_urls(
    pages: DataFrame,
    *,
    page_id: str = "page_id",
    url: str = "url",
    rules: Sequence[tuple[str, str]] = RULES,
    labelled: DataFrame | None = None,
    training_rows: int = TRAINING_ROWS,
    rounds: int = 10,
    depth: int = 4,
    seed: int = 7,
) -> DataFrame:
    """Verdict of every URL.

    Returns ``page_id, host, path, rule, verdict, score``: the fitting rule decides;
    where none fits, the trees' probability of ``block`` (``score``) does, at 0.5.

    ``labelled`` has ``url`` and ``label`` (1: block); without it the URLs that a rule
    decides are the labelled ones. Suffix statistics cover all of them, trees learn from
    the ``training_rows`` of smallest hash. Rules are a short configured list.

    A NULL URL is empty: no host, no path, judged by the trees. With no or one kind of
    label every score is that label's (0.0, allow, without any). Repeated rows are
    judged alike, empty tables give no rows, other columns are ignored.
    """
    host, path = split_url(F.col("url"))
    base = (
        pages.select(F.col(page_id).alias("page_id"), F.coalesce(F.col(url), F.lit("")).alias("url"))
        .withColumn("host", host)
        .withColumn("path", path)
    )
    rule, verdict = matching_rule(F.col("host"), F.col("path"), rules)
    rows = stored(with_lexical(base.withColumn("rule", rule).withColumn("by_rule", verdict)), "url-features")
    if labelled is None:
        known = rows.filter("rule IS NOT NULL").withColumn("label", (F.col("by_rule") == "block").cast("double"))
    else:
        given = labelled.filter("label IS NOT NULL").select(
            F.coalesce("url", F.lit("")).alias("url"), F.col("label").cast("double").alias("label")
        )
        known = with_lexical(given.withColumn("host", host).withColumn("path", path))
    chosen = known.orderBy(F.xxhash64("url", F.lit(seed)), "url", "label").limit(training_rows)
    model = train(
        stored(_with_suffix_statistics(chosen, known), "url-training"), rounds=rounds, depth=depth, seed=seed
    )
    if model is None:
        only = known.agg(F.max("label")).first()[0] or 0.0
        scored = rows.withColumn("score", F.lit(float(only)))
    else:
        packed = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(
            _with_suffix_statistics(rows, known)
        )
        scored = model.transform(packed).withColumn("score", vector_to_array("probability")[1])
    return scored.select(
        "page_id",
        "host",
        "path",
        "rule",
        F.coalesce("by_rule", F.when(F.col("score") >= 0.5, "block").otherwise("allow")).alias("verdict"),
        "score",
    )
