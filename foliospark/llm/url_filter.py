"""URL verdicts: explicit rules first, else logistic regression on hashed character n-grams.

A rule is a host and a path prefix; it holds for the host and all its subdomains, and the longest rule
that fits wins. URLs without a rule are judged by a logistic regression over hashed character n-grams
of host and path, fitted on a small labelled table of at most ``MAX_TRAINING_URLS`` distinct URLs (those
with the smallest hashes, so the choice repeats).

A null URL or one without ``://`` has an empty host and path and is judged by the model. A labelled
table with one class gives that class, an empty one ``allow``. Repeated rows each get their verdict;
input columns are kept, those named like a result are replaced. An empty table gives an empty result.
"""

from __future__ import annotations

import string
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.generate import let

MAX_TRAINING_URLS = 20_000
FEATURES = 1 << 14
GRAM = 3


@dataclass(frozen=True)
class UrlRule:
    rule: str  # host/path prefix
    verdict: str

    @property
    def host(self) -> str:
        return self.rule.partition("/")[0]

    @property
    def path(self) -> str:
        return "/" + self.rule.partition("/")[2]


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL; empty when it has none."""
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), r"^[^?#]*", 0)
    return F.coalesce(F.translate(host, string.ascii_uppercase, string.ascii_lowercase), F.lit("")), F.coalesce(path, F.lit(""))


def matching_rule(host: Column, path: Column, rules: list[UrlRule]) -> Column:
    """(rule, verdict) of the longest rule that fits, null without one."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for r in sorted(rules, key=lambda r: len(r.rule)):
        fits = ((host == r.host) | F.endswith(host, F.lit("." + r.host))) & F.startswith(path, F.lit(r.path))
        found = F.when(fits, F.struct(F.lit(r.rule).alias("rule"), F.lit(r.verdict).alias("verdict"))).otherwise(found)
    return found


def grams(text: Column, mark: str, width: int = GRAM) -> Column:
    """Character n-grams with edge marks, each preceded by ``mark``."""
    chars = F.split(F.concat(F.lit("^"), text, F.lit("$")), "")
    return let(chars, lambda c: F.transform(
        F.sequence(F.lit(0), F.greatest(F.size(c) - width, F.lit(0))),
        lambda i: F.concat(F.lit(mark), *[F.coalesce(F.get(c, i + k), F.lit("")) for k in range(width)])))


def with_features(urls: DataFrame) -> DataFrame:
    """Hashed n-gram counts of ``_host`` and ``_path`` in ``_features``."""
    listed = urls.withColumn("_grams", F.concat(grams(F.col("_host"), "h"), grams(F.col("_path"), "p")))
    return HashingTF(numFeatures=FEATURES, inputCol="_grams", outputCol="_features").transform(listed).drop("_grams")


def fit_url_model(labelled: DataFrame, limit: int = MAX_TRAINING_URLS) -> LogisticRegressionModel | str:
    """Model from (url, verdict) rows, or the only verdict there is."""
    host, path = url_parts(F.col("url"))
    parts = labelled.where(F.col("verdict").isin("allow", "block")).select(host.alias("_host"), path.alias("_path"), "verdict")
    sample = (parts.distinct().orderBy(F.xxhash64("_host", "_path", "verdict"), "_host", "_path", "verdict").limit(limit))
    known = [r.verdict for r in sample.select("verdict").distinct().collect()]  # two values at most
    if len(known) < 2:
        return known[0] if known else "allow"
    rows = with_features(sample).withColumn("_label", (F.col("verdict") == "block").cast("double"))
    return LogisticRegression(featuresCol="_features", labelCol="_label", predictionCol="_predicted", maxIter=50, regParam=1e-3,
                              rawPredictionCol="_raw", probabilityCol="_probability").fit(rows.coalesce(1))  # at most ``limit`` rows


def judge_urls(pages: DataFrame, rules: list[UrlRule], model: LogisticRegressionModel | str, url_col: str = "url") -> DataFrame:
    """Adds host, path, rule and verdict."""
    kept = [c for c in pages.columns if c not in ("host", "path", "rule", "verdict")]
    host, path = url_parts(F.col(url_col))
    rows = pages.select(F.struct(*kept).alias("_row"), host.alias("_host"), path.alias("_path"))
    rows = rows.withColumn("_rule", matching_rule(F.col("_host"), F.col("_path"), rules))
    if isinstance(model, str):
        guess = F.lit(model)
    else:
        rows = model.transform(with_features(rows))
        guess = F.when(F.col("_predicted") == 1.0, "block").otherwise("allow")
    return rows.select("_row.*", F.col("_host").alias("host"), F.col("_path").alias("path"), F.col("_rule.rule").alias("rule"),
                       F.coalesce("_rule.verdict", guess).alias("verdict"))


def labelled_by_rules(pages: DataFrame, rules: list[UrlRule], url_col: str = "url") -> DataFrame:
    """(url, verdict) of the pages that a rule decides."""
    host, path = url_parts(F.col(url_col))
    rows = pages.select(F.col(url_col).alias("url"), matching_rule(host, path, rules).alias("_rule"))
    return rows.where(F.col("_rule").isNotNull()).select("url", "_rule.verdict")
