"""URL filters: host and path rules, and boosted trees on lexical features for the rest."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recogna.functions.skew import attach
from recogna.llm.common import ascii_lower, clash_free, stored

#: Distinct labelled URLs that the trees learn from, at most; tasks that share them.
TRAINING_ROWS = 50_000
TRAINING_TASKS = 4
TREES, DEPTH = 20, 4
FEATURES = ["url_length", "host_length", "path_length", "depth", "host_labels", "digit_ratio", "hyphens", "parameters", "entropy", "last_rate", "last_two_rate"]
RESULTS = ["host", "path", "rule", "verdict"]


@dataclass(frozen=True)
class UrlRule:
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return f"{self.host}{self.path}"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://``."""
    return ascii_lower(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def matched(host: Column, path: Column, rules: list[UrlRule], value: str) -> Column:
    """``text`` or ``verdict`` of the longest rule for the host or a domain above it, by its path's beginning."""
    out = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.text), r.text)):
        fits = ((host == rule.host) | host.endswith(f".{rule.host}")) & path.startswith(rule.path)
        out = F.when(fits, F.lit(getattr(rule, value))).otherwise(out)
    return out


def with_features(pages: DataFrame) -> DataFrame:
    """Add the lexical features that need no statistics, and the host's last one and two labels."""
    url = F.coalesce("url", F.lit(""))
    labels = F.split("host", r"\.")
    chars = F.split(url, "")
    shares = F.transform(F.array_distinct(chars), lambda c: (F.length(url) - F.length(F.replace(url, c, F.lit("")))) / F.length(url))
    query = F.regexp_extract(url, r"(?s)\?([^#]*)", 1)
    return pages.withColumns({
        "url_length": F.length(url).cast("double"),
        "host_length": F.length("host").cast("double"),
        "path_length": F.length("path").cast("double"),
        "depth": F.size(F.filter(F.split("path", "/"), lambda s: s != "")).cast("double"),
        "host_labels": F.size(labels).cast("double"),
        "digit_ratio": (F.length(url) - F.length(F.translate(url, "0123456789", ""))) / F.greatest(F.length(url), F.lit(1)),
        "hyphens": (F.length(url) - F.length(F.translate(url, "-", ""))).cast("double"),
        "parameters": F.size(F.filter(F.split(query, "&"), lambda p: p != "")).cast("double"),
        "entropy": F.when(url == "", 0.0).otherwise(F.aggregate(shares, F.lit(0.0), lambda a, p: a - F.when(p > 0, p * F.log2(p)).otherwise(0.0))),
        "last": F.substring_index("host", ".", -1),
        "last_two": F.substring_index("host", ".", -2),
    })


def labelled_urls(parsed: DataFrame) -> DataFrame:
    """(url, host, path, label, copies): the distinct URLs that a rule decides; all copies of a URL have its label."""
    rows = parsed.where("rule is not null").select("url", "host", "path", (F.col("_ruled") == "block").cast("double").alias("label"))
    return stored(rows.groupBy("url", "host", "path", "label").agg(F.count("*").alias("copies")), "url-labelled")


def suffix_rates(labelled: DataFrame, suffix: str) -> DataFrame:
    """Share of blocked pages among all labelled ones of each suffix, smoothed by one of each kind."""
    pages, blocked = F.sum("copies"), F.sum(F.when(F.col("label") == 1.0, F.col("copies")).otherwise(0))
    return stored(labelled.groupBy(suffix).agg(((blocked + 1) / (pages + 2)).alias(f"{suffix}_rate")), "url-rates")


def training_sample(labelled: DataFrame, pages: dict[float, int], training_rows: int) -> DataFrame:
    """The URLs of smallest hash of each label, half of ``training_rows`` each and one at least.

    A URL weighs as many pages as it has copies, scaled so that the labels keep their shares of all labelled pages
    and weights are 1 on average.
    """
    most = max(1, training_rows // len(pages))
    parts = [labelled.where(F.col("label") == k).orderBy(F.xxhash64("url", F.lit("trees")), "url").limit(most) for k in sorted(pages)]
    sample = stored(reduce(DataFrame.unionByName, parts), "url-sample")
    drawn = {r["label"]: (r["urls"], r["pages"]) for r in sample.groupBy("label").agg(F.count("*").alias("urls"), F.sum("copies").alias("pages")).collect()}
    urls, total = sum(u for u, _ in drawn.values()), sum(pages.values())
    weight = F.lit(0.0)
    for k, n in sorted(pages.items()):
        weight = F.when(F.col("label") == k, F.col("copies") * (n / total * urls / drawn[k][1])).otherwise(weight)
    return sample.withColumn("weight", weight)


@clash_free(*FEATURES, "last", "last_two", "features", "rawPrediction", "probability", "prediction")
def judged(pages: DataFrame, rules: list[UrlRule], training_rows: int = TRAINING_ROWS) -> DataFrame:
    """All columns of ``pages``, ``host``, ``path``, ``rule`` (null without one) and ``verdict``.

    URLs that a rule decides are the labelled ones. The trees learn from at most ``training_rows`` distinct ones of
    them, chosen by a hash of the URL and weighted by their copies, and judge the others. Suffix rates count all labelled
    pages, at every size; they are joined so that a suffix with a large part of the pages can be split, and an unseen suffix
    counts as one half. With labels of one kind only, that kind is the verdict of all; without labelled URLs it is ``allow``.

    A null URL or one without ``://`` has an empty host and path, which no rule fits, and is judged by
    its features. Rows are judged one by one: repeated URLs get the same verdict. Columns of ``pages`` named
    like the results are replaced, all others come back whatever they are called.
    """
    rows = pages.drop(*RESULTS)
    parsed = rows.withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url"))})
    parsed = parsed.withColumns({"rule": matched(F.col("host"), F.col("path"), rules, "text"), "_ruled": matched(F.col("host"), F.col("path"), rules, "verdict")})
    labelled = labelled_urls(parsed)
    kinds = {r["label"]: r["pages"] for r in labelled.groupBy("label").agg(F.sum("copies").alias("pages")).collect()}  # two rows
    if len(kinds) < 2:
        only = "block" if 1.0 in kinds else "allow"
        return parsed.select(*rows.columns, "host", "path", "rule", F.coalesce("_ruled", F.lit(only)).alias("verdict"))
    rates = [suffix_rates(with_features(labelled), s) for s in ("last", "last_two")]

    def assembled(frame: DataFrame) -> DataFrame:
        for r in rates:
            frame = attach(frame, r, r.columns[:1])
        frame = frame.fillna(0.5, ["last_rate", "last_two_rate"])
        return VectorAssembler(inputCols=FEATURES, outputCol="features").transform(frame)

    sample = with_features(training_sample(labelled, kinds, training_rows))
    training = stored(assembled(sample).select("label", "weight", "features").orderBy("features", "label", "weight").coalesce(TRAINING_TASKS), "url-training")
    trees = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, seed=11, checkpointInterval=-1, weightCol="weight").fit(training.coalesce(TRAINING_TASKS))
    guessed = trees.transform(assembled(with_features(parsed)))
    verdict = F.coalesce("_ruled", F.when(F.col("prediction") == 1.0, "block").otherwise("allow"))
    return guessed.select(*rows.columns, "host", "path", "rule", verdict.alias("verdict"))
