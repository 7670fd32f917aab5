"""URL filters: rules by host and path, and gradient-boosted trees on lexical features for every other URL.

Only DataFrame functions and Spark ML run here; no Python touches a row.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stationflow.llm.common import quoted
from stationflow.storage import stage

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    """``verdict`` for a host with its subdomains, below a path: Rule("block", "example.com", "/de/")."""

    verdict: str
    host: str
    path: str = "/"

    @property
    def text(self) -> str:
        return self.host + self.path


@dataclass(frozen=True)
class Trees:
    """``train_rows`` labelled URLs, half of each label as far as there are so many, fit ``trees`` trees of ``depth`` levels.

    Rows are weighted by the share in which their label was drawn, but no label weighs less than ``least_weight`` of all.
    """

    train_rows: int = 10_000
    trees: int = 12
    depth: int = 4
    step: float = 0.2
    seed: int = 11
    block_at: float = 0.5
    least_weight: float = 0.1


def host_of(url: Column) -> Column:
    """After the first ``://`` up to a slash, question mark, hash or the end; A-Z in lower case; else empty."""
    return F.coalesce(F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host, up to a question mark, hash or the end; empty without ``://``."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: tuple[Rule, ...], give: str) -> Column:
    """``text`` or ``verdict`` of the longest rule that fits, else null. Rules are a short list, tested in order."""
    found = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.text), r.text)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        found = F.when(fits, F.lit(getattr(rule, give))).otherwise(found)
    return found


def _occurrences(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern)).cast("double")


FEATURES = (
    "length host_length path_length query_length depth labels digit_ratio host_digit_ratio entropy parameters "
    "hyphens marks suffix_pages suffix_hosts suffix_length suffix_digits suffix_depth"
).split()


def lexical(urls: DataFrame) -> DataFrame:
    """Lexical features of (url, host, path): lengths, depth, ratios, entropy of characters, parameter counts."""
    url = F.coalesce("url", F.lit(""))
    size = F.length(url)
    per_char = F.transform(
        F.array_distinct(F.split(url, "")), lambda c: (size - F.length(F.replace(url, c, F.lit("")))) / size
    )
    bits = F.aggregate(per_char, F.lit(0.0), lambda s, p: s + F.when(p > 0, -p * F.log2(p)).otherwise(0.0))
    query = F.regexp_extract(url, r"(?s)\?([^#]*)", 1)
    digits = _occurrences(url, "[0-9]")
    host_size = F.length("host")
    return urls.select(
        *urls.columns,
        size.cast("double").alias("length"),
        host_size.cast("double").alias("host_length"),
        F.length("path").cast("double").alias("path_length"),
        F.length(query).cast("double").alias("query_length"),
        _occurrences(F.col("path"), "/[^/]").alias("depth"),
        _occurrences(F.col("host"), "[^.]+").alias("labels"),
        F.coalesce(F.try_divide(digits, size), F.lit(0.0)).alias("digit_ratio"),
        F.coalesce(F.try_divide(_occurrences(F.col("host"), "[0-9]"), host_size), F.lit(0.0)).alias("host_digit_ratio"),
        F.when(size > 0, bits).otherwise(0.0).alias("entropy"),
        _occurrences(query, "[^&=]+=").alias("parameters"),
        _occurrences(F.col("host"), "-").alias("hyphens"),
        _occurrences(url, "[%@_~!*,;+]").alias("marks"),
        F.substring_index("host", ".", -2).alias("suffix"),
    )


def with_suffix_statistics(lexed: DataFrame) -> DataFrame:
    """``lexed`` with what all its URLs of the same host suffix (last two labels) have in common.

    Statistics are aggregated before the shuffle, one row per suffix; adaptive execution splits a hot suffix in
    the join back.
    """
    statistics = lexed.groupBy("suffix").agg(
        F.log1p(F.count(F.lit(1))).alias("suffix_pages"),
        F.log1p(F.approx_count_distinct("host").cast("double")).alias("suffix_hosts"),
        F.avg("length").alias("suffix_length"),
        F.avg("digit_ratio").alias("suffix_digits"),
        F.avg("depth").alias("suffix_depth"),
    )
    return lexed.join(statistics, "suffix")


def draw(rows: DataFrame, label: str, settings: Trees) -> DataFrame | None:
    """FEATURES, target and weight of the training rows, or None unless both labels (0 and 1) occur.

    Each label is drawn with its own share, so a rare one is not lost. Rows equal in every column hash alike and
    count as one row, whose weight is their number, so that many copies neither fill the sample nor are left out
    together. Only hashes and counts are shuffled to find the shares; about ``train_rows`` rows result.
    """
    found = rows.groupBy("pick", label).agg(F.count(F.lit(1)).alias("copies"))
    found = found.groupBy(label).agg(F.count(F.lit(1)).alias("n"), F.sum("copies").alias("copies")).collect()
    counted = {r[label]: (r["n"], r["copies"]) for r in found}
    if not {0.0, 1.0} <= counted.keys():
        return None
    everything = counted[0.0][1] + counted[1.0][1]
    chosen, each = F.lit(False), F.lit(None).cast("double")
    for side in (0.0, 1.0):
        n, copies = counted[side]
        share = min(1.0, settings.train_rows / 2 / n)
        drawn = F.pmod(F.xxhash64("pick", F.lit(settings.seed)), F.lit(1 << 30)) < math.ceil(share * (1 << 30))
        chosen = chosen | ((F.col(label) == side) & drawn)
        # What the label weighs as a whole, dealt out to the rows that stand for it.
        whole = max(copies / everything, settings.least_weight)
        each = F.when(F.col(label) == side, F.lit(whole * settings.train_rows / (copies * share))).otherwise(each)
    one = rows.where(chosen).groupBy("pick", label).agg(*[F.first(c).alias(c) for c in FEATURES], F.count(F.lit(1)).alias("n"))
    drawn = one.select(*FEATURES, F.col(label).alias("target"), (each * F.col("n")).alias("weight"))
    return stage(drawn, "url-train").coalesce(8)


def train(featured: DataFrame, label: str, settings: Trees):
    """A fitted model, or None unless both labels (0 and 1) occur. The training rows are staged and bounded in number."""
    chosen = draw(featured.where(F.col(label).isNotNull()), label, settings)
    if chosen is None or chosen.select("target").distinct().count() < 2:
        return None
    vector = VectorAssembler(inputCols=FEATURES, outputCol="vector")
    boost = GBTClassifier(
        featuresCol="vector",
        labelCol="target",
        weightCol="weight",
        maxIter=settings.trees,
        maxDepth=settings.depth,
        stepSize=settings.step,
        seed=settings.seed,
    )
    return boost.fit(vector.transform(chosen).select("vector", "target", "weight"))


def judge_urls(
    df: DataFrame,
    rules: tuple[Rule, ...],
    url: str = "url",
    labels: Column | None = None,
    settings: Trees | None = None,
    into: str = "url_verdict",
) -> DataFrame:
    """``df`` with a struct ``into``: host, path, rule, verdict ("block" or "allow"), and block_score of the trees.

    A rule that fits decides, the longest first; every other URL gets the verdict of the trees. They learn from
    ``labels``, a column of 1 for block, 0 for allow and null for unknown; by default from the URLs that a rule
    decides. Without both labels to learn from, URLs without a rule are allowed, with a null score. A null URL, or
    one without ``://``, has an empty host and path, and features of its characters alone. Rows are judged one by
    one, so repeated rows get equal verdicts; other columns pass through; an empty frame gives an empty frame.
    """
    settings = settings or Trees()
    cut = df.select(
        quoted(url).alias("url"),
        host_of(quoted(url)).alias("host"),
        path_of(quoted(url)).alias("path"),
        (F.lit(None).cast("double") if labels is None else labels.cast("double")).alias("label"),
        F.struct(*map(quoted, df.columns)).alias("row"),
        # Of the whole row: pages that share one frequent URL are drawn one by one.
        F.xxhash64(*map(quoted, df.columns)).alias("pick"),
    )
    host, path = F.col("host"), F.col("path")
    ruled = cut.select("*", rule_of(host, path, rules, "text").alias("rule"), rule_of(host, path, rules, "verdict").alias("ruled"))
    if labels is None:
        ruled = ruled.withColumn("label", F.when(F.col("ruled").isNotNull(), (F.col("ruled") == "block").cast("double")))
    model = train(with_suffix_statistics(lexical(ruled.drop("row"))), "label", settings)
    scored = ruled if model is None else with_suffix_statistics(lexical(ruled))
    if model is None:
        scored = scored.withColumn("score", F.lit(None).cast("double"))
    else:
        from pyspark.ml.functions import vector_to_array

        scored = VectorAssembler(inputCols=FEATURES, outputCol="vector").transform(scored)
        scored = model.transform(scored).withColumn("score", vector_to_array("probability")[1])
    own = F.when(F.col("score") >= settings.block_at, "block").otherwise("allow")
    verdict = F.struct(
        "host", "path", "rule", F.coalesce("ruled", own).alias("verdict"), F.col("score").alias("block_score")
    )
    kept = [F.col("row").getField(c).alias(c) for c in df.columns if c != into]
    return scored.select(*kept, verdict.alias(into))
