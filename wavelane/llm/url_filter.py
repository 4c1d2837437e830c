"""URL filters: host and path rules first, gradient-boosted trees for the urls no rule speaks of.

The trees see lexical features alone (lengths, depth, digit ratio, entropy, parameter counts, statistics of
the host's suffixes) and learn from labelled urls. Boosting is histogram based: the training table holds bin
numbers, and a tree level is one grouped sum of gradients and curvatures by (node, feature, bin), so the
driver gets some hundred sums per level whatever the number of rows. The finished trees are Spark
conditional expressions; scoring is a projection. All of it is built-in Spark functions.

Defined results: a null url, or one without ``://``, has empty host and path; an empty host or path is an
ordinary value; repeated rows are judged each for itself; without labelled urls of both kinds the score is
their smoothed rate, one half if there are none; extra columns of the input are not looked at.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wavelane.llm.common import hashed_sample, store

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# The rules of the registered query: (verdict, host followed by path prefix).
RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))
FEATURES = (
    "url_length",
    "host_length",
    "path_length",
    "depth",
    "host_labels",
    "hyphens",
    "digit_ratio",
    "entropy",
    "parameters",
    "query_length",
    "has_fragment",
    "secure",
    "suffix1_rate",
    "suffix2_rate",
    "suffix2_count",
)


def host_of(url: Column) -> Column:
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def matched_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]] = RULES) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits, as conditional expressions over a rule list of
    bounded length; null where none fits. Rules of equal length and text: the first counts."""
    text = verdict = F.lit(None).cast("string")
    for decision, rule in sorted(rules, key=lambda x: len(x[1])):
        rule_host, _, rest = rule.partition("/")
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith("/" + rest)
        text = F.when(fits, F.lit(rule)).otherwise(text)
        verdict = F.when(fits, F.lit(decision)).otherwise(verdict)
    return text, verdict


def _entropy(text: Column) -> Column:
    """Bits per character, summed over the distinct characters."""
    n = F.length(text)

    def part(c: Column) -> Column:
        p = (n - F.length(F.replace(text, c, F.lit("")))) / n
        return F.coalesce(-p * F.log2(p), F.lit(0.0))

    found = F.array_distinct(F.filter(F.split(text, ""), lambda c: c != ""))
    return F.aggregate(F.transform(found, part), F.lit(0.0), lambda a, x: a + x)


def lexical_features(pages: DataFrame) -> DataFrame:
    """``pages`` (with url, host, path) and its lexical features; suffixes are the last one and two labels."""
    url = F.coalesce("url", F.lit(""))
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    count = lambda text, pattern: F.regexp_count(text, F.lit(pattern)).cast("double")
    length = lambda text: F.length(text).cast("double")
    return pages.select(
        "*",
        length(url).alias("url_length"),
        length(F.col("host")).alias("host_length"),
        length(F.col("path")).alias("path_length"),
        count(F.col("path"), "/").alias("depth"),
        count(F.col("host"), r"\.").alias("host_labels"),
        count(F.col("host"), "-").alias("hyphens"),
        F.coalesce(F.try_divide(count(url, "[0-9]"), length(url)), F.lit(0.0)).alias("digit_ratio"),
        _entropy(F.col("host")).alias("entropy"),
        count(query, "=").alias("parameters"),
        length(query).alias("query_length"),
        F.contains(url, F.lit("#")).cast("double").alias("has_fragment"),
        F.startswith(url, F.lit("https:")).cast("double").alias("secure"),
        F.substring_index("host", ".", -1).alias("suffix1"),
        F.substring_index("host", ".", -2).alias("suffix2"),
    )


def suffix_statistics(labelled: DataFrame, suffix: str, smoothing: float = 20.0) -> DataFrame:
    """Per suffix of the labelled urls: their number and the smoothed share that is blocked."""
    n, bad = F.count(F.lit(1)), F.sum(F.col("blocked").cast("double"))
    return labelled.groupBy(suffix).agg(
        ((bad + smoothing / 2) / (n + smoothing)).alias(f"{suffix}_rate"),
        F.log1p(n.cast("double")).alias(f"{suffix}_count"),
    )


@dataclass(frozen=True)
class UrlModel:
    """Trees as lists of (feature, threshold) per level-ordered node, leaf values, and suffix tables."""

    start: float
    trees: tuple[dict, ...]
    suffix1: DataFrame
    suffix2: DataFrame

    def with_features(self, pages: DataFrame) -> DataFrame:
        """Join the suffix statistics; a suffix not seen in training gets one half. A suffix may hold a
        third of all rows: these are plain left joins, which adaptive execution splits or broadcasts by
        the measured size of the statistics."""
        joined = lexical_features(pages).join(self.suffix1, "suffix1", "left").join(self.suffix2, "suffix2", "left")
        return joined.withColumns(
            {
                "suffix1_rate": F.coalesce("suffix1_rate", F.lit(0.5)),
                "suffix2_rate": F.coalesce("suffix2_rate", F.lit(0.5)),
                "suffix2_count": F.coalesce("suffix2_count", F.lit(0.0)),
            }
        )

    def score(self) -> Column:
        margin = reduce(lambda a, t: a + _tree(t, 1), self.trees, F.lit(self.start))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-margin))


def _tree(tree: dict, node: int) -> Column:
    if node in tree["splits"]:
        feature, threshold = tree["splits"][node]
        return F.when(F.col(feature) > threshold, _tree(tree, 2 * node + 1)).otherwise(_tree(tree, 2 * node))
    return F.lit(tree["leaves"].get(node, 0.0))


def fit_url_model(
    labelled: DataFrame,
    rounds: int = 10,
    depth: int = 3,
    bins: int = 16,
    rate: float = 0.4,
    ridge: float = 1.0,
    max_training_rows: int = 50_000,
) -> UrlModel:
    """Boost trees on rows (url, host, path, boolean ``blocked``). The suffix statistics count all labelled
    rows; the trees take at most about ``max_training_rows``, chosen by a hash of the url."""
    rows = labelled.where(F.col("blocked").isNotNull()).select("url", "host", "path", "blocked")
    suffixed = rows.select(
        "blocked", F.substring_index("host", ".", -1).alias("suffix1"), F.substring_index("host", ".", -2).alias("suffix2")
    )
    one = store(suffix_statistics(suffixed, "suffix1").select("suffix1", "suffix1_rate"), "url-suffix1")
    two = store(suffix_statistics(suffixed, "suffix2"), "url-suffix2")
    bare = UrlModel(0.0, (), one, two)
    sample = store(bare.with_features(hashed_sample(rows, "url", max_training_rows)), "url-features")
    counts = sample.agg(F.sum(F.col("blocked").cast("int")).alias("bad"), F.count("*").alias("n")).first()
    bad, n = counts["bad"] or 0, counts["n"]
    start = math.log((bad + 1) / (n - bad + 1))
    if bad == 0 or bad == n:
        return UrlModel(start, (), one, two)
    shares = [i / bins for i in range(1, bins)]
    quantiles = sample.agg(*[F.percentile_approx(f, shares, 10000).alias(f) for f in FEATURES]).first()
    cuts = {f: sorted(set(quantiles[f])) for f in FEATURES}
    binned = store(
        sample.select(
            F.col("blocked").cast("double").alias("y"),
            *FEATURES,
            F.array(
                *[
                    F.struct(
                        F.lit(k).alias("f"),
                        sum((F.when(F.col(f) > c, 1).otherwise(0) for c in cuts[f]), F.lit(0)).alias("b"),
                    )
                    for k, f in enumerate(FEATURES)
                ]
            ).alias("bins"),
        ),
        "url-bins",
    )
    trees: list[dict] = []
    for _ in range(rounds):
        p = UrlModel(start, tuple(trees), one, two).score()
        graded = binned.select("*", (F.col("y") - p).alias("g"), (p * (1 - p)).alias("h"))
        tree: dict = {"splits": {}, "leaves": {}}
        for level in range(depth):
            sums = (
                graded.select("g", "h", _node(tree, 1).alias("node"), F.explode("bins").alias("x"))
                .where(F.col("node") >= 2**level)
                .groupBy("node", "x.f", "x.b")
                .agg(F.sum("g").alias("g"), F.sum("h").alias("h"))
                .collect()
            )
            if not _split(tree, sums, cuts, rate, ridge):
                break
        trees.append(tree)
    return UrlModel(start, tuple(trees), one, two)


def _node(tree: dict, node: int) -> Column:
    if node in tree["splits"]:
        feature, threshold = tree["splits"][node]
        return F.when(F.col(feature) > threshold, _node(tree, 2 * node + 1)).otherwise(_node(tree, 2 * node))
    return F.lit(node)


def _split(tree: dict, sums, cuts: dict, rate: float, ridge: float) -> bool:
    """Give each open node its best threshold and its children their values; whether any was split."""
    table: dict[int, dict[int, dict[int, tuple[float, float]]]] = {}
    for row in sums:
        table.setdefault(row["node"], {}).setdefault(row["f"], {})[row["b"]] = (row["g"], row["h"])
    value = lambda g, h: rate * g / (h + ridge)
    gain = lambda g, h: g * g / (h + ridge)
    split = False
    for node, by_feature in sorted(table.items()):
        total_g, total_h = (sum(x[k] for x in by_feature[0].values()) for k in (0, 1))
        tree["leaves"].setdefault(node, value(total_g, total_h))
        best = (1e-6, None)
        for k, f in enumerate(FEATURES):
            g = h = 0.0
            for i, cut in enumerate(cuts[f]):
                dg, dh = by_feature[k].get(i, (0.0, 0.0))
                g, h = g + dg, h + dh
                if h > 1e-3 and total_h - h > 1e-3:
                    better = gain(g, h) + gain(total_g - g, total_h - h) - gain(total_g, total_h)
                    if better > best[0] * (1 + 1e-9):
                        best = (better, (f, cut, g, h))
        if best[1]:
            f, cut, g, h = best[1]
            tree["splits"][node] = (f, cut)
            tree["leaves"][2 * node] = value(g, h)
            tree["leaves"][2 * node + 1] = value(total_g - g, total_h - h)
            split = True
    return split


def with_parts(pages: DataFrame, rules: Sequence[tuple[str, str]] = RULES) -> DataFrame:
    """page_id, url, host, path, and the text and verdict of the rule that fits."""
    parts = pages.select("page_id", "url", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    rule, verdict = matched_rule(F.col("host"), F.col("path"), rules)
    return parts.select("*", rule.alias("rule"), verdict.alias("rule_verdict"))


def judge_urls(
    pages: DataFrame,
    rules: Sequence[tuple[str, str]] = RULES,
    labelled: DataFrame | None = None,
    threshold: float = 0.5,
) -> DataFrame:
    """page_id, host, path, rule, score, verdict of every row. ``labelled`` (url, boolean blocked) trains the
    model; without it the urls that a rule decides do."""
    parts = with_parts(pages, rules)
    if labelled is None:
        examples = parts.where(F.col("rule_verdict").isNotNull()).select(
            "url", "host", "path", (F.col("rule_verdict") == "block").alias("blocked")
        )
    else:
        examples = labelled.select("url", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), "blocked")
    model = fit_url_model(examples)
    scored = model.with_features(parts).select("*", model.score().alias("score"))
    verdict = F.coalesce("rule_verdict", F.when(F.col("score") >= threshold, "block").otherwise("allow"))
    return scored.select("page_id", "host", "path", "rule", "score", verdict.alias("verdict"))
