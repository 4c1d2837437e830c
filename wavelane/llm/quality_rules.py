"""Quality rules: a learned decision list over text statistics.

Sequential covering: a conjunction of thresholds is grown literal by literal on two thirds of the labelled
rows (by information gain of the covered rejects), pruned on the other third, and taken if it is precise
enough there; what it covers leaves the training rows and the next one is grown. Each step is one grouped
count of (feature, bin), so the driver sees a few hundred counts whatever the number of rows. The result is
an ordered list of Spark conditions. All of it is built-in Spark functions.

Defined results: a null, empty or blank text has no words and fails the base rules; texts of any length are
counted whole; repeated rows are judged each for itself; with no usable labels the list is empty, so that
only the base rules reject; extra columns of the input are not looked at.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wavelane.llm.common import WHITE, hashed_sample, store, words

WINDOW = 8
FEATURES = (
    "n_words",
    "word_length",
    "symbols_per_word",
    "dup_line_share",
    "repeat_share",
    "upper_share",
    "digit_share",
    "punct_share",
    "distinct_share",
    "words_per_line",
)


@dataclass(frozen=True)
class Literal:
    feature: str
    above: bool
    threshold: float

    def condition(self, where: str) -> Column:
        column = F.col(where + self.feature)
        return column > F.lit(self.threshold) if self.above else column <= F.lit(self.threshold)

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.threshold:.6g}"


@dataclass(frozen=True)
class RuleList:
    """Conjunctions in order; a row that none covers is kept."""

    rules: tuple[tuple[Literal, ...], ...] = ()

    def fired(self, where: str = "stats.") -> Column:
        """The first conjunction that covers the row, as text; null if none does."""
        fired = F.lit(None).cast("string")
        for rule in reversed(self.rules):
            fired = F.when(
                reduce(and_, [x.condition(where) for x in rule]), F.lit(" and ".join(map(str, rule)))
            ).otherwise(fired)
        return fired


def text_statistics(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: ``key`` as doc_id, and base counts and features of the whole text as ``stats``.

    Words in repeated windows: the 8-word windows of a text are hashed to 64 bits in one array. Only if
    that array holds an equal pair (rare) are its entries sorted and the positions of equal ones merged.
    """
    base = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("__text"))
    split = base.select("*", words(F.col("__text")).alias("__words"))
    n = F.size("__words")
    width = F.greatest(n - (WINDOW - 1), F.lit(0))
    shifted = [F.slice("__words", F.lit(k + 1), width).alias(f"w{k}") for k in range(WINDOW)]
    hashed = split.select(
        "*",
        F.transform(F.arrays_zip(*shifted), lambda window: F.xxhash64(window)).alias("__hashes"),
        F.filter(F.split("__text", "\n"), lambda x: F.btrim(x, F.lit(WHITE)) != "").alias("__lines"),
    )
    repeats = F.size(F.array_distinct("__hashes")) < F.size("__hashes")
    ordered = hashed.select(
        "*",
        F.when(
            repeats,
            F.sort_array(
                F.arrays_zip(
                    F.col("__hashes").alias("h"),
                    F.sequence(F.lit(0), F.size("__hashes") - 1).alias("at"),
                )
            ),
        ).alias("__order"),
    )

    def has_twin(entry: Column, i: Column) -> Column:
        before, after = F.get("__order", i - 1)["h"], F.get("__order", i + 1)["h"]
        return F.coalesce(entry["h"] == before, F.lit(False)) | F.coalesce(entry["h"] == after, F.lit(False))

    twins = ordered.select(
        "*",
        F.when(
            F.col("__order").isNotNull(),
            F.sort_array(F.transform(F.filter("__order", has_twin), lambda x: x["at"])),
        ).alias("__twins"),
    )
    later = F.slice("__twins", F.lit(2), F.greatest(F.size("__twins") - 1, F.lit(0)))
    earlier = F.slice("__twins", F.lit(1), F.greatest(F.size("__twins") - 1, F.lit(0)))
    covered = F.aggregate(
        F.zip_with(later, earlier, lambda b, a: F.least(b - a, F.lit(WINDOW))),
        F.lit(WINDOW),
        lambda total, x: total + x,
    )
    text_, long = F.col("__text"), lambda c: F.coalesce(c.cast("long"), F.lit(0).cast("long"))

    def characters(pattern: str) -> Column:
        return F.length(text_) - F.length(F.regexp_replace(text_, pattern, ""))

    # One struct per step instead of many columns: the optimizer's constraints double with every alias.
    counted = twins.select(
        "doc_id",
        F.struct(
            long(F.size("__words")).alias("n_words"),
            long(F.length(F.array_join("__words", ""))).alias("word_chars"),
            long(characters(r"[#*$%&|<>]")).alias("n_symbols"),
            long(F.when(text_.isNotNull(), F.size("__lines") - F.size(F.array_distinct("__lines")))).alias("n_dup_lines"),
            long(F.when(F.col("__twins").isNotNull(), covered)).alias("n_repeat_words"),
            long(F.size(F.array_distinct("__words"))).alias("n_distinct_words"),
            long(F.when(text_.isNotNull(), F.size("__lines"))).alias("n_lines"),
            long(characters(r"\p{Lu}+")).alias("n_upper"),
            long(characters(r"[0-9]+")).alias("n_digits"),
            long(characters(r"[\p{Punct}]+")).alias("n_punct"),
        ).alias("counts"),
    )

    def share(part: str, whole: str) -> Column:
        return F.coalesce(F.try_divide(F.col(f"counts.{part}").cast("double"), F.col(f"counts.{whole}")), F.lit(0.0))

    return counted.select(
        "doc_id",
        F.struct(
            "counts.*",
            share("word_chars", "n_words").alias("word_length"),
            share("n_symbols", "n_words").alias("symbols_per_word"),
            share("n_dup_lines", "n_lines").alias("dup_line_share"),
            share("n_repeat_words", "n_words").alias("repeat_share"),
            share("n_upper", "word_chars").alias("upper_share"),
            share("n_digits", "word_chars").alias("digit_share"),
            share("n_punct", "word_chars").alias("punct_share"),
            share("n_distinct_words", "n_words").alias("distinct_share"),
            share("n_words", "n_lines").alias("words_per_line"),
        ).alias("stats"),
    )


def base_failed(where: str = "stats.") -> Column:
    n = F.col(f"{where}n_words")
    return (n < 20) | (F.lit(100) * F.col(f"{where}n_repeat_words") > F.lit(30) * n)


def fit_rules(
    statistics: DataFrame,
    reject: str = "__reject",
    features: tuple[str, ...] = FEATURES,
    bins: int = 24,
    max_rules: int = 8,
    max_literals: int = 3,
    min_precision: float = 0.9,
    min_covered: int = 4,
) -> RuleList:
    """Learn a decision list from rows with ``features``, ``doc_id`` and a boolean ``reject``."""
    if statistics.isEmpty():
        return RuleList()
    shares = [i / bins for i in range(1, bins)]
    found = statistics.agg(
        *[F.percentile_approx(f, [*shares, 0.99, 0.995], 10000).alias(f) for f in features]
    ).first()
    cuts = {f: sorted(set(map(float, found[f] or []))) for f in features}
    binned = store(
        statistics.select(
            F.col(reject).cast("boolean").alias("bad"),
            (F.pmod(F.xxhash64("doc_id"), F.lit(3)) < 2).alias("grow"),
            *[sum((F.when(F.col(f) > c, 1).otherwise(0) for c in cuts[f]), F.lit(0)).alias(f) for f in features],
        ),
        "quality-training",
    )

    def on_bins(literal: tuple[str, bool, int]) -> Column:
        f, above, i = literal
        return F.col(f) > i if above else F.col(f) <= i

    def conjunction(literals: list[tuple[str, bool, int]]) -> Column:
        return reduce(and_, map(on_bins, literals), F.lit(True))

    one = lambda c: F.sum(F.when(c, 1).otherwise(0))
    taken: list[list[tuple[str, bool, int]]] = []
    for _ in range(max_rules):
        left = ~reduce(or_, map(conjunction, taken), F.lit(False))
        rule: list[tuple[str, bool, int]] = []
        while len(rule) < max_literals:
            counts = (
                binned.where(F.col("grow") & left & conjunction(rule))
                .select("bad", F.explode(F.array(*[F.struct(F.lit(f).alias("f"), F.col(f).alias("i")) for f in features])).alias("x"))
                .groupBy("x.f", "x.i")
                .agg(one(F.col("bad")).alias("p"), one(~F.col("bad")).alias("n"))
                .collect()
            )
            best = _best_literal(counts, cuts, min_covered)
            if best is None:
                break
            rule.append(best[0])
            if best[1] == 0:
                break
        if not rule:
            break
        on_prune = binned.where(~F.col("grow") & left)
        sums = on_prune.agg(
            *[one(F.col("bad") & conjunction(rule[: k + 1])).alias(f"p{k}") for k in range(len(rule))],
            *[one(~F.col("bad") & conjunction(rule[: k + 1])).alias(f"n{k}") for k in range(len(rule))],
        ).first()
        scored = [((sums[f"p{k}"] or 0, sums[f"n{k}"] or 0), k) for k in range(len(rule))]
        (p, n), k = max(scored, key=lambda x: ((x[0][0] - x[0][1]) / max(1, sum(x[0])), -x[1]))
        if p == 0 or p < min_precision * (p + n):
            break
        taken.append(rule[: k + 1])
    return RuleList(
        tuple(tuple(Literal(f, above, cuts[f][i]) for f, above, i in rule) for rule in taken)
    )


def _best_literal(counts, cuts, min_covered):
    """The literal with the largest information gain of covered rejects, and the clean rows it covers."""
    table: dict[str, dict[int, tuple[int, int]]] = {}
    for row in counts:
        table.setdefault(row["f"], {})[row["i"]] = (row["p"], row["n"])
    if not table:
        return None
    p0, n0 = (sum(x[k] for x in next(iter(table.values())).values()) for k in (0, 1))
    if p0 < min_covered or n0 == 0:
        return None
    best, best_gain = None, 1e-9
    before = math.log2(p0 / (p0 + n0))
    for f in sorted(table):
        p = n = 0
        for i in range(len(cuts[f])):
            dp, dn = table[f].get(i, (0, 0))
            p, n = p + dp, n + dn
            for above, pp, nn in ((False, p, n), (True, p0 - p, n0 - n)):
                if pp >= min_covered and pp + nn < p0 + n0:
                    gain = pp * (math.log2(pp / (pp + nn)) - before)
                    if gain > best_gain:
                        best, best_gain = ((f, above, i), nn), gain
    return best


def fit_from_labels(docs: DataFrame, labels: DataFrame, max_training_rows: int = 20_000) -> RuleList:
    """Learn from the documents ``labels`` (doc_id, quality 0/1) speaks of, at most about
    ``max_training_rows`` of them, chosen by a hash of the id. Rows without an id or label are no examples;
    several labels of one document count as rejecting if any does."""
    usable = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull())
    verdicts = usable.groupBy("doc_id").agg((F.min("quality") == 0).alias("__reject"))
    chosen = hashed_sample(verdicts, "doc_id", max_training_rows)
    # At most about max_training_rows ids of 8 bytes and a flag: the bound of this broadcast.
    sample = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    statistics = text_statistics(sample.select(F.struct("doc_id", "__reject").alias("key"), "text"), "key")
    stored = store(statistics.select("doc_id.*", "stats.*"), "quality-statistics")
    return fit_rules(stored.where(~base_failed("")))


def judge(docs: DataFrame, rules: RuleList) -> DataFrame:
    """doc_id, base counts, ``base_failed``, the rule that rejects (null: none) and ``kept``."""
    return text_statistics(docs).select(
        "doc_id",
        *[F.col(f"stats.{c}") for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
        base_failed().alias("base_failed"),
        (~base_failed() & rules.fired().isNull()).alias("kept"),
        F.when(~base_failed(), rules.fired()).alias("rule"),
    )


def keep_good(docs: DataFrame, rules: RuleList) -> DataFrame:
    """The rows of ``docs``, all columns, whose text passes; judged row by row, so nothing is shuffled."""
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row"), F.col("text").alias("__body"))
    # A filter on top would make the optimizer spell the statistics out again wherever the condition names
    # them; exploding one row or none does not.
    judged = text_statistics(whole, "__row", "__body")
    good = ~base_failed() & rules.fired().isNull()
    kept = judged.select(F.explode(F.when(good, F.array("doc_id")).otherwise(F.array_remove(F.array("doc_id"), F.col("doc_id")))).alias("kept"))
    return kept.select("kept.*")
