"""Mixing sources to target weights: budgets down a tree domain - language - source, then a prefix per leaf.

Budgets: a node's budget goes to its children in proportion to their weights. A child takes no more than it
can give (its tokens times the epochs allowed); what it can't use goes to its siblings first, and only what
all siblings together can't use had not been given to the parent in the first place, so it went to the
parent's siblings. This is exact water filling in whole numbers: sorted by supply per weight, a child is full
if the budget left after the fuller ones before it covers its supply; the others share the rest by weight,
rounded down. The tree is a table of distinct leaves, worked on with windows over siblings.

Selection: in every epoch a leaf's documents are ordered by a seeded hash; a leaf takes whole epochs while
its budget allows and in the last one the documents that begin before the budget ends. A leaf may hold a
third of all rows, so no leaf is sorted: token sums per (leaf, hash prefix) find the one slice of the hash
range in which the budget ends, only that slice is ordered, and what comes out is a hash bound per leaf.
Texts are neither shuffled nor sorted. All of it is built-in Spark functions.

Defined results: null domain, language or source is a leaf value of its own; a null or blank text has no
tokens and comes along if its hash lies within its leaf's prefix; rows that repeat a doc_id are one unit,
taken or left together; a node without a listed weight has weight 1; weight 0 takes nothing; an empty table
gives an empty result; columns of the input keep their names, whatever they are.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wavelane.llm.common import small, store, words

LEVELS = ("domain", "lang", "source")
BIG = "decimal(38,0)"


def shuffled_order(seed: int, epoch: Column, doc_id: Column) -> Column:
    """Where a document stands in an epoch: an md5 in hex, which SQL engines agree on."""
    return F.md5(
        F.concat(F.lit(f"{seed}:"), epoch.cast("string"), F.lit(":"), F.coalesce(doc_id.cast("string"), F.lit("null")))
    )


def _weight(level: str, weights: Mapping[str, int]) -> Column:
    weight = F.lit(1)
    for name, value in weights.items():
        weight = F.when(F.col(level) == name, F.lit(int(value))).otherwise(weight)
    return weight.cast(BIG)


def water_fill(children: DataFrame, siblings: list[str], given: str) -> DataFrame:
    """Add ``budget`` to rows with ``name``, ``weight``, ``supply`` and the parent's budget ``given``."""
    family = Window.partitionBy(*siblings)
    in_order = family.orderBy(
        F.coalesce(F.try_divide(F.col("supply").cast("double"), F.col("weight").cast("double")), F.lit(0.0)), "name"
    )
    before = in_order.rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast(BIG)
    total = lambda c, over: F.coalesce(F.sum(c).over(over).cast(BIG), zero)
    usable = children.withColumn("supply", F.when(F.col("weight") > 0, F.col("supply")).otherwise(zero).cast(BIG))
    ranked = usable.withColumns(
        {
            "__before": total("supply", before),
            "__left": (total("weight", family) - total("weight", before)).cast(BIG),
        }
    )
    need = F.col("__before") * F.col("weight") + F.col("supply") * F.col("__left")
    ranked = ranked.withColumn("__full", need <= F.col(given) * F.col("weight"))
    rest = ranked.withColumns(
        {
            "__rest": (F.col(given) - total(F.when(F.col("__full"), F.col("supply")), family)).cast(BIG),
            "__weights": total(F.when(~F.col("__full"), F.col("weight")), family),
        }
    )
    part = F.when(F.col("__weights") > 0, F.expr("cast((__rest * weight) div __weights as decimal(38,0))")).otherwise(zero)
    filled = rest.withColumn("budget", F.when(F.col("__full"), F.col("supply")).otherwise(part).cast(BIG))
    return filled.drop("__before", "__left", "__full", "__rest", "__weights")


def leaf_budgets(
    leaves: DataFrame, weights: Mapping[str, Mapping[str, int]], share: float, max_epochs: int, levels=LEVELS
) -> DataFrame:
    """``leaves`` (levels, tokens, documents) with their ``budget``: ``share`` (to a millionth) of all
    tokens, poured down the tree. The windows run over siblings in the table of distinct leaves."""
    supplied = leaves.withColumn("supply", (F.col("tokens") * max_epochs).cast(BIG))
    millionths = round(share * 1_000_000)
    total = leaves.agg(F.coalesce(F.sum("tokens"), F.lit(0)).cast(BIG).alias("t")).first()["t"]
    budgets: DataFrame | None = None
    for depth in range(1, len(levels) + 1):
        keys, level = list(levels[:depth]), levels[depth - 1]
        nodes = supplied.groupBy(*keys).agg(F.sum("supply").cast(BIG).alias("supply"))
        nodes = nodes.withColumns({"name": F.col(level), "weight": _weight(level, weights.get(level, {}))})
        if budgets is None:
            nodes = nodes.withColumn("__given", F.lit(int(total) * millionths // 1_000_000).cast(BIG))
        else:
            nodes = nodes.join(budgets.withColumnRenamed("budget", "__given"), keys[:-1])
        # The given budget of the root may exceed what there is; of other nodes it never does.
        budgets = water_fill(nodes, keys[:-1], "__given").select(*keys, "budget")
    return leaves.join(budgets, list(levels))


def _key(column: Column) -> Column:
    """A value as a join key in which null is a value."""
    return F.coalesce(F.concat(F.lit("="), column.cast("string")), F.lit("null"))


def plan_mix(
    docs: DataFrame,
    domain: Column,
    weights: Mapping[str, Mapping[str, int]],
    share: float = 0.6,
    max_epochs: int = 3,
    seed: int = 0,
    slice_documents: int = 4096,
) -> tuple[DataFrame, DataFrame]:
    """The documents' keys and token counts, and per leaf: budget, whole epochs, hash bound of the last one."""
    units = store(
        docs.select(
            _key(domain).alias("domain"),
            _key(F.col("lang")).alias("lang"),
            _key(F.col("source")).alias("source"),
            "doc_id",
            F.size(words(F.col("text"))).cast("long").alias("n_tokens"),
        ),
        "mix-units",
    )
    leaves = units.groupBy(*LEVELS).agg(F.sum("n_tokens").alias("tokens"), F.count(F.lit(1)).alias("documents"))
    keyed = {level: {f"={k}": v for k, v in named.items()} for level, named in weights.items()}
    planned = leaf_budgets(store(leaves, "mix-leaves"), keyed, share, max_epochs).select(
        *LEVELS,
        F.col("tokens").cast("long").alias("tokens"),
        F.col("budget").cast("long").alias("budget"),
        F.when(F.col("tokens") > 0, F.expr("cast(budget as bigint) div tokens")).otherwise(F.lit(0)).cast("int").alias("whole_epochs"),
        F.when(F.col("tokens") > 0, F.expr("cast(budget as bigint) % tokens")).otherwise(F.lit(0)).cast("long").alias("rest"),
        F.greatest(F.ceil(F.log(16.0, F.greatest(F.col("documents") / slice_documents, F.lit(1.0)))), F.lit(1)).cast("int").alias("digits"),
    )
    planned = store(planned, "mix-budgets")
    open_leaves = small(planned.where("rest > 0").select(*LEVELS, "whole_epochs", "rest", "digits"))
    ordered = units.join(open_leaves, list(LEVELS)).withColumn(
        "order", shuffled_order(seed, F.col("whole_epochs"), F.col("doc_id"))
    )
    ordered = ordered.withColumn("slice", F.substring(F.col("order"), F.lit(1), F.col("digits")))
    slices = ordered.groupBy(*LEVELS, "slice", "rest").agg(F.sum("n_tokens").alias("n"))
    up_to = Window.partitionBy(*LEVELS).orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    last = (
        slices.withColumn("before", F.coalesce(F.sum("n").over(up_to), F.lit(0)))
        .where("before < rest")
        .groupBy(*LEVELS)
        .agg(F.max(F.struct("slice", "before")).alias("x"))
        .select(*LEVELS, "x.slice", "x.before")
    )
    cut = small(store(last, "mix-slices"))
    in_slice = ordered.join(cut, [*LEVELS, "slice"]).groupBy(*LEVELS, "order", "before", "rest").agg(F.sum("n_tokens").alias("n"))
    running = Window.partitionBy(*LEVELS).orderBy("order").rowsBetween(Window.unboundedPreceding, -1)
    bounds = (
        in_slice.withColumn("start", F.col("before") + F.coalesce(F.sum("n").over(running), F.lit(0)))
        .where("start < rest")
        .groupBy(*LEVELS)
        .agg(F.max("order").alias("bound"))
    )
    return units, store(planned.join(bounds, list(LEVELS), "left"), "mix-bounds")


def _copies(seed: int) -> Column:
    order = shuffled_order(seed, F.col("whole_epochs"), F.col("doc_id"))
    return F.col("whole_epochs") + F.coalesce((order <= F.col("bound")).cast("int"), F.lit(0))


def mix(docs: DataFrame, domain: Column, weights: Mapping[str, Mapping[str, int]], share: float = 0.6, max_epochs: int = 3, seed: int = 0) -> DataFrame:
    """doc_id, epoch (from 0), n_tokens, leaf_budget of every selected copy."""
    units, bounds = plan_mix(docs, domain, weights, share, max_epochs, seed)
    chosen = units.join(small(bounds), list(LEVELS)).withColumn("copies", _copies(seed)).where("copies > 0")
    return chosen.select(
        "doc_id",
        F.explode(F.sequence(F.lit(0), F.col("copies") - 1)).alias("epoch"),
        "n_tokens",
        F.col("budget").alias("leaf_budget"),
    )


def select_mix(docs: DataFrame, domain: Column, weights: Mapping[str, Mapping[str, int]], share: float = 0.6, max_epochs: int = 1, seed: int = 0) -> DataFrame:
    """The selected rows of ``docs`` with all their columns, once per epoch. Each text meets a leaf's bound
    where it lies: the leaf table is broadcast if it is small, joined on measured sizes if not."""
    _, bounds = plan_mix(docs, domain, weights, share, max_epochs, seed)
    whole = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row"),
        "doc_id",
        _key(domain).alias("domain"),
        _key(F.col("lang")).alias("lang"),
        _key(F.col("source")).alias("source"),
    )
    chosen = whole.join(small(bounds), list(LEVELS)).withColumn("copies", _copies(seed)).where("copies > 0")
    return chosen.select("__row", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("__row.*")
