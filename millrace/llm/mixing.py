"""Mixing sources to target weights: hierarchical token budgets, seeded prefixes.

A tree of levels (say domain, language, source) gets a token budget at its root. Each node
deals its budget to its children by weight; a child takes at most what its leaves can supply
in ``max_epochs`` passes, and what it leaves over goes to its siblings by their weights.
Because a node's budget never exceeds its supply, a shortage reaches an ancestor's siblings
only when the nearer siblings are exhausted. All amounts are whole tokens, dealt by largest
remainders, so the leaves sum to the budget exactly.

A leaf takes full passes over its documents and then the longest prefix of one more pass
that fits. Each pass has its own seeded order. The prefix is found without ordering a leaf
as a whole: the order key cuts a leaf into as many slices as the square root of its number
of documents, slice sums are accumulated, and only the slice in which the budget ends is
ordered.

Defined results: a NULL level value is a node of its own; NULL token counts count 0 and
negative ones are refused; rows with equal ids share their place in the order and are
taken or left together; an empty table and a budget of 0 give no rows; columns beside the
named ones are kept, whatever their names, but for ``copies``, which is replaced; levels of
``mix`` may have any names.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.rows import durable

# A table of leaves up to this size is broadcast; a larger one is joined by shuffling.
BROADCAST_LEAVES = 10_000

_BIG = "decimal(38,0)"
_OWN = "__mix_"


@dataclass(frozen=True)
class Mix:
    """What to mix. ``weights`` are positive integers by path from the root; a node that is
    not named weighs ``default_weight``. The budget is ``budget_percent`` of all tokens."""

    levels: tuple[str, ...]
    weights: dict[tuple[str, ...], int] = field(default_factory=dict)
    default_weight: int = 1
    budget_percent: int = 60
    max_epochs: int = 2
    seed: int = 1

    def __post_init__(self):
        if min([self.default_weight, *self.weights.values()]) < 1:
            raise ValueError("weights must be positive integers")
        if self.budget_percent < 0 or self.max_epochs < 1:
            raise ValueError("a budget is not negative, and there is at least one epoch")


def join_levels(left: DataFrame, right: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """Join on level columns, NULL being equal to NULL; the columns of ``right`` are new."""
    right = right.select(*[F.col(c).alias(f"{_OWN}on_{c}") if c in on else F.col(c) for c in right.columns])
    match = F.lit(True)
    for c in on:
        match = match & F.col(c).eqNullSafe(F.col(f"{_OWN}on_{c}"))
    return left.join(right, match, how).drop(*[f"{_OWN}on_{c}" for c in on])


def _weight(mix: Mix, depth: int) -> Column:
    """Weight of a node at ``depth`` (1 for children of the root) by its path."""
    column = F.lit(mix.default_weight)
    for path, weight in mix.weights.items():
        if len(path) == depth:
            here = F.lit(True)
            for name, value in zip(mix.levels, path):
                here = here & F.col(name).eqNullSafe(F.lit(value))
            column = F.when(here, F.lit(weight)).otherwise(column)
    return column.cast(_BIG)


def deal(nodes: DataFrame, parents: list[str], key: str) -> DataFrame:
    """Share each parent's ``budget`` among its nodes by ``weight``, none above its ``cap``.

    Ordered by cap per weight, a node is full if the budget suffices to bring all nodes to
    its own level; the others share the rest by weight.
    """
    family = Window.partitionBy(*[F.col(c) for c in parents] or [F.lit(1)])
    ratio = F.col("cap").cast("double") / F.col("weight").cast("double")
    upto = family.orderBy(ratio, F.col(key).asc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0)
    out = (
        nodes.withColumn("cap_upto", F.sum("cap").over(upto).cast(_BIG))
        .withColumn("weight_upto", F.sum("weight").over(upto).cast(_BIG))
        .withColumn("weight_all", F.sum("weight").over(family).cast(_BIG))
        .withColumn(
            "full",
            F.expr("cap_upto * weight + cap * (weight_all - weight_upto) <= budget * weight"),
        )
        .withColumn("full_cap", F.sum(F.expr("IF(full, cap, 0)")).over(family).cast(_BIG))
        .withColumn("open_weight", F.sum(F.expr("IF(full, 0, weight)")).over(family).cast(_BIG))
        .withColumn("claim", F.expr("weight * (budget - full_cap)").cast(_BIG))
        .withColumn(
            "share", F.expr("IF(full, cap, claim div open_weight)").cast(_BIG)
        )
        .withColumn("remainder", F.expr("IF(full, -1, claim % open_weight)").cast(_BIG))
        .withColumn("left_over", F.expr("budget").cast(_BIG) - F.sum("share").over(family).cast(_BIG))
    )
    turn = F.row_number().over(family.orderBy(F.desc("remainder"), F.col(key).asc_nulls_first()))
    extra = F.when(~F.col("full") & (turn <= F.col("left_over")), F.lit(1)).otherwise(F.lit(0))
    return out.withColumn("budget", (F.col("share") + extra).cast(_BIG))


def leaf_budgets(sizes: DataFrame, mix: Mix) -> DataFrame:
    """Levels, n_docs, supply and budget of every leaf. ``sizes`` has levels and n_tokens."""
    levels = list(mix.levels)
    leaves = sizes.groupBy(*levels).agg(
        F.count(F.lit(1)).alias("n_docs"), F.sum("n_tokens").cast(_BIG).alias("supply")
    )
    # Few rows from here on, but each level reads them again.
    leaves = leaves.withColumn("cap", (F.col("supply") * mix.max_epochs).cast(_BIG)).transform(durable)
    budgets, parents = None, []
    for depth, level in enumerate(levels, 1):
        path = levels[:depth]
        nodes = leaves.groupBy(*path).agg(F.sum("cap").cast(_BIG).alias("cap"), F.sum("supply").cast(_BIG).alias("held"))
        nodes = nodes.withColumn("weight", _weight(mix, depth))
        if budgets is None:  # the children of the root see the whole supply
            total = F.sum("held").over(Window.partitionBy(F.lit(1)))
            nodes = nodes.withColumn("total", total.cast(_BIG)).withColumn(
                "budget", F.expr(f"LEAST(total * {mix.budget_percent} div 100, total * {mix.max_epochs})").cast(_BIG)
            )
        else:
            nodes = join_levels(nodes, budgets, parents)
        budgets, parents = deal(nodes, parents, level).select(*path, "budget"), path
    return join_levels(leaves, budgets, levels).select(*levels, "n_docs", "supply", "budget")


def _key(seed: Column, epoch: Column, doc_id: Column) -> Column:
    """Place in the seeded order of an epoch: 60 bits."""
    text = F.concat_ws("|", seed, epoch, F.coalesce(doc_id.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("long")


def _placed(rows: DataFrame, plans: DataFrame, mix: Mix, few: bool) -> DataFrame:
    """``rows`` with the plan of their leaf, their key and their slice."""
    plans = plans.select(*[F.col(c).alias(f"{_OWN}{c}") for c in plans.columns])
    on = F.lit(True)
    for c in mix.levels:
        on = on & F.col(c).eqNullSafe(F.col(f"{_OWN}{c}"))
    joined = rows.join(F.broadcast(plans) if few else plans, on)
    key = _key(F.lit(str(mix.seed)), F.col(f"{_OWN}passes").cast("string"), F.col("doc_id"))
    joined = joined.withColumn(f"{_OWN}key", key)
    high = F.shiftright(f"{_OWN}key", 30)
    return joined.withColumn(f"{_OWN}slice", F.shiftright(high * F.col(f"{_OWN}slices"), 30))


def _cuts(sizes: DataFrame, mix: Mix) -> tuple[DataFrame, bool]:
    """For every leaf: full passes, and the last (key, id) of the prefix of one more pass."""
    levels = list(mix.levels)
    plans = leaf_budgets(sizes, mix).select(
        *levels,
        F.expr("IF(supply > 0, budget div supply, 0)").cast("long").alias("passes"),
        F.expr("IF(supply > 0, budget % supply, 0)").cast("long").alias("rest"),
        F.ceil(F.sqrt("n_docs")).cast("long").alias("slices"),
    ).transform(durable)
    few = plans.count() <= BROADCAST_LEAVES
    own = [f"{_OWN}{c}" for c in levels]
    placed = _placed(sizes, plans, mix, few)
    slices = placed.groupBy(*own, f"{_OWN}rest", f"{_OWN}slice").agg(F.sum("n_tokens").alias("held"))
    in_order = Window.partitionBy(*own).orderBy(f"{_OWN}slice").rowsBetween(Window.unboundedPreceding, 0)
    upto = slices.withColumn("upto", F.sum("held").over(in_order))
    # The slice in which the budget ends: the first that does not fit as a whole.
    ends = (
        upto.filter(F.col("upto") > F.col(f"{_OWN}rest"))
        .groupBy(*own)
        .agg(F.min(F.struct(f"{_OWN}slice", "upto", "held")).alias("e"))
        .select(
            *[F.col(c).alias(c.removeprefix(_OWN)) for c in own],
            F.col(f"e.{_OWN}slice").alias("end_slice"),
            (F.col("e.upto") - F.col("e.held")).alias("before"),
        )
    )
    plans = join_levels(plans, ends, levels, "left")
    placed = _placed(sizes, plans, mix, few).filter(F.col(f"{_OWN}slice") == F.col(f"{_OWN}end_slice"))
    ordered = Window.partitionBy(*own).orderBy(F.struct(f"{_OWN}key", "doc_id"))
    upto = F.sum("n_tokens").over(ordered.rangeBetween(Window.unboundedPreceding, Window.currentRow))
    fits = placed.withColumn("upto", F.col(f"{_OWN}before") + upto).filter(F.col("upto") <= F.col(f"{_OWN}rest"))
    last = fits.groupBy(*own).agg(F.max(F.struct(f"{_OWN}key", "doc_id")).alias("last"))
    last = last.select(
        *[F.col(c).alias(c.removeprefix(_OWN)) for c in own],
        F.col(f"last.{_OWN}key").alias("last_key"),
        F.col("last.doc_id").alias("last_id"),
    )
    return join_levels(plans, last, levels, "left").transform(durable), few


def mix(docs: DataFrame, spec: Mix) -> DataFrame:
    """``docs`` (doc_id, n_tokens, the level columns, and more) times their ``copies``.

    A document that is not taken is left out; one taken in full passes and in the prefix
    has ``copies`` above 1.
    """
    # Levels under names of our own: theirs may be those of amounts.
    named = {f"{_OWN}level{i}": F.col(f"`{c}`") for i, c in enumerate(spec.levels)}
    spec = replace(spec, levels=tuple(named))
    sizes = docs.select(
        "doc_id",
        *[column.alias(c) for c, column in named.items()],
        F.expr("IF(n_tokens < 0, raise_error('negative token count'), COALESCE(n_tokens, 0))").cast("long").alias("n_tokens"),
    ).transform(durable)
    plans, few = _cuts(sizes, spec)
    placed = _placed(docs.withColumns(named), plans, spec, few)
    own = {c: F.col(f"{_OWN}{c}") for c in ("slice", "end_slice", "key", "last_key", "last_id", "passes")}
    at_end = own["slice"] == own["end_slice"]
    # NULL ids come first in an ascending order.
    upto_last = (own["key"] < own["last_key"]) | (
        (own["key"] == own["last_key"])
        & (F.col("doc_id").isNull() | F.coalesce(F.col("doc_id") <= own["last_id"], F.lit(False)))
    )
    inside = (
        F.when(own["end_slice"].isNull(), F.lit(False))
        .when(own["slice"] < own["end_slice"], F.lit(True))
        .otherwise(at_end & F.coalesce(upto_last, F.lit(False)))
    )
    copies = (own["passes"] + inside.cast("long")).cast("long")
    kept = [F.col(f"`{c}`") for c in docs.columns if c.lower() != "copies"]
    return placed.select(*kept, copies.alias("copies")).filter(F.col("copies") > 0)
