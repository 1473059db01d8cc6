"""Mixing sources to target weights through a domain-language-source tree.

The token budget goes down the tree: a node's budget is shared among its children by
weight, and no child gets more than its subtree can supply in ``max_epochs`` epochs. What
a short child cannot use goes to its siblings by weight; only what no sibling can use is
left to the ancestors, since a subtree's supply bounds its share one level up. Shares are
whole tokens, rounded down.

A leaf's tokens are spent epoch by epoch. Each epoch puts the leaf's documents in an order
of its own (MD5 of seed, epoch and doc_id); whole epochs come first, then the prefix of
the next one: a document is in it if the tokens before it are fewer than those left.
The prefix is found from sums over about sqrt(n) ranges of the order, so no leaf is ever
sorted or summed in one task; only the range that the cut falls into is.

Defined results: null texts have no tokens; null language or source is a node of its own;
nodes without a weight get ``default_weight``; a node of
weight 0 is left out with all below it; rows with the same doc_id share one place
in the order and are taken or left together; a document without tokens is taken in each
epoch in which its place is reached; leaves with budget 0, and empty tables, give no rows.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyfold.llm.common import cut, set_aside, text_of, words_of

PATH = ("domain", "lang", "source")
_WIDE = "decimal(38,0)"


@set_aside
def with_domain(docs: DataFrame, domains: Mapping[str, str], default: str = "other") -> DataFrame:
    """Adds ``domain``, looked up by source."""
    named = F.lit(None).cast("string")
    for domain in sorted(set(domains.values())):
        named = F.when(
            F.col("source").isin(sorted(s for s, d in domains.items() if d == domain)), domain
        ).otherwise(named)
    return docs.withColumn("domain", F.coalesce(named, F.lit(default)))


def _weight(level: int, weights: Mapping[tuple, int], default_weight: int) -> Column:
    """The weight of the node at this level; keys are paths from the root."""
    found = F.lit(default_weight)
    for path, weight in weights.items():
        if len(path) == level + 1:
            here = F.lit(True)
            for name, value in zip(PATH, path, strict=False):
                here &= F.col(name).eqNullSafe(F.lit(value))
            found = F.when(here, weight).otherwise(found)
    return found.cast(_WIDE)


def share_out(nodes: DataFrame, parent: list[str], name: str) -> DataFrame:
    """Adds ``share`` to rows with ``budget`` (of the parent), ``weight`` and ``supply``.

    Children are ordered by supply per weight. Those whose supply is at most their part of
    what their lighter-supplied siblings leave over are used up; the others share the rest.
    """
    peers = W.partitionBy(*parent)
    ahead = peers.orderBy(F.col("supply") / F.greatest("weight", F.lit(1).cast(_WIDE)), F.col(name).asc_nulls_first())
    before = ahead.rowsBetween(W.unboundedPreceding, -1)
    zero = F.lit(0).cast(_WIDE)
    staged = nodes.withColumns(
        {
            "_used": F.coalesce(F.sum("supply").over(before), zero),
            "_weights": F.sum("weight").over(peers) - F.coalesce(F.sum("weight").over(before), zero),
        }
    )
    short = F.col("supply") * F.col("_weights") <= F.col("weight") * (F.col("budget") - F.col("_used"))
    staged = staged.withColumn("_short", short)
    full = F.coalesce(F.sum(F.when(F.col("_short"), F.col("supply"))).over(peers), zero)
    open_ = F.coalesce(F.sum(F.when(~F.col("_short"), F.col("weight"))).over(peers), zero)
    staged = staged.withColumns({"_full": full, "_open": open_})
    rest = F.expr("weight * (budget - _full) div greatest(_open, 1)")
    share = F.when(F.col("_short"), F.col("supply")).otherwise(rest)
    return staged.withColumn("share", share.cast(_WIDE)).drop("_used", "_weights", "_short", "_full", "_open")


def budgets(
    leaves: DataFrame, budget_percent: int, weights: Mapping[tuple, int], default_weight: int, max_epochs: int
) -> DataFrame:
    """Adds each leaf's ``budget`` to rows of ``PATH``, ``tokens`` and ``docs``."""
    left_out = F.lit(False)
    for level in range(len(PATH)):
        left_out |= _weight(level, weights, default_weight) == 0
    # What lies below a weight of 0 supplies nothing, so its share is 0.
    sums = leaves.withColumn("supply", F.when(left_out, 0).otherwise(F.col("tokens") * max_epochs).cast(_WIDE))
    total = sums.agg(F.least(F.expr(f"sum(tokens) * {budget_percent} div 100").cast(_WIDE), F.sum("supply")))
    above, parent = None, []
    for level, name in enumerate(PATH):
        path = list(PATH[: level + 1])
        nodes = sums.groupBy(*path).agg(F.sum("supply").cast(_WIDE).alias("supply"))
        nodes = nodes.withColumn("weight", _weight(level, weights, default_weight))
        if parent:
            above = above.withColumnsRenamed({p: f"_{p}" for p in parent})
            nodes = nodes.join(above, _all_same(parent, [f"_{p}" for p in parent]))
            nodes = nodes.select(*path, "supply", "weight", "budget")
        else:
            nodes = nodes.withColumn("budget", total.scalar())
        shared = share_out(nodes, parent, name)
        above, parent = shared.select(*path, F.col("share").alias("budget")), path
    return above


def order_key(seed: int, epoch: Column) -> Column:
    """A document's place in the order of an epoch, 32 hex digits."""
    return F.md5(
        F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary")
    )


@set_aside
def mix(
    docs: DataFrame,
    weights: Mapping[tuple, int],
    budget_percent: int = 100,
    default_weight: int = 1,
    max_epochs: int = 2,
    seed: int = 17,
    tokens: Column | None = None,
) -> DataFrame:
    """Rows of ``docs`` (with ``domain``, ``lang``, ``source``) once for each epoch they are
    taken in, with ``epoch`` from 0, ``n_tokens`` and ``place`` (the order key).

    ``budget_percent`` is of all tokens. ``weights`` maps paths such as ``("web",)`` or
    ``("web", "en", "src0")`` to whole numbers; tokens are words unless given.
    """
    counted = docs.withColumn("n_tokens", (F.size(words_of(text_of())) if tokens is None else tokens).cast("long"))
    slim = cut(counted.select("doc_id", *PATH, "n_tokens"), "token-counts")
    leaves = cut(
        slim.groupBy(*PATH).agg(F.sum("n_tokens").alias("tokens"), F.count("*").alias("docs")), "leaves"
    )
    shared = budgets(leaves, budget_percent, weights, default_weight, max_epochs)
    keys = [f"_{c}" for c in PATH]
    shared = shared.withColumnsRenamed(dict(zip(PATH, keys, strict=True)))
    plan = cut(
        leaves.join(shared, _all_same(list(PATH), keys))
        .filter("tokens > 0 and budget > 0")
        .select(
            *keys,
            F.expr("cast(budget div tokens as int)").alias("_epochs"),
            (F.col("budget") % F.col("tokens")).cast("long").alias("_left"),
            F.ceil(F.sqrt("docs")).cast("long").alias("_ranges"),
        ),
        "leaf-plan",
    )
    mine = _all_same(list(PATH), keys)
    key = order_key(seed, F.col("_epochs"))
    # The first 28 bits of the key, as a share of all values, choose the range.
    at = F.floor(F.conv(F.substring("_key", 1, 7), 16, 10).cast("long") * F.col("_ranges") / (1 << 28)).cast("long")
    cutting = (
        slim.join(plan, mine).filter("_left > 0").withColumn("_key", key).withColumn("_at", at)
        .select(*keys, "_left", "_at", "_key", "n_tokens")
    )
    ranges = cutting.groupBy(*keys, "_left", "_at").agg(F.sum("n_tokens").alias("_sum"))
    running = W.partitionBy(*keys).orderBy("_at").rowsBetween(W.unboundedPreceding, -1)
    last = (
        ranges.withColumn("_before", F.coalesce(F.sum("_sum").over(running), F.lit(0)))
        .filter("_before < _left")
        .groupBy(*keys)
        .agg(F.max_by(F.struct("_at", "_before"), "_at").alias("_cut"))
        .select(*[F.col(k).alias(f"c{k}") for k in keys], "_cut.*")
        .withColumnsRenamed({"_at": "c_at", "_before": "c_before"})
    )
    last = cut(last, "last-ranges")
    within = cutting.join(
        last, (F.col("_at") == F.col("c_at")) & _all_same(keys, [f"c{k}" for k in keys])
    )
    # Rows of one id share their key, so they are summed before the window.
    summed = within.groupBy(*keys, "_left", "c_before", "_key").agg(F.sum("n_tokens").alias("_sum"))
    upto = W.partitionBy(*keys).orderBy("_key").rowsBetween(W.unboundedPreceding, -1)
    inside = summed.withColumn("_sofar", F.coalesce(F.sum("_sum").over(upto), F.lit(0)) + F.col("c_before"))
    edge = inside.filter("_sofar < _left").groupBy(*keys).agg(F.max("_key").alias("_edge"))
    plan = cut(
        plan.join(edge.select(*[F.col(k).alias(f"e{k}") for k in keys], "_edge"), _all_same(keys, [f"e{k}" for k in keys]), "left")
        .select(*keys, "_epochs", "_edge"),
        "leaf-edges",
    )
    taken = counted.join(plan, mine).withColumn("_key", key)
    epochs = F.col("_epochs") + F.when(F.col("_key") <= F.col("_edge"), 1).otherwise(0)
    return (
        taken.withColumn("_n", epochs)
        .filter("_n > 0")
        .withColumn("epoch", F.explode(F.sequence(F.lit(0), F.col("_n") - 1)))
        .withColumn("place", order_key(seed, F.col("epoch")))
        .drop(*keys, "_epochs", "_edge", "_key", "_n")
    )


def _all_same(left: list[str], right: list[str]) -> Column:
    same = F.lit(True)
    for a, b in zip(left, right, strict=True):
        same &= F.col(a).eqNullSafe(F.col(b))
    return same


# The mix of the registered query and the pipeline: 20 sources in four domains.
DOMAINS = {f"src{i}": ("web", "news", "books", "forum")[i % 4] for i in range(20)}
WEIGHTS: dict[tuple, int] = {
    ("web",): 40,
    ("news",): 25,
    ("books",): 25,
    ("forum",): 10,
    **{(d, lang): w for d in ("web", "news", "books", "forum") for lang, w in (("en", 60), ("de", 15), ("fr", 15), ("es", 10))},
}
