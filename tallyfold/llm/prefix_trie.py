"""Prefix trie of conversations, with subtree totals by parallel tree contraction.

A node is a distinct sequence of first turns. Sequences are told apart by two 64-bit sums
(exclusive or) over the hashes of their turns, each tagged with its place, and by their
length; a conversation's nodes come from a running sum over its turns.

Totals over subtrees come from contraction in join rounds. A round takes out, at once,
leaves (rake: their totals are known and go to their parents) and nodes of one child
(compress: such a node is taken out if its random priority of the round is above its
child's and its parent's, so no two neighbours go together; its own sums wait on the edge
that now skips it). Chains of any length shrink by a constant share in each round, so the
rounds grow with the logarithm of the tree. Then the rounds are walked back: the total of a
node that compress took out is what was left with it and the total of its child.

Every round starts from written files. Joins inside the rounds have one row per node on
both sides, sums to a common parent are combined before they are shuffled, and the one join
that children share a parent in is salted. Turns are numbered in sorted ranges, not by
conversation, and running sums go by blocks of turns, so a conversation of a third of all
turns, or the same turn over and over, is spread as well.

Defined results: rows without a conversation id take no part; a null role or text counts
as empty; turns are ordered by turn (null first), then role, then text, and a repeated row
is one more turn; no conversations give no nodes, and a conversation without turns is a
member of the root alone.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyfold.llm.common import cut

BLOCK = 4096  # turns of a conversation in one running sum
_SALTS = 8
_ID_BITS = 13  # ids of a node's conversations are listed in lists of at most 2^13


def number_turns(conversations: DataFrame) -> DataFrame:
    """``conv_id``, ``place`` (from 1), two hashes ``x`` and ``y`` of role and text, ``chars``.

    Rows are sorted in ranges; equal rows are told apart by a number of their own, so they
    too are dealt over ranges. A place is the place inside its range plus the turns of the
    conversation in earlier ranges.
    """

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, n = None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            ids = batch.column(0).to_numpy()
            new = np.r_[ids[0] != last, ids[1:] != ids[:-1]]
            starts = np.flatnonzero(new)
            place = np.arange(1, len(ids) + 1)
            # Rows before the first new conversation carry on from the last batch.
            place[: starts[0] if len(starts) else len(ids)] += n
            for a, b in zip(starts, np.r_[starts[1:], len(ids)].astype(int), strict=False):
                place[a:b] -= a
            last, n = ids[-1], int(place[-1])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(place, pa.int64())], names=[*batch.schema.names, "inside"])

    said = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
        F.monotonically_increasing_id().alias("row"),
    ).filter("conv_id is not null")
    keys = ("conv_id", "turn", "role", "text", "row")
    slim = said.repartitionByRange(*keys).sortWithinPartitions(*keys).select(
        "conv_id",
        F.spark_partition_id().alias("range"),
        F.xxhash64("role", "text").alias("x"),
        F.xxhash64("text", "role").alias("y"),
        F.length("text").cast("long").alias("chars"),
    )
    placed = cut(slim.mapInArrow(number, "conv_id long, range int, x long, y long, chars long, inside long"), "turns")
    # Conversations that go over the end of a range, of which each range has one at most.
    counts = placed.groupBy("conv_id", "range").agg(F.max("inside").alias("n"))
    earlier = W.partitionBy("conv_id").orderBy("range").rowsBetween(W.unboundedPreceding, -1)
    offsets = counts.withColumn("earlier", F.sum("n").over(earlier)).filter("earlier > 0").select("conv_id", "range", "earlier")
    place = (F.col("inside") + F.coalesce("earlier", F.lit(0))).alias("place")
    return placed.join(offsets, ["conv_id", "range"], "left").select("conv_id", place, "x", "y", "chars")


def memberships(turns: DataFrame, members: DataFrame) -> DataFrame:
    """One row per conversation and node it is a member of: ``node`` and ``parent`` (keys),
    ``depth``, ``conv_id``, ``chars`` of the node's last text, and whether it ``ends`` there.

    ``turns`` is as ``number_turns`` gives it; ``members`` has every ``conv_id`` and its
    ``n_turns``, those without turns too.
    """
    tagged = turns.withColumns(
        {
            "p": F.xxhash64("place", "x"),
            "q": F.xxhash64("y", "place"),
            "block": F.expr(f"(place - 1) div {BLOCK}"),
        }
    )
    blocks = tagged.groupBy("conv_id", "block").agg(F.bit_xor("p").alias("p"), F.bit_xor("q").alias("q"))
    earlier = W.partitionBy("conv_id").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    blocks = blocks.select(
        "conv_id", "block", F.bit_xor("p").over(earlier).alias("p0"), F.bit_xor("q").over(earlier).alias("q0")
    ).filter("block > 0")
    upto = W.partitionBy("conv_id", "block").orderBy("place")
    summed = (
        tagged.withColumns({"a": F.bit_xor("p").over(upto), "b": F.bit_xor("q").over(upto)})
        .join(blocks, ["conv_id", "block"], "left")
        .withColumns(
            {
                "a": F.col("a").bitwiseXOR(F.coalesce("p0", F.lit(0).cast("long"))),
                "b": F.col("b").bitwiseXOR(F.coalesce("q0", F.lit(0).cast("long"))),
            }
        )
    )
    key = lambda depth, a, b: F.concat_ws(":", depth, F.hex(a), F.hex(b))
    zero = F.lit(0).cast("long")
    # The turns of a long conversation meet its length block by block.
    lengths = members.withColumn("block", F.explode(F.expr(f"sequence(0, greatest(n_turns - 1, 0) div {BLOCK})")))
    inner = summed.join(lengths, ["conv_id", "block"]).select(
        key(F.col("place"), F.col("a"), F.col("b")).alias("node"),
        key(F.col("place") - 1, F.col("a").bitwiseXOR(F.col("p")), F.col("b").bitwiseXOR(F.col("q"))).alias("parent"),
        F.col("place").alias("depth"),
        "conv_id",
        "chars",
        (F.col("place") == F.col("n_turns")).alias("ends"),
    )
    root = members.select(
        key(zero, zero, zero).alias("node"), F.lit(None).cast("string").alias("parent"), zero.alias("depth"), "conv_id",
        zero.alias("chars"), (F.col("n_turns") == 0).alias("ends"),
    )
    return inner.unionByName(root)


def subtree_totals(nodes: DataFrame, sums: Sequence[str]) -> DataFrame:
    """``node`` and the sums of columns ``sums`` over its subtree, itself included, from rows
    ``node`` and ``parent`` (longs; null for a root) and those columns."""
    via = {c: f"via_{c}" for c in sums}
    live = nodes.select("node", "parent", *sums, *[F.lit(0).cast("long").alias(v) for v in via.values()])
    finished, taken_out, number = [], [], 0
    while True:
        kids = live.filter("parent is not null").groupBy(F.col("parent").alias("of")).agg(
            F.count("*").alias("kids"), F.min("node").alias("only")
        )
        marked = live.join(kids, live["node"] == kids["of"], "left").drop("of")
        rank = lambda c, n=number: F.xxhash64(c, F.lit(n))
        goes = (F.col("kids") == 1) & F.col("parent").isNotNull()
        goes &= (rank("node") > rank("only")) & (rank("node") > rank("parent"))
        marked = cut(marked.withColumn("goes", F.coalesce(goes, F.lit(False))), "marked")
        gone = marked.filter("goes").select(
            F.col("only").alias("below"), F.col("node").alias("gone"), F.col("parent").alias("above"),
            *[F.col(c).alias(f"left_{c}") for c in sums], *[(F.col(c) + F.col(via[c])).alias(f"skip_{c}") for c in sums],
        )
        stay = marked.filter("not goes").drop("goes", "only")
        step = cut(
            stay.join(gone, stay["node"] == gone["below"], "left").select(
                "node",
                F.coalesce("above", "parent").alias("parent"),
                F.col("kids").isNull().alias("leaf"),
                "gone",
                *sums,
                *[(F.col(f"left_{c}") + F.col(via[c])).alias(f"left_{c}") for c in sums],
                *[(F.col(via[c]) + F.coalesce(f"skip_{c}", F.lit(0).cast("long"))).alias(via[c]) for c in sums],
            ),
            "round",
        )
        finished.append(step.filter("leaf").select("node", *sums))
        taken_out.append(step.filter("gone is not null").select(F.col("gone").alias("node"), F.col("node").alias("below"), *[F.col(f"left_{c}").alias(c) for c in sums]))
        rest = step.filter("not leaf").select("node", "parent", *sums, *via.values())
        if rest.isEmpty():
            break
        raked = step.filter("leaf and parent is not null").groupBy(F.col("parent").alias("to")).agg(
            *[F.sum(F.col(c) + F.col(via[c])).alias(f"more_{c}") for c in sums]
        )
        live = rest.join(raked, rest["node"] == raked["to"], "left").select(
            "node", "parent", *[(F.col(c) + F.coalesce(f"more_{c}", F.lit(0).cast("long"))).alias(c) for c in sums], *via.values()
        )
        number += 1
    totals = finished[0]
    for more in finished[1:]:
        totals = totals.unionByName(more)
    for waiting in reversed(taken_out):
        known = totals.select(F.col("node").alias("child"), *[F.col(c).alias(f"of_{c}") for c in sums])
        back = waiting.join(known, waiting["below"] == known["child"])
        totals = totals.unionByName(cut(back.select("node", *[(F.col(c) + F.col(f"of_{c}")).alias(c) for c in sums]), "expanded"))
    return totals


def digest_ends(ends: DataFrame) -> DataFrame:
    """``node`` and ``ends_sha256`` of its conversations' ids, ascending and comma-joined.

    Lists of bounded length are made first; one digest is sequential, so the lists of a node
    are streamed through one task, which holds one batch of them.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, digest = None, None
        for batch in batches:
            done = []
            for node, ids in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if node != at:
                    if at is not None:
                        done.append((at, digest.hexdigest()))
                    at, digest = node, hashlib.sha256()
                else:
                    digest.update(b",")
                digest.update(ids.as_py().encode())
            yield _pairs(done)
        if at is not None:
            yield _pairs([(at, digest.hexdigest())])

    listed = ends.groupBy("node", F.shiftright("conv_id", _ID_BITS).alias("list")).agg(
        F.array_join(F.array_sort(F.collect_list("conv_id")).cast("array<string>"), ",").alias("ids")
    )
    return (
        listed.repartition("node").sortWithinPartitions("node", "list").select("node", "ids").mapInArrow(run, "node string, ends_sha256 string")
    )


def _pairs(rows: list[tuple[str, str]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.string())], names=["node", "ends_sha256"]
    )


def prefix_trie(turns: DataFrame, members: DataFrame) -> DataFrame:
    """One row per node: ``conv_id`` (smallest member), ``depth``, ``parent_conv_id`` (null for
    the root), ``n_convs``, ``n_children``, ``n_leaves``, ``saved_tokens`` (code points that
    need not be read again, summed over the subtree) and ``ends_sha256``.

    A node's turns are the first ``depth`` of its ``conv_id``. For the arguments see
    ``memberships``.
    """
    rows = cut(memberships(turns, members), "memberships")
    grouped = rows.groupBy("node", "parent", "depth").agg(
        F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.max("chars").alias("chars")
    )
    # The numbers stand once they are written.
    nodes = cut(grouped.withColumn("id", F.monotonically_increasing_id()), "nodes")
    children = nodes.filter("parent is not null").groupBy(F.col("parent").alias("of")).agg(F.count("*").alias("n_children"))
    counted = nodes.join(children, nodes["node"] == children["of"], "left").drop("of").withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long")))
    salt = F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1)))
    above = counted.filter("n_children > 0").select(
        F.col("node").alias("parent"), F.col("id").alias("parent_id"), F.col("conv_id").alias("parent_conv_id"), salt.alias("salt")
    )
    linked = cut(
        counted.withColumn("salt", F.pmod("id", F.lit(_SALTS)).cast("int")).join(above, ["parent", "salt"], "left").drop("salt", "parent"),
        "linked-nodes",
    )
    totals = subtree_totals(
        linked.select(
            F.col("id").alias("node"),
            F.col("parent_id").alias("parent"),
            (F.col("n_children") == 0).cast("long").alias("n_leaves"),
            ((F.col("n_convs") - 1) * F.col("chars")).alias("saved_tokens"),
        ),
        ["n_leaves", "saved_tokens"],
    ).withColumnRenamed("node", "id")
    ends = digest_ends(rows.filter("ends").select("node", "conv_id"))
    return linked.join(totals, "id").join(ends, "node", "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"),
    )
