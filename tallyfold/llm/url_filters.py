"""URL filters: fixed rules first, then the purity of learned path templates.

Every host has a tree of path templates. Segments that vary by form (digits, hex, dates,
long slugs) become ``*`` at once. Then, level by level, a node whose children are mostly
seen once or twice each gets one ``*`` child for all of them. Sibling branches whose share
of bad labels does not differ statistically from that of all siblings together are merged:
they are judged by their pooled labels. By default only templates that differ in their
last segment are siblings; with ``inner`` whole subtrees are, from the deepest level up to
the host: the alike ones become one branch, in which equal remainders are one template. A
template is rejected if its smoothed share of bad labels reaches ``max_bad``; the smoothing
is a prior of ``prior`` pages at the share of all labelled pages.

Pages are counted by template before anything else, so a host of a third of all pages is
a few rows. Only column expressions, joins and aggregates are used.

Defined results: a url without ``://`` (or null) has an empty host and path; a page may
have several labels, each counts; null labels are none; pages without labels, repeated
rows and empty tables are fine; a repeated page is judged alike each time.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyfold.llm.common import cut, set_aside

MERGED = "/"  # alike siblings as one branch; never a segment of a path
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Forms of segments that vary from page to page: numbers with or without an ending, dates,
# hex strings, and slugs of many words.
VARIABLE = r"^([0-9]+([._-][0-9]+)*(\.[a-z]{2,5})?|[0-9a-f]*[0-9][0-9a-f]{7,}(\.[a-z]{2,5})?|[^-]+(-[^-]+){4,})$"


class Rule(NamedTuple):
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


# The rules of the registered query.
RULES = (
    Rule("allow", "org", "/"),
    Rule("block", "example.org", "/es/"),
    Rule("block", "example.org", "/en/1"),
    Rule("allow", "com", "/fr/"),
    Rule("block", "com", "/de/"),
)


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (ASCII letters lower-cased) and path, both empty without ``://``."""
    found = r"(?s)^.*?://([^/?#]*)([^?#]*).*$"
    has = F.coalesce(F.locate("://", url) > 0, F.lit(False)) if isinstance(url, str) else F.coalesce(F.instr(url, "://") > 0, F.lit(False))
    host = F.when(has, F.translate(F.regexp_extract(url, found, 1), UPPER, LOWER)).otherwise("")
    path = F.when(has, F.regexp_extract(url, found, 2)).otherwise("")
    return host, path


def fitting_rule(rules: Sequence[Rule]) -> Column:
    """Struct of name and verdict of the longest rule that fits ``host`` and ``path``, or null."""
    found = F.lit(None).cast("struct<rule: string, verdict: string>")
    for rule in sorted(rules, key=lambda r: len(r.name)):
        fits = (
            (F.col("host") == rule.host) | F.col("host").endswith("." + rule.host)
        ) & F.col("path").startswith(rule.path)
        found = F.when(fits, F.struct(F.lit(rule.name).alias("rule"), F.lit(rule.verdict).alias("verdict"))).otherwise(found)
    return found


def segments(path: Column, depth: int | None) -> Column:
    """Path segments, variable forms as ``*``; what lies below ``depth`` becomes ``**``."""
    named = F.filter(F.split(path, "/"), lambda s: s != "")
    starred = lambda s: F.when(s.rlike(VARIABLE), "*").otherwise(s)
    if depth is None:
        return F.transform(named, starred)
    shown = F.transform(F.slice(named, 1, depth), starred)
    return F.when(F.size(named) > depth, F.concat(shown, F.array(F.lit("**")))).otherwise(shown)


def generalise(nodes: DataFrame, level: int, min_children: int, max_mean: int) -> DataFrame:
    """``template`` with its segment at ``level`` (from 0) as ``*`` where the parent has at
    least ``min_children`` different ones, each with at most ``max_mean`` pages on average."""
    has = F.size("template") > level
    parent = F.slice("template", 1, level)
    here = nodes.withColumns(
        {"_parent": F.when(has, F.array_join(parent, "/")), "_child": F.when(has, F.get("template", F.lit(level)))}
    )
    children = here.filter(has & ~F.col("_child").isin("*", "**")).groupBy("host", "_parent", "_child").agg(F.sum("pages").alias("pages"))
    wide = (
        children.groupBy(F.col("host").alias("_h"), F.col("_parent").alias("_p"))
        .agg(F.count("*").alias("_n"), F.sum("pages").alias("_pages"))
        .filter((F.col("_n") >= min_children) & (F.col("_pages") <= max_mean * F.col("_n")))
        .select("_h", "_p", F.lit(True).alias("_wide"))
    )
    joined = here.join(wide, (F.col("host") == F.col("_h")) & (F.col("_parent") == F.col("_p")), "left")
    starred = F.concat(
        F.slice("template", 1, level),
        F.array(F.lit("*")),
        F.slice("template", F.lit(level + 2), F.greatest(F.size("template") - (level + 1), F.lit(0))),
    )
    change = F.coalesce(F.col("_wide") & ~F.col("_child").isin("*", "**"), F.lit(False))
    return joined.withColumn("template", F.when(change, starred).otherwise(F.col("template"))).drop(
        "_parent", "_child", "_h", "_p", "_wide"
    )


def branching_levels(nodes: DataFrame, children: int) -> list[int]:
    """Levels at which some host has ``children`` different segments. At others no parent
    has so many, now or after segments above or beside have become one."""
    at = nodes.select("host", F.posexplode("template").alias("_level", "_child")).groupBy("host", "_level")
    wide = at.agg(F.count_distinct("_child").alias("_n")).filter(F.col("_n") >= children)
    return sorted(r["_level"] for r in wide.select("_level").distinct().collect())


def is_alike(z_squared: int) -> Column:
    """With pooled counts N and B, a branch belongs to the pool if
    (b/n - B/N)^2 * n <= z^2 * B/N * (1 - B/N), in whole numbers."""
    wide = lambda c: F.col(c).cast("decimal(19,0)")
    gap = wide("b") * wide("_n") - wide("_b") * wide("n")
    return gap * gap <= z_squared * wide("_b") * (wide("_n") - wide("_b")) * wide("n")


def pool_siblings(leaves: DataFrame, z_squared: int) -> DataFrame:
    """``leaves`` with ``n`` and ``b`` pooled over the alike templates of equal parent."""
    leaves = leaves.withColumn("template", F.array_join("template", "/"))
    leaves = leaves.withColumn("parent", F.regexp_replace("template", r"(^|/)[^/]*$", ""))
    pooled = leaves.groupBy(F.col("host").alias("_h"), F.col("parent").alias("_p")).agg(
        F.sum("n").alias("_n"), F.sum("b").alias("_b")
    )
    joined = leaves.join(pooled, (F.col("host") == F.col("_h")) & (F.col("parent") == F.col("_p"))).withColumn(
        "_alike", is_alike(z_squared)
    )
    merged = joined.filter("_alike").groupBy("_h", "_p").agg(F.sum("n").alias("_mn"), F.sum("b").alias("_mb"))
    judged = joined.drop("_h", "_p").join(merged, (F.col("host") == F.col("_h")) & (F.col("parent") == F.col("_p")), "left")
    n = F.when(F.col("_alike"), F.col("_mn")).otherwise(F.col("n"))
    b = F.when(F.col("_alike"), F.col("_mb")).otherwise(F.col("b"))
    return judged.select("host", "template", n.alias("n"), b.alias("b"))


def pool_subtrees(leaves: DataFrame, z_squared: int) -> DataFrame:
    """``leaves`` with ``n`` and ``b`` pooled over the templates that become one when, from
    the deepest level up, the alike subtrees of each parent become one branch."""
    leaves = leaves.withColumn("_branch", F.col("template"))
    for level in reversed(branching_levels(leaves, 2)):
        here = leaves.withColumns(
            {"_parent": F.slice("_branch", 1, level), "_child": F.get("_branch", F.lit(level))}
        )
        subtrees = here.filter(F.col("_child").isNotNull()).groupBy("host", "_parent", "_child").agg(
            F.sum("n").alias("n"), F.sum("b").alias("b")
        )
        pooled = subtrees.groupBy(F.col("host").alias("_h"), F.col("_parent").alias("_p")).agg(
            F.sum("n").alias("_n"), F.sum("b").alias("_b")
        )
        alike = (
            subtrees.join(pooled, (F.col("host") == F.col("_h")) & (F.col("_parent") == F.col("_p")))
            .filter(is_alike(z_squared))
            .select("_h", "_p", F.col("_child").alias("_c"))
        )
        joined = here.join(
            alike, (F.col("host") == F.col("_h")) & (F.col("_parent") == F.col("_p")) & (F.col("_child") == F.col("_c")), "left"
        )
        rest = F.slice("_branch", F.lit(level + 2), F.greatest(F.size("_branch") - (level + 1), F.lit(0)))
        one = F.concat("_parent", F.array(F.lit(MERGED)), rest)
        branch = F.when(F.col("_c").isNotNull(), one).otherwise(F.col("_branch"))
        leaves = cut(joined.select("host", "template", "n", "b", branch.alias("_branch")), "url-branches")
    pooled = leaves.groupBy(F.col("host").alias("_h"), F.col("_branch").alias("_p")).agg(
        F.sum("n").alias("_n"), F.sum("b").alias("_b")
    )
    joined = leaves.join(pooled, (F.col("host") == F.col("_h")) & (F.col("_branch") == F.col("_p")))
    return joined.select("host", F.array_join("template", "/").alias("template"), F.col("_n").alias("n"), F.col("_b").alias("b"))


def judge_templates(
    counted: DataFrame,
    depth: int | None,
    min_children: int,
    max_mean: int,
    prior: int,
    max_bad_percent: int,
    z_squared: int,
    inner: bool = False,
) -> DataFrame:
    """``host``, ``lexical``, ``template`` and ``rejected`` from rows of ``host``,
    ``lexical`` (array of segments), ``pages``, ``labelled`` and ``bad``."""
    nodes = counted.withColumn("template", F.col("lexical"))
    levels = range(depth) if depth is not None else branching_levels(nodes, min_children)
    for done, level in enumerate(levels, 1):
        nodes = generalise(nodes, level, min_children, max_mean)
        if done % 6 == 0 and done < len(levels):  # bounds the plan of very deep paths
            nodes = cut(nodes, "templates")
    nodes = cut(nodes, "templates")
    leaves = nodes.groupBy("host", "template").agg(F.sum("labelled").alias("n"), F.sum("bad").alias("b"))
    judged = pool_subtrees(leaves, z_squared) if inner else pool_siblings(leaves, z_squared)
    nodes = nodes.withColumn("template", F.array_join("template", "/"))
    overall = counted.agg(F.struct(F.sum("labelled").alias("all"), F.sum("bad").alias("bad"))).scalar()
    # (b + prior * share) / (n + prior) >= limit, with share = all_bad / all.
    judged = judged.select("host", "template", "n", "b", overall.alias("_all"))
    smoothed = 100 * (F.col("b") * F.col("_all.all") + prior * F.col("_all.bad")) >= max_bad_percent * F.col("_all.all") * (F.col("n") + prior)
    verdicts = judged.select(
        F.col("host").alias("_vh"), F.col("template").alias("_vt"),
        F.coalesce(smoothed & (F.col("n") > 0), F.lit(False)).alias("rejected"),
    )
    return nodes.join(verdicts, (F.col("host") == F.col("_vh")) & (F.col("template") == F.col("_vt"))).select(
        "host", "lexical", "template", "rejected"
    )


@set_aside
def filter_urls(
    pages: DataFrame,
    labels: DataFrame,
    rules: Sequence[Rule] = RULES,
    depth: int | None = 6,
    min_children: int = 8,
    max_mean: int = 2,
    prior: int = 10,
    max_bad_percent: int = 50,
    z_squared: int = 4,
    inner: bool = False,
) -> DataFrame:
    """``pages`` with ``host``, ``path``, ``template``, ``rule`` and ``verdict``.

    ``depth`` of ``None`` takes whole paths; ``inner`` merges alike subtrees at every level.

    ``labels`` has ``page_id`` and ``bad`` (boolean). Added columns replace input columns
    of the same name.
    """
    added = ["host", "path", "template", "rule", "verdict"]
    own = [c for c in pages.columns if c not in added]
    host, path = url_parts(F.col("url"))
    parted = pages.select(*own).withColumns({"host": host, "path": path})
    ruled = parted.withColumns({"_fit": fitting_rule(rules), "_lexical": segments(F.col("path"), depth)})
    marks = labels.filter("bad is not null").groupBy(F.col("page_id").alias("_id")).agg(
        F.count("*").alias("labelled"), F.count_if("bad").alias("bad")
    )
    slim = ruled.select("page_id", "host", "_lexical")
    counted = cut(
        slim.join(marks, F.col("page_id") == F.col("_id"), "left")
        .groupBy("host", F.col("_lexical").alias("lexical"))
        .agg(
            F.count("*").alias("pages"),
            F.coalesce(F.sum("labelled"), F.lit(0)).alias("labelled"),
            F.coalesce(F.sum("bad"), F.lit(0)).alias("bad"),
        ),
        "url-templates",
    )
    judged = cut(
        judge_templates(counted, depth, min_children, max_mean, prior, max_bad_percent, z_squared, inner), "url-verdicts"
    ).select(F.col("host").alias("_jh"), "lexical", "template", "rejected")
    joined = ruled.join(judged, (F.col("host") == F.col("_jh")) & (F.col("_lexical") == F.col("lexical")), "left")
    own_verdict = F.when(F.coalesce("rejected", F.lit(False)), "block").otherwise("allow")
    return joined.select(
        *own, "host", "path", "template",
        F.col("_fit.rule").alias("rule"), F.coalesce(F.col("_fit.verdict"), own_verdict).alias("verdict"),
    )
