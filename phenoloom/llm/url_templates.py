"""URL filtering by a tree of path templates per host.

A url's path becomes a list of segments. Going down from the root of each host, a segment that varies (its digits, or a
node with many children) becomes a wildcard, and siblings are merged when their labels do not conflict and the
shapes below them are distributed alike: a branch without labels joins the labelled branches that it is most like, unless
it is like bad ones and good ones. Each resulting template has the labelled urls that fell into it; its purity is
the share of bad ones, smoothed towards a small prior, and a template is rejected where that exceeds one half.

All work after the first aggregate is on distinct (host, shape) rows. Edge cases: a null url, or one without ``://``,
has an empty host and path and no rule; templates without labelled urls are allowed; repeated urls count each time.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from phenoloom.llm.frames import stored

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Levels of the tree; what lies deeper is one last segment.
DEPTH = 6
#: A node with more children than this, or whose children are mostly seen once, has a variable segment.
MOST_CHILDREN, SEEN_ONCE = 50, 0.5
#: Weight and value of the prior of a template's share of bad urls, and the share from which it is rejected.
PRIOR_WEIGHT, PRIOR_BAD, REJECT = 4.0, 0.1, 0.5
#: Siblings are alike if their shape distributions differ by less than this plus the sampling error.
ALIKE = 0.1
#: A branch without labels joins labelled ones only if its shapes differ from theirs by less than this, whatever the error.
MOSTLY = 0.5


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host after the first ``://``, lower-cased in A-Z only, and the path up to ``?``, ``#`` or the end."""
    pattern = r"^(?s:.*?)://([^/?#]*)([^?#]*)"
    text = F.coalesce(url, F.lit(""))
    return F.translate(F.regexp_extract(text, pattern, 1), UPPER, LOWER), F.regexp_extract(text, pattern, 2)


def rule_of(host: Column, path: Column, rules: Sequence[str]) -> Column:
    """The longest rule ``host/path`` that fits; null if none does."""
    out = None
    for rule in sorted(rules, key=lambda x: (-len(x), x)):
        name, _, start = rule.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith("/" + start)
        out = F.when(fits, rule) if out is None else out.when(fits, rule)
    return F.lit(None).cast("string") if out is None else out


def segment_shape(segment: Column) -> Column:
    """Digits, long hexadecimal names and uuids are variable wherever they are."""
    hexed = F.regexp_replace(segment, r"(?i)^(?=[^0-9]*[0-9])[0-9a-f]{8,}(-[0-9a-f]{4,})*", "{hex}")
    return F.regexp_replace(hexed, r"[0-9]+", "{n}")


def path_shapes(path: Column, depth: int = DEPTH) -> Column:
    parts = F.transform(F.filter(F.split(path, "/"), lambda x: x != ""), segment_shape)
    deep = F.concat(F.slice(parts, 1, depth - 1), F.array(F.array_join(F.slice(parts, depth, 1_000_000), "/")))
    return F.when(F.size(parts) > depth, deep).otherwise(parts)


def templates(urls: DataFrame, depth: int = DEPTH) -> DataFrame:
    """From ``host, shapes, bad`` (1, 0, or null without a label) to one row per host and shapes: ``template, reject, purity``."""
    tree = stored(
        urls.groupBy("host", "shapes")
        .agg(F.count("*").alias("n"), F.count("bad").alias("labelled"), F.coalesce(F.sum("bad"), F.lit(0)).cast("long").alias("bad"))
        .withColumn("template", F.lit(""))
    )
    deepest = min(depth, tree.agg(F.max(F.size("shapes"))).first()[0] or 0)
    for level in range(1, deepest + 1):
        tree = stored(_one_level(tree, level))
    node = ["host", "template"]
    judged = tree.groupBy(*node).agg(F.sum("labelled").alias("labelled"), F.sum("bad").alias("bad"))
    purity = (F.col("bad") + PRIOR_WEIGHT * PRIOR_BAD) / (F.col("labelled") + PRIOR_WEIGHT)
    judged = judged.select(*node, purity.alias("purity"), (purity > REJECT).alias("reject"))
    return tree.select("host", "shapes", "template").join(judged, node)


def _one_level(tree: DataFrame, level: int) -> DataFrame:
    """Extend each template by the segment of this level, generalised and merged with its like."""
    here = F.get("shapes", F.lit(level - 1))
    below = F.array_join(F.transform(F.slice("shapes", level + 1, DEPTH), lambda x: F.regexp_replace(x, r"\p{L}+", "a")), "/")
    rows = tree.withColumn("child", here).withColumn("below", below)
    parent, node = ["host", "template"], ["host", "template", "child"]
    alive = rows.where(F.col("child").isNotNull())

    children = alive.groupBy(*node).agg(F.sum("n").alias("n"), F.sum("labelled").alias("labelled"), F.sum("bad").alias("bad"))
    varied = children.groupBy(*parent).agg(
        F.count("*").alias("kinds"), F.avg((F.col("n") == 1).cast("double")).alias("once")
    )
    varied = varied.select(*parent, ((F.col("kinds") > MOST_CHILDREN) | ((F.col("kinds") >= 10) & (F.col("once") > SEEN_ONCE))).alias("variable"))

    # evidence of the labels: the Wilson interval of the share of bad ones lies on one side of a half, or is open
    share, m, z = F.col("bad") / F.greatest("labelled", F.lit(1)), F.greatest("labelled", F.lit(1)), 1.96
    centre = (share + z * z / (2 * m)) / (1 + z * z / m)
    half = z * F.sqrt(share * (1 - share) / m + z * z / (4 * m * m)) / (1 + z * z / m)
    evidence = F.when(F.col("labelled") == 0, "none").when(centre - half > 0.5, "bad").when(centre + half < 0.5, "good").otherwise("open")
    children = children.withColumn("evidence", evidence)

    # total variation between the shapes below a child and those below all children of a kind: the child's own evidence,
    # or any evidence if it has no labels
    kind = [*parent, "kind"]
    seen = alive.groupBy(*node, "below").agg(F.sum("n").alias("k")).join(children.select(*node, "n", "evidence"), node)
    pooled = seen.groupBy(*parent, F.col("evidence").alias("kind"), "below").agg(F.sum("k").alias("pk"))
    sizes = pooled.groupBy(*kind).agg(F.sum("pk").alias("pn"))
    away = (
        seen.join(sizes, parent)
        .where((F.col("evidence") == F.col("kind")) | (F.col("evidence") == "none"))
        .join(pooled, [*kind, "below"], "left")
        .withColumn("pk", F.coalesce("pk", F.lit(0)))
        .groupBy(*node, "kind")
        .agg(
            # shapes the child lacks count through 1 - (their pooled share that it has)
            ((F.sum(F.abs(F.col("k") / F.col("n") - F.col("pk") / F.col("pn"))) + 1 - F.sum(F.col("pk") / F.col("pn"))) / 2).alias("away"),
            (F.sqrt(F.count("*") / F.max("n"))).alias("noise"),
        )
        .withColumn("like", F.col("away") <= ALIKE + F.col("noise"))
    )
    # a few pages are like anything within the sampling error; to join labels most of their shapes must be known there
    near = F.col("like") & (F.col("away") < MOSTLY)
    joins = F.when(near & (F.col("kind") != "none"), F.struct("away", "kind", "like"))
    own = children.select(*node, "evidence")
    chosen = (
        away.join(own, node)
        .groupBy(*node)
        .agg(
            F.min(joins).alias("_joined"),
            F.min(F.when(F.col("kind") == F.col("evidence"), F.struct("away", "kind", "like"))).alias("_own"),
            F.count_if(near & F.col("kind").isin("bad", "good")).alias("_sides"),
        )
        .withColumn("_taken", F.when(F.col("_sides") < 2, F.coalesce("_joined", "_own")).otherwise(F.col("_own")))
        .select(*node, F.col("_taken.kind").alias("kind"), F.col("_taken.like").alias("like"))
    )
    merged = (
        children.join(varied, parent)
        .join(chosen, node)
        .withColumn("first", F.min(F.when(F.col("like"), F.col("child"))).over(Window.partitionBy(*kind)))
        .withColumn("many", F.sum(F.col("like").cast("int")).over(Window.partitionBy(*kind)) > 1)
    )
    name = F.when(F.col("variable"), F.concat(F.lit("*"), F.when(F.col("kind").isin("bad", "good"), F.concat(F.lit(":"), F.col("kind"))).otherwise("")))
    name = name.when(F.col("like") & F.col("many"), F.concat(F.lit("~"), F.col("first"))).otherwise(F.col("child"))
    names = merged.select(*node, name.alias("_name"))
    out = rows.join(names, node, "left")
    longer = F.when(F.col("child").isNull(), F.col("template")).otherwise(F.concat(F.col("template"), F.lit("/"), F.col("_name")))
    return out.select("host", "shapes", "n", "labelled", "bad", longer.alias("template"))


def judge(pages: DataFrame, rules: dict[str, str], labels: DataFrame | None = None, key: str = "page_id", url: str = "url") -> DataFrame:
    """Verdict per page. ``rules`` maps ``host/path`` to ``allow`` or ``block``; they decide their urls and label them.

    ``labels`` (``key, bad``) may label further urls. Returns ``key, host, path, rule, verdict, template, purity``.
    """
    host, path = host_and_path(F.col(url))
    rows = pages.select(key, host.alias("host"), path.alias("path"))
    rows = rows.withColumn("rule", rule_of(F.col("host"), F.col("path"), list(rules))).withColumn("shapes", path_shapes(F.col("path")))
    ruled = F.when(F.col("rule").isin([k for k, v in rules.items() if v == "block"]), 1).when(F.col("rule").isNotNull(), 0)
    if labels is None:
        learned = rows.withColumn("bad", ruled)
    else:
        mine = labels.groupBy(key).agg(F.max("bad").alias("_bad"))
        learned = rows.join(mine, key, "left").withColumn("bad", F.coalesce(ruled, F.col("_bad")))
    tree = templates(learned.select("host", "shapes", "bad"))
    verdict = (
        F.when(F.col("rule").isin([k for k, v in rules.items() if v == "block"]), "block")
        .when(F.col("rule").isNotNull(), "allow")
        .otherwise(F.when(F.col("reject"), "block").otherwise("allow"))
    )
    out = rows.join(tree, ["host", "shapes"], "left")
    return out.select(key, "host", "path", "rule", verdict.alias("verdict"), "template", "purity")
