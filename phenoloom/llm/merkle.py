"""A Merkle manifest of a dataset with one proof for every row, made by octopus multiproofs.

A leaf is the sha256 of a row's fields. The leaves of a group stand in the order of their key and form a tree: every
``FANOUT`` consecutive nodes become the hash of their digests until one is left; the last of a level may have fewer
children, even one. The trees of the groups are the leaves of one more tree, in the order of the groups.

Leaves are ranked over range slices, so a group of any size is spread over tasks, and gathered in partitions of
``PARTITION`` consecutive leaves, one stored row each. A partition climbs to its own top; only tops go on, level by level,
until every tree has its root. For the proofs each partition acts as an octopus: from the positions that it holds it works
out level by level which sibling nodes it cannot derive, up to the root of all; this minimal union of coordinates, a few
dozen for a whole partition, is fetched by one join. What its leaves share it derives once, and each leaf's own proof is
written out from there, in the task.

Edge cases: null fields count as ``-``; null groups come first, null keys first in their group; equal keys stand in the
order of their leaves, so rows equal in all fields have equal leaves and may change places; a lone leaf is its tree's root
and has no siblings there; an empty table gives no rows; other columns are not read, so they may have any names.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from phenoloom.llm.frames import small, stored
from phenoloom.session import ordered_slices

FANOUT = 8
#: Levels of the tree within a partition, and the leaves of a partition.
INNER = 3
PARTITION = FANOUT**INNER
#: The tree over the groups; a group's own tree is named ``-`` or a colon and the group.
ALL = "*"

_NODE = "tree string, level int, place bigint, digest string"


def leaf_digest(*fields: Column) -> Column:
    """Hash of fields: ``-`` for a null, else the number of UTF-8 bytes, a colon and the value."""
    parts = []
    for f in fields:
        value = f.cast("string")
        parts.append(F.when(value.isNull(), "-").otherwise(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value)))
    return F.sha2(F.concat(*parts), 256)


def digest(nodes: list[str]) -> str:
    return sha256("".join(nodes).encode()).hexdigest()


def depth(leaves: int) -> int:
    """Levels above the leaves of a tree."""
    levels = 0
    while leaves > 1:
        leaves, levels = -(-leaves // FANOUT), levels + 1
    return levels


def climb(nodes: list[str], levels: int) -> list[list[str]]:
    """The nodes of a partition level by level, its leaves first."""
    out = [nodes]
    for _ in range(levels):
        out.append([digest(out[-1][i : i + FANOUT]) for i in range(0, len(out[-1]), FANOUT)])
    return out


def missing(places: list[int], leaves: int) -> list[tuple[int, int]]:
    """``(level, place)`` of the fewest nodes that a holder of the leaves at ``places`` needs to derive the root."""
    known, out, level = sorted(set(places)), [], 0
    while leaves > 1:
        held = set(known)
        known = sorted({p // FANOUT for p in known})
        for parent in known:
            out += [(level, p) for p in range(parent * FANOUT, min((parent + 1) * FANOUT, leaves)) if p not in held]
        leaves, level = -(-leaves // FANOUT), level + 1
    return out


def fold(node: str, place: int, siblings: list[list[str]]) -> str:
    """The root that a node and the siblings of each level lead to."""
    for others in siblings:
        at = place % FANOUT
        node = digest([*others[:at], node, *others[at:]])
        place //= FANOUT
    return node


def ranked(df: DataFrame, by: Column, order: list[Column], out: str = "place") -> DataFrame:
    """Add each row's place (from 0) in its group ``by`` and the group's size, over range slices that may cut any group.

    Rows that tie get their places in any order. The slices are written, so their bounds are sampled once.
    """
    numbered = stored(df.withColumn("_by", by).withColumn("_tie", F.monotonically_increasing_id()))
    keys = [F.col("_by").asc_nulls_first(), *order, F.col("_tie")]
    sliced = stored(numbered.repartitionByRange(ordered_slices(df.sparkSession), *keys).withColumn("_slice", F.spark_partition_id()))
    counts = sliced.groupBy("_by", "_slice").agg(F.count("*").alias("_n"))
    group = Window.partitionBy("_by")
    before = F.sum("_n").over(group.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.select(F.col("_by").alias("_of"), F.col("_slice").alias("_in"), F.coalesce(before, F.lit(0)).alias("_before"), F.sum("_n").over(group).alias("n_leaves"))
    inner = Window.partitionBy("_by", "_slice").orderBy(*order, "_tie")
    rows = sliced.withColumn("_r", F.row_number().over(inner))
    joined = rows.join(offsets, F.col("_by").eqNullSafe(F.col("_of")) & (F.col("_slice") == F.col("_in")))
    return joined.select(*df.columns, (F.col("_before") + F.col("_r") - 1).alias(out), "n_leaves")


def partitions(leaves: DataFrame) -> DataFrame:
    """``tree, part, n_leaves, rows``: stored rows of up to ``PARTITION`` consecutive ``(place, leaf, ...)``."""
    fields = [c for c in leaves.columns if c not in ("tree", "n_leaves", "place")]
    at = F.floor(F.col("place") / PARTITION)
    rows = F.sort_array(F.collect_list(F.struct("place", *fields)))
    return stored(leaves.groupBy("tree", at.alias("part"), "n_leaves").agg(rows.alias("rows")))


def nodes_above(parts: DataFrame) -> DataFrame:
    """``tree, level, place, digest, n_leaves``: the stored nodes of all trees from the tops of partitions to the roots."""
    spark = parts.sparkSession

    def tops(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for tree, part, n, rows in zip(*[batch.column(i).to_pylist() for i in range(4)], strict=True):
                levels = min(INNER, depth(n))
                out.append((tree, levels, part, climb(rows, levels)[-1][0], n))
            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r, strict=True)) for r in out], schema=schema)

    schema = pa.schema([("tree", pa.string()), ("level", pa.int32()), ("place", pa.int64()), ("digest", pa.string()), ("n_leaves", pa.int64())])
    leaves = parts.select("tree", "part", "n_leaves", F.transform("rows", lambda r: r["leaf"]).alias("leaves"))
    level = stored(leaves.mapInArrow(tops, f"{_NODE}, n_leaves bigint"))
    steps, width, at = [level], PARTITION, INNER
    most = parts.agg(F.max("n_leaves")).first()[0] or 0
    while width < most:
        group = level.where(F.col("n_leaves") > width).groupBy("tree", F.floor(F.col("place") / FANOUT).alias("up"), "n_leaves")
        nodes = F.sort_array(F.collect_list(F.struct("place", "digest")))
        hashed = F.sha2(F.array_join(F.transform(nodes, lambda x: x["digest"]), ""), 256)
        at, width = at + 1, width * FANOUT
        level = stored(group.agg(hashed.alias("digest")).select("tree", F.lit(at).alias("level"), F.col("up").alias("place"), "digest", "n_leaves"))
        steps.append(level)
    out = steps[0]
    for step in steps[1:]:
        out = out.unionByName(step)
    return out


def roots(nodes: DataFrame) -> DataFrame:
    """``tree, digest``: a tree's only node on the level that is its depth."""
    levels = F.aggregate(F.sequence(F.lit(1), F.lit(21)), F.lit(0), lambda d, i: d + (F.pow(F.lit(float(FANOUT)), i - 1) < F.col("n_leaves")).cast("int"))
    return nodes.where(F.col("level") == levels).select("tree", "digest")


def proofs(parts: DataFrame, nodes: DataFrame, groups: DataFrame) -> DataFrame:
    """``part`` rows with ``fetched``: the nodes that the octopus of each partition asked for, in its group's tree and in the tree of all.

    ``groups`` has ``tree``, its ``place`` among ``n_groups`` and its root ``subroot``.
    """

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for tree, part, n, place, n_groups in zip(*[batch.column(i).to_pylist() for i in range(5)], strict=True):
                held = list(range(part * PARTITION, min((part + 1) * PARTITION, n)))
                for of, wanted in ((tree, missing(held, n)), (ALL, missing([place], n_groups))):
                    out += [(tree, part, of, level, p) for level, p in wanted]
            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r, strict=True)) for r in out], schema=schema)

    schema = pa.schema([("asker", pa.string()), ("part", pa.int64()), ("tree", pa.string()), ("level", pa.int32()), ("place", pa.int64())])
    placed = parts.join(small(groups), "tree")
    wanted = stored(placed.select("tree", "part", "n_leaves", "group_place", "n_groups").mapInArrow(ask, "asker string, part bigint, tree string, level int, place bigint"))
    found = wanted.join(small(nodes.select("tree", "level", "place", "digest")), ["tree", "level", "place"])
    node = F.struct((F.col("tree") == ALL).alias("above"), "level", "place", "digest")
    fetched = found.groupBy(F.col("asker").alias("tree"), "part").agg(F.sort_array(F.collect_list(node)).alias("fetched"))
    return placed.join(fetched, ["tree", "part"], "left")


def manifest(docs: DataFrame, key: str, group: str, leaf: Column, claimed: Column | None = None) -> DataFrame:
    """One row per document: ``key, leaf, subroot, root, proof, proof_sha256, folded_root, verified``.

    ``leaf`` is the digest of a row (see ``leaf_digest``); ``key`` orders the leaves of a ``group``. The proof holds the siblings
    level by level, from the leaf to its group's root and on to the root of all. ``claimed`` is the leaf as somebody
    presents it (null: as it is): ``folded_root`` is what it and the proof lead to, and ``verified`` says whether that is
    the root.
    """
    tree = F.when(F.col("_group").isNull(), "-").otherwise(F.concat(F.lit(":"), F.col("_group")))
    shown = F.lit(None).cast("string") if claimed is None else claimed
    rows = docs.select(F.col(group).cast("string").alias("_group"), F.col(key).alias("_key"), leaf.alias("leaf"), shown.alias("claimed"))
    leaves = ranked(rows, F.col("_group"), [F.col("_key").asc_nulls_first(), F.col("leaf")])
    parts = partitions(leaves.select(tree.alias("tree"), "n_leaves", "place", "leaf", "claimed", "_key"))
    nodes = nodes_above(parts)
    subroots = stored(roots(nodes))
    # '-' comes before ':' and names keep their bytewise order behind it
    of_all = ranked(subroots.withColumnRenamed("digest", "leaf"), F.lit(ALL), [F.col("tree")])
    of_all = stored(of_all.withColumnRenamed("place", "group_place").withColumnRenamed("n_leaves", "n_groups"))
    above = _all_nodes(of_all)
    root = above.orderBy(F.desc("level")).select("digest").first()
    asked = proofs(parts, nodes.select("tree", "level", "place", "digest").unionByName(above), of_all.withColumnRenamed("leaf", "subroot"))
    kind = docs.schema[key].dataType.simpleString()
    out = asked.mapInArrow(_expander(root["digest"] if root else "", docs.schema[key].dataType), f"k {kind}, leaf string, subroot string, root string, proof array<string>, proof_sha256 string, folded_root string, verified boolean")
    return out.withColumnRenamed("k", key)


def _all_nodes(of_all: DataFrame) -> DataFrame:
    """Every node of the tree over the groups, its leaves included."""
    level = of_all.select(F.lit(ALL).alias("tree"), F.lit(0).alias("level"), F.col("group_place").alias("place"), F.col("leaf").alias("digest"))
    out, at = level, 0
    width = of_all.agg(F.max("n_groups")).first()[0] or 0
    while width > 1:
        nodes = F.sort_array(F.collect_list(F.struct("place", "digest")))
        hashed = F.sha2(F.array_join(F.transform(nodes, lambda x: x["digest"]), ""), 256)
        at, width = at + 1, -(-width // FANOUT)
        level = stored(level.groupBy(F.floor(F.col("place") / FANOUT).alias("up")).agg(hashed.alias("digest")).select(F.lit(ALL).alias("tree"), F.lit(at).alias("level"), F.col("up").alias("place"), "digest"))
        out = out.unionByName(level)
    return stored(out)


def _expander(root: str, kind):
    from pyspark.sql.pandas.types import to_arrow_type

    schema = pa.schema(
        [("k", to_arrow_type(kind)), ("leaf", pa.string()), ("subroot", pa.string()), ("root", pa.string()), ("proof", pa.list_(pa.string())),
         ("proof_sha256", pa.string()), ("folded_root", pa.string()), ("verified", pa.bool_())]
    )

    def siblings(level: list[str], at: int) -> list[str]:
        first = at // FANOUT * FANOUT
        return level[first:at] + level[at + 1 : first + FANOUT]

    def expand(row: dict) -> Iterator[tuple]:
        n, part = row["n_leaves"], row["part"]
        inner = min(INNER, depth(n))
        shared = climb([r["leaf"] for r in row["rows"]], inner)
        outer: list[list[str]] = [[] for _ in range(depth(n) - inner + depth(row["n_groups"]))]
        for x in row["fetched"] or []:
            outer[depth(n) - inner + x["level"] if x["above"] else x["level"] - inner].append(x["digest"])
        for i, r in enumerate(row["rows"]):
            near = [siblings(shared[k], i // FANOUT**k) for k in range(inner)]
            flat = [x for others in [*near, *outer] for x in others]
            node = r["claimed"] or r["leaf"]
            tree = fold(node, r["place"], [*near, *outer[: depth(n) - inner]])
            folded = fold(tree, row["group_place"], outer[depth(n) - inner :])
            yield r["_key"], r["leaf"], row["subroot"], root, flat, digest(flat), folded, folded == root

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                rows = list(zip(*expand(batch.slice(i, 1).to_pylist()[0]), strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(rows, schema, strict=True)], schema=schema)

    return each
