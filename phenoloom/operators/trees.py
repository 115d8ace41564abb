"""Trees grown level by level on histograms: second-order boosting and bagged forests.

Every feature is cut into at most ``MAX_BINS`` bins by a mergeable quantile sketch, and every row keeps its bins. A level
of all trees is then one grouped aggregate: tasks add up the two statistics of the rows of every open node by feature and
bin, the partial sums are shuffled, and running sums over bins give the gain of every cut. What reaches the driver is one
best cut per open node, and what is sent back are the nodes, so both are as large as the model and not as the data. Sums of
more than ``CELLS`` cells are made in several passes over disjoint nodes.

The two statistics ``a`` and ``b`` of a node give its score ``a^2 / (b + l2)``; a cut gains what the children's scores add up
to above the parent's. Boosting puts the gradient and the Hessian of the log loss there, so that a leaf is the Newton step
``-a / (b + l2)``; a forest puts the weight of the cases and of all rows, which makes the gain half the decrease of the Gini
impurity and a leaf the share of cases. Missing values (null or NaN) go to the side where they gain more.

A forest can also draw a shadow of each feature in every node: the cases of the node are dealt anew to the bins of the
feature, whose sums are all that this takes. A shadow has the feature's bins and no relation to the outcome, so what it
gains is what the feature would gain by chance (see :func:`shadowed_forest`).

Which rows a tree is grown on follows from a hash of the row and the number of the tree, so a row's trees are known later
on: a forest is scored out of bag by the very trees that it consists of.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml import Transformer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.param import Param, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

from phenoloom.session import materialise

MAX_BINS = 64
#: Sums that a task holds at once.
CELLS = 2_000_000
#: Rounds of boosting after which the margins are written; in between, tasks walk the trees since then.
REFRESH = 10
#: Cuts must gain more; equal gains (to so many decimals) go to the first feature, then the lowest cut.
LEAST_GAIN, GAIN_DIGITS = 1e-9, 9
_MISSING = -1


# --- trees as flat arrays --------------------------------------------------------------------------------------------


@dataclass
class Trees:
    """Nodes of several trees end to end. ``feature`` is -1 in a leaf; children are places in the same arrays."""

    roots: list[int] = field(default_factory=list)
    feature: list[int] = field(default_factory=list)
    cut: list[int] = field(default_factory=list)
    threshold: list[float] = field(default_factory=list)
    missing_left: list[bool] = field(default_factory=list)
    left: list[int] = field(default_factory=list)
    right: list[int] = field(default_factory=list)
    value: list[float] = field(default_factory=list)
    gain: list[float] = field(default_factory=list)
    cover: list[float] = field(default_factory=list)
    rows: list[float] = field(default_factory=list)

    def add(self, value: float, cover: float, rows: float) -> int:
        for name, x in (("feature", -1), ("cut", 0), ("threshold", 0.0), ("missing_left", False), ("left", -1), ("right", -1), ("value", value), ("gain", 0.0), ("cover", cover), ("rows", rows)):
            getattr(self, name).append(x)
        return len(self.feature) - 1

    def part(self, first: int) -> Trees:
        """The trees from number ``first`` on, with their nodes moved to the front."""
        if not self.roots[first:]:
            return Trees()
        at = self.roots[first]
        out = Trees([r - at for r in self.roots[first:]])
        for name in ("feature", "cut", "threshold", "missing_left", "value", "gain", "cover", "rows"):
            setattr(out, name, getattr(self, name)[at:])
        out.left, out.right = [x - at for x in self.left[at:]], [x - at for x in self.right[at:]]
        return out

    def append(self, other: Trees) -> None:
        at = len(self.feature)
        self.roots += [r + at for r in other.roots]
        for name in ("feature", "cut", "threshold", "missing_left", "value", "gain", "cover", "rows"):
            getattr(self, name).extend(getattr(other, name))
        self.left += [x + at for x in other.left]
        self.right += [x + at for x in other.right]

    def prune(self, root: int, least: float) -> None:
        """From the leaves up, take back cuts between two leaves that gain less than ``least``."""
        order, at = [root], 0
        while at < len(order):
            if self.feature[order[at]] >= 0:
                order += [self.left[order[at]], self.right[order[at]]]
            at += 1
        for n in reversed(order):
            if self.feature[n] >= 0 and self.feature[self.left[n]] < 0 and self.feature[self.right[n]] < 0 and self.gain[n] < least:
                self.feature[n], self.gain[n] = -1, 0.0

    def importances(self, width: int) -> np.ndarray:
        """Each feature's share of the gain, averaged over the trees that have any."""
        total = np.zeros(width)
        bounds = [*self.roots, len(self.feature)]
        for a, b in zip(bounds, bounds[1:]):
            f, g = np.array(self.feature[a:b]), np.array(self.gain[a:b])
            own = np.bincount(f[f >= 0], g[f >= 0], minlength=width)[:width]
            if own.sum() > 0:
                total += own / own.sum()
        return total / total.sum() if total.sum() > 0 else total

    def table(self) -> list[tuple]:
        """``(tree, node, feature, threshold, missing_left, left, right, value, gain, cover, rows)``, nodes numbered within trees."""
        bounds = [*self.roots, len(self.feature)]
        out = []
        for t, (a, b) in enumerate(zip(bounds, bounds[1:])):
            for n in range(a, b):
                inner = self.feature[n] >= 0
                out.append((t, n - a, self.feature[n], self.threshold[n] if inner else None, self.missing_left[n] if inner else None,
                            self.left[n] - a if inner else None, self.right[n] - a if inner else None, self.value[n], self.gain[n], self.cover[n], self.rows[n]))
        return out


TABLE_SCHEMA = "tree int, node int, feature int, threshold double, missing_left boolean, left int, right int, value double, gain double, cover double, rows double"


class Walker:
    """Leads rows of bins, or of values, through trees."""

    def __init__(self, trees: Trees):
        self.roots = trees.roots
        self.feature, self.cut = np.array(trees.feature, np.int64), np.array(trees.cut, np.int64)
        self.threshold, self.missing_left = np.array(trees.threshold, float), np.array(trees.missing_left, bool)
        self.left, self.right = np.array(trees.left, np.int64), np.array(trees.right, np.int64)
        self.value = np.array(trees.value, float)

    def leaves(self, tree: int, data: np.ndarray, binned: bool) -> np.ndarray:
        at = np.full(len(data), self.roots[tree], np.int64)
        moving = np.arange(len(data))
        while True:
            moving = moving[self.feature[at[moving]] >= 0]
            if not len(moving):
                return at
            node = at[moving]
            x = data[moving, self.feature[node]]
            gone = (x == _MISSING) if binned else np.isnan(x)
            with np.errstate(invalid="ignore"):
                low = x <= (self.cut[node] if binned else self.threshold[node])
            at[moving] = np.where(np.where(gone, self.missing_left[node], low), self.left[node], self.right[node])


def matrix_of(column: pa.Array, width: int, kind: type) -> np.ndarray:
    """A list column of equal lengths as a matrix; nulls become NaN or the bin of missing values."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten()
    if flat.null_count:
        flat = flat.fill_null(float("nan") if kind is float else _MISSING)
    return flat.to_numpy(zero_copy_only=False).astype(kind, copy=False).reshape(-1, width)


# --- chance as a hash ------------------------------------------------------------------------------------------------


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def uniform(rows: np.ndarray, tree: int) -> np.ndarray:
    """A number in [0, 1) for each row hash and one tree."""
    salt = np.uint64((tree + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
    return (mixed(mixed(rows.view(np.uint64) + salt)) >> np.uint64(11)).astype(float) * 2.0**-53


_POISSON = np.cumsum([math.exp(-1.0) / math.factorial(k) for k in range(20)])


def times_drawn(rows: np.ndarray, tree: int, how: str, share: float) -> np.ndarray:
    """How often a tree sees each row: a Poisson(1) count, or once for a share of the rows."""
    if how == "bag":
        return np.searchsorted(_POISSON, uniform(rows, tree), side="right").astype(float)
    return np.ones(len(rows)) if share >= 1 else (uniform(rows, tree) < share).astype(float)


def columns_drawn(seed: int, tree: int, node: int | None, width: int, n: int) -> np.ndarray:
    if n >= width:
        return np.arange(width)
    return np.sort(np.random.default_rng([seed, tree, 0 if node is None else node + 1]).choice(width, n, replace=False))


# --- bins ------------------------------------------------------------------------------------------------------------


def bin_edges(frame: DataFrame, features: str = "features", bins: int = MAX_BINS, accuracy: int = 10_000) -> list[list[float]]:
    """Upper edges of each feature's bins but the last: values of the data at even steps of its distribution.

    Four times as many steps as bins are asked of the sketch. If they hold few values, each has a bin of its own.
    """
    if not 2 <= bins <= 30_000:
        raise ValueError("bins must lie between 2 and 30,000")
    cells = frame.select(F.posexplode(features).alias("feature", "value")).where("value is not null and not isnan(value)")
    steps = [i / (4 * bins) for i in range(4 * bins + 1)]
    asked = cells.groupBy("feature").agg(F.array_distinct(F.percentile_approx("value", steps, accuracy)).alias("q")).collect()
    width = frame.select(F.max(F.size(features)).alias("n")).first()["n"] or 0
    out: list[list[float]] = [[] for _ in range(width)]
    for r in asked:
        values = sorted(r["q"])
        if len(values) > bins:
            values = sorted({values[round(i * (len(values) - 1) / bins)] for i in range(1, bins + 1)})
        out[r["feature"]] = values[:-1]
    return out


def binned(frame: DataFrame, edges: list[list[float]], keep: Sequence[Column], features: str = "features") -> DataFrame:
    """``keep`` and ``bins``: the number of edges below each value, -1 where it is missing."""
    width, arrays = len(edges), [np.array(e, float) for e in edges]

    @F.pandas_udf("array<smallint>")
    def place(x: pd.Series) -> pd.Series:
        if not len(x):
            return pd.Series([], dtype=object)
        m = np.stack([np.asarray([math.nan if v is None else v for v in r] if r.dtype == object else r, float) for r in x])
        out = np.empty((len(x), width), np.int16)
        for j, e in enumerate(arrays):
            out[:, j] = np.searchsorted(e, m[:, j], side="left")
        out[np.isnan(m)] = _MISSING
        return pd.Series(list(out))

    return frame.select(*keep, place(F.col(features)).alias("bins"))


# --- growing ---------------------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Rules:
    """When a node may be cut. ``depth`` None means without limit; ``columns`` are drawn per tree, or per node."""

    depth: int | None = 6
    l2: float = 1.0
    least_child_weight: float = 1.0
    least_child_rows: float = 1.0
    least_split_rows: float = 2.0
    columns: int | None = None
    per_node: bool = False
    how: str = "share"
    share: float = 1.0
    newton: bool = True
    seed: int = 0
    shadows: bool = False

    def leaf(self, a: float, b: float) -> float:
        if b + self.l2 <= 0:
            return 0.0
        # a share may leave [0, 1] by rounding, as the right child is what the left one leaves
        return -a / (b + self.l2) if self.newton else min(max(a / (b + self.l2), 0.0), 1.0)


def _sums(rules: Rules, trees: Trees, numbers: list[int], slots: dict[int, int], drawn: np.ndarray, width: int, bins: int, stats):
    """Partial sums ``(slot, feature, bin, a, b, n)`` of the rows in the open nodes ``slots``."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        walker = Walker(trees)
        slot_of = np.full(len(trees.feature), -1, np.int64)
        slot_of[list(slots)] = list(slots.values())
        per = drawn.shape[1]
        cells = len(slots) * per * (bins + 1)
        sums = np.zeros((3, cells))
        for batch in batches:
            if not batch.num_rows:
                continue
            data = matrix_of(batch.column(batch.schema.get_field_index("bins")), width, np.int64)
            hashes = batch.column(batch.schema.get_field_index("row_hash")).to_numpy(zero_copy_only=False)
            a, b = stats(batch, data)
            for t, number in enumerate(numbers):
                times = times_drawn(hashes, number, rules.how, rules.share)
                used = np.flatnonzero(times)
                slot = slot_of[walker.leaves(t, data[used], True)]
                used, slot = used[slot >= 0], slot[slot >= 0]
                if not len(used):
                    continue
                at = (slot[:, None] * per + np.arange(per)) * (bins + 1) + np.take_along_axis(data[used], drawn[slot], 1) + 1
                for k, x in enumerate((times[used] * a[used], times[used] * b[used], times[used])):
                    sums[k] += np.bincount(at.ravel(), np.repeat(x, per), minlength=cells)
        full = np.flatnonzero(sums[2])
        slot, rest = np.divmod(full, per * (bins + 1))
        j, b = np.divmod(rest, bins + 1)
        for i in range(0, len(full), 50_000):
            s = slice(i, i + 50_000)
            yield pa.RecordBatch.from_arrays(
                [pa.array(slot[s], pa.int32()), pa.array(drawn[slot[s], j[s]], pa.int32()), pa.array(b[s] - 1, pa.int32()), *[pa.array(x[full[s]]) for x in sums]],
                names=["slot", "feature", "bin", "a", "b", "n"],
            )

    return each


#: Rows of a node below which its cases are dealt to bins exactly; above, by the normal limit of each bin's share.
EXACT_DEAL = 10**9


def dealt(rows: np.ndarray, cases: int, rng: np.random.Generator, exact_below: int = EXACT_DEAL) -> np.ndarray:
    """``cases`` of all ``rows``, drawn without return: how many fall into each bin of so many rows."""
    total = int(rows.sum())
    if total < exact_below:
        return rng.multivariate_hypergeometric(rows, cases, method="marginals")
    out, left, rest = np.zeros(len(rows), np.int64), cases, total
    for i, n in enumerate(rows.tolist()):
        share = n / rest if rest else 0.0
        spread = math.sqrt(max(0.0, left * share * (1 - share) * (rest - left) / max(1, rest - 1)))
        out[i] = min(max(round(rng.normal(left * share, spread)), left - (rest - n), 0), n, left)
        left, rest = left - int(out[i]), rest - n
    return out


def shadow_cases(slot: np.ndarray, feature: np.ndarray, bin_: np.ndarray, a: np.ndarray, n: np.ndarray, salts: dict[int, tuple[int, int]], seed: int) -> np.ndarray:
    """The cases of each node dealt anew to the bins of each of its features, in the order of the bins.

    Chance is a hash of the seed, the tree and node that ``salts`` names, and the feature, so a lost task repeats it.
    """
    out = np.zeros(len(a))
    order = np.lexsort((bin_, feature, slot))
    first = np.flatnonzero(np.r_[True, (np.diff(slot[order]) != 0) | (np.diff(feature[order]) != 0)]) if len(order) else []
    for at in np.split(order, first[1:]) if len(order) else []:
        tree, node = salts[int(slot[at[0]])]
        rng = np.random.default_rng([seed, tree, node, int(feature[at[0]])])
        out[at] = dealt(np.rint(n[at]).astype(np.int64), round(a[at].sum()), rng)
    return out


def best_cuts(sums: DataFrame, rules: Rules, salts: dict[int, tuple[int, int]] | None = None) -> DataFrame:
    """From partial sums by (slot, feature, bin): each node's totals and best cut, once for every part of its features.

    The sums of a feature of a node meet in one partition, which runs over its bins and keeps the best cut of each node;
    so a partition returns one row for a node at most. Totals are those of the first feature there. With ``salts`` (tree and
    node of each slot) also the best cut's feature and gain among the shadows, whose rows are counts and cases whole numbers.
    """
    met = sums.repartition("slot", "feature").groupBy("slot", "feature", "bin").agg(*[F.sum(c).alias(c) for c in ("a", "b", "n")])
    schema = "slot int, first int, ta double, tb double, tn double, feature int, cut int, missing_left boolean, gain double, a double, b double, n double"
    schema += ", shadow_feature int, shadow_gain double" if salts is not None else ""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(list(batches)) if (batches := [b for b in batches if b.num_rows]) else None
        if table is not None:
            cells = [table.column(c).to_numpy() for c in ("slot", "feature", "bin", "a", "b", "n")]
            best = _best_of(*cells, rules)
            if salts is not None:
                slot, feature, bin_, a, b, n = cells
                shadow = _best_of(slot, feature, bin_, shadow_cases(slot, feature, bin_, a, n, salts, rules.seed), b, n, rules)
                best += [shadow[5], shadow[8]]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in best], names=[c.split()[0] for c in schema.split(", ")])

    return met.mapInArrow(each, schema)


def _best_of(slot: np.ndarray, feature: np.ndarray, bin_: np.ndarray, a: np.ndarray, b: np.ndarray, n: np.ndarray, rules: Rules) -> list[np.ndarray]:
    order = np.lexsort((bin_, feature, slot))
    slot, feature, bin_, stats = slot[order], feature[order], bin_[order], np.stack([a, b, n])[:, order]
    first = np.flatnonzero(np.r_[True, (slot[1:] != slot[:-1]) | (feature[1:] != feature[:-1])])
    run = np.repeat(np.arange(len(first)), np.diff(np.r_[first, len(slot)]))
    gone = bin_ < 0
    total = np.add.reduceat(stats, first, axis=1)
    missing = np.add.reduceat(np.where(gone, stats, 0.0), first, axis=1)
    upto = np.cumsum(np.where(gone, 0.0, stats), axis=1)
    low = upto - (upto[:, first] - np.where(gone, 0.0, stats)[:, first])[:, run]

    def score(x: np.ndarray) -> np.ndarray:
        weight = x[1] + rules.l2
        return np.where(weight > 0, x[0] * x[0] / np.where(weight > 0, weight, 1.0), 0.0)

    sides = np.concatenate([low, low + missing[:, run]], axis=1)
    missing_left = np.repeat([False, True], len(slot))
    whole, at = np.tile(total[:, run], 2), np.tile(np.arange(len(slot)), 2)
    other = whole - sides
    gain = score(sides) + score(other) - score(whole)
    least_rows, least_weight = max(rules.least_child_rows, 0.5), max(rules.least_child_weight, 1e-12)
    allowed = ~gone[at] & (~missing_left | (missing[2, run][at] > 0)) & (gain > LEAST_GAIN)
    allowed &= (sides[2] >= least_rows) & (other[2] >= least_rows) & (sides[1] >= least_weight) & (other[1] >= least_weight)
    keep = np.flatnonzero(allowed)
    keep = keep[np.lexsort((~missing_left[keep], bin_[at[keep]], feature[at[keep]], -np.round(gain[keep], GAIN_DIGITS), slot[at[keep]]))]
    keep = keep[np.flatnonzero(np.r_[True, np.diff(slot[at[keep]]) != 0])] if len(keep) else keep
    nodes, head = np.unique(slot[first], return_index=True)
    place = np.searchsorted(nodes, slot[at[keep]])
    cuts = [np.full(len(nodes), -1, np.int32), np.zeros(len(nodes), np.int32), np.zeros(len(nodes), bool), np.zeros(len(nodes)), *np.zeros((3, len(nodes)))]
    for out, x in zip(cuts, (feature[at[keep]], bin_[at[keep]], missing_left[keep], gain[keep], *sides[:, keep]), strict=True):
        out[place] = x
    return [nodes, feature[first][head], *total[:, head], *cuts]


def _rank(r: dict) -> tuple:
    return r["feature"] >= 0, round(r["gain"], GAIN_DIGITS), -r["feature"], -r["cut"], r["missing_left"]


def grow(rows: DataFrame, edges: list[list[float]], numbers: list[int], rules: Rules, stats, credits: list[tuple] | None = None) -> Trees:
    """One tree for each of ``numbers``, all grown together a level at a time, on ``rows`` with ``row_hash`` and ``bins``.

    ``stats(batch, bins)`` gives the two statistics of the rows of an Arrow batch. If ``rules`` ask for shadows, ``credits``
    gets ``(tree, node, feature, gain)`` of each node that could be cut: the gain of the feature that gains most, or, if
    a shadow gains more, less than nothing for the feature of the shadow. A draw between them gives neither.
    """
    width, bins = len(edges), max((len(e) for e in edges), default=0) + 1
    grown = {t: Trees() for t in numbers}
    open_nodes = [(t, grown[t].add(0.0, 0.0, 0.0)) for t in numbers]
    n_columns = min(rules.columns or width, width)
    level = 0
    while open_nodes and width:
        flat, offset = Trees(), {}
        for t in numbers:
            offset[t] = len(flat.feature)
            grown[t].roots = [0]
            flat.append(grown[t])
        found: dict[tuple[int, int], dict] = {}
        most = max(1, CELLS // (n_columns * (bins + 1)))
        for i in range(0, len(open_nodes), most):
            some = open_nodes[i : i + most]
            drawn = np.stack([columns_drawn(rules.seed, t, n if rules.per_node else None, width, n_columns) for t, n in some])
            slots = {offset[t] + n: s for s, (t, n) in enumerate(some)}
            schema = "slot int, feature int, bin int, a double, b double, n double"
            parts: dict[int, list[dict]] = {}
            salts = dict(enumerate(some)) if rules.shadows else None
            for r in best_cuts(rows.mapInArrow(_sums(rules, flat, numbers, slots, drawn, width, bins, stats), schema), rules, salts).collect():
                parts.setdefault(r["slot"], []).append(r.asDict())
            for s, of in parts.items():
                head = min(of, key=lambda r: r["first"])
                found[some[s]] = max(of, key=_rank) | {c: head[c] for c in ("ta", "tb", "tn")}
                if rules.shadows:
                    chance = max(of, key=lambda r: (r["shadow_feature"] >= 0, round(r["shadow_gain"], GAIN_DIGITS), -r["shadow_feature"]))
                    found[some[s]] |= {c: chance[c] for c in ("shadow_feature", "shadow_gain")}
        nxt = []
        for t, n in open_nodes:
            tree, r = grown[t], found.get((t, n))
            if r is None:
                continue
            if not level:
                tree.value[n], tree.cover[n], tree.rows[n] = rules.leaf(r["ta"], r["tb"]), r["tb"], r["tn"]
            if rules.shadows and tree.rows[n] >= rules.least_split_rows:
                more = round(r["gain"], GAIN_DIGITS) - round(r["shadow_gain"], GAIN_DIGITS)
                if more:
                    credits.append((t, n, r["feature"], r["gain"]) if more > 0 else (t, n, r["shadow_feature"], -r["shadow_gain"]))
            if r["feature"] < 0 or tree.rows[n] < rules.least_split_rows:
                continue
            upper = edges[r["feature"]]
            tree.feature[n], tree.cut[n], tree.threshold[n] = r["feature"], r["cut"], upper[r["cut"]] if r["cut"] < len(upper) else math.inf
            tree.missing_left[n], tree.gain[n] = r["missing_left"], r["gain"]
            sides = [(r["a"], r["b"], r["n"]), (r["ta"] - r["a"], r["tb"] - r["b"], r["tn"] - r["n"])]
            children = [tree.add(rules.leaf(a, b), b, m) for a, b, m in sides]
            tree.left[n], tree.right[n] = children
            if rules.depth is None or level + 1 < rules.depth:
                nxt += [(t, c) for c in children if tree.rows[c] >= max(2.0, rules.least_split_rows)]
        open_nodes, level = nxt, level + 1
    out = Trees()
    for t in numbers:
        grown[t].roots = [0]
        out.append(grown[t])
    return out


# --- boosting --------------------------------------------------------------------------------------------------------


def boost(
    frame: DataFrame,
    label: str = "outcome",
    features: str = "features",
    weight: str | None = None,
    rounds: int = 300,
    rate: float = 0.1,
    depth: int = 6,
    l2: float = 1.0,
    least_gain: float = 0.0,
    least_child_weight: float = 1.0,
    column_share: float = 1.0,
    row_share: float = 1.0,
    bins: int = MAX_BINS,
    seed: int = 42,
) -> Trees:
    """Second-order boosting of the log loss from a margin of 0; leaves are already multiplied by ``rate``.

    ``least_gain`` prunes a grown tree from its leaves up; ``least_child_weight`` bounds the Hessian of a child from
    below; columns are drawn per tree and rows by their hash per round.
    """
    if rounds < 1 or depth < 1 or not 0 < rate or not 0 < column_share <= 1 or not 0 < row_share <= 1 or l2 < 0 or least_gain < 0:
        raise ValueError("rounds and depth from 1, rate above 0, shares in (0, 1], penalties from 0")
    w = F.lit(1.0) if weight is None else F.col(weight).cast("double")
    edges = bin_edges(frame, features, bins)
    keep = [F.xxhash64(F.col(features), F.col(label), F.lit(seed)).alias("row_hash"), F.col(label).cast("double").alias("y"), w.alias("w"), F.lit(0.0).alias("margin")]
    rows = materialise(binned(frame.where(F.col(label).isNotNull()), edges, keep, features))
    width = len(edges)
    rules = Rules(depth, l2, least_child_weight, 1.0, 2.0, max(1, round(column_share * width)), False, "share", row_share, True, seed)
    model, written = Trees(), 0
    for t in range(rounds):
        if t - written >= REFRESH:
            rows, written = materialise(_advanced(rows, model.part(written), width)), t
        pending = Walker(model.part(written))
        tree = grow(rows, edges, [t], rules, _gradients(pending, t - written))
        tree.prune(0, least_gain)
        tree.value = [rate * v for v in tree.value]
        model.append(tree)
    return model


def _margins(batch: pa.RecordBatch, data: np.ndarray, walker: Walker, n: int) -> np.ndarray:
    out = batch.column(batch.schema.get_field_index("margin")).to_numpy(zero_copy_only=False).copy()
    for t in range(n):
        out += walker.value[walker.leaves(t, data, True)]
    return out


def _gradients(walker: Walker, n: int):
    def stats(batch: pa.RecordBatch, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        y, w = (batch.column(batch.schema.get_field_index(c)).to_numpy(zero_copy_only=False) for c in ("y", "w"))
        p = 1.0 / (1.0 + np.exp(-_margins(batch, data, walker, n)))
        return w * (p - y), w * p * (1.0 - p)

    return stats


def _advanced(rows: DataFrame, trees: Trees, width: int) -> DataFrame:
    at = rows.columns.index("margin")

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        walker = Walker(trees)
        for batch in batches:
            moved = _margins(batch, matrix_of(batch.column(batch.schema.get_field_index("bins")), width, np.int64), walker, len(trees.roots))
            yield pa.RecordBatch.from_arrays([pa.array(moved) if i == at else c for i, c in enumerate(batch.columns)], names=batch.schema.names)

    return rows.mapInArrow(each, rows.schema)


# --- a bagged forest and its out-of-bag scores -------------------------------------------------------------------------


def row_hash(key: str, seed: int) -> Column:
    return F.xxhash64(F.col(key), F.lit(seed))


def bagged_forest(
    frame: DataFrame,
    key: str,
    label: str = "outcome",
    features: str = "features",
    weight: str | None = None,
    trees: int = 100,
    depth: int | None = None,
    columns: int | str = "sqrt",
    least_split_rows: int = 2,
    least_leaf_rows: int = 1,
    bins: int = MAX_BINS,
    seed: int = 42,
    together: int = 50,
) -> Trees:
    """A forest whose bags are Poisson(1) counts from the hash of key, seed and tree; ``together`` trees grow at a time.

    ``depth`` None grows until nodes are pure or too small to cut; ``columns`` are drawn anew in every node.
    """
    edges = bin_edges(frame, features, bins)
    width = len(edges)
    n = max(1, int(math.sqrt(width))) if columns == "sqrt" else max(1, int(math.log2(width))) if columns == "log2" else int(columns)
    w = F.lit(1.0) if weight is None else F.col(weight).cast("double")
    keep = [row_hash(key, seed).alias("row_hash"), F.col(label).cast("double").alias("y"), w.alias("w")]
    rows = materialise(binned(frame.where(F.col(label).isNotNull()), edges, keep, features))
    rules = Rules(depth, 0.0, 0.0, least_leaf_rows, least_split_rows, n, True, "bag", 1.0, False, seed)

    def stats(batch: pa.RecordBatch, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        y, w = (batch.column(batch.schema.get_field_index(c)).to_numpy(zero_copy_only=False) for c in ("y", "w"))
        return w * y, w

    model = Trees()
    for first in range(0, trees, together):
        model.append(grow(rows, edges, list(range(first, min(trees, first + together))), rules, stats))
    return model


def shadowed_forest(
    frame: DataFrame,
    key: str,
    label: str = "outcome",
    features: str = "features",
    trees: int = 100,
    depth: int | None = None,
    columns: int | str = "sqrt",
    share: float = 0.632,
    least_split_rows: int = 2,
    least_leaf_rows: int = 1,
    bins: int = MAX_BINS,
    seed: int = 42,
    together: int = 50,
) -> tuple[Trees, list[tuple]]:
    """A forest on shares of the rows, and its credits ``(tree, node, feature, gain)`` against shadows drawn in each node.

    Gains are divided by the rows of the tree. Rows are drawn without return, as a row that is twice in a bag would fall
    into one bin twice but be dealt to two. The label is 0 or 1; rows without one are left out.
    """
    if not 0 < share <= 1:
        raise ValueError("share must lie in (0, 1]")
    if frame.where(F.col(label).isNotNull() & ~F.col(label).cast("double").isin(0.0, 1.0)).limit(1).count():
        raise ValueError("cases are dealt to bins: the label must be 0 or 1")
    edges = bin_edges(frame, features, bins)
    width = len(edges)
    n = max(1, int(math.sqrt(width))) if columns == "sqrt" else max(1, int(math.log2(width))) if columns == "log2" else int(columns)
    keep = [row_hash(key, seed).alias("row_hash"), F.col(label).cast("double").alias("y")]
    rows = materialise(binned(frame.where(F.col(label).isNotNull()), edges, keep, features))
    rules = Rules(depth, 0.0, 0.0, least_leaf_rows, least_split_rows, n, True, "share", share, False, seed, True)

    def stats(batch: pa.RecordBatch, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        y = batch.column(batch.schema.get_field_index("y")).to_numpy(zero_copy_only=False)
        return y, np.ones(len(y))

    model, credits = Trees(), []
    for first in range(0, trees, together):
        model.append(grow(rows, edges, list(range(first, min(trees, first + together))), rules, stats, credits))
    size = [model.rows[r] for r in model.roots]
    return model, [(t, node, f, g / size[t]) for t, node, f, g in credits]


def out_of_bag(frame: DataFrame, key: str, model: Trees, label: str = "outcome", features: str = "features", seed: int = 42) -> DataFrame:
    """``key, actual, score, n_trees, prediction``: the mean of each row over the trees whose bags leave it out.

    ``score`` is null for a row that is in every bag.
    """

    @F.pandas_udf("score double, n_trees int")
    def score(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        walker = Walker(model)
        for hashes, x in batches:
            if not len(x):
                yield pd.DataFrame({"score": [], "n_trees": []})
                continue
            m = np.stack([np.asarray(r, float) for r in x])
            h = hashes.to_numpy()
            total, n = np.zeros(len(m)), np.zeros(len(m), np.int32)
            for t in range(len(model.roots)):
                out = np.flatnonzero(times_drawn(h, t, "bag", 1.0) == 0)
                total[out] += walker.value[walker.leaves(t, m[out], False)]
                n[out] += 1
            yield pd.DataFrame({"score": np.where(n > 0, total / np.maximum(n, 1), np.nan), "n_trees": n})

    scored = frame.select(key, F.col(label).alias("actual"), score(row_hash(key, seed), F.col(features)).alias("s"))
    value = F.when(F.col("s.n_trees") > 0, F.col("s.score"))
    return materialise(scored.select(key, "actual", value.alias("score"), F.col("s.n_trees").alias("n_trees"), (value > 0.5).cast("int").alias("prediction")))


# --- a fitted model --------------------------------------------------------------------------------------------------


class TreeModel(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Adds ``probability`` and ``prediction``: boosted trees add up to a margin, bagged ones are averaged."""

    def __init__(self, trees: Trees | None = None, boosted: bool = True, width: int = 0, source: str = "features") -> None:
        super().__init__()
        self.trees = Param(self, "trees", "nodes as JSON", TypeConverters.toString)
        self.boosted = Param(self, "boosted", "sum of margins or mean of shares", TypeConverters.toBoolean)
        self.width = Param(self, "width", "number of features", TypeConverters.toInt)
        self.source = Param(self, "source", "vector column", TypeConverters.toString)
        self._set(trees=json.dumps(vars(trees or Trees())), boosted=boosted, width=width, source=source)

    def nodes(self) -> Trees:
        return Trees(**json.loads(self.getOrDefault(self.trees)))

    @property
    def featureImportances(self):  # noqa: N802  (the name Spark's tree models use)
        return Vectors.dense(self.nodes().importances(self.getOrDefault(self.width)))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        trees, boosted = self.nodes(), self.getOrDefault(self.boosted)

        @F.pandas_udf(ArrayType(DoubleType()))
        def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            walker = Walker(trees)
            for x in batches:
                if not len(x):
                    yield pd.Series([], dtype=object)
                    continue
                m = np.stack([np.asarray(r, float) for r in x])
                total = np.zeros(len(m))
                for t in range(len(trees.roots)):
                    total += walker.value[walker.leaves(t, m, False)]
                p = 1.0 / (1.0 + np.exp(-total)) if boosted else total / max(1, len(trees.roots))
                yield pd.Series(list(np.stack([1.0 - p, p], axis=1)))

        scored = dataset.withColumn("probability", array_to_vector(score(vector_to_array(self.getOrDefault(self.source)))))
        return scored.withColumn("prediction", (vector_to_array("probability")[1] > 0.5).cast("double"))
