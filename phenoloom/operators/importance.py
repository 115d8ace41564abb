"""Tables of feature importance: aggregate over fits, rank, shares, mutual information."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from phenoloom.functions.special import digamma
from phenoloom.operators.association import anova
from phenoloom.operators.ordered import SLICE, accumulate, exact_quantiles, rank_rows, slice_by_order
from phenoloom.session import materialise, small_side

#: Neighbours are looked up in runs of this many ordered rows, each seen with its borders.
RUN = 20_000


def first_repeats(importances: DataFrame, k: int) -> DataFrame:
    return importances.where(F.col("repeat") <= k)


def importance_stats(importances: DataFrame) -> DataFrame:
    """Mean, median, sample sd and number of fits that used each feature. A group has one row per fit."""
    v = F.col("importance")
    return importances.groupBy("feature").agg(
        F.avg(v).alias("imp_mean"), F.median(v).alias("imp_median"), F.stddev_samp(v).alias("imp_sd"), F.count(v).alias("nr_notna")
    )


def rank_importance(stats: DataFrame, drop_unused: bool = True) -> DataFrame:
    """Rank by mean importance, highest first, unused features last (then dropped); name breaks ties."""
    ranked = rank_rows(stats, [F.col("imp_mean").desc_nulls_last(), F.col("feature")])
    return ranked.where(F.col("imp_mean").isNotNull()) if drop_unused else ranked


def name_features(ranked: DataFrame, annotation: DataFrame, key: str, name: str) -> DataFrame:
    side = annotation.select(F.col(key).alias("feature"), F.col(name).alias("feature_name"))
    return ranked.join(side, "feature", "left")


def cumulative_share(ranked: DataFrame, value: str = "imp_mean") -> DataFrame:
    """Normalised importance and its running sum from the top."""
    order = [F.col(value).desc(), F.col("feature")]
    total = F.sum(value)
    sliced = slice_by_order(ranked, order)
    share = F.col(value) / sliced.agg(total.alias("t")).scalar()
    ran = accumulate(sliced.withColumn("share", share), order, {"cum_share": ("sum", F.col("share"))})
    return ran.drop(SLICE)


def top_features(table: DataFrame, n: int | None = None, threshold: float | None = None, method: str = "top_n") -> DataFrame:
    """The ``n`` most important features, or all with at least ``threshold``."""
    if method == "top_n":
        if n is None:
            raise ValueError("method 'top_n' needs n")
        return table.orderBy(F.col("importance").desc_nulls_last(), "feature").limit(n)
    if method == "threshold":
        if threshold is None:
            raise ValueError("method 'threshold' needs threshold")
        return table.where(F.col("importance") >= threshold)
    raise ValueError(f"invalid method {method!r}")


def tuning_grid(n_features: int, row: int | None = None, distinct: bool = False) -> list[int]:
    """Features tried per split: the square root of their number, scaled around. ``row`` keeps one entry (from 1)."""
    import math

    base = math.ceil(math.sqrt(n_features))
    grid = [math.ceil(base * s) for s in (0.6, 0.8, 1, 1.2)]
    if distinct:
        grid = list(dict.fromkeys(grid))
    return [grid[row - 1]] if row else grid


# --- mutual information ----------------------------------------------------------------------------------------------


def binned_mi(cells: DataFrame, outcome: str = "outcome", bins: int = 10) -> DataFrame:
    """Mutual information of the outcome with the feature cut at its quantiles (order statistics at floor((n-1)p))."""
    rows = cells.where(F.col("value").isNotNull() & F.col(outcome).isNotNull())
    probs = {f"q{i}": i / bins for i in range(1, bins)}
    edges = small_side(materialise(exact_quantiles(rows, "value", probs, ["feature"], interpolate=False)))
    bin_no = sum(((F.col("value") > F.col(q)).cast("int") for q in probs), F.lit(0))
    counts = rows.join(edges, "feature").groupBy("feature", bin_no.alias("bin"), F.col(outcome).alias("y")).agg(F.count("*").alias("c"))
    # at most bins x classes rows per feature from here on
    w = Window.partitionBy("feature")
    c, n = F.col("c"), F.sum("c").over(w)
    part = counts.select(
        "feature",
        (c / n * F.log(c * n / (F.sum("c").over(Window.partitionBy("feature", "bin")) * F.sum("c").over(Window.partitionBy("feature", "y"))))).alias("t"),
    )
    return part.groupBy("feature").agg(F.greatest(F.lit(0.0), F.sum("t")).alias("mutual_info"))


def neighbour_mi(cells: DataFrame, key: str, outcome: str = "outcome", k: int = 3) -> DataFrame:
    """Nearest-neighbour estimate for a continuous feature and a discrete outcome (Ross 2014).

    Values are ordered per feature and class; the k-th neighbour of a value is among its k predecessors and k
    successors, read in runs of bounded length with their borders copied. How many values of any class lie within that
    distance is a difference of two running counts over values and interval ends together.
    """
    rows = cells.where(F.col("value").isNotNull() & F.col(outcome).isNotNull()).select(
        F.col(key).alias("_k"), "feature", F.col(outcome).alias("_y"), F.col("value").alias("_x")
    )
    ranked = rank_rows(rows, [F.col("_x"), F.col("_k")], ["feature", "_y"], out="_r")
    ranked = materialise(ranked)
    sizes = ranked.groupBy("feature", "_y").agg(F.max("_r").alias("_ny"))
    run = F.floor((F.col("_r") - 1) / RUN)
    home = F.struct(run.alias("run"), F.lit(True).alias("own"))
    ahead = F.when((F.col("_r") - 1) % RUN >= RUN - k, F.struct((run + 1).alias("run"), F.lit(False).alias("own")))
    back = F.when((F.col("_r") - 1) % RUN < k, F.struct((run - 1).alias("run"), F.lit(False).alias("own")))
    copies = ranked.withColumn("_c", F.explode(F.filter(F.array(home, ahead, back), lambda c: c.isNotNull())))
    w = Window.partitionBy("feature", "_y", "_c.run").orderBy("_r")
    gaps = F.array(*[F.abs(F.col("_x") - f("_x", i).over(w)) for i in range(1, k + 1) for f in (F.lag, F.lead)])
    near = copies.select("*", F.array_sort(F.filter(gaps, lambda g: g.isNotNull())).alias("_g")).where("_c.own")
    near = near.join(sizes, ["feature", "_y"]).where("_ny > 1")
    kk = F.least(F.lit(k), F.col("_ny") - 1).cast("int")
    near = near.select("feature", "_k", "_x", "_ny", kk.alias("_kk"), F.get("_g", kk - 1).alias("_d"))

    # an interval end counts the values before it: strictly below its upper end, up to and including its lower end
    wide = F.col("_d") > 0
    ends = near.select(
        "feature",
        F.explode(
            F.array(
                F.struct(F.col("_x").alias("at"), F.lit(1).alias("side"), F.lit(1).alias("one"), F.lit(0).alias("sign")),
                F.struct(
                    F.when(wide, F.col("_x") + F.col("_d")).otherwise(F.col("_x")).alias("at"),
                    F.when(wide, 0).otherwise(2).alias("side"),
                    F.lit(0).alias("one"),
                    F.lit(1).alias("sign"),
                ),
                F.struct(
                    F.when(wide, F.col("_x") - F.col("_d")).otherwise(F.col("_x")).alias("at"),
                    F.when(wide, 2).otherwise(0).alias("side"),
                    F.lit(0).alias("one"),
                    F.lit(-1).alias("sign"),
                ),
            )
        ).alias("e"),
        "_k",
    ).select("feature", "_k", "e.*")
    order = [F.col("at"), F.col("side"), F.col("_k"), F.col("sign")]
    counted = accumulate(slice_by_order(ends, order, ["feature"]), order, {"_below": ("sum", F.col("one"))}, ["feature"])
    m = counted.where("sign <> 0").groupBy("feature", "_k").agg(F.sum(F.col("sign") * F.col("_below")).alias("_m"))
    both = near.join(m, ["feature", "_k"])
    term = digamma(F.col("_kk").cast("double")) - digamma(F.col("_ny").cast("double")) - digamma(F.col("_m").cast("double"))
    return both.groupBy("feature").agg(
        F.greatest(F.lit(0.0), digamma(F.count("*").cast("double")) + F.avg(term)).alias("mutual_info")
    )


def compare_importance(
    cells: DataFrame, key: str, outcome: str = "outcome", forest: DataFrame | None = None, methods: Sequence[str] = ("f", "mi")
) -> DataFrame:
    """Forest importance (if given), F score and mutual information side by side, each with its rank."""
    tables = []
    if forest is not None:
        tables.append((forest.select("feature", F.col("importance").alias("forest")), "forest"))
    if "f" in methods:
        tables.append((anova(cells, outcome).select("feature", "f_score", "p_value"), "f_score"))
    if "mi" in methods:
        tables.append((neighbour_mi(cells, key, outcome), "mutual_info"))
    if "binned_mi" in methods:
        tables.append((binned_mi(cells, outcome).select("feature", F.col("mutual_info").alias("binned_mi")), "binned_mi"))
    out = None
    for t, score in tables:
        ranked = rank_rows(t, [F.col(score).desc_nulls_last(), F.col("feature")], out=f"{score}_rank")
        out = ranked if out is None else out.join(ranked, "feature", "full")
    return out
