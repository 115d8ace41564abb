"""Folds, hold-out parts, class weights and balanced resampling.

Every random choice is a hash of the sample key and a seed: a lost task repeats exactly what it did before.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from phenoloom.operators.ordered import hash_buckets, hashed_rank
from phenoloom.operators.shape import cells_from_arrays
from phenoloom.session import materialise, small_side

#: A class table larger than this is taken for a mistake (a continuous outcome) and refused.
MAX_CLASSES = 1000


def uniform(*parts: Column) -> Column:
    """A number in [0, 1) from the md5 of its parts."""
    digest = F.md5(F.concat_ws("|", *[p.cast("string") for p in parts]))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(float(16**13))


def normal(*parts: Column) -> Column:
    """A standard normal number from the hash of its parts (Box-Muller)."""
    u, v = uniform(*parts, F.lit("u")), uniform(*parts, F.lit("v"))
    return F.sqrt(-2.0 * F.log(1.0 - u)) * F.cos(2.0 * math.pi * v)


def poisson_one(*parts: Column) -> Column:
    """A Poisson(1) count from the hash of its parts, by inversion."""
    u, total, term = uniform(*parts), 0.0, math.exp(-1.0)
    out = F.lit(0)
    for k in range(1, 16):
        total += term
        out = F.when(u >= total, F.lit(k)).otherwise(out)
        term /= k
    return out


def stratified_folds(df: DataFrame, key: str, label: str, k: int = 5, seed: int | str = 42) -> DataFrame:
    """Add ``fold``; the classes are spread evenly, within one row, over the folds."""
    ranked = hashed_rank(df, F.col(key), seed, [label], out="_rank")
    return ranked.withColumn("fold", F.pmod(F.col("_rank") - 1, F.lit(k)).cast("int")).drop("_rank")


def repeated_folds(df: DataFrame, key: str, label: str, k: int = 5, repeats: int = 5, seed: int | str = 42) -> DataFrame:
    """One copy of the rows per repeat, each with its own assignment. Pass only the columns the folds need."""
    copies = df.withColumn("repeat", F.explode(F.sequence(F.lit(1), F.lit(repeats))))
    salt = F.concat_ws(":", F.lit(str(seed)), F.col("repeat").cast("string"))
    ranked = hashed_rank(copies, F.col(key), salt, ["repeat", label], out="_rank")
    return ranked.withColumn("fold", F.pmod(F.col("_rank") - 1, F.lit(k)).cast("int")).drop("_rank")


def holdout_split(df: DataFrame, key: str, label: str, fraction: float = 0.1, seed: int | str = 42) -> DataFrame:
    """Add ``split``: ``val`` for the given share of every class, ``train`` for the rest.

    A row comes before the cut or after it by the bucket of its hash alone, but for the one bucket of each class that the
    cut falls into. Only the rows of those buckets are ranked; all others are neither moved nor sorted.
    """
    tagged, keys, sizes = hash_buckets(df, F.col(key), seed, [label])
    wanted = F.ceil(F.lit(fraction) * F.col("_n"))
    reached = sizes.where(F.col("_o") < wanted).select(*keys, "_c", (wanted - F.col("_o")).alias("_left"))
    last = reached.groupBy(label).agg(F.max_by(F.struct(F.col("_b").alias("cut"), "_left", "_c"), "_b").alias("_at"))
    # one row for each class; a class without any row in the part has none
    known = tagged.join(small_side(materialise(last)), label, "left")
    inside = F.coalesce((F.col("_b") == F.col("_at.cut")) & (F.col("_at._left") < F.col("_at._c")), F.lit(False))
    part = lambda val: F.when(val, "val").otherwise("train").alias("split")
    sure = known.where(~inside & F.col(label).isNotNull()).select(*df.columns, part(F.col("_b") <= F.col("_at.cut")))
    rank = F.row_number().over(Window.partitionBy(label).orderBy("_h", F.col(key).cast("string")))
    # a bucket's rows, stored as both parts ask for them
    ranked = materialise(known.where(inside).withColumn("_r", rank).select(*df.columns, part(F.col("_r") <= F.col("_at._left"))))
    return sure.union(ranked)


def training_part(df: DataFrame, fold: int) -> DataFrame:
    return df.where(F.col("fold") != fold)


def class_counts(df: DataFrame, label: str) -> dict:
    """Rows per class, on the driver, for fits that need them as numbers; more than ``MAX_CLASSES`` levels are refused.

    Weights for any number of classes: :func:`with_class_weights`.
    """
    rows = df.where(F.col(label).isNotNull()).groupBy(label).count().limit(MAX_CLASSES + 1).collect()
    if len(rows) > MAX_CLASSES:
        raise ValueError(f"{label!r} has more than {MAX_CLASSES} levels")
    return {r[label]: r["count"] for r in rows}


def balanced_weight(label: Column, counts: dict) -> Column:
    """``n / (k * n_class)`` as a column, from known class counts."""
    n, k = sum(counts.values()), len(counts)
    out = F.when(F.lit(False), F.lit(0.0))
    for level, m in counts.items():
        out = out.when(label == F.lit(level), F.lit(n / (k * m)))
    return out


def with_class_weights(df: DataFrame, label: str, out: str = "weight") -> DataFrame:
    """``n / (k * n_class)`` joined to every row, for any number of classes; null without a label."""
    sizes = materialise(df.where(F.col(label).isNotNull()).groupBy(F.col(label).alias("_level")).agg(F.count("*").alias("_n")))
    whole = sizes.agg(F.sum("_n").alias("n"), F.count("*").alias("k")).first()
    weights = small_side(sizes.select("_level", (F.lit(whole["n"]) / (F.lit(whole["k"]) * F.col("_n"))).alias(out)))
    return df.join(weights, F.col(label) == F.col("_level"), "left").drop("_level")


def rose(
    train: DataFrame,
    names: Sequence[str],
    key: str,
    label: str,
    n: int | None = None,
    seed: int | str = 42,
    shrink: float = 1.0,
) -> DataFrame:
    """Smoothed bootstrap with balanced classes (Menardi & Torelli 2014).

    ``n`` draws: a fair coin picks the class, a uniform rank picks a row in it, and every feature gets Gaussian noise of
    the class's own bandwidth. Draws meet rows by an equi-join on (class, rank), which spreads a rare class evenly.
    """
    counts = class_counts(train, label)
    levels = sorted(counts)
    n = n or sum(counts.values())
    d = len(names)
    spread = (
        cells_from_arrays(train, names, [label])
        .groupBy(label, "feature")
        .agg(F.stddev_samp("value").alias("sd"))
        .collect()
    )
    sd = {(r[label], r["feature"]): r["sd"] or 0.0 for r in spread}
    width = None
    for c in levels:
        factor = shrink * (4.0 / ((d + 2) * counts[c])) ** (1.0 / (d + 4))
        row = F.array(*[F.lit(factor * sd.get((c, f), 0.0)) for f in names])
        width = F.when(F.col(label) == F.lit(c), row) if width is None else width.when(F.col(label) == F.lit(c), row)

    salt = F.lit(str(seed))
    draws = train.sparkSession.range(n).withColumnRenamed("id", "draw")
    pick = F.lit(levels[-1])
    coin = uniform(F.col("draw"), salt, F.lit("class"))
    for i, c in reversed(list(enumerate(levels[:-1]))):
        pick = F.when(coin < (i + 1) / len(levels), F.lit(c)).otherwise(pick)
    draws = draws.withColumn(label, pick)
    size = F.lit(0)
    for c in levels:
        size = F.when(F.col(label) == F.lit(c), F.lit(counts[c])).otherwise(size)
    draws = draws.withColumn("_rank", (F.floor(uniform(F.col("draw"), salt, F.lit("row")) * size) + 1).cast("long"))

    ranked = hashed_rank(train.select(key, label, "features"), F.col(key), seed, [label], out="_rank")
    joined = draws.join(ranked, [label, "_rank"]).withColumn("_w", width)
    noisy = F.transform(
        "features",
        lambda x, i: x + F.get("_w", i) * normal(F.col("draw"), i, salt),
    )
    return joined.select("draw", F.col(key).alias("source"), label, noisy.alias("features"))


def moments(matrix: DataFrame, names: Sequence[str]) -> dict[str, tuple[float, float]]:
    """Mean and population standard deviation per feature, one row each on the driver."""
    rows = cells_from_arrays(matrix, names, []).groupBy("feature").agg(
        F.avg("value").alias("mean"), F.stddev_pop("value").alias("sd")
    )
    return {r["feature"]: (r["mean"], r["sd"]) for r in rows.collect()}


def standardise(matrix: DataFrame, names: Sequence[str], fitted: dict[str, tuple[float, float]]) -> DataFrame:
    """Centre and scale with moments fitted on the training part. A constant feature is only centred."""
    centre = F.array(*[F.lit(fitted[n][0]) for n in names])
    scale = F.array(*[F.lit(fitted[n][1] or 1.0) for n in names])
    moved = F.transform("features", lambda x, i: (x - F.get(centre, i)) / F.get(scale, i))
    return matrix.withColumn("features", moved)
