"""Ordered work without a single-task window.

A window over a whole table sorts that table in one task. Here a table is range-partitioned into slices instead; each
slice is accumulated on its own and then shifted by the totals of the slices on its other side. The table of slice
totals has one row per slice and group, so nothing unbounded meets in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from phenoloom.session import materialise, ordered_slices, small_side

SLICE = "_slice"
_COMBINE = {"sum": (F.sum, lambda a, b: a + b), "min": (F.min, F.least), "max": (F.max, F.greatest)}


def slice_by_order(df: DataFrame, order: Sequence[Column], by: Sequence[str] = ()) -> DataFrame:
    """Range-partition on ``by`` and ``order`` and number the slices.

    The order should be unique within ``by`` (add a key, or collapse equal values first): then no value, however
    frequent, can overload a slice. The checkpoint pins the slice bounds, which are sampled, for all later reads.
    """
    cut = materialise(df.repartitionByRange(ordered_slices(df.sparkSession), *by, *order))
    return cut.withColumn(SLICE, F.spark_partition_id())


def accumulate(
    sliced: DataFrame,
    order: Sequence[Column],
    measures: dict[str, tuple[str, Column]],
    by: Sequence[str] = (),
    backward: bool = False,
    exclusive: bool = False,
) -> DataFrame:
    """Add running ``sum``/``min``/``max`` columns along ``order``.

    ``measures`` maps an output name to ``(function, column)``. ``backward`` accumulates from the last row up to the
    current one; ``exclusive`` leaves the current row out.
    """
    keys = [*by, SLICE]
    totals = sliced.groupBy(*keys).agg(*[_COMBINE[f][0](c).alias(f"_t_{o}") for o, (f, c) in measures.items()])
    other = Window.partitionBy(*by).orderBy(F.col(SLICE).desc() if backward else F.col(SLICE))
    other = other.rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*keys, *[_COMBINE[f][0](f"_t_{o}").over(other).alias(f"_o_{o}") for o, (f, _) in measures.items()])

    edge = 1 if exclusive else 0
    inner = Window.partitionBy(*keys).orderBy(*order)
    inner = inner.rowsBetween(edge, Window.unboundedFollowing) if backward else inner.rowsBetween(Window.unboundedPreceding, -edge)
    ran = sliced.select("*", *[_COMBINE[f][0](c).over(inner).alias(f"_r_{o}") for o, (f, c) in measures.items()])

    joined = ran.join(offsets, keys)
    outs = []
    for o, (f, _) in measures.items():
        near, far = F.col(f"_r_{o}"), F.col(f"_o_{o}")
        if f == "sum":
            outs.append((F.coalesce(near, F.lit(0)) + F.coalesce(far, F.lit(0))).alias(o))
        else:
            outs.append(_COMBINE[f][1](near, far).alias(o))
    return joined.select(*sliced.columns, *outs)


def rank_rows(df: DataFrame, order: Sequence[Column], by: Sequence[str] = (), out: str = "rank") -> DataFrame:
    """``row_number`` over a unique order, spread over slices."""
    sliced = slice_by_order(df, order, by)
    return accumulate(sliced, order, {out: ("sum", F.lit(1).cast("long"))}, by).drop(SLICE)


def hash_buckets(
    df: DataFrame, key: Column, seed: Column | str | int, by: Sequence[str] = (), digits: int = 3
) -> tuple[DataFrame, list[str], DataFrame]:
    """Rows with the md5 of ``key|seed`` as ``_h`` and its first digits, the bucket, as ``_b``; the columns that name a bucket
    of a group; and for each of these its rows ``_c``, those of the buckets before it ``_o`` and of the whole group ``_n``."""
    seed = seed if isinstance(seed, Column) else F.lit(str(seed))
    tagged = df.withColumn("_h", F.md5(F.concat_ws("|", key.cast("string"), seed)))
    tagged = tagged.withColumn("_b", F.substring("_h", 1, digits))
    keys = [*by, "_b"]
    sizes = tagged.groupBy(*keys).agg(F.count("*").alias("_c"))
    group = Window.partitionBy(*by)
    offsets = sizes.select(
        *keys,
        "_c",
        F.coalesce(F.sum("_c").over(group.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_o"),
        F.sum("_c").over(group).alias("_n"),
    )
    return tagged, keys, offsets


def hashed_rank(
    df: DataFrame,
    key: Column,
    seed: Column | str | int,
    by: Sequence[str] = (),
    out: str = "rank",
    total: str | None = None,
    digits: int = 3,
    unique: bool = False,
) -> DataFrame:
    """``row_number`` within ``by`` in the order of ``md5(key|seed)``.

    md5 is uniform, so its first hex digits cut each group into ``16**digits`` even buckets, whatever the size of the
    group: a class that holds nearly all rows is ranked by thousands of tasks. Fully lazy and repeatable. With ``unique`` a key that
    comes twice in a group is an error.
    """
    tagged, keys, offsets = hash_buckets(df, key, seed, by, digits)
    order = Window.partitionBy(*keys).orderBy("_h", key.cast("string"))
    number = F.row_number().over(order)
    if unique:
        text = key.cast("string")
        twice = (number > 1) & F.lag(text).over(order).eqNullSafe(text)
        number = F.when(twice, F.raise_error(F.concat(F.lit("key comes twice: "), F.coalesce(text, F.lit("null"))))).otherwise(number)
    ranked = tagged.withColumn("_r", number)
    extra = [F.col("_n").alias(total)] if total else []
    return ranked.join(offsets.drop("_c"), keys).select(*df.columns, (F.col("_o") + F.col("_r")).cast("long").alias(out), *extra)


def exact_quantiles(
    df: DataFrame, value: str, probs: dict[str, float], by: Sequence[str] = (), accuracy: int = 10_000,
    interpolate: bool = True,
) -> DataFrame:
    """Exact quantiles of ``value`` per group, linear between order statistics or the lower one; nulls ignored.

    First pass: a bounded sketch per group brackets each quantile; its rank error is at most ``n/accuracy``, the
    bracket is twice that on either side. Second pass: count what lies below each bracket and order only the distinct
    values inside it. No group is gathered in one task and only a sliver of the rows is shuffled.
    """
    by = list(by)
    rows = df.where(F.col(value).isNotNull()).select(*by, F.col(value).cast("double").alias("_v"))
    if not by:
        by, rows = ["_all"], rows.withColumn("_all", F.lit(0))
    margin = 2.0 / accuracy
    asked = list(probs.items())
    points = [max(0.0, p - margin) for _, p in asked] + [min(1.0, p + margin) for _, p in asked]
    k = len(asked)
    sketch = rows.groupBy(*by).agg(
        F.count("*").alias("_n"), F.percentile_approx("_v", points, accuracy).alias("_q"), F.min("_v").alias("_a"), F.max("_v").alias("_z")
    )
    # in a small group the margin is less than a row: take the whole of it
    whole = F.array(*[F.col("_a")] * k, *[F.col("_z")] * k)
    sketch = materialise(sketch.select(*by, "_n", F.when(F.col("_n") < 4 * accuracy, whole).otherwise(F.col("_q")).alias("_q")))
    near = small_side(sketch)
    tagged = rows.join(near, by)
    below = tagged.groupBy(*by).agg(
        *[F.count_if(F.col("_v") < F.col("_q")[i]).alias(f"_b{i}") for i in range(k)]
    )
    inside = (
        tagged.select(
            *by,
            "_v",
            F.explode(
                F.filter(
                    F.array(
                        *[
                            F.when((F.col("_v") >= F.col("_q")[i]) & (F.col("_v") <= F.col("_q")[k + i]), F.lit(i))
                            for i in range(k)
                        ]
                    ),
                    lambda x: x.isNotNull(),
                )
            ).alias("_i"),
        )
        .groupBy(*by, "_i", "_v")
        .agg(F.count("*").alias("_c"))
    )
    order = [F.col("_v")]
    ran = accumulate(slice_by_order(inside, order, [*by, "_i"]), order, {"_cum": ("sum", F.col("_c"))}, [*by, "_i"])
    facts = below.join(sketch.select(*by, "_n"), by)
    spots = facts.select(
        *by,
        F.explode(
            F.array(
                *[
                    F.struct(
                        F.lit(i).alias("_i"), F.col(f"_b{i}").alias("_below"), ((F.col("_n") - 1) * F.lit(float(p))).alias("_pos")
                    )
                    for i, (_, p) in enumerate(asked)
                ]
            )
        ).alias("s"),
    ).select(*by, "s.*")
    hit = ran.join(spots, [*by, "_i"])
    last = F.col("_below") + F.col("_cum")
    first = last - F.col("_c")

    def at(pos: Column) -> Column:
        return F.max(F.when((first <= pos) & (pos < last), F.col("_v")))

    picked = hit.groupBy(*by, "_i").agg(
        at(F.floor("_pos")).alias("_lo"), at(F.ceil("_pos")).alias("_hi"), F.first("_pos").alias("_pos")
    )
    quantile = F.col("_lo")
    if interpolate:
        quantile = quantile + (F.col("_pos") - F.floor("_pos")) * (F.col("_hi") - F.col("_lo"))
    out = picked.groupBy(*by).agg(*[F.max(F.when(F.col("_i") == i, quantile)).alias(n) for i, (n, _) in enumerate(asked)])
    return out.drop("_all")
