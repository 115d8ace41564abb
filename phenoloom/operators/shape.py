"""Three forms of the feature matrix.

* arrays: one row per sample, ``features ARRAY<DOUBLE>`` plus an ordered list of names. The stored form: joins on the
  sample key move one row per sample, not one per cell.
* cells: one row per (sample, feature). The form for per-feature statistics; made last, after joins and filters, so
  that only partial aggregates are shuffled.
* wide: one column per feature. For few features, and for import and export.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def finite(value):
    """NaN and infinities become NULL, the one form of a missing cell."""
    return F.when(F.abs(value) < float("inf"), value)


def name_literal(names: Sequence[str]):
    """The names as one string literal that is split again, so that a plan has one size for any number of them."""
    if any("\x1f" in n for n in names):
        raise ValueError("a feature name holds the unit separator")
    return F.split(F.lit("\x1f".join(names)), "\x1f") if names else F.array().cast("array<string>")


def cells_from_wide(df: DataFrame, features: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """Unpivot numeric columns into cells. For a few hundred columns at most; import wider files as arrays."""
    typed = df.select(*keep, *[F.col(c).cast("double").alias(c) for c in features])
    return typed.unpivot(list(keep), list(features), "feature", "value")


def cells_from_arrays(df: DataFrame, names: Sequence[str], keep: Sequence[str], col: str = "features") -> DataFrame:
    """Explode the array form. One narrow step, no shuffle; the names travel as one literal.

    The outer form, less its empty rows: for the inner one Catalyst infers a filter on the array, which makes it compute
    a derived array twice.
    """
    labels = name_literal(names)
    return df.select(*keep, F.posexplode_outer(col).alias("_pos", "value")).where(F.col("_pos").isNotNull()).select(
        *keep, F.get(labels, F.col("_pos")).alias("feature"), F.col("value").cast("double").alias("value")
    )


def arrays_from_wide(df: DataFrame, features: Sequence[str], keep: Sequence[str], col: str = "features") -> DataFrame:
    return df.select(*keep, F.array(*[F.col(c).cast("double") for c in features]).alias(col))


def wide_from_arrays(df: DataFrame, names: Sequence[str], keep: Sequence[str], col: str = "features") -> DataFrame:
    return df.select(*keep, *[F.get(col, F.lit(i)).alias(n) for i, n in enumerate(names)])


def wide_from_cells(cells: DataFrame, names: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """Pivot with the names given, so no extra pass is needed to discover them."""
    return cells.groupBy(*keep).pivot("feature", list(names)).agg(F.first("value", ignorenulls=True))


def arrays_from_cells(cells: DataFrame, names: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """Gather the cells of each sample in the order of ``names``; a missing cell is NULL.

    A group holds one sample, at most ``len(names)`` cells.
    """
    wanted = cells.where(F.array_contains(name_literal(names), F.col("feature")))
    grouped = wanted.groupBy(*keep).agg(F.map_from_entries(F.collect_list(F.struct("feature", "value"))).alias("_m"))
    return grouped.select(*keep, F.transform(name_literal(names), lambda n: F.col("_m")[n]).alias("features"))


def slice_arrays(df: DataFrame, names: Sequence[str], wanted: Sequence[str], col: str = "features") -> DataFrame:
    """Keep the named features, in the order asked for. Narrow."""
    place = {n: i for i, n in enumerate(names)}
    at = F.split(F.lit(",".join(str(place[n]) for n in wanted)), ",").cast("array<int>")
    return df.withColumn(col, F.transform(at, lambda i: F.get(F.col(col), i)) if wanted else F.slice(col, 1, 0))


def vectors(df: DataFrame, col: str = "features") -> DataFrame:
    """The array column as an ML vector."""
    return df.withColumn(col, array_to_vector(F.col(col)))
