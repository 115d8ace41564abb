"""Distributed ordered work against brute force, with a third of the rows in one value, group or score."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from phenoloom.operators import ordered as O


@pytest.fixture(scope="module")
def skewed():
    rng = np.random.default_rng(3)
    n = 60_000
    return pd.DataFrame(
        {
            "id": np.arange(n),
            # one group holds a third of the rows, one value a third of every group
            "g": np.where(rng.random(n) < 0.33, 0, rng.integers(1, 40, n)),
            "v": np.where(rng.random(n) < 0.33, 1.5, rng.lognormal(size=n)),
        }
    )


@pytest.mark.parametrize("accuracy", [100, 10_000])
def test_exact_quantiles(spark, skewed, accuracy):
    # accuracy 100 makes the bracketing branch run: groups of 4 x 100 rows and more use the sketch
    probs = {"a": 0.01, "b": 0.25, "c": 0.5, "d": 0.999}
    got = O.exact_quantiles(spark.createDataFrame(skewed), "v", probs, ["g"], accuracy).toPandas().set_index("g").sort_index()
    want = skewed.groupby("g").v.quantile(list(probs.values())).unstack()
    assert np.allclose(got[list(probs)].to_numpy(dtype=float), want.to_numpy(), rtol=0, atol=1e-12)


def test_quantiles_of_small_groups_and_nulls(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("a", None), ("b", 5.0)], "f string, v double")
    got = {r["f"]: r["m"] for r in O.exact_quantiles(df, "v", {"m": 0.5}, ["f"]).collect()}
    assert got == {"a": 1.5, "b": 5.0}


def test_rank_rows(spark, skewed):
    got = O.rank_rows(spark.createDataFrame(skewed), [F.col("v").desc(), F.col("id")], ["g"]).toPandas()
    got = got.sort_values(["g", "v", "id"], ascending=[True, False, True])
    assert (got["rank"].to_numpy() == got.groupby("g").cumcount().to_numpy() + 1).all()


def test_backward_and_exclusive(spark, skewed):
    order = [F.col("v"), F.col("id")]
    sliced = O.slice_by_order(spark.createDataFrame(skewed), order)
    got = O.accumulate(sliced, order, {"m": ("max", F.col("v"))}, backward=True, exclusive=True).toPandas()
    want = got.sort_values(["v", "id"]).v.max()
    assert got.m.isna().sum() == 1 and (got.m.dropna() == want).all()
    run = O.accumulate(sliced, order, {"s": ("sum", F.lit(1))}, exclusive=True).toPandas().sort_values(["v", "id"])
    assert (run.s.to_numpy() == np.arange(len(run))).all()


def test_hashed_rank_is_a_permutation_in_every_class(spark, skewed):
    df = spark.createDataFrame(skewed.assign(y=(skewed.g == 0).astype(int)))
    got = O.hashed_rank(df, F.col("id"), 1, ["y"], total="n").toPandas()
    for _, part in got.groupby("y"):
        assert sorted(part["rank"]) == list(range(1, len(part) + 1)) and (part.n == len(part)).all()


def test_no_window_without_partition(spark, skewed):
    """The slices, not the table, are what a window sees."""
    plan = O.rank_rows(spark.createDataFrame(skewed), [F.col("v"), F.col("id")])._jdf.queryExecution().executedPlan().toString()
    wide = [line for line in plan.splitlines() if "Exchange SinglePartition" in line]
    assert len(wide) <= 1 and "_slice" in plan
