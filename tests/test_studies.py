"""All outcomes in all modes: shared steps, a study that fails, and a run that goes on where it was."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from phenoloom.operators import models as M
from phenoloom.plans import study as S
from phenoloom.plans.ledger import ledger_of

NAMES = ["p1", "p2", "p3", "p4"]
SETTINGS = S.Settings(forest={"numTrees": 4, "maxDepth": 3}, folds=2, repeats=1, eliminate=False, kept=2, models=("logistic_regression",))


@pytest.fixture(scope="module")
def tables(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [float(v) for v in rng.normal(size=4) + [i % 2, 0, 0, i % 3]]) for i in range(240)]
    matrix = spark.createDataFrame(rows, "sample_id long, features array<double>")
    pheno = matrix.select("sample_id", (20 + F.col("sample_id") % 50).alias("age"), (F.col("sample_id") % 4 % 2).alias("sex"), F.lit(22.5).alias("bmi"))
    outcomes = {"odd": pheno.withColumn("outcome", F.col("sample_id") % 2), "third": pheno.withColumn("outcome", (F.col("sample_id") % 3 == 0).cast("int"))}
    return matrix, outcomes


def recorded(spark, root):
    return {(r["run_id"], r["step"]): r["n"] for r in ledger_of(spark, root).groupBy("run_id", "step").agg(F.count("*").alias("n")).collect()}


def test_a_killed_run_goes_on(spark, tables, tmp_path, monkeypatch):
    matrix, outcomes = tables
    root, trained, real = str(tmp_path), [], M.train_model

    def dies(frame, names, *a, **b):
        if len(trained) >= 1:
            raise RuntimeError("driver lost")
        trained.append(tuple(names))
        return real(frame, names, *a, **b)

    monkeypatch.setattr(M, "train_model", dies)
    some, modes = outcomes, ("sexagebmi",)
    half = S.run_all_studies(spark, root, some, matrix, NAMES, modes, settings=SETTINGS, side_by_side=1)
    assert list(half.runs) == [("odd", "sexagebmi")] and half.errors == {("third", "sexagebmi"): "driver lost"}
    assert half.metrics().select("outcome", "mode").distinct().count() == 1
    with pytest.raises(RuntimeError, match="driver lost"):
        S.run_studies(spark, root, some, matrix, NAMES, modes, settings=SETTINGS)
    before = recorded(spark, root)
    monkeypatch.setattr(M, "train_model", real)
    metrics = S.run_studies(spark, root, some, matrix, NAMES, modes, settings=SETTINGS)
    after = recorded(spark, root)
    # every step is there once: nothing that was stored was made again
    assert set(after.values()) == {1} and all(after[k] == n for k, n in before.items()) and len(after) > len(before)
    assert {("odd-shared", "aligned"), ("third-shared", "aligned")} <= set(after)
    assert metrics.where("split = 'cv' and metric = 'auc_mean'").count() == 2


def test_a_study_that_cannot_run_stops_no_other(spark, tables, tmp_path):
    matrix, outcomes = tables
    none = {"odd": outcomes["odd"], "same": outcomes["odd"].withColumn("outcome", F.lit(1))}
    done = S.run_all_studies(spark, str(tmp_path), none, matrix, NAMES, ("sexagebmi",), settings=SETTINGS)
    assert set(done.runs) == {("odd", "sexagebmi")} and set(done.errors) == {("same", "sexagebmi")}
