"""Stacked logistic fits against separate fits, a general optimiser's conditions, and one by one."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from phenoloom.operators import linear as L
from phenoloom.operators import models as M

WIDTH = 6


@pytest.fixture(scope="module")
def frame(spark):
    rng = np.random.default_rng(2)
    rows = []
    for i in range(600):
        x = rng.normal(size=WIDTH) * [1, 5, 0.2, 1, 1, 0] + [0, 100, 0, 3, 0, 8]
        x[3] += 0.8 * x[0]
        y = int(rng.random() < 1 / (1 + np.exp(-(1.2 * x[0] - 0.2 * (x[1] - 100) + 2 * x[2] - 0.8))))
        rows.append((i, y, [float(v) for v in x]))
    return spark.createDataFrame(rows, "sample_id long, outcome int, features array<double>").repartition(4).persist()


@pytest.fixture(scope="module")
def folded(frame):
    return M.with_folds(frame, "sample_id", 3, 2, 42).persist()


def data(frame):
    rows = frame.orderBy("sample_id").collect()
    return np.array([r["features"] for r in rows]), np.array([r["outcome"] for r in rows], float)


def off(x, y, w, f, setting, sd):
    """How far off optimal: from the definition, on the features as they are, over penalties on coefficients times ``sd``."""
    p = 1 / (1 + np.exp(-(x @ f.coefficients + f.intercept)))
    g = np.array([(w * (p - y) * x[:, j]).sum() / len(y) for j in range(x.shape[1])])
    out = [abs((w * (p - y)).sum() / len(y))]
    for j, c in enumerate(f.coefficients):
        if x[:, j].std() == 0:
            assert c == 0
            continue
        slope = g[j] + setting.penalty * (1 - setting.mixing) * c * sd[j] ** 2
        l1 = setting.penalty * setting.mixing * sd[j]
        out.append(abs(slope + l1 * np.sign(c)) / sd[j] if c else max(abs(slope) - l1, 0) / sd[j])
    return max(out)


SETTINGS = [L.Setting(0, 0), L.Setting(0, 0.01), L.Setting(0.5, 0.02), L.Setting(1, 0.05), L.Setting(1, 0.001), L.Setting(1, 10)]


@pytest.mark.parametrize("scale", L.SCALES)
@pytest.mark.parametrize("balanced", [True, False])
@pytest.mark.parametrize("cells", [L.CELLS, 150])
def test_optimal_everywhere(folded, scale, balanced, cells, monkeypatch):
    if cells == 150 and scale != "population":
        pytest.skip("blocks are tried once")
    monkeypatch.setattr(L, "CELLS", cells)
    groups = [L.Group(), L.Group(1, 0), L.Group(2, 2)]
    found = L.fit_many(folded, SETTINGS, groups, scale, balanced)
    assert set(found) == {(i, g) for i in range(len(SETTINGS)) for g in range(3)}
    rows = folded.orderBy("sample_id").collect()
    for (i, g), f in found.items():
        keep = [r for r in rows if groups[g].fold is None or r["folds"][groups[g].repeat] != groups[g].fold]
        x, y = np.array([r["features"] for r in keep]), np.array([r["outcome"] for r in keep], float)
        w = np.where(y == 1, len(y) / (2 * y.sum()), len(y) / (2 * (1 - y).sum())) if balanced else np.ones(len(y))
        sd = {"none": np.ones(WIDTH), "population": x.std(0), "sample": x.std(0, ddof=1)}[scale]
        x = x - x.mean(0)  # the same coefficients, another intercept
        shifted = L.Fitted(f.intercept + f.coefficients @ np.array([r["features"] for r in keep]).mean(0), f.coefficients, f.off, f.rounds, f.loss)
        assert f.off <= L.TOLERANCE and off(x, y, w, shifted, SETTINGS[i], sd) < 1e-6
    assert not found[5, 0].coefficients.any() and found[0, 0].coefficients[:3].all()


@pytest.mark.parametrize("model, params, scale", [("logistic_regression", {"C": 0.5}, False), ("logistic_regression", {"elasticNetParam": 0.5, "C": 0.1}, True), ("elastic_net", {"regParam": 0.02}, False)])
def test_same_scores_as_separate_fits(folded, model, params, scale):
    many, errors = M.cross_scores(folded, [], "sample_id", model, [params], 3, 2, scale=scale)
    assert not errors
    got = {(r["repeat"], r["sample_id"]): (r["fold"], r["score"], r["prediction"], r["actual"]) for r in many.collect()}
    assert len(got) == 1200
    for repeat, fold in [(1, 0), (2, 1)]:
        here = F.col("folds")[repeat] == fold
        single = M.fit(folded.where(~here), model, params | {"tol": 1e-14, "maxIter": 2000}, scale=scale)
        for r in M.predict(single, folded.where(here), ["sample_id", "outcome"]).collect():
            k, score, prediction, actual = got[repeat, r["sample_id"]]
            assert k == fold and abs(score - r["score"]) < 1e-6 and prediction == r["prediction"] and actual == r["outcome"]


def test_bad_settings_are_reported(folded, frame):
    scores, errors = M.cross_scores(folded, [], "sample_id", "logistic_regression", [{"C": 1.0}, {"C": -1.0}, {"elasticNetParam": 3.0}], 3, 1)
    assert set(errors) == {1, 2} and [r["setting"] for r in scores.select("setting").distinct().collect()] == [0]
    assert not M.stacked("logistic_regression", [{"threshold": 0.3}], False) and not M.stacked("random_forest", [{}], False)
    for bad in (dict(settings=[L.Setting(2, 0)]), dict(settings=[L.Setting()], scale="odd")):
        with pytest.raises(ValueError):
            L.fit_many(frame, **bad)
    with pytest.raises(ValueError):
        L.fit_many(frame.where("outcome = 1"), [L.Setting()])
    with pytest.raises(ValueError):
        L.fit_many(frame.withColumn("features", F.array(F.lit(float("nan")))), [L.Setting()])


def test_path(frame):
    points = L.elastic_net_path(frame, [f"x{j}" for j in range(WIDTH)], [0.3, 1.0], 12)
    assert [p["alpha"] for p in points] == [0.3] * 12 + [1.0] * 12 and all(p["off"] <= L.TOLERANCE for p in points)
    for a in (points[:12], points[12:]):
        assert a[0]["n_features"] == 0 and a[-1]["n_features"] == 5 and all(p["loss"] >= q["loss"] for p, q in zip(a, a[1:]))
        assert np.isclose(a[0]["penalty"] / a[-1]["penalty"], 1e4)
    # the end of the path is close to the fit without a penalty
    free = L.fit_many(frame, [L.Setting()])[0, 0]
    assert np.allclose(list(points[-1]["coefficients"].values()), free.coefficients, atol=5e-3)


def test_separable_data_and_few_rows(spark):
    rows = [(i, int(i > 4), [float(i)]) for i in range(10)]
    frame = spark.createDataFrame(rows, "sample_id long, outcome int, features array<double>")
    f = L.fit_many(frame, [L.Setting(0, 0.1), L.Setting(1, 0.1)])
    assert all(x.off <= L.TOLERANCE and x.coefficients[0] > 0 for x in f.values())


def test_packed_rows_are_the_rows(spark):
    rows = [(float(i % 2), [float(i), i / 7], [i % 3, i % 5]) for i in range(50)]
    data = spark.createDataFrame(rows, "y double, features array<double>, folds array<int>").coalesce(1)
    blocks = data.transform(lambda d: L.packed(d, 2, 2)).toArrow()
    got = [r for block in blocks.to_batches() for batch in L._unpacked(block, 2) for r in batch.to_pylist()]
    assert [(r["y"], r["features"], r["folds"]) for r in got] == rows


def test_rounds_read_packed_rows(spark, monkeypatch):
    """Every round sums over the same stored blocks, not over rows made anew."""
    seen = []
    summed = L._summed
    monkeypatch.setattr(L, "_summed", lambda frame, *a: seen.append((frame.columns, frame.storageLevel.useMemory)) or summed(frame, *a))
    frame = spark.createDataFrame([(i % 2, [float(i % 7), float(i % 5)]) for i in range(100)], "outcome int, features array<double>")
    L.fit_many(frame, [L.Setting(0.0, 0.1)])
    assert len(seen) > 3 and all(s == (["n", "y", "features", "folds"], True) for s in seen)
