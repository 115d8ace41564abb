"""The kernel machine on landmarks next to an exact dual solver."""

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array

from phenoloom.operators import models as M


@pytest.fixture(scope="module")
def frame(spark):
    rng = np.random.default_rng(1)
    rows = []
    for i in range(500):
        x = rng.normal(size=3)
        rows.append((i, int(x[0] ** 2 + x[1] ** 2 + 0.3 * rng.normal() > 1.6), [float(v) for v in x]))
    return spark.createDataFrame(rows, "sample_id long, outcome int, features array<double>").repartition(4).persist()


def exact_margins(x, y, w, c, gamma):
    """The dual of the weighted hinge loss with a free intercept: the pair that is most off is moved until none is."""
    kernel, bound, a = M.gaussian(x, x, gamma), c * w, np.zeros(len(y))
    slope = -np.ones(len(y))
    q = kernel * np.outer(y, y)
    for _ in range(20_000):
        up = np.where(((y > 0) & (a < bound)) | ((y < 0) & (a > 0)), -y * slope, -np.inf)
        low = np.where(((y > 0) & (a > 0)) | ((y < 0) & (a < bound)), -y * slope, np.inf)
        i, j = int(up.argmax()), int(low.argmin())
        if up[i] - low[j] < 1e-6:
            break
        step = (up[i] - low[j]) / max(kernel[i, i] + kernel[j, j] - 2 * kernel[i, j], 1e-12)
        step = min(step, bound[i] - a[i] if y[i] > 0 else a[i], a[j] if y[j] > 0 else bound[j] - a[j])
        a[i] += y[i] * step
        a[j] -= y[j] * step
        slope += q[:, i] * y[i] * step - q[:, j] * y[j] * step
    return kernel @ (a * y) + (up[i] + low[j]) / 2


def test_margins_are_near_the_exact_ones(frame):
    model = M.fit(frame, "svm", {"n_random": 100, "gamma": 0.5, "maxIter": 60})
    lift = model.stages[0]
    assert len(lift.rows()) == 100 and lift.getOrDefault(lift.error)[0] < 1e-2
    rows = model.transform(frame.withColumn("features", M.array_to_vector("features"))).select("sample_id", "outcome", vector_to_array("features").alias("x"), vector_to_array("margin")[1].alias("m")).orderBy("sample_id").collect()
    x, y, m = np.array([r["x"] for r in rows]), np.array([1 if r["outcome"] else -1 for r in rows]), np.array([r["m"] for r in rows])
    w = np.where(y > 0, len(y) / (2 * (y > 0).sum()), len(y) / (2 * (y < 0).sum()))
    want = exact_margins(x, y, w, 1.0, 0.5)
    # stated tolerance: a twentieth of the margins' spread on average, and the same side beyond a tenth of a margin
    assert np.abs(m - want).mean() < 0.05 * want.std()
    assert (np.sign(m) == np.sign(want))[np.abs(want) > 0.1].all()


def test_more_landmarks_are_nearer_and_leverage_beats_chance(frame):
    vectors = frame.withColumn("features", M.array_to_vector("features"))
    off = [M.draw_landmarks(vectors, "features", 0.5, k, 7).getOrDefault("error")[0] for k in (5, 40, 200)]
    assert off[0] > off[1] > off[2]
    # a crowd and a few far rows: the far ones are drawn
    crowd = np.concatenate([np.random.default_rng(0).normal(size=(1500, 2)) * 0.05, np.array([[5.0, 5.0], [-5.0, 5.0], [5.0, -5.0], [-5.0, -5.0]])])
    rows = frame.sparkSession.createDataFrame([(i, i % 2, [float(v) for v in r]) for i, r in enumerate(crowd)], "sample_id long, outcome int, features array<double>")
    lift = M.draw_landmarks(rows.withColumn("features", M.array_to_vector("features")), "features", 0.5, 12, 7)
    assert (np.abs(lift.rows()) > 4).all(1).sum() >= 3


def test_few_distinct_rows_and_refusals(spark, frame):
    few = spark.createDataFrame([(i, i % 2, [float(i % 2), 1.0]) for i in range(60)], "sample_id long, outcome int, features array<double>")
    lift = M.draw_landmarks(few.withColumn("features", M.array_to_vector("features")), "features", 0.5, 50, 7)
    assert sorted(lift.rows().tolist()) == [[0.0, 1.0], [1.0, 1.0]] and lift.getOrDefault(lift.error)[1] < 1e-9
    with pytest.raises(ValueError):
        M.fit(frame, "svm", {"approximation": "none"})
    assert M.fit(frame, "svm", {"approximation": "random", "n_random": 16, "maxIter": 5}).stages[0].getOrDefault("size") == 16
