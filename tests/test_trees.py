"""Grown trees against a row-by-row grower in numpy on the same bins, draws and bags."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from phenoloom.operators import models as M
from phenoloom.operators import trees as T

NAMES = ["a", "b", "c", "d"]


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(4)
    out = []
    for i in range(400):
        x = [float(rng.integers(0, 9)), float(rng.normal()), float(rng.integers(0, 3)), 7.0]
        y = int(x[0] + 2 * x[1] * (x[2] == 1) + rng.normal() > 4.5)
        if i % 11 == 0:
            x[1] = None
        if i % 17 == 0:
            x[0] = math.nan
        out.append((i, y, x))
    return out


@pytest.fixture(scope="module")
def frame(spark, rows):
    return spark.createDataFrame(rows, "sample_id long, outcome int, features array<double>").repartition(3).persist()


def matrix(rows):
    return np.array([[math.nan if v is None else v for v in x] for _, _, x in rows])


def slow_tree(x, a, b, n, edges, rules, tree, scale=1.0):
    """Every row, every column, every edge, both sides for missing values; nodes in the order of levels."""
    nodes, todo = [], [(np.arange(len(x)), 0)]
    while todo:
        at, level = todo.pop(0)
        ga, gb, gn = (n[at] * a[at]).sum(), (n[at] * b[at]).sum(), n[at].sum()
        node = {"value": scale * rules.leaf(ga, gb), "rows": gn, "feature": -1, "gain": 0.0, "at": at}
        number = len(nodes)
        nodes.append(node)
        if (rules.depth is not None and level >= rules.depth) or gn < rules.least_split_rows:
            continue
        score = lambda p, q: p * p / (q + rules.l2) if q + rules.l2 > 0 else 0.0
        best = None
        drawn = T.columns_drawn(rules.seed, tree, number if rules.per_node else None, x.shape[1], rules.columns or x.shape[1])
        for j in drawn:
            v, missing = x[at, j], np.isnan(x[at, j])
            for e in [*edges[j], math.inf]:
                for missing_left in (False, True) if (n[at][missing] > 0).any() else (False,):
                    low = np.where(missing, missing_left, v <= e)
                    la, lb, ln = ((n[at] * s)[low].sum() for s in (a[at], b[at], np.ones(len(at))))
                    present = (n[at][low & ~missing] > 0).any()
                    if not present or ln < max(0.5, rules.least_child_rows) or gn - ln < max(0.5, rules.least_child_rows) or min(lb, gb - lb) < max(1e-12, rules.least_child_weight):
                        continue
                    gain = score(la, lb) + score(ga - la, gb - lb) - score(ga, gb)
                    rank = (round(gain, T.GAIN_DIGITS), -j, -e, missing_left)
                    if gain > T.LEAST_GAIN and (best is None or rank > best[0]):
                        best = rank, j, e, missing_left, low, gain
        if best:
            _, node["feature"], node["threshold"], node["missing_left"], low, node["gain"] = best
            node["left"], node["right"] = None, None
            todo += [(at[low], level + 1), (at[~low], level + 1)]
            node["sides"] = at[low], at[~low]
    return nodes


def walk(nodes, x):
    out = np.empty(len(x))
    for node in nodes:
        if node["feature"] < 0:
            out[node["at"]] = node["value"]
    return out


def shape(trees, tree):
    return [(f, None if f < 0 else round(t, 9) if t < math.inf else t, m, round(v, 6), round(g, 6), round(n, 6)) for k, _, f, t, m, _, _, v, g, _, n in trees.table() if k == tree]


def slow_shape(nodes):
    return [(x["feature"], None if x["feature"] < 0 else round(x["threshold"], 9) if x["threshold"] < math.inf else math.inf, x.get("missing_left"), round(x["value"], 6), round(x["gain"], 6), round(x["rows"], 6)) for x in nodes]


def hashes(frame, column):
    return np.array([r["h"] for r in frame.select("sample_id", column.alias("h")).orderBy("sample_id").collect()], np.int64)


@pytest.mark.parametrize("options", [{"depth": 1}, {"depth": 3, "l2": 0.5, "row_share": 0.7, "column_share": 0.5}, {"depth": 4, "least_child_weight": 3.0, "rate": 0.3}])
def test_boosting_equals_brute_force(frame, rows, options, monkeypatch):
    monkeypatch.setattr(T, "REFRESH", 2)
    monkeypatch.setattr(T, "CELLS", 1000)
    x, y = matrix(rows), np.array([r[1] for r in rows], float)
    found = T.boost(frame, rounds=3, **options)
    edges = T.bin_edges(frame)
    assert [len(set(e)) for e in edges] == [len(e) for e in edges] and len(edges[0]) == 8 and len(edges[2]) == 2 and edges[3] == [] and len(edges[1]) == T.MAX_BINS - 1
    o = {"rate": 0.1, "depth": 6, "l2": 1.0, "least_child_weight": 1.0, "column_share": 1.0, "row_share": 1.0} | options
    rules = T.Rules(o["depth"], o["l2"], o["least_child_weight"], columns=max(1, round(4 * o["column_share"])), share=o["row_share"], seed=42)
    h = hashes(frame, F.xxhash64("features", "outcome", F.lit(42)))
    margin = np.zeros(len(x))
    for t in range(3):
        p = 1 / (1 + np.exp(-margin))
        nodes = slow_tree(x, p - y, p * (1 - p), T.times_drawn(h, t, "share", o["row_share"]), edges, rules, t, o["rate"])
        assert shape(found, t) == slow_shape(nodes)
        # rows that are not drawn reach leaves as well
        margin += T.Walker(found).value[T.Walker(found).leaves(t, x, False)]


def test_pruning(frame):
    whole, cut = T.boost(frame, rounds=1, depth=4, rate=1.0), T.boost(frame, rounds=1, depth=4, rate=1.0, least_gain=5.0)
    assert 1 < len([f for f in cut.feature if f >= 0]) < len([f for f in whole.feature if f >= 0])
    reached, todo = [], [0]
    while todo:
        n = todo.pop()
        reached.append(n)
        todo += [cut.left[n], cut.right[n]] if cut.feature[n] >= 0 else []
    ends = [n for n in reached if cut.feature[n] >= 0 and cut.feature[cut.left[n]] < 0 and cut.feature[cut.right[n]] < 0]
    assert ends and all(cut.gain[n] >= 5.0 for n in ends)


def test_refused_settings(frame):
    for bad in ({"rounds": 0}, {"rate": 0.0}, {"row_share": 1.5}, {"l2": -1.0}):
        with pytest.raises(ValueError):
            T.boost(frame, **bad)
    with pytest.raises(ValueError):
        M.fit(frame, "xgboost", {"maxDeep": 3})


@pytest.mark.parametrize("options", [{"depth": 4}, {"depth": None, "least_leaf_rows": 5, "columns": 3}, {"depth": None, "least_split_rows": 40, "columns": "log2"}])
def test_forest_and_out_of_bag_equal_brute_force(frame, rows, options):
    x, y = matrix(rows), np.array([r[1] for r in rows], float)
    model = T.bagged_forest(frame, "sample_id", trees=4, together=3, **options)
    edges = T.bin_edges(frame)
    columns = {"columns": 2} | options
    rules = T.Rules(options.get("depth"), 0.0, 0.0, options.get("least_leaf_rows", 1), options.get("least_split_rows", 2), 2 if columns["columns"] == "log2" else columns["columns"], True, "bag", 1.0, False, 42)
    h = hashes(frame, T.row_hash("sample_id", 42))
    total, n = np.zeros(len(x)), np.zeros(len(x))
    for t in range(4):
        times = T.times_drawn(h, t, "bag", 1.0)
        nodes = slow_tree(x, y, np.ones(len(y)), times, edges, rules, t)
        assert shape(model, t) == slow_shape(nodes)
        out = times == 0
        total[out] += walk(nodes, x)[out]
        n += out
    found = T.out_of_bag(frame, "sample_id", model).orderBy("sample_id").collect()
    assert [r["n_trees"] for r in found] == n.tolist()
    for r, s, k in zip(found, total, n):
        assert (r["score"] is None) == (k == 0) and (not k or abs(r["score"] - s / k) < 1e-9)


def test_bags_are_poisson():
    h = np.arange(200_000, dtype=np.int64)
    drawn = T.times_drawn(h, 3, "bag", 1.0)
    assert abs(drawn.mean() - 1) < 0.01 and abs((drawn == 0).mean() - math.exp(-1)) < 0.005 and abs(drawn.var() - 1) < 0.02
    assert abs(np.corrcoef(drawn, T.times_drawn(h, 4, "bag", 1.0))[0, 1]) < 0.01
    assert abs(T.times_drawn(h, 3, "share", 0.3).mean() - 0.3) < 0.005


def test_odd_frames(spark):
    one = spark.createDataFrame([(i, i % 2, [1.0, None]) for i in range(10)], "sample_id long, outcome int, features array<double>")
    model = T.boost(one, rounds=2, depth=2)
    assert model.feature == [-1, -1] and model.value == [0.0, 0.0]
    missing = spark.createDataFrame([(i, i % 2, [None if i % 2 else 3.0]) for i in range(40)], "sample_id long, outcome int, features array<double>")
    model = T.boost(missing, rounds=1, depth=1)
    assert model.feature == [0, -1, -1] and not model.missing_left[0] and model.value[1] < 0 < model.value[2]
    assert T.Trees().part(0).roots == [] and T.Trees().importances(2).tolist() == [0.0, 0.0]


def test_fitted_model_reloads(frame, tmp_path):
    whole = frame.withColumn("features", F.transform("features", lambda v: F.nanvl(F.coalesce(v, F.lit(0.0)), F.lit(0.0))))
    m = M.fit(whole, "xgboost", {"maxIter": 4, "maxDepth": 2}, scale=True)
    m.write().overwrite().save(str(tmp_path / "b"))
    a, b = (M.predict(z, whole, ["sample_id"]).orderBy("sample_id").toPandas().score.tolist() for z in (m, M.PipelineModel.load(str(tmp_path / "b"))))
    assert a == b and dict(M.feature_weights(m, NAMES))["a"] > 0
