"""Shadows drawn in nodes, and the p-values of importances, against brute force and under chance alone."""

import math
from collections import Counter

import numpy as np
import pytest

from phenoloom.operators import selection as Z
from phenoloom.operators import trees as T


def brute(values):
    null = [v for v in values if v is not None and not math.isnan(v) and v <= 0]
    null += [-v for v in null if v < 0]
    return [None if v is None or math.isnan(v) or not null else sum(n >= v for n in null) / len(null) for v in values]


def test_p_values_equal_brute_force(spark):
    rng = np.random.default_rng(1)
    values = [*rng.normal(0.3, 1, 400).round(2).tolist(), *[-0.5] * 300, *[0.0, -0.0, 0.0], None, math.nan, 9.0]
    table = spark.createDataFrame([(i, "x", v) for i, v in enumerate(values)], "i int, p_value string, importance double").repartition(5)
    got = {r["i"]: r["p_value"] for r in Z.mirrored_p_values(table).collect()}
    assert len(got) == len(values)
    for i, p in enumerate(brute(values)):
        assert got[i] == (p if p is None else pytest.approx(p))


def test_p_values_of_groups_nulls_and_nothing(spark):
    rows = [("a", 1.0), ("a", 2.0), ("b", -1.0), ("b", 0.5), (None, -2.0), (None, 1.0), (None, 3.0)]
    table = spark.createDataFrame(rows, "g string, importance double")
    got = {(r["g"], r["importance"]): r["p_value"] for r in Z.mirrored_p_values(table, by=["g"]).collect()}
    assert got == {("a", 1.0): None, ("a", 2.0): None, ("b", -1.0): 1.0, ("b", 0.5): 0.5, (None, -2.0): 1.0, (None, 1.0): 0.5, (None, 3.0): 0.0}
    assert Z.mirrored_p_values(table.limit(0)).collect() == []


def test_dealt_cases_keep_the_totals_and_the_spread():
    rows, rng = np.array([50, 0, 30, 400, 20]), np.random.default_rng(0)
    for below in (10**9, 0):
        draws = np.array([T.dealt(rows, 90, rng, below) for _ in range(4000)])
        assert (draws.sum(axis=1) == 90).all() and (draws >= 0).all() and (draws <= rows).all()
        share = rows / rows.sum()
        assert np.allclose(draws.mean(axis=0), 90 * share, atol=0.4)
        assert np.allclose(draws.var(axis=0), 90 * share * (1 - share) * 410 / 499, rtol=0.15, atol=0.2)


def test_shadow_cases_do_not_depend_on_order_or_slots():
    rng = np.random.default_rng(3)
    slot, feature, bin_ = (x.ravel() for x in np.meshgrid([0, 1], [0, 2, 5], [-1, 0, 1, 2], indexing="ij"))
    n = rng.integers(1, 50, len(slot)).astype(float)
    a = np.floor(n / 3)
    one = T.shadow_cases(slot, feature, bin_, a, n, {0: (7, 1), 1: (7, 2)}, 5)
    mix = rng.permutation(len(slot))
    two = T.shadow_cases(1 - slot[mix], feature[mix], bin_[mix], a[mix], n[mix], {1: (7, 1), 0: (7, 2)}, 5)
    assert (one[mix] == two).all()
    for s in (0, 1):
        for f in (0, 2, 5):
            here = (slot == s) & (feature == f)
            assert one[here].sum() == a[here].sum() and (one[here] <= n[here]).all()


WIDTH = 60


@pytest.fixture(scope="module")
def chance(spark):
    """58 features of chance with 2 to 64 values, and two that matter."""
    rng = np.random.default_rng(8)
    x = np.stack([rng.integers(0, 2 ** (1 + j % 6), 600) for j in range(WIDTH)], axis=1).astype(float)
    y = (x[:, 0] + x[:, 5] / 31 + rng.normal(0, 0.6, 600) > 1.5).astype(int)
    frame = spark.createDataFrame([(i, int(y[i]), x[i].tolist()) for i in range(600)], "sample_id long, outcome int, features array<double>")
    return frame.repartition(4).persist()


def test_p_values_of_chance_are_even_and_the_signal_stands_out(chance):
    names = [f"f{j}" for j in range(WIDTH)]
    table = Z.shadow_importance(chance, names, "sample_id", trees=60, depth=4)
    got = {r["feature"]: r for r in Z.mirrored_p_values(table).collect()}
    assert got["f0"]["p_value"] < 0.02 and got["f5"]["p_value"] < 0.02
    noise = [n for n in names if n not in ("f0", "f5")]
    p = np.sort([got[n]["p_value"] for n in noise])
    distance = np.max(np.abs(p - (np.arange(len(p)) + 0.5) / len(p)))
    assert distance < 1.36 / math.sqrt(len(p))
    # shadows lose the bias towards features of many values
    by_kind = {k: np.mean([got[n]["importance"] for n in noise if int(n[1:]) % 6 == k]) for k in range(6)}
    spread = np.std([got[n]["importance"] for n in noise]) / math.sqrt(len(noise) / 6)
    assert all(abs(v) < 3.5 * spread for v in by_kind.values()), (by_kind, spread)


def test_credits_are_the_gains_of_nodes(chance):
    model, credits = T.shadowed_forest(chance, "sample_id", trees=6, depth=3, columns=8)
    again, same = T.shadowed_forest(chance.repartition(7), "sample_id", trees=6, depth=3, columns=8, together=2)
    assert vars(model) == vars(again) and sorted(credits) == sorted(same)
    nodes = {(t, n): (f, gain) for t, n, f, _, _, _, _, _, gain, _, _ in model.table()}
    size = [model.rows[r] for r in model.roots]
    assert max(Counter((t, n) for t, n, _, _ in credits).values()) == 1 and any(g < 0 for *_, g in credits)
    for t, n, f, g in credits:
        if g > 0:
            assert nodes[t, n][0] == f and g == pytest.approx(nodes[t, n][1] / size[t])
        else:
            assert -g * size[t] > nodes[t, n][1] - 1e-9


def test_labels_must_be_cases_or_not(spark):
    frame = spark.createDataFrame([(1, 2, [1.0]), (2, 0, [2.0])], "sample_id long, outcome int, features array<double>")
    with pytest.raises(ValueError, match="0 or 1"):
        T.shadowed_forest(frame, "sample_id")
    with pytest.raises(ValueError, match="share"):
        T.shadowed_forest(frame.where("outcome = 0"), "sample_id", share=0)
