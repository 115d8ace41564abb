import numpy as np
import pytest

from phenoloom.llm import embed_dedup as D


def brute(rows, cosine):
    ok = [i for i, (_, v, lab) in enumerate(rows) if lab is not None and v and None not in v and np.isfinite(v).all() and np.any(v)]
    scaled = {i: np.array(rows[i][1]) / np.abs(rows[i][1]).max() for i in ok}
    unit = {i: x / np.linalg.norm(x) for i, x in scaled.items()}
    links, parent = dict.fromkeys(range(len(rows)), 0), list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in ok:
        for j in ok:
            if i != j and rows[i][2] == rows[j][2] and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= cosine:
                links[i] += 1
                parent[find(i)] = find(j)
    out = []
    for i, (key, _, _) in enumerate(rows):
        mine = [rows[j][0] for j in range(len(rows)) if find(j) == find(i) and rows[j][0] is not None]
        low = min(mine, default=None)
        out.append((key, links[i], low, key is not None and key == low))
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def vectors():
    draw = np.random.default_rng(8)
    rows = []
    for c in range(12):
        centre = draw.normal(size=16)
        for _ in range(int(draw.integers(1, 40))):
            rows.append((len(rows), (centre + draw.normal(size=16) * 0.08 * np.linalg.norm(centre) / 4).tolist(), c % 3))
    rows += [(len(rows) + i, draw.normal(size=16).tolist(), i % 3) for i in range(150)]
    n = len(rows)
    rows += [(n, rows[0][1], rows[0][2]), (n + 1, rows[0][1], None), (n + 2, None, 1), (n + 3, [0.0] * 16, 1), (n + 4, [float("nan")] * 16, 1)]
    rows += [(n + 5, [None] + [1.0] * 15, 1), (n + 6, [float("inf")] + [1.0] * 15, 1), (n + 7, [], 1), (n + 8, [1e300] * 16, 2), (n + 9, [1e-300] * 16, 2), (None, rows[0][1], rows[0][2])]
    return rows


@pytest.mark.parametrize("block", [1024, 7])
def test_brute_force(spark, vectors, block):
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<double>, label int").repartition(5)
    rows = D.near_duplicates(df, block=block, target=0.99999).collect()
    assert sorted(map(tuple, rows), key=repr) == brute(vectors, D.COSINE)


def test_traversal_is_by_nearness_and_reaches_the_target():
    draw = np.random.default_rng(2)
    points = draw.normal(size=(1500, 16))
    points /= np.linalg.norm(points, axis=1, keepdims=True)
    books = [D.codebook(points[:, :8], 10, 1), D.codebook(points[:, 8:], 10, 2)]
    index = D.Index(books, D.radius(points, books, 0.98, 0.99))
    rows, cells = index.visits(points[:50])
    _, a = D.nearness(points[:50, :8], books[0])
    _, b = D.nearness(points[:50, 8:], books[1])
    want = {(i, j * 10 + k) for i in range(50) for j in range(10) for k in range(10) if a[i, j] + b[i, k] <= index.reach}
    assert set(zip(rows.tolist(), cells.tolist())) == want and len(rows) == len(want)
    assert {(i, c) for i, c in enumerate(index.cells(points[:50]).tolist())} <= want
    turn = draw.normal(size=points.shape)
    turn -= (turn * points).sum(1, keepdims=True) * points
    turn /= np.linalg.norm(turn, axis=1, keepdims=True)
    partner = 0.98 * points + np.sqrt(1 - 0.98**2) * turn
    rows, cells = index.visits(points)
    seen = set(zip(rows.tolist(), cells.tolist()))
    assert np.mean([(i, c) in seen for i, c in enumerate(index.cells(partner).tolist())]) >= 0.97


def test_empty_and_unusable(spark):
    schema = "vec_id long, embedding array<float>, label int, node int, cell int"
    assert D.near_duplicates(spark.createDataFrame([], schema)).count() == 0
    rows = D.near_duplicates(spark.createDataFrame([(1, None, 1, 0, 0), (2, [1.0], None, 0, 0), (3, [0.0], 1, 0, 0)], schema)).collect()
    assert sorted(map(tuple, rows)) == [(1, 0, 1, True), (2, 0, 2, True), (3, 0, 3, True)]
    rows = D.near_duplicates(spark.createDataFrame([(1, [2.0], 1, 0, 0), (2, [3.0], 1, 0, 0), (3, [-1.0], 1, 0, 0)], schema)).collect()
    assert sorted(map(tuple, rows)) == [(1, 1, 1, True), (2, 1, 1, False), (3, 0, 3, True)]


def test_lengths_are_kept_apart(spark):
    draw = np.random.default_rng(5)
    rows = []
    for n, (length, many) in enumerate([(8, 300), (16, 120), (3, 9), (1, 3)]):
        centres = draw.normal(size=(max(2, many // 6), length))
        for i in range(many):
            c = centres[i % len(centres)]
            rows.append((len(rows), (c * (1 + n) + draw.normal(size=length) * 0.05 * np.linalg.norm(c) / np.sqrt(length)).tolist(), i % 2))
    rows += [(len(rows) + i, [1.0, 2.0, 3.0], 1) for i in range(3)] + [(len(rows) + 3, [1.0, 2.0, 3.0] + [0.0] * 5, 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(4)
    assert sorted(map(tuple, D.near_duplicates(df, target=0.99999).collect()), key=repr) == brute(rows, D.COSINE)


def test_very_many_equal_vectors(spark):
    draw = np.random.default_rng(6)
    centre = draw.normal(size=8)
    near = [(centre + draw.normal(size=8) * 0.02).tolist() for _ in range(5)]
    rows = [(i, centre.tolist(), 1) for i in range(20_000)] + [(20_000 + i, x, 1) for i, x in enumerate(near)] + [(20_005 + i, draw.normal(size=8).tolist(), 1) for i in range(100)]
    found = {r.vec_id: r for r in D.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"), target=0.99999).collect()}
    unit = np.array([x[1] for x in rows[20_000:]] + [centre])
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    alike = unit @ unit.T >= D.COSINE
    np.fill_diagonal(alike, False)
    assert alike[-1, :5].all() and len(found) == len(rows)
    assert all(found[i].n_links == 19_999 + alike[-1, :-1].sum() and found[i].component_id == 0 for i in range(20_000))
    for k in range(105):
        assert found[20_000 + k].n_links == alike[k, :-1].sum() + 20_000 * alike[k, -1]
