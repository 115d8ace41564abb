from collections import Counter, defaultdict

import numpy as np
import pytest

from phenoloom.llm import odd_sketch as O
from phenoloom.llm.frames import components


def brute(rows, percent=80):
    sets = []
    for _, text in rows:
        w = (text or "").encode().lower().split()
        sets.append(frozenset(tuple(w[i : i + 4]) for i in range(len(w) - 3)) if len(w) >= 4 else frozenset([tuple(w)] if w else []))
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    first, holders = {}, defaultdict(list)
    for i, s in enumerate(sets):
        if s and s in first:
            parent[find(i)] = find(first[s])
        elif s:
            first[s] = i
            for x in s:
                holders[x].append(i)
    for s, i in first.items():
        for j, n in Counter(j for x in s for j in holders[x] if j < i).items():
            if 100 * n >= percent * (len(s) + len(sets[j]) - n):
                parent[find(i)] = find(j)
    low = {}
    for i, (key, _) in enumerate(rows):
        if key is not None:
            low[find(i)] = min(key, low.get(find(i), key))
    out = []
    for i, (key, _) in enumerate(rows):
        mine = low.get(find(i))
        out.append((key, len(sets[i]), mine, key is not None and key == mine))
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def near_copies(spark):
    """Chains and clouds of edited copies around the threshold, besides unrelated texts that share phrases."""
    draw = np.random.default_rng(12)
    words = [f"w{i}" for i in range(400)]
    rows = []
    for _ in range(6):
        base = draw.choice(words, 60).tolist()
        for _ in range(25):
            text = list(base)
            for _ in range(int(draw.integers(0, 4))):
                text[int(draw.integers(0, len(text)))] = str(draw.choice(words))
            rows.append(" ".join(text))
            if draw.random() < 0.2:
                base = text
    rows += [" ".join(draw.choice(words[:12], int(draw.integers(1, 9)))) for _ in range(60)]
    return [(i, t) for i, t in enumerate(rows)]


@pytest.mark.parametrize("sizes", [{}, {"bucket": 3, "block": 3, "shared": 1}])
def test_brute_force(spark, near_copies, documents, odd_documents, sizes):
    docs = spark.createDataFrame([(10**6 + i, t) for i, t in near_copies], "doc_id long, text string").repartition(4)
    docs = docs.unionByName(documents.select("doc_id", "text")).unionByName(odd_documents.selectExpr("doc_id + 2000000 AS doc_id", "text"))
    found = sorted(map(tuple, O.near_duplicates(docs, **sizes).collect()), key=repr)
    assert found == brute([tuple(r) for r in docs.collect()])


def test_clashing_columns_and_empty(odd_documents):
    assert O.near_duplicates(odd_documents).count() == 17
    assert O.near_duplicates(odd_documents.limit(0)).count() == 0


@pytest.mark.parametrize("similarity", [0.7, 0.8, 0.9, 0.95])
def test_the_sketch_estimates_similarity(similarity):
    draw = np.random.default_rng(int(similarity * 100))
    n, off = 400, []
    for _ in range(40):
        common = round(2 * n * similarity / (1 + similarity))
        pool = np.unique(draw.integers(0, 1 << 63, 3 * n).astype(np.uint64))
        draw.shuffle(pool)
        a, b = np.sort(pool[:n]), np.sort(pool[n - common : 2 * n - common])
        values, bounds = np.concatenate([a, b]), np.array([0, n, 2 * n])
        odd = O.odd_sketches(O.signatures(values, bounds)).view(np.uint64)
        bits = int(np.bitwise_count(odd[0] ^ odd[1]).sum())
        estimate = 1 + O.SKETCH_BITS / (4 * O.SAMPLES) * np.log(1 - 2 * bits / O.SKETCH_BITS)
        off.append(estimate - len(np.intersect1d(a, b)) / len(np.union1d(a, b)))
    assert abs(np.mean(off)) < 0.02 and np.std(off) < 0.07


def test_set_search():
    draw = np.random.default_rng(5)
    sets = [np.unique(draw.integers(0, 60, 30).astype(np.uint64)) for _ in range(60)]
    index = O.SetIndex(sets)
    for s in sets:
        assert index.common(s).tolist() == [len(np.intersect1d(s, t)) for t in sets]
    label = O.search_sets(sets, 45)
    linked = [[100 * (c := len(np.intersect1d(s, t))) >= 45 * (len(s) + len(t) - c) for t in sets] for s in sets]
    reach = np.linalg.matrix_power(np.array(linked, float) + np.eye(60), 60) > 0
    assert all((label[i] == label[j]) == reach[i, j] for i in range(60) for j in range(60))


def test_components(spark):
    draw = np.random.default_rng(1)
    pairs = [(i, i + 1) for i in range(100, 160)] + [(7, int(x)) for x in range(200, 400)] + [tuple(map(int, draw.integers(500, 700, 2))) for _ in range(90)]
    parent = {x: x for p in pairs for x in p}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    loops = {a for a, b in pairs if a == b} - {x for a, b in pairs if a != b for x in (a, b)}
    found = {r.node: r.component for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert found == {x: find(x) for x in parent if x not in loops}
