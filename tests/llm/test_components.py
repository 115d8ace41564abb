import numpy as np
import pytest

from phenoloom.llm import frames


def smallest(pairs):
    parent = {x: x for p in pairs for x in p}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    return {x: find(x) for x in parent}


def test_few_edges_need_few_jobs(spark):
    pairs = [(i, i + 1) for i in range(400)] + [(1000, 1000 + i) for i in range(1, 200)]
    spark.sparkContext.setJobGroup("few_edges", "")
    found = {r.node: r.component for r in frames.components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup("few_edges"))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert found == smallest(pairs)
    assert jobs <= 12


@pytest.mark.parametrize("most", [60, 7])
def test_many_tasks_agree(spark, monkeypatch, most):
    monkeypatch.setattr(frames, "TASK_EDGES", most)
    draw = np.random.default_rng(3)
    pairs = [tuple(map(int, draw.integers(0, 150, 2))) for _ in range(120)] + [(i, i + 1) for i in range(200, 290)]
    pairs = [p for p in pairs if p[0] != p[1]]
    found = {r.node: r.component for r in frames.components(spark.createDataFrame(pairs, "a long, b long").repartition(9)).collect()}
    assert found == smallest(pairs)
