import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from phenoloom.llm import periodic_runs
from phenoloom.llm.queries import cycled


def brute(words, periods=4, shortest=6):
    """Every stretch that keeps a period as far as it goes, if it has no smaller one."""
    out = []
    for q in range(1, len(words) // periods + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(shortest, periods * q) and not any(all(words[t] == words[t + p] for t in range(i, j + q - p)) for p in range(1, q)):
                out.append((i, j + q - i, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def laid(texts, **kw):
    lengths = np.array([len(t) for t in texts], np.int64)
    found = periodic_runs.runs_of(np.array([x for t in texts for x in t], np.int64), lengths, **kw)
    return list(zip(*[x.tolist() for x in found]))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.lists(st.integers(0, 2), max_size=6), st.lists(st.integers(0, 3), min_size=1, max_size=7), st.integers(0, 40)), max_size=4), st.integers(4, 6), st.integers(1, 9))
def test_brute_force(parts, periods, shortest):
    texts = [head + [cycle[i % len(cycle)] for i in range(n)] for head, cycle, n in parts]
    want, at = [], 0
    for t in texts:
        want += [(s + at, n, p) for s, n, p in brute(t, periods, shortest)]
        at += len(t)
    assert laid(texts, periods=periods, shortest=shortest) == want


def test_long_periods():
    rng = random.Random(0)
    for period, copies in [(1000, 4), (999, 5), (1024, 4), (513, 9), (1, 5000)]:
        cycle = [rng.randrange(10**6) for _ in range(period)]
        text = [-1] * 7 + cycle * copies + cycle[: period // 2] + [-2, -3]
        assert (7, period * copies + period // 2, period) in laid([text, text])
    assert laid([[1, 2, 3] * 3 + [1, 2]]) == []  # fewer than four periods


def expected(doc_id, text, tail=None):
    words = (text or "").encode().split()
    if tail and words and (shape := tail(doc_id, len(words))):
        a, p = shape
        words = words[:a] + [words[a + (i - a) % p] for i in range(a, len(words))]
    runs = brute(words)
    gone = {i for s, n, p in runs for i in range(s + p, s + n)}
    return doc_id, len(words), runs, len(gone), b" ".join(w for i, w in enumerate(words) if i not in gone).decode()


def as_rows(df):
    return sorted([(r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.n_dropped, r.collapsed) for r in df.collect()], key=repr)


@pytest.mark.parametrize("tail", [None, cycled, lambda k, n: (n // 3, 1 + n // 20)])
def test_documents(spark, odd_documents, documents, tail, monkeypatch):
    monkeypatch.setattr(periodic_runs, "TOGETHER", 3000)
    looped = spark.createDataFrame([(20, "la " * 40 + "end"), (21, "a b a b a b a b x " * 5), (22, "ab " * 5), (23, "x " * 6)], "doc_id long, text string")
    docs = odd_documents.where("doc_id is null or doc_id not in (6, 7)").select("doc_id", "text").unionByName(looped).unionByName(documents.where("n_chars < 4000").select("doc_id", "text"))
    found = as_rows(periodic_runs.find_runs(docs, tail=tail))
    assert found == sorted([expected(*r, tail) for r in docs.collect()], key=repr)


def test_long_text_and_empty(odd_documents):
    out = {r.doc_id: r for r in periodic_runs.find_runs(odd_documents).collect()}
    assert out[6].n_words == 60_000 and out[7].n_words == 60_001 and out[2].collapsed == "" == out[3].collapsed
    assert out[4].runs[0].asDict() == {"start": 0, "length": 60, "period": 10} and out[4].n_dropped == 50
    assert periodic_runs.find_runs(odd_documents.limit(0)).count() == 0


def test_cycle():
    assert cycled(None, 5) is None
    for k in range(200):
        h = zlib.crc32(str(k).encode())
        shape = cycled(k, 57)
        assert (shape is None) == (h % 10 != 0)
        if shape:
            a, p = shape
            assert a == (h // 10) % 57 and 1 <= p <= 57 - a and p == 1 + (57 - a) // (3 + (h // 10) % 8)
