from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

import numpy as np

from phenoloom.llm import substring_dedup
from phenoloom.llm.words import Windows, covered, inside


def brute(rows, width):
    words = [(k, (t or "").encode().split(), t) for k, t in rows]
    seen = Counter(tuple(w[i : i + width]) for _, w, _ in words for i in range(len(w) - width + 1))
    out = []
    for k, w, t in words:
        gone = [False] * len(w)
        for i in range(len(w) - width + 1):
            if seen[tuple(w[i : i + width])] > 1:
                gone[i : i + width] = [True] * width
        kept = None if t is None else b" ".join(x for x, g in zip(w, gone) if not g).decode()
        out.append((k, len(w), sum(gone), kept))
    return sorted(out, key=repr)


def as_rows(df):
    return sorted([(r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in df.collect()], key=repr)


@pytest.mark.parametrize("width", [35, 5, 1])
def test_brute_force(documents, odd_documents, width, monkeypatch):
    monkeypatch.setattr(substring_dedup, "GROUP_BYTES", 40_000)  # many groups and buckets
    monkeypatch.setattr(substring_dedup, "BUCKET_WINDOWS", 3_000)
    docs = documents.select("doc_id", "text").unionByName(odd_documents.select("doc_id", "text"))
    found = substring_dedup.remove_repeats(docs, width=width)
    assert as_rows(found) == brute([tuple(r) for r in docs.collect()], width)


def test_intervals_and_carried_columns(odd_documents):
    found = substring_dedup.remove_repeats(odd_documents, carry=("lang", "g", "k")).collect()
    assert len(found) == 17 and all(r.g == -1 and r.k == -1 for r in found)
    for r in found:
        assert sum(s.end - s.start for s in r.removed) == r.n_removed
        assert all(a.end < b.start for a, b in zip(r.removed, r.removed[1:]))


def test_empty(odd_documents):
    assert substring_dedup.remove_repeats(odd_documents.limit(0)).count() == 0


@settings(max_examples=40, deadline=None)
@given(st.lists(st.lists(st.integers(0, 3), max_size=12), max_size=6), st.integers(1, 5))
def test_windows(texts, width):
    draw = np.random.default_rng(0).integers(0, 1 << 63, 4).astype(np.uint64)
    flat = draw[[x for t in texts for x in t]] if any(texts) else np.zeros(0, np.uint64)
    lengths = np.array([len(t) for t in texts], np.int64)
    starts = np.flatnonzero(inside(lengths, width))
    hashes = Windows(width).of(flat)[starts]
    want = [tuple(t[i : i + width]) for t in texts for i in range(len(t) - width + 1)]
    assert len(hashes) == len(want)
    assert len(set(zip(hashes.tolist(), want))) == len(set(want)) == len(set(hashes.tolist()))
    assert covered(starts, int(lengths.sum()), width).sum() == sum(len(t) for t in texts if len(t) >= width)
