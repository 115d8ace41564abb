import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from phenoloom.llm import packing, queries


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_str(queries.tokenizer_json())


def expected(tokenizer, texts, capacity):
    out = []
    for key, text in texts:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [0]
        for p in range(-(-len(ids) // capacity)):
            part = ids[p * capacity : (p + 1) * capacity]
            out.append((key, p, p * capacity, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
    return sorted(out, key=repr)


@pytest.mark.parametrize("capacity", [2048, 100])
def test_pieces_and_places(spark, documents, odd_documents, tokenizer, capacity):
    docs = documents.select("doc_id", "text").unionByName(odd_documents.select("doc_id", "text"))
    rows = packing.pack(packing.pieces(docs, queries.tokenizer_json(), capacity=capacity), capacity=capacity).collect()
    want = expected(tokenizer, [tuple(r) for r in docs.collect()], capacity)
    assert sorted([(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows], key=repr) == want
    bins = {}
    for r in rows:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    least = -(-sum(r.length for r in rows) // capacity)
    assert least <= len(bins) <= 1.02 * least + 1


def test_ids_are_those_of_the_pieces(odd_documents, tokenizer):
    rows = packing.pieces(odd_documents, queries.tokenizer_json(), with_ids=True).collect()
    assert all(zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32 and len(r.ids) == r.length for r in rows)


def test_empty(odd_documents):
    assert packing.pack(packing.pieces(odd_documents.limit(0), queries.tokenizer_json())).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 60), st.integers(1, 40), max_size=25))
def test_every_piece_is_used_once(counts):
    left = dict(counts)
    for use, times in packing.minimum_bin_slack(counts, 60):
        assert sum(x * k for x, k in use) <= 60 and times > 0
        for x, k in use:
            left[x] -= k * times
    assert not any(left.values())


def test_a_bin_is_as_full_as_it_can_be():
    first = packing.minimum_bin_slack({50: 1, 9: 3, 4: 2, 3: 1}, 70)[0]
    assert first == ([(50, 1), (9, 1), (4, 2), (3, 1)], 1)


def test_words_that_come_again_are_remembered(tokenizer, monkeypatch):
    monkeypatch.setattr(packing, "REMEMBERED", 30)
    words = packing.WordTokens(queries.tokenizer_json())
    learned = []
    learn = words.learn
    monkeypatch.setattr(words, "learn", lambda new: (learned.extend(new), learn(new)))
    texts = [[f"house tree*** river. River! {'x' * i} a{i} été,,, it's l'été <|endoftext|> .,: {i}th--", None, "", " \t\n\x0b\x0c\r house"] for i in range(1, 30)]
    for batch in texts:
        ids, bounds = words.encode(batch, 0)
        for text, a, b in zip(batch, bounds, bounds[1:], strict=False):
            assert ids[a:b].tolist() == tokenizer.encode(text or "", add_special_tokens=False).ids + [0]
    assert learned.count(b"house") == learned.count(b"tree***") == 1 and len(words.place) < 60
