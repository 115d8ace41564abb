import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from phenoloom.llm import contamination
from phenoloom.llm.contamination import Automaton, decontaminate

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words_of(text):
    return WORD.findall((text or "").translate(UPPER))


def brute(docs, items, width=10):
    windows = {}
    for k, t in items:
        w = words_of(t)
        m = min(width, len(w))
        for i in range(len(w) - m + 1 if w else 0):
            windows.setdefault(tuple(w[i : i + m]), set()).add(k)
    sizes = {len(w) for w in windows}
    out = []
    for k, t in docs:
        w, hit, found = words_of(t), set(), set()
        for m in sizes:
            for i in range(len(w) - m + 1):
                if tuple(w[i : i + m]) in windows:
                    hit.update(range(i, i + m))
                    found |= windows[tuple(w[i : i + m])]
        spans = []
        for i in sorted(hit):
            if spans and spans[-1][1] == i:
                spans[-1][1] = i + 1
            else:
                spans.append([i, i + 1])
        out.append((k, len(w), len(hit), [tuple(s) for s in spans], sorted(str(x) for x in found if x is not None)))
    return sorted(out, key=repr)


def as_rows(df):
    return sorted([(r.doc_id, r.n_words, r.n_hit, [tuple(s) for s in r.spans], r["items"]) for r in df.collect()], key=repr)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2), min_size=1, max_size=14), min_size=1, max_size=5), st.lists(st.integers(0, 3), max_size=40), st.integers(1, 6))
def test_automaton(items, text, width):
    automaton = Automaton()
    for item in items:
        automaton.add(item)
    factors = {tuple(x[i:j]) for x in items for i in range(len(x)) for j in range(i + 1, len(x) + 1)}
    state = length = 0
    for i, word in enumerate(text):
        state, length = automaton.step(state, length, word)
        assert length == max((n for n in range(i + 2) if tuple(text[i + 1 - n : i + 1]) in factors or n == 0))
    assert len(automaton.next) <= 2 * sum(map(len, items)) + 1
    windows = automaton.windows(items, width)
    want = {tuple(x[i : i + min(width, len(x))]) for x in items for i in range(len(x) - min(width, len(x)) + 1)}
    assert len(windows) == len(want) and {m for _, m in windows} == {len(w) for w in want}


def made(spark, seed, n_items, n_docs, vocabulary, longest):
    rng = random.Random(seed)
    word = lambda: rng.choice(["Ab", "CD", "e9", "É", "naïve", "x"])[: rng.randint(1, 5)] + str(rng.randrange(vocabulary))
    items = [(i % (n_items - 2), " ".join(word() for _ in range(rng.randint(0, longest)))) for i in range(n_items)]
    docs = []
    for i in range(n_docs):
        parts = []
        for _ in range(rng.randint(0, 6)):
            whole = rng.choice(items)[1].split()
            a = rng.randrange(len(whole) + 1)
            parts += whole[a : a + rng.randint(1, 25)] if rng.random() < 0.6 else [word() for _ in range(rng.randint(1, 9))]
        docs.append((i, rng.choice([" ", ", ", "\n--"]).join(parts)))
    return spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")


@pytest.mark.parametrize("longest, width, block, vocabulary", [(30, 10, 10**5, 3), (12, 4, 60, 1), (60, 3, 25, 2), (9, 10, 30, 1)])
def test_brute_force(spark, longest, width, block, vocabulary, monkeypatch):
    monkeypatch.setattr(contamination, "PIECE_WORDS", 20)
    monkeypatch.setattr(contamination, "BLOCK_WORDS", block)
    monkeypatch.setattr(contamination, "BLOCKS_AT_ONCE", 5)
    monkeypatch.setattr(contamination, "TOGETHER", 50)
    docs, items = made(spark, 1, 25, 60, vocabulary, longest)
    found = decontaminate(docs, items, width=width)
    assert as_rows(found) == brute([tuple(r) for r in docs.collect()], [tuple(r) for r in items.collect()], width)


def test_given_tables(spark, sf, documents, odd_documents):
    docs = documents.select("doc_id", "text").unionByName(odd_documents.select("doc_id", "text"))
    items = spark.read.parquet(f"{sf}/benchmark.parquet")
    want = brute([tuple(r) for r in docs.collect()], [tuple(r) for r in items.collect()])
    assert as_rows(decontaminate(docs, items)) == want and any(r[2] for r in want)


def test_odd_items(spark, odd_documents):
    items = spark.createDataFrame(
        [(1, None, "z"), (2, "", "z"), (3, "!?", "z"), (None, "a b", "z"), (None, None, None), (4, "X", None), (4, "x", "z"), (5, "one two three four five six seven eight nine ten one", "z")],
        "item_id long, text string, k string",
    )
    got = {r.doc_id: r for r in decontaminate(odd_documents.where("doc_id is not null"), items).collect()}
    assert as_rows(decontaminate(odd_documents, items)) == brute([(r.doc_id, r.text) for r in odd_documents.collect()], [tuple(r)[:2] for r in items.collect()])
    assert got[8].kept_text == "" and got[8].dropped and got[8]["items"] == ["4"]
    assert got[13].kept_text == " c" and got[13].n_hit == 2 and got[13]["items"] == []
    assert got[1].kept_text is None and not got[1].dropped and got[1].n_words == 0
    assert got[4].longest == 11 and got[4].n_hit == 60 and got[6].n_hit == 0
    assert got[11].kept_text == odd_documents.where("doc_id = 11").first().text


def test_empty_tables(spark, odd_documents, sf):
    items = spark.read.parquet(f"{sf}/benchmark.parquet")
    assert decontaminate(odd_documents.limit(0), items).count() == 0
    assert all(r.n_hit == 0 and r.spans == [] for r in decontaminate(odd_documents, items.limit(0)).collect())
