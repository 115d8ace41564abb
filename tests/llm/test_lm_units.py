import numpy as np

from phenoloom.llm import lm_scoring as L


def test_rare_words_are_predicted_by_the_network(spark):
    # far more words than units, each seen once
    texts = [" ".join(f"w{i * 37 + j:x}q{(i * 41 + j) % 997}" for j in range(300)) for i in range(40)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    m = L.start(docs)
    units, beyond, counts = m.read(texts)
    assert not beyond.any() and counts.sum() == len(units) > 300 * 40
    names = {v: k for k, v in m.ids.items()}
    back = b"".join(names[u] for u in m.read(texts[:1])[0].tolist())
    assert back.decode() == " " + texts[0]
    rare = [m.read([f"w{k:x}"])[0].tolist() for k in (70_001, 70_002)]
    assert rare[0] != rare[1]


def test_rounds_visit_every_position_once():
    seeds, counts = np.array([5, 77, 9], np.uint64), np.array([40, 0, 300])
    for rounds in (1, 2, 3):
        seen = np.concatenate([L.masked(seeds, counts, k, rounds) for k in range(rounds)])
        assert sorted(seen.tolist()) == list(range(340))


def test_many_words_are_cut_like_one():
    draw = np.random.default_rng(7)
    alphabet = [b"a", b"b", b"ab", b"bab", "\u00e9".encode(), b"\x00", b"9"]
    words = [b"".join(draw.choice(alphabet, draw.integers(1, 12)).tolist()) for _ in range(3000)]
    units = {b" " + w for w in words[:40]}
    for w in words[:400]:
        marked = b" " + w
        a = int(draw.integers(0, len(marked)))
        units.add(marked[a : a + int(draw.integers(2, 7))])
    units = sorted(u for u in units if len(u) > 1)[: L.WHOLE]
    m = L.Model(units, np.zeros(257), {})
    each = [m.cut(w) for w in words]
    flat, sizes = m.cut_all(words)
    assert sizes.tolist() == [len(c) for c in each] and flat.tolist() == [u for c in each for u in c]
    assert m.cut_all([])[0].tolist() == [] and m.cut_all([])[1].tolist() == []


def test_blocks_of_products_add_up():
    draw = np.random.default_rng(2)
    a, x, y = draw.normal(size=(5, 7)), draw.normal(size=(7, 700)), draw.normal(size=(3, 700))
    assert np.allclose(L._times(a, x), a @ x) and np.allclose(L._against(x, y), x @ y.T) and L._times(a, x[:, :0]).shape == (5, 0)


def test_large_and_small_logits_give_the_same_shares():
    draw = np.random.default_rng(3)
    x = draw.normal(size=(6, 50))
    for size in (1.0, 30.0, 900.0):
        z = x * size
        want = np.exp(z - z.max(0)) / np.exp(z - z.max(0)).sum(0)
        assert np.allclose(L._softmax(z.copy(), np.abs(z).max()), want)
        assert np.allclose(L._log_share(z.copy(), np.zeros(50, int), np.abs(z).max()), z[0] - z.max(0) - np.log(np.exp(z - z.max(0)).sum(0)))
    assert L._bounds(np.array([[1.0, -2.0], [3.0, 0.5]]), np.array([-1.0, 0.0])) == 4.0


def test_words_are_counted_whole(spark, monkeypatch):
    texts = ["B a\tb\x0bA", None, "", " \n ", "\u00c9 \u00e9 a\u00a0b b\r\nb"] * 30
    docs = spark.createDataFrame([(t,) for t in texts], "text string").repartition(3)
    want = {"a": 60, "b": 120, "\u00c9": 30, "\u00e9": 30, "a\u00a0b": 30}
    assert {r.word: r.n for r in L.word_counts(docs).collect()} == want
    assert L.word_counts(docs.limit(0)).count() == 0
