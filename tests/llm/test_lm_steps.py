import numpy as np
import pyarrow as pa

from phenoloom.llm import lm_scoring as L


def model(seed=0):
    draw = np.random.default_rng(seed)
    return L.Model([b"the", b"of"], np.zeros(257), {k: draw.normal(0, 0.3, s) for k, s in L.SHAPES.items()})


def plain(m, words, context):
    """Gradients from whole matrices, position by position."""
    w, out = m.weights, {k: np.zeros(s) for k, s in L.SHAPES.items()}
    for word, near in zip(words.tolist(), context.T.tolist(), strict=True):
        h = np.tanh(sum(w["around"][k][c] for k, c in enumerate(near)) + w["bias"])
        c, i = divmod(word, L.IN_CLUSTER)
        p, q = np.exp(h @ w["cluster"] + w["cluster_bias"]), np.exp(w["word"][c] @ h + w["word_bias"][c])
        p, q = p / p.sum(), q / q.sum()
        p[c] -= 1
        q[i] -= 1
        back = (w["cluster"] @ p + w["word"][c].T @ q) * (1 - h * h)
        for k, g in (("cluster", np.outer(h, p)), ("cluster_bias", p), ("bias", back)):
            out[k] += g / len(words)
        out["word"][c] += np.outer(q, h) / len(words)
        out["word_bias"][c] += q / len(words)
        for k, one in enumerate(near):
            out["around"][k][one] += back / len(words)
    return out


def test_gradients_of_many_positions_and_rows_that_occur():
    m, draw = model(), np.random.default_rng(4)
    # one cluster with more positions than a block, others with few or none
    words = np.concatenate([draw.integers(0, 3, L.COLUMNS + 30), draw.integers(0, 200, 300), draw.integers(3000, L.CLASSES, 40)])
    draw.shuffle(words)
    context = m.context(words, np.array([len(words) - 7, 0, 7]))
    want, got = plain(m, words, context), m.gradients(words, context)
    for k in L.SHAPES:
        assert np.allclose(got[k], want[k], atol=1e-12)
    for near, (rows, _) in zip(context, m.slopes(words, context)[1], strict=True):
        assert rows.tolist() == sorted(set(near.tolist()))


def test_a_step_leaves_rows_that_do_not_occur():
    m = model()
    old = m.weights["around"].copy()
    words = np.array([5, 6, 7, 8], np.uint16)
    L.Trainer(m).step(words, m.context(words, np.array([4])))
    moved = np.flatnonzero((m.weights["around"] != old).any((0, 2)))
    assert moved.tolist() == [5, 6, 7, 8, L.EDGE]


def test_words_of_texts_are_those_of_bytes():
    texts = [None, "", " \n", "\x85A b\x0bC \x1cd", "É é a B b\r\nb  x \t", "a b  c", "x" * 5000] * 3
    words, counts = L._split(texts)
    each = [(x or "").encode().lower().split() for x in texts]
    assert [w.encode() for w in words.to_pylist()] == [w for ws in each for w in ws] and counts.tolist() == [*map(len, each)]
    assert counts.dtype == np.int64 and L._split([])[1].tolist() == [] and L._split(["a b"])[1].dtype == np.int64
    m = model()
    units, n, sizes = m.units_of(texts)
    assert units.tolist() == [u for ws in each for w in ws for u in m.cut(w)] and n.tolist() == counts.tolist() and sizes.sum() == len(units)


def test_lots_have_every_row_once(monkeypatch):
    monkeypatch.setattr(L, "LOT", 10)
    texts = ["a" * 4, None, "", "b" * 25, "c" * 9, None, "d", "e" * 3, ""]
    batch = pa.RecordBatch.from_arrays([pa.array(range(9)), pa.array(texts)], names=["k", "text"])
    for part in (batch, batch.slice(2, 5), batch.slice(0, 0)):
        lots = [x.column(0).to_pylist() for x in L._lots(part, 1)]
        assert sum(lots, []) == part.column(0).to_pylist() and all(lots)
    assert len([*L._lots(batch, 1)]) > 1
