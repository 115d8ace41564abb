import numpy as np
from pyspark.sql import functions as F

from phenoloom.llm import language_id as L
from phenoloom.llm import queries


def test_gradients():
    n = L.Network(["a", "b", "c"])
    n.weights = {k: v.astype(np.float64) for k, v in n.weights.items()}
    texts, target, weight = [b"abc", b"hello", b"x", b"zz zz"], np.array([0, 1, 2, 1]), np.array([1.0, 2, 1, 0.5])

    def loss():
        p, alive, _ = n.run(texts)
        w = alive * weight[None]
        return -(np.log(p[:, np.arange(4), target]) * w).sum() / w.sum()

    for k, g in n.gradients(texts, target, weight).items():
        i = np.unravel_index(np.abs(g).argmax(), g.shape)
        old = n.weights[k][i]
        n.weights[k][i] = old + 1e-2
        up = loss()
        n.weights[k][i] = old - 1e-2
        down = loss()
        n.weights[k][i] = old
        assert abs((up - down) / 2e-2 - g[i]) < 1e-3 * max(1, abs(g[i]))


def test_both_directions_see_the_word():
    n = L.Network(["a", "b"])
    p, alive, _ = n.run([b"abcd", b"xbcd", b"abcy"])
    assert np.abs(p[3, 0] - p[3, 1]).max() > 1e-6 and np.abs(p[0, 0] - p[0, 2]).max() > 1e-6 and alive.all()


def test_held_out_accuracy(documents):
    held = ~queries.learns_from()
    network = L.fit(documents.where(queries.learns_from()))
    rows = L.predict(documents, network).join(documents.where(held).select("doc_id", "lang", "n_chars"), "doc_id").collect()
    right = [r.lang_pred == r.lang for r in rows if r.n_chars >= 100]
    assert len(right) >= 20 and np.mean(right) >= 0.95
    assert all(0 <= r.score <= 1 for r in rows)


def test_odd_rows(documents, odd_documents):
    network = L.fit(odd_documents.unionByName(documents.select("*", *[F.lit(0).alias(c) for c in odd_documents.columns[5:]])))
    rows = L.predict(odd_documents, network).collect()
    assert len(rows) == 17
    und = {r.doc_id for r in rows if r.lang_pred == "und"}
    assert {1, 2, 3, 10} <= und and not und & {4, 6, 8, 11}
    same = {(r.lang_pred, r.score) for r in rows if r.doc_id in (4, 5)}
    assert len(same) == 1


def test_nothing_to_learn(odd_documents):
    network = L.fit(odd_documents.limit(0))
    assert {r.lang_pred for r in L.predict(odd_documents, network).collect()} == {"und"}
    assert L.predict(odd_documents.limit(0), network).count() == 0


def test_a_word_counts_alike_wherever_it_is():
    labels = L.WordLabels(L.Network(["a", "b"]))
    one = labels.documents(["some words here", None, "", "words  some\nhere"])
    two = L.WordLabels(labels.network).documents(["here", "words some"])
    assert np.allclose(one[0], one[3], atol=1e-5) and np.allclose(one[0], two.sum(0), atol=1e-5) and not one[1:3].any()
    assert L.cut(b"x" * 50) == [b"x" * 24, b"x" * 24, b"xx"]
