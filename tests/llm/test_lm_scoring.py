import numpy as np

from phenoloom.llm import lm_scoring as L


def model(seed=0, scale=0.3):
    draw = np.random.default_rng(seed)
    return L.Model([b"the", b"of"], np.log(np.full(257, 1 / 257)), {k: draw.normal(0, scale, s) for k, s in L.SHAPES.items()})


def test_gradients():
    m, draw = model(), np.random.default_rng(1)
    words = draw.integers(0, L.CLASSES, 40)
    context = m.context(words, np.array([15, 0, 25]))
    for k, g in m.gradients(words, context).items():
        i = np.unravel_index(np.abs(g).argmax(), g.shape)
        old = m.weights[k][i]
        m.weights[k][i] = old + 1e-4
        up = -m.log_probabilities(words, context).mean()
        m.weights[k][i] = old - 1e-4
        down = -m.log_probabilities(words, context).mean()
        m.weights[k][i] = old
        assert abs((up - down) / 2e-4 - g[i]) < 1e-5


def test_context_has_both_sides_and_edges():
    m = model()
    context = m.context(np.array([5, 6, 7, 8]), np.array([3, 1]))
    assert context.T.tolist() == [[L.EDGE, L.EDGE, 6, 7], [L.EDGE, 5, 7, L.EDGE], [5, 6, L.EDGE, L.EDGE], [L.EDGE] * 4]


def test_probabilities_add_up_to_one():
    m = model()
    for around in ([3, 9, 200, 4000], [L.EDGE] * 4):
        context = np.repeat(np.array(around)[:, None], L.CLASSES, 1)
        assert abs(np.exp(m.log_probabilities(np.arange(L.CLASSES), context)).sum() - 1) < 1e-6


def test_training_helps_and_scores_are_sums(spark, documents, odd_documents):
    docs = documents.select("doc_id", "text").unionByName(odd_documents.where("length(text) < 1000 or text is null").select("doc_id", "text"))
    plain = L.start(docs)
    better = L.train(docs)
    before, after = (sum(r.log_prob for r in L.score(docs, m).collect()) for m in (plain, better))
    assert after > before
    texts = {r.doc_id: r.text for r in documents.collect()}
    for r in L.score(documents, better).collect()[:20]:
        words, spelt, counts = better.read([texts[r.doc_id]])
        each = better.log_probabilities(words, better.context(words, counts)) + spelt
        assert r.n_words == len(texts[r.doc_id].encode().split()) and abs(r.log_prob - each.sum()) < 1e-3 * r.n_words


def test_odd_rows(odd_documents):
    m = L.train(odd_documents.limit(0), rounds=1)
    rows = {(r.doc_id, r.n_words): r for r in L.score(odd_documents, m).collect()}
    for key in ((1, 0), (2, 0), (3, 0), (None, 0)):
        assert rows[key].log_prob == 0 and rows[key].mean_log_prob is None
    assert rows[8, 1].log_prob == rows[9, 1].log_prob < 0 and rows[6, 60_000].log_prob < 0
    assert L.score(odd_documents.limit(0), m).count() == 0
