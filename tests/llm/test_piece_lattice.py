import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

from phenoloom.llm import piece_lattice as L

FILE = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def model(spark):
    return L.pieces(spark, FILE)


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=FILE)


def best_score(library, text):
    """Highest sum of scores over all segmentations of a marked text, an unknown character at the lowest score less ten."""
    ordinary = {library.id_to_piece(i): library.get_score(i) for i in range(259, library.get_piece_size())}
    low, best = min(ordinary.values()) - 10, [0.0] + [float("-inf")] * len(text)
    for end in range(1, len(text) + 1):
        for start in range(max(0, end - 16), end):
            score = ordinary.get(text[start:end], low if end - start == 1 else None)
            if score is not None:
                best[end] = max(best[end], best[start] + score)
    return best[-1]


TEXTS = ["  a   b ", "a\tb\n\nc 你好😀 ﬁ", "", " ", None, "\n", " \n ", "hest. the, (x) a1b2c3 1eb9c654e721b4f8", "é É J̌", "x" * 90, "straightforward addEventListener 12.50, ok..."]


def test_best_score_round_trip_and_merges(spark, documents, model, library):
    docs = documents.select("doc_id", "text").limit(40).unionByName(spark.createDataFrame([(10**6 + i, t) for i, t in enumerate(TEXTS)], "doc_id long, text string"))
    texts = {r.doc_id: r.text for r in docs.collect()}
    encoded = L.encode_documents(docs, model)
    found = {r.doc_id: r.ids for r in encoded.collect()}
    assert found.keys() == texts.keys()
    low = min(library.get_score(i) for i in range(259, library.get_piece_size())) - 10
    for key, text in texts.items():
        marked = "▁" + text.replace(" ", "▁") if text else ""
        # bytes of one unknown character count once
        spelt = sum(low for c in marked if library.piece_to_id(c) == library.unk_id())
        got = sum(library.get_score(i) for i in found[key] if not library.is_byte(i)) + spelt
        assert got == pytest.approx(best_score(library, marked), abs=1e-3)
    decoded = {r.doc_id: r.t for r in L.decode(encoded.where("size(ids) > 0"), model, ["doc_id"]).select("doc_id", L.unmarked(F.col("decoded")).alias("t")).collect()}
    assert all(decoded.get(k, "") == (t or "") for k, t in texts.items())
    merged = {r.doc_id: r.ids for r in L.encode_documents(docs, model, merges=True).collect()}
    assert all(merged[k] == library.encode(t or "") for k, t in texts.items())


def test_words_join_up_to_the_text(odd_documents):
    rows = odd_documents.select("text", L.words_of(F.col("text")).alias("w")).collect()
    for r in rows:
        assert "".join(r.w or []) == ("▁" + r.text.replace(" ", "▁") if r.text else "")


def test_plan_keeps_words_together(spark, documents, model):
    words = L.vocabulary(documents)
    plan = L.encode_words(words, model)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Cartesian" not in plan and "SortMergeJoin" not in plan


def test_empty(odd_documents, model):
    assert L.encode_words(L.vocabulary(odd_documents.limit(0)), model).count() == 0
    assert L.encode_documents(odd_documents.limit(0), model).count() == 0
