import public_tokenizers
import sentencepiece

from phenoloom.llm import piece_lattice as L

FILE = public_tokenizers.path("piece_bpe_32k.model")


def test_long_runs_equal_the_library(spark):
    library = sentencepiece.SentencePieceProcessor(model_file=FILE)
    texts = ["x" * 97, "x" * 400, "abcdefghij" * 500, " " * 33 + "a", "你好世界" * 200, "1" * 1000, "a1" * 500, "!" * 300, "\n\t ▁▁ a\r\n ", "ǅᴬ²½Ⅷ٣a٣ a²b ª", "", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    model = L.pieces(spark, FILE)
    encoded = L.encode_documents(docs, model, merges=True)
    found = {r.doc_id: r.ids for r in encoded.collect()}
    assert all(found[i] == library.encode(t or "") for i, t in enumerate(texts)) and len(found) == len(texts)
    decoded = L.decode(encoded, model, ["doc_id", "ids"]).select("doc_id", L.unmarked("decoded")).collect()
    assert dict(map(tuple, decoded)) == {i: t.replace("▁", " ") for i, t in enumerate(texts) if t}


def test_occurrences_of_words_are_not_shuffled(spark, documents):
    model = L.pieces(spark, FILE)
    for made in (L.word_ids(documents, model, merges=True), L.decode(L.encode_documents(documents, model, merges=True), model, ["doc_id", "ids"])):
        plan = made._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "Join" not in plan


def test_rows_that_share_a_key(spark):
    rows = [(1, "the house"), (1, "the tree"), (None, "a"), (2, "the tree"), (1, None)]
    model = L.pieces(spark, FILE)
    found = L.encode_documents(spark.createDataFrame(rows, "doc_id int, text string"), model, merges=True)
    words = {r.word: r.merged_ids for r in L.encode_words(spark.createDataFrame([("▁the",), ("▁house",), ("▁tree",), ("▁a",)], "word string"), model, True).collect()}
    mixed = [*words["▁the"], *words["▁the"], *sum(sorted([words["▁house"], words["▁tree"]]), [])]
    expected = [(1, mixed), (1, []), (2, words["▁the"] + words["▁tree"]), (None, words["▁a"])]
    assert sorted((map(tuple, found.collect())), key=str) == sorted(expected, key=str)
