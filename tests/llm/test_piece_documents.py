import hashlib

import public_tokenizers
import sentencepiece

from phenoloom.llm import queries


def test_query_encodes_and_decodes_every_document(spark, documents, sf):
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    texts = {r.doc_id: r.text or "" for r in documents.collect()}
    rows = queries.op3(spark, sf).collect()
    assert len(rows) == len(texts) == documents.count()
    for r in rows:
        assert r.ids == library.encode(texts[r.doc_id]) and r.n_pieces == len(r.ids)
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()
