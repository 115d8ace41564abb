import pytest
from test_odd_sketch import brute as groups
from test_packing import expected
from test_quality import brute as counts
from test_substring_dedup import brute as passages

import corpus_pipeline as C
from phenoloom.llm import queries
from phenoloom.llm.frames import stored


def rows(df):
    return sorted((tuple(r) for r in df.select(*C.COLUMNS).collect()), key=repr)


@pytest.fixture(scope="module")
def stages(spark, documents, sf):
    """What goes into each stage and what comes out, each written and read again."""
    out, docs = [], documents
    for name, stage in C.STAGES:
        after = stored(stage(spark, docs, sf))
        out.append((name, docs, after))
        docs = after
    return {name: (before, after) for name, before, after in out}


def test_columns(stages, documents):
    for name, (_, after) in stages.items():
        if name != "packing":
            assert sorted(after.dtypes) == sorted(documents.dtypes)


def test_quality(spark, stages, sf):
    before, after = map(rows, stages["quality_rules"])
    kept, labels = set(after), {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    assert kept <= set(before)
    for r in before:
        n, _, _, _, repeated, _ = counts(r[1])
        failed = n < 20 or 100 * repeated > 30 * n
        if failed:
            assert r not in kept
        elif labels.get(r[0]) == 1:
            assert r in kept


def test_language(stages):
    before, after = map(rows, stages["language_id"])
    assert len(after) >= 0.99 * len(before) and set(after) <= set(before)


def test_one_of_each_group_stays(stages):
    before, after = map(rows, stages["near_dedup"])
    want = {k for k, _, _, kept in groups([r[:2] for r in before]) if kept}
    assert {r[0] for r in after} == want and len(after) == len(want)


def test_passages(stages):
    before, after = map(rows, stages["substring_dedup"])
    by = {r[0]: r for r in before}
    want = {k: (kept if gone else by[k][1]) for k, _, gone, kept in passages([r[:2] for r in before], 35)}
    assert {r[0]: r[1] for r in after} == want
    assert all(r[4] == (by[r[0]][4] if r[1] == by[r[0]][1] else len(r[1])) for r in after)


def test_packing(spark, stages, sf):
    from tokenizers import Tokenizer

    before, after = stages["packing"]
    want = expected(Tokenizer.from_str(queries.tokenizer_json()), [r[:2] for r in rows(before)], 2048)
    assert sorted([(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in after.collect()], key=repr) == want
    assert C.run(spark, sf).count() == len(want)


def test_odd_rows(spark, odd_documents):
    docs = stored(odd_documents)
    for name, stage in C.STAGES:
        after = stored(stage(spark, docs, ""))
        if name == "packing":
            assert after.count() >= docs.count()
        else:
            assert after.columns == C.COLUMNS and after.count() <= docs.count()
    near = C.near_dedup(spark, docs, "").collect()
    assert sum(r.text is not None and r.text.startswith("one two three") for r in near) == 1
    assert sum(r.text == "x" for r in near) == 1 and sum(r.text is None for r in near) == 2
    none = docs.limit(0)
    assert all(stage(spark, none, "").count() == 0 for _, stage in C.STAGES)
