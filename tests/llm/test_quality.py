import numpy as np
import pytest
from pyspark.sql import functions as F

from phenoloom.llm import quality

WS = " \t\n\x0b\x0c\r"


def words(text):
    out, now = [], ""
    for c in text or "":
        if c in WS:
            out, now = out + [now] * bool(now), ""
        else:
            now += c
    return out + [now] * bool(now)


def brute(text):
    w = words(text) if len(text or "") < 50_000 else (text or "").encode().split()
    seen, gone = {}, set()
    for i in range(len(w) - 7):
        seen.setdefault(tuple(w[i : i + 8]), []).append(i)
    for at in seen.values():
        if len(at) > 1:
            gone.update(j for i in at for j in range(i, i + 8))
    lines = [x for x in (text or "").split("\n") if words(x)]
    chars = sum(len(x) if isinstance(x, str) else len(x.decode()) for x in w)
    symbols = sum((text or "").count(c) for c in "#*$%&|<>")
    return len(w), chars, symbols, len(lines) - len(set(lines)), len(gone), len(set(w))


def test_counts(documents, odd_documents):
    docs = documents.select("doc_id", "text", "lang", "source").unionByName(odd_documents.select("doc_id", "text", "lang", "source"))
    found = sorted((tuple(r) for r in quality.text_statistics(docs).select("doc_id", *quality.COUNTS).collect()), key=repr)
    assert found == sorted(((r.doc_id, *brute(r.text)) for r in docs.collect()), key=repr)


def test_verdicts(documents, odd_documents):
    docs = documents.unionByName(odd_documents.select(*documents.columns))
    rows = quality.judge(docs).collect()
    assert len(rows) == docs.count()
    for r in rows:
        failed = r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words
        assert r.base_failed == failed and r.kept == (not failed and r.distance <= quality.chi2_cut(quality.CHANCE, quality.P))


def test_junk_goes_and_clean_text_stays(spark, documents, sf):
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    rows = quality.judge(documents).where("not base_failed").join(labels, "doc_id").collect()
    junk, clean = [r.kept for r in rows if r.quality == 0], [r.kept for r in rows if r.quality == 1]
    assert not junk or np.mean(junk) <= 0.2
    assert np.mean(clean) >= 0.99


def test_estimate_ignores_outliers(spark):
    draw = np.random.default_rng(4)
    mix = draw.normal(size=(quality.P, quality.P)) * 0.3 + np.eye(quality.P)
    clean = draw.normal(size=(1600, quality.P)) @ mix.T + 3
    bad = draw.normal(size=(400, quality.P)) * 0.2 + 40
    rows = spark.createDataFrame([("a", x.tolist()) for x in np.vstack([clean, bad])], "grp string, x array<double>")
    got = quality.minimum_covariance(rows.repartition(4)).first()
    scatter = np.linalg.inv(np.reshape(got.inverse, (quality.P, quality.P)))
    assert got.rows == 2000 and np.abs(np.array(got.centre) - 3).max() < 0.4
    ratio = np.trace(scatter) / np.trace(mix @ mix.T)
    assert 0.6 < ratio < 1.5


def test_chi_squared():
    assert quality.chi2_above(0, 6) == 1 and abs(quality.chi2_above(quality.chi2_cut(0.05, 6), 6) - 0.05) < 1e-9
    assert abs(quality.chi2_cut(0.05, 6) - 12.5916) < 1e-3


def test_empty(odd_documents):
    assert quality.judge(odd_documents.limit(0)).count() == 0
    assert not any(r.kept for r in quality.judge(odd_documents.where(F.col("text").isNull())).collect())


@pytest.mark.parametrize("text", ["a|b<c>", "é ü\n\né ü\né ü ", "#*$%&|<>"])
def test_single_texts(text):
    got = quality.statistics_of([text])
    assert tuple(int(got[c][0]) for c in quality.COUNTS) == brute(text)
