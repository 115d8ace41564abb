"""Documents without a character: their share of letters is 0 / 0, NaN in the SQL."""

import math

import pytest
from compare import difference

from phenoloom.operators import evaluation as E
from phenoloom.plans import cohorts as K
from phenoloom.plans import study as S
from phenoloom.plans.catalogue import ORACLES, QUERIES

CHARACTERS = ["a", "B", " ", "1", ".", "\n", ","]


def text_of(i):
    return "ab" + "".join(c * ((i * (2 * k + 3) + i * i) % (5 + k)) for k, c in enumerate(CHARACTERS))


def tables(spark, folder, empty):
    """Every fourth document has no label."""
    texts = {i: "" if i in empty else text_of(i) for i in range(120)}
    documents = [(i, t, "en", "web", len(t)) for i, t in texts.items()]
    labels = [(i, int(i % 3 > 0 or i % 7 == 0), int(i % 5 == 0)) for i in texts if i % 4]
    spark.createDataFrame(documents, "doc_id long, text string, lang string, source string, n_chars long").coalesce(1).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").coalesce(1).write.parquet(f"{folder}/labels.parquet")
    return str(folder)


@pytest.fixture(scope="module")
def folders(spark, tmp_path_factory):
    kinds = {"unlabelled": {4, 8}, "labelled": {4, 9, 10, 22, 33, 81}}
    return {kind: tables(spark, tmp_path_factory.mktemp(kind), empty) for kind, empty in kinds.items()}


@pytest.fixture
def shuffled(spark):
    """Joins as at size: the labels are not broadcast, and every document is measured before it meets them."""
    key = "spark.sql.autoBroadcastJoinThreshold"
    was = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield
    spark.conf.set(key, was)


def against_sql(spark, sf, name):
    import duckdb

    con = duckdb.connect()
    for t in ("documents", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet/*.parquet'")
    return difference(QUERIES[name](spark, sf), con, ORACLES[name])


@pytest.mark.parametrize("kind", ["unlabelled", "labelled"])
@pytest.mark.parametrize("name", ["auc_untied", "avg_precision_untied", "pr_points", "roc_points", "unpivot_wide", "youden"])
def test_equal_to_sql(spark, folders, name, kind):
    assert against_sql(spark, folders[kind], name) is None


def test_shares_as_in_sql(spark, tmp_path):
    rows = [(0, "", 0), (1, "ab", 0), (2, "1", 0), (3, None, 0), (4, "ab", None), (5, "ab1.", 4)]
    spark.createDataFrame(rows, "doc_id long, text string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    share = {r.sample_id: r.alpha_ratio for r in K.doc_table(spark, str(tmp_path)).collect()}
    assert math.isnan(share[0]) and math.isnan(share[2])
    assert (share[1], share[3], share[4], share[5]) == (math.inf, None, None, 0.5)


def test_threshold_that_is_no_number_loses_ties(spark):
    rows = [(float("nan"), 1), (0.8, 1), (0.8, 0), (0.3, 0)]
    best = E.youden(spark.createDataFrame(rows, "score double, actual int")).first()
    assert (best.threshold, best.youden_j) == (pytest.approx(0.55), pytest.approx(0.5))


@pytest.mark.parametrize("kind", ["unlabelled", "labelled"])
def test_rows_that_studies_share(spark, folders, shuffled, tmp_path, kind):
    c = K.docs(spark, folders[kind]).stored()
    pheno = c.pheno.where("sample_id > 20")
    rows = S.shared_rows(spark, str(tmp_path), "quality", c.matrix, pheno).collect()
    assert {r.sample_id for r in rows} == {i for i in range(21, 120) if i % 4}
    assert {r.sample_id for r in rows if math.isnan(r.features[-1])} == ({22, 33, 81} if kind == "labelled" else set())


@pytest.mark.parametrize("kind", ["unlabelled", "labelled"])
@pytest.mark.parametrize("name", ["moderated_t", "select_k_best"])
def test_equal_to_sql_with_shuffled_joins(spark, folders, shuffled, name, kind):
    assert against_sql(spark, folders[kind], name) is None
