import warnings

import pytest
from pyspark.sql import functions as F

from phenoloom.functions import scalar as S
from phenoloom.operators import cohort as C
from phenoloom.operators import shape
from phenoloom.sources import tables as IO


def test_covariate_aliases():
    assert C.find_covariates(["P1", "Age_at_recruitment", "SEX", "BMI"]) == {"sex": "SEX", "age": "Age_at_recruitment", "bmi": "BMI"}
    assert C.find_covariates(["age", "Age"]) == {"age": "age"}


def test_outcome_column():
    assert C.outcome_column(["a", "AOD_diff_case_t0_incid"], "case_t0") == "AOD_diff_case_t0_incid"
    for columns in (["a"], ["x_case_t0", "y_case_t0"]):
        with pytest.raises(ValueError):
            C.outcome_column(columns, "case_t0")


def test_modes():
    assert C.mode_columns(["P1", "age"], ["bmi"], "prot_only") == (["P1"], [])
    assert C.mode_columns(["P1", "age"], ["bmi"], "sexagebmi") == (["age"], [])
    assert C.mode_columns(["P1"], ["x", "bmi"], "sexagebmi") == ([], ["bmi"])
    assert C.mode_columns(["P1"], ["Sex", "bmi"], "comb") == (["P1"], ["Sex", "bmi"])
    with pytest.warns(UserWarning):
        assert C.mode_columns(["P1"], ["x"], "comb") == (["P1"], [])
    for cols, mode in ((["P1"], "sexagebmi"), (["P1", "age"], "everything")):
        with pytest.raises(ValueError):
            C.mode_columns(cols, ["x"], mode)


def test_alignment_is_checked(spark):
    a = spark.createDataFrame([(1,), (2,)], "sample_id int")
    b = spark.createDataFrame([(3,)], "sample_id int")
    with pytest.raises(ValueError):
        C.require_overlap(a, b, "sample_id", "t")
    with pytest.raises(ValueError):
        C.require_overlap(a.union(a), a, "sample_id", "t")
    with pytest.warns(UserWarning):
        C.require_overlap(a, a.where("sample_id = 1"), "sample_id", "t")
    with warnings.catch_warnings():
        warnings.simplefilter("error")
        C.require_overlap(a, a, "sample_id", "t")


def test_prepare_wants_the_training_outcome(spark):
    m = spark.createDataFrame([("a", 1.0), ("b", 2.0)], "sample_id string, P1 double")
    p = spark.createDataFrame([("a", 0), ("b", 1)], "sample_id string, oa_status int")
    with pytest.raises(ValueError):
        C.prepare(m, p.drop("oa_status"), m, p, outcome="oa_status")
    with pytest.warns(UserWarning):
        done = C.prepare(m, p, m, p.drop("oa_status"), outcome="oa_status")
    assert done.info["target_distribution_train"] == {0: 1, 1: 1} and done.info["target_distribution_val"] == {}
    assert done.info["feature_names"] == ["P1"] and done.info["val_samples"] == 2


def test_modes_and_medians_at_the_edges(spark):
    df = spark.createDataFrame([("b", None), ("a", None), (None, None)], "t string, e string")
    assert {r["feature"]: r["mode"] for r in C.category_modes(df, ["t", "e"]).collect()} == {"t": "a", "e": "missing"}
    cells = spark.createDataFrame([("f", 1.0), ("f", None), ("f", 4.0)], "feature string, value double")
    assert sorted(r["value"] for r in C.impute_cells(cells).collect()) == [1.0, 2.5, 4.0]


def test_shapes_round_trip(spark):
    wide = spark.createDataFrame([(1, 1.0, None), (2, 3.0, 4.0)], "sample_id int, a double, b double")
    arrays = shape.arrays_from_wide(wide, ["a", "b"], ["sample_id"])
    cells = shape.cells_from_arrays(arrays, ["a", "b"], ["sample_id"])
    for back in (shape.arrays_from_cells(cells, ["a", "b"], ["sample_id"]), shape.arrays_from_wide(shape.wide_from_cells(cells, ["a", "b"], ["sample_id"]), ["a", "b"], ["sample_id"])):
        assert {r["sample_id"]: r["features"] for r in back.collect()} == {1: [1.0, None], 2: [3.0, 4.0]}
    assert shape.slice_arrays(arrays, ["a", "b"], ["b"]).orderBy("sample_id").first()["features"] == [None]


def test_unknown_features(spark):
    cells = spark.createDataFrame([("a", 1.0)], "feature string, value double")
    with pytest.warns(UserWarning):
        assert C.select_features(cells, ["a", "x"], ["a"]).count() == 1
    with pytest.raises(KeyError):
        C.select_features(cells, ["a", "x"], ["a"], validate=False)


def test_keyed_csv(spark, tmp_path):
    path = str(tmp_path / "m")
    spark.createDataFrame([("s1", 1.5, float("nan")), ("s2", None, 2.0)], "`Unnamed: 0` string, P1 double, P2 double").write.option("header", True).csv(path)
    got = {r["sample_id"]: (r["P1"], r["P2"]) for r in IO.read_matrix(spark, path).collect()}
    assert got == {"s1": (1.5, None), "s2": (None, 2.0)}
    with pytest.raises(ValueError):
        IO.key_column(["P1", "P2"])


def test_annotation_must_be_unique(spark, tmp_path):
    df = spark.createDataFrame([("p1", "ONE"), ("p2", "TWO")], "`x.olinkid` string, `x.names` string")
    IO.write_tsv(df, str(tmp_path / "ok"))
    assert IO.read_annotation(spark, str(tmp_path / "ok")).where("feature = 'p2'").first()["feature_name"] == "TWO"
    IO.write_tsv(df.union(df), str(tmp_path / "twice"))
    with pytest.raises(ValueError):
        IO.read_annotation(spark, str(tmp_path / "twice"))


def test_names_keep_their_order(spark, tmp_path):
    df = spark.createDataFrame([(i, f"f{i}") for i in (3, 1, 2)], "position int, feature string")
    IO.write_names(df, str(tmp_path / "n"), "feature", "position")
    assert [r["feature"] for r in IO.read_names(spark, str(tmp_path / "n")).collect()] == ["f1", "f2", "f3"]


def test_partition_is_pruned(spark, tmp_path):
    path = str(tmp_path / "p")
    IO.write_partitioned(spark.range(10).withColumn("split", F.when(F.col("id") < 3, "val").otherwise("train")), path, ["split"])
    plan = IO.read_part(spark, path, split="val")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(split" in plan and IO.read_part(spark, path, split="val").count() == 3


def test_labels(spark):
    row = spark.range(1).select(
        S.label_after_elimination(F.lit("rose_top30_x"), F.lit(8)).alias("a"),
        S.predictor_type(F.lit("/x/models_comb")).alias("b"),
        S.predictor_type(F.lit("/x/other")).alias("c"),
        S.elimination_note(F.lit("m_rfe_x"), F.lit(8)).alias("d"),
        S.step_folder(F.lit(3), F.lit("rf")).alias("e"),
    ).first()
    assert tuple(row) == ("rose_top30rfekeep8_x", "prot_and_sexagebmi", None, "rfe_feat: 8", "03_rf")
    assert S.only_label(["model_x.rda"]) == "model_x"
    with pytest.raises(ValueError):
        S.only_label(["a.rda", "b.rda"])


def test_compatibility(spark):
    m = spark.createDataFrame([(1, 1.0), (2, None)], "sample_id int, P1 double")
    p = spark.createDataFrame([(1, 0), (2, 0)], "sample_id int, y int")
    rows = {r["check"]: r for r in C.compatibility_report(m, p, "y", "sample_id").collect()}
    assert rows["target"]["level"] == "error" and rows["compatible"]["value"] == 0.0 and rows["feature_missing"]["value"] == 1.0
    assert {r["check"]: r["level"] for r in C.compatibility_report(m, p, "z", "sample_id").collect()}["target"] == "error"
