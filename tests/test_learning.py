import numpy as np
import pytest
from pyspark.sql import functions as F

from phenoloom.operators import evaluation as E
from phenoloom.operators import importance as I
from phenoloom.operators import models as M
from phenoloom.operators import selection as Z
from phenoloom.plans.ledger import Run
from phenoloom.plans.study import Settings, run_study

NAMES = ["signal", "weak", "noise1", "noise2", "noise3"]
FOREST = {"numTrees": 10, "maxDepth": 4}


@pytest.fixture(scope="module")
def frame(spark):
    rng = np.random.default_rng(9)
    rows = []
    for i in range(500):
        y = int(rng.random() < 0.25)
        rows.append((i, y, [float(v) for v in (rng.normal(2.5 * y), rng.normal(0.8 * y), rng.normal(), rng.normal(), rng.normal())]))
    return spark.createDataFrame(rows, "sample_id long, outcome int, features array<double>").persist()


@pytest.mark.parametrize(
    "model,params",
    [
        ("random_forest", FOREST),
        ("logistic_regression", {"maxIter": 30}),
        ("elastic_net", {"regParam": 0.01}),
        ("gradient_boosting", {"maxIter": 5}),
        ("xgboost", {"maxIter": 5, "maxDepth": 2, "subsamplingRate": 0.8}),
        ("svm", {"kernel": "linear", "maxIter": 10}),
        ("svm", {"kernel": "rbf", "maxIter": 10, "n_random": 64}),
    ],
)
def test_models_find_the_signal(frame, model, params):
    train, val = M.hold_out(frame, "sample_id", 0.3)
    scores = M.predict(M.fit(train, model, params, scale=model == "svm"), val, ["sample_id", "outcome"])
    assert E.auc(scores, actual="outcome").first()["auc"] > 0.85


def test_unknown_model_and_single_class(frame):
    with pytest.raises(ValueError):
        M.fit(frame, "oracle")
    with pytest.raises(ValueError):
        M.fit(frame.where("outcome = 0"), "random_forest", FOREST)


def test_same_seed_same_forest(frame):
    a, b = (M.feature_weights(M.fit(frame, "random_forest", FOREST), NAMES) for _ in range(2))
    assert a == b


def test_scaling_uses_population_sd(frame):
    scaler, stretch, _ = M.fit(frame, "logistic_regression", {"maxIter": 5}, scale=True).stages
    x = np.array([r["features"] for r in frame.select("features").collect()])
    row = M.vector_to_array(F.col("scaled_features"))
    data = frame.withColumn("features", M.array_to_vector("features"))
    got = np.array([r["v"] for r in stretch.transform(scaler.transform(data)).orderBy("sample_id").select(row.alias("v")).collect()])
    assert np.allclose(got, (x - x.mean(0)) / x.std(0))


def test_cross_validation_covers_every_row_once_per_repeat(frame):
    s = M.cross_validate(frame, NAMES, "sample_id", "random_forest", FOREST, k=3, repeats=2)
    assert s.count() == 1000 and s.select("repeat", "sample_id").distinct().count() == 1000
    r = M.cv_auc(s).first()
    assert len(r["auc_scores"]) == 6 and r["auc_mean"] > 0.85


def test_resampling_leaves_held_out_rows_alone(frame):
    s = M.cross_validate(frame, NAMES, "sample_id", "random_forest", FOREST, k=2, sampling="rose")
    assert s.select("sample_id").distinct().count() == 500
    with pytest.raises(ValueError):
        M.cross_validate(frame, NAMES, "sample_id", "random_forest", FOREST, k=2, sampling="smote")


def test_grid_search_reports_a_refused_setting(frame):
    grid = [{"maxDepth": 1}, {"maxDepth": 99}]
    best, records = M.grid_search(frame, NAMES, "sample_id", "random_forest", grid, k=2, base={"numTrees": 5})
    assert best == {"maxDepth": 1} and records[1]["error"] and records[1]["mean"] is None


def test_published_grids():
    assert len(M.combinations(M.RECIPES["xgboost"].grid)) == 3 * 5 * 3 * 3 * 2 * 2 * 3
    assert I.tuning_grid(64) == [5, 7, 8, 10] and I.tuning_grid(4, distinct=True) == [2, 3] and I.tuning_grid(64, row=2) == [7]


def test_model_set(frame, spark, tmp_path):
    train, val = M.hold_out(frame, "sample_id", 0.3)
    models = M.ModelSet()
    with pytest.raises(ValueError):
        models.predict(val)
    with pytest.warns(UserWarning):
        table = models.compare(
            train, NAMES, ("random_forest", "oracle"), {"random_forest": FOREST}, val=val, k=2
        )
    assert table.where("model = 'oracle' and error is not null").count() == 1
    assert table.where("split = 'val' and metric = 'auc' and value > 0.85").count() == 1
    assert models.best() == "random_forest"
    with pytest.raises(ValueError):
        models.predict(val, "svm")
    M.save_model(models.models["random_forest"], str(tmp_path / "m"))
    again = M.load_model(spark, str(tmp_path / "m"))
    assert again.features == NAMES == M.features_of_model(spark, str(tmp_path / "m"))
    a = models.predict(val).orderBy("sample_id").toPandas()
    b = M.predict(again.model, val, ["sample_id"]).orderBy("sample_id").toPandas()
    assert a.score.tolist() == b.score.tolist()


def test_kernel_machine_reloads(frame, spark, tmp_path):
    m = M.fit(frame, "svm", {"maxIter": 5, "n_random": 16})
    m.write().overwrite().save(str(tmp_path / "svm"))
    again = M.PipelineModel.load(str(tmp_path / "svm"))
    a, b = (M.predict(x, frame, ["sample_id"]).orderBy("sample_id").toPandas().score.tolist() for x in (m, again))
    assert a == b


def test_out_of_bag(frame):
    s = M.oob_scores(frame, "sample_id", 10, {"maxDepth": 4})
    assert s.count() > 450 and E.auc(s).first()["auc"] > 0.85


def test_corrected_importance_of_noise_is_centred(frame):
    w = {r["feature"]: r["importance"] for r in Z.corrected_importance(frame, NAMES, "sample_id", {"numTrees": 30, "maxDepth": 5}).collect()}
    assert w["signal"] > 0.2 and all(abs(w[n]) < 0.1 for n in NAMES[2:])


def test_elimination_keeps_the_signal(frame):
    t = {r["feature"]: r for r in Z.rfe(frame, NAMES, 2, params=FOREST).collect()}
    assert t["signal"]["selected"] and sum(r["selected"] for r in t.values()) == 2
    assert sorted(r["ranking"] for r in t.values()) == [1, 1, 2, 3, 4]
    lr = Z.rfe(frame, NAMES, 1, estimator="logistic_regression").where("selected").first()
    assert lr["feature"] == "signal"


def test_elimination_with_folds(frame):
    selection, ladder = Z.rfe_cv(frame, NAMES, "sample_id", 2, 2, params=FOREST)
    assert selection.where("selected and feature = 'signal'").count() == 1
    assert {r["n_features"] for r in ladder.collect()} == {5, 3, 1}


def test_elimination_by_sizes(frame):
    kept, ladder = Z.rfe_sizes(frame, NAMES, "sample_id", 3, 2, 2, FOREST)
    assert "signal" in kept and len(kept) <= 3
    assert {r["n_features"] for r in ladder.collect()} == {2, 3, 5}


def test_unknown_selection_method_is_warned_about(frame):
    with pytest.warns(UserWarning):
        t = Z.compare_selection(frame, NAMES, "sample_id", ("variance_threshold", "magic"))
    assert {r["method"] for r in t.collect()} == {"variance_threshold"}


# --- run management --------------------------------------------------------------------------------------------------


def test_ledger(spark, tmp_path):
    run = Run(spark, str(tmp_path), "r")
    with pytest.raises(FileNotFoundError):
        run.load("a")
    made = []

    def make():
        made.append(1)
        return spark.range(5)

    for params in ({"x": 1}, {"x": 1}, {"x": 2}):
        assert run.step("a", params, make).count() == 5
    assert len(made) == 2 and run.exists("a")
    assert run.check().first()["valid"] and run.timing().first()["share"] == pytest.approx(100)
    assert run.has_files("a")
    run.delete("a")
    assert not run.exists("a") and not run.has_files("a")


def test_study_resumes(spark, frame, tmp_path):
    pheno = frame.select(
        "sample_id", "outcome", (F.col("sample_id") % 60 + 20).alias("Age_at_recruitment"),
        F.when(F.col("sample_id") % 2 == 0, "Male").otherwise("Female").alias("Sex"),
        F.when(F.col("sample_id") % 9 != 0, 20 + F.col("sample_id") % 7).alias("bmi"),
    )
    s = Settings(forest=FOREST, folds=2, repeats=1, models=("random_forest",), final={"random_forest": FOREST}, kept=2)
    args = (spark, str(tmp_path), "toy", frame.select("sample_id", "features"), NAMES, pheno, None, "comb", s)
    run = run_study(*args)
    before = {r["step"]: r["path"] for r in run.steps().collect()}
    final = [r["feature"] for r in run.load("model_data_prep").orderBy("position").collect()]
    assert "signal" in final and final[-3:] == ["age", "sex", "bmi"]
    # rows without a bmi are dropped in this mode
    assert run.load("data_loading").count() == 500 - 56
    run.delete("rfe_feature_selection")
    after = {r["step"]: r["path"] for r in run_study(*args).steps().collect()}
    changed = {k for k in after if before[k] != after[k]}
    assert changed == {"rfe_feature_selection", "model_data_prep", "model_random_forest", "threshold_random_forest"}


def test_partitions_are_merged_after_their_sorts(spark):
    """A task that merges partitions would hold the sorts of all of them: rows with folds are stored before."""
    rows = [(i, int(i % 3 == 0), [float(i), 1.0]) for i in range(300)]
    frame = spark.createDataFrame(rows, "sample_id long, outcome int, features array<double>")
    folded = M.with_folds(frame, "sample_id", 3, 2, 42)
    plan = folded._jdf.queryExecution().executedPlan().toString()
    assert "Coalesce" in plan and "Sort" not in plan and "Window" not in plan and "Exchange" not in plan
    assert folded.count() == 300 and {len(r["folds"]) for r in folded.collect()} == {2}


def test_folds_of_one_repeat_join_nothing(spark):
    rows = [(i, int(i % 3 == 0), [float(i), 1.0]) for i in range(300)]
    frame = spark.createDataFrame([*rows, (None, 1, [0.0, 0.0])], "sample_id long, outcome int, features array<double>")
    folded = M.with_folds(frame, "sample_id", 3, 1, 42)
    want = M.repeated_folds(frame.select("sample_id", "outcome"), "sample_id", "outcome", 3, 1, 42).where("sample_id is not null")
    assert {r["sample_id"]: r["folds"] for r in folded.collect()} == {r["sample_id"]: {1: r["fold"]} for r in want.collect()}
    with pytest.raises(Exception, match="key comes twice"):
        M.with_folds(frame.union(frame), "sample_id", 3, 1, 42).count()
