import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from phenoloom.functions import special as S
from phenoloom.operators import association as A
from phenoloom.operators import evaluation as E
from phenoloom.operators import resampling as R
from phenoloom.operators.shape import arrays_from_cells, arrays_from_wide, cells_from_arrays, slice_arrays
from phenoloom.plans import cohorts as K
from phenoloom.plans.queries_assoc import pearson_flags


def test_tail_probabilities():
    p = S.t_two_sided([2.0, 1.96, 0.5, 0.0], [10, 397, 3.7, 5])
    assert np.allclose(p, [0.0733880348, 0.0506949187, 0.6453356333, 1.0], atol=1e-9)
    assert np.allclose(S.f_upper([4.0], [1], [10]), [0.0733880348], atol=1e-9)
    assert np.allclose(S.log_gamma(np.array([0.5, 3.7, 50.0])), [math.lgamma(x) for x in (0.5, 3.7, 50.0)])


def test_digamma_family(spark):
    row = spark.range(1).select(S.digamma(F.lit(1.0)).alias("d"), S.trigamma(F.lit(1.0)).alias("t")).first()
    assert row["d"] == pytest.approx(-0.5772156649, abs=1e-9) and row["t"] == pytest.approx(math.pi**2 / 6, abs=1e-9)
    assert S.trigamma_inverse(math.pi**2 / 6) == pytest.approx(1.0, abs=1e-9)
    assert S.trigamma_inverse(0.0) == math.inf


def test_sql_functions(spark):
    S.register(spark)
    row = spark.sql("SELECT student_t_p(2.0D, 10.0D) AS t, f_p(4.0D, 1.0D, 10.0D) AS f").first()
    assert row["t"] == pytest.approx(row["f"], abs=1e-12)


def test_benjamini_hochberg_by_hand(spark):
    df = spark.createDataFrame([(f"f{i}", p) for i, p in enumerate([0.01, 0.04, 0.03, 0.005, 0.5, None])], "feature string, p_value double")
    got = {r["feature"]: r["p_adjusted"] for r in A.adjust_fdr(df).collect()}
    want = {"f0": 0.025, "f1": 0.05, "f2": 0.05, "f3": 0.025, "f4": 0.5, "f5": None}
    assert all((got[k] is None and v is None) or got[k] == pytest.approx(v) for k, v in want.items())


def test_adjusted_p_is_monotone_and_not_below_p(spark, sf):
    rows = pearson_flags(K.vectors(spark, sf, 9).cells()).orderBy("p_value").collect()
    assert all(r["p_adjusted"] >= r["p_value"] for r in rows)
    assert all(a["p_adjusted"] <= b["p_adjusted"] for a, b in zip(rows, rows[1:]))


def test_shift_and_scale(spark, sf):
    cells = K.vectors(spark, sf, 1).cells()
    base = {r["feature"]: r for r in A.plain_t(A.two_group(cells)).collect()}
    moved = {r["feature"]: r for r in A.plain_t(A.two_group(cells.withColumn("value", F.col("value") * 3 + 7))).collect()}
    for f, r in base.items():
        assert moved[f]["t"] == pytest.approx(r["t"], rel=1e-7) and moved[f]["effect"] == pytest.approx(3 * r["effect"], rel=1e-7)


def test_constant_feature_gets_a_floor(spark):
    rows = [(i, i % 2, "a", float(i % 5)) for i in range(40)] + [(i, i % 2, "b", 1.0) for i in range(40)]
    rows += [(i, i % 2, "c", float(i * i % 7)) for i in range(40)]
    cells = spark.createDataFrame(rows, "sample_id int, outcome int, feature string, value double")
    out = {r["feature"]: r for r in A.associate_moderated(cells).collect()}
    assert out["b"]["effect"] == 0 and out["a"]["p_value"] is not None


def test_logistic_gradient_vanishes(spark):
    rng = np.random.default_rng(5)
    n = 400
    x, z = rng.normal(size=(n, 3)), rng.normal(size=n)
    y = (rng.random(n) < 1 / (1 + np.exp(-(x[:, 0] - z)))).astype(int)
    rows = [(i, [float(v) for v in x[i]], float(z[i]), int(y[i])) for i in range(n)]
    matrix = spark.createDataFrame(rows, "sample_id int, features array<double>, z double, outcome int")
    cells = K.cells_from_arrays(matrix, ["a", "b", "c"], ["z", "outcome"])
    for r in A.fit_logistic(cells, ["z"]).collect():
        b = np.array(r["beta"])
        design = np.column_stack([np.ones(n), x[:, "abc".index(r["feature"])], z])
        g = design.T @ (1 / (1 + np.exp(-design @ b)) - y) + np.array([0, b[1], b[2]])
        assert r["converged"] and np.abs(g).max() < 1e-6


def test_non_finite_feature_is_left_out(spark):
    rows = [(i, [float(i % 3), None if i == 4 else 1.0 * (i % 4)], i % 2) for i in range(60)]
    m = spark.createDataFrame(rows, "sample_id int, features array<double>, outcome int")
    assert [r["feature"] for r in A.associate_adjusted(m, ["a", "b"], []).collect()] == ["a"]


def test_selection_rules(spark):
    rows = [("a", 0.001, True, True), ("b", 0.02, False, True), ("c", 0.3, False, False)]
    t = spark.createDataFrame(rows, "feature string, p_value double, fdr_significant boolean, nominal_significant boolean")
    names = lambda df: sorted(r["feature"] for r in df.collect())
    assert names(A.select_with_fallback(t, min_hits=2)) == ["a", "b"]
    assert names(A.select_with_fallback(t, min_hits=1)) == ["a"]
    assert names(A.select_with_fallback(t, min_hits=3, top_n=2)) == ["a", "b"]
    with pytest.raises(ValueError):
        A.select_by_strategy(t, "best")


def test_no_cap_unless_asked(spark):
    t = spark.range(500).selectExpr("concat('f', id) AS feature", "id / 1e6 AS p_value", "id < 450 AS fdr_significant", "true AS nominal_significant")
    assert A.select_by_strategy(t).count() == 450
    assert A.select_by_strategy(t, "nominal_significant", 20).count() == 20
    assert A.select_by_strategy(t, "top_n").count() == A.MAX_SELECTED


def test_anova_with_many_classes(spark):
    df = spark.range(6000).selectExpr("'f' AS feature", "id % 1500 AS outcome", "(id % 1500) * 1.0 + (id div 1500) AS value")
    row = A.anova(df).first()
    # four values 0..3 about each of 1500 class levels
    ssw, ssb = 1500 * 5.0, 4.0 * sum((c - 749.5) ** 2 for c in range(1500))
    assert row["f_score"] == pytest.approx((ssb / 1499) / (ssw / 4500))


def test_weights_for_any_number_of_classes(spark):
    df = spark.range(6000).selectExpr("id", "if(id < 3000, id, NULL) AS outcome")
    out = R.with_class_weights(df, "outcome")
    assert out.where("weight = 1.0").count() == 3000 and out.where("weight IS NULL").count() == 3000


def test_plan_size_does_not_grow_with_names(spark):
    sizes = []
    for n in (50, 5000):
        names = [f"f{i}" for i in range(n)]
        df = spark.range(1).select("id", F.array_repeat(F.lit(1.0), n).alias("features"))
        sliced = slice_arrays(df, names, names[::-1])
        assert sliced.first()["features"] == [1.0] * n
        plan = arrays_from_cells(cells_from_arrays(sliced, names, ["id"]), names, ["id"])._jdf.queryExecution().analyzed()
        sizes.append(plan.toString().count("lambda"))
        assert cells_from_arrays(sliced, names, ["id"]).where("feature = 'f7'").count() == 1
    assert sizes[0] == sizes[1]


def test_broadcast_is_checked_by_rows_and_bytes(spark, monkeypatch):
    import phenoloom.session as S

    hinted = lambda df: "broadcast" in df._jdf.queryExecution().logical().toString().lower()
    df = spark.range(100).withColumn("x", F.repeat(F.lit("y"), 1000))
    assert hinted(S.small_side(df)) and not hinted(S.small_side(df, 99))
    monkeypatch.setattr(S, "BROADCAST_BYTE_LIMIT", 50_000)
    assert not hinted(S.small_side(df))


def test_shared_folder_is_required_on_a_cluster(spark):
    from types import SimpleNamespace

    from phenoloom.session import runs_in_one_process, shared_folder

    def session(master, named=None):
        made = []
        context = SimpleNamespace(master=master, getCheckpointDir=lambda: made[-1] if made else None, setCheckpointDir=made.append)
        return SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda key, default=None: named))

    for master in ("yarn", "spark://h:7077", "k8s://h", "local-cluster[2,1,1024]"):
        with pytest.raises(ValueError):
            shared_folder(session(master))
        assert shared_folder(session(master, "hdfs://x/y")) == "hdfs://x/y"
    assert runs_in_one_process("local") and runs_in_one_process("local[4]") and shared_folder(session("local[4]"))


def test_empty_summary(spark):
    t = spark.createDataFrame(
        [], "feature string, p_value double, effect double, fdr_significant boolean, pass_bonf boolean, nominal_significant boolean"
    )
    r = A.summarise(t).first()
    assert r["total_tested"] == 0 and r["min_p_value"] == 1.0 and r["mean_effect"] == 0.0 and r["top_feature"] is None


# --- evaluation ------------------------------------------------------------------------------------------------------


def test_auc_with_heavy_ties(spark):
    rng = np.random.default_rng(1)
    s = np.where(rng.random(3000) < 0.4, 0.5, np.round(rng.random(3000), 3))
    y = rng.integers(0, 2, 3000)
    df = spark.createDataFrame([(float(a), int(b)) for a, b in zip(s, y)], "score double, actual int")
    p, n = s[y == 1], s[y == 0]
    want = ((p[:, None] > n[None]).sum() + 0.5 * (p[:, None] == n[None]).sum()) / (len(p) * len(n))
    assert E.auc(df).first()["auc"] == pytest.approx(want, abs=1e-12)
    # a monotone transform of the scores changes nothing
    assert E.auc(df.withColumn("score", F.exp("score"))).first()["auc"] == pytest.approx(want, abs=1e-12)


def test_one_class_has_no_auc(spark):
    assert E.auc(spark.createDataFrame([(0.1, 1), (0.2, 1)], "score double, actual int")).first()["auc"] is None


def test_youden_by_hand(spark):
    df = spark.createDataFrame([(0.9, 1), (0.8, 1), (0.4, 0), (0.1, 0)], "score double, actual int")
    r = E.youden(df).first()
    assert r["threshold"] == pytest.approx(0.6) and r["youden_j"] == pytest.approx(1.0)


def test_report_with_a_class_never_predicted(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (0, 1)], "actual int, prediction int")
    rows = {r["label"]: r for r in E.class_report(df).collect()}
    assert rows["0"]["precision"] == 0 and rows["0"]["support"] == 1 and rows["1"]["recall"] == 1


# --- resampling ------------------------------------------------------------------------------------------------------


def test_folds_are_even_and_complete(spark, sf):
    df = K.table(spark, sf, "labels").select(F.col("doc_id").alias("sample_id"), F.col("quality").alias("outcome"))
    folds = R.repeated_folds(df, "sample_id", "outcome", 5, 2).toPandas()
    assert len(folds) == 2 * df.count()
    sizes = folds.groupby(["repeat", "outcome", "fold"]).size().groupby(["repeat", "outcome"])
    assert (sizes.max() - sizes.min() <= 1).all()
    again = R.repeated_folds(df.repartition(3), "sample_id", "outcome", 5, 2).toPandas()
    key = ["repeat", "sample_id"]
    assert folds.sort_values(key).fold.tolist() == again.sort_values(key).fold.tolist()
    assert folds[folds.repeat == 1].sort_values("sample_id").fold.tolist() != folds[folds.repeat == 2].sort_values("sample_id").fold.tolist()


def test_rose_balances_and_keeps_the_class_means(spark):
    rng = np.random.default_rng(2)
    rows = [(i, int(i % 10 == 0), [float(rng.normal(3 * (i % 10 == 0))), float(rng.normal())]) for i in range(2000)]
    df = spark.createDataFrame(rows, "sample_id int, outcome int, features array<double>")
    out = R.rose(df, ["a", "b"], "sample_id", "outcome").toPandas()
    assert len(out) == 2000 and abs(out.outcome.mean() - 0.5) < 0.05
    for y in (0, 1):
        want = np.mean([r[2][0] for r in rows if r[1] == y])
        assert abs(np.mean([f[0] for f in out[out.outcome == y].features]) - want) < 0.15
    again = R.rose(df.repartition(5), ["a", "b"], "sample_id", "outcome").toPandas()
    assert out.sort_values("draw").source.tolist() == again.sort_values("draw").source.tolist()


def test_normal_and_poisson_from_hashes(spark):
    r = spark.range(20000).select(R.normal(F.col("id"), F.lit("s")).alias("z"), R.poisson_one(F.col("id"), F.lit("s")).alias("k"))
    m = r.agg(F.avg("z").alias("m"), F.stddev("z").alias("s"), F.avg("k").alias("k"), F.variance("k").alias("v")).first()
    assert abs(m["m"]) < 0.03 and abs(m["s"] - 1) < 0.03 and abs(m["k"] - 1) < 0.03 and abs(m["v"] - 1) < 0.05


def test_continuous_outcome_is_refused(spark):
    df = spark.range(3000).withColumn("outcome", F.col("id"))
    with pytest.raises(ValueError):
        R.class_counts(df, "outcome")


def test_one_shuffle_by_feature(spark, sf):
    wide = arrays_from_wide(K.line_table(spark, sf), K.LINE_FEATURES, ["sample_id", "outcome"])
    plan = A.two_group(K.cells_from_arrays(wide, K.LINE_FEATURES, ["outcome"]))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "EvalPython" not in plan and "l_comment" not in plan


def test_holdout_ranks_only_the_rows_at_the_cut(spark):
    """Exact shares, with repeated and null keys; whoever is far from the cut is neither moved nor sorted."""
    rows = spark.range(20_000).select(F.when(F.col("id") % 100 > 0, F.col("id") % 5000).alias("k"), (F.col("id") % 7 == 0).cast("int").alias("y"))
    for fraction in (0.0, 0.1, 0.37, 1.0):
        out = R.holdout_split(rows, "k", "y", fraction, 42)
        counts = {(r["y"], r["split"]): r["count"] for r in out.groupBy("y", "split").count().collect()}
        for y in (0, 1):
            n = counts.get((y, "val"), 0) + counts.get((y, "train"), 0)
            assert n == rows.where(F.col("y") == y).count() and counts.get((y, "val"), 0) == math.ceil(fraction * n)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "hashpartitioning" not in plan


def test_areas_are_those_of_each_measure(spark):
    scores = spark.range(3000).select((F.col("id") % 97 / 97).alias("score"), (F.col("id") % 7 % 2).cast("int").alias("actual"), (F.col("id") % 3).alias("g"))
    both = {r["g"]: r for r in E.areas(scores, ["g"]).collect()}
    assert {r["g"]: r["auc"] for r in E.auc(scores, ["g"]).collect()} == pytest.approx({g: r["auc"] for g, r in both.items()}, rel=1e-12)
    assert E.areas(scores).first()["auc"] == pytest.approx(E.auc(scores).first()["auc"], rel=1e-12)
