"""Catalogue: learners. Small settings, whole tables. Where the fit has one right answer, SQL finds it another way."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from phenoloom.operators import evaluation as E
from phenoloom.operators import linear as L
from phenoloom.operators import models as M
from phenoloom.operators import selection as Z
from phenoloom.operators import trees as T
from phenoloom.operators.association import associate_moderated
from phenoloom.operators.shape import arrays_from_wide, slice_arrays
from phenoloom.plans import cohorts as K
from phenoloom.plans.queries_assoc import sql_newton
from phenoloom.plans.queries_cohort import scratch
from phenoloom.plans.registry import query, r, tidy

KEY = "sample_id"
FOREST = {"numTrees": 20, "maxDepth": 5}
BOOST = {"maxIter": 10, "maxDepth": 3}


def doc_frame(spark: SparkSession, sf: str, outcome: str = "quality") -> tuple[DataFrame, list[str]]:
    c = K.docs(spark, sf, outcome).stored()
    return c.joined(), c.names


def vector_frame(spark: SparkSession, sf: str, label: int = 1, thin: bool = False) -> tuple[DataFrame, list[str]]:
    c = K.vectors(spark, sf, label, thin=thin)
    return c.joined(), c.names


def line_frame(spark: SparkSession, sf: str) -> tuple[DataFrame, list[str]]:
    return arrays_from_wide(K.line_table(spark, sf), K.LINE_FEATURES, [KEY, "outcome"]), K.LINE_FEATURES


# --- importance and selection ----------------------------------------------------------------------------------------


@query("rf_importance")
def rf_importance(spark, sf):
    frame, names = doc_frame(spark, sf)
    table, performance = Z.forest_importance(frame, names, KEY, FOREST, k=3)
    shown = performance.where(~F.col("metric").like("cv_auc\\__")).select(F.col("metric").alias("item"), "value")
    return table.select(F.col("feature").alias("item"), F.col("importance").alias("value")).unionByName(shown)


@query("corrected_importance")
def corrected_importance(spark, sf):
    frame, names = doc_frame(spark, sf)
    return Z.corrected_importance(frame, names, KEY, FOREST)


_DIFFERENCES = """imp AS (SELECT feature, round(avg(value) FILTER (outcome = 1) - avg(value) FILTER (outcome = 0), 9) AS importance FROM cells GROUP BY 1)"""


@query(
    "mirrored_p_values",
    f"""WITH {K.sql_vector_cells(1)}, {_DIFFERENCES}, none AS (SELECT importance AS v FROM imp WHERE importance <= 0 UNION ALL SELECT -importance FROM imp WHERE importance < 0)
 SELECT feature, round(importance, 6) AS importance, round((SELECT count(*) FROM none WHERE v >= importance) / nullif((SELECT count(*) FROM none), 0), 6) AS p_value FROM imp""",
)
def mirrored_p_values(spark, sf):
    """P-values from the mirrored negative values, of a signed importance that SQL has too: the difference of the means."""
    cells = K.vectors(spark, sf, 1).cells()
    mean = lambda y: F.avg(F.when(F.col("outcome") == y, F.col("value")))
    return tidy(Z.mirrored_p_values(cells.groupBy("feature").agg(F.round(mean(1) - mean(0), 9).alias("importance"))))


@query("shadow_importance")
def shadow_importance(spark, sf):
    """Importance corrected by shadows drawn in every node, with its p-values."""
    frame, names = vector_frame(spark, sf)
    return Z.mirrored_p_values(Z.shadow_importance(frame, names, KEY, trees=20, depth=4))


@query(
    "shadow_features",
    f"""WITH {K.sql_vector_cells(1)}, s AS (SELECT feature, round(sum(value), 6) AS own, round(sum(value), 6) AS shadow FROM cells GROUP BY 1) SELECT * FROM s""",
)
def shadow_features(spark, sf):
    frame, names = vector_frame(spark, sf)
    both = Z.with_shadows(frame, KEY)
    cells = K.cells_from_arrays(both, [*names, *[f"shadow:{n}" for n in names]], [])
    shadow = F.col("feature").startswith("shadow:")
    base = F.replace(F.col("feature"), F.lit("shadow:"), F.lit(""))
    return tidy(
        cells.groupBy(base.alias("feature")).agg(F.sum(F.when(~shadow, F.col("value"))).alias("own"), F.sum(F.when(shadow, F.col("value"))).alias("shadow"))
    )


@query("repeated_cv_importance")
def repeated_cv_importance(spark, sf):
    frame, names = doc_frame(spark, sf)
    table, _ = Z.repeated_importance(frame, names, KEY, k=3, repeats=2, params=FOREST)
    return table


@query("repeated_cv_importance_rose")
def repeated_cv_importance_rose(spark, sf):
    frame, names = doc_frame(spark, sf)
    table, scores = Z.repeated_importance(frame, names, KEY, k=2, repeats=1, params=FOREST, grid={"featureSubsetStrategy": ["2", "3"]}, inner_k=2, sampling="rose")
    return E.confusion_metrics(E.confusion(scores, ["repeat", "fold"])).join(table.groupBy("repeat", "fold").agg(F.max_by("feature", "importance").alias("top")), ["repeat", "fold"])


@query("rfe_fixed")
def rfe_fixed(spark, sf):
    frame, names = doc_frame(spark, sf)
    return Z.rfe(frame, names, 3, 1, params=FOREST)


@query("rfe_cv")
def rfe_cv(spark, sf):
    frame, names = doc_frame(spark, sf)
    selection, _ = Z.rfe_cv(frame, names, KEY, 2, 3, params=FOREST)
    return selection


@query("rfe_ladder")
def rfe_ladder(spark, sf):
    frame, names = doc_frame(spark, sf)
    _, ladder = Z.rfe_cv(frame, names, KEY, 2, 3, estimator="logistic_regression", params={"maxIter": 30})
    return ladder


@query("rfe_sizes")
def rfe_sizes(spark, sf):
    frame, names = doc_frame(spark, sf)
    kept, ladder = Z.rfe_sizes(frame, names, KEY, max_size=4, k=3, params=FOREST)
    return ladder.withColumn("kept", F.lit(",".join(kept)))


@query("compare_selection")
def compare_selection(spark, sf):
    frame, names = doc_frame(spark, sf)
    return Z.compare_selection(frame, names, KEY, k=3, threshold=10.0, params={"random_forest": FOREST, "logistic_regression": {"maxIter": 20}}, folds=2)


@query("evaluate_features")
def evaluate_features(spark, sf):
    frame, names = doc_frame(spark, sf)
    return Z.evaluate_features(slice_arrays(frame, names, names[:3]), names[:3], KEY, 3, FOREST)


# --- models ----------------------------------------------------------------------------------------------------------


def _train(model: str, params: dict | None = None, frame=doc_frame, **options):
    def run(spark: SparkSession, sf: str) -> DataFrame:
        data, names = frame(spark, sf)
        train, val = M.hold_out(data, KEY)
        return M.train_model(train, names, KEY, val, model, params, k=3, **options).metrics

    return run


query("train_rf")(_train("random_forest", FOREST))
query("train_rf_rose")(_train("random_forest", FOREST, sampling="rose"))
query("train_gbt")(_train("gradient_boosting", BOOST))
query("train_xgboost_style")(_train("xgboost", {"maxIter": 10, "maxDepth": 3, "subsamplingRate": 0.8, "columnShare": 0.8}))
query("train_elastic_net")(_train("elastic_net", {"regParam": 0.01, "maxIter": 50}, scale=True))
query("train_svm_linear")(_train("svm", {"kernel": "linear", "maxIter": 10}, scale=True))
query("train_svm_rbf")(_train("svm", {"kernel": "rbf", "maxIter": 10, "n_random": 64}, frame=vector_frame))
query("train_logistic_lines")(_train("logistic_regression", {"maxIter": 15}, frame=line_frame, scale=True))


STUMP_FEATURES = ["quantity", "discount", "tax"]


def _sql_stump(number: int) -> str:
    """Best cut of one round of depth 1 over all values, and both leaves; margins of the rounds before are in ``m{number - 1}``."""
    score = "({0}) * ({0}) / (({1}) + 1)"
    gain = f"{score.format('ga', 'ha')} + {score.format('tg - ga', 'th - ha')} - {score.format('tg', 'th')}"
    return f"""g{number} AS (SELECT *, 1 / (1 + exp(-margin)) - y AS g, 1 / (1 + exp(-margin)) * (1 - 1 / (1 + exp(-margin))) AS h FROM m{number - 1}),
 v{number} AS (SELECT feature, value, sum(g) AS g, sum(h) AS h FROM (UNPIVOT g{number} ON {", ".join(STUMP_FEATURES)} INTO NAME feature VALUE value) GROUP BY ALL),
 u{number} AS (SELECT feature, value, sum(g) OVER up AS ga, sum(h) OVER up AS ha, sum(g) OVER one AS tg, sum(h) OVER one AS th, max(value) OVER one AS top FROM v{number}
  WINDOW up AS (PARTITION BY feature ORDER BY value), one AS (PARTITION BY feature)),
 b{number} AS (SELECT feature, value AS threshold, {gain} AS gain, -0.1 * ga / (ha + 1) AS low, -0.1 * (tg - ga) / (th - ha + 1) AS high, th AS cover
  FROM u{number} WHERE value < top AND ha >= 1 AND th - ha >= 1
  ORDER BY round(gain, 9) DESC, list_position(['quantity', 'discount', 'tax'], feature), threshold LIMIT 1),
 m{number} AS (SELECT m{number - 1}.* REPLACE (margin + CASE WHEN (CASE feature WHEN 'quantity' THEN quantity WHEN 'discount' THEN discount ELSE tax END) <= threshold THEN low ELSE high END AS margin)
  FROM m{number - 1}, b{number})"""


@query(
    "boosted_stumps",
    f"""WITH {K.SQL_LINES}, m0 AS (SELECT quantity, discount, tax, CAST(outcome AS DOUBLE) AS y, 0.0::DOUBLE AS margin FROM lines),
 {", ".join(_sql_stump(i) for i in (1, 2, 3))},
 b AS ({" UNION ALL ".join(f"SELECT CAST({i - 1} AS BIGINT) AS round, * FROM b{i}" for i in (1, 2, 3))})
 SELECT round, feature, round(threshold, 6) AS threshold, round(gain, 4) AS gain, round(low, 6) AS low, round(high, 6) AS high, round(cover, 4) AS cover FROM b""",
)
def boosted_stumps(spark, sf):
    """Three rounds of second-order boosting with one cut each, over all lines."""
    lines = arrays_from_wide(K.line_table(spark, sf), STUMP_FEATURES, [KEY, "outcome"])
    nodes = spark.createDataFrame(T.boost(lines, rounds=3, depth=1).table(), T.TABLE_SCHEMA)
    value = nodes.select("tree", "node", "value")
    low, high = (value.select("tree", F.col("node").alias(side), F.col("value").alias(name)) for side, name in (("left", "low"), ("right", "high")))
    out = nodes.where("feature >= 0").drop("value").join(low, ["tree", "left"]).join(high, ["tree", "right"])
    out = out.withColumn("feature", F.element_at(F.array(*[F.lit(f) for f in STUMP_FEATURES]), F.col("feature") + 1))
    return tidy(out.select(F.col("tree").alias("round"), "feature", "threshold", "gain", "low", "high", "cover"), gain=4, cover=4)


@query("boosted_trees")
def boosted_trees(spark, sf):
    """The nodes of second-order boosting on the document measures; brute force in the tests."""
    frame, names = doc_frame(spark, sf)
    trees = T.boost(frame, rounds=8, depth=3, rate=0.3, column_share=0.8, row_share=0.8)
    return tidy(spark.createDataFrame(trees.table(), T.TABLE_SCHEMA))


_LOGISTIC = f"""{K.SQL_LINES}, n AS (SELECT outcome, count(*) AS c FROM lines GROUP BY 1),
 cells AS (SELECT 'all' AS feature, quantity / 50 AS x, discount * 10 AS z, CAST(lines.outcome AS DOUBLE) AS y, (SELECT sum(c) FROM n) / (2 * n.c) AS w FROM lines JOIN n ON n.outcome = lines.outcome)"""


@query(
    "logistic_coefficients",
    f"WITH {sql_newton(_LOGISTIC, 8)} SELECT term, round(value, 4) AS value FROM (SELECT unnest(['intercept', 'quantity', 'discount']) AS term, unnest([a, b, c]) AS value FROM b8)",
)
def logistic_coefficients(spark, sf):
    lines = K.line_table(spark, sf).select(KEY, "outcome", (F.col("quantity") / 50).alias("quantity"), (F.col("discount") * 10).alias("discount"))
    frame = arrays_from_wide(lines, ["quantity", "discount"], [KEY, "outcome"])
    m = M.fit(frame, "logistic_regression", {"tol": 1e-12}).stages[-1]
    rows = [("intercept", float(m.intercept)), *zip(["quantity", "discount"], map(float, m.coefficients))]
    return tidy(spark.createDataFrame(rows, "term string, value double"), 4)


@query(
    "logistic_coefficients_stacked",
    f"WITH {sql_newton(_LOGISTIC, 8)} SELECT term, round(value, 4) AS value FROM (SELECT unnest(['intercept', 'quantity', 'discount']) AS term, unnest([a, b, c]) AS value FROM b8)",
)
def logistic_coefficients_stacked(spark, sf):
    """The same ridge fit by the stacked Newton steps, next to a path of other penalties."""
    lines = K.line_table(spark, sf).select(KEY, "outcome", (F.col("quantity") / 50).alias("quantity"), (F.col("discount") * 10).alias("discount"))
    frame = arrays_from_wide(lines, ["quantity", "discount"], ["outcome"])
    n = frame.count()
    m = L.fit_many(frame, [L.Setting(0.0, c / n) for c in (100.0, 10.0, 1.0, 0.1)], balanced=True)[2, 0]
    rows = [("intercept", m.intercept), *zip(["quantity", "discount"], map(float, m.coefficients))]
    return tidy(spark.createDataFrame(rows, "term string, value double"), 4)


PATH_LENGTH = 20


@query(
    "elastic_net_path_facts",
    f"""WITH {K.sql_doc_cells()}, c AS (SELECT feature, abs(covar_pop(value, outcome)) / stddev_pop(value) AS c FROM cells GROUP BY 1),
 top AS (SELECT a AS alpha, max(c) / a AS top FROM c, (SELECT unnest([0.1::DOUBLE, 0.5, 1.0]) AS a) GROUP BY 1)
 SELECT alpha, step, round(top * pow(1e-4, step / {PATH_LENGTH - 1}), 6) AS penalty, true AS optimal, true AS no_worse, step = 0 AS empty
 FROM top, (SELECT unnest(range(0, {PATH_LENGTH})) AS step)""",
)
def elastic_net_path_facts(spark, sf):
    """The path of each mixing: its penalties, whether every point is optimal, fits no worse than the one before, and is empty."""
    frame, names = doc_frame(spark, sf)
    rows = []
    for p in L.elastic_net_path(frame, names, [0.1, 0.5, 1.0], PATH_LENGTH):
        before = rows[-1][-1] if p["step"] else float("inf")
        rows.append((p["alpha"], p["step"], p["penalty"], p["off"] <= 1e-6, p["loss"] <= before + 1e-9, p["n_features"] == 0, p["loss"]))
    return tidy(spark.createDataFrame(rows, "alpha double, step long, penalty double, optimal boolean, no_worse boolean, empty boolean, loss double").drop("loss"))


@query("elastic_net_path")
def elastic_net_path(spark, sf):
    """Coefficients along the path, one row for each point and feature."""
    frame, names = doc_frame(spark, sf)
    points = L.elastic_net_path(frame, names, [0.5, 1.0], PATH_LENGTH)
    rows = [(p["alpha"], p["step"], p["penalty"], n, c) for p in points for n, c in p["coefficients"].items()]
    return tidy(spark.createDataFrame(rows, "alpha double, step int, penalty double, feature string, coefficient double"))


@query("grid_search")
def grid_search(spark, sf):
    frame, names = doc_frame(spark, sf)
    grid = {"numTrees": [10, 20], "maxDepth": [2, 4]}
    best, records = M.grid_search(frame, names, KEY, "random_forest", grid, k=3)
    rows = [(str(sorted(x["params"].items())), x["mean"], x["sd"], x["params"] == best) for x in records]
    return spark.createDataFrame(rows, "params string, mean double, sd double, best boolean")


@query(
    "elastic_net_top_penalty",
    f"""WITH {K.sql_doc_cells()}, c AS (SELECT feature, abs(covar_pop(value, outcome)) / stddev_pop(value) AS c FROM cells GROUP BY 1)
 SELECT a AS alpha, round(max(c) / a, 6) AS penalty FROM c, (SELECT unnest([0.1::DOUBLE, 0.5, 1.0]) AS a) GROUP BY 1""",
)
def elastic_net_top_penalty(spark, sf):
    frame, names = doc_frame(spark, sf)
    grid = M.elastic_net_grid(frame, names, 5, [0.1, 0.5, 1.0])
    top = [g for i, g in enumerate(grid) if i % 5 == 0]
    return tidy(spark.createDataFrame([(g["elasticNetParam"], g["regParam"]) for g in top], "alpha double, penalty double"))


@query("cv_auc")
def cv_auc(spark, sf):
    frame, names = doc_frame(spark, sf)
    scores = M.cross_validate(frame, names, KEY, "logistic_regression", {"maxIter": 50}, k=3, repeats=2, scale=True)
    return M.cv_auc(scores)


@query("compare_models")
def compare_models(spark, sf):
    frame, names = doc_frame(spark, sf)
    train, val = M.hold_out(frame, KEY)
    params = {"random_forest": FOREST, "gradient_boosting": BOOST, "logistic_regression": {"maxIter": 50}}
    return M.ModelSet(KEY).compare(train, names, params=params, val=val, k=2)


@query("predict_reload")
def predict_reload(spark, sf):
    frame, names = doc_frame(spark, sf)
    models = M.ModelSet(KEY)
    models.train(frame, names, "random_forest", params=FOREST, k=2)
    path = scratch(spark)
    M.save_model(models.models["random_forest"], path)
    again = M.load_model(spark, path)
    a = models.predict(frame)
    b = M.predict(again.model, frame, [KEY]).select(KEY, F.col("score").alias("reloaded"))
    return a.join(b, KEY).select(KEY, "prediction", r("score").alias("score"), (F.col("score") == F.col("reloaded")).alias("same"))


@query("oob_score")
def oob_score(spark, sf):
    frame, names = doc_frame(spark, sf)
    scores = M.oob_scores(frame, KEY, bags=30, params={"maxDepth": 4})
    return E.accuracy(scores).select(F.lit("accuracy").alias("metric"), F.col("accuracy").alias("value")).unionByName(
        E.auc(scores).select(F.lit("auc").alias("metric"), F.col("auc").alias("value"))
    )


@query(
    "locate_model",
    "SELECT unnest(['comb', 'prot_only', 'newest']) AS asked, unnest(['comb/a_linear', 'prot_only/b_linear', 'prot_only/c_linear']) AS found, count(*) > 0 AS usable FROM labels",
)
def locate_model(spark, sf):
    """Saved models found by a listing of their files: the first of each mode, and the newest of all; each is read and applied."""
    frame, names = doc_frame(spark, sf)
    root = scratch(spark)
    fitted = M.fit(frame, "logistic_regression", {"maxIter": 5}, scale=True)
    metrics = spark.createDataFrame([], M.METRIC_SCHEMA)
    for place in ("prot_only/b_linear", "comb/d_linear", "comb/a_linear", "prot_only/c_linear"):
        M.save_model(M.Trained("logistic_regression", fitted, names, {}, metrics), f"{root}/{place}")
    found = {mode: M.locate_model(spark, root, mode) for mode in ("comb", "prot_only")} | {"newest": M.locate_model(spark, root, newest=True)}
    rows = [(asked, "/".join(path.split("/")[-2:]), M.predict(M.load_model(spark, path).model, frame, [KEY]).count() > 0) for asked, path in found.items()]
    return spark.createDataFrame(rows, "asked string, found string, usable boolean")


@query("streamed_scores", "SELECT CAST(l.quality AS BIGINT) AS outcome, count(*) AS n, true AS same FROM documents d JOIN labels l USING (doc_id) GROUP BY 1")
def streamed_scores(spark, sf):
    """Rows that arrive as files are scored by a stream until all are done; batch scores are the same."""
    frame, names = doc_frame(spark, sf)
    fitted = M.fit(frame, "random_forest", FOREST)
    root = scratch(spark)
    frame.repartition(6).write.parquet(f"{root}/in")
    arriving = spark.readStream.schema(frame.schema).option("maxFilesPerTrigger", 2).parquet(f"{root}/in")
    scored = M.predict(fitted, arriving, [KEY, M.LABEL])
    scored.writeStream.format("parquet").option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start(f"{root}/out").awaitTermination()
    streamed = spark.read.schema(scored.schema).parquet(f"{root}/out").select(KEY, F.col(M.LABEL).alias("outcome"), F.col("score").alias("streamed"))
    both = streamed.join(M.predict(fitted, frame, [KEY]), KEY, "full")
    return tidy(both.groupBy("outcome").agg(F.count("*").alias("n"), F.bool_and(F.coalesce(F.col("score") == F.col("streamed"), F.lit(False))).alias("same")))


@query("best_threshold_of_model")
def best_threshold_of_model(spark, sf):
    frame, names = doc_frame(spark, sf)
    train, val = M.hold_out(frame, KEY)
    fitted = M.fit(train, "random_forest", FOREST)
    return E.best_threshold(M.predict(fitted, val, [KEY, "outcome"]), actual="outcome")


@query("end_to_end")
def end_to_end(spark, sf):
    from phenoloom.plans.study import Settings, run_study

    c = K.docs(spark, sf).stored()
    pheno = c.joined().select(KEY, "outcome", F.lit(None).cast("double").alias("bmi"))
    settings = Settings(forest=FOREST, folds=2, repeats=1, final={"random_forest": FOREST}, models=("random_forest",), kept=3)
    out = run_study(spark, scratch(spark), "docs", c.joined().select(KEY, "features"), c.names, pheno, None, "prot_only", settings)
    return out.ledger().select("step", "rows")


@query(
    "studies",
    f"""WITH n AS (SELECT count(*) AS n FROM documents d JOIN labels l USING (doc_id)), o AS (SELECT unnest(['quality', 'toxic']) AS outcome),
 m AS (SELECT unnest(['prot_only', 'sexagebmi', 'comb']) AS mode, unnest([{len(K.DOC_FEATURES)}, 3, {len(K.DOC_FEATURES) + 3}]) AS features),
 s AS (SELECT unnest(['data_loading', 'feature_names', 'pwas_analysis']) AS step),
 steps AS (SELECT outcome || '-' || mode AS run_id, step, CASE step WHEN 'data_loading' THEN n WHEN 'feature_names' THEN features ELSE {len(K.DOC_FEATURES)} END AS rows
  FROM o, m, s, n WHERE mode <> 'sexagebmi' OR step <> 'pwas_analysis')
 SELECT run_id, step, CAST(rows AS BIGINT) AS rows, 1::BIGINT AS times FROM steps UNION ALL SELECT outcome || '-shared', 'aligned', n, 1 FROM o, n""",
)
def studies(spark, sf):
    """Two outcomes in three modes, called twice: shared rows are made once, and the second call makes nothing anew."""
    from phenoloom.plans.ledger import ledger_of
    from phenoloom.plans.study import Settings, run_studies

    c = K.docs(spark, sf).stored()
    k, labels = F.col("doc_id"), K.table(spark, sf, "labels")
    facts = [k.alias(KEY), (20 + k % 60).alias("age"), (k % 2).alias("sex"), (18 + k % 13).cast("double").alias("bmi")]
    outcomes = {o: labels.select(*facts, F.col(o).alias("outcome")) for o in ("quality", "toxic")}
    settings = Settings(forest={"numTrees": 5, "maxDepth": 3}, folds=2, repeats=1, eliminate=False, kept=3, models=("logistic_regression",))
    root = scratch(spark)
    for _ in range(2):
        run_studies(spark, root, outcomes, c.matrix, c.names, settings=settings, side_by_side=6)
    ledger = ledger_of(spark, root)
    wanted = F.col("step").isin("aligned", "data_loading", "feature_names", "pwas_analysis")
    return tidy(ledger.where(wanted).groupBy("run_id", "step").agg(F.max("rows").alias("rows"), F.count("*").alias("times")))


@query("association_of_trained_features")
def association_of_trained_features(spark, sf):
    frame, names = doc_frame(spark, sf)
    table = spark.createDataFrame(M.feature_weights(M.fit(frame, "random_forest", FOREST), names), "feature string, importance double")
    p = associate_moderated(K.cells_from_arrays(frame, names, ["outcome"])).select("feature", "p_value", "p_adjusted")
    return table.join(p, "feature", "left")
