"""Catalogue: what must hold of any learner, whatever it learned.

Fitted values have no SQL. But which rows each part of a split holds, that every row is scored once, that probabilities
are probabilities, and that reported metrics are those of the stored predictions, follow from the tables alone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from phenoloom.operators import evaluation as E
from phenoloom.operators import models as M
from phenoloom.operators import selection as Z
from phenoloom.plans import cohorts as K
from phenoloom.plans.queries_cohort import scratch
from phenoloom.plans.queries_learn import BOOST, FOREST, KEY, doc_frame
from phenoloom.plans.registry import query, tidy
from phenoloom.session import materialise

_CLASSES = """c AS (SELECT l.quality AS outcome, count(*) AS n FROM documents d JOIN labels l USING (doc_id) GROUP BY 1)"""
_HOLD_OUT = f"""{_CLASSES}, parts AS (SELECT 'val' AS split, outcome, CAST(ceil(0.1 * n) AS BIGINT) AS n FROM c
 UNION ALL SELECT 'train', outcome, n - CAST(ceil(0.1 * n) AS BIGINT) FROM c)"""
_FOREST, _LINEAR = ("random_forest", FOREST, False), ("logistic_regression", {"maxIter": 30}, True)
TRAINED = {
    "train_rf": _FOREST, "train_gbt": ("gradient_boosting", BOOST, False), "train_logistic": _LINEAR,
    "train_xgboost_style": ("xgboost", {"maxIter": 10, "maxDepth": 3, "subsamplingRate": 0.8, "columnShare": 0.8}, False),
    "train_elastic_net": ("elastic_net", {"regParam": 0.01, "maxIter": 50}, True), "train_svm_linear": ("svm", {"kernel": "linear", "maxIter": 10}, True),
    "train_svm_rbf": ("svm", {"kernel": "rbf", "maxIter": 10, "n_random": 32}, True),
}


def _training_facts(model: str, params: dict, scale: bool):
    def run(spark, sf) -> DataFrame:
        data, names = doc_frame(spark, sf)
        train, val = M.hold_out(data, KEY)
        trained = M.train_model(train, names, KEY, val, model, params, k=2, scale=scale)
        told = trained.metrics.where(F.col("metric").isin("accuracy", "auc")).groupBy("split").pivot("metric", ["accuracy", "auc"]).agg(F.first("value"))
        parts = train.withColumn("split", F.lit("train")).unionByName(val.withColumn("split", F.lit("val")))
        scores = materialise(M.predict(trained.model, parts, [KEY, "split", M.LABEL]).withColumnRenamed(M.LABEL, "actual"))
        again = E.accuracy(scores, ["split"]).join(E.auc(scores, ["split"]).select("split", F.col("auc").alias("area")), "split")
        again = again.withColumnRenamed("accuracy", "right").join(told, "split")
        agrees = (F.abs(F.col("right") - F.col("accuracy")) < 1e-9) & (F.abs(F.col("area") - F.col("auc")) < 1e-9)
        sizes = scores.groupBy("split", F.col("actual").cast("int").alias("outcome")).agg(
            F.count("*").alias("n"), F.countDistinct(KEY).alias("distinct"), F.bool_and(F.col("score").between(0, 1)).alias("probabilities")
        )
        out = sizes.join(again.select("split", agrees.alias("metrics_agree")), "split")
        return tidy(out.select("split", "outcome", "n", (F.col("n") == F.col("distinct")).alias("once"), "probabilities", "metrics_agree"))

    return run


for _name, _how in TRAINED.items():
    query(f"{_name}_facts", f"WITH {_HOLD_OUT} SELECT split, CAST(outcome AS BIGINT) AS outcome, n, true AS once, true AS probabilities, true AS metrics_agree FROM parts WHERE n > 0")(
        _training_facts(*_how)
    )


@query(
    "cv_facts",
    f"""WITH {_CLASSES}, f AS (SELECT unnest(range(1, 3)) AS repeat), g AS (SELECT unnest(range(0, 3)) AS fold)
 SELECT repeat, fold, CAST(outcome AS BIGINT) AS outcome, (n + 2 - fold) // 3 AS n, true AS once, true AS probabilities FROM c, f, g WHERE (n + 2 - fold) // 3 > 0""",
)
def cv_facts(spark, sf):
    """Every row is scored once in each repeat, in folds of sizes that differ by one row per class."""
    frame, names = doc_frame(spark, sf)
    scores = M.cross_validate(frame, names, KEY, "logistic_regression", {"maxIter": 20}, k=3, repeats=2, scale=True)
    out = scores.groupBy("repeat", "fold", F.col("actual").cast("int").alias("outcome")).agg(
        F.count("*").alias("n"), (F.count("*") == F.countDistinct(KEY)).alias("once"), F.bool_and(F.col("score").between(0, 1)).alias("probabilities")
    )
    return tidy(out)


@query(
    "importance_facts",
    f"""WITH {K.SQL_DOCS}, n AS (SELECT count(*) > 0 AS filled FROM docs),
 names AS (SELECT unnest([{", ".join(f"'{x}'" for x in K.DOC_FEATURES)}]) AS feature), methods AS (SELECT unnest(['corrected', 'forest']) AS method)
 SELECT method, feature, CAST(1 AS BIGINT) AS times, method = 'forest' AND filled AS adds_up_to_one FROM names, methods, n""",
)
def importance_facts(spark, sf):
    """Each feature has one importance; those of a forest are shares of one, corrected ones are not."""
    frame, names = doc_frame(spark, sf)
    plain = spark.createDataFrame(M.feature_weights(M.fit(frame, "random_forest", FOREST), names), "feature string, importance double")
    both = plain.withColumn("method", F.lit("forest")).unionByName(Z.corrected_importance(frame, names, KEY, FOREST).withColumn("method", F.lit("corrected")))
    sums = both.groupBy("method").agg((F.abs(F.sum("importance") - 1) < 1e-6).alias("adds_up_to_one"))
    return tidy(both.groupBy("method", "feature").agg(F.count("*").alias("times")).join(sums, "method"))


@query(
    "shadow_importance_facts",
    f"""WITH {K.SQL_DOCS}, n AS (SELECT count(*) > 0 AS filled FROM docs), f AS (SELECT unnest([{", ".join(f"'{x}'" for x in K.DOC_FEATURES)}]) AS feature)
 SELECT feature, CAST(1 AS BIGINT) AS times, true AS no_credit_no_gain, true AS p_falls FROM f, n WHERE filled""",
)
def shadow_importance_facts(spark, sf):
    """Each feature has one importance, 0 if it neither won nor lost a node, and no higher one has a greater p-value."""
    frame, names = doc_frame(spark, sf)
    if frame.isEmpty():
        return spark.createDataFrame([], "feature string, times long, no_credit_no_gain boolean, p_falls boolean")
    found = materialise(Z.mirrored_p_values(Z.shadow_importance(frame, names, KEY, trees=10, depth=4)))
    steps = [r["p_value"] for r in found.orderBy(F.desc("importance")).select("p_value").collect()]  # one a feature
    falls = all(a <= b for a, b in zip(steps, steps[1:])) if None not in steps else not any(steps)
    no_gain = F.bool_and((F.col("n_own") + F.col("n_shadow") > 0) | (F.col("importance") == 0)).alias("no_credit_no_gain")
    return tidy(found.groupBy("feature").agg(F.count("*").alias("times"), no_gain).withColumn("p_falls", F.lit(falls)))


@query(
    "elimination_facts",
    f"""WITH k AS (SELECT {len(K.DOC_FEATURES)} AS features, 3 AS kept WHERE EXISTS (SELECT 1 FROM documents)), r AS (SELECT unnest(range(1, features - kept + 2)) AS ranking, kept FROM k)
 SELECT ranking, CASE WHEN ranking = 1 THEN kept ELSE 1 END AS n FROM r""",
)
def elimination_facts(spark, sf):
    """The kept features share the first rank; one feature is eliminated at a time."""
    frame, names = doc_frame(spark, sf)
    return tidy(Z.rfe(frame, names, 3, 1, params=FOREST).groupBy("ranking").agg(F.count("*").alias("n")))


_RUNGS = {"eliminated": [len(K.DOC_FEATURES) - i for i in range(0, len(K.DOC_FEATURES) - 1, 2)] + [1], "ranked_once": [2, 3, 4, len(K.DOC_FEATURES)]}


@query(
    "ladder_facts",
    f"""WITH {K.SQL_DOCS}, n AS (SELECT count(*) > 0 AS filled FROM docs), rungs AS ({" UNION ALL ".join(f"SELECT '{m}' AS method, unnest({sorted(set(v))}) AS n_features" for m, v in _RUNGS.items())})
 SELECT method, CAST(n_features AS BIGINT) AS n_features, CAST(3 AS BIGINT) AS folds, true AS once, true AS shares, true AS picked_is_best FROM rungs, n WHERE filled""",
)
def ladder_facts(spark, sf):
    """Both ladders score every size once in every fold, and the size that is kept has the best mean score."""
    frame, names = doc_frame(spark, sf)
    if frame.isEmpty():
        return spark.createDataFrame([], "method string, n_features long, folds long, once boolean, shares boolean, picked_is_best boolean")
    selection, by_steps = Z.rfe_cv(frame, names, KEY, 2, 3, estimator="logistic_regression", params={"maxIter": 10})
    kept, at_once = Z.rfe_sizes(frame, names, KEY, max_size=4, k=3, params={"numTrees": 10, "maxDepth": 4})
    tables = []
    for method, ladder, size, most in (
        ("eliminated", by_steps, selection.where("selected").count(), len(names)), ("ranked_once", at_once, len(kept), len(names) - 1),
    ):
        scores: dict[int, list[float]] = {}
        for r in ladder.collect():  # one row per size and fold
            scores.setdefault(r["n_features"], []).append(r["score"])
        means = {n: round(sum(v) / len(v), 9) for n, v in scores.items() if n <= most}
        rows = ladder.groupBy("n_features").agg(
            F.countDistinct("fold").alias("folds"), (F.count("*") == F.countDistinct("fold")).alias("once"), F.bool_and(F.col("score").between(0, 1)).alias("shares")
        )
        tables.append(rows.withColumn("method", F.lit(method)).withColumn("picked_is_best", F.lit(means[size] == max(means.values()))))
    return tidy(tables[0].unionByName(tables[1]))


@query(
    "repeated_importance_facts",
    f"""WITH {_CLASSES}, f AS (SELECT unnest(range(1, 3)) AS repeat), g AS (SELECT unnest(range(0, 2)) AS fold)
 SELECT repeat, fold, CAST(outcome AS BIGINT) AS outcome, (n + 1 - fold) // 2 AS n, true AS once, CAST({len(K.DOC_FEATURES)} AS BIGINT) AS features FROM c, f, g WHERE (n + 1 - fold) // 2 > 0""",
)
def repeated_importance_facts(spark, sf):
    """Each fit of each repeat gives every feature one importance, and scores every row that it has not seen once."""
    frame, names = doc_frame(spark, sf)
    table, scores = Z.repeated_importance(frame, names, KEY, k=2, repeats=2, params={"numTrees": 10, "maxDepth": 4})
    sizes = scores.groupBy("repeat", "fold", F.col("actual").cast("int").alias("outcome")).agg(F.count("*").alias("n"), (F.count("*") == F.countDistinct(KEY)).alias("once"))
    told = table.groupBy("repeat", "fold").agg(F.when(F.count("*") == F.countDistinct("feature"), F.count("*")).alias("features"))
    return tidy(sizes.join(told, ["repeat", "fold"]))


@query(
    "comparison_facts",
    f"""WITH {_HOLD_OUT}, m AS (SELECT unnest(['random_forest', 'logistic_regression']) AS model), s AS (SELECT split, sum(n) AS n FROM parts GROUP BY 1)
 SELECT model, split, CAST(n AS BIGINT) AS n, true AS metrics_agree, true AS no_error FROM m, s WHERE n > 0""",
)
def comparison_facts(spark, sf):
    """The metrics of models compared side by side are those of their own predictions on both parts."""
    frame, names = doc_frame(spark, sf)
    train, val = M.hold_out(frame, KEY)
    models = M.ModelSet(KEY)
    params = {"random_forest": {"numTrees": 10, "maxDepth": 4}, "logistic_regression": {"maxIter": 10}}
    told = materialise(models.compare(train, names, list(params), params, val=val, k=2))
    parts = train.withColumn("split", F.lit("train")).unionByName(val.withColumn("split", F.lit("val")))
    out = None
    for m in params:
        scores = materialise(M.predict(models.models[m].model, parts, [KEY, "split", M.LABEL]).withColumnRenamed(M.LABEL, "actual"))
        own = E.accuracy(scores, ["split"]).withColumnRenamed("accuracy", "right").join(E.auc(scores, ["split"]).select("split", F.col("auc").alias("area")), "split")
        mine = told.where(F.col("model") == m)
        both = mine.where(F.col("metric").isin("accuracy", "auc")).groupBy("split").pivot("metric", ["accuracy", "auc"]).agg(F.first("value")).join(own, "split")
        agrees = (F.abs(F.col("right") - F.col("accuracy")) < 1e-9) & (F.abs(F.col("area") - F.col("auc")) < 1e-9)
        rows = both.select("split", agrees.alias("metrics_agree")).join(scores.groupBy("split").agg(F.count("*").alias("n")), "split")
        failed = mine.groupBy(F.lit(m).alias("model")).agg((F.count("error") == 0).alias("no_error"))
        rows = rows.withColumn("model", F.lit(m)).join(failed, "model")
        out = rows if out is None else out.unionByName(rows)
    return tidy(out)


@query(
    "selection_facts",
    f"""WITH {K.SQL_DOCS}, n AS (SELECT count(*) > 0 AS filled FROM docs), m AS (SELECT unnest(['rfe_lr', 'univariate', 'variance_threshold']) AS method)
 SELECT method, CAST({len(K.DOC_FEATURES)} AS BIGINT) AS features, true AS once, true AS fits FROM m, n WHERE filled""",
)
def selection_facts(spark, sf):
    """Every method judges every feature once and selects what it says: the k best scores, those over the threshold, or some."""
    frame, names = doc_frame(spark, sf)
    table = materialise(Z.compare_selection(frame, names, KEY, ["rfe_lr", "univariate", "variance_threshold"], 3, 10.0, {"logistic_regression": {"maxIter": 10}}, folds=2))
    chosen = F.col("selected")
    least, most = F.min(F.when(chosen, F.col("score"))), F.max(F.when(~chosen, F.col("score")))
    by = table.groupBy("method").agg(
        F.count("*").alias("features"), (F.count("*") == F.countDistinct("feature")).alias("once"), F.count_if(chosen).alias("n"), least.alias("least"), most.alias("most")
    )
    best = (F.col("n") == 3) & (F.col("least") >= F.col("most"))
    over = F.coalesce(F.col("least") > 10.0, F.lit(True)) & F.coalesce(F.col("most") <= 10.0, F.lit(True))
    fits = F.when(F.col("method") == "univariate", best).when(F.col("method") == "variance_threshold", over).otherwise(F.col("n") > 0)
    return tidy(by.select("method", "features", "once", fits.alias("fits")))


@query("reload_facts", f"WITH {_CLASSES} SELECT CAST(outcome AS BIGINT) AS outcome, n, true AS same FROM c")
def reload_facts(spark, sf):
    """A stored model that is read again gives every row the same score."""
    frame, names = doc_frame(spark, sf)
    models = M.ModelSet(KEY)
    models.train(frame, names, "random_forest", params=FOREST, k=2)
    path = scratch(spark)
    M.save_model(models.models["random_forest"], path)
    again = M.predict(M.load_model(spark, path).model, frame, [KEY, M.LABEL]).select(KEY, M.LABEL, F.col("score").alias("reloaded"))
    both = models.predict(frame).select(KEY, "score").join(again, KEY)
    return tidy(both.groupBy(F.col(M.LABEL).alias("outcome")).agg(F.count("*").alias("n"), F.bool_and(F.col("score") == F.col("reloaded")).alias("same")))


@query("oob_facts", f"WITH {_CLASSES} SELECT CAST(outcome AS BIGINT) AS outcome, n, true AS once, true AS shares, true AS left_out FROM c")
def oob_facts(spark, sf):
    """Every row is scored once, by trees of the reported forest whose bags leave it out; a row in all bags has no score."""
    frame, names = doc_frame(spark, sf)
    _, scores = M.oob_forest(frame, KEY, {"trees": 20, "depth": 5})
    out = scores.groupBy(F.col("actual").alias("outcome")).agg(
        F.count("*").alias("n"), (F.count("*") == F.countDistinct(KEY)).alias("once"), F.bool_and(F.coalesce(F.col("score").between(0, 1), F.col("n_trees") == 0)).alias("shares"),
        F.bool_and(F.col("n_trees").between(0, 20)).alias("left_out"),
    )
    return tidy(out)
