"""Feature selection: univariate, by variance, by recursive elimination."""

from __future__ import annotations

import warnings
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from phenoloom.operators import evaluation as E
from phenoloom.operators import models as M
from phenoloom.operators import trees as T
from phenoloom.operators.association import anova, variances
from phenoloom.operators.ordered import SLICE, accumulate, hashed_rank, slice_by_order
from phenoloom.operators.shape import cells_from_arrays, slice_arrays
from phenoloom.session import materialise

# Features entering the elimination, and how many are kept by default.
ENTERING = 100
DEFAULT_KEPT = 20
FOREST_TREES = 100
SELECTION_METHODS = ("rfe_rf", "rfe_lr", "univariate", "variance_threshold")
ESTIMATORS = {"random_forest": {"numTrees": FOREST_TREES}, "logistic_regression": {}}


# --- univariate ------------------------------------------------------------------------------------------------------


def select_k_best(cells: DataFrame, k: int = DEFAULT_KEPT, outcome: str = "outcome") -> DataFrame:
    """The ``k`` features of highest F score, with score and p-value."""
    return anova(cells, outcome).orderBy(F.col("f_score").desc_nulls_last(), "feature").limit(k)


def with_forced(selected: DataFrame, covariates: Sequence[str]) -> DataFrame:
    """Selected features together with covariates that must be in."""
    forced = selected.sparkSession.createDataFrame([(c,) for c in covariates], "feature string")
    return selected.select("feature").union(forced).distinct()


# --- picking a size --------------------------------------------------------------------------------------------------


def mean_ladder(ladder: DataFrame) -> DataFrame:
    """Mean score per subset size; one row per size, whatever the number of folds."""
    return ladder.groupBy("n_features").agg(F.avg("score").alias("score"))


def pick_size(ladder: DataFrame) -> DataFrame:
    """The size of the best mean score, the smallest on ties."""
    best = F.max_by("n_features", F.struct(F.round("score", 12), -F.col("n_features")))
    return mean_ladder(ladder).agg(best.alias("n_features"))


def pick_size_below_full(ladder: DataFrame) -> DataFrame:
    """As above, but the full set does not count."""
    means = mean_ladder(ladder)
    full = ladder.agg(F.max("n_features")).scalar()
    best = F.max_by("n_features", F.struct(F.round("score", 12), -F.col("n_features")))
    return means.where(F.col("n_features") < full).agg(best.alias("n_features"))


# --- importance by fits ----------------------------------------------------------------------------------------------


def forest_importance(
    frame: DataFrame, names: Sequence[str], key: str, params: dict | None = None, k: int = 10, seed: int = M.SEED, parallelism: int = 4
) -> tuple[DataFrame, DataFrame]:
    """Importances of one forest, and its performance: training AUC, mean and spread of the cross-validated AUC."""
    spark = frame.sparkSession
    fitted = M.fit(frame, "random_forest", params, seed)
    table = spark.createDataFrame(M.feature_weights(fitted, names), "feature string, importance double")
    return table, evaluate_features(frame, names, key, k, params, seed, parallelism, fitted)


def evaluate_features(
    frame: DataFrame,
    names: Sequence[str],
    key: str,
    k: int = 5,
    params: dict | None = None,
    seed: int = M.SEED,
    parallelism: int = 4,
    fitted=None,
) -> DataFrame:
    """How well a forest does with these features: ``(metric, value)`` rows."""
    params = params or {"numTrees": FOREST_TREES}
    fitted = fitted or M.fit(frame, "random_forest", params, seed)
    train = E.auc(M.predict(fitted, frame, [key, M.LABEL]), actual=M.LABEL).first()["auc"]
    cv = M.cv_auc(M.cross_validate(frame, names, key, "random_forest", params, k, seed=seed, parallelism=parallelism)).first()
    rows = [("train_auc", train), ("cv_auc_mean", cv["auc_mean"]), ("cv_auc_std", cv["auc_std"])]
    rows += [(f"cv_auc_{i}", v) for i, v in enumerate(cv["auc_scores"])]
    return frame.sparkSession.createDataFrame(rows, "metric string, value double")


def with_shadows(frame: DataFrame, key: str, seed: int | str = M.SEED) -> DataFrame:
    """Every row gets the features of another row after its own: the copy keeps each feature's distribution and loses
    its relation to the outcome. Rows are paired by an equi-join of two hashed orders."""
    one = hashed_rank(frame, F.col(key), f"{seed}:own", out="_rank")
    two = hashed_rank(frame.select(key, "features"), F.col(key), f"{seed}:shadow", out="_rank").select("_rank", F.col("features").alias("_shadow"))
    return one.join(two, "_rank").withColumn("features", F.concat("features", "_shadow")).drop("_rank", "_shadow")


def corrected_importance(frame: DataFrame, names: Sequence[str], key: str, params: dict | None = None, seed: int = M.SEED) -> DataFrame:
    """Impurity importance less that of the feature's shadow (Nembrini et al. 2018); may be negative."""
    both = [*names, *[f"shadow:{n}" for n in names]]
    fitted = M.fit(with_shadows(frame, key, seed), "random_forest", params, seed, keep=True)
    weights = dict(M.feature_weights(fitted, both))
    rows = [(n, weights[n] - weights[f"shadow:{n}"]) for n in names]
    return frame.sparkSession.createDataFrame(rows, "feature string, importance double")


def shadow_importance(
    frame: DataFrame,
    names: Sequence[str],
    key: str,
    label: str = M.LABEL,
    trees: int = FOREST_TREES,
    depth: int | None = None,
    seed: int = M.SEED,
    **how,
) -> DataFrame:
    """``feature, importance, n_own, n_shadow``: decrease of impurity, corrected by shadows drawn in each node, per tree.

    In every node the drawn features compete with shadows of themselves. The gain counts for a feature that wins and
    against one whose shadow wins, so a feature without relation to the outcome gets zero on average whatever its
    number of values. Rows are as wide as before: a shadow needs the sums of a node's bins only. A feature that neither
    won nor lost a node has 0.
    """
    spark = frame.sparkSession
    _, credits = T.shadowed_forest(frame, key, label, trees=trees, depth=depth, seed=seed, **how)
    own, gain, lost = [0] * len(names), [0.0] * len(names), [0] * len(names)
    for _, _, f, g in credits:
        own[f], lost[f], gain[f] = own[f] + (g > 0), lost[f] + (g < 0), gain[f] + g / trees
    return spark.createDataFrame(list(zip(names, gain, own, lost)), "feature string, importance double, n_own long, n_shadow long")


def mirrored_p_values(table: DataFrame, value: str = "importance", by: Sequence[str] = (), out: str = "p_value") -> DataFrame:
    """Adds the chance of an importance this high if the feature has no relation to the outcome (Janitza et al. 2018).

    Importances below zero come from chance alone; they, their mirror images and the zeros are the null distribution of
    their group ``by``. ``out`` is the share of it that is not below a value. It is null for a null or NaN importance,
    and in a group whose importances are all positive. Equal values are collapsed before they are ordered.
    """
    grouped = table.withColumn("_group", F.struct(*by) if by else F.lit(0))
    known = F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double"))
    number = F.col(value).cast("double") + F.lit(0.0)  # -0.0 and 0.0 are one value
    chance, itself = (lambda v: F.struct(v.alias("_value"), F.lit(1).alias("_null"))), F.struct(number.alias("_value"), F.lit(0).alias("_null"))
    sides = F.when(number > 0, F.array(itself)).when(number < 0, F.array(chance(number), chance(-number))).otherwise(F.array(chance(number)))
    merged = grouped.where(known).select("_group", F.inline(sides)).groupBy("_group", "_value").agg(F.sum("_null").cast("long").alias("_null"))
    order, group = [F.col("_value")], ["_group"]
    above = accumulate(slice_by_order(merged, order, group), order, {"_above": ("sum", F.col("_null"))}, group, backward=True).drop(SLICE)
    whole = above.groupBy("_group").agg(F.sum("_null").alias("_all"))
    found = above.join(whole, "_group").select("_group", "_value", F.when(F.col("_all") > 0, F.col("_above") / F.col("_all")).alias(out))
    return grouped.drop(out).withColumn("_value", F.when(known, number)).join(found, ["_group", "_value"], "left").drop("_group", "_value")


def repeated_importance(
    frame: DataFrame,
    names: Sequence[str],
    key: str,
    k: int = 5,
    repeats: int = 5,
    params: dict | None = None,
    grid: dict | None = None,
    inner_k: int = 5,
    sampling: str | None = None,
    seed: int = M.SEED,
    parallelism: int = 4,
) -> tuple[DataFrame, DataFrame]:
    """Corrected forest importances in every repeat and fold, and the held-out scores of the same fits.

    With a ``grid`` each training part is tuned by an inner cross-validation (accuracy). Importances come off the fitted
    models, one row per (repeat, fold, feature); a feature no tree used has a NULL.
    """
    spark = frame.sparkSession
    both = [*names, *[f"shadow:{n}" for n in names]]
    folded = M.with_folds(frame, key, k, repeats, seed).persist(StorageLevel.MEMORY_AND_DISK)
    counts = M.fold_counts(folded)

    def job(repeat: int, fold: int):
        def run():
            here = F.col("folds")[repeat] == fold
            train = folded.where(~here).drop("folds")
            chosen = dict(params or {})
            if grid:
                best, _ = M.grid_search(
                    train, names, key, "random_forest", grid, inner_k, 1, "accuracy", sampling, seed, parallelism=1, base=params
                )
                chosen |= best
            used = M._resampled(train, names, key, sampling, f"{seed}:{repeat}:{fold}")
            used_key = "draw" if sampling == "rose" else key
            # a permutation of the rows keeps the class counts
            known = None if sampling == "rose" else M._training_counts(counts, repeat, fold)
            fitted = M.fit(with_shadows(used, used_key, f"{seed}:{repeat}:{fold}"), "random_forest", chosen, seed, counts=known, keep=True)
            w = dict(M.feature_weights(fitted, both))
            rows = [
                (repeat, fold, n, None if w[n] == 0 and w[f"shadow:{n}"] == 0 else w[n] - w[f"shadow:{n}"]) for n in names
            ]
            # shadows of held-out rows are needed only to fill the places
            test = folded.where(here).withColumn("features", F.concat("features", "features"))
            scored = M.predict(fitted, test, [key, M.LABEL]).select(
                F.lit("random_forest").alias("model"), F.lit(repeat).alias("repeat"), F.lit(fold).alias("fold"), key, F.col(M.LABEL).alias("actual"), "prediction", "score"
            )
            return rows, scored

        return run

    try:
        done = M.run_all([job(r, f) for r in range(1, repeats + 1) for f in range(k)], parallelism)
        table = spark.createDataFrame([row for rows, _ in done for row in rows], "repeat int, fold int, feature string, importance double")
        return table, materialise(reduce(DataFrame.unionByName, [s for _, s in done]))
    finally:
        folded.unpersist()


# --- recursive elimination -------------------------------------------------------------------------------------------


def _estimator(name: str, params: dict | None) -> tuple[str, dict]:
    if name not in ESTIMATORS:
        raise ValueError(f"unknown estimator {name!r}")
    return name, ESTIMATORS[name] | (params or {})


def _eliminate(
    frame: DataFrame, names: Sequence[str], down_to: int, step: int, model: str, params: dict, seed: int, counts: dict, seen: Callable | None = None
) -> tuple[list[str], dict[str, int], dict[str, float]]:
    """Fit, drop the ``step`` least important, again. Returns what is left, the ranking, and the last importances.

    ``seen(fitted, kept)`` is called for every rung.
    """
    kept, dropped, weights = list(names), [], {}
    while True:
        fitted = M.fit(slice_arrays(frame, names, kept), model, params, seed, counts=counts)
        weights = dict(M.feature_weights(fitted, kept))
        if seen:
            seen(fitted, list(kept))
        if len(kept) <= down_to:
            break
        n = min(step, len(kept) - down_to)
        worst = sorted(kept, key=lambda f: (weights[f], f))[:n]
        dropped.append(worst)
        kept = [f for f in kept if f not in worst]
    ranking = dict.fromkeys(kept, 1)
    for i, group in enumerate(reversed(dropped)):
        ranking |= dict.fromkeys(group, i + 2)
    return kept, ranking, weights


def _table(frame: DataFrame, names: Sequence[str], kept: Sequence[str], ranking: dict, weights: dict) -> DataFrame:
    rows = [(n, ranking[n], n in kept, weights.get(n, 0.0)) for n in names]
    return frame.sparkSession.createDataFrame(rows, "feature string, ranking int, selected boolean, importance double")


def rfe(
    frame: DataFrame,
    names: Sequence[str],
    n_select: int | None = None,
    step: int = 1,
    estimator: str = "random_forest",
    params: dict | None = None,
    seed: int = M.SEED,
) -> DataFrame:
    """Eliminate down to ``n_select`` features (default: half of them, at most 20). ``ranking`` 1 is selected."""
    model, settings = _estimator(estimator, params)
    down_to = n_select or max(1, min(DEFAULT_KEPT, len(names) // 2))
    counts = M.class_counts(frame, M.LABEL)
    frame = M.compact(frame, sum(counts.values())).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        out = _eliminate(frame, names, down_to, step, model, settings, seed, counts)
    finally:
        frame.unpersist()
    return _table(frame, names, *out)


def rfe_cv(
    frame: DataFrame,
    names: Sequence[str],
    key: str,
    step: int = 1,
    k: int = 5,
    estimator: str = "random_forest",
    params: dict | None = None,
    metric: str = "auc",
    seed: int = M.SEED,
    parallelism: int = 4,
    size_rule: Callable[[DataFrame], DataFrame] = pick_size,
) -> tuple[DataFrame, DataFrame]:
    """Eliminate in every fold, score each rung on the fold's held-out rows, pick the size, and refit on all rows.

    Returns the selection and ``ladder(n_features, fold, metric, score)``. All rungs of all folds are scored by one
    grouped aggregate.
    """
    model, settings = _estimator(estimator, params)
    folded = M.with_folds(frame, key, k, 1, seed).persist(StorageLevel.MEMORY_AND_DISK)
    counts = M.fold_counts(folded)

    def job(fold: int):
        def run():
            here = F.col("folds")[1] == fold
            test, parts = folded.where(here), []

            def seen(fitted, kept):
                s = M.predict(fitted, slice_arrays(test, names, kept), [key, M.LABEL])
                parts.append(s.select(F.lit(len(kept)).alias("n_features"), F.lit(fold).alias("fold"), F.col(M.LABEL).alias("actual"), "prediction", "score"))

            _eliminate(folded.where(~here), names, 1, step, model, settings, seed, M._training_counts(counts, 1, fold), seen)
            return parts

        return run

    try:
        parts = [p for ps in M.run_all([job(f) for f in range(k)], parallelism) for p in ps]
        ladder = materialise(_ladder(reduce(DataFrame.unionByName, parts), metric))
    finally:
        folded.unpersist()
    size = size_rule(ladder).first()["n_features"]
    return rfe(frame, names, size, step, estimator, params, seed), ladder


def _ladder(scores: DataFrame, metric: str) -> DataFrame:
    by = ["n_features", "fold"]
    table = E.auc(scores, by) if metric == "auc" else E.accuracy(scores, by)
    return table.select(*by, F.lit(metric).alias("metric"), F.col(metric).alias("score"))


def rfe_sizes(
    frame: DataFrame,
    names: Sequence[str],
    key: str,
    max_size: int,
    min_size: int = 2,
    k: int = 3,
    params: dict | None = None,
    seed: int = M.SEED,
    parallelism: int = 4,
    size_rule: Callable[[DataFrame], DataFrame] = pick_size_below_full,
) -> tuple[list[str], DataFrame]:
    """The other published form: rank once per fold on all features, score sizes ``min..max`` and the full set by
    accuracy, pick by a rule that leaves the full set out, and keep the features of highest mean importance."""
    settings = ESTIMATORS["random_forest"] | (params or {})
    folded = M.with_folds(frame, key, k, 1, seed).persist(StorageLevel.MEMORY_AND_DISK)
    counts = M.fold_counts(folded)
    sizes = sorted({s for s in range(min_size, max_size + 1) if s < len(names)} | {len(names)}, reverse=True)

    def job(fold: int):
        def run():
            here = F.col("folds")[1] == fold
            train, test = folded.where(~here), folded.where(here)
            used = M._training_counts(counts, 1, fold)
            full = M.fit(train, "random_forest", settings, seed, counts=used)
            weights = dict(M.feature_weights(full, names))
            ranked, parts = sorted(names, key=lambda f: (-weights[f], f)), []
            for s in sizes:
                kept = ranked[:s] if s < len(names) else list(names)
                fitted = full if s == len(names) else M.fit(slice_arrays(train, names, kept), "random_forest", settings, seed, counts=used)
                p = M.predict(fitted, slice_arrays(test, names, kept), [key, M.LABEL])
                parts.append(p.select(F.lit(s).alias("n_features"), F.lit(fold).alias("fold"), F.col(M.LABEL).alias("actual"), "prediction", "score"))
            return weights, parts

        return run

    try:
        done = M.run_all([job(f) for f in range(k)], parallelism)
        ladder = materialise(_ladder(reduce(DataFrame.unionByName, [p for _, ps in done for p in ps]), "accuracy"))
    finally:
        folded.unpersist()
    size = size_rule(ladder).first()["n_features"]
    mean = {n: sum(w[n] for w, _ in done) / k for n in names}
    return sorted(names, key=lambda f: (-mean[f], f))[:size], ladder


def entering(ranked: DataFrame, n: int = ENTERING) -> DataFrame:
    return ranked.where(F.col("rank") <= n)


def compare_selection(
    frame: DataFrame,
    names: Sequence[str],
    key: str,
    methods: Sequence[str] = SELECTION_METHODS,
    k: int = DEFAULT_KEPT,
    threshold: float = 0.0,
    params: dict[str, dict] | None = None,
    seed: int = M.SEED,
    folds: int = 5,
) -> DataFrame:
    """``(method, feature, selected, score)`` of several methods. One that fails or is unknown is warned about."""
    cells = cells_from_arrays(frame, names, [M.LABEL])
    params, tables = params or {}, []

    def by_rfe(estimator: str):
        t, _ = rfe_cv(frame, names, key, 1, folds, estimator, params.get(estimator), seed=seed)
        return t.select("feature", "selected", F.col("importance").alias("score"))

    def univariate():
        scores = materialise(anova(cells))
        best = scores.orderBy(F.col("f_score").desc_nulls_last(), "feature").limit(k).select("feature", F.lit(True).alias("selected"))
        return scores.join(best, "feature", "left").select("feature", F.coalesce("selected", F.lit(False)).alias("selected"), F.col("f_score").alias("score"))

    known = {
        "rfe_rf": lambda: by_rfe("random_forest"),
        "rfe_lr": lambda: by_rfe("logistic_regression"),
        "univariate": univariate,
        "variance_threshold": lambda: variances(cells, threshold).select("feature", "selected", F.col("variance").alias("score")),
    }
    for m in methods:
        if m not in known:
            warnings.warn(f"unknown selection method {m!r}")
            continue
        try:
            tables.append(known[m]().select(F.lit(m).alias("method"), "feature", "selected", "score"))
        except Exception as e:  # noqa: BLE001
            warnings.warn(f"selection method {m!r} failed: {e}")
    return reduce(DataFrame.unionByName, tables)
