"""Whole studies, of one outcome in one predictor mode or of all of them, step by step, each step stored and resumable."""

from __future__ import annotations

import threading
import time
from collections.abc import Sequence
from dataclasses import asdict, dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from phenoloom.operators import association as A
from phenoloom.operators import cohort as C
from phenoloom.operators import evaluation as E
from phenoloom.operators import importance as I
from phenoloom.operators import models as M
from phenoloom.operators import selection as Z
from phenoloom.operators.resampling import holdout_split
from phenoloom.operators.shape import cells_from_arrays, slice_arrays
from phenoloom.plans.ledger import Run

KEY = "sample_id"
# Covariates a mode adds.
COVARIATES = ("age", "sex", "bmi")


@dataclass(frozen=True)
class Settings:
    """Options of a study. The defaults follow the script with saved steps; ``flavour="adjusted"``, ``min_hits=1``,
    ``max_features=200``, ``metric="auc"`` follow the modular one."""

    flavour: str = "moderated"
    min_hits: int = 2
    max_features: int | None = None
    top_n: int = 200
    holdout: float = 0.1
    folds: int = 5
    repeats: int = 5
    forest: dict = field(default_factory=lambda: {"numTrees": 500})
    tune_forest: bool = False
    sampling: str | None = None
    eliminate: bool = True
    entering: int = Z.ENTERING
    kept: int = 8
    models: Sequence[str] = ("random_forest", "elastic_net", "xgboost")
    final: dict = field(default_factory=dict)
    tune: bool = False
    metric: str = "accuracy"
    missing_bmi: str = "drop"
    sex_codes: dict = field(default_factory=lambda: dict(C.SEX_MALE_ZERO))
    seed: int = 42
    parallelism: int = 4


def covariate_columns(pheno: DataFrame, codes: dict) -> DataFrame:
    """``age``, ``sex``, ``bmi`` as numbers, whatever they were called; absent ones are left out."""
    found = C.find_covariates(pheno.columns)
    out = pheno
    for name, column in found.items():
        value = F.col(column)
        if name == "sex" and dict(pheno.dtypes)[column] == "string":
            value = C.recode(value, codes)
        out = out.withColumn(name, value.try_cast("double"))
    return out


def load(matrix: DataFrame, names: Sequence[str], pheno: DataFrame, mode: str, s: Settings) -> tuple[DataFrame, list[str]]:
    """Aligned, imputed rows with their split: ``(sample_id, outcome, features, split)``."""
    if mode not in C.PRED_MODES:
        raise ValueError(f"invalid predictor mode {mode!r}")
    C.require_overlap(matrix, pheno, KEY, "study")
    C.require_classes(pheno, M.LABEL)
    pheno = covariate_columns(pheno.where(F.col(M.LABEL).isNotNull()), s.sex_codes)
    covs = [c for c in COVARIATES if c in pheno.columns]
    names = list(names)
    if mode != "prot_only":
        if "bmi" in covs and s.missing_bmi == "drop":
            pheno = pheno.dropna(subset=["bmi"])
        if mode == "sexagebmi" and not covs:
            raise ValueError("no sex, age or bmi column found")
        matrix, names = C.append_covariates(matrix, names, pheno, covs, KEY) if covs else (matrix, names)
        if mode == "sexagebmi":
            matrix, names = slice_arrays(matrix, names, covs), covs
    rows = matrix.select(KEY, "features").join(pheno.select(KEY, F.col(M.LABEL).cast("int").alias(M.LABEL)), KEY)
    split = holdout_split(rows, KEY, M.LABEL, s.holdout, s.seed)
    medians = C.feature_medians(cells_from_arrays(split.where("split = 'train'"), names, []).where(F.col("value").isNotNull()))
    fill = {r["feature"]: r["median"] for r in medians.collect()}
    return C.impute_arrays(split, names, fill), names


def run_study(
    spark: SparkSession,
    root: str,
    outcome: str,
    matrix: DataFrame,
    names: Sequence[str],
    pheno: DataFrame,
    annotation: DataFrame | None = None,
    mode: str = "prot_only",
    settings: Settings = Settings(),
) -> Run:
    """Load, associate, rank, eliminate, train, evaluate. A step whose parameters and predecessor are unchanged is read
    back instead of made again. ``pheno`` holds the outcome as 0/1 in ``outcome``."""
    s, run = settings, Run(spark, root, f"{outcome}-{mode}")

    def params(step: str, after: str | None, **more) -> dict:
        return {"mode": mode, "outcome": outcome, "after": run.info(after)["path"] if after else None} | more

    base = {k: v for k, v in asdict(s).items() if k in ("holdout", "missing_bmi", "sex_codes", "seed")}
    planned = load(matrix, names, pheno, mode, s) if not _stored(run, "data_loading", params("", None, **base)) else None
    rows = run.step("data_loading", params("", None, **base), lambda: planned[0], "aligned, imputed, split")
    listed = run.step(
        "feature_names",
        params("", "data_loading"),
        lambda: spark.createDataFrame(list(enumerate(planned[1] if planned else load(matrix, names, pheno, mode, s)[1])), "position int, feature string"),
    )
    names = [r["feature"] for r in listed.orderBy("position").collect()]
    train, val = rows.where("split = 'train'").drop("split"), rows.where("split = 'val'").drop("split")
    covs = [c for c in COVARIATES if c in names] if mode != "prot_only" else []
    tested = [n for n in names if n not in covs]

    if mode == "sexagebmi":
        last, final = "feature_names", covs
    else:
        last, final = _select_features(run, params, s, train, names, tested, covs, pheno, annotation)
    final_table = run.step(
        "model_data_prep", params("", last, forced=covs), lambda: spark.createDataFrame(list(enumerate(final)), "position int, feature string")
    )
    final = [r["feature"] for r in final_table.orderBy("position").collect()]
    fit_on, test_on = slice_arrays(train, names, final), slice_arrays(val, names, final)

    for model in s.models:
        wanted = params("", "model_data_prep", model=model, settings=s.final.get(model), tune=s.tune, sampling=s.sampling, folds=s.folds, repeats=s.repeats)
        path = f"{run.root}/{run.run_id}/models/{model}"

        def make(model=model, path=path):
            done = M.train_model(
                fit_on, final, KEY, test_on, model, s.final.get(model), s.tune, None, s.folds, s.repeats, s.metric, False, s.sampling, s.seed, s.parallelism
            )
            M.save_model(done, path)
            return done.metrics

        run.step(f"model_{model}", wanted, make, f"{model} on {len(final)} features")
        run.step(
            f"threshold_{model}",
            params("", f"model_{model}"),
            lambda path=path: E.best_threshold(M.predict(M.load_model(spark, path).model, test_on, [KEY, M.LABEL]), actual=M.LABEL),
        )
    return run


def _stored(run: Run, step: str, params: dict) -> bool:
    from phenoloom.plans.ledger import params_hash

    row = run.info(step)
    return row is not None and row["params_hash"] == params_hash(params)


def _select_features(run, params, s: Settings, train, names, tested, covs, pheno, annotation):
    spark = run.spark

    def associate() -> DataFrame:
        if s.flavour == "moderated":
            return A.associate_moderated(cells_from_arrays(slice_arrays(train, names, tested), tested, [M.LABEL]), M.LABEL)
        if s.flavour != "adjusted":
            raise ValueError(f"invalid flavour {s.flavour!r}")
        used = [c for c in C.find_covariates(pheno.columns)]
        table = covariate_columns(pheno, s.sex_codes).select(KEY, *used)
        joined = slice_arrays(train, names, tested).join(table, KEY).dropna(subset=used) if used else slice_arrays(train, names, tested)
        return A.associate_adjusted(joined, tested, used, M.LABEL)

    results = run.step("pwas_analysis", params("", "feature_names", flavour=s.flavour), associate, "every feature against the outcome")
    chosen = run.step(
        "selected_features",
        params("", "pwas_analysis", min_hits=s.min_hits, cap=s.max_features, top=s.top_n),
        lambda: A.select_with_fallback(results, s.min_hits, s.max_features, s.top_n).select("feature", "p_value", "rule"),
    )
    picked = [r["feature"] for r in chosen.orderBy(F.col("p_value").asc_nulls_last(), "feature").collect()]
    entering = list(dict.fromkeys([*picked, *covs]))

    forest_params = params("", "selected_features", folds=s.folds, repeats=s.repeats, forest=s.forest, tune=s.tune_forest, sampling=s.sampling)
    begun = time.time()
    if not (_stored(run, "rf_training", forest_params) and run.exists("rf_scores")):
        grid = {"featureSubsetStrategy": [str(m) for m in I.tuning_grid(len(entering), distinct=True)]} if s.tune_forest else None
        table, scores = Z.repeated_importance(
            slice_arrays(train, names, entering), entering, KEY, s.folds, s.repeats, s.forest, grid, sampling=s.sampling, seed=s.seed, parallelism=s.parallelism
        )
        run.save(table, step="rf_training", description="importance per repeat and fold", params=forest_params, started=begun)
        run.save(scores, step="rf_scores", description="held-out scores of the same fits", params=forest_params)
    run.step(
        "rf_performance",
        params("", "rf_scores"),
        lambda: E.metric_summary(
            E.melt_metrics(
                E.confusion_metrics(E.confusion(run.load("rf_scores"), ["model", "repeat", "fold"])),
                ["model"],
                ["accuracy", "sensitivity", "specificity", "ppv"],
            )
        ),
    )

    def rank() -> DataFrame:
        ranked = I.rank_importance(I.importance_stats(run.load("rf_training")))
        if annotation is not None:
            ranked = I.name_features(ranked, annotation, "feature", "feature_name")
        return C.lookup(ranked, results, "feature", "feature", {"effect": "effect", "p_value": "p_value", "p_adjusted": "p_adjusted"})

    ranked = run.step("feature_importance", params("", "rf_training"), rank, "ranked, named, with association")

    def eliminate() -> DataFrame:
        order = ranked.where(~F.col("feature").isin(covs)) if covs else ranked
        top = [r["feature"] for r in Z.entering(order, s.entering).orderBy("rank").select("feature").collect()]
        if s.eliminate and len(top) > 2:
            kept, _ = Z.rfe_sizes(
                slice_arrays(train, names, top), top, KEY, min(s.kept, len(top)), 2, s.folds, s.forest, s.seed, s.parallelism
            )
        else:
            kept = top[: s.kept]
        return spark.createDataFrame(list(enumerate(kept)), "position int, feature string")

    kept = run.step("rfe_feature_selection", params("", "feature_importance", eliminate=s.eliminate, kept=s.kept, entering=s.entering), eliminate)
    final = [r["feature"] for r in kept.orderBy("position").collect()]
    return "rfe_feature_selection", list(dict.fromkeys([*final, *covs]))


def shared_rows(spark: SparkSession, root: str, outcome: str, matrix: DataFrame, pheno: DataFrame) -> DataFrame:
    """What all modes of an outcome start from, stored once: the matrix next to the phenotypes of the samples with an outcome."""
    run = Run(spark, root, f"{outcome}-shared")

    def align() -> DataFrame:
        C.require_overlap(matrix, pheno, KEY, "study")
        return matrix.select(KEY, "features").join(pheno.where(F.col(M.LABEL).isNotNull()), KEY)

    return run.step("aligned", {"outcome": outcome, "columns": sorted(pheno.columns)}, align, "matrix and phenotypes")


@dataclass
class Studies:
    """What became of each ``(outcome, mode)``: its run, or the error that stopped it."""

    runs: dict[tuple[str, str], Run]
    errors: dict[tuple[str, str], str]
    models: Sequence[str]

    def metrics(self) -> DataFrame | None:
        """The metrics of all models of the finished studies."""
        parts = [
            run.load(f"model_{model}").select(F.lit(outcome).alias("outcome"), F.lit(mode).alias("mode"), "*")
            for (outcome, mode), run in sorted(self.runs.items()) for model in self.models
        ]
        return reduce(DataFrame.unionByName, parts) if parts else None


def run_all_studies(
    spark: SparkSession,
    root: str,
    outcomes: dict[str, DataFrame],
    matrix: DataFrame,
    names: Sequence[str],
    modes: Sequence[str] = C.PRED_MODES,
    annotation: DataFrame | None = None,
    settings: Settings = Settings(),
    side_by_side: int = 3,
) -> Studies:
    """All outcomes in all modes, ``side_by_side`` at a time, each in a scheduler pool of its own.

    The modes of an outcome share its aligned rows, which are made once, by whichever mode comes first. A study that fails
    stops no other. All state is in the ledger: called again with the same settings, after an error or with a new driver,
    it goes on where each study was.
    """
    once = {outcome: threading.Lock() for outcome in outcomes}
    done = Studies({}, {}, settings.models)

    def study(outcome: str, mode: str) -> None:
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", f"{outcome}-{mode}")
        try:
            with once[outcome]:
                rows = shared_rows(spark, root, outcome, matrix, outcomes[outcome])
            done.runs[outcome, mode] = run_study(spark, root, outcome, rows.select(KEY, "features"), names, rows.drop("features"), annotation, mode, settings)
        except Exception as e:  # noqa: BLE001
            done.errors[outcome, mode] = str(e).split("\n")[0]
        finally:
            spark.sparkContext.setLocalProperty("spark.scheduler.pool", None)

    # one outcome's modes do not queue behind each other's shared step: outcomes alternate
    jobs = [(outcome, mode) for mode in modes for outcome in outcomes]
    M.run_all([lambda j=j: study(*j) for j in jobs], side_by_side)
    return done


def run_studies(
    spark: SparkSession,
    root: str,
    outcomes: dict[str, DataFrame],
    matrix: DataFrame,
    names: Sequence[str],
    modes: Sequence[str] = C.PRED_MODES,
    annotation: DataFrame | None = None,
    settings: Settings = Settings(),
    side_by_side: int = 3,
) -> DataFrame:
    """All outcomes in all modes; the metrics of all models in one table. If any study failed, an error after the last one."""
    done = run_all_studies(spark, root, outcomes, matrix, names, modes, annotation, settings, side_by_side)
    if done.errors:
        raise RuntimeError("; ".join(f"{outcome} {mode}: {e}" for (outcome, mode), e in sorted(done.errors.items())))
    return done.metrics()
