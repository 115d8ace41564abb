"""Train, tune, compare and apply classifiers with Spark ML.

A frame is a DataFrame with a sample key, an integer ``outcome`` and ``features ARRAY<DOUBLE>``. Fits over folds and
grids run from driver threads over one persisted frame; all their predictions are then scored by one grouped aggregate.
"""

from __future__ import annotations

import base64
import itertools
import math
import warnings
from collections.abc import Callable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pandas as pd
from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml import PipelineModel, Transformer
from pyspark.ml.classification import GBTClassifier, LinearSVC, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import ElementwiseProduct, StandardScaler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.param import Param, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

from phenoloom.operators import evaluation as E
from phenoloom.operators import linear as L
from phenoloom.operators import trees as T
from phenoloom.operators.ordered import hashed_rank
from phenoloom.operators.resampling import balanced_weight, class_counts, repeated_folds, rose, stratified_folds
from phenoloom.operators.shape import cells_from_arrays
from phenoloom.sources.tables import list_files
from phenoloom.session import materialise, ordered_slices

LABEL = "outcome"
SEED = 42
#: Depth Spark allows; stands for "no limit".
DEEPEST = 30


@dataclass(frozen=True)
class Recipe:
    """An estimator (none for our own) with its default parameters, whether classes are weighted, and its tuning grid."""

    estimator: type | None
    defaults: dict
    balanced: bool
    grid: dict = field(default_factory=dict)


# Default settings and tuning grids of each model type.
RECIPES: dict[str, Recipe] = {
    "random_forest": Recipe(
        RandomForestClassifier,
        {"numTrees": 500, "maxDepth": DEEPEST, "featureSubsetStrategy": "sqrt", "maxMemoryInMB": 1024},
        True,
        {
            "numTrees": [100, 300, 500],
            "maxDepth": [5, 10, 15, DEEPEST],
            "minInstancesPerNode": [1, 2, 4],
            "featureSubsetStrategy": ["sqrt", "log2", "0.6", "0.8"],
        },
    ),
    "logistic_regression": Recipe(
        LogisticRegression,
        {"maxIter": 1000, "standardization": False, "elasticNetParam": 0.0, "C": 1.0},
        True,
        {"C": [0.001, 0.01, 0.1, 1.0, 10.0, 100.0], "elasticNetParam": [0.0, 0.1, 0.5, 0.7, 0.9, 1.0]},
    ),
    "elastic_net": Recipe(LogisticRegression, {"maxIter": 200, "standardization": True, "elasticNetParam": 0.5, "regParam": 0.01}, False),
    "gradient_boosting": Recipe(
        GBTClassifier,
        {"maxIter": 100, "maxDepth": 3, "stepSize": 0.1},
        False,
        {"maxIter": [50, 100, 200], "stepSize": [0.01, 0.1, 0.2], "maxDepth": [3, 5, 7]},
    ),
    "xgboost": Recipe(
        None,
        {"maxIter": 300, "maxDepth": 6, "stepSize": 0.1},
        False,
        {
            "maxIter": [150, 300, 500],
            "maxDepth": [1, 3, 5, 7, 10],
            "stepSize": [0.03, 0.05, 0.1],
            "minSplitLoss": [0.0, 0.1, 0.5],
            "columnShare": [0.8, 1.0],
            "minChildWeight": [1.0, 3.0],
            "subsamplingRate": [0.6, 0.8, 1.0],
        },
    ),
    "svm": Recipe(
        LinearSVC,
        {"maxIter": 100, "C": 1.0, "gamma": "scale", "kernel": "rbf", "n_random": 256, "approximation": "landmarks"},
        True,
        {"C": [0.1, 1.0, 10.0], "gamma": ["scale", "auto", 0.001, 0.01], "kernel": ["rbf", "linear"]},
    ),
}
SAMPLING = (None, "none", "rose")


# --- kernel features -------------------------------------------------------------------------------------------------


class RandomFeatures(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Random Fourier features of the Gaussian kernel (Rahimi & Recht 2007): ``sqrt(2/D) cos(W x + b)``.

    W and b are drawn from the seed inside each task, so nothing large is shipped. Rows pass in Arrow batches.
    """

    def __init__(self, gamma: float = 1.0, size: int = 256, seed: int = SEED, source: str = "features") -> None:
        super().__init__()
        self.source = Param(self, "source", "vector column", TypeConverters.toString)
        self.gamma = Param(self, "gamma", "kernel width", TypeConverters.toFloat)
        self.size = Param(self, "size", "number of features", TypeConverters.toInt)
        self.seed = Param(self, "seed", "seed", TypeConverters.toInt)
        self._set(gamma=gamma, size=size, seed=seed, source=source)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        gamma, size, seed = (self.getOrDefault(p) for p in (self.gamma, self.size, self.seed))

        @F.pandas_udf(ArrayType(DoubleType()))
        def lift(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            w = b = None
            for x in batches:
                if not len(x):
                    yield pd.Series([], dtype=object)
                    continue
                m = np.stack(x.to_numpy())
                if w is None:
                    rng = np.random.default_rng(seed)
                    w = rng.normal(scale=math.sqrt(2.0 * gamma), size=(m.shape[1], size))
                    b = rng.uniform(0, 2 * math.pi, size)
                yield pd.Series(list(math.sqrt(2.0 / size) * np.cos(m @ w + b)))

        return dataset.withColumn("kernel_features", array_to_vector(lift(vector_to_array(self.getOrDefault(self.source)))))


#: Rows of the bounded sample that landmarks are drawn from, and of the one that the kernel's error is measured on.
LANDMARK_SAMPLE, ERROR_SAMPLE = 2000, 300


class LandmarkFeatures(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Nystroem features of the Gaussian kernel: kernels with landmark rows, whitened by the landmarks' own kernel.

    Inner products of the features are the kernel between landmarks, and its best approximation from them elsewhere.
    ``error`` holds the mean and the greatest difference from the kernel between rows that were not drawn from.
    """

    def __init__(self, landmarks: np.ndarray | None = None, gamma: float = 1.0, source: str = "features", error: Sequence[float] = (0.0, 0.0)) -> None:
        super().__init__()
        self.source = Param(self, "source", "vector column", TypeConverters.toString)
        self.gamma = Param(self, "gamma", "kernel width", TypeConverters.toFloat)
        self.landmarks = Param(self, "landmarks", "rows, as bytes of doubles", TypeConverters.toString)
        self.width = Param(self, "width", "features of a landmark", TypeConverters.toInt)
        self.error = Param(self, "error", "mean and greatest error of the kernel", TypeConverters.toListFloat)
        rows = np.zeros((0, 1)) if landmarks is None else np.ascontiguousarray(landmarks, float)
        self._set(gamma=gamma, source=source, landmarks=base64.b64encode(rows.tobytes()).decode(), width=rows.shape[1], error=[float(x) for x in error])

    def rows(self) -> np.ndarray:
        return np.frombuffer(base64.b64decode(self.getOrDefault(self.landmarks)), float).reshape(-1, self.getOrDefault(self.width))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        landmarks, gamma = self.rows(), self.getOrDefault(self.gamma)
        white = whitening(landmarks, gamma)

        @F.pandas_udf(ArrayType(DoubleType()))
        def lift(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            for x in batches:
                yield pd.Series(list(gaussian(np.stack(x.to_numpy()), landmarks, gamma) @ white) if len(x) else [], dtype=object)

        return dataset.withColumn("kernel_features", array_to_vector(lift(vector_to_array(self.getOrDefault(self.source)))))


def gaussian(a: np.ndarray, b: np.ndarray, gamma: float) -> np.ndarray:
    far = (a * a).sum(1)[:, None] + (b * b).sum(1)[None] - 2.0 * a @ b.T
    return np.exp(-gamma * np.maximum(far, 0.0))


def whitening(landmarks: np.ndarray, gamma: float) -> np.ndarray:
    """The inverse square root of the landmarks' kernel; directions that repeat others are left out."""
    values, vectors = np.linalg.eigh(gaussian(landmarks, landmarks, gamma))
    kept = values > 1e-10 * values.max()
    return vectors[:, kept] / np.sqrt(values[kept])


def draw_landmarks(data: DataFrame, column: str, gamma: float, size: int, seed: int, ridge: float = 1e-3) -> LandmarkFeatures:
    """Landmarks from a bounded sample by their ridge leverage: rows that others do not stand for are likelier.

    The sample holds distinct rows in the order of a hash, and another one like it measures the error.
    """
    values = vector_to_array(column)
    sample = data.select(values.alias("x")).distinct().orderBy(F.xxhash64("x", F.lit(seed)), "x").limit(max(size, LANDMARK_SAMPLE) + ERROR_SAMPLE)

    def draw(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = [r for batch in batches for r in batch["x"]]
        if not rows:
            return
        x = np.array([list(r) for r in rows], float)
        n = len(x) if len(x) <= size else max(size, len(x) - ERROR_SAMPLE)
        chosen, rest = x[:n], x[n:]
        if n > size:
            kernel = gaussian(chosen, chosen, gamma)
            leverage = np.maximum(1.0 - np.diag(np.linalg.inv(np.eye(n) + kernel / (ridge * n))), 1e-12)
            # the shortest of independent exponential races: draws without replacement in proportion to leverage
            race = np.random.default_rng(seed).exponential(size=n) / leverage
            chosen = chosen[np.sort(np.argsort(race)[:size])]
        mean, most = kernel_error(rest if len(rest) else x[:ERROR_SAMPLE], chosen, gamma)
        yield pd.DataFrame({"x": list(chosen), "mean": mean, "most": most})

    # one task on a sample of bounded size
    drawn = sample.coalesce(1).mapInPandas(draw, "x array<double>, mean double, most double").collect()
    if not drawn:
        raise ValueError("there are no rows to draw landmarks from")
    return LandmarkFeatures(np.array([r["x"] for r in drawn], float), gamma, column, (drawn[0]["mean"], drawn[0]["most"]))


def kernel_error(rows: np.ndarray, landmarks: np.ndarray, gamma: float) -> tuple[float, float]:
    lifted = gaussian(rows, landmarks, gamma) @ whitening(landmarks, gamma)
    off = np.abs(gaussian(rows, rows, gamma) - lifted @ lifted.T)
    return float(off.mean()), float(off.max())


def kernel_width(gamma, frame: DataFrame) -> float:
    """A number, ``auto`` = 1/d, or ``scale`` = 1/(d var of all cells)."""
    if isinstance(gamma, (int, float)):
        return float(gamma)
    d = F.max(F.size("features"))
    if gamma == "auto":
        return 1.0 / frame.agg(d.alias("d")).first()["d"]
    if gamma == "scale":
        row = frame.select(F.size("features").alias("d"), F.explode("features").alias("x")).agg(F.max("d").alias("d"), F.var_pop("x").alias("v")).first()
        return 1.0 / (row["d"] * row["v"]) if row["v"] else 1.0
    raise ValueError(f"invalid gamma {gamma!r}")


#: Rows per task worth having in an iterative fit; below it the tasks cost more than they do.
ROWS_PER_TASK = 20_000


def compact(frame: DataFrame, rows: int) -> DataFrame:
    """No more partitions than the rows are worth. Never adds any, so a large frame keeps its own.

    The frame should be stored or cached, or be made without sorts: a task that merges partitions makes them one after
    the other and keeps the memory of their sorts until it ends.
    """
    return frame.coalesce(max(1, math.ceil(rows / ROWS_PER_TASK)))


def compact_stored(frame: DataFrame, rows: int) -> DataFrame:
    """As above, for frames made by shuffles: if their partitions are to be merged, they are stored first, each by a task of its own."""
    if math.ceil(rows / ROWS_PER_TASK) < ordered_slices(frame.sparkSession):
        return compact(materialise(frame), rows)
    return frame


# --- one fit ---------------------------------------------------------------------------------------------------------


def recipe(model: str) -> Recipe:
    if model not in RECIPES:
        raise ValueError(f"unknown model type {model!r}; known: {sorted(RECIPES)}")
    return RECIPES[model]


def _estimator(model: str, params: dict, rows: int, weighted: bool, seed: int):
    spec = recipe(model)
    settings = spec.defaults | params
    c = settings.pop("C", None)
    if c is not None:
        # the penalty is on the sum of losses there and on their mean here; balanced weights sum to the row count
        settings["regParam"] = 1.0 / (c * rows)
    known = spec.estimator().params
    names = {p.name for p in known}
    if "seed" in names:
        settings["seed"] = seed
    if weighted:
        settings["weightCol"] = "weight"
    return spec.estimator(featuresCol="features", labelCol=LABEL, **settings)


def fit(
    train: DataFrame,
    model: str,
    params: dict | None = None,
    seed: int = SEED,
    scale: bool = False,
    counts: dict | None = None,
    keep: bool = False,
) -> PipelineModel:
    """Fit one model on a frame. The result adds ``prediction`` and ``probability`` to any frame with vector features.

    ``keep`` holds the frame for the duration of the fit: for frames that are costly to derive (resampled, with shadow
    features), as a fit reads its input several times.
    """
    if keep:
        train = train.persist(StorageLevel.MEMORY_AND_DISK)
        # a task for each partition, before the fit merges them
        train.count()
    try:
        return _fit(train, model, dict(params or {}), seed, scale, counts or class_counts(train, LABEL))
    finally:
        if keep:
            train.unpersist()


def _fit(train: DataFrame, model: str, params: dict, seed: int, scale: bool, counts: dict) -> PipelineModel:
    if len(counts) < 2:
        raise ValueError("the outcome needs at least two classes")
    rows, spec = sum(counts.values()), recipe(model)
    data = compact(train, rows)
    if spec.balanced:
        data = data.withColumn("weight", balanced_weight(F.col(LABEL), counts))
    data = data.withColumn("features", array_to_vector(F.col("features")))
    before, column = [], "features"
    if scale:
        scaler = StandardScaler(inputCol="features", outputCol="scaled", withMean=True, withStd=True).fit(data)
        # sample to population standard deviation
        factor = math.sqrt(rows / max(rows - 1, 1))
        stretch = ElementwiseProduct(
            scalingVec=Vectors.dense([factor] * len(scaler.mean)), inputCol="scaled", outputCol="scaled_features"
        )
        before, column = [scaler, stretch], "scaled_features"
        data = stretch.transform(scaler.transform(data))
    if model == "svm":
        return _fit_svm(data, before, column, spec.defaults | params, rows, seed)
    if model == "xgboost":
        return PipelineModel([*before, _boosted(data, column, spec.defaults | params, seed)])
    est = _estimator(model, params, rows, spec.balanced, seed).setFeaturesCol(column)
    return PipelineModel([*before, est.fit(data)])


#: Settings of second-order boosting and the names of its arguments.
BOOSTING = {
    "maxIter": "rounds", "maxDepth": "depth", "stepSize": "rate", "regLambda": "l2", "minSplitLoss": "least_gain", "minChildWeight": "least_child_weight",
    "columnShare": "column_share", "subsamplingRate": "row_share", "maxBins": "bins",
}


def _boosted(data: DataFrame, column: str, params: dict, seed: int) -> T.TreeModel:
    if unknown := set(params) - set(BOOSTING):
        raise ValueError(f"unknown settings {sorted(unknown)}; known: {sorted(BOOSTING)}")
    rows = data.select(vector_to_array(column).alias("features"), LABEL)
    trees = T.boost(rows, LABEL, seed=seed, **{BOOSTING[k]: v for k, v in params.items()})
    width = rows.select(F.size("features").alias("n")).first()["n"]
    return T.TreeModel(trees, True, width, column)


def _fit_svm(data: DataFrame, before: list, column: str, p: dict, rows: int, seed: int) -> PipelineModel:
    """Linear or kernel machine, with probabilities by a logistic fit on margins of rows not used for the margin."""
    stages = list(before)
    if p["kernel"] == "rbf":
        gamma = kernel_width(p["gamma"], data.select(vector_to_array(column).alias("features")))
        if p["approximation"] not in ("landmarks", "random"):
            raise ValueError(f"invalid approximation {p['approximation']!r}")
        lift = RandomFeatures(gamma, p["n_random"], seed, column) if p["approximation"] == "random" else draw_landmarks(data, column, gamma, p["n_random"], seed)
        stages.append(lift)
        data, column = lift.transform(data), "kernel_features"
    elif p["kernel"] != "linear":
        raise ValueError(f"invalid kernel {p['kernel']!r}")
    svc = LinearSVC(
        featuresCol=column, labelCol=LABEL, weightCol="weight", maxIter=p["maxIter"], regParam=1.0 / (p["C"] * rows),
        rawPredictionCol="margin", predictionCol="margin_side",
        # the kernel's own norm is the penalty; it would change if its features were scaled
        standardization=p["kernel"] == "linear",
    )
    data = data.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        part = F.pmod(F.xxhash64(vector_to_array("features"), F.lit(seed)), F.lit(3))
        held = []
        for k in range(3):
            m = svc.fit(data.where(part != k))
            held.append(m.transform(data.where(part == k)).select(LABEL, "margin", "weight"))
        margins = reduce(DataFrame.unionByName, held)
        platt = LogisticRegression(featuresCol="margin", labelCol=LABEL, maxIter=100, regParam=1e-6).fit(margins)
        return PipelineModel([*stages, svc.fit(data), platt])
    finally:
        data.unpersist()


def predict(model: PipelineModel, frame: DataFrame, keep: Sequence[str]) -> DataFrame:
    """Hard and soft predictions. Stateless, so it works on a streaming frame as well."""
    scored = model.transform(frame.withColumn("features", array_to_vector(F.col("features"))))
    return scored.select(*keep, F.col("prediction").cast("int").alias("prediction"), vector_to_array("probability")[1].alias("score"))


def feature_weights(model: PipelineModel, names: Sequence[str]) -> list[tuple[str, float]]:
    """Impurity importances of a tree model or squared coefficients of a linear one."""
    last = model.stages[-1]
    if hasattr(last, "featureImportances"):
        values = last.featureImportances.toArray()
    else:
        values = np.square(last.coefficients.toArray())
    return [(n, float(v)) for n, v in zip(names, values)]


# --- resampled fits --------------------------------------------------------------------------------------------------


def run_all(jobs: Sequence[Callable], parallelism: int) -> list:
    """Call the jobs from driver threads; Spark runs their tasks side by side."""
    if parallelism <= 1 or len(jobs) <= 1:
        return [j() for j in jobs]
    with ThreadPoolExecutor(parallelism) as pool:
        carry = inheritable_thread_target(SparkSession.getActiveSession())
        return [f.result() for f in [pool.submit(carry(j)) for j in jobs]]


def with_folds(frame: DataFrame, key: str, k: int, repeats: int, seed: int) -> DataFrame:
    """Add ``folds``, a map from repeat to fold: the wide rows are not copied per repeat. Keys must not come twice.

    With one repeat the rows themselves are ranked, and nothing is joined to them.
    """
    rows = frame.count()
    if repeats == 1:
        ranked = hashed_rank(frame, F.col(key), f"{seed}:1", [LABEL], out="_rank", unique=True).where(F.col(key).isNotNull())
        fold = F.pmod(F.col("_rank") - 1, F.lit(k)).cast("int")
        others = [c for c in frame.columns if c != key]
        return compact_stored(ranked.select(key, *others, F.create_map(F.lit(1), fold).alias("folds")), rows)
    folds = repeated_folds(frame.select(key, LABEL), key, LABEL, k, repeats, seed)
    per = folds.groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct("repeat", "fold"))).alias("folds"))
    return compact_stored(frame.join(per, key), rows)


def fold_counts(frame: DataFrame) -> dict:
    """Class counts of every fold: what weights of any training part need, in one aggregate."""
    rows = frame.select(LABEL, F.explode("folds").alias("repeat", "fold")).groupBy("repeat", "fold", LABEL).count().collect()
    return {(r["repeat"], r["fold"], r[LABEL]): r["count"] for r in rows}


def _training_counts(counts: dict, repeat: int, fold: int) -> dict:
    out: dict = {}
    for (r, f, y), n in counts.items():
        if r == repeat and f != fold:
            out[y] = out.get(y, 0) + n
    return out


def _resampled(train: DataFrame, names: Sequence[str], key: str, sampling: str | None, seed) -> DataFrame:
    if sampling not in SAMPLING:
        raise ValueError(f"unsupported sampling {sampling!r}")
    return rose(train, names, key, LABEL, seed=seed) if sampling == "rose" else train


#: Settings of logistic fits that the stacked fits know; with them a fit is run to its optimum.
STACKED = {"C", "regParam", "elasticNetParam", "maxIter", "tol", "standardization"}


def stacked(model: str, settings: Sequence[dict], scale: bool) -> bool:
    """Whether these are logistic fits that differ in penalty and mixing alone."""
    if model not in ("logistic_regression", "elastic_net"):
        return False
    full = [recipe(model).defaults | s for s in settings]
    return all(set(s) <= STACKED for s in full) and len({s["standardization"] for s in full}) == 1 and not (scale and full[0]["standardization"])


def _stacked_scores(folded: DataFrame, key: str, model: str, settings: Sequence[dict], k: int, repeats: int, scale: bool) -> tuple[DataFrame, dict]:
    spec = recipe(model)
    groups = [L.Group(r, f) for r in range(1, repeats + 1) for f in range(k)]
    errors, given = {}, {}
    counts = fold_counts(folded)
    rows = {g: sum(_training_counts(counts, g.repeat, g.fold).values()) for g in groups}
    models: dict = {}
    how = "population" if scale else "sample" if (spec.defaults | dict(settings[0]))["standardization"] else "none"
    for i, s in enumerate(settings):
        full = spec.defaults | s
        try:
            mixing, bad = float(full["elasticNetParam"]), [n for n in ("C", "regParam") if full.get(n) is not None and (full[n] < 0 or n == "C" and full[n] == 0)]
            if not 0 <= mixing <= 1 or bad:
                raise ValueError(f"invalid setting {s}")
            given[i] = mixing, full
        except (TypeError, ValueError) as e:
            errors[i] = str(e)
    # penalties that depend on the rows of a fold differ by group: fits of one size go together
    for n in sorted(set(rows.values())):
        own = [g for g in groups if rows[g] == n]
        fits = [L.Setting(mixing, 1.0 / (full["C"] * n) if full.get("C") is not None else float(full.get("regParam", 0.0))) for mixing, full in given.values()]
        if fits:
            found = L.fit_many(folded, fits, own, how, spec.balanced, LABEL)
            models |= {(list(given)[i], groups.index(own[g])): f for (i, g), f in found.items()}
    if not models:
        raise ValueError(f"no setting of {model!r} could be fitted: {errors}")
    return L.scores_of(folded, key, models, groups, LABEL), errors


def cross_scores(
    folded: DataFrame,
    names: Sequence[str],
    key: str,
    model: str,
    settings: Sequence[dict],
    k: int,
    repeats: int,
    sampling: str | None = None,
    seed: int = SEED,
    scale: bool = False,
    parallelism: int = 4,
) -> tuple[DataFrame, dict]:
    """Out-of-fold scores ``(setting, repeat, fold, key, actual, prediction, score)`` for every setting, and errors.

    Resampling touches the training part only. A setting the estimator refuses is reported, not fatal. Logistic fits
    without resampling all advance together, see ``linear``; other fits are jobs of their own.
    """
    if sampling in (None, "none") and stacked(model, settings, scale):
        return _stacked_scores(folded, key, model, settings, k, repeats, scale)
    counts = fold_counts(folded)
    errors: dict = {}

    def job(i: int, repeat: int, fold: int):
        def run():
            where = F.col("folds")[repeat] == fold
            train = folded.where(~where)
            try:
                used = None
                if sampling == "rose":
                    train = _resampled(train, names, key, sampling, f"{seed}:{repeat}:{fold}")
                else:
                    _resampled(train, names, key, sampling, seed)
                    used = _training_counts(counts, repeat, fold)
                fitted = fit(train, model, settings[i], seed, scale, used, keep=sampling == "rose")
            except Exception as e:  # noqa: BLE001
                errors[i] = str(e).split("\n")[0]
                return None
            tested = predict(fitted, folded.where(where), [key, LABEL])
            return tested.select(
                F.lit(i).alias("setting"), F.lit(repeat).alias("repeat"), F.lit(fold).alias("fold"), key, F.col(LABEL).alias("actual"), "prediction", "score"
            )

        return run

    jobs = [job(i, r, f) for i in range(len(settings)) for r in range(1, repeats + 1) for f in range(k)]
    parts = [p for p in run_all(jobs, parallelism) if p is not None]
    if not parts:
        raise ValueError(f"no setting of {model!r} could be fitted: {errors}")
    return reduce(DataFrame.unionByName, parts), errors


def cross_validate(
    frame: DataFrame,
    names: Sequence[str],
    key: str,
    model: str,
    params: dict | None = None,
    k: int = 10,
    repeats: int = 1,
    sampling: str | None = None,
    seed: int = SEED,
    scale: bool = False,
    parallelism: int = 4,
) -> DataFrame:
    """Out-of-fold scores of one model, materialised: ``(repeat, fold, key, actual, prediction, score)``."""
    folded = with_folds(frame, key, k, repeats, seed).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        scores, _ = cross_scores(folded, names, key, model, [params or {}], k, repeats, sampling, seed, scale, parallelism)
        return materialise(scores.drop("setting"))
    finally:
        folded.unpersist()


def cv_auc(scores: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Mean and population standard deviation of the per-fold AUC, with the fold values."""
    per = E.auc(scores, [*by, "repeat", "fold"])
    return per.groupBy(*by).agg(
        F.avg("auc").alias("auc_mean"),
        F.stddev_pop("auc").alias("auc_std"),
        F.transform(F.array_sort(F.collect_list(F.struct("repeat", "fold", "auc"))), lambda x: x["auc"]).alias("auc_scores"),
    )


# --- tuning ----------------------------------------------------------------------------------------------------------


def expand_grid(df: DataFrame, grid: dict[str, Sequence]) -> DataFrame:
    """Every combination of the grid next to every row of a small table (fits to run), without a join."""
    for name, values in grid.items():
        df = df.withColumn(name, F.explode(F.array(*[F.lit(v) for v in values])))
    return df


def combinations(grid: dict[str, Sequence]) -> list[dict]:
    return [dict(zip(grid, v)) for v in itertools.product(*grid.values())]


def elastic_net_grid(frame: DataFrame, names: Sequence[str], length: int = 80, alphas: Sequence[float] | None = None) -> list[dict]:
    """Mixing values from 0.1 to 1 and, for each, penalties from the one that empties the model down, log-spaced.

    The largest inner product of a standardised feature with the centred outcome comes from one aggregate.
    """
    y = F.col(LABEL).cast("double")
    per = cells_from_arrays(frame, names, [LABEL]).groupBy("feature").agg(
        F.abs(F.covar_pop("value", y)).alias("c"), F.stddev_pop("value").alias("s"), F.count("*").alias("n")
    )
    row = per.agg(F.max(F.when(F.col("s") > 0, F.col("c") / F.col("s"))).alias("top"), F.max("n").alias("n")).first()
    floor = 1e-4 if row["n"] > len(names) else 1e-2
    alphas = list(alphas) if alphas is not None else [float(a) for a in np.linspace(0.1, 1.0, length)]
    return [
        {"elasticNetParam": a, "regParam": float(v)}
        for a in alphas
        for v in np.geomspace(row["top"] / a, row["top"] / a * floor, length)
    ]


def grid_search(
    frame: DataFrame,
    names: Sequence[str],
    key: str,
    model: str,
    grid: dict[str, Sequence] | Sequence[dict] | None = None,
    k: int = 5,
    repeats: int = 1,
    metric: str = "auc",
    sampling: str | None = None,
    seed: int = SEED,
    scale: bool = False,
    parallelism: int = 4,
    batch: int = 16,
    base: dict | None = None,
) -> tuple[dict, list[dict]]:
    """Cross-validate every combination; return the best parameters and one record per combination.

    ``base`` holds parameters common to all of them.
    Folds are shared by all combinations. Predictions of a batch of combinations are scored by one grouped aggregate.
    """
    if metric not in ("auc", "accuracy"):
        raise ValueError(f"invalid metric {metric!r}")
    settings = combinations(recipe(model).grid if grid is None else grid) if grid is None or isinstance(grid, dict) else list(grid)
    folded = with_folds(frame, key, k, repeats, seed).persist(StorageLevel.MEMORY_AND_DISK)
    records: list[dict] = []
    try:
        for start in range(0, len(settings), batch):
            some = settings[start : start + batch]
            full = [(base or {}) | x for x in some]
            scores, errors = cross_scores(folded, names, key, model, full, k, repeats, sampling, seed, scale, parallelism)
            by = ["setting", "repeat", "fold"]
            table = E.auc(scores, by) if metric == "auc" else E.accuracy(scores, by)
            means = {
                r["setting"]: (r["m"], r["s"])
                for r in table.groupBy("setting").agg(F.avg(metric).alias("m"), F.stddev_pop(metric).alias("s")).collect()
            }
            for i, params in enumerate(some):
                m, s = means.get(i, (None, None))
                records.append({"params": params, "mean": None if i in errors else m, "sd": s, "error": errors.get(i)})
    finally:
        folded.unpersist()
    scored = [r for r in records if r["mean"] is not None]
    if not scored:
        raise ValueError(f"no setting of {model!r} could be scored: {[(r['params'], r['error']) for r in records]}")
    best = max(scored, key=lambda r: r["mean"])
    return best["params"], records


# --- training ---------------------------------------------------------------------------------------------------------


@dataclass
class Trained:
    """A fitted model apart from its evaluation: ``metrics(model, split, metric, value)`` and its parameters."""

    model_type: str
    model: PipelineModel
    features: list[str]
    params: dict
    metrics: DataFrame
    tuning: list[dict] = field(default_factory=list)


def evaluate_split(fitted: PipelineModel, frame: DataFrame, key: str, model: str, split: str) -> list[tuple]:
    """Accuracy, AUC and confusion metrics of one split as metric rows."""
    # counts and areas need no keys
    scores = materialise(predict(fitted, frame, [LABEL]).withColumnRenamed(LABEL, "actual"))
    cm = E.confusion_metrics(E.confusion(scores)).first().asDict()
    areas = E.areas(scores).first().asDict()
    values = cm | {n: areas[n] for n in ("auc", "average_precision")}
    return [(model, split, m, None if v is None else float(v)) for m, v in values.items()]


METRIC_SCHEMA = "model string, split string, metric string, value double"


def train_model(
    train: DataFrame,
    names: Sequence[str],
    key: str = "sample_id",
    val: DataFrame | None = None,
    model: str = "random_forest",
    params: dict | None = None,
    tune: bool = False,
    grid=None,
    k: int = 10,
    repeats: int = 1,
    metric: str = "auc",
    scale: bool = False,
    sampling: str | None = None,
    seed: int = SEED,
    parallelism: int = 4,
) -> Trained:
    """Fit (after tuning, if asked), cross-validate, and evaluate on the training and the validation frame."""
    spark = train.sparkSession
    params, tuning = dict(params or {}), []
    train = train.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        counts = class_counts(train, LABEL)
        if len(counts) < 2:
            raise ValueError("the outcome needs at least two classes")
        if tune:
            best, tuning = grid_search(train, names, key, model, grid, k, repeats, metric, sampling, seed, scale, parallelism, base=params)
            params |= best
        used = _resampled(train, names, key, sampling, seed)
        fitted = fit(used, model, params, seed, scale, None if sampling == "rose" else counts, keep=sampling == "rose")
        rows = evaluate_split(fitted, train, key, model, "train")
        scores = cross_validate(train, names, key, model, params, k, repeats, sampling, seed, scale, parallelism)
        cv = cv_auc(scores).first()
        rows += [(model, "cv", "auc_mean", cv["auc_mean"]), (model, "cv", "auc_std", cv["auc_std"])]
        rows += [(model, "cv", f"auc_{i}", v) for i, v in enumerate(cv["auc_scores"])]
        if val is not None:
            rows += evaluate_split(fitted, val, key, model, "val")
        return Trained(model, fitted, list(names), params, spark.createDataFrame(rows, METRIC_SCHEMA), tuning)
    finally:
        train.unpersist()


# Models compared by default.
COMPARED = ("random_forest", "logistic_regression", "gradient_boosting")


class ModelSet:
    """Models trained on one study: train, compare, predict with the latest or a named one."""

    def __init__(self, key: str = "sample_id", seed: int = SEED, parallelism: int = 4) -> None:
        self.key, self.seed, self.parallelism = key, seed, parallelism
        self.models: dict[str, Trained] = {}

    def train(self, train: DataFrame, names: Sequence[str], model: str = "random_forest", **options) -> Trained:
        options = {"seed": self.seed, "parallelism": self.parallelism} | options
        done = train_model(train, names, self.key, model=model, **options)
        self.models.pop(model, None)
        self.models[model] = done
        return done

    def compare(
        self, train: DataFrame, names: Sequence[str], models: Sequence[str] = COMPARED, params: dict[str, dict] | None = None, **options
    ) -> DataFrame:
        """Metric rows of all models, untuned; a model that fails leaves one row naming its error."""
        spark, tables = train.sparkSession, []
        for m in models:
            try:
                tables.append(self.train(train, names, m, params=(params or {}).get(m), **options).metrics.withColumn("error", F.lit(None).cast("string")))
            except Exception as e:  # noqa: BLE001
                warnings.warn(f"{m} failed: {e}")
                row = [(m, None, None, None, str(e).split("\n")[0])]
                tables.append(spark.createDataFrame(row, METRIC_SCHEMA + ", error string"))
        return reduce(DataFrame.unionByName, tables)

    def best(self, split: str = "cv", metric: str = "auc_mean") -> str:
        """The model of the highest value; the one trained first wins ties."""
        values = {m: t.metrics.where((F.col("split") == split) & (F.col("metric") == metric)).first() for m, t in self.models.items()}
        return max((m for m in values if values[m] is not None), key=lambda m: values[m]["value"])

    def predict(self, frame: DataFrame, model: str | None = None, probabilities: bool = True) -> DataFrame:
        if not self.models:
            raise ValueError("no model has been trained")
        name = model or list(self.models)[-1]
        if name not in self.models:
            raise ValueError(f"model {name!r} not found; trained: {list(self.models)}")
        out = predict(self.models[name].model, frame, [c for c in (self.key, LABEL) if c in frame.columns])
        return out if probabilities else out.drop("score")


def save_model(trained: Trained, path: str) -> None:
    """The model, its feature names in order, and its metrics, each on its own under ``path``."""
    trained.model.write().overwrite().save(f"{path}/model")
    spark = trained.metrics.sparkSession
    names = [(i, n) for i, n in enumerate(trained.features)]
    spark.createDataFrame(names, "position int, feature string").withColumn("model", F.lit(trained.model_type)).withColumn(
        "params", F.lit(str(sorted(trained.params.items())))
    ).coalesce(1).write.mode("overwrite").parquet(f"{path}/features")
    trained.metrics.write.mode("overwrite").parquet(f"{path}/metrics")


def features_of_model(spark: SparkSession, path: str) -> list[str]:
    return [r["feature"] for r in spark.read.parquet(f"{path}/features").orderBy("position").select("feature").collect()]


def load_model(spark: SparkSession, path: str) -> Trained:
    head = spark.read.parquet(f"{path}/features").first()
    return Trained(head["model"], PipelineModel.load(f"{path}/model"), features_of_model(spark, path), {}, spark.read.parquet(f"{path}/metrics"))


def stored_models(spark: SparkSession, path: str) -> DataFrame:
    """``folder, model, modified`` of every model saved below ``path``, from a listing of files: no model is read.

    A model is complete once its feature names are written, which ``save_model`` does after the model itself.
    """
    files = list_files(spark, path, "*.parquet")
    kept = files.where(F.col("path").rlike("/features/[^/]+$"))
    folder = F.regexp_replace("path", "/features/[^/]+$", "")
    out = kept.groupBy(folder.alias("folder")).agg(F.max("modified").alias("modified"))
    return out.select("folder", F.substring_index("folder", "/", -1).alias("model"), "modified")


def locate_model(spark: SparkSession, path: str, inside: str = "", newest: bool = False) -> str:
    """The first model below ``path`` in the order of its folder's name, or the newest; ``inside`` must be one of its folders."""
    found = stored_models(spark, path)
    if inside:
        found = found.where(F.concat(F.lit("/"), "folder", F.lit("/")).contains(f"/{inside}/"))
    row = found.orderBy(F.desc("modified") if newest else F.col("folder"), "folder").first()
    if row is None:
        raise FileNotFoundError(f"no model below {path!r}" + (f" in {inside!r}" if inside else ""))
    return row["folder"]


# --- out-of-bag ------------------------------------------------------------------------------------------------------


def oob_forest(frame: DataFrame, key: str, params: dict | None = None, weighted: bool = True, seed: int = SEED) -> tuple[T.Trees, DataFrame]:
    """A forest and its own out-of-bag scores: the trees that are returned are the trees that score.

    Settings are those of ``trees.bagged_forest``; classes are weighted to balance unless ``weighted`` is off.
    """
    data = frame.withColumn("_weight", balanced_weight(F.col(LABEL), class_counts(frame, LABEL))) if weighted else frame.withColumn("_weight", F.lit(1.0))
    data = compact(data, frame.count()).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        forest = T.bagged_forest(data, key, LABEL, weight="_weight", seed=seed, **(params or {}))
        return forest, T.out_of_bag(data, key, forest, LABEL, seed=seed)
    finally:
        data.unpersist()


def oob_scores(frame: DataFrame, key: str, bags: int = 50, params: dict | None = None, seed: int = SEED) -> DataFrame:
    """Out-of-bag scores of a forest of ``bags`` trees: ``key, actual, score, n_trees, prediction``; rows in all bags have none."""
    renamed = {{"maxDepth": "depth", "minInstancesPerNode": "least_leaf_rows", "featureSubsetStrategy": "columns"}.get(k, k): v for k, v in (params or {}).items()}
    return oob_forest(frame, key, {"depth": 10} | renamed | {"trees": bags}, seed=seed)[1].where("n_trees > 0")


def hold_out(frame: DataFrame, key: str, fraction: float = 0.1, seed: int = SEED) -> tuple[DataFrame, DataFrame]:
    from phenoloom.operators.resampling import holdout_split

    split = holdout_split(frame, key, LABEL, fraction, seed)
    return split.where("split = 'train'").drop("split"), split.where("split = 'val'").drop("split")


def fold_frame(frame: DataFrame, key: str, k: int, seed: int = SEED) -> DataFrame:
    return stratified_folds(frame, key, LABEL, k, seed)
