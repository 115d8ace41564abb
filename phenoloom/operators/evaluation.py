"""Evaluation of scored samples: ``(by..., actual 0/1, score, prediction)``.

Curves first collapse the scores to distinct values, then accumulate them in ordered slices, so that neither a large
score table nor a heavily tied score meets in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from phenoloom.operators.ordered import SLICE, accumulate, slice_by_order
from phenoloom.session import materialise

# Thresholds of the sweep, i/10 for i in 0..10.
SWEEP = [i * 0.1 for i in range(11)]
DEFAULT_THRESHOLD = 0.5


def ratio(num: Column, den: Column, default=0.0) -> Column:
    """Division with a value for a zero denominator."""
    return F.when(den != 0, num / den).otherwise(F.lit(default).cast("double"))


# --- counts ----------------------------------------------------------------------------------------------------------


def confusion(scores: DataFrame, by: Sequence[str] = (), actual: str = "actual", prediction: str = "prediction") -> DataFrame:
    a, p = F.col(actual), F.col(prediction)
    return scores.groupBy(*by).agg(
        F.count_if((a == 1) & (p == 1)).alias("tp"),
        F.count_if((a == 0) & (p == 1)).alias("fp"),
        F.count_if((a == 0) & (p == 0)).alias("tn"),
        F.count_if((a == 1) & (p == 0)).alias("fn"),
    )


def confusion_metrics(counts: DataFrame) -> DataFrame:
    """Sensitivity, specificity, predictive value, accuracies from the four counts; undefined ratios are NULL."""
    tp, fp, tn, fn = (F.col(c) for c in ("tp", "fp", "tn", "fn"))
    sens, spec = ratio(tp, tp + fn, None), ratio(tn, tn + fp, None)
    return counts.select(
        "*",
        sens.alias("sensitivity"),
        spec.alias("specificity"),
        ratio(tp, tp + fp, None).alias("ppv"),
        ((sens + spec) / 2.0).alias("balanced_accuracy"),
        ratio(tp + tn, tp + fp + tn + fn, None).alias("accuracy"),
    )


def accuracy(scores: DataFrame, by: Sequence[str] = (), actual: str = "actual", prediction: str = "prediction") -> DataFrame:
    return scores.groupBy(*by).agg(F.avg((F.col(actual) == F.col(prediction)).cast("double")).alias("accuracy"))


def _per_class(scores: DataFrame, by: Sequence[str], actual: str, prediction: str) -> DataFrame:
    """True positives, predicted and actual counts of every class of every group."""
    pairs = scores.groupBy(*by, F.col(actual).alias("_a"), F.col(prediction).alias("_p")).agg(F.count("*").alias("_n"))
    same = F.col("_a") == F.col("_p")
    roles = F.array(
        F.struct(F.col("_a").alias("label"), F.when(same, F.col("_n")).otherwise(0).alias("tp"), F.lit(0).alias("pred"), F.col("_n").alias("support")),
        F.struct(F.col("_p").alias("label"), F.lit(0).alias("tp"), F.col("_n").alias("pred"), F.lit(0).alias("support")),
    )
    rows = pairs.select(*by, F.explode(roles).alias("r")).select(*by, "r.*")
    sums = rows.groupBy(*by, "label").agg(*[F.sum(c).alias(c) for c in ("tp", "pred", "support")])
    precision, recall = ratio(F.col("tp"), F.col("pred")), ratio(F.col("tp"), F.col("support"))
    return sums.select(
        *by,
        F.col("label").cast("string").alias("label"),
        precision.alias("precision"),
        recall.alias("recall"),
        ratio(2.0 * precision * recall, precision + recall).alias("f1"),
        "support",
        "tp",
    )


def class_report(scores: DataFrame, by: Sequence[str] = (), actual: str = "actual", prediction: str = "prediction") -> DataFrame:
    """Precision, recall, F1 and support per class, with the macro and the support-weighted average."""
    # a handful of rows per group, read twice below
    per = materialise(_per_class(scores, by, actual, prediction))
    names = ["precision", "recall", "f1"]
    macro = per.groupBy(*by).agg(*[F.avg(c).alias(c) for c in names], F.sum("support").alias("support"))
    weighted = per.groupBy(*by).agg(
        *[(F.sum(F.col(c) * F.col("support")) / F.sum("support")).alias(c) for c in names], F.sum("support").alias("support")
    )
    cols = [*by, "label", *names, "support"]
    return (
        per.select(*cols)
        .unionByName(macro.withColumn("label", F.lit("macro avg")).select(*cols))
        .unionByName(weighted.withColumn("label", F.lit("weighted avg")).select(*cols))
    )


def weighted_scores(scores: DataFrame, by: Sequence[str] = (), actual: str = "actual", prediction: str = "prediction") -> DataFrame:
    """Accuracy and support-weighted precision, recall and F1, one row per group."""
    per = _per_class(scores, by, actual, prediction)
    total = F.sum("support")
    return per.groupBy(*by).agg(
        (F.sum("tp") / total).alias("accuracy"),
        *[(F.sum(F.col(c) * F.col("support")) / total).alias(f"weighted_{c}") for c in ("precision", "recall", "f1")],
    )


# --- curves ----------------------------------------------------------------------------------------------------------


def score_counts(scores: DataFrame, by: Sequence[str] = (), score: str = "score", actual: str = "actual") -> DataFrame:
    """Positives and negatives per distinct score. Ties collapse here, on the map side first."""
    rows = scores.where(F.col(score).isNotNull() & F.col(actual).isNotNull())
    return rows.groupBy(*by, F.col(score).cast("double").alias("score")).agg(
        F.count_if(F.col(actual) == 1).alias("pos"), F.count_if(F.col(actual) == 0).alias("neg")
    )


def _cumulated(scores: DataFrame, by: Sequence[str], score: str, actual: str) -> DataFrame:
    """Cumulative true and false positives from the highest score down, next to those of the whole group."""
    by = list(by)
    order = [F.col("score").desc()]
    sliced = slice_by_order(score_counts(scores, by, score, actual), order, by)
    up = accumulate(sliced, order, {"tp": ("sum", F.col("pos")), "fp": ("sum", F.col("neg"))}, by)
    totals = sliced.groupBy(*by).agg(F.sum("pos").alias("n_pos"), F.sum("neg").alias("n_neg"))
    if by:
        return up.join(totals, by)
    return up.withColumns({"n_pos": totals.select("n_pos").scalar(), "n_neg": totals.select("n_neg").scalar()})


def curve(scores: DataFrame, by: Sequence[str] = (), score: str = "score", actual: str = "actual") -> DataFrame:
    """Cumulative true and false positives from the highest score down, with the next lower score."""
    up, order = _cumulated(scores, by, score, actual), [F.col("score").desc()]
    full = accumulate(up, order, {"next_score": ("max", F.col("score"))}, list(by), backward=True, exclusive=True)
    return full.drop(SLICE)


def roc_points(scores: DataFrame, by: Sequence[str] = (), score: str = "score", actual: str = "actual") -> DataFrame:
    c = _cumulated(scores, by, score, actual)
    return c.select(*by, "score", (F.col("fp") / F.col("n_neg")).alias("fpr"), (F.col("tp") / F.col("n_pos")).alias("tpr"))


def auc(scores: DataFrame, by: Sequence[str] = (), score: str = "score", actual: str = "actual") -> DataFrame:
    """Area under the ROC curve as the tie-aware rank sum. NULL for a group with one class."""
    by = list(by)
    order = [F.col("score")]
    sliced = slice_by_order(score_counts(scores, by, score, actual), order, by)
    ran = accumulate(sliced, order, {"below": ("sum", F.col("neg"))}, by, exclusive=True)
    won = F.sum(F.col("pos") * (F.col("below") + F.col("neg") / 2.0))
    return ran.groupBy(*by).agg(ratio(won, F.sum("pos").cast("double") * F.sum("neg"), None).alias("auc"))


def average_ranks(scores: DataFrame, by: Sequence[str] = (), score: str = "score", actual: str = "actual") -> DataFrame:
    """Average rank of every distinct score, ascending."""
    by = list(by)
    order = [F.col("score")]
    sliced = slice_by_order(score_counts(scores, by, score, actual), order, by)
    here = F.col("pos") + F.col("neg")
    ran = accumulate(sliced, order, {"before": ("sum", here)}, by, exclusive=True)
    return ran.select(*by, "score", here.alias("n"), (F.col("before") + (here + 1) / 2.0).alias("avg_rank"))


def pr_points(scores: DataFrame, by: Sequence[str] = (), score: str = "score", actual: str = "actual") -> DataFrame:
    c = curve(scores, by, score, actual)
    return c.select(
        *by, "score", (F.col("tp") / F.col("n_pos")).alias("recall"), (F.col("tp") / (F.col("tp") + F.col("fp"))).alias("precision")
    )


def pr_areas(scores: DataFrame, by: Sequence[str] = (), score: str = "score", actual: str = "actual") -> DataFrame:
    """Area under the precision-recall curve: step sum (average precision), trapezoid, and the continuous
    interpolation of Davis & Goadrich (2006) as integrated by Keilwagen et al. (2014)."""
    return areas(scores, by, score, actual).drop("auc")


def areas(scores: DataFrame, by: Sequence[str] = (), score: str = "score", actual: str = "actual") -> DataFrame:
    """The areas of :func:`pr_areas` and the ``auc`` of :func:`auc` from one ordering of the scores."""
    c = _cumulated(scores, by, score, actual)
    tp, fp = F.col("tp").cast("double"), F.col("fp").cast("double")
    tp0, fp0 = tp - F.col("pos"), fp - F.col("neg")
    now = tp / (tp + fp)
    before = F.when(tp0 + fp0 > 0, tp0 / (tp0 + fp0)).otherwise(now)
    width = F.col("pos") / F.col("n_pos")
    slope = F.col("neg") / F.col("pos")
    a, b = 1.0 + slope, fp0 - slope * tp0
    # integral of tp / (a tp + b) between the two points
    area = F.when(F.abs(b) < 1e-12, F.col("pos") / a).otherwise(
        F.col("pos") / a - b / (a * a) * F.log((a * tp + b) / (a * tp0 + b))
    )
    grown = F.col("pos") > 0
    return c.groupBy(*by).agg(
        F.sum(width * now).alias("average_precision"),
        F.sum(width * (now + before) / 2.0).alias("area_trapezoid"),
        F.sum(F.when(grown, area / F.col("n_pos")).otherwise(0.0)).alias("area_continuous"),
        ratio(F.sum(F.col("pos") * (F.col("n_neg") - F.col("fp") + F.col("neg") / 2.0)), F.sum("pos").cast("double") * F.sum("neg"), None).alias("auc"),
    )


def youden(scores: DataFrame, by: Sequence[str] = (), score: str = "score", actual: str = "actual") -> DataFrame:
    """Threshold midway between distinct scores that maximises tpr - fpr; the lowest on ties."""
    c = curve(scores, by, score, actual)
    mid = (F.col("score") + F.col("next_score")) / 2.0
    j = F.col("tp") / F.col("n_pos") - F.col("fp") / F.col("n_neg")
    cut = c.select(*by, F.coalesce(mid, F.lit(float("-inf"))).alias("threshold"), j.alias("j"))
    # a threshold that is not a number, next to a score that is none, is above all others
    low = F.when(~F.isnan("threshold"), -F.col("threshold"))
    best = F.max_by("threshold", F.struct(F.round("j", 12), low))
    return cut.groupBy(*by).agg(best.alias("threshold"), F.max("j").alias("youden_j"))


# --- thresholds ------------------------------------------------------------------------------------------------------


def threshold_sweep(
    scores: DataFrame, by: Sequence[str] = (), score: str = "score", actual: str = "actual", grid: Sequence[float] = tuple(SWEEP)
) -> DataFrame:
    """Confusion metrics at every threshold of a fixed grid, with the rule ``score >= threshold``.

    The grid is folded into one aggregate, so the scores are read once and never multiplied by the grid.
    """
    s, y = F.col(score), F.col(actual)
    hits = [(F.count_if((s >= t) & (y == 1)).alias(f"_p{i}"), F.count_if((s >= t) & (y == 0)).alias(f"_n{i}")) for i, t in enumerate(grid)]
    agg = scores.groupBy(*by).agg(
        F.count_if(y == 1).alias("_pos"), F.count_if(y == 0).alias("_neg"), *[c for pair in hits for c in pair]
    )
    rows = F.array(
        *[
            F.struct(F.lit(t).alias("threshold"), F.col(f"_p{i}").alias("tp"), F.col(f"_n{i}").alias("fp"))
            for i, t in enumerate(grid)
        ]
    )
    flat = agg.select(*by, "_pos", "_neg", F.explode(rows).alias("r")).select(
        *by,
        "r.threshold",
        "r.tp",
        "r.fp",
        (F.col("_neg") - F.col("r.fp")).alias("tn"),
        (F.col("_pos") - F.col("r.tp")).alias("fn"),
    )
    return confusion_metrics(flat)


def best_threshold(
    scores: DataFrame, by: Sequence[str] = (), score: str = "score", actual: str = "actual", use_default: bool = False
) -> DataFrame:
    """The sweep row of highest balanced accuracy, the first on ties, or the row of the default threshold."""
    grid = (DEFAULT_THRESHOLD,) if use_default else tuple(SWEEP)
    sweep = threshold_sweep(scores, by, score, actual, grid)
    rest = [c for c in sweep.columns if c not in by]
    key = F.struct(F.coalesce(F.round("balanced_accuracy", 12), F.lit(-1.0)), -F.col("threshold"))
    return sweep.groupBy(*by).agg(F.max_by(F.struct(*rest), key).alias("b")).select(*by, "b.*")


# --- tables of metrics -----------------------------------------------------------------------------------------------


def metric_summary(metrics: DataFrame, by: Sequence[str] = ("model", "metric"), value: str = "value") -> DataFrame:
    """Six-number summary with both standard deviations. A group holds one value per repeat and fold."""
    v = F.col(value)
    return metrics.groupBy(*by).agg(
        F.count(v).alias("n"),
        F.min(v).alias("min"),
        F.percentile(v, F.lit(0.25)).alias("q1"),
        F.percentile(v, F.lit(0.5)).alias("median"),
        F.avg(v).alias("mean"),
        F.percentile(v, F.lit(0.75)).alias("q3"),
        F.max(v).alias("max"),
        F.stddev_samp(v).alias("sd_sample"),
        F.stddev_pop(v).alias("sd_population"),
    )


def melt_metrics(table: DataFrame, keep: Sequence[str], metrics: Sequence[str]) -> DataFrame:
    typed = table.select(*keep, *[F.col(m).cast("double").alias(m) for m in metrics])
    return typed.unpivot(list(keep), list(metrics), "metric", "value")


def best_by(metrics: DataFrame, item: str, value: str, order: str | None = None) -> DataFrame:
    """The item of the highest value; the first (by ``order``, else by name) wins ties."""
    first = -F.col(order) if order else None
    if first is None:
        ranked = metrics.where(F.col(value) == metrics.agg(F.max(value)).scalar())
        return ranked.agg(F.min(item).alias(item), F.max(value).alias(value))
    return metrics.agg(F.max_by(item, F.struct(F.col(value), first)).alias(item), F.max(value).alias(value))


def baseline_delta(metrics: DataFrame, baseline: DataFrame, keys: Sequence[str] = ("metric",)) -> DataFrame:
    """Difference of each metric from a stored run; metrics only one run has stay, with a NULL difference."""
    old = baseline.select(*keys, F.col("value").alias("baseline"))
    return metrics.select(*keys, "value").join(old, list(keys), "full").withColumn("delta", F.col("value") - F.col("baseline"))
