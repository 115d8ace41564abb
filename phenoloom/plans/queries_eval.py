"""Catalogue: folds, weights, resampling, evaluation, run management."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from phenoloom.operators import evaluation as E
from phenoloom.operators import resampling as R
from phenoloom.operators.shape import cells_from_arrays
from phenoloom.plans import cohorts as K
from phenoloom.plans import ledger as L
from phenoloom.plans.digest import digest_table
from phenoloom.plans.registry import query, tidy
from phenoloom.plans.queries_cohort import scratch

SEED = "42"
TWO_PI = "6.283185307179586"


def labels(spark: SparkSession, sf: str) -> DataFrame:
    return K.table(spark, sf, "labels").select(F.col("doc_id").alias("sample_id"), F.col("quality").alias("outcome"))


def line_keys(spark: SparkSession, sf: str) -> DataFrame:
    return K.line_table(spark, sf).select("sample_id", "outcome")


SQL_LABELS = "lab AS (SELECT doc_id AS sample_id, quality AS outcome FROM labels)"


def sql_hash_order(key: str, seed: str) -> str:
    return f"md5(concat_ws('|', {key}, {seed})), CAST({key} AS VARCHAR)"


# --- folds -----------------------------------------------------------------------------------------------------------


@query(
    "strat_folds",
    f"WITH {K.SQL_LINES} SELECT sample_id, CAST(outcome AS BIGINT) AS outcome, (row_number() OVER (PARTITION BY outcome ORDER BY {sql_hash_order('sample_id', repr(SEED))}) - 1) % 5 AS fold FROM lines",
)
def strat_folds(spark, sf):
    return tidy(R.stratified_folds(line_keys(spark, sf), "sample_id", "outcome", 5, SEED))


_FOLD_SEED = f"'{SEED}:' || repeat"
_REPEATED = f"""WITH {SQL_LABELS}, rep AS (SELECT *, unnest(range(1, 4)) AS repeat FROM lab),
 folds AS (SELECT *, (row_number() OVER (PARTITION BY repeat, outcome ORDER BY {sql_hash_order('sample_id', _FOLD_SEED)}) - 1) % 5 AS fold FROM rep)"""


@query("repeated_folds", f"{_REPEATED} SELECT sample_id, CAST(outcome AS BIGINT) AS outcome, CAST(repeat AS BIGINT) AS repeat, fold FROM folds")
def repeated_folds(spark, sf):
    return tidy(R.repeated_folds(labels(spark, sf), "sample_id", "outcome", 5, 3, SEED))


@query(
    "holdout_split",
    f"""WITH {SQL_LABELS}, k AS (SELECT *, row_number() OVER (PARTITION BY outcome ORDER BY {sql_hash_order('sample_id', repr(SEED))}) AS r, count(*) OVER (PARTITION BY outcome) AS n FROM lab)
 SELECT sample_id, CAST(outcome AS BIGINT) AS outcome, CASE WHEN r <= ceil(0.1::DOUBLE * n) THEN 'val' ELSE 'train' END AS split FROM k""",
)
def holdout_split(spark, sf):
    return tidy(R.holdout_split(labels(spark, sf), "sample_id", "outcome", 0.1, SEED))


@query("split_class_counts", """WITH k AS (SELECT quality, row_number() OVER (PARTITION BY quality ORDER BY md5(concat_ws('|', doc_id, '42')), CAST(doc_id AS VARCHAR)) AS r, count(*) OVER (PARTITION BY quality) AS n FROM labels)
 SELECT CASE WHEN r <= ceil(0.1::DOUBLE * n) THEN 'val' ELSE 'train' END AS split, CAST(quality AS BIGINT) AS outcome, count(*) AS n FROM k GROUP BY ALL""")
def split_class_counts(spark, sf):
    parts = R.holdout_split(labels(spark, sf), "sample_id", "outcome", 0.1, SEED)
    return tidy(parts.groupBy("split", "outcome").agg(F.count("*").alias("n")))


@query("train_without_fold", f"{_REPEATED} SELECT CAST(repeat AS BIGINT) AS repeat, CAST(outcome AS BIGINT) AS outcome, count(*) AS n FROM folds WHERE fold <> 2 GROUP BY ALL")
def train_without_fold(spark, sf):
    folds = R.repeated_folds(labels(spark, sf), "sample_id", "outcome", 5, 3, SEED)
    return tidy(R.training_part(folds, 2).groupBy("repeat", "outcome").agg(F.count("*").alias("n")))


@query("class_weights", f"WITH {SQL_LABELS}, c AS (SELECT outcome, count(*) AS n FROM lab GROUP BY 1) SELECT sample_id, round((SELECT sum(n) FROM c) / (2 * c.n), 6) AS weight FROM lab JOIN c USING (outcome)")
def class_weights(spark, sf):
    return tidy(R.with_class_weights(labels(spark, sf), "outcome").select("sample_id", "weight"))


@query(
    "standardize",
    f"""WITH {K.sql_doc_cells()}, m AS (SELECT feature, avg(value) AS mean, stddev_pop(value) AS sd FROM cells WHERE sample_id % 3 <> 0 GROUP BY 1)
 SELECT sample_id, feature, round((value - mean) / sd, 6) AS value FROM cells JOIN m USING (feature) WHERE sample_id % 3 = 0""",
)
def standardize(spark, sf):
    c = K.docs(spark, sf).stored()
    joined = c.joined()
    fitted = R.moments(joined.where("sample_id % 3 <> 0"), c.names)
    out = R.standardise(joined.where("sample_id % 3 = 0"), c.names, fitted)
    return tidy(cells_from_arrays(out, c.names, ["sample_id"]))


def _u(parts: str) -> str:
    return f"(('0x' || substr(md5(concat_ws('|', {parts})), 1, 13))::BIGINT / {float(16**13)!r})"


_ROSE = f"""WITH {K.sql_doc_cells()}, n AS (SELECT outcome, count(*) AS nc FROM wide GROUP BY 1),
 h AS (SELECT c.outcome, feature, pow(4.0 / (10 * any_value(nc)), 1.0 / 12) * stddev_samp(value) AS h FROM cells c JOIN n USING (outcome) GROUP BY 1, 2),
 rk AS (SELECT sample_id, outcome, row_number() OVER (PARTITION BY outcome ORDER BY {sql_hash_order('sample_id', repr(SEED))}) AS r FROM wide),
 dr AS (SELECT draw, CASE WHEN {_u("draw, '42', 'class'")} < 0.5 THEN 0 ELSE 1 END AS outcome FROM range(0, (SELECT count(*) FROM wide)) g(draw)),
 pk AS (SELECT draw, dr.outcome, floor({_u("draw, '42', 'row'")} * nc) + 1 AS r FROM dr JOIN n USING (outcome)),
 src AS (SELECT draw, rk.sample_id AS source, pk.outcome FROM pk JOIN rk ON rk.outcome = pk.outcome AND rk.r = pk.r),
 nm AS (SELECT unnest({K.DOC_FEATURES!r}) AS feature, unnest(range(0, {len(K.DOC_FEATURES)})) AS i),
 out AS (SELECT draw, source, src.outcome, feature, i, value + h * sqrt(-2 * ln(1 - {_u("draw, i, '42', 'u'")})) * cos({TWO_PI} * {_u("draw, i, '42', 'v'")}) AS value
   FROM src JOIN cells ON cells.sample_id = source JOIN nm USING (feature) JOIN h ON h.outcome = src.outcome AND h.feature = cells.feature)"""


def _rose(spark, sf):
    c = K.docs(spark, sf).stored()
    return R.rose(c.joined(), c.names, "sample_id", "outcome", seed=SEED), c.names


@query("rose_draws", f"{_ROSE} SELECT draw, source, CAST(outcome AS BIGINT) AS outcome, feature, round(value, 5) AS value FROM out")
def rose_draws(spark, sf):
    sample, names = _rose(spark, sf)
    return tidy(cells_from_arrays(sample, names, ["draw", "source", "outcome"]), 5)


@query("rose_balance", f"{_ROSE} SELECT CAST(outcome AS BIGINT) AS outcome, count(*) AS n, count(DISTINCT source) AS n_sources FROM src GROUP BY 1")
def rose_balance(spark, sf):
    sample, _ = _rose(spark, sf)
    return tidy(sample.groupBy("outcome").agg(F.count("*").alias("n"), F.count_distinct("source").alias("n_sources")))


@query(
    "param_grid",
    f"""{_REPEATED}, t AS (SELECT repeat, fold, count(*) AS n_test FROM folds GROUP BY ALL)
 SELECT CAST(repeat AS BIGINT) AS repeat, fold, n_test, CAST(d AS BIGINT) AS max_depth, s AS step, CAST(r AS BIGINT) AS rounds FROM t,
 (SELECT unnest([1, 3, 5, 7, 10]) AS d), (SELECT unnest([0.03::DOUBLE, 0.05, 0.1]) AS s), (SELECT unnest([150, 300, 500]) AS r)""",
)
def param_grid(spark, sf):
    from phenoloom.operators.models import expand_grid

    folds = R.repeated_folds(labels(spark, sf), "sample_id", "outcome", 5, 3, SEED)
    fits = folds.groupBy("repeat", "fold").agg(F.count("*").alias("n_test"))
    return tidy(expand_grid(fits, {"max_depth": [1, 3, 5, 7, 10], "step": [0.03, 0.05, 0.1], "rounds": [150, 300, 500]}))


# --- evaluation ------------------------------------------------------------------------------------------------------

BY = ["model", "fold"]
_AUC = """sc AS (SELECT {by} score, count(*) FILTER (actual = 1) AS pos, count(*) FILTER (actual = 0) AS neg FROM scores GROUP BY ALL)"""
_CURVE = """cv AS (SELECT {by} score, pos, neg, sum(pos) OVER ({part} ORDER BY score DESC) AS tp, sum(neg) OVER ({part} ORDER BY score DESC) AS fp,
   sum(pos) OVER ({part}) AS np, sum(neg) OVER ({part}) AS nn, lead(score) OVER ({part} ORDER BY score DESC) AS nxt FROM sc)"""


def sql_curve(base: str, grouped: bool) -> str:
    by, part = ("model, fold,", "PARTITION BY model, fold") if grouped else ("", "")
    return f"WITH {base}, {_AUC.format(by=by)}, {_CURVE.format(by=by, part=part)}"


_TIED, _FREE = sql_curve(K.SQL_SCORES, True), sql_curve(K.SQL_DOC_SCORES, False)


@query(
    "auc_ranksum",
    f"{_TIED}, a AS (SELECT model, fold, sum(pos * (nn - fp + neg / 2.0)) / (any_value(np) * any_value(nn)) AS auc FROM cv GROUP BY 1, 2) SELECT model, CAST(fold AS BIGINT) AS fold, round(auc, 6) AS auc FROM a",
)
def auc_ranksum(spark, sf):
    return tidy(E.auc(K.scores(spark, sf), BY))


@query(
    "auc_untied",
    f"WITH {K.SQL_DOC_SCORES} SELECT round(sum(CASE WHEN a.score > b.score THEN 1.0 WHEN a.score = b.score THEN 0.5 ELSE 0 END) / count(*), 6) AS auc FROM scores a JOIN scores b ON a.actual = 1 AND b.actual = 0",
)
def auc_untied(spark, sf):
    return tidy(E.auc(K.doc_scores(spark, sf)))


@query(
    "average_ranks",
    f"WITH {K.SQL_SCORES}, k AS (SELECT model, fold, score, rank() OVER (PARTITION BY model, fold ORDER BY score) + (count(*) OVER (PARTITION BY model, fold, score) - 1) / 2.0 AS avg_rank FROM scores)"
    " SELECT model, CAST(fold AS BIGINT) AS fold, round(score, 6) AS score, count(*) AS n, round(any_value(avg_rank), 6) AS avg_rank FROM k GROUP BY model, fold, k.score",
)
def average_ranks(spark, sf):
    return tidy(E.average_ranks(K.scores(spark, sf), BY))


@query("roc_points", f"{_FREE} SELECT round(score, 6) AS score, round(fp / nn, 6) AS fpr, round(tp / np, 6) AS tpr FROM cv")
def roc_points(spark, sf):
    return tidy(E.roc_points(K.doc_scores(spark, sf)))


@query("roc_tied", f"{_TIED} SELECT model, CAST(fold AS BIGINT) AS fold, round(score, 6) AS score, round(fp / nn, 6) AS fpr, round(tp / np, 6) AS tpr FROM cv")
def roc_tied(spark, sf):
    return tidy(E.roc_points(K.scores(spark, sf), BY))


@query(
    "roc_hard_labels",
    f"WITH {K.SQL_SCORES}, t AS (SELECT model, avg(prediction) FILTER (actual = 0) AS fpr, avg(prediction) FILTER (actual = 1) AS tpr FROM scores GROUP BY 1)"
    " SELECT model, 1.0::DOUBLE AS score, round(fpr, 6) AS fpr, round(tpr, 6) AS tpr FROM t UNION ALL SELECT model, 0.0, 1.0, 1.0 FROM t",
)
def roc_hard_labels(spark, sf):
    return tidy(E.roc_points(K.scores(spark, sf), ["model"], score="prediction"))


@query(
    "youden",
    f"{_FREE}, j AS (SELECT (score + nxt) / 2 AS thr, tp / np - fp / nn AS j FROM cv WHERE nxt IS NOT NULL) SELECT round(thr, 6) AS threshold, round(j, 6) AS youden_j FROM j ORDER BY round(j, 12) DESC, thr LIMIT 1",
)
def youden(spark, sf):
    return tidy(E.youden(K.doc_scores(spark, sf)))


@query("pr_points", f"{_FREE} SELECT round(score, 6) AS score, round(tp / np, 6) AS recall, round(tp / (tp + fp), 6) AS precision FROM cv")
def pr_points(spark, sf):
    return tidy(E.pr_points(K.doc_scores(spark, sf)))


_PR = """, lg AS (SELECT *, tp - pos AS tp0, fp - neg AS fp0, neg / pos AS h FROM cv),
 ar AS (SELECT *, pos / np AS w, tp / (tp + fp) AS pr, CASE WHEN tp0 + fp0 > 0 THEN tp0 / (tp0 + fp0) ELSE tp / (tp + fp) END AS pr0 FROM lg)"""


@query(
    "pr_areas",
    f"""{_TIED}{_PR} SELECT model, CAST(fold AS BIGINT) AS fold, round(sum(w * pr), 6) AS average_precision, round(sum(w * (pr + pr0) / 2), 6) AS area_trapezoid,
 round(sum((SELECT sum((CASE WHEN i IN (0, 400) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END) * (CASE WHEN tp0 + pos * i / 400.0 = 0 THEN 1 / (1 + h)
    ELSE (tp0 + pos * i / 400.0) / (tp0 + pos * i / 400.0 + fp0 + h * pos * i / 400.0) END)) * pos / 400.0 / 3 / np FROM range(0, 401) g(i))), 6) AS area_continuous FROM ar GROUP BY 1, 2""",
)
def pr_areas(spark, sf):
    return tidy(E.pr_areas(K.scores(spark, sf), BY))


@query("avg_precision_untied", f"{_FREE}{_PR} SELECT round(sum(w * pr), 6) AS average_precision, round(sum(w * (pr + pr0) / 2), 6) AS area_trapezoid FROM ar")
def avg_precision_untied(spark, sf):
    return tidy(E.pr_areas(K.doc_scores(spark, sf)).select("average_precision", "area_trapezoid"))


_SWEEP = f"""WITH {K.SQL_SCORES}, g AS (SELECT i * 0.1::DOUBLE AS threshold FROM range(0, 11) g(i)),
 c AS (SELECT model, fold, threshold, count(*) FILTER (actual = 1 AND score >= threshold) AS tp, count(*) FILTER (actual = 0 AND score >= threshold) AS fp,
   count(*) FILTER (actual = 0 AND score < threshold) AS tn, count(*) FILTER (actual = 1 AND score < threshold) AS fn FROM scores, g GROUP BY ALL),
 m AS (SELECT *, tp / (tp + fn) AS sens, tn / (tn + fp) AS spec, (tp / (tp + fn) + tn / (tn + fp)) / 2 AS bal FROM c)"""


@query(
    "threshold_sweep",
    f"{_SWEEP} SELECT model, CAST(fold AS BIGINT) AS fold, round(threshold, 6) AS threshold, tp, fp, tn, fn, round(sens, 6) AS sensitivity, round(spec, 6) AS specificity, round(bal, 6) AS balanced_accuracy FROM m",
)
def threshold_sweep(spark, sf):
    out = E.threshold_sweep(K.scores(spark, sf), BY)
    return tidy(out.drop("ppv", "accuracy"))


@query(
    "best_threshold",
    f"{_SWEEP}, k AS (SELECT *, row_number() OVER (PARTITION BY model, fold ORDER BY round(bal, 12) DESC, threshold) AS i FROM m) SELECT model, CAST(fold AS BIGINT) AS fold, round(threshold, 6) AS threshold, round(bal, 6) AS balanced_accuracy FROM k WHERE i = 1",
)
def best_threshold(spark, sf):
    return tidy(E.best_threshold(K.scores(spark, sf), BY).select(*BY, "threshold", "balanced_accuracy"))


@query(
    "default_threshold",
    f"{_SWEEP} SELECT model, CAST(fold AS BIGINT) AS fold, tp, fp, tn, fn, round(bal, 6) AS balanced_accuracy FROM m WHERE threshold = 0.5",
)
def default_threshold(spark, sf):
    return tidy(E.best_threshold(K.scores(spark, sf), BY, use_default=True).select(*BY, "tp", "fp", "tn", "fn", "balanced_accuracy"))


_CM = f"""WITH {K.SQL_SCORES}, c AS (SELECT model, fold, count(*) FILTER (actual = 1 AND prediction = 1) AS tp, count(*) FILTER (actual = 0 AND prediction = 1) AS fp,
 count(*) FILTER (actual = 0 AND prediction = 0) AS tn, count(*) FILTER (actual = 1 AND prediction = 0) AS fn FROM scores GROUP BY ALL)"""
_CM_COLS = """tp / (tp + fn) AS sensitivity, tn / (tn + fp) AS specificity, tp / (tp + fp) AS ppv, (tp / (tp + fn) + tn / (tn + fp)) / 2 AS balanced_accuracy,
 (tp + tn) / (tp + fp + tn + fn) AS accuracy"""
METRICS = ["sensitivity", "specificity", "ppv", "balanced_accuracy", "accuracy"]


@query("confusion_metrics", f"{_CM}, m AS (SELECT *, {_CM_COLS} FROM c) SELECT model, CAST(fold AS BIGINT) AS fold, tp, fp, tn, fn, {', '.join(f'round({m}, 6) AS {m}' for m in METRICS)} FROM m")
def confusion_metrics(spark, sf):
    return tidy(E.confusion_metrics(E.confusion(K.scores(spark, sf), BY)))


@query("accuracy", f"WITH {K.SQL_SCORES} SELECT model, round(avg(CAST(actual = prediction AS INT)), 6) AS accuracy FROM scores GROUP BY 1")
def accuracy(spark, sf):
    return tidy(E.accuracy(K.scores(spark, sf), ["model"]))


_PC = f"""WITH {K.SQL_SCORES}, lv AS (SELECT DISTINCT model, unnest([0, 1]) AS label FROM scores),
 pc AS (SELECT lv.model, label, count(*) FILTER (actual = label AND prediction = label) AS tp, count(*) FILTER (prediction = label) AS pred, count(*) FILTER (actual = label) AS support
   FROM lv JOIN scores s ON s.model = lv.model GROUP BY ALL),
 pm AS (SELECT *, CASE WHEN pred = 0 THEN 0 ELSE tp / pred END AS p, CASE WHEN support = 0 THEN 0 ELSE tp / support END AS r FROM pc),
 pf AS (SELECT *, CASE WHEN p + r = 0 THEN 0 ELSE 2 * p * r / (p + r) END AS f FROM pm)"""


@query(
    "class_report",
    f"""{_PC} SELECT model, CAST(label AS VARCHAR) AS label, round(p, 6) AS precision, round(r, 6) AS recall, round(f, 6) AS f1, support FROM pf
 UNION ALL SELECT model, 'macro avg', round(avg(p), 6), round(avg(r), 6), round(avg(f), 6), CAST(sum(support) AS BIGINT) FROM pf GROUP BY 1
 UNION ALL SELECT model, 'weighted avg', round(sum(p * support) / sum(support), 6), round(sum(r * support) / sum(support), 6), round(sum(f * support) / sum(support), 6), CAST(sum(support) AS BIGINT) FROM pf GROUP BY 1""",
)
def class_report(spark, sf):
    return tidy(E.class_report(K.scores(spark, sf), ["model"]))


@query(
    "weighted_prf",
    f"{_PC} SELECT model, round(sum(tp) / sum(support), 6) AS accuracy, round(sum(p * support) / sum(support), 6) AS weighted_precision, round(sum(r * support) / sum(support), 6) AS weighted_recall, round(sum(f * support) / sum(support), 6) AS weighted_f1 FROM pf GROUP BY 1",
)
def weighted_prf(spark, sf):
    return tidy(E.weighted_scores(K.scores(spark, sf), ["model"]))


def _metrics(spark, sf) -> DataFrame:
    return E.melt_metrics(E.confusion_metrics(E.confusion(K.scores(spark, sf), BY)), BY, METRICS)


_LONG = f"""{_CM}, w AS (SELECT model, fold, {_CM_COLS} FROM c), metrics AS (SELECT * FROM (UNPIVOT w ON {', '.join(METRICS)} INTO NAME metric VALUE value))"""


@query(
    "fold_metric_summary",
    f"""{_LONG} SELECT model, metric, count(value) AS n, round(min(value), 6) AS min, round(quantile_cont(value, 0.25), 6) AS q1, round(median(value), 6) AS median, round(avg(value), 6) AS mean,
 round(quantile_cont(value, 0.75), 6) AS q3, round(max(value), 6) AS max, round(stddev_samp(value), 6) AS sd_sample, round(stddev_pop(value), 6) AS sd_population FROM metrics GROUP BY 1, 2""",
)
def fold_metric_summary(spark, sf):
    return tidy(E.metric_summary(_metrics(spark, sf)))


@query("best_model", f"{_LONG}, a AS (SELECT model, avg(value) AS v FROM metrics WHERE metric = 'accuracy' GROUP BY 1) SELECT model, round(v, 6) AS value FROM a ORDER BY v DESC, model LIMIT 1")
def best_model(spark, sf):
    means = _metrics(spark, sf).where("metric = 'accuracy'").groupBy("model").agg(F.avg("value").alias("value"))
    return tidy(E.best_by(means, "model", "value"))


@query(
    "ladder_pick",
    f"""WITH {K.SQL_SCORES}, l AS (SELECT CAST(l_linenumber AS BIGINT) AS n_features, l_suppkey % 3 AS fold, avg(CAST((l_discount >= 0.05) = (l_returnflag = 'R') AS INT)) AS score FROM lineitem GROUP BY ALL),
 a AS (SELECT n_features, avg(score) AS s FROM l GROUP BY 1) SELECT 'all' AS rule, (SELECT n_features FROM a ORDER BY round(s, 12) DESC, n_features LIMIT 1) AS n_features
 UNION ALL SELECT 'without_largest', (SELECT n_features FROM a WHERE n_features < (SELECT max(n_features) FROM a) ORDER BY round(s, 12) DESC, n_features LIMIT 1)""",
)
def ladder_pick(spark, sf):
    from phenoloom.operators.selection import pick_size, pick_size_below_full

    li = K.table(spark, sf, "lineitem")
    hit = ((F.col("l_discount") >= 0.05) == (F.col("l_returnflag") == "R")).cast("double")
    ladder = li.groupBy(F.col("l_linenumber").cast("long").alias("n_features"), (F.col("l_suppkey") % 3).alias("fold")).agg(F.avg(hit).alias("score"))
    return pick_size(ladder).select(F.lit("all").alias("rule"), "n_features").unionByName(
        pick_size_below_full(ladder).select(F.lit("without_largest").alias("rule"), "n_features")
    )


@query(
    "baseline_delta",
    f"""{_LONG}, cur AS (SELECT metric, avg(value) AS value FROM metrics WHERE model = 'F' GROUP BY 1), old AS (SELECT metric, avg(value) AS value FROM metrics WHERE model = 'O' AND metric <> 'ppv' GROUP BY 1)
 SELECT metric, round(cur.value, 6) AS value, round(old.value, 6) AS baseline, round(cur.value - old.value, 6) AS delta FROM cur FULL JOIN old USING (metric)""",
)
def baseline_delta(spark, sf):
    m = _metrics(spark, sf)
    means = m.groupBy("model", "metric").agg(F.avg("value").alias("value"))
    return tidy(E.baseline_delta(means.where("model = 'F'"), means.where("model = 'O' and metric <> 'ppv'")))


# --- run management --------------------------------------------------------------------------------------------------


@query(
    "timing_shares",
    f"""WITH {K.SQL_LEDGER}, s AS (SELECT run_id, step, sum(elapsed_s) AS seconds FROM ledger GROUP BY ALL)
 SELECT run_id, step, round(seconds, 4) AS seconds, round(seconds / 60, 4) AS minutes, round(100 * seconds / sum(seconds) OVER (PARTITION BY run_id), 4) AS share FROM s""",
)
def timing_shares(spark, sf):
    return tidy(L.timing_shares(K.ledger_rows(spark, sf)), 4)


@query(
    "timing_overhead",
    f"""WITH {K.SQL_LEDGER}, t AS (SELECT run_id, sum(elapsed_s) AS measured, epoch_us(max(started)) / 1e6 - epoch_us(min(started)) / 1e6 AS wall FROM ledger GROUP BY 1)
 SELECT run_id, round(measured, 3) AS measured, round(wall, 3) AS wall, round(wall - measured, 3) AS overhead FROM t""",
)
def timing_overhead(spark, sf):
    rows = K.ledger_rows(spark, sf).withColumn("ended", F.col("started"))
    return tidy(L.overhead(rows), 3)


@query("step_latest", f"WITH {K.SQL_LEDGER} SELECT run_id, step, arg_max(rows, (started, rows)) AS rows FROM ledger GROUP BY 1, 2")
def step_latest(spark, sf):
    return L.latest_steps(K.ledger_rows(spark, sf)).select("run_id", "step", "rows")


@query("checkpoint_roundtrip", "SELECT c_mktsegment AS segment, count(*) AS n FROM customer GROUP BY 1")
def checkpoint_roundtrip(spark, sf):
    run = L.Run(spark, scratch(spark), "r1")
    segments = K.table(spark, sf, "customer").groupBy(F.col("c_mktsegment").alias("segment")).agg(F.count("*").alias("n"))
    run.save(segments, step="segments", description="customers per segment")
    return run.load("segments")


@query(
    "integrity_check",
    "SELECT 'customers' AS step, count(*) > 0 AS valid, count(*) AS rows FROM customer UNION ALL SELECT 'nations', count(*) > 0, count(*) FROM nation",
)
def integrity_check(spark, sf):
    run = L.Run(spark, scratch(spark), "r1")
    for step, name in (("customers", "customer"), ("nations", "nation"), ("dropped", "region")):
        run.save(K.table(spark, sf, name), step=step)
    run.delete("dropped")
    return run.check().select("step", "valid", F.col("rows_found").alias("rows"))


_CELLS = {"c_custkey": "CAST(c_custkey AS VARCHAR)", "c_name": "c_name", "c_nationkey": "CAST(c_nationkey AS VARCHAR)", "c_mktsegment": "c_mktsegment"}


@query(
    "table_digest",
    f"""WITH c AS (SELECT *, CASE WHEN c_custkey % 7 <> 0 THEN c_name END AS name FROM customer),
 h AS (SELECT {", ".join(f"('0x' || md5(coalesce('=' || {x.replace('c_name', 'name')}, '-'))[1:15])::BIGINT AS {n}" for n, x in _CELLS.items())}, name IS NULL AS gone FROM c),
 r AS (SELECT *, ('0x' || md5(concat_ws('|', {", ".join(_CELLS)}))[1:15])::BIGINT AS "*" FROM h),
 l AS (UNPIVOT r ON {", ".join(_CELLS)}, "*" INTO NAME "column" VALUE v)
 SELECT "column", count(*) AS rows, CAST(sum(CASE WHEN gone AND "column" = 'c_name' THEN 1 ELSE 0 END) AS BIGINT) AS nulls, CAST(sum(v) AS VARCHAR) AS sum, bit_xor(v) AS xor FROM l GROUP BY 1""",
)
def table_digest(spark, sf):
    """Sums and exclusive ors of the hashes of all cells and rows, with nulls in one column."""
    c = K.table(spark, sf, "customer").select(*_CELLS).withColumn("c_name", F.when(F.col("c_custkey") % 7 != 0, F.col("c_name")))
    return digest_table(c.repartition(5))


@query(
    "integrity_by_content",
    """SELECT unnest(['altered', 'kept', 'lost', 'swapped']) AS step, unnest([false, true, false, false]) AS valid, unnest(['content of c_name differs', 'ok',
 count(*) - 1 || ' rows, ' || count(*) || ' recorded', 'content of c_mktsegment, c_name differs']) AS message FROM customer HAVING count(*) > 1""",
)
def integrity_by_content(spark, sf):
    """Stored steps whose files were changed behind the ledger: one cell, nothing, one row lost, two columns exchanged."""
    run = L.Run(spark, scratch(spark), "r1")
    c = K.table(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment")
    one = c.agg(F.min("c_custkey").alias("k")).first()["k"]
    changed = {
        "kept": None, "altered": c.withColumn("c_name", F.when(F.col("c_custkey") == one, "nobody").otherwise(F.col("c_name"))), "lost": c.where(F.col("c_custkey") != one),
        "swapped": c.select("c_custkey", F.col("c_mktsegment").alias("c_name"), F.col("c_name").alias("c_mktsegment")),
    }
    for step, other in changed.items():
        run.save(c, step=step)
        if other is not None:
            other.write.mode("overwrite").parquet(run.info(step)["path"])
    return run.check().select("step", "valid", "message")


@query(
    "step_delete",
    "SELECT 'kept' AS step, true AS listed, true AS files, count(*) AS rows FROM nation UNION ALL SELECT 'dropped', false, false, CAST(NULL AS BIGINT)",
)
def step_delete(spark, sf):
    """One of two stored steps is deleted: it is neither listed nor on disk, the other is both."""
    run = L.Run(spark, scratch(spark), "r1")
    for step, name in (("kept", "nation"), ("dropped", "region")):
        run.save(K.table(spark, sf, name), step=step)
    run.delete("dropped")
    facts = [(step, run.exists(step), run.has_files(step)) for step in ("kept", "dropped")]
    asked = spark.createDataFrame(facts, "step string, listed boolean, files boolean")
    return asked.join(run.load("kept").agg(F.lit("kept").alias("step"), F.count("*").alias("rows")), "step", "left").select("step", "listed", "files", "rows")


@query(
    "run_summary",
    "SELECT 'performance' AS section, 'orders' AS step, o_orderstatus AS key, CAST(count(*) AS VARCHAR) AS value FROM orders GROUP BY 3"
    " UNION ALL SELECT 'overview', 'orders', 'rows', CAST(count(DISTINCT o_orderstatus) AS VARCHAR) FROM orders",
)
def run_summary(spark, sf):
    run = L.Run(spark, scratch(spark), "r1")
    counts = K.table(spark, sf, "orders").groupBy("o_orderstatus").agg(F.count("*").alias("n"))
    run.save(counts, step="orders")
    facts = run.load("orders").select(F.lit("orders").alias("step"), F.col("o_orderstatus").alias("key"), F.col("n").cast("string").alias("value"))
    return run.summary({"performance": facts}).where("key <> 'elapsed_s'").select("section", "step", "key", "value")
