"""Catalogue: association tests, multiple testing, selection, importance tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from phenoloom.functions.special import DIGAMMA_SERIES, SHIFT, TRIGAMMA_SERIES, student_t_p
from phenoloom.operators import association as A
from phenoloom.operators import importance as I
from phenoloom.operators.cohort import lookup
from phenoloom.plans import cohorts as K
from phenoloom.plans.registry import query, r, tidy
from phenoloom.session import materialise

# --- SQL for the special functions ------------------------------------------------------------------------------------


def sql_t_p(t: str, df: str) -> str:
    """Two-sided p of Student's t: the density, with t = sqrt(df) tan(u), integrated by Simpson's rule on 4,001 points."""
    lo = f"atan(abs({t}) / sqrt({df}))"
    # for large df the density is spent long before pi/2
    width = f"(least(pi() / 2, {lo} + 40 / sqrt({df})) - {lo})"
    u = f"({lo} + {width} * g.i / 4000.0)"
    return (
        f"(SELECT 2 * exp(lgamma(({df} + 1) / 2) - lgamma({df} / 2)) / sqrt(pi()) * {width} / 4000.0 / 3 *"
        f" sum((CASE WHEN g.i IN (0, 4000) THEN 1 WHEN g.i % 2 = 1 THEN 4 ELSE 2 END) * pow(greatest(cos({u}), 0), {df} - 1)) FROM range(0, 4001) g(i))"
    )


def sql_digamma(x: str) -> str:
    y = f"({x} + {SHIFT})"
    tail = " + ".join(f"({c!r}) * pow({y}, {-2 * (i + 1)})" for i, c in enumerate(DIGAMMA_SERIES))
    steps = " + ".join(f"1.0 / ({x} + {i})" for i in range(SHIFT))
    return f"(ln({y}) - 0.5 / {y} - ({tail}) - ({steps}))"


def sql_trigamma(x: str) -> str:
    y = f"({x} + {SHIFT})"
    tail = " + ".join(f"({c!r}) * pow({y}, {-2 * (i + 1) - 1})" for i, c in enumerate(TRIGAMMA_SERIES))
    steps = " + ".join(f"1.0 / pow({x} + {i}, 2)" for i in range(SHIFT))
    return f"(1.0 / {y} + 0.5 / pow({y}, 2) + {tail} + {steps})"


def sql_two_group(cells: str) -> str:
    return f"""{cells},
 st AS (SELECT feature, count(value) AS n, count(value) FILTER (outcome = 0) AS n0, count(value) FILTER (outcome = 1) AS n1,
   avg(value) FILTER (outcome = 1) - avg(value) FILTER (outcome = 0) AS effect,
   ((count(value) FILTER (outcome = 0) - 1) * var_samp(value) FILTER (outcome = 0)
    + (count(value) FILTER (outcome = 1) - 1) * var_samp(value) FILTER (outcome = 1)) / (count(value) - 2) AS s2,
   CAST(count(value) - 2 AS DOUBLE) AS df,
   1.0 / count(value) FILTER (outcome = 0) + 1.0 / count(value) FILTER (outcome = 1) AS v FROM cells GROUP BY 1)"""


def sql_moderated(cells: str) -> str:
    """The prior by moments; trigamma is inverted by bisection on log x, another way than the engine's."""
    return f"""{sql_two_group(cells).replace('WITH ', '')},
 ev AS (SELECT ln(s2) - {sql_digamma('(df / 2)')} + ln(df / 2) AS e, {sql_trigamma('(df / 2)')} AS tri FROM st),
 em AS (SELECT avg(e) AS me, var_samp(e) - avg(tri) AS spread FROM ev),
 bis(k, lo, hi) AS (SELECT 0, -20.0::DOUBLE, 20.0::DOUBLE UNION ALL
   SELECT k + 1, CASE WHEN {sql_trigamma('exp((lo + hi) / 2)')} > spread THEN (lo + hi) / 2 ELSE lo END,
     CASE WHEN {sql_trigamma('exp((lo + hi) / 2)')} > spread THEN hi ELSE (lo + hi) / 2 END FROM bis, em WHERE k < 80 AND spread > 0),
 pr AS (SELECT CASE WHEN spread > 0 THEN (SELECT 2 * exp((lo + hi) / 2) FROM bis WHERE k = 80) END AS d0, me FROM em),
 prior AS (SELECT d0, CASE WHEN d0 IS NULL THEN exp(me) ELSE exp(me + {sql_digamma('(d0 / 2)')} - ln(d0 / 2)) END AS s0 FROM pr),
 tt AS (SELECT feature, n, effect, effect / (sqrt(CASE WHEN d0 IS NULL THEN s0 ELSE (d0 * s0 + df * s2) / (d0 + df) END) * sqrt(v)) AS t,
   CASE WHEN d0 IS NULL THEN (SELECT sum(df) FROM st) ELSE least(d0 + df, (SELECT sum(df) FROM st)) END AS dft FROM st, prior),
 tested AS (SELECT *, {sql_t_p('t', 'dft')} AS p_value FROM tt)"""


def sql_pearson(cells: str) -> str:
    return f"""{cells},
 rr AS (SELECT feature, count(*) AS n, corr(value, outcome) AS r FROM cells WHERE value IS NOT NULL GROUP BY 1),
 rt AS (SELECT *, r * sqrt((n - 2) / (1 - r * r)) AS t, CAST(n - 2 AS DOUBLE) AS df FROM rr),
 tested AS (SELECT feature, n, r, {sql_t_p('t', 'df')} AS p_value FROM rt)"""


SQL_BH = """adj AS (SELECT *, least(1.0, min(raw) OVER (ORDER BY i DESC ROWS UNBOUNDED PRECEDING)) AS p_adjusted FROM
   (SELECT *, p_value * count(*) OVER () / row_number() OVER (ORDER BY p_value, feature) AS raw,
      row_number() OVER (ORDER BY p_value, feature) AS i FROM tested)),
 flags AS (SELECT *, p_value < 0.05 / count(*) OVER () AS pass_bonf, p_adjusted <= 0.05 AS fdr_significant, p_value < 0.05 AS nominal_significant FROM adj)"""


def pearson_flags(cells: DataFrame) -> DataFrame:
    return A.with_flags(A.adjust_fdr(A.pearson(cells)))


# --- tests -----------------------------------------------------------------------------------------------------------


@query(
    "two_group_t",
    f"""WITH {sql_two_group(K.sql_vector_cells(1, holes=True))}, tt AS (SELECT *, effect / sqrt(s2 * v) AS t FROM st)
 SELECT feature, n, n0, n1, round(effect, 6) AS effect, round(s2, 6) AS s2, round(t, 6) AS t, round({sql_t_p('t', 'df')}, 6) AS p_value FROM tt""",
)
def two_group_t(spark: SparkSession, sf: str) -> DataFrame:
    out = A.plain_t(A.two_group(K.vectors(spark, sf, 1, holes=True).cells()))
    return tidy(out.select("feature", "n", "n0", "n1", "effect", "s2", "t", "p_value"))


_MODERATED = """, {bh} SELECT feature, n, round(effect, 5) AS effect, round(t, 5) AS t, round(dft, 3) AS df_total, round(log10(p_value), 4) AS log10_p,
 round(p_adjusted, 6) AS p_adjusted, pass_bonf, p_adjusted < 0.05 AS fdr_significant, nominal_significant FROM flags"""


def _moderated(cells: DataFrame) -> DataFrame:
    out = A.associate_moderated(cells)
    return out.select(
        "feature",
        "n",
        r("effect", 5).alias("effect"),
        r("t", 5).alias("t"),
        r("df_total", 3).alias("df_total"),
        r(F.log10("p_value"), 4).alias("log10_p"),
        r("p_adjusted").alias("p_adjusted"),
        "pass_bonf",
        "fdr_significant",
        "nominal_significant",
    )


@query("moderated_t", f"WITH RECURSIVE {sql_moderated(K.sql_doc_cells())}" + _MODERATED.format(bh=SQL_BH))
def moderated_t(spark, sf):
    return _moderated(K.docs(spark, sf).cells())


@query("moderated_t_vectors", f"WITH RECURSIVE {sql_moderated(K.sql_vector_cells(9, holes=True))}" + _MODERATED.format(bh=SQL_BH))
def moderated_t_vectors(spark, sf):
    return _moderated(K.vectors(spark, sf, 9, holes=True).cells())


@query("moderated_t_lines", f"WITH RECURSIVE {sql_moderated(K.SQL_LINE_CELLS)}" + _MODERATED.format(bh=SQL_BH))
def moderated_t_lines(spark, sf):
    return _moderated(K.line_cells(spark, sf))


@query(
    "t_pvalue",
    f"""WITH s AS (SELECT event_type AS grp, count(*) AS n, (avg(value) - 50) / (stddev_samp(value) / sqrt(count(*))) AS t FROM events GROUP BY 1),
 d AS (SELECT grp, t, CAST(n - 1 AS DOUBLE) AS df FROM s) SELECT grp, round({sql_t_p('t', 'df')}, 6) AS p_value FROM d""",
)
def t_pvalue(spark, sf):
    v = F.col("value")
    s = K.table(spark, sf, "events").groupBy(F.col("event_type").alias("grp")).agg(
        F.count("*").alias("n"), ((F.avg(v) - 50) / (F.stddev_samp(v) / F.sqrt(F.count("*")))).alias("t")
    )
    return tidy(s.select("grp", student_t_p("t", (F.col("n") - 1).cast("double")).alias("p_value")))


@query("pearson_by_feature", f"WITH {sql_pearson(K.sql_vector_cells(9, holes=True))} SELECT feature, n, round(r, 6) AS r, round(p_value, 6) AS p_value FROM tested")
def pearson_by_feature(spark, sf):
    return tidy(A.pearson(K.vectors(spark, sf, 9, holes=True).cells()))


@query(
    "anova_f",
    f"""WITH {K.sql_vector_cells(1)}, g AS (SELECT feature, e.label AS y, count(*) AS n, avg(value) AS m, var_pop(value) AS v FROM cells JOIN embeddings e ON e.vec_id = sample_id GROUP BY 1, 2),
 f AS (SELECT feature, sum(n) AS n, count(*) AS k, sum(n * v) AS ssw, sum(n * m) / sum(n) AS gm FROM g GROUP BY 1)
 SELECT feature, CAST(f.n AS BIGINT) AS n, round((SELECT sum(g.n * pow(g.m - f.gm, 2)) FROM g WHERE g.feature = f.feature) / (k - 1) / (ssw / (f.n - k)), 6) AS f_score FROM f""",
)
def anova_f(spark, sf):
    e = K.table(spark, sf, "embeddings").select(F.col("vec_id").alias("sample_id"), F.col("label"))
    cohort = K.vectors(spark, sf, 1)
    cells = K.cells_from_arrays(cohort.matrix.join(e, "sample_id"), cohort.names, ["label"])
    return tidy(A.anova(cells, "label").select("feature", "n", "f_score"))


_ANOVA2 = f"""WITH {sql_two_group(K.sql_doc_cells())}, tt AS (SELECT feature, n, df, effect / sqrt(s2 * v) AS t FROM st),
 tested AS (SELECT feature, n, t * t AS f_score, {sql_t_p('t', 'df')} AS p_value FROM tt)"""


@query(
    "select_k_best",
    f"{_ANOVA2}, k AS (SELECT *, row_number() OVER (ORDER BY f_score DESC, feature) AS i FROM tested)"
    " SELECT feature, round(f_score, 5) AS f_score, round(log10(p_value), 4) AS log10_p FROM k WHERE i <= 5",
)
def select_k_best(spark, sf):
    from phenoloom.operators.selection import select_k_best

    best = select_k_best(K.docs(spark, sf).cells(), 5)
    return best.select("feature", r("f_score", 5).alias("f_score"), r(F.log10("p_value"), 4).alias("log10_p"))


@query(
    "feature_variance",
    f"WITH {K.sql_vector_cells(1)} SELECT feature, round(var_samp(value), 6) AS variance, round(var_pop(value), 6) AS variance_pop, var_pop(value) > 0.015 AS selected FROM cells GROUP BY 1",
)
def feature_variance(spark, sf):
    return tidy(A.variances(K.vectors(spark, sf, 1).cells(), 0.015))


@query(
    "variance_threshold",
    f"WITH {K.sql_doc_cells()} SELECT feature FROM cells GROUP BY 1 HAVING var_pop(value) > 10",
)
def variance_threshold(spark, sf):
    return A.variances(K.docs(spark, sf).cells(), 10.0).where("selected").select("feature")


# --- multiple testing and selection ----------------------------------------------------------------------------------

_P9 = f"WITH {sql_pearson(K.sql_vector_cells(9))}, {SQL_BH}"
_P1 = f"WITH {sql_pearson(K.sql_vector_cells(1))}, {SQL_BH}"
_PQ = f"WITH {sql_pearson(K.sql_doc_cells())}, {SQL_BH}"
_PT = f"WITH {sql_pearson(K.sql_doc_cells('toxic'))}, {SQL_BH}"


@query("bh_adjust", f"{_P9} SELECT feature, round(p_value, 6) AS p_value, round(p_adjusted, 6) AS p_adjusted FROM flags")
def bh_adjust(spark, sf):
    return tidy(pearson_flags(K.vectors(spark, sf, 9).cells()).select("feature", "p_value", "p_adjusted"))


@query(
    "bh_by_group",
    f"""WITH {K.SQL_LINES}, c0 AS (SELECT outcome, line, feature, value FROM (UNPIVOT lines ON quantity, price, discount, tax INTO NAME feature VALUE value)),
 rr AS (SELECT line, feature, count(*) AS n, corr(value, outcome) AS r FROM c0 GROUP BY ALL),
 rt AS (SELECT *, r * sqrt((n - 2) / (1 - r * r)) AS t, CAST(n - 2 AS DOUBLE) AS df FROM rr), tested AS (SELECT line, feature, {sql_t_p('t', 'df')} AS p_value FROM rt),
 w AS (SELECT *, row_number() OVER (PARTITION BY line ORDER BY p_value, feature) AS i, count(*) OVER (PARTITION BY line) AS m FROM tested)
 SELECT CAST(line AS BIGINT) AS line, feature, round(least(1.0, min(p_value * m / i) OVER (PARTITION BY line ORDER BY i DESC ROWS UNBOUNDED PRECEDING)), 6) AS p_adjusted FROM w""",
)
def bh_by_group(spark, sf):
    wide = K.arrays_from_wide(K.line_table(spark, sf), K.LINE_FEATURES, ["outcome", "line"])
    cells = K.cells_from_arrays(wide, K.LINE_FEATURES, ["outcome", "line"])
    per = cells.groupBy("line", "feature").agg(F.count("*").alias("n"), F.corr("value", F.col("outcome").cast("double")).alias("r"))
    return tidy(A.adjust_fdr(A.with_correlation_p(per), ["line"]).select("line", "feature", "p_adjusted"))


@query("bonferroni_flags", f"{_PQ} SELECT feature, pass_bonf, fdr_significant, nominal_significant FROM flags")
def bonferroni_flags(spark, sf):
    return pearson_flags(K.docs(spark, sf).cells()).select("feature", "pass_bonf", "fdr_significant", "nominal_significant")


@query("select_fdr", f"{_PQ} SELECT feature FROM flags WHERE fdr_significant ORDER BY p_value, feature LIMIT 200")
def select_fdr(spark, sf):
    return A.select_by_strategy(pearson_flags(K.docs(spark, sf).cells()), "fdr_significant").select("feature")


@query("select_nominal", f"{_P1} SELECT feature FROM flags WHERE nominal_significant ORDER BY p_value, feature LIMIT 200")
def select_nominal(spark, sf):
    return A.select_by_strategy(pearson_flags(K.vectors(spark, sf, 1).cells()), "nominal_significant").select("feature")


@query("select_top_n", f"{_P1} SELECT feature FROM flags ORDER BY p_value, feature LIMIT 10")
def select_top_n(spark, sf):
    return A.select_by_strategy(pearson_flags(K.vectors(spark, sf, 1).cells()), "top_n", 10).select("feature")


def _sql_fallback(base: str, min_hits: int, cap: int | None, top: int) -> str:
    limited = f" ORDER BY p_value, feature LIMIT {cap}" if cap else ""
    return f"""{base}, h AS (SELECT CASE WHEN count(*) FILTER (fdr_significant) >= {min_hits} THEN 'fdr'
   WHEN count(*) FILTER (nominal_significant) >= {min_hits} THEN 'nominal' ELSE 'top_n' END AS rule FROM flags),
 hit AS (SELECT feature, rule FROM flags, h WHERE (rule = 'fdr' AND fdr_significant) OR (rule = 'nominal' AND nominal_significant){limited}),
 top AS (SELECT feature, rule FROM flags, h WHERE rule = 'top_n' ORDER BY p_value, feature LIMIT {top})
 SELECT * FROM hit UNION ALL SELECT * FROM top"""


def _fallback(cohort, min_hits: int, cap: int | None, top: int):
    def run(spark, sf):
        return A.select_with_fallback(pearson_flags(cohort(spark, sf).cells()), min_hits, cap, top).select("feature", "rule")

    return run


for _name, _cohort, _base in (
    ("quality", lambda s, d: K.docs(s, d), _PQ),
    ("toxic", lambda s, d: K.docs(s, d, "toxic"), _PT),
    ("vector_1", lambda s, d: K.vectors(s, d, 1), _P1),
    ("vector_9", lambda s, d: K.vectors(s, d, 9), _P9),
):
    # two hits needed and no cap, or one hit and a cap: the two published rules
    query(f"select_fallback_two_{_name}", _sql_fallback(_base, 2, None, 5))(_fallback(_cohort, 2, None, 5))
    query(f"select_fallback_one_{_name}", _sql_fallback(_base, 1, 200, 5))(_fallback(_cohort, 1, 200, 5))


@query(
    "pwas_summary",
    f"""{_P9}, x AS (SELECT f.*, e.effect FROM flags f JOIN (SELECT feature, avg(value) FILTER (outcome = 1) - avg(value) FILTER (outcome = 0) AS effect FROM cells GROUP BY 1) e USING (feature))
 SELECT count(*) AS total_tested, count(*) FILTER (fdr_significant) AS fdr_significant_count, count(*) FILTER (pass_bonf) AS bonferroni_significant_count,
 count(*) FILTER (nominal_significant) AS nominal_significant_count, round(min(p_value), 6) AS min_p_value, arg_min(feature, p_value) AS top_feature,
 round(avg(effect), 6) AS mean_effect, round(stddev_samp(effect), 6) AS std_effect FROM x""",
)
def pwas_summary(spark, sf):
    cells = K.vectors(spark, sf, 9).cells()
    results = pearson_flags(cells).join(A.two_group(cells).select("feature", "effect"), "feature")
    return tidy(A.summarise(results))


@query(
    "correlation_of_results",
    f"""WITH {K.SQL_IMPORTANCES}, s AS (SELECT feature, avg(importance) AS a, median(importance) AS b FROM importances GROUP BY 1),
 q AS (SELECT count(*) AS n, corr(a, b) AS r FROM s WHERE a IS NOT NULL AND b IS NOT NULL), t AS (SELECT n, r, r * sqrt((n - 2) / (1 - r * r)) AS t, CAST(n - 2 AS DOUBLE) AS df FROM q)
 SELECT n, round(r, 6) AS r, round(log10({sql_t_p('t', 'df')}), 3) AS log10_p FROM t""",
)
def correlation_of_results(spark, sf):
    stats = I.importance_stats(K.importances(spark, sf))
    t = A.correlation_test(stats, "imp_mean", "imp_median")
    return t.select("n", r("r").alias("r"), r(F.log10("p_value"), 3).alias("log10_p"))


# --- covariate-adjusted coefficients ---------------------------------------------------------------------------------


def sql_newton(cells: str, rounds: int) -> str:
    """Newton steps for intercept, feature and one covariate written out, the 3 x 3 system solved by Cramer's rule."""
    parts = [
        cells,
        "b0 AS MATERIALIZED (SELECT feature, 0.0::DOUBLE AS a, 0.0::DOUBLE AS b, 0.0::DOUBLE AS c FROM cells GROUP BY 1)",
    ]
    for k in range(rounds):
        parts.append(
            f"""m{k} AS (SELECT feature, x, z, y, w, b{k}.a, b{k}.b, b{k}.c, 1 / (1 + exp(-(b{k}.a + b{k}.b * x + b{k}.c * z))) AS mu FROM cells JOIN b{k} USING (feature)),
 s{k} AS (SELECT feature, any_value(a) AS a, any_value(b) AS b, any_value(c) AS c, sum(w * (mu - y)) AS g0, sum(w * (mu - y) * x) + any_value(b) AS g1,
   sum(w * (mu - y) * z) + any_value(c) AS g2, sum(w * mu * (1 - mu)) AS p, sum(w * mu * (1 - mu) * x) AS q, sum(w * mu * (1 - mu) * z) AS r,
   sum(w * mu * (1 - mu) * x * x) + 1 AS s, sum(w * mu * (1 - mu) * x * z) AS t, sum(w * mu * (1 - mu) * z * z) + 1 AS u FROM m{k} GROUP BY 1),
 d{k} AS (SELECT *, p * (s * u - t * t) - q * (q * u - t * r) + r * (q * t - s * r) AS det FROM s{k}),
 b{k + 1} AS MATERIALIZED (SELECT feature,
   a - (g0 * (s * u - t * t) - q * (g1 * u - t * g2) + r * (g1 * t - s * g2)) / det AS a,
   b - (p * (g1 * u - t * g2) - g0 * (q * u - t * r) + r * (q * g2 - g1 * r)) / det AS b,
   c - (p * (s * g2 - g1 * t) - q * (q * g2 - g1 * r) + g0 * (q * t - s * r)) / det AS c FROM d{k})"""
        )
    return ",\n ".join(parts)


_LOGIT_CELLS = f"""{K.sql_vector_cells(1)}"""
_LOGIT = _LOGIT_CELLS.replace("cells AS (", "cells0 AS (") + (
    ", cells AS (SELECT feature, value AS x, (sample_id % 7) / 7.0 AS z, CAST(outcome AS DOUBLE) AS y, 1.0 AS w FROM cells0)"
)


@query(
    "logit_by_feature",
    f"WITH {sql_newton(_LOGIT, 10)} SELECT feature, round(b, 5) AS coefficient, round(exp(b), 5) AS odds_ratio, true AS converged FROM b10",
)
def logit_by_feature(spark, sf):
    c = K.vectors(spark, sf, 1)
    matrix = c.joined().withColumn("z", F.pmod("sample_id", F.lit(7)) / 7.0)
    out = A.associate_adjusted(matrix, c.names, ["z"])
    return out.select("feature", r("effect", 5).alias("coefficient"), r("odds_ratio", 5).alias("odds_ratio"), "converged")


# --- importance tables -----------------------------------------------------------------------------------------------

_STATS = f"""WITH {K.SQL_IMPORTANCES}, s AS (SELECT feature, avg(importance) AS imp_mean, median(importance) AS imp_median, stddev_samp(importance) AS imp_sd,
 count(importance) AS nr_notna FROM importances GROUP BY 1),
 ranked AS (SELECT *, row_number() OVER (ORDER BY round(imp_mean, 9) DESC NULLS LAST, feature) AS rank FROM s)"""


def _stats(spark, sf) -> DataFrame:
    return I.importance_stats(K.importances(spark, sf)).withColumn("imp_mean", F.round("imp_mean", 9))


@query("importance_stats", f"{_STATS} SELECT feature, round(imp_mean, 6) AS imp_mean, round(imp_median, 6) AS imp_median, round(imp_sd, 6) AS imp_sd, nr_notna FROM s")
def importance_stats(spark, sf):
    return tidy(I.importance_stats(K.importances(spark, sf)))


@query("first_repeats", f"WITH {K.SQL_IMPORTANCES} SELECT feature, count(*) AS n, count(importance) AS used FROM importances WHERE repeat <= 3 GROUP BY 1")
def first_repeats(spark, sf):
    kept = I.first_repeats(K.importances(spark, sf), 3)
    return kept.groupBy("feature").agg(F.count("*").alias("n"), F.count("importance").alias("used"))


@query("rank_importance", f"{_STATS} SELECT feature, rank, round(imp_mean, 6) AS imp_mean FROM ranked WHERE imp_mean IS NOT NULL")
def rank_importance(spark, sf):
    return tidy(I.rank_importance(_stats(spark, sf)).select("feature", "rank", "imp_mean"))


@query(
    "cum_share",
    f"""{_STATS}, k AS (SELECT feature, imp_mean / sum(imp_mean) OVER () AS share, sum(imp_mean) OVER (ORDER BY rank ROWS UNBOUNDED PRECEDING) / sum(imp_mean) OVER () AS cum_share
 FROM ranked WHERE imp_mean IS NOT NULL) SELECT feature, round(share, 6) AS share, round(cum_share, 6) AS cum_share FROM k""",
)
def cum_share(spark, sf):
    ranked = _stats(spark, sf).where("imp_mean is not null")
    return tidy(I.cumulative_share(ranked).select("feature", "share", "cum_share"))


@query("top_features", f"{_STATS} SELECT feature FROM ranked WHERE rank <= 8")
def top_features(spark, sf):
    table = _stats(spark, sf).withColumn("importance", F.col("imp_mean"))
    return I.top_features(table, 8).select("feature")


@query("features_over_threshold", f"{_STATS} SELECT feature FROM s WHERE round(imp_mean, 9) >= 0.02")
def features_over_threshold(spark, sf):
    table = _stats(spark, sf).withColumn("importance", F.col("imp_mean"))
    return I.top_features(table, threshold=0.02, method="threshold").select("feature")


@query("remove_disallowed", f"{_STATS} SELECT feature FROM s WHERE imp_mean IS NOT NULL AND feature NOT IN ('v01', 'v05')")
def remove_disallowed(spark, sf):
    stats = _stats(spark, sf).where("imp_mean is not null")
    barred = stats.where(F.col("feature").isin("v01", "v05")).select("feature")
    return stats.join(barred, "feature", "left_anti").select("feature")


@query(
    "force_covariates",
    f"{_STATS} SELECT feature FROM ranked WHERE rank <= 6 UNION SELECT unnest(['age', 'sex', 'bmi', 'v02'])",
)
def force_covariates(spark, sf):
    from phenoloom.operators.selection import with_forced

    ranked = I.rank_importance(_stats(spark, sf))
    return with_forced(ranked.where("rank <= 6"), ["age", "sex", "bmi", "v02"]).select("feature")


@query(
    "importance_with_association",
    f"""WITH {sql_pearson(K.SQL_IMPORTANCES)}, s AS (SELECT feature, avg(importance) AS imp_mean FROM importances GROUP BY 1)
 SELECT s.feature, round(imp_mean, 6) AS imp_mean, round(t.p_value, 6) AS p_value FROM s LEFT JOIN (SELECT * FROM tested WHERE p_value < 0.5) t USING (feature)""",
)
def importance_with_association(spark, sf):
    stats = I.importance_stats(K.importances(spark, sf))
    p = A.pearson(K.vectors(spark, sf, 1).cells()).where("p_value < 0.5")
    return tidy(lookup(stats.select("feature", "imp_mean"), p, "feature", "feature", {"p_value": "p_value"}))


@query(
    "mtry_grid",
    """WITH p AS (SELECT max(len(embedding)) AS p FROM embeddings), b AS (SELECT ceil(sqrt(p)) AS b FROM p)
 SELECT CAST(ceil(b * s) AS BIGINT) AS mtry FROM b, (SELECT unnest([0.6::DOUBLE, 0.8, 1, 1.2]) AS s)""",
)
def mtry_grid(spark, sf):
    n = K.vectors(spark, sf, 1).matrix.agg(F.max(F.size("features")).alias("p")).first()["p"]
    return spark.createDataFrame([(m,) for m in I.tuning_grid(n)], "mtry long")


# --- mutual information ----------------------------------------------------------------------------------------------


@query(
    "binned_mi",
    f"""WITH {K.sql_doc_cells()}, o AS (SELECT feature, outcome AS y, value, row_number() OVER (PARTITION BY feature ORDER BY value) - 1 AS i, count(*) OVER (PARTITION BY feature) AS n FROM cells),
 e AS (SELECT o.feature, k.k, o.value AS edge FROM o JOIN range(1, 10) k(k) ON o.i = floor((o.n - 1) * (k.k / 10.0::DOUBLE))),
 b AS (SELECT o.feature, o.y, (SELECT count(*) FROM e WHERE e.feature = o.feature AND o.value > e.edge) AS bin FROM o),
 c AS (SELECT feature, bin, y, count(*) AS c FROM b GROUP BY ALL),
 t AS (SELECT feature, c / sum(c) OVER (PARTITION BY feature) * ln(c * sum(c) OVER (PARTITION BY feature) / (sum(c) OVER (PARTITION BY feature, bin) * sum(c) OVER (PARTITION BY feature, y))) AS t FROM c)
 SELECT feature, round(greatest(0.0, sum(t)), 6) AS mutual_info FROM t GROUP BY 1""",
)
def binned_mi(spark, sf):
    return tidy(I.binned_mi(K.docs(spark, sf).stored().cells()))


_KNN = f"""WITH {K.sql_vector_cells(9)}, w AS (SELECT feature, sample_id, outcome AS y, value AS x FROM cells),
 ny AS (SELECT feature, y, count(*) AS ny FROM w GROUP BY ALL),
 nb AS (SELECT a.feature, a.sample_id, any_value(a.x) AS x, any_value(a.y) AS y, min(abs(a.x - b.x), 3) AS g FROM w a JOIN w b ON a.feature = b.feature AND a.y = b.y AND a.sample_id <> b.sample_id GROUP BY 1, 2),
 d AS (SELECT nb.feature, sample_id, x, ny.ny, len(g) AS k, g[len(g)] AS d FROM nb JOIN ny ON ny.feature = nb.feature AND ny.y = nb.y),
 m AS (SELECT d.feature, d.sample_id, any_value(k) AS k, any_value(ny) AS ny, count(*) AS m FROM d JOIN w ON w.feature = d.feature
   AND ((d.d > 0 AND w.x < d.x + d.d AND w.x > d.x - d.d) OR (d.d = 0 AND w.x = d.x)) GROUP BY 1, 2)
 SELECT feature, round(greatest(0.0, {sql_digamma('count(*)')} + avg({sql_digamma('k')} - {sql_digamma('ny')} - {sql_digamma('m')})), 6) AS mutual_info FROM m GROUP BY 1"""


@query("neighbour_mi", _KNN)
def neighbour_mi(spark, sf):
    return tidy(I.neighbour_mi(K.vectors(spark, sf, 9).cells(), "sample_id"))


@query(
    "compare_importance",
    f"""{_ANOVA2}, o AS (SELECT feature, outcome AS y, value, row_number() OVER (PARTITION BY feature ORDER BY value) - 1 AS i, count(*) OVER (PARTITION BY feature) AS n FROM cells),
 e AS (SELECT o.feature, k.k, o.value AS edge FROM o JOIN range(1, 10) k(k) ON o.i = floor((o.n - 1) * (k.k / 10.0::DOUBLE))),
 b AS (SELECT o.feature, o.y, (SELECT count(*) FROM e WHERE e.feature = o.feature AND o.value > e.edge) AS bin FROM o),
 c AS (SELECT feature, bin, y, count(*) AS c FROM b GROUP BY ALL),
 t AS (SELECT feature, c / sum(c) OVER (PARTITION BY feature) * ln(c * sum(c) OVER (PARTITION BY feature) / (sum(c) OVER (PARTITION BY feature, bin) * sum(c) OVER (PARTITION BY feature, y))) AS t FROM c),
 mi AS (SELECT feature, greatest(0.0, sum(t)) AS mi FROM t GROUP BY 1)
 SELECT feature, round(f_score, 5) AS f_score, row_number() OVER (ORDER BY f_score DESC, feature) AS f_rank, round(mi, 6) AS binned_mi,
 row_number() OVER (ORDER BY round(mi, 12) DESC, feature) AS mi_rank FROM tested JOIN mi USING (feature)""",
)
def compare_importance(spark, sf):
    cells = K.docs(spark, sf).stored().cells()
    t = I.compare_importance(cells, "sample_id", methods=("f", "binned_mi"))
    return t.select(
        "feature",
        r("f_score", 5).alias("f_score"),
        F.col("f_score_rank").alias("f_rank"),
        r("binned_mi").alias("binned_mi"),
        F.col("binned_mi_rank").alias("mi_rank"),
    )
