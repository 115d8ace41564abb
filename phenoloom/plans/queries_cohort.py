"""Catalogue: sources, projections, joins, counts, sets, scalar functions."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from phenoloom.functions import scalar as S
from phenoloom.operators import cohort as C
from phenoloom.operators import shape
from phenoloom.plans import cohorts as K
from phenoloom.plans.registry import query, r, tidy
from phenoloom.session import shared_folder
from phenoloom.sources import tables as IO


def scratch(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/out-{uuid.uuid4().hex}"


# --- alignment -------------------------------------------------------------------------------------------------------


@query(
    "align_inner",
    f"WITH {K.SQL_DOCS} SELECT d.sample_id, d.n_chars, CAST(l.quality AS BIGINT) AS quality FROM docs d JOIN labels l ON l.doc_id = d.sample_id",
)
def align_inner(spark: SparkSession, sf: str) -> DataFrame:
    labels = K.table(spark, sf, "labels").withColumnRenamed("doc_id", "sample_id")
    return tidy(C.align(K.doc_table(spark, sf), labels, "sample_id").select("sample_id", "n_chars", "quality"))


@query(
    "align_drop_counts",
    """SELECT (SELECT count(*) FROM documents) AS n_features, (SELECT count(*) FROM labels) AS n_pheno, c AS n_common,
 (SELECT count(*) FROM documents) - c AS dropped_features, (SELECT count(*) FROM labels) - c AS dropped_pheno
 FROM (SELECT count(*) AS c FROM documents JOIN labels USING (doc_id))""",
)
def align_drop_counts(spark, sf):
    return tidy(C.alignment_counts(K.table(spark, sf, "documents"), K.table(spark, sf, "labels"), "doc_id"))


# --- projection ------------------------------------------------------------------------------------------------------

_MODES = {
    "prot_only": 'SELECT m.sample_id, "P1", "P2", "P3" FROM matrix m',
    "covs": 'SELECT m.sample_id, "Sex", CAST("Age_at_recruitment" AS BIGINT) AS "Age_at_recruitment", round("BMI", 6) AS "BMI" FROM matrix m JOIN pheno p USING (sample_id)',
    "comb": 'SELECT m.sample_id, "P1", "P2", "P3", "Sex", CAST("Age_at_recruitment" AS BIGINT) AS "Age_at_recruitment", round("BMI", 6) AS "BMI" FROM matrix m JOIN pheno p USING (sample_id)',
}


def _mode(mode: str):
    def run(spark: SparkSession, sf: str) -> DataFrame:
        matrix, pheno = K.people(spark, sf)
        return tidy(C.project_mode(matrix, pheno, mode, "sample_id"))

    return run


for _name, _arg in (("prot_only", "prot_only"), ("covs", "sexagebmi"), ("comb", "comb")):
    query(f"mode_{_name}", f"WITH {K.SQL_PEOPLE} {_MODES[_name]}")(_mode(_arg))


@query(
    "exclude_covariates",
    f"WITH {K.SQL_LINE_CELLS} SELECT feature, count(*) AS n, round(sum(value), 4) AS total FROM cells WHERE feature NOT IN ('tax') GROUP BY 1",
)
def exclude_covariates(spark, sf):
    kept = C.exclude_features(K.line_cells(spark, sf), ["tax"])
    return tidy(kept.groupBy("feature").agg(F.count("*").alias("n"), F.sum("value").alias("total")), 4)


@query(
    "select_named_features",
    f"WITH {K.SQL_LINE_CELLS} SELECT feature, count(*) AS n, round(avg(value), 6) AS mean FROM cells WHERE feature IN ('tax', 'price') GROUP BY 1",
)
def select_named_features(spark, sf):
    kept = C.select_features(K.line_cells(spark, sf), ["tax", "price", "absent"], K.LINE_FEATURES)
    return tidy(kept.groupBy("feature").agg(F.count("*").alias("n"), F.avg("value").alias("mean")))


@query("rename_covariates", f'WITH {K.SQL_PEOPLE} SELECT sample_id, CAST("Age_at_recruitment" AS BIGINT) AS age, "Sex" AS sex FROM pheno')
def rename_covariates(spark, sf):
    return tidy(C.rename_covariates(K.people(spark, sf)[1]).select("sample_id", "age", "sex"))


@query(
    "recode_category",
    f"""WITH {K.SQL_PEOPLE} SELECT sample_id, CAST(CASE "Sex" WHEN 'Male' THEN 0 WHEN 'Female' THEN 1 END AS BIGINT) AS male_zero,
 CAST(CASE "Sex" WHEN 'Male' THEN 1 WHEN 'Female' THEN 0 END AS BIGINT) AS male_one FROM pheno""",
)
def recode_category(spark, sf):
    pheno = K.people(spark, sf)[1]
    sex = F.col(C.find_covariates(pheno.columns)["sex"])
    return tidy(pheno.select("sample_id", C.recode(sex, C.SEX_MALE_ZERO).alias("male_zero"), C.recode(sex, C.SEX_MALE_ONE).alias("male_one")))


@query("outcome_levels", f'WITH {K.SQL_PEOPLE} SELECT DISTINCT CAST("AOD_case_t0" AS BIGINT) AS level FROM pheno ORDER BY 1')
def outcome_levels(spark, sf):
    return tidy(C.outcome_levels(C.with_outcome(K.people(spark, sf)[1], "case_t0"), "outcome"))


@query("drop_missing_cov", f'WITH {K.SQL_PEOPLE} SELECT m.* FROM matrix m WHERE sample_id IN (SELECT sample_id FROM pheno WHERE "BMI" IS NOT NULL)')
def drop_missing_cov(spark, sf):
    matrix, pheno = K.people(spark, sf)
    return tidy(C.drop_missing(matrix, pheno, "BMI", "sample_id")[0])


@query(
    "coerce_covariate",
    "SELECT o_orderkey, TRY_CAST(substr(o_orderpriority, 1, 1) AS DOUBLE) AS priority, TRY_CAST(o_orderstatus AS DOUBLE) AS status FROM orders",
)
def coerce_covariate(spark, sf):
    o = K.table(spark, sf, "orders")
    return tidy(
        o.select("o_orderkey", C.to_number(F.substring("o_orderpriority", 1, 1)).alias("priority"), C.to_number(F.col("o_orderstatus")).alias("status"))
    )


@query(
    "finite_feature_filter",
    f"WITH {K.sql_vector_cells(1)}, bad AS (SELECT feature, CASE WHEN pos % 5 = 2 AND sample_id % 50 = 3 THEN NULL ELSE value END AS value FROM cells)"
    " SELECT feature FROM bad GROUP BY 1 HAVING bool_and(value IS NOT NULL)",
)
def finite_feature_filter(spark, sf):
    cells = K.vectors(spark, sf, 1).cells()
    pos = F.substring("feature", 2, 2).cast("int")
    hole = (pos % 5 == 2) & (F.col("sample_id") % 50 == 3)
    return C.complete_features(cells.withColumn("value", F.when(hole, F.lit(float("nan"))).otherwise(F.col("value"))))


@query("unpivot_wide", f"WITH {K.SQL_DOCS} SELECT sample_id, feature, round(value, 6) AS value FROM (UNPIVOT docs ON {', '.join(K.DOC_FEATURES)} INTO NAME feature VALUE value)")
def unpivot_wide(spark, sf):
    return tidy(shape.cells_from_wide(K.doc_table(spark, sf), K.DOC_FEATURES, ["sample_id"]))


_PIVOT = ", ".join(f"round(avg(value) FILTER (event_type = '{t}'), 6) AS \"{t}\"" for t in K.EVENT_TYPES)


@query("pivot_long", f"SELECT user_id, {_PIVOT} FROM events GROUP BY 1")
def pivot_long(spark, sf):
    cells = K.table(spark, sf, "events").groupBy("user_id", F.col("event_type").alias("feature")).agg(F.avg("value").alias("value"))
    return tidy(shape.wide_from_cells(cells, K.EVENT_TYPES, ["user_id"]))


@query(
    "cells_to_arrays",
    f"WITH {K.sql_vector_cells(1, holes=True)} SELECT sample_id, count(value) AS n_present, round(sum(value * (pos + 1)), 6) AS signature FROM cells GROUP BY 1",
)
def cells_to_arrays(spark, sf):
    cells = K.vectors(spark, sf, 1, holes=True).cells(("sample_id",))
    back = shape.arrays_from_cells(cells, K.VECTOR_FEATURES, ["sample_id"])
    present = F.size(F.filter("features", lambda x: x.isNotNull()))
    weighted = F.aggregate(F.transform("features", lambda x, i: F.coalesce(x, F.lit(0.0)) * (i + 1)), F.lit(0.0), lambda a, x: a + x)
    return tidy(back.select("sample_id", present.alias("n_present"), weighted.alias("signature")))


@query(
    "add_covariates",
    f'WITH {K.SQL_PEOPLE} SELECT m.sample_id, "P1" AS "P1", CAST("Age_at_recruitment" AS DOUBLE) AS "Age_at_recruitment", round("BMI", 6) AS "BMI" FROM matrix m JOIN pheno USING (sample_id)',
)
def add_covariates(spark, sf):
    matrix, pheno = K.people(spark, sf)
    arrays = shape.arrays_from_wide(matrix, ["P1"], ["sample_id"])
    wide, names = C.append_covariates(arrays, ["P1"], pheno, ["Age_at_recruitment", "BMI"], "sample_id")
    return tidy(shape.wide_from_arrays(wide, names, ["sample_id"]))


# --- joins -----------------------------------------------------------------------------------------------------------


@query(
    "lookup_left",
    "SELECT o_orderkey, CASE WHEN c_custkey % 3 <> 0 THEN c_acctbal END AS covariate FROM orders LEFT JOIN customer ON c_custkey = o_custkey",
)
def lookup_left(spark, sf):
    orders = K.table(spark, sf, "orders").select("o_orderkey", F.col("o_custkey").alias("sample_id"))
    known = K.table(spark, sf, "customer").where(F.col("c_custkey") % 3 != 0)
    return C.lookup(orders, known, "sample_id", "c_custkey", {"c_acctbal": "covariate"}).select("o_orderkey", "covariate")


@query(
    "annotate_features",
    """SELECT l_partkey AS feature, round(avg(l_quantity), 6) AS mean, any_value(p_name) AS feature_name FROM lineitem
 LEFT JOIN part ON p_partkey = l_partkey GROUP BY 1""",
)
def annotate_features(spark, sf):
    per = K.table(spark, sf, "lineitem").groupBy(F.col("l_partkey").alias("feature")).agg(F.avg("l_quantity").alias("mean"))
    annotation = IO.unique_key(K.table(spark, sf, "part"), "p_partkey")
    return tidy(C.lookup(per, annotation, "feature", "p_partkey", {"p_name": "feature_name"}))


@query("rows_for_samples", "SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')")
def rows_for_samples(spark, sf):
    listed = K.table(spark, sf, "customer").where(F.col("c_mktsegment") == "BUILDING").select(F.col("c_custkey").alias("o_custkey"))
    return C.rows_for(K.table(spark, sf, "orders").select("o_orderkey", "o_custkey"), listed, "o_custkey")


@query(
    "cells_with_covariates",
    f"WITH {K.sql_doc_cells()} SELECT feature, outcome, count(*) AS n, round(avg(value * log(1 + d.n_chars)), 5) AS weighted FROM cells JOIN documents d ON d.doc_id = sample_id GROUP BY 1, 2",
)
def cells_with_covariates(spark, sf):
    c = K.docs(spark, sf)
    cov = K.table(spark, sf, "documents").select(F.col("doc_id").alias("sample_id"), F.log10(1 + F.col("n_chars")).alias("size"))
    joined = c.joined().join(cov, "sample_id")
    cells = shape.cells_from_arrays(joined, c.names, ["outcome", "size"])
    agg = cells.groupBy("feature", F.col("outcome").cast("int").alias("outcome")).agg(
        F.count("*").alias("n"), F.avg(F.col("value") * F.col("size")).alias("weighted")
    )
    return agg.select("feature", "outcome", "n", r("weighted", 5).alias("weighted"))


# --- counts ----------------------------------------------------------------------------------------------------------


@query("target_distribution", "SELECT CAST(quality AS BIGINT) AS level, count(*) AS n FROM labels GROUP BY 1")
def target_distribution(spark, sf):
    return tidy(C.target_distribution(K.table(spark, sf, "labels"), "quality"))


@query(
    "imbalance_ratio",
    """WITH c AS (SELECT label, count(*) AS n FROM embeddings GROUP BY 1)
 SELECT count(*) AS n_classes, round(max(n) / min(n), 6) AS imbalance_ratio, max(n) / min(n) > 10 AS severe, count(*) >= 2 AS compatible FROM c""",
)
def imbalance_ratio(spark, sf):
    return tidy(C.imbalance(K.table(spark, sf, "embeddings"), "label"))


@query("missing_cells", f'WITH {K.SQL_PEOPLE} SELECT CAST(sum(("Sex" IS NULL)::INT + ("BMI" IS NULL)::INT) AS BIGINT) AS n_missing, count(*) AS n_rows FROM pheno')
def missing_cells(spark, sf):
    pheno = K.people(spark, sf)[1]
    return tidy(C.missing_cells(pheno, [c for c in pheno.columns if c != "sample_id"]))


@query(
    "impute_median",
    f"""WITH {K.sql_vector_cells(1, holes=True)}, med AS (SELECT feature, quantile_cont(value, 0.5) AS median FROM cells GROUP BY 1)
 SELECT sample_id, feature, round(coalesce(value, median), 6) AS value FROM cells JOIN med USING (feature)""",
)
def impute_median(spark, sf):
    cells = K.vectors(spark, sf, 1, holes=True).cells(("sample_id",))
    return tidy(C.impute_cells(cells).select("sample_id", "feature", "value"))


@query(
    "impute_median_mode",
    f"""WITH {K.SQL_PEOPLE}, m AS (SELECT "Sex" AS v FROM pheno WHERE "Sex" IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)
 SELECT sample_id, CAST("Age_at_recruitment" AS DOUBLE) AS age, coalesce("Sex", (SELECT v FROM m)) AS sex,
 round(coalesce("BMI", (SELECT quantile_cont("BMI", 0.5) FROM pheno)), 6) AS bmi FROM pheno""",
)
def impute_median_mode(spark, sf):
    pheno = K.people(spark, sf)[1]
    filled = C.impute_table(pheno, ["sample_id", "AOD_case_t0"])
    return tidy(filled.select("sample_id", F.col("Age_at_recruitment").alias("age"), F.col("Sex").alias("sex"), F.col("BMI").alias("bmi")))


@query(
    "category_modes",
    """WITH t AS (SELECT 'o_orderstatus' AS feature, o_orderstatus AS v FROM orders UNION ALL SELECT 'o_orderpriority', o_orderpriority FROM orders),
 c AS (SELECT feature, v, count(*) AS n FROM t GROUP BY ALL) SELECT feature, arg_min(v, (-n, v)) AS mode FROM c GROUP BY 1""",
)
def category_modes(spark, sf):
    return C.category_modes(K.table(spark, sf, "orders"), ["o_orderstatus", "o_orderpriority"])


@query("distinct_counts", "SELECT count(*) AS n, count(DISTINCT o_custkey) AS n_samples, count(DISTINCT o_orderpriority) AS n_levels FROM orders")
def distinct_counts(spark, sf):
    o = K.table(spark, sf, "orders")
    return o.agg(F.count("*").alias("n"), F.count_distinct("o_custkey").alias("n_samples"), F.count_distinct("o_orderpriority").alias("n_levels"))


@query(
    "covariate_profile",
    f"""WITH {K.SQL_PEOPLE} SELECT 'BMI' AS covariate, min("BMI") AS min_value, max("BMI") AS max_value, bool_or("BMI" IS NULL) AS has_null FROM pheno
 UNION ALL SELECT 'Age_at_recruitment', min("Age_at_recruitment")::DOUBLE, max("Age_at_recruitment")::DOUBLE, bool_or("Age_at_recruitment" IS NULL) FROM pheno""",
)
def covariate_profile(spark, sf):
    return C.covariate_profile(K.people(spark, sf)[1], ["BMI", "Age_at_recruitment"])


@query(
    "compat_report",
    f"""WITH {K.SQL_PEOPLE}, n AS (SELECT (SELECT count(*) FROM matrix) AS nf, (SELECT count(*) FROM pheno) AS np,
   (SELECT count(*) FROM pheno WHERE "Sex" IS NULL) + (SELECT count(*) FROM pheno WHERE "BMI" IS NULL) AS pm),
 k AS (SELECT "AOD_case_t0", count(*) AS n FROM pheno GROUP BY 1), i AS (SELECT count(*) AS c, max(n) / min(n) AS ratio FROM k)
 SELECT 'sample_count' AS "check", CASE WHEN nf = np THEN 'ok' ELSE 'error' END AS level, CAST(nf - np AS DOUBLE) AS value, NULL::VARCHAR AS recommendation FROM n
 UNION ALL SELECT 'feature_missing', 'ok', 0.0, NULL
 UNION ALL SELECT 'phenotype_missing', CASE WHEN pm > 0 THEN 'warn' ELSE 'ok' END, pm, NULL FROM n
 UNION ALL SELECT 'non_numeric_features', 'ok', 0.0, NULL UNION ALL SELECT 'numeric_features', 'ok', 3.0, NULL
 UNION ALL SELECT 'target', CASE WHEN c >= 2 THEN 'ok' ELSE 'error' END, c, NULL FROM i
 UNION ALL SELECT 'imbalance_ratio', CASE WHEN ratio > 10 THEN 'warn' ELSE 'ok' END, round(ratio, 6), CASE WHEN ratio > 10 THEN 'use balanced weights' END FROM i
 UNION ALL SELECT 'compatible', CASE WHEN nf = np AND c >= 2 THEN 'ok' ELSE 'error' END, CAST(CAST(nf = np AND c >= 2 AS INT) AS DOUBLE), NULL FROM n, i""",
)
def compat_report(spark, sf):
    matrix, pheno = K.people(spark, sf)
    return tidy(C.compatibility_report(matrix, pheno, "AOD_case_t0", "sample_id"))


@query(
    "prepare_matrices",
    f"""WITH {K.SQL_PEOPLE}, j AS (SELECT m.sample_id, "P1", "Sex", "Age_at_recruitment" AS age, "BMI" FROM matrix m JOIN pheno USING (sample_id)),
 tr AS (SELECT * FROM j WHERE sample_id % 10 <> 0), md AS (SELECT "Sex" AS v FROM tr WHERE "Sex" IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)
 SELECT sample_id, "P1", coalesce("Sex", (SELECT v FROM md)) AS sex, CAST(age AS DOUBLE) AS age, round(coalesce("BMI", (SELECT quantile_cont("BMI", 0.5) FROM tr)), 6) AS bmi
 FROM j WHERE sample_id % 10 = 0""",
)
def prepare_matrices(spark, sf):
    matrix, pheno = K.people(spark, sf)
    train, val = F.col("sample_id") % 10 != 0, F.col("sample_id") % 10 == 0
    done = C.prepare(matrix.where(train), pheno.where(train), matrix.where(val), pheno.where(val), "comb", "AOD_case_t0")
    return tidy(
        done.val.select("sample_id", "P1", F.col("Sex").alias("sex"), F.col("Age_at_recruitment").alias("age"), F.col("BMI").alias("bmi"))
    )


# --- sets ------------------------------------------------------------------------------------------------------------


@query("id_intersection", "SELECT doc_id FROM documents INTERSECT SELECT doc_id FROM labels")
def id_intersection(spark, sf):
    return K.table(spark, sf, "documents").select("doc_id").intersect(K.table(spark, sf, "labels").select("doc_id"))


@query("name_difference", "SELECT p_name AS feature FROM part EXCEPT SELECT p_name FROM part WHERE p_size > 3")
def name_difference(spark, sf):
    part = K.table(spark, sf, "part").select(F.col("p_name").alias("feature"), "p_size")
    return part.select("feature").subtract(part.where("p_size > 3").select("feature"))


@query(
    "union_rows",
    "SELECT 'events' AS part, count(*) AS n FROM events UNION ALL SELECT 'orders', count(*) FROM orders UNION ALL SELECT 'pages', count(*) FROM pages",
)
def union_rows(spark, sf):
    out = None
    for name in ("events", "orders", "pages"):
        one = K.table(spark, sf, name).agg(F.count("*").alias("n")).select(F.lit(name).alias("part"), "n")
        out = one if out is None else out.unionByName(one)
    return out


# --- scalar functions ------------------------------------------------------------------------------------------------


@query(
    "label_edit",
    """SELECT o_orderkey, 'model_rose_top30rfekeep' || (o_orderkey % 30) || '_rfe' AS label, 'rfe_feat: ' || (o_orderkey % 30) AS note,
 lpad(CAST(o_orderkey % 10 + 1 AS VARCHAR), 2, '0') || '_' || o_orderstatus AS folder FROM orders""",
)
def label_edit(spark, sf):
    kept = F.col("o_orderkey") % 30
    return K.table(spark, sf, "orders").select(
        "o_orderkey",
        S.label_after_elimination(F.lit("model_rose_top30_rfe"), kept).alias("label"),
        S.elimination_note(F.lit("xgb_rfe_top30"), kept).alias("note"),
        S.step_folder(F.col("o_orderkey") % 10 + 1, F.col("o_orderstatus")).alias("folder"),
    )


@query(
    "path_parts",
    """SELECT page_id, CASE page_id % 4 WHEN 0 THEN 'prot_only' WHEN 1 THEN 'prot_and_sexagebmi' WHEN 2 THEN 'sexagebmi' END AS predictors,
 split_part(split_part(url, '/', -1), '.', 1) AS stem FROM pages""",
)
def path_parts(spark, sf):
    folder = F.get(F.array(*[F.lit(x) for x in ("models", "models_comb", "models_sexagebmi", "other")]), (F.col("page_id") % 4).cast("int"))
    return K.table(spark, sf, "pages").select(
        "page_id", S.predictor_type(F.concat(F.lit("/runs/"), folder)).alias("predictors"), S.file_stem(F.col("url")).alias("stem")
    )


@query(
    "clip_and_square",
    """SELECT c_custkey, greatest(-500.0, least(5000.0, c_acctbal)) AS clipped, pow(20 + c_custkey % 66, 2) AS age2,
 CASE WHEN c_custkey % 5 <> 0 THEN round(c_acctbal / (c_custkey % 5), 6) ELSE 0.0 END AS safe, round(sqrt(abs(c_acctbal)), 4) AS root FROM customer""",
)
def clip_and_square(spark, sf):
    from phenoloom.operators.evaluation import ratio

    k = F.col("c_custkey")
    return K.table(spark, sf, "customer").select(
        "c_custkey",
        S.clip(F.col("c_acctbal"), -500.0, 5000.0).alias("clipped"),
        F.pow((20 + k % 66).cast("double"), F.lit(2.0)).alias("age2"),
        F.round(ratio(F.col("c_acctbal"), k % 5), 6).alias("safe"),
        F.round(F.sqrt(F.abs("c_acctbal")), 4).alias("root"),
    )


@query(
    "array_functions",
    """WITH t AS (SELECT user_id, list(DISTINCT event_type ORDER BY event_type) AS a, count(*) AS n FROM events GROUP BY 1)
 SELECT user_id, len(a) AS n_types, list_contains(a, 'click') AS has_click, array_to_string(a[1:3], ',') AS first_three FROM t""",
)
def array_functions(spark, sf):
    a = F.array_sort(F.collect_set("event_type"))
    t = K.table(spark, sf, "events").groupBy("user_id").agg(a.alias("a"))
    return tidy(
        t.select(
            "user_id",
            F.size("a").alias("n_types"),
            F.array_contains("a", "click").alias("has_click"),
            F.array_join(F.slice("a", 1, 3), ",").alias("first_three"),
        )
    )


@query("json_params", "SELECT event_id, CAST(json_extract(props, '$.k') AS VARCHAR) AS k, strftime(ts, '%Y-%m-%d %H:%M:%S') AS started FROM events")
def json_params(spark, sf):
    params = F.from_json("props", "map<string,string>")
    return K.table(spark, sf, "events").select(
        "event_id", F.from_json(F.to_json(params), "map<string,string>")["k"].alias("k"), F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("started")
    )


# --- sources and sinks: written to the shared folder, read back ---------------------------------------------------------


@query("csv_matrix", f"WITH {K.SQL_PEOPLE} SELECT sample_id, \"P1\", \"P2\", \"P3\" FROM matrix")
def csv_matrix(spark, sf):
    matrix, _ = K.people(spark, sf)
    path = scratch(spark)
    IO.write_csv(matrix.withColumnRenamed("sample_id", "Unnamed: 0"), path)
    return IO.read_matrix(spark, path, key_type="long")


@query("tsv_covariates", "SELECT c_custkey AS sample_id, c_acctbal AS bmi FROM customer")
def tsv_covariates(spark, sf):
    path = scratch(spark)
    source = K.table(spark, sf, "customer").select(F.col("c_custkey").alias("ID_1"), F.col("c_acctbal").alias("Body_mass_index_(BMI)"), "c_name")
    IO.write_tsv(source, path, compression="gzip")
    return IO.read_covariates(spark, path, "ID_1", {"Body_mass_index_(BMI)": "bmi"}, key_type="long")


@query("split_tables", "SELECT doc_id, quality FROM labels WHERE doc_id % 10 = 0")
def split_tables(spark, sf):
    path = scratch(spark)
    split = F.when(F.col("doc_id") % 10 == 0, "val").otherwise("train")
    IO.write_partitioned(K.table(spark, sf, "labels").select("doc_id", "quality", split.alias("split")), path, ["split"])
    return IO.read_part(spark, path, split="val").select("doc_id", "quality")


@query("outcome_cohort", "SELECT doc_id, CAST(toxic AS INTEGER) AS outcome FROM labels")
def outcome_cohort(spark, sf):
    path = scratch(spark)
    labels = K.table(spark, sf, "labels")
    both = labels.select("doc_id", F.explode(F.map_from_arrays(F.array(F.lit("quality"), F.lit("toxic")), F.array("quality", "toxic"))).alias("name", "outcome"))
    IO.write_partitioned(both, path, ["name"])
    return IO.read_part(spark, path, name="toxic").select("doc_id", F.col("outcome").cast("int").alias("outcome"))


@query("feature_list_text", "SELECT DISTINCT p_brand AS feature FROM part")
def feature_list_text(spark, sf):
    path = scratch(spark)
    brands = K.table(spark, sf, "part").select(F.col("p_brand").alias("feature")).distinct()
    IO.write_names(brands.withColumn("position", F.substring_index("feature", "#", -1).cast("int")), path, "feature", "position")
    return IO.read_names(spark, path)


@query("json_summary", "SELECT r_regionkey::BIGINT AS key, count(*) AS n FROM nation JOIN region ON n_regionkey = r_regionkey GROUP BY 1")
def json_summary(spark, sf):
    path = scratch(spark)
    facts = K.table(spark, sf, "nation").groupBy(F.col("n_regionkey").cast("long").alias("key")).agg(F.count("*").alias("n"))
    IO.write_json(facts, path)
    return IO.read_json(spark, path, "key bigint, n bigint")


@query(
    "run_log_counts",
    """WITH l AS (SELECT quality AS y, doc_id % 10 = 0 AS val FROM labels), c AS (SELECT
   count(*) FILTER (y = 1) AS a, count(*) FILTER (y = 0) AS b, count(*) FILTER (y = 1 AND NOT val) AS c, count(*) FILTER (y = 0 AND NOT val) AS d,
   count(*) FILTER (y = 1 AND val) AS e, count(*) FILTER (y = 0 AND val) AS f FROM l)
 SELECT 'rf' AS model, unnest(['nr cases all', 'nr controls all', 'nr cases train/test', 'nr controls train/test', 'nr cases validation', 'nr controls validation', 'nrfeat', 'rfe']) AS key,
   unnest([a::DOUBLE, b, c, d, e, f, 2, 1]) AS value FROM c""",
)
def run_log_counts(spark, sf):
    l = K.table(spark, sf, "labels")
    return IO.log_facts("rf", ["a", "b"], l.where("doc_id % 10 <> 0"), l.where("doc_id % 10 = 0"), "quality", True)


@query(
    "run_log",
    "WITH m AS (SELECT o_orderstatus AS model, avg(o_totalprice) AS v, count(*) AS n FROM orders GROUP BY 1)"
    " SELECT 'r1' AS run_id, model, 'mean' AS key, CAST(CAST(round(v, 4) AS DOUBLE) AS DOUBLE) AS value FROM m UNION ALL SELECT 'r1', model, 'n', CAST(n AS DOUBLE) FROM m",
)
def run_log(spark, sf):
    path = scratch(spark)
    m = K.table(spark, sf, "orders").groupBy(F.col("o_orderstatus").alias("model")).agg(F.avg("o_totalprice").alias("mean"), F.count("*").alias("n"))
    for key in ("mean", "n", "mean"):  # a step that is run again is logged once
        IO.append_log(m.select("model", F.lit(key).alias("key"), F.col(key).alias("value")), path, "r1", key)
    return IO.read_log(spark, path)


@query(
    "run_log_compacted",
    "SELECT 'r' || n_regionkey AS run_id, 'm' AS model, 'n' AS key, CAST(count(*) AS DOUBLE) AS value FROM nation GROUP BY 1",
)
def run_log_compacted(spark, sf):
    """Entries before and after a compaction; one of them replaces what the snapshot holds."""
    path = scratch(spark)
    n = K.table(spark, sf, "nation")
    for k in (0, 1, 2):
        wrong = F.lit(-1) if k == 1 else F.count("*")
        IO.append_log(n.where(F.col("n_regionkey") == k).agg(F.lit("m").alias("model"), F.lit("n").alias("key"), wrong.alias("value")), path, f"r{k}", "count")
    IO.compact_log(spark, path)
    for k in (1, 3, 4):
        IO.append_log(n.where(F.col("n_regionkey") == k).agg(F.lit("m").alias("model"), F.lit("n").alias("key"), F.count("*").alias("value")), path, f"r{k}", "count")
    return IO.read_log(spark, path)


@query("files_listed", "SELECT 'part=' || n_regionkey AS part, 1::BIGINT AS files, true AS filled FROM nation GROUP BY 1")
def files_listed(spark, sf):
    """The files of a partitioned table, from their names and sizes alone."""
    path = scratch(spark)
    K.table(spark, sf, "nation").withColumn("part", F.col("n_regionkey")).repartition(1).write.partitionBy("part").parquet(path)
    found = IO.list_files(spark, path, "*.parquet")
    return found.groupBy(F.regexp_extract("path", "(part=[^/]*)/", 1).alias("part")).agg(F.count("*").alias("files"), F.bool_and(F.col("bytes") > 0).alias("filled"))
