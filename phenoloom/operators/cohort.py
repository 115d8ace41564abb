"""Bring samples, phenotypes and covariates together: projection, alignment, recoding, imputation, validation."""

from __future__ import annotations

import warnings
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from phenoloom.operators.ordered import exact_quantiles
from phenoloom.operators.shape import cells_from_wide
from phenoloom.session import small_side

# Accepted spellings of the demographic covariates.
COVARIATE_ALIASES = {
    "sex": ["sex", "Sex"],
    "age": ["age", "Age", "Age_at_recruitment", "age_at_recruitment"],
    "bmi": ["bmi", "BMI"],
}
# Numeric codes of sex. The two conventions are opposite.
SEX_MALE_ZERO = {"Male": 0, "Female": 1}
SEX_MALE_ONE = {"Female": 0, "Male": 1, "female": 0, "male": 1, "F": 0, "M": 1}
# Covariates used by default in the adjusted association test.
DEFAULT_COVARIATES = ["Age_at_recruitment", "Sex", "bmi", "age", "sex", "mean_NPX", "Plate0", "Plate2", "Plate3"]
PRED_MODES = ("prot_only", "sexagebmi", "comb")
#: A class ratio above this is reported as severe.
SEVERE_IMBALANCE = 10.0


# --- columns ---------------------------------------------------------------------------------------------------------

#: Levels of the outcome that the short report on prepared tables shows, most frequent first; ``levels`` has all of them.
SHOWN_LEVELS = 1000


def find_covariates(columns: Sequence[str]) -> dict[str, str]:
    """Canonical covariate name to the column that carries it: exact spelling first, then any case."""
    folded = {c.lower(): c for c in columns}
    found = {}
    for name, spellings in COVARIATE_ALIASES.items():
        hits = [s if s in columns else folded.get(s.lower()) for s in spellings]
        hit = next((h for h in hits if h), None)
        if hit:
            found[name] = hit
    return found


def outcome_column(columns: Sequence[str], part: str) -> str:
    """The single column whose name contains ``part``."""
    hits = [c for c in columns if part in c]
    if len(hits) != 1:
        raise ValueError(f"expected one column containing {part!r}, found {hits}")
    return hits[0]


def with_outcome(pheno: DataFrame, part: str, out: str = "outcome") -> DataFrame:
    return pheno.withColumn(out, F.col(outcome_column(pheno.columns, part)).cast("int"))


def outcome_levels(pheno: DataFrame, outcome: str) -> DataFrame:
    return pheno.where(F.col(outcome).isNotNull()).select(F.col(outcome).cast("int").alias("level")).distinct().orderBy("level")


def rename_covariates(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed({"Age_at_recruitment": "age", "Sex": "sex"})


def recode(value: Column, codes: dict) -> Column:
    """Map listed values to numbers; anything else is NULL."""
    out = None
    for k, v in codes.items():
        out = F.when(value == F.lit(k), F.lit(v)) if out is None else out.when(value == F.lit(k), F.lit(v))
    return out


def to_number(value: Column) -> Column:
    """Text to double; unparsable is NULL, and so is NaN."""
    number = value.try_cast("double")
    return F.when(~F.isnan(number), number)


def split_by_type(df: DataFrame) -> tuple[list[str], list[str]]:
    numeric = [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)]
    return numeric, [c for c in df.columns if c not in numeric]


# --- joins -----------------------------------------------------------------------------------------------------------


def align(features: DataFrame, pheno: DataFrame, key: str) -> DataFrame:
    """Samples present in both tables. Order never matters, so there is nothing else to check."""
    return features.join(pheno, key, "inner")


def _alignment(features: DataFrame, pheno: DataFrame, key: str) -> DataFrame:
    tagged = features.select(key, F.lit(1).alias("f"), F.lit(0).alias("p")).unionByName(
        pheno.select(key, F.lit(0).alias("f"), F.lit(1).alias("p"))
    )
    per_key = tagged.groupBy(key).agg(F.sum("f").alias("f"), F.sum("p").alias("p"))
    both = F.when((F.col("f") > 0) & (F.col("p") > 0), 1).otherwise(0)
    return per_key.agg(
        F.sum("f").alias("n_features"),
        F.sum("p").alias("n_pheno"),
        F.sum(both).alias("n_common"),
        F.max(F.greatest("f", "p")).alias("_most"),
    )


def alignment_counts(features: DataFrame, pheno: DataFrame, key: str) -> DataFrame:
    """Rows on either side, in common, and dropped. One shuffle of keys, combined on the map side."""
    return _alignment(features, pheno, key).drop("_most").select(
        "*",
        (F.col("n_features") - F.col("n_common")).alias("dropped_features"),
        (F.col("n_pheno") - F.col("n_common")).alias("dropped_pheno"),
    )


def require_overlap(features: DataFrame, pheno: DataFrame, key: str, name: str) -> None:
    """Refuse tables without a common sample, or with a sample id twice; warn of rows without a partner."""
    n = _alignment(features, pheno, key).first()
    if not n["n_common"]:
        raise ValueError(f"no common sample ids between features and phenotypes ({name})")
    if n["_most"] > 1:
        raise ValueError(f"a sample id occurs more than once ({name})")
    lost = [n[c] - n["n_common"] for c in ("n_features", "n_pheno")]
    if any(lost):
        warnings.warn(f"{name}: {lost[0]} feature rows and {lost[1]} phenotype rows have no partner")


def lookup(df: DataFrame, table: DataFrame, key: str, table_key: str, columns: dict[str, str]) -> DataFrame:
    """Left join of a keyed lookup table; an id it lacks gives NULL.

    No broadcast hint: Catalyst broadcasts the table when its file is small and shuffles otherwise.
    """
    side = table.select(F.col(table_key).alias(key), *[F.col(c).alias(n) for c, n in columns.items()])
    return df.join(side, key, "left")


def drop_missing(matrix: DataFrame, pheno: DataFrame, column: str, key: str) -> tuple[DataFrame, DataFrame]:
    kept = pheno.dropna(subset=[column])
    return matrix.join(kept.select(key), key, "left_semi"), kept


def rows_for(df: DataFrame, samples: DataFrame, key: str) -> DataFrame:
    return df.join(samples.select(key), key, "left_semi")


# --- projection ------------------------------------------------------------------------------------------------------


def mode_columns(matrix_cols: Sequence[str], pheno_cols: Sequence[str], mode: str) -> tuple[list[str], list[str]]:
    """Columns to take from the matrix and from the phenotype table in a predictor mode."""
    if mode not in PRED_MODES:
        raise ValueError(f"invalid predictor mode {mode!r}; use one of {PRED_MODES}")
    own = list(find_covariates(matrix_cols).values())
    other = list(find_covariates(pheno_cols).values())
    proteins = [c for c in matrix_cols if c not in own]
    if mode == "prot_only":
        return proteins, []
    if mode == "sexagebmi":
        if not own and not other:
            raise ValueError("no sex, age or bmi column found")
        return (own, []) if own else ([], other)
    if not own and not other:
        warnings.warn("no sex, age or bmi column found; using the features alone")
        return proteins, []
    return (proteins + own, []) if own else (proteins, other)


def project_mode(matrix: DataFrame, pheno: DataFrame, mode: str, key: str) -> DataFrame:
    """The predictor table of a mode, keyed by sample."""
    mine, theirs = mode_columns([c for c in matrix.columns if c != key], [c for c in pheno.columns if c != key], mode)
    if not theirs:
        return matrix.select(key, *mine)
    return matrix.select(key, *mine).join(pheno.select(key, *theirs), key, "inner")


def append_covariates(matrix: DataFrame, names: Sequence[str], pheno: DataFrame, covariates: Sequence[str], key: str):
    """Covariates as further elements of the array form. Returns the matrix and its names."""
    joined = matrix.join(pheno.select(key, *covariates), key, "inner")
    extra = F.array(*[F.col(c).cast("double") for c in covariates])
    kept = [F.col(c) for c in matrix.columns if c != "features"]
    return joined.select(*kept, F.concat("features", extra).alias("features")), [*names, *covariates]


def exclude_features(cells: DataFrame, names: Sequence[str]) -> DataFrame:
    return cells.where(~F.col("feature").isin(list(names)))


def select_features(cells: DataFrame, wanted: Sequence[str], available: Sequence[str], validate: bool = True) -> DataFrame:
    """Cells of the named features. Unknown names are warned about and left out, or raise."""
    unknown = sorted(set(wanted) - set(available))
    if unknown and not validate:
        raise KeyError(f"unknown features: {unknown}")
    if unknown:
        warnings.warn(f"unknown features left out: {unknown}")
    return cells.where(F.col("feature").isin([w for w in wanted if w in set(available)]))


def complete_features(cells: DataFrame) -> DataFrame:
    """Names of the features all of whose cells are finite."""
    ok = F.coalesce(F.abs("value") < float("inf"), F.lit(False))
    return cells.groupBy("feature").agg(F.bool_and(ok).alias("_ok")).where("_ok").select("feature")


# --- counts ----------------------------------------------------------------------------------------------------------


def target_distribution(pheno: DataFrame, outcome: str) -> DataFrame:
    return pheno.where(F.col(outcome).isNotNull()).groupBy(F.col(outcome).alias("level")).agg(F.count("*").alias("n"))


def imbalance(pheno: DataFrame, outcome: str) -> DataFrame:
    """Largest over smallest class, with the flags that follow from it."""
    ratio = F.col("largest") / F.col("smallest")
    return (
        target_distribution(pheno, outcome)
        .agg(F.count("*").alias("n_classes"), F.max("n").alias("largest"), F.min("n").alias("smallest"))
        .select(
            "n_classes",
            ratio.alias("imbalance_ratio"),
            (ratio > SEVERE_IMBALANCE).alias("severe"),
            (F.col("n_classes") >= 2).alias("compatible"),
        )
    )


def missing_cells(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Missing cells in the listed columns and in all: one pass, one row."""
    per = [F.count_if(F.col(c).isNull()) for c in columns]
    total = per[0]
    for p in per[1:]:
        total = total + p
    return df.agg(total.alias("n_missing"), F.count("*").alias("n_rows"))


def missing_in_arrays(matrix: DataFrame, col: str = "features") -> DataFrame:
    gone = F.size(F.filter(col, lambda x: x.isNull() | F.isnan(x)))
    return matrix.agg(F.sum(gone).alias("n_missing"), F.count("*").alias("n_rows"))


def covariate_profile(pheno: DataFrame, covariates: Sequence[str]) -> DataFrame:
    """Minimum, maximum and presence of nulls per covariate."""
    return (
        cells_from_wide(pheno, covariates, [])
        .groupBy(F.col("feature").alias("covariate"))
        .agg(F.min("value").alias("min_value"), F.max("value").alias("max_value"), F.bool_or(F.col("value").isNull()).alias("has_null"))
    )


def require_classes(pheno: DataFrame, outcome: str) -> None:
    n = imbalance(pheno, outcome).first()
    if n["n_classes"] < 2:
        raise ValueError("the outcome needs at least two classes")


# --- imputation ------------------------------------------------------------------------------------------------------


def feature_medians(cells: DataFrame) -> DataFrame:
    return exact_quantiles(cells, "value", {"median": 0.5}, ["feature"])


def category_modes(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Most frequent value per text column, the smallest on ties, ``missing`` where a column is all null.

    Counted as (column, value) pairs, so no column's values meet in one task.
    """
    text = df.select(*[F.col(c).cast("string").alias(c) for c in columns]).unpivot([], list(columns), "feature", "value")
    counts = text.groupBy("feature", "value").agg(F.count("value").alias("n"))
    best = F.min_by("value", F.struct(-F.col("n"), F.col("value"))).alias("mode")
    return counts.groupBy("feature").agg(best).select("feature", F.coalesce("mode", F.lit("missing")).alias("mode"))


def impute_cells(cells: DataFrame, fit_on: DataFrame | None = None) -> DataFrame:
    """Missing cells take the median of their feature. ``fit_on`` gives the table the medians come from (the training
    part, to keep validation data out of it); by default the table itself."""
    medians = small_side(feature_medians(fit_on if fit_on is not None else cells))
    joined = cells.join(medians, "feature", "left")
    return joined.select(*[F.coalesce("value", "median").alias("value") if c == "value" else F.col(c) for c in cells.columns])


def impute_arrays(matrix: DataFrame, names: Sequence[str], medians: dict[str, float], col: str = "features") -> DataFrame:
    """As above for the array form, narrow: one median per feature travels as a literal."""
    fill = F.array(*[F.lit(medians.get(n)).cast("double") for n in names])
    return matrix.withColumn(col, F.zip_with(col, fill, lambda x, m: F.coalesce(F.when(~F.isnan(x), x), m)))


def impute_table(df: DataFrame, skip: Sequence[str], fit_on: DataFrame | None = None) -> DataFrame:
    """Numeric columns by median, text columns by mode. One value per column comes to the driver."""
    base = fit_on if fit_on is not None else df
    numeric, text = split_by_type(df.drop(*skip))
    fills: dict = {}
    if numeric:
        cells = cells_from_wide(base, numeric, [])
        fills |= {r["feature"]: r["median"] for r in feature_medians(cells).collect() if r["median"] is not None}
    if text:
        fills |= {r["feature"]: r["mode"] for r in category_modes(base, text).collect()}
    # a median may be fractional where the column is integer, so the filled column becomes double
    out = df
    for c, v in fills.items():
        out = out.withColumn(c, F.coalesce(F.col(c).cast("double") if c in numeric else F.col(c).cast("string"), F.lit(v)))
    return out


# --- preparation -----------------------------------------------------------------------------------------------------


@dataclass
class Prepared:
    """The four tables a study starts from, with the facts about them."""

    train: DataFrame
    pheno_train: DataFrame
    val: DataFrame
    pheno_val: DataFrame
    info: dict
    #: All outcome levels with their counts, a table for each part that has the outcome.
    levels: dict[str, DataFrame] = field(default_factory=dict)


def prepare(
    matrix_train: DataFrame,
    pheno_train: DataFrame,
    matrix_val: DataFrame,
    pheno_val: DataFrame,
    mode: str = "prot_only",
    outcome: str = "outcome",
    key: str = "sample_id",
    fit_on: str = "train",
) -> Prepared:
    """Align, project to the predictor mode, impute, and describe.

    ``fit_on="train"`` imputes validation rows with training medians; ``"own"`` lets every table use its own.
    """
    for m, p, name in ((matrix_train, pheno_train, "training"), (matrix_val, pheno_val, "validation")):
        require_overlap(m, p, key, name)
    if outcome not in pheno_train.columns:
        raise ValueError(f"outcome {outcome!r} is not in the training phenotypes")
    if outcome not in pheno_val.columns:
        warnings.warn(f"outcome {outcome!r} is not in the validation phenotypes: prediction only")

    x_train = project_mode(rows_for(matrix_train, pheno_train, key), pheno_train, mode, key)
    x_val = project_mode(rows_for(matrix_val, pheno_val, key), pheno_val, mode, key)
    p_train, p_val = rows_for(pheno_train, matrix_train, key), rows_for(pheno_val, matrix_val, key)
    own = fit_on == "own"
    skip = [key, outcome]
    out = Prepared(
        impute_table(x_train, [key]),
        impute_table(p_train, skip),
        impute_table(x_val, [key], None if own else x_train),
        impute_table(p_val, [c for c in skip if c in p_val.columns], None if own else p_train),
        {"pred_mode": mode, "outcome": outcome, "feature_names": [c for c in x_train.columns if c != key]},
    )

    out.levels = {part: target_distribution(p, outcome) for part, p in (("train", p_train), ("val", p_val)) if outcome in p.columns}

    def levels(part: str) -> dict:
        """The most frequent levels; a continuous outcome has as many as rows, and those stay in the table."""
        if part not in out.levels:
            return {}
        shown = out.levels[part].orderBy(F.desc("n"), "level").limit(SHOWN_LEVELS)
        return {r["level"]: r["n"] for r in shown.collect()}

    out.info |= {
        "train_samples": out.train.count(),
        "val_samples": out.val.count(),
        "n_features": len(out.info["feature_names"]),
        "target_distribution_train": levels("train"),
        "target_distribution_val": levels("val"),
    }
    return out


def compatibility_report(features: DataFrame, pheno: DataFrame, outcome: str, key: str) -> DataFrame:
    """Checks before a study, one row each: ``(check, level, value, recommendation)``."""
    spark = features.sparkSession
    cols = [c for c in features.columns if c != key]
    numeric, text = split_by_type(features.select(*cols))
    n_missing, n_rows = missing_cells(features, cols).first()
    p_missing, p_rows = missing_cells(pheno, pheno.columns).first()
    rows = [
        ("sample_count", "ok" if n_rows == p_rows else "error", float(n_rows - p_rows), None),
        ("feature_missing", "warn" if n_missing else "ok", float(n_missing), "impute or drop" if n_missing else None),
        ("phenotype_missing", "warn" if p_missing else "ok", float(p_missing), None),
        ("non_numeric_features", "warn" if text else "ok", float(len(text)), "convert to numbers" if text else None),
        ("numeric_features", "ok", float(len(numeric)), None),
    ]
    if outcome not in pheno.columns:
        rows.append(("target", "error", 0.0, "name a column of the phenotype table"))
    else:
        i = imbalance(pheno, outcome).first()
        rows.append(("target", "ok" if i["compatible"] else "error", float(i["n_classes"]), None))
        if i["compatible"]:
            severe = i["severe"]
            rows.append(("imbalance_ratio", "warn" if severe else "ok", i["imbalance_ratio"], "use balanced weights" if severe else None))
    compatible = all(r[1] != "error" for r in rows)
    rows.append(("compatible", "ok" if compatible else "error", float(compatible), None))
    return spark.createDataFrame(rows, "check string, level string, value double, recommendation string")
