"""Small column functions: labels, paths, clipping, rounding."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Output folder name and the predictor type it stands for.
FOLDER_TYPES = {"models": "prot_only", "models_comb": "prot_and_sexagebmi", "models_sexagebmi": "sexagebmi"}


def predictor_type(path: Column) -> Column:
    """Predictor type from the last part of a path; NULL for any other folder."""
    last = F.element_at(F.split(path, "/"), -1)
    out = F.lit(None).cast("string")
    for folder, kind in FOLDER_TYPES.items():
        out = F.when(last == folder, kind).otherwise(out)
    return out


def label_after_elimination(label: Column, kept: Column) -> Column:
    """``..._top30_...`` becomes ``..._top30rfekeep8_...``."""
    parts = F.transform(
        F.split(label, "_"),
        lambda p: F.when(F.contains(p, F.lit("top")), F.concat(p, F.lit("rfekeep"), kept.cast("string"))).otherwise(p),
    )
    return F.array_join(parts, "_")


def elimination_note(file: Column, n_features: Column) -> Column:
    n = F.when(F.contains(file, F.lit("_rfe_")), n_features.cast("string")).otherwise("NA")
    return F.concat(F.lit("rfe_feat: "), n)


def file_stem(path: Column) -> Column:
    """File name up to its first dot."""
    return F.substring_index(F.element_at(F.split(path, "/"), -1), ".", 1)


def only_label(files: list[str]) -> str:
    """Label of the only model file in a folder."""
    if len(files) != 1:
        raise ValueError(f"expected one model, found {files}")
    return re.split(r"\.", files[0])[0]


def clip(value: Column, low: float, high: float) -> Column:
    return F.greatest(F.lit(low), F.least(F.lit(high), value))


def step_folder(number: Column, name: Column) -> Column:
    """``01_data_loading``."""
    return F.concat(F.lpad(number.cast("string"), 2, "0"), F.lit("_"), name)
