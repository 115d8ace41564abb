"""The catalogue: each query with, where SQL can say the same, its SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegralType

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


def r(column: str | Column, digits: int = 6) -> Column:
    """Rounded for comparison; adding zero turns -0.0 into 0.0."""
    return F.round(column, digits) + F.lit(0.0)


def tidy(df: DataFrame, digits: int = 6, **per: int) -> DataFrame:
    """Doubles rounded, integers widened to bigint."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, DoubleType):
            out.append(r(c, per.get(f.name, digits)).alias(f.name))
        elif isinstance(f.dataType, IntegralType):
            out.append(c.cast("long").alias(f.name))
        else:
            out.append(c)
    return df.select(*out)
