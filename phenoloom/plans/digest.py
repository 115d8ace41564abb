"""A digest of a table's content that does not depend on the order of its rows or on how they lie in files.

Every cell gives a hash of its value as text, and so does every row. Their sums and exclusive ors, by column, are one aggregate
whose result is one row; two tables differ where a digest differs. An altered cell changes its column and the rows, cells
exchanged between rows change the rows alone, and a sum tells apart what an exclusive or forgets: rows that come twice.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, DateType, MapType, StructType, TimestampNTZType, TimestampType

#: The name under which whole rows are digested; no column is called so.
ROWS = "*"


def as_text(column: Column, kind) -> Column:
    """A value as text, the same wherever it is computed; a null stays null."""
    if isinstance(kind, TimestampType):
        return F.unix_micros(column).cast("string")
    if isinstance(kind, BinaryType):
        return F.hex(column)
    if isinstance(kind, (DateType, TimestampNTZType)):
        return column.cast("string")
    if isinstance(kind, MapType):
        return as_text(F.array_sort(F.map_entries(column)), ArrayType(StructType()))
    if isinstance(kind, (ArrayType, StructType)):
        return F.when(column.isNotNull(), F.to_json(F.struct(column.alias("v")), {"ignoreNullFields": "false"}))
    return column.cast("string")


def hashed(text: Column) -> Column:
    """60 bits of the md5 of a text, as a number."""
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def digests(df: DataFrame) -> dict[str, dict]:
    """``rows``, ``nulls``, ``sum`` and ``xor`` of every column, and of whole rows under ``*``, in one aggregate."""
    cells = [hashed(F.coalesce(F.concat(F.lit("="), as_text(F.col(f"`{f.name}`"), f.dataType)), F.lit("-"))).alias(f"h{i}") for i, f in enumerate(df.schema.fields)]
    names, missing = [f.name for f in df.schema.fields], [F.col(f"`{n}`").isNull().cast("long").alias(f"m{i}") for i, n in enumerate(df.columns)]
    parts = df.select(*cells, *missing)
    whole = hashed(F.concat_ws("|", *[F.col(f"h{i}").cast("string") for i in range(len(names))])) if names else F.lit(0).cast("long")
    parts = parts.withColumn("hr", whole)
    keys = [*[(n, f"h{i}") for i, n in enumerate(names)], (ROWS, "hr")]
    sums = [F.sum(F.col(h).cast("decimal(20,0)")).cast("string").alias(f"s_{h}") for _, h in keys] + [F.bit_xor(h).alias(f"x_{h}") for _, h in keys]
    r = parts.agg(F.count("*").alias("n"), *sums, *[F.sum(f"m{i}").alias(f"n_{i}") for i in range(len(names))]).first()
    out = {n: {"rows": r["n"], "nulls": r[f"n_{i}"] or 0, "sum": r[f"s_h{i}"] or "0", "xor": r[f"x_h{i}"] or 0} for i, n in enumerate(names)}
    return out | {ROWS: {"rows": r["n"], "nulls": 0, "sum": r["s_hr"] or "0", "xor": r["x_hr"] or 0}}


def digest_table(df: DataFrame) -> DataFrame:
    """One row for each column: ``column, rows, nulls, sum, xor``."""
    rows = [(name, d["rows"], d["nulls"], d["sum"], d["xor"]) for name, d in digests(df).items()]
    return df.sparkSession.createDataFrame(rows, "column string, rows long, nulls long, sum string, xor long")


def stored_form(found: dict[str, dict]) -> str:
    return json.dumps(found, sort_keys=True)


def differences(now: dict[str, dict], recorded: str) -> list[str]:
    """Columns whose content is not what was recorded; ``*`` alone if cells only changed places."""
    then = json.loads(recorded)
    return sorted(n for n in now.keys() | then.keys() if now.get(n) != then.get(n))
