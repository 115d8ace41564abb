"""Readers and writers. Everything is a Spark source: partitioned reads, pushed filters, one file per task on write."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# Header names under which older files keep the sample key in their first column.
LEGACY_KEYS = ("unnamed: 0", "index", "sample_id", "")


def key_column(columns: Sequence[str]) -> str:
    """The sample key: ``sample_id``, or a legacy name in the first column. A positional key is never invented."""
    if "sample_id" in columns:
        return "sample_id"
    first = columns[0]
    if first.lower() in LEGACY_KEYS or first == "_c0":
        return first
    raise ValueError(f"no sample key among the columns, the first is {first!r}")


def read_matrix(spark: SparkSession, path: str, key_type: str = "string", schema: StructType | str | None = None, sep: str = ",") -> DataFrame:
    """A keyed matrix from CSV. Without a schema every column but the key is read as a double, from the header alone:
    the data is not scanned to guess types."""
    reader = spark.read.option("header", True).option("sep", sep)
    if schema is None:
        columns = reader.csv(path).columns
        key = key_column(columns)
        schema = StructType()
        for c in columns:
            schema = schema.add(c, key_type if c == key else "double")
    df = reader.schema(schema).csv(path)
    df = df.withColumnRenamed(key_column(df.columns), "sample_id")
    doubles = [f.name for f in df.schema.fields if f.dataType.typeName() == "double" and f.name != "sample_id"]
    return df.select("sample_id", *[F.nanvl(F.col(f"`{c}`"), F.lit(None)).alias(c) if c in doubles else F.col(f"`{c}`") for c in df.columns if c != "sample_id"])


def read_phenotypes(spark: SparkSession, path: str, schema: StructType | str, sep: str = ",") -> DataFrame:
    df = spark.read.option("header", True).option("sep", sep).schema(schema).csv(path)
    return df.withColumnRenamed(key_column(df.columns), "sample_id")


def read_covariates(
    spark: SparkSession, path: str, key: str, columns: dict[str, str], key_type: str = "string", sep: str = "\t"
) -> DataFrame:
    """Named numeric columns of a TSV lookup table; the others are never parsed."""
    raw = spark.read.option("header", True).option("sep", sep).csv(path)
    return raw.select(F.col(f"`{key}`").cast(key_type).alias("sample_id"), *[F.col(f"`{c}`").try_cast("double").alias(n) for c, n in columns.items()])


def unique_key(df: DataFrame, key: str) -> DataFrame:
    """The table itself, after a check that its key is unique."""
    twice = df.groupBy(key).count().where("count > 1").limit(5).collect()
    if twice:
        raise ValueError(f"{key!r} is not unique, for example {[row[key] for row in twice]}")
    return df


def read_annotation(spark: SparkSession, path: str, key: str = "x.olinkid", name: str = "x.names") -> DataFrame:
    """Feature annotation ``(feature, feature_name)``; a repeated id is an error."""
    raw = spark.read.option("header", True).option("sep", "\t").csv(path)
    return unique_key(raw.select(F.col(f"`{key}`").alias("feature"), F.col(f"`{name}`").alias("feature_name")), "feature")


def read_part(spark: SparkSession, path: str, **partition: str) -> DataFrame:
    """One partition (a split, an outcome) of a partitioned table; the others are not opened."""
    df = spark.read.parquet(path)
    for c, v in partition.items():
        df = df.where(F.col(c) == v)
    return df


def write_parquet(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.write.mode(mode).option("compression", "snappy").parquet(path)


def write_partitioned(df: DataFrame, path: str, columns: Sequence[str]) -> None:
    df.write.partitionBy(*columns).option("compression", "snappy").parquet(path)


def write_bucketed(df: DataFrame, name: str, key: str, buckets: int) -> None:
    """A table bucketed by the sample key, for repeated joins without a shuffle."""
    df.write.bucketBy(buckets, key).sortBy(key).saveAsTable(name)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.option("header", True).csv(path)


def write_tsv(df: DataFrame, path: str, compression: str = "gzip") -> None:
    df.write.option("header", True).option("sep", "\t").option("compression", compression).csv(path)


def write_json(df: DataFrame, path: str) -> None:
    df.write.json(path)


def read_json(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    return spark.read.schema(schema).json(path)


def write_names(df: DataFrame, path: str, name: str, order: str) -> None:
    """One name per line in the given order. Range-partitioned, so the files follow each other in order."""
    df.orderBy(order).select(F.col(name).cast("string").alias("value")).write.text(path)


def read_names(spark: SparkSession, path: str, name: str = "feature") -> DataFrame:
    return spark.read.text(path).withColumnRenamed("value", name)


_MANIFEST = "entry string, kind string, folder string, committed timestamp"


def append_log(rows: DataFrame, path: str, run_id: str, step: str) -> None:
    """Add ``(run_id, model, key, value)``, values to four decimals, as the entry of one step of a run.

    The rows go to a folder of their own, and the entry exists once its line is in the manifest: a job that died before
    leaves nothing to see, and a step that is logged again replaces its entry.
    """
    entry, folder = f"{run_id}/{step}", f"entries/{uuid.uuid4().hex}"
    values = rows.select(F.lit(entry).alias("entry"), F.lit(run_id).alias("run_id"), "model", "key", F.round(F.col("value").cast("double"), 4).alias("value"))
    values.write.parquet(f"{path}/{folder}")
    _commit(rows.sparkSession, path, entry, "entry", folder)


def _commit(spark: SparkSession, path: str, entry: str, kind: str, folder: str) -> None:
    now = datetime.now(timezone.utc)
    spark.createDataFrame([(entry, kind, folder, now)], _MANIFEST).coalesce(1).write.mode("append").parquet(f"{path}/manifest")


def _visible(spark: SparkSession, path: str) -> tuple[str | None, list[tuple[str, str]]]:
    """The last snapshot's folder, and the entries committed since, each with the folder of its last version."""
    try:
        lines = spark.read.schema(_MANIFEST).parquet(f"{path}/manifest").orderBy("committed", "folder").collect()
    except AnalysisException:
        return None, []
    at = max((i for i, r in enumerate(lines) if r["kind"] == "snapshot"), default=None)
    since = lines if at is None else lines[at + 1 :]
    return None if at is None else lines[at]["folder"], list({r["entry"]: r["folder"] for r in since}.items())


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """All committed entries, each in its last version."""
    return _read_log(spark, path).drop("entry")


def _read_log(spark: SparkSession, path: str) -> DataFrame:
    schema = "entry string, run_id string, model string, key string, value double"
    snapshot, entries = _visible(spark, path)
    out = spark.read.schema(schema).parquet(*[f"{path}/{f}" for _, f in entries]) if entries else spark.createDataFrame([], schema)
    if snapshot is None:
        return out
    older = spark.read.schema(schema).parquet(f"{path}/{snapshot}")
    return out.unionByName(older.where(~F.col("entry").isin([e for e, _ in entries])) if entries else older)


def compact_log(spark: SparkSession, path: str) -> None:
    """Write what is visible into one folder, a snapshot; entries committed later come on top of it.

    Folders that were read before stay, as a reader may still hold them. One job compacts at a time.
    """
    folder = f"snapshots/{uuid.uuid4().hex}"
    _read_log(spark, path).coalesce(1).write.parquet(f"{path}/{folder}")
    _commit(spark, path, "", "snapshot", folder)


def list_files(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """``path, name, modified, bytes`` of all files below a folder whose name fits; no content is read."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(path)
    return found.select("path", F.substring_index("path", "/", -1).alias("name"), F.col("modificationTime").alias("modified"), F.col("length").alias("bytes"))


def log_facts(model: str, features: Sequence[str], train: DataFrame, val: DataFrame, outcome: str, eliminated: bool) -> DataFrame:
    """What a run is about, as log rows ``(model, key, value)``: class counts per part, features, elimination or not."""
    y = F.col("y")
    parts = train.select(F.col(outcome).alias("y"), F.lit("train/test").alias("part")).unionByName(
        val.select(F.col(outcome).alias("y"), F.lit("validation").alias("part"))
    )
    # one row of counts, unpivoted
    counts = parts.agg(
        *[
            F.count_if((y == level) & where).cast("double").alias(f"nr {name} {part}")
            for part, where in (("all", F.lit(True)), ("train/test", F.col("part") == "train/test"), ("validation", F.col("part") == "validation"))
            for name, level in (("cases", 1), ("controls", 0))
        ],
        F.lit(float(len(set(features)))).alias("nrfeat"),
        F.lit(float(eliminated)).alias("rfe"),
    )
    return counts.select(F.lit(model).alias("model"), "*").unpivot(["model"], [c for c in counts.columns], "key", "value")
