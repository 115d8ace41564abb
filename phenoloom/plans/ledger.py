"""Run management: step tables, and a ledger of what was run, when, with which parameters."""

from __future__ import annotations

import hashlib
import json
import time
import uuid
from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from phenoloom.plans.digest import ROWS, differences, digests, stored_form

LEDGER_SCHEMA = (
    "run_id string, step string, description string, started timestamp, ended timestamp, elapsed_s double, rows bigint, "
    "path string, schema_json string, params map<string,string>, params_hash string, deleted boolean, digest string"
)


def params_hash(params: dict) -> str:
    return hashlib.md5(json.dumps(params, sort_keys=True, default=str).encode()).hexdigest()


class _Folder:
    """A folder in any file system that Spark reads."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self._path = spark._jvm.org.apache.hadoop.fs.Path(path)
        self._fs = self._path.getFileSystem(spark._jsc.hadoopConfiguration())

    def exists(self) -> bool:
        return bool(self._fs.exists(self._path))

    def delete(self) -> None:
        self._fs.delete(self._path, True)


class Run:
    """The steps of one run under ``root``. Step tables and ledger are parquet in shared storage; every save gets a new
    path, so a reader never sees a half-written step. A deletion removes the step's files and is one more ledger row."""

    def __init__(self, spark: SparkSession, root: str, run_id: str) -> None:
        self.spark, self.root, self.run_id = spark, root.rstrip("/"), run_id

    @property
    def ledger_path(self) -> str:
        """A folder for each run: runs side by side neither wait for each other nor read each other's rows."""
        return f"{self.root}/ledger/run={self.run_id}"

    def ledger(self) -> DataFrame:
        try:
            df = self.spark.read.schema(LEDGER_SCHEMA).parquet(self.ledger_path)
        except AnalysisException:
            return self.spark.createDataFrame([], LEDGER_SCHEMA)
        return df.where(F.col("run_id") == self.run_id)

    def _append(self, **row) -> None:
        base = dict.fromkeys((p.split()[0] for p in LEDGER_SCHEMA.split(", ")), None) | {"run_id": self.run_id, "deleted": False}
        row = base | row
        names = [p.split()[0] for p in LEDGER_SCHEMA.split(", ")]
        self.spark.createDataFrame([tuple(row[n] for n in names)], LEDGER_SCHEMA).coalesce(1).write.mode("append").parquet(self.ledger_path)

    def save(self, data: DataFrame, *, step: str, description: str = "", params: dict | None = None, started: float | None = None) -> DataFrame:
        """Write a step table, record it, and return it as read back."""
        begun = started or time.time()
        path = f"{self.root}/{self.run_id}/{step}/{uuid.uuid4().hex}"
        data.write.option("compression", "snappy").parquet(path)
        saved = self.spark.read.parquet(path)
        content = digests(saved)
        ended = time.time()
        self._append(
            step=step,
            description=description,
            started=datetime.fromtimestamp(begun, timezone.utc),
            ended=datetime.fromtimestamp(ended, timezone.utc),
            elapsed_s=ended - begun,
            rows=content[ROWS]["rows"],
            path=path,
            schema_json=saved.schema.json(),
            digest=stored_form(content),
            params={k: str(v) for k, v in (params or {}).items()},
            params_hash=params_hash(params or {}),
        )
        return saved

    def record(self, step: str, path: str, rows: int, params: dict | None = None, started: float | None = None) -> None:
        """Record something saved elsewhere, such as a model."""
        begun, ended = started or time.time(), time.time()
        self._append(
            step=step,
            started=datetime.fromtimestamp(begun, timezone.utc),
            ended=datetime.fromtimestamp(ended, timezone.utc),
            elapsed_s=ended - begun,
            rows=rows,
            path=path,
            params={k: str(v) for k, v in (params or {}).items()},
            params_hash=params_hash(params or {}),
        )

    def steps(self) -> DataFrame:
        """The current row of every step that has not been deleted."""
        return latest_steps(self.ledger()).where(~F.col("deleted"))

    def info(self, step: str):
        return self.steps().where(F.col("step") == step).first()

    def exists(self, step: str) -> bool:
        return self.info(step) is not None

    def load(self, step: str) -> DataFrame:
        row = self.info(step)
        if row is None:
            raise FileNotFoundError(f"no step {step!r} in run {self.run_id!r}")
        return self.spark.read.parquet(row["path"])

    def delete(self, step: str) -> None:
        """Forget a step and remove the files of all its versions, wherever the run is stored."""
        if not self.exists(step):
            raise FileNotFoundError(f"no step {step!r} in run {self.run_id!r}")
        self._folder(step).delete()
        now = datetime.fromtimestamp(time.time(), timezone.utc)
        self._append(step=step, started=now, ended=now, elapsed_s=0.0, deleted=True)

    def _folder(self, step: str) -> _Folder:
        return _Folder(self.spark, f"{self.root}/{self.run_id}/{step}")

    def has_files(self, step: str) -> bool:
        return self._folder(step).exists()

    def step(self, name: str, params: dict, make: Callable[[], DataFrame], description: str = "") -> DataFrame:
        """The stored table of a step if it was made with the same parameters, else make and store it."""
        row = self.info(name)
        if row is not None and row["params_hash"] == params_hash(params):
            return self.spark.read.parquet(row["path"])
        begun = time.time()
        return self.save(make(), step=name, description=description, params=params, started=begun)

    def check(self) -> DataFrame:
        """Read every step: is it there, has it rows, has it the recorded schema and, cell by cell, the recorded content?"""
        out = []
        for row in self.steps().where("schema_json is not null").collect():
            try:
                df = self.spark.read.parquet(row["path"])
                now = digests(df)
                n, same = now[ROWS]["rows"], df.schema.json() == row["schema_json"]
                other = differences(now, row["digest"]) if same and row["digest"] else []
                ok = n > 0 and n == row["rows"] and same and not other
                if not same:
                    message = "schema differs"
                elif n != row["rows"] or not n:
                    message = f"{n} rows, {row['rows']} recorded"
                elif other:
                    named = [c for c in other if c != ROWS]
                    message = f"content of {', '.join(named)} differs" if named else "cells have changed places"
                else:
                    message = "ok"
                out.append((row["step"], ok, n, message))
            except Exception as e:  # noqa: BLE001
                out.append((row["step"], False, 0, str(e).split("\n")[0]))
        return self.spark.createDataFrame(out, "step string, valid boolean, rows_found long, message string")

    def timing(self) -> DataFrame:
        return timing_shares(self.steps())

    def summary(self, facts: dict[str, DataFrame] | None = None) -> DataFrame:
        """``(section, step, key, value)``: the steps and their sizes, with further facts ``(step, key, value)`` by section."""
        s = self.steps()
        out = s.select(F.lit("overview").alias("section"), "step", F.lit("rows").alias("key"), F.col("rows").cast("string").alias("value"))
        out = out.unionByName(
            s.select(F.lit("overview").alias("section"), "step", F.lit("elapsed_s").alias("key"), F.col("elapsed_s").cast("string").alias("value"))
        )
        for section, df in (facts or {}).items():
            out = out.unionByName(df.select(F.lit(section).alias("section"), "step", "key", F.col("value").cast("string").alias("value")))
        return out


def ledger_of(spark: SparkSession, root: str) -> DataFrame:
    """The rows of all runs under ``root``."""
    return spark.read.option("recursiveFileLookup", True).schema(LEDGER_SCHEMA).parquet(f"{root.rstrip('/')}/ledger")


def latest_steps(ledger: DataFrame) -> DataFrame:
    """The last row per run and step. An aggregate, so a long history is combined on the map side."""
    rest = [c for c in ledger.columns if c not in ("run_id", "step")]
    tie = [c for c in ("started", "rows") if c in rest]
    last = F.max_by(F.struct(*rest), F.struct(*tie)).alias("r")
    return ledger.groupBy("run_id", "step").agg(last).select("run_id", "step", "r.*")


def timing_shares(ledger: DataFrame) -> DataFrame:
    """Seconds, minutes and share of the run per step."""
    per = ledger.groupBy("run_id", "step").agg(F.sum("elapsed_s").alias("seconds"))
    whole = F.sum("seconds").over(Window.partitionBy("run_id"))
    return per.select("run_id", "step", "seconds", (F.col("seconds") / 60).alias("minutes"), (100 * F.col("seconds") / whole).alias("share"))


def overhead(ledger: DataFrame) -> DataFrame:
    """Wall time of a run, its measured part, and the rest."""
    wall = F.unix_micros(F.max("ended").cast("timestamp")) / 1e6 - F.unix_micros(F.min("started").cast("timestamp")) / 1e6
    out = ledger.groupBy("run_id").agg(F.sum("elapsed_s").alias("measured"), wall.alias("wall"))
    return out.withColumn("overhead", F.col("wall") - F.col("measured"))
