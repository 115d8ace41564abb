"""Digests of content, the log that counts a step once, and models found by their files."""

import datetime

import pytest
from pyspark.sql import functions as F

from phenoloom.operators import models as M
from phenoloom.plans.digest import ROWS, differences, digests, stored_form
from phenoloom.plans.ledger import Run
from phenoloom.sources import tables as IO


@pytest.fixture(scope="module")
def table(spark):
    rows = [(i, f"n{i % 5}" if i % 7 else None, i / 3, [float(i), None], {"b": i, "a": 1}, (i, "x"), datetime.datetime(2020, 1, 1, i % 24), bytearray([i % 256]), i % 2 == 0) for i in range(200)]
    return spark.createDataFrame(rows, "id long, name string, v double, a array<double>, m map<string,int>, s struct<p:long,q:string>, t timestamp, b binary, f boolean")


def test_order_and_files_do_not_matter(table):
    assert digests(table) == digests(table.repartition(7)) == digests(table.orderBy(F.desc("id")).coalesce(1))
    assert digests(table)["name"]["nulls"] == 29 and digests(table)[ROWS]["rows"] == 200


@pytest.mark.parametrize("column, value", [("name", "'n9'"), ("v", "0.5D"), ("a", "array(1D, null)"), ("m", "map('b', 3)"), ("s", "named_struct('p', 3L, 'q', 'y')"), ("t", "timestamp'2020-01-01 03:00:01'"), ("b", "X'FF'"), ("f", "not f"), ("name", "cast(null as string)")])
def test_one_altered_cell_is_found(table, column, value):
    other = table.withColumn(column, F.when(F.col("id") == 3, F.expr(value)).otherwise(F.col(column)))
    assert differences(digests(other), stored_form(digests(table))) == [ROWS, column]


def test_moved_cells_repeats_and_lost_rows(table):
    two = table.select("id", "name").where("name is not null")
    moved = two.withColumn("name", F.when(F.col("id") == 1, "n2").when(F.col("id") == 2, "n1").otherwise(F.col("name")))
    assert differences(digests(moved), stored_form(digests(two))) == [ROWS]
    twice = two.unionByName(two).unionByName(two)
    assert differences(digests(twice), stored_form(digests(two))) == [ROWS, "id", "name"]
    swapped = table.select(F.col("id").cast("string").alias("x"), F.lit("").alias("y"))
    assert digests(swapped)["y"] != digests(swapped.withColumn("y", F.lit(None).cast("string")))["y"]
    assert digests(two.limit(0))[ROWS] == {"rows": 0, "nulls": 0, "sum": "0", "xor": 0}


def test_older_ledgers_have_no_digest(spark, table, tmp_path):
    run = Run(spark, str(tmp_path), "old")
    run.save(table, step="a")
    plain = spark.read.parquet(run.ledger_path).drop("digest").collect()
    spark.createDataFrame(plain, ", ".join(p for p in "run_id string, step string, description string, started timestamp, ended timestamp, elapsed_s double, rows bigint, path string, schema_json string, params map<string,string>, params_hash string, deleted boolean".split(", "))).write.parquet(Run(spark, str(tmp_path / "more"), "old").ledger_path)
    again = Run(spark, str(tmp_path / "more"), "old")
    assert again.check().first().asDict() == {"step": "a", "valid": True, "rows_found": 200, "message": "ok"}


def log(spark, value):
    return spark.createDataFrame([("m", "k", value)], "model string, key string, value double")


def seen(spark, path):
    return sorted((r["run_id"], r["value"]) for r in IO.read_log(spark, path).collect())


def test_log_counts_a_step_once(spark, tmp_path):
    path = str(tmp_path / "log")
    assert seen(spark, path) == []
    for run, step, value in [("a", "s", 1.0), ("b", "s", 2.0), ("a", "s", 3.0), ("a", "t", 4.00004)]:
        IO.append_log(log(spark, value), path, run, step)
    assert seen(spark, path) == [("a", 3.0), ("a", 4.0), ("b", 2.0)]
    # rows of a job that died before it was committed are not there
    log(spark, 9.0).write.parquet(f"{path}/entries/half")
    IO.compact_log(spark, path)
    assert seen(spark, path) == [("a", 3.0), ("a", 4.0), ("b", 2.0)]
    IO.append_log(log(spark, 5.0), path, "b", "s")
    assert seen(spark, path) == [("a", 3.0), ("a", 4.0), ("b", 5.0)]
    IO.compact_log(spark, path)
    IO.append_log(log(spark, 6.0), path, "c", "s")
    assert seen(spark, path) == [("a", 3.0), ("a", 4.0), ("b", 5.0), ("c", 6.0)]


def test_models_are_found_by_their_files(spark, tmp_path):
    frame = spark.createDataFrame([(i, i % 2, [float(i % 5)]) for i in range(30)], "sample_id long, outcome int, features array<double>")
    fitted = M.fit(frame, "logistic_regression", {"maxIter": 3})
    for place in ("x/comb/b", "x/comb/a", "x/prot/c"):
        M.save_model(M.Trained("logistic_regression", fitted, ["f"], {}, spark.createDataFrame([], M.METRIC_SCHEMA)), str(tmp_path / place))
    fitted.write().save(str(tmp_path / "x/prot/a_unfinished/model"))
    found = [r["model"] for r in M.stored_models(spark, str(tmp_path)).orderBy("folder").collect()]
    assert found == ["a", "b", "c"]
    assert M.locate_model(spark, str(tmp_path)).endswith("x/comb/a") and M.locate_model(spark, str(tmp_path), "prot").endswith("x/prot/c")
    assert M.locate_model(spark, str(tmp_path), newest=True).endswith("x/prot/c")
    with pytest.raises(FileNotFoundError):
        M.locate_model(spark, str(tmp_path), "com")
