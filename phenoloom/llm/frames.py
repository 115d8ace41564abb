"""Helpers shared by the operators: stored intermediates, size-checked broadcasts and connected components."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from phenoloom.session import shared_folder

#: A side is broadcast only if it was counted and has at most so many rows; every use has rows of a few dozen bytes.
BROADCAST_ROWS = 200_000
#: Edges that one task joins into stars by itself; more edges have more tasks.
TASK_EDGES = 100_000


def stored(df: DataFrame) -> DataFrame:
    """Write ``df`` as Parquet in the shared checkpoint folder and read it back: computed once, safe from lost executors."""
    path = f"{shared_folder(df.sparkSession)}/stored-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast of a stored, narrow table after counting it; beyond ``limit`` rows the join stays a shuffle."""
    return F.broadcast(df) if df.limit(limit + 1).count() <= limit else df


def text_bytes(df: DataFrame, column: str = "text") -> int:
    return df.agg(F.sum(F.octet_length(column)).alias("n")).first()["n"] or 0


def unsigned32(column: Column) -> Column:
    return column.bitwiseAND(F.lit(0xFFFFFFFF).cast("long"))


def _stars(v: np.ndarray, u: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges between each node and the smallest one that it reaches along the given edges."""
    nodes, at = np.unique(np.concatenate([v, u]), return_inverse=True)
    a, b = np.split(at, 2)
    root = np.arange(len(nodes))
    while True:
        low, high = np.minimum(root[a], root[b]), np.maximum(root[a], root[b])
        apart = low < high
        if not apart.any():
            break
        np.minimum.at(root, high[apart], low[apart])
        while True:
            further = root[root]
            if np.array_equal(further, root):
                break
            root = further
    hung = np.flatnonzero(root != np.arange(len(nodes)))
    return nodes[hung], nodes[root[hung]]


def _hung(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Stars of the edges of a task, of so many at a time."""
    some, n = [], 0

    def told() -> pa.RecordBatch:
        v, u = _stars(*(np.concatenate([x.column(c).to_numpy() for x in some]) for c in (0, 1)))
        return pa.RecordBatch.from_arrays([pa.array(v, pa.int64()), pa.array(u, pa.int64())], names=["v", "u"])

    for batch in batches:
        for part in (batch.slice(i, TASK_EDGES) for i in range(0, batch.num_rows, TASK_EDGES)):
            if n + part.num_rows > TASK_EDGES:
                yield told()
                some, n = [], 0
            some.append(part)
            n += part.num_rows
    if some:
        yield told()


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, component)`` with the smallest node reachable, for every node of an undirected edge.

    First every task joins its own edges into stars, so few edges are done in one task and one job, and many have short
    ways left. Then alternating large and small stars: each round hangs the neighbours of a node on its smallest neighbour, first the
    larger ones, then the smaller ones. Edges never grow in number, no node's neighbours are gathered, and each round
    is written to the shared folder. The minima are written too: a join of two plain inputs is one that Spark splits
    where a node has very many edges. Ends when a round changes nothing.
    """
    now = stored(
        edges.select(F.greatest(a, b).alias("v"), F.least(a, b).alias("u")).where("u <> v").distinct()
    )
    tasks = -(-now.count() // TASK_EDGES)
    whole = {"v": "bigint", "u": "bigint"} == dict(now.dtypes)
    if whole and tasks:
        now = stored(now.coalesce(tasks).mapInArrow(_hung, "v bigint, u bigint"))
    seen = None
    while tasks > 1 or not whole:
        both = now.select("v", "u").unionByName(now.select(F.col("u").alias("v"), F.col("v").alias("u")))
        low = stored(both.groupBy("v").agg(F.min("u").alias("m")).select("v", F.least("v", "m").alias("m")))
        large = both.join(low, "v").where("u > v").select(F.col("u").alias("v"), F.col("m").alias("u")).distinct()
        large = stored(large)
        low = stored(large.groupBy("v").agg(F.min("u").alias("m")))
        star = large.join(low, "v")
        hung = star.where("u <> m").select(F.col("u").alias("v"), F.col("m").alias("u"))
        now = stored(hung.unionByName(low.select("v", F.col("m").alias("u"))).distinct())
        state = now.agg(F.count("*"), F.sum(F.xxhash64("v", "u").cast("decimal(38,0)"))).first()
        if state == seen:
            break
        seen = state
    return now.select(F.col("v").alias("node"), F.col("u").alias("component")).unionByName(
        now.select(F.col("u").alias("node"), F.col("u").alias("component")).distinct()
    )
