"""Session settings shared by every operator: where lineage is cut and how wide ordered work is spread."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows and bytes (as text) a join side may have to be sent to every executor. Beyond them the join stays a shuffle join.
BROADCAST_ROW_LIMIT = 200_000
BROADCAST_BYTE_LIMIT = 64 << 20


def local_session(cores: str = "*", app: str = "phenoloom", shuffle_partitions: int = 8) -> SparkSession:
    """A session for tests and the bench. On a cluster, pass the session the cluster gives you instead."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    Where none is set, a temporary folder serves a session whose driver and executors are one process; any other
    session needs a folder that all its machines share, so its absence is an error.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if named is None and not runs_in_one_process(sc.master):
            raise ValueError(f"set spark.checkpoint.dir to a folder that all machines of {sc.master} share")
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="phenoloom-"))
    return sc.getCheckpointDir()


def runs_in_one_process(master: str) -> bool:
    return master == "local" or master.startswith("local[")


def materialise(df: DataFrame) -> DataFrame:
    """Compute ``df`` once, write it to the shared checkpoint folder and go on from there.

    Used where a result is read several times or where a driver loop would grow the plan. The copy survives the
    loss of executors.
    """
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def small_side(df: DataFrame, limit: int = BROADCAST_ROW_LIMIT) -> DataFrame:
    """Hint a broadcast only after counting rows and bytes of the (already materialised) table; else leave a shuffle join."""
    size = F.sum(F.length(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns])))).alias("bytes")
    seen = df.limit(limit + 1).agg(F.count("*").alias("rows"), size).first()
    return F.broadcast(df) if seen["rows"] <= limit and (seen["bytes"] or 0) <= BROADCAST_BYTE_LIMIT else df


def ordered_slices(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
