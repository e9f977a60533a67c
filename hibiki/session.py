"""Session and checkpoint settings that every query may rely on."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str = "*", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A session for tests and the bench; on a cluster the caller brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("hibiki")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints.

    The cluster's ``spark.checkpoint.dir`` is used as it is. Only where it is
    unset *and* the master is a single machine is a temporary folder made.
    """
    sc = spark.sparkContext
    known = sc.getCheckpointDir()
    if known:
        return known
    named = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        named = os.path.join(tempfile.gettempdir(), "hibiki-checkpoints")
    sc.setCheckpointDir(named)
    return named


def cut(df: DataFrame) -> DataFrame:
    """Write the rows to the shared checkpoint folder and go on from there.

    For results that are read more than once, or that follow an iterative step:
    a lost executor then costs a read, not the whole lineage.
    """
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tasks(spark: SparkSession) -> int:
    """How many tasks a costly step is spread over: as many as a shuffle has, two a core at least."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), 2 * spark.sparkContext.defaultParallelism)


def spread(scan: DataFrame) -> DataFrame:
    """A table whose rows each cost much time, over all cores: few small files are few tasks otherwise.

    To be used on a scan, whose partitions are known without running anything; a
    scan that has a partition a core stays as it is.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan.repartition(2 * cores) if scan.rdd.getNumPartitions() < cores else scan
