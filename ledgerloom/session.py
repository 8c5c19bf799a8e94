"""Session settings and table access."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | str = 8, shuffle_partitions: int = 8) -> SparkSession:
    """A single-JVM session for tests and the bench; a cluster brings its own."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("ledgerloom")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("LEDGERLOOM_DRIVER_MEMORY", "8g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder of spark.checkpoint.dir. Where it is unset, a temporary one on a single machine; a cluster must name one."""
    sc = spark.sparkContext
    said = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    held = sc._jsc.sc().getCheckpointDir()
    if not said and held.isDefined():
        return held.get()
    if not said:
        master = sc.master
        if master != "local" and not master.startswith("local["):
            raise ValueError(f"spark.checkpoint.dir is unset: the cluster {master} must name a folder that all its machines share")
        said = os.path.join(tempfile.gettempdir(), "ledgerloom-checkpoint")
    if held.isEmpty():
        sc.setCheckpointDir(said)
    return said


def cut(df: DataFrame, eager: bool = True) -> DataFrame:
    """The same rows with their lineage cut by a reliable checkpoint, which outlives lost executors."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=eager)


def merged(df: DataFrame) -> DataFrame:
    """The same rows, joined by sort and merge whatever the threshold for broadcasts.

    For exploded rows, made texts and what is aggregated from them: the optimizer takes their size for
    that of the narrow table they come from, and would send all of them to the driver.
    """
    return df.hint("merge")


def spread(df: DataFrame) -> DataFrame:
    """The same rows over at least as many partitions as there are cores: for work that costs far more than moving its input.

    Only plain scans are asked for their partitions; a plan with a shuffle would have to run to tell.
    """
    plan = df._jdf.queryExecution()
    if plan.executedPlan().toString().startswith("AdaptiveSparkPlan"):
        return df
    want = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(want) if plan.toRdd().getNumPartitions() < want else df
