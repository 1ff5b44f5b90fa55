"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"


def local_session(cores: int | str = 8, shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A local session for tests and the bench; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tallyloom")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", memory)
        .getOrCreate()
    )


def shared_root(spark: SparkSession) -> str:
    """The folder all executors see, as the cluster names it in spark.checkpoint.dir."""
    named = spark.conf.get(CHECKPOINT_KEY, None) or spark.sparkContext.getConf().get(CHECKPOINT_KEY)
    if named:
        return named.rstrip("/")
    set_already = spark.sparkContext.getCheckpointDir()
    if set_already:
        return set_already.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_KEY} to a folder that every executor can reach")
    return tempfile.mkdtemp(prefix="tallyloom-")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder; nothing is ever written there twice."""
    return f"{shared_root(spark)}/tallyloom/{label}-{uuid.uuid4().hex}"


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the shared folder."""
    spark = df.sparkSession
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(shared_root(spark))
    return df.checkpoint(eager=True)
