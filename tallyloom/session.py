"""Session and shared-folder helpers.

Nothing here is needed on a cluster, where the session comes from spark-submit; ``local_session`` is what the tests
and the benchmark use.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A single-machine session for tests and benchmarks."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tallyloom")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it in ``spark.checkpoint.dir``.

    Only where the setting is absent (a local session) a temporary folder stands in for it.
    """
    context = spark.sparkContext
    configured = context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="tallyloom-"))
    return context.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as a table in the shared folder and return a scan of it.

    Used where one expensive frame feeds several branches. A written table survives lost executors, cuts the lineage,
    and gives the optimizer real sizes, so a small result is broadcast by the planner's own size check.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
