"""Spark session for local runs and tests, and the shared checkpoint folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = 8, memory: str = "12g") -> SparkSession:
    """A local session with the settings that every operator here expects."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("commonweave")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.mapKeyDedupPolicy", "LAST_WIN")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The folder for checkpoints: the one the cluster names in spark.checkpoint.dir. Only a
    local master, as in tests, gets an own one, removed at its end; a cluster that names none
    is refused, as a folder of one machine would not do."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not named:
        if not (sc.master.startswith("local[") or sc.master == "local"):
            raise RuntimeError("spark.checkpoint.dir names no shared folder")
        named = tempfile.mkdtemp(prefix="commonweave-")
        atexit.register(shutil.rmtree, named, ignore_errors=True)
    sc.setCheckpointDir(named)
    return sc.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """Write df to the shared checkpoint folder and go on from there: later
    stages neither recompute it nor depend on one executor's disk."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


#: Bytes of a scan for each task that Spark makes of it at least.
SPLIT_BYTES = 4 << 20


def spread(df: DataFrame) -> DataFrame:
    """df in at least as many partitions as tasks can run at once, for the sake of
    costly work per row. A scan large enough to be split so is left as it is; its
    size is taken from the plan, nothing is run."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()  # noqa: SLF001
    size = sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))
    return df if size >= cores * SPLIT_BYTES else df.repartition(cores)


def shuffle_partitions(spark: SparkSession) -> int:
    """The session's number of shuffle partitions, for repartitions that are to stay."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
