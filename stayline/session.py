"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
import warnings
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F


def local_session(cores: str = "8", shuffle_partitions: str = "8", memory: str = "8g") -> SparkSession:
    """Single-JVM session for tests and the benchmark."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("stayline")
        .config("spark.sql.shuffle.partitions", shuffle_partitions)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        # Recording the Python call site of every column expression slows plan building.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def cluster_settings(shuffle_bytes: int, partition_bytes: int = 256 * 2**20) -> dict[str, str]:
    """Session settings for a job whose largest shuffle moves about ``shuffle_bytes``.

    Enough initial partitions that each fits in an executor's memory share; adaptive
    execution merges what turns out small and splits what turns out skewed, also when the
    split costs another exchange of partial aggregates.
    """
    partitions = max(200, -(-shuffle_bytes // partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        "spark.sql.session.timeZone": "UTC",
    }


_SCOPES: list[list[str]] = []


def scratch_root(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder.

    A machine-local folder is only ever chosen for a local master, where every
    task runs on this machine. On a cluster a ``file:`` folder can only be right as a mount
    that all machines share, which the session can't see: it is taken with a warning.
    """
    sc = spark.sparkContext
    root = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if root:
        if root.startswith("file:") and not sc.master.startswith("local"):
            warnings.warn(f"{root} must be a mount that all executors share", stacklevel=2)
        return root
    if not (sc.master == "local" or sc.master.startswith("local[")):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    root = tempfile.mkdtemp(prefix="stayline-")
    sc.setCheckpointDir(root)
    return sc.getCheckpointDir() or root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder name under the shared scratch root, owned by the innermost scope."""
    path = f"{scratch_root(spark)}/stayline/{name}-{uuid.uuid4().hex}"
    if _SCOPES:
        _SCOPES[-1].append(path)
    return path


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Own what is staged inside, and delete it at the end.

    A frame that reads a staged table must be used up before the scope closes. Without a
    scope staged tables stay until the scratch folder is emptied.
    """
    _SCOPES.append([])
    try:
        yield
    finally:
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        for path in _SCOPES.pop():
            target = spark._jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(conf).delete(target, True)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Compute ``df`` once into shared storage and read it back.

    Used where several jobs need the same intermediate: the written table survives
    lost executors, cuts the lineage, and gives later joins real sizes to plan with.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stage_counted(df: DataFrame, name: str) -> tuple[DataFrame, int]:
    """As :func:`stage`, plus the number of rows, counted while they are written."""
    staged, found = stage_tallied(df, name, {})
    return staged, found["n"]


def stage_tallied(df: DataFrame, name: str, conditions: dict[str, Column]) -> tuple[DataFrame, dict[str, int]]:
    """As :func:`stage`, plus ``n`` rows and how many meet each condition, counted while they are written."""
    seen = Observation(name)
    staged = stage(df.observe(seen, *tallies(conditions)), name)
    return staged, seen.get


def tallies(conditions: dict[str, Column]) -> list[Column]:
    return [F.count(F.lit(1)).alias("n"), *[F.count_if(c).alias(k) for k, c in conditions.items()]]
