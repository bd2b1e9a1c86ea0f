"""Session settings and lineage control shared by jobs, tests and the benchmark."""

from __future__ import annotations

import atexit
import contextlib
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def local_session(cores: int | str = "*", app: str = "marquee") -> SparkSession:
    """Session for tests and the benchmark; a cluster job brings its own."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for key, value in CONF.items():
        builder = builder.config(key, value)
    return (
        builder.config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .getOrCreate()
    )


def use_utc(spark: SparkSession) -> SparkSession:
    """Every timestamp rule here is written in UTC; pin the session to it."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by the cluster; a scratch folder only in local mode."""
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        configured = tempfile.mkdtemp(prefix="marquee-checkpoint-")
    context.setCheckpointDir(configured)
    return configured


_SCRATCH: list[str] = []


def scratch_path(spark: SparkSession) -> str:
    """A new path in the shared folder that every executor can reach; removed with the job."""
    path = f"{ensure_checkpoint_dir(spark)}/marquee-{uuid.uuid4().hex}"
    _SCRATCH.append(path)
    return path


def scratch_mark() -> int:
    """A point in time for ``remove_scratch``."""
    return len(_SCRATCH)


def remove_scratch(spark: SparkSession, since: int = 0) -> None:
    """Removes what ``scratch_path`` gave out in this process since a mark. Frames that read it
    end here."""
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    while len(_SCRATCH) > since:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_SCRATCH.pop())
        path.getFileSystem(hadoop).delete(path, True)


@atexit.register
def _job_ends() -> None:
    spark = SparkSession.getActiveSession()
    if spark is not None and spark.sparkContext._jsc is not None:
        with contextlib.suppress(Exception):  # the cluster may be gone before this process
            remove_scratch(spark)


def stored_alone(df: DataFrame, since: int) -> DataFrame:
    """Stores the rows and removes all scratch tables since the mark that led to them."""
    out = stored(df)
    own = _SCRATCH.pop()
    remove_scratch(df.sparkSession, since)
    _SCRATCH.append(own)
    return out


def stored(df: DataFrame, compression: str | None = None) -> DataFrame:
    """Writes the rows once to the shared folder and reads them back.

    For results that several later steps read: the files survive a lost executor,
    end the lineage, and still allow column pruning and filter pushdown. ``compression``: of the
    files, the session's if none.
    """
    spark = df.sparkSession
    path = scratch_path(spark)
    df.write.parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)
