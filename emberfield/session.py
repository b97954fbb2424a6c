"""Session helper and the durable-storage rules shared by every operator."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def get_session(app: str = "emberfield", cores: int | str = "*", memory: str = "12g") -> SparkSession:
    """Local session for tests and benchmarks; a cluster supplies its own session."""
    partitions = "8" if cores == "*" else str(cores)
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", partitions)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: the cluster's ``spark.checkpoint.dir``.

    Only a local master may fall back to a folder of its own, made once for the
    session and removed when the driver ends; on a cluster a machine-local folder
    would be lost together with its executor.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    own = tempfile.mkdtemp(prefix="emberfield-")
    atexit.register(shutil.rmtree, own, ignore_errors=True)
    spark.conf.set("spark.checkpoint.dir", own)
    return own


def durable(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder as Parquet and read it from there.

    Lineage is cut, lost executors lose nothing, and later steps read only the columns they use.
    """
    spark = df.sparkSession
    if any(f.dataType.typeName() == "void" for f in df.schema.fields):  # Parquet has no such type
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(shared_dir(spark))
        return df.checkpoint(eager=True)
    path = scratch_path(spark, "table")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fits_broadcast(df: DataFrame, rows: int, size: int = 64 << 20) -> bool:
    """Whether counting shows at most ``rows`` rows and, at the schema's width, ``size`` bytes.

    Counting stops one row past the limit, so the check stays cheap on a large table.
    """
    most = min(rows, size // max(1, df._jdf.schema().defaultSize()))
    return df.limit(most + 1).count() <= most


def sized_broadcast(df: DataFrame, rows: int = 200_000) -> DataFrame:
    """Broadcast ``df`` if counting shows it is small, else leave the join to Spark's shuffle."""
    return F.broadcast(df) if fits_broadcast(df, rows) else df


def scratch_path(spark: SparkSession, name: str) -> str:
    """Fresh path under the shared folder for a table written by a job or stream."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def data_partitions(df: DataFrame, per_task: int = 64 << 20) -> int:
    """Partitions for all of ``df``: about ``per_task`` bytes of its input files each, the session's number at least."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())]
    read = sum(s for s in sizes if s < 1 << 60)  # Spark's mark for rows given by the driver, whose size it doesn't know
    return max(shuffle_partitions(df.sparkSession), min(read // per_task, 100_000))


def dealt(df: DataFrame, *keys: Column | str, per_task: int = 16 << 20) -> DataFrame:
    """``df`` dealt by ``keys`` over as many partitions as its input files need; left alone where the session's number is enough.

    What follows and groups by these keys (or more) works on these partitions, so a task's memory doesn't grow with the input.
    """
    needed = data_partitions(df, per_task)
    return df.repartition(needed, *keys) if needed > shuffle_partitions(df.sparkSession) else df
