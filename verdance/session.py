"""Session settings and the shared scratch folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

# Only settings that hold at any cluster size.  Shuffle parallelism, memory
# and file split sizes belong to the deployment.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


#: Removes an execution's shuffle files when it ends.
DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_made: list[str] = []


def get_session(app_name: str = "verdance", master: str | None = None, **settings: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh path in a folder that the driver and every executor can reach.

    The folder is the one the session names in ``spark.checkpoint.dir``, else
    one below the session's warehouse.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"
    path = f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
    _made.append(path)
    return path


def scratch_mark() -> int:
    """A mark for ``remove_scratch``: the folders asked for so far."""
    return len(_made)


def remove_scratch(spark: SparkSession, since: int = 0, until: int | None = None) -> None:
    """Removes the scratch folders this process has asked for between the marks, when results are written."""
    gone = _made[since:until]
    del _made[since:until]
    for name in gone:
        path = spark._jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def materialise(df: DataFrame, purpose: str) -> DataFrame:
    """Write an intermediate table to the shared folder and read it back.

    It outlives lost executors and is computed once however often it is used.
    What was shuffled for it leaves the executors' disks once it is written.
    """
    spark = df.sparkSession
    path = shared_dir(spark, purpose)
    before = spark.conf.get(DROP_SHUFFLES, None)
    spark.conf.set(DROP_SHUFFLES, "true")
    try:
        df.write.parquet(path)
    finally:
        if before is None:
            spark.conf.unset(DROP_SHUFFLES)
        else:
            spark.conf.set(DROP_SHUFFLES, before)
    return spark.read.parquet(path)
