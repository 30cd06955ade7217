"""Session set-up and the shared folder used to cut lineage."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"


def local_session(cores: str = "8", app: str = "gevel", **conf: str) -> SparkSession:
    """A local session for tests and benchmarks; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", cores if cores.isdigit() else "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_private: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach; a private one only in local mode where none is named."""
    named = spark.conf.get(CHECKPOINT_KEY, None)
    if named:
        return named
    if not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise RuntimeError(f"set {CHECKPOINT_KEY} to a folder that the driver and all executors share")
    app = spark.sparkContext.applicationId
    if app not in _private:
        _private[app] = tempfile.mkdtemp(prefix="gevel-")
    return _private[app]


def cut_lineage(df: DataFrame) -> DataFrame:
    """Writes the rows once to the shared folder and reads them back.

    A lost executor then re-reads files instead of replaying the plan, and plans that use
    the rows several times compute them once.
    """
    path = f"{shared_dir(df.sparkSession).rstrip('/')}/gevel-{uuid.uuid4().hex}"
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
