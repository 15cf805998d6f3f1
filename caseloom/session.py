"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SCRATCH_CONF = "spark.checkpoint.dir"

_local_roots: dict[str, str] = {}


def local_session(cores: int | str = 8, app: str = "caseloom") -> SparkSession:
    """A session for tests and the bench; on a cluster the session is given."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_root(spark: SparkSession) -> str:
    """The shared folder the cluster names; a temporary one on local masters."""
    root = spark.conf.get(SCRATCH_CONF, None) or spark.sparkContext.getConf().get(SCRATCH_CONF)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"{SCRATCH_CONF} must name a folder all executors share")
    app = spark.sparkContext.applicationId
    if app not in _local_roots:
        _local_roots[app] = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    return _local_roots[app]


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write once to the shared folder and read back.

    Used where one result feeds several branches (a drawn sample, paid-for
    model responses): the table survives lost executors, so neither the scan
    nor the model calls behind it are repeated.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
