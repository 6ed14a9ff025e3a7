"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job relies on; all of them can be changed on a running session.
JOB_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the job settings to a session that somebody else created."""
    for key, value in JOB_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: int = 8, app: str = "tillhouse") -> SparkSession:
    """A local session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def shared_root(spark: SparkSession) -> str:
    """The folder all executors can reach, as named by the cluster.

    Only where ``spark.checkpoint.dir`` is unset and Spark runs on a single
    machine (tests) a temporary folder is made and remembered in the session.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.conf.get("tillhouse.shared.root", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="tillhouse-")
        spark.conf.set("tillhouse.shared.root", root)
    return root.rstrip("/")


def new_folder(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder; Spark creates it on first write."""
    return f"{shared_root(spark)}/tillhouse/{label}-{uuid.uuid4().hex}"


def staged(df, label: str):
    """Write ``df`` once to the shared folder and return a scan of the copy.

    Used where a result feeds several later steps or replaces its own input:
    it cuts the lineage, fixes non-deterministic columns, survives the loss of
    executors and gives the planner real file sizes.
    """
    path = new_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
