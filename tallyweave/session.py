"""Session helpers: the shared folder and staged tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Local sessions without the setting (tests) get a temporary folder; a
    cluster without it is an error, since a machine-local folder would be lost
    with its executor.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
    folder = tempfile.mkdtemp(prefix="tallyweave-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def run_folder(spark: SparkSession) -> str:
    """Folder of this application's staged tables; delete it when its results are stored."""
    return f"{shared_folder(spark)}/tallyweave/{spark.sparkContext.applicationId}"


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Later plans start from the written files instead of recomputing the
    lineage, survive the loss of executors, read only the columns they use,
    and see the true table size: a staged table joins by broadcast only while
    it is below ``spark.sql.autoBroadcastJoinThreshold`` and by shuffle above.
    """
    spark = df.sparkSession
    path = f"{run_folder(spark)}/{uuid.uuid4().hex}/{label}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def build_session(app_name: str = "tallyweave", **conf: str) -> SparkSession:
    """Session with the settings the jobs rely on; ``conf`` overrides them."""
    builder = SparkSession.builder.appName(app_name)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        # The JVM does not compile methods above 8000 bytes; wide records reach that.
        "spark.sql.codegen.hugeMethodLimit": "8000",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
