"""What stands in the folder that all executors share: scratch files and tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def _folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``. Without the setting a local session has a temporary one; a cluster has none
    that its executors share, so there this raises an error."""
    context = spark.sparkContext
    configured = context.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if configured:
        return configured
    if not context.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    context.setCheckpointDir("file://" + tempfile.mkdtemp(prefix="framelens-"))
    return context.getCheckpointDir()


def scratch(spark: SparkSession, label: str) -> str:
    """A new path in the shared folder, removed when the application ends."""
    path = f"{_folder(spark).rstrip('/')}/framelens/{label}-{uuid.uuid4().hex}"
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(place)
    return path


def written(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder and read back, which cuts its lineage. Sizes are known again from then on, where
    a checkpoint would carry on estimates that multiply with every join."""
    path = scratch(df.sparkSession, "table")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
