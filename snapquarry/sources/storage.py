"""The folder that driver and executors share."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir. Where it is unset a session of one process gets a new folder; on a cluster, where no folder of one machine can stand in for it, that is an error."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if re.match(r"local(\[|$)", spark.sparkContext.master) is None:
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        path = "file://" + tempfile.mkdtemp(prefix="spark-shared-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", path)
    return path


def written(df: DataFrame) -> DataFrame:
    """Cut lineage: df as a table in the shared folder, read back."""
    path = f"{shared_dir(df.sparkSession)}/tables/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
