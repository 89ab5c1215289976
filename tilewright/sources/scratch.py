"""Intermediate tables in the folder that the driver and all executors share."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def scratch_dir(spark: SparkSession) -> str:
    """The session's ``spark.checkpoint.dir``; only where it is unset and the session is local (tests) a temporary folder of this machine."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir is unset: a cluster's tasks need a folder that they share")
        found = tempfile.mkdtemp(prefix="tilewright-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found


def new_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing has yet."""
    return f"{scratch_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as a Parquet table and read again: the plan starts anew from files that outlive executors."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
