"""Tables as they are stored."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def spread(df: DataFrame) -> DataFrame:
    """df, dealt out to all cores if its files have fewer splits than there are cores: a small table, whose texts may still take
    long. A table of as many splits is read as it lies."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def parquet(spark: SparkSession, path: str, *columns: str) -> DataFrame:
    df = spark.read.parquet(path)
    return spread(df.select(*columns) if columns else df)


def scratch(spark: SparkSession, what: str) -> str:
    """A new folder's path under spark.checkpoint.dir, which driver and executors share, or in local mode a temporary one."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        own = tempfile.mkdtemp(prefix="vellum-")
        atexit.register(shutil.rmtree, own, True)
        found = f"file://{own}"
    return f"{found.rstrip('/')}/{what}-{uuid.uuid4().hex}"
