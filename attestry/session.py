"""Session settings that every entry point of the engine uses."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Kept apart from cluster settings: only what results depend on is forced.
REQUIRED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def local_session(cores: int | str = "*", app: str = "attestry", shuffle_partitions: int = 8, memory: str = "6g") -> SparkSession:
    """A session for tests and benchmarks; a cluster brings its own."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    conf = REQUIRED | {
        "spark.sql.shuffle.partitions": str(shuffle_partitions),
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": os.environ.get("ATTESTRY_DRIVER_MEMORY", memory),
    }
    spark = builder.config(map=conf).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch(spark: SparkSession) -> str:
    """A new path in the shared folder that spark.checkpoint.dir names; where that is unset a temporary one on a local master, and an error on a cluster."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = tempfile.gettempdir()
    return f"{base.rstrip('/')}/attestry-{uuid.uuid4().hex}"


def settled(df: DataFrame) -> DataFrame:
    """df as a table in the shared folder: what reads it more than once neither repeats its work nor carries its plan, and a lost executor costs nothing."""
    path = scratch(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
