"""A folder for tables that queries build: in the cluster's shared folder if it names one, else a temporary one, where all is one process."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def folder(spark: SparkSession, name: str) -> str:
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the cluster shares")
        return tempfile.mkdtemp(prefix=f"{name}-")
    return f"{shared.rstrip('/')}/tables/{name}-{uuid.uuid4().hex}"
