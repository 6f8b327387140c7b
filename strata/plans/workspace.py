"""Where jobs keep what they write."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared folder the session names, or below its warehouse where it names none."""
    shared = spark.conf.get("spark.checkpoint.dir", "") or spark.sparkContext.getConf().get("spark.checkpoint.dir", "")
    if not shared:
        shared = spark.conf.get("spark.sql.warehouse.dir")
    return f"{shared.rstrip('/')}/strata/{name}-{uuid.uuid4().hex}"
