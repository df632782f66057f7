"""Where intermediate tables go."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def scratch_path(spark: SparkSession, name: str) -> str:
    """New path below the shared folder the cluster names in ``spark.checkpoint.dir``; where unset, in the warehouse."""
    folder = spark.conf.get(CHECKPOINT_DIR, None) or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"
    return f"{folder.rstrip('/')}/{name}-{uuid.uuid4().hex}"
