"""Where derived files go.

Executors and driver must see the same files and any of them may be lost, so written
tables and streaming checkpoints live below the shared folder that the cluster names in
``spark.checkpoint.dir``, or below the session's warehouse where that is unset.
"""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

SHARED_DIR_KEY = "spark.checkpoint.dir"
WAREHOUSE_KEY = "spark.sql.warehouse.dir"


def shared_root(spark: SparkSession) -> str:
    """The shared folder of the session."""
    root = spark.conf.get(SHARED_DIR_KEY, None)
    return root.rstrip("/") if root else f"{spark.conf.get(WAREHOUSE_KEY).rstrip('/')}/_shared"


def new_dir(spark: SparkSession, label: str) -> str:
    """A path nobody has used yet; Spark creates it on the first write."""
    return f"{shared_root(spark)}/{label}-{uuid.uuid4().hex}"
