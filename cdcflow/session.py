"""Session settings that the results depend on, and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def configure(spark: SparkSession) -> SparkSession:
    """Set the options that results and generated code depend on; leaves sizing to the cluster."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    # The JVM leaves methods above 8000 bytes uncompiled; Spark then had better use small ones.
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", "8000")
    return spark


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder every executor can reach.

    The cluster names the parent in ``spark.checkpoint.dir``. Only a local master may fall
    back to this machine's temporary folder.
    """
    parent = spark.conf.get("spark.checkpoint.dir", None)
    if parent:
        return os.path.join(parent, f"cdcflow-{name}-{uuid.uuid4().hex}")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster")
    return os.path.join(tempfile.mkdtemp(prefix="cdcflow-"), name)
