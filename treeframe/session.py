"""Session-level settings: the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_local_base: str | None = None


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder path under the folder that ``spark.checkpoint.dir`` names.

    Only a local session may go without the setting; it then uses a temporary
    folder of this machine.
    """
    global _local_base
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a shared folder on a cluster")
        _local_base = _local_base or tempfile.mkdtemp(prefix="treeframe-")
        base = _local_base
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
