"""Where queries that write and read again keep their files: the cluster's shared folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession


#: Temporary folders of sessions in one process that name no shared one.
_OWN: dict[str, str] = {}


def scratch_path(spark: SparkSession, what: str) -> str:
    """A fresh path under spark.checkpoint.dir; a temporary folder only where none is set and all runs in one process."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        app = spark.sparkContext.applicationId  # a running session takes no new spark.checkpoint.dir
        if app not in _OWN:
            _OWN[app] = f"file://{tempfile.mkdtemp(prefix='tidemark-')}"
        found = _OWN[app]
    return f"{found.rstrip('/')}/{what}-{uuid.uuid4().hex}"
