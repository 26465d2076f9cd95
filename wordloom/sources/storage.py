"""Folders that driver and executors share."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession


def fresh_folder(spark: SparkSession, kind: str) -> str:
    """A new folder under ``spark.checkpoint.dir``; under a temporary one in a local session that names none (tests)."""
    sc = spark.sparkContext
    named = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if named is None:
        if not sc.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        sc.setCheckpointDir("file://" + tempfile.mkdtemp(prefix="wordloom-"))
        named = sc.getCheckpointDir()
    return f"{named.rstrip('/')}/{kind}-{uuid.uuid4().hex}"


def opened(uri: str):
    """(pyarrow file system, path in it) of a URI in the shared folder, for tasks that write or read files of their own."""
    from pyarrow import fs

    # Hadoop writes local paths with one slash.
    return fs.FileSystem.from_uri(re.sub("^file:/(?!/)", "file:///", uri))
