"""Where jobs may put intermediate files."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid
from functools import lru_cache

from pyspark.sql import SparkSession


@lru_cache(maxsize=1)
def _local_folder() -> str:
    folder = tempfile.mkdtemp(prefix="lodgemart-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


def scratch_path(spark: SparkSession, purpose: str) -> str:
    """A new folder name under the shared folder that ``spark.checkpoint.dir`` names.

    Only a local session may fall back to the machine's own temporary folder, which is
    emptied when Python ends: on a cluster no other executor would see it. What lies in
    the shared folder is left to its owner, as other jobs may still read it.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        # "local-cluster" is not local: its executors are processes of their own.
        if not re.fullmatch(r"local(\[.*\])?", spark.conf.get("spark.master", "")):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = _local_folder()
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
