"""Folders for tables that one job writes and a later one reads."""

import tempfile
import uuid

from pyspark.sql import SparkSession

_OWN: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors share, ``spark.checkpoint.dir``.

    In local mode a new temporary folder takes its place where it is unset. On a cluster that would be another folder
    on each machine, and tables would come back incomplete without an error; so it raises.
    """
    named = spark.conf.get("spark.checkpoint.dir", "")
    if named:
        return named.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if "dir" not in _OWN:
        _OWN["dir"] = "file://" + tempfile.mkdtemp(prefix="clustertrace-")
    return _OWN["dir"]


def new_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing uses yet."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
