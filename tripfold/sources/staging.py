"""A place for intermediate tables that every executor can reach."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

SHARED_FOLDER = "spark.checkpoint.dir"


def new_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh path under the shared folder the session names.

    There is no fallback: a folder of this machine is refused unless the executors run on it.
    """
    return f"{shared_root(spark.conf.get(SHARED_FOLDER, None), spark.sparkContext.master)}/{purpose}-{uuid.uuid4().hex}"


def shared_root(shared: str | None, master: str) -> str:
    if not shared:
        raise ValueError(f"set {SHARED_FOLDER} to a folder all executors share")
    if shared.startswith("file:") and not master.startswith("local"):
        raise ValueError(f"{SHARED_FOLDER} is on one machine, {shared}: executors elsewhere miss it")
    return shared.rstrip("/")


def materialised(frame: DataFrame, path: str) -> DataFrame:
    """Write a frame and read it back: later results start from the files, not the lineage."""
    frame.write.mode("overwrite").parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)
