"""Shared folder for tables and checkpoints that a query writes on its way."""

import atexit
import shutil
import tempfile
import uuid
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"


@lru_cache(maxsize=1)
def _own_root() -> str:
    """One temporary root per process, removed when it ends."""
    root = tempfile.mkdtemp(prefix="tillwise-")
    atexit.register(shutil.rmtree, root, ignore_errors=True)
    return root


def shared_folder(spark: SparkSession) -> str:
    """The folder the session names; a temporary one only in local mode without it."""
    folder = spark.conf.get(CHECKPOINT_SETTING, None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_SETTING} to a folder that all executors share")
    return _own_root()


def new_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_folder(spark)}/{purpose}-{uuid.uuid4().hex[:12]}"


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` below the shared folder and read it back.

    For tables that several later steps read: the work before is done once, and a lost
    executor costs a re-read instead of a re-run.
    """
    path = f"{new_folder(df.sparkSession, purpose)}/table"
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)
