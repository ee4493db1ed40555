"""Where jobs keep what the whole cluster reads."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir; only where that is unset, in a local session, one of this process' own."""
    at = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not at:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError("spark.checkpoint.dir must name a folder that the whole cluster shares")
        at = _own()
    return at.rstrip("/")


def kept(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once in the shared folder and read again: for what a plan reads many times."""
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@lru_cache(1)
def _own() -> str:
    at = tempfile.mkdtemp(prefix="stintgraph-")
    atexit.register(shutil.rmtree, at, True)
    return at
