"""Resumable ingest: files are taken once each, however often the load is begun again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def latest_stats(stats: DataFrame) -> DataFrame:
    """state, last_updated of source statistics: the latest of each state, those without a state left out."""
    return stats.where("state is not null").groupBy("state").agg(F.max("last_updated").alias("last_updated"))


def ingest_available(spark: SparkSession, source: str, schema: StructType, target: str, checkpoint: str, pattern: str = "*.parquet", files_at_once: int = 100) -> None:
    """Appends all files of ``source`` that aren't taken yet to ``target``, and ends."""
    stream = spark.readStream.schema(schema).option("pathGlobFilter", pattern).option("maxFilesPerTrigger", files_at_once).parquet(source)
    query = stream.writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def page_after(docs: DataFrame, cursor: str | None, page: int = 5000, key: str = "fs_path") -> DataFrame:
    """The next ``page`` documents in order of their keys behind ``cursor`` (from the start where it is None), so that
    a load goes on where another one ended: its cursor is the last key it has."""
    rest = docs if cursor is None else docs.where(F.col(key) > cursor)
    return rest.orderBy(key).limit(page)
