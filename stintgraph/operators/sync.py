"""Keeping the employment table in step with its source: rows from documents, change detection,
differences by key, and writes that never overwrite what is being read."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The text columns of a stored record.
TEXT = ("document_id", "person_nbr", "first_name", "middle_name", "last_name", "agency_name", "state", "start_date", "end_date", "separation_reason")
UNCHANGED = "unchanged"


def stored_text(c: Column) -> Column:
    """Empty text is stored as null and shown as empty."""
    return F.when(c != "", c)


def doc_rows(docs: DataFrame) -> DataFrame:
    """Table rows of nested source documents: missing text is empty, ``raw`` holds the whole document."""
    own = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) if c in docs.columns else F.lit("").alias(c) for c in TEXT]
    queries = F.to_json("searchQueries") if "searchQueries" in docs.columns else F.lit(None).cast("string")
    return docs.select("fs_path", *own, queries.alias("search_queries"), F.to_json(F.struct("*")).alias("raw"))


def append_new(existing: DataFrame, incoming: DataFrame, key: str = "fs_path") -> DataFrame:
    """Rows of ``incoming`` whose key isn't in ``existing``, one per key."""
    return incoming.dropDuplicates([key]).join(existing.select(key), key, "left_anti")


def sync_plan(stats: DataFrame, meta: DataFrame, counts: DataFrame) -> DataFrame:
    """state, reason of all states in ``stats`` (state, last_updated): ``new state``, ``last_updated
    advanced``, ``row count changed`` or unchanged. ``meta``: state, last_updated, row_count; ``counts``: state, n."""
    m = meta.select("state", F.col("last_updated").alias("_was"), F.col("row_count").alias("_rows"), F.lit(True).alias("_known"))
    rows = stats.join(m, "state", "left").join(counts, "state", "left")
    reason = (
        F.when(F.col("_known").isNull(), "new state")
        .when(F.col("last_updated") > F.col("_was"), "last_updated advanced")
        .when(F.coalesce("n", F.lit(0)) != F.coalesce("_rows", F.lit(0)), "row count changed")
        .otherwise(UNCHANGED)
    )
    return rows.select("state", reason.alias("reason"))


def same_document(a: Column, b: Column) -> Column:
    """Equal as JSON, whatever the order of keys; text that isn't JSON is compared as it is."""
    plain = lambda c: F.coalesce(F.to_json(F.try_parse_json(c)), c)
    return plain(a).eqNullSafe(plain(b))


def diff(live: DataFrame, incoming: DataFrame, key: str = "fs_path", value: str = "raw") -> DataFrame:
    """key and action of every row of either: insert, update, delete or keep. Both hold the states being synchronised, one row per key."""
    a = live.select(key, F.col(value).alias("_a"), F.lit(True).alias("_live"))
    b = incoming.select(key, F.col(value).alias("_b"), F.lit(True).alias("_new"))
    action = (
        F.when(F.col("_live").isNull(), "insert")
        .when(F.col("_new").isNull(), "delete")
        .when(~same_document(F.col("_a"), F.col("_b")), "update")
        .otherwise("keep")
    )
    return a.join(b, key, "full").select(key, action.alias("action"))


def baseline(counts: DataFrame, stats: DataFrame) -> DataFrame:
    """state, last_updated, row_count: metadata of a table that is in step already, nothing being pulled.
    ``counts``: state, n; ``stats``: state, last_updated. States without rows count 0."""
    return stats.join(counts, "state", "left").select("state", "last_updated", F.coalesce("n", F.lit(0)).cast("bigint").alias("row_count"))


def resync_counts(live: DataFrame, incoming: DataFrame, key: str = "fs_path", value: str = "raw") -> DataFrame:
    """pulled, changed (new ones included), deleted of a resync: one row. Changes nothing, so it is also its dry run."""
    did = F.col("action")
    told = diff(live, incoming, key, value)
    return told.agg(F.count_if(did != "delete").alias("pulled"), F.count_if(did.isin("insert", "update")).alias("changed"), F.count_if(did == "delete").alias("deleted"))


def merged(live: DataFrame, incoming: DataFrame, states: list[str], key: str = "fs_path", value: str = "raw") -> DataFrame:
    """The table after a resync of ``states``: their vanished rows go, new ones come, others change only
    if their document does. Deletion is confined to the states, the key is global."""
    here = F.col("state").isin(states)
    b = incoming.select(key, F.struct(*[F.col(c).alias(c) for c in live.columns]).alias("_b"))
    a = live.select(F.col(key), F.struct(*live.columns).alias("_a"), here.alias("_here"))
    both = a.join(b, key, "full").where(F.col("_b").isNotNull() | ~F.col("_here"))
    same = same_document(F.col("_a")[value], F.col("_b")[value])
    row = F.when(F.col("_b").isNull() | (F.col("_a").isNotNull() & same), F.col("_a")).otherwise(F.col("_b"))
    return both.select(row.alias("_row")).select("_row.*")


def meta_after(meta: DataFrame, fresh: DataFrame) -> DataFrame:
    return meta.join(fresh.select("state"), "state", "left_anti").unionByName(fresh)


def swap_in(table: DataFrame, path: str) -> str:
    """Writes a new version beside the others and then names it current, in one small file more. Nothing
    that readers know is touched: until the new name is complete they find the one before it."""
    spark = table.sparkSession
    version = f"{path}/v-{uuid.uuid4().hex}"
    table.write.partitionBy("state").parquet(version)
    number = max((n for n, _ in _names(spark, path)), default=0) + 1
    spark.createDataFrame([(version,)], "version string").coalesce(1).write.json(f"{path}/current/{number:012d}-{uuid.uuid4().hex}")
    return version


def _names(spark: SparkSession, path: str) -> list[tuple[int, str]]:
    """Number and folder of every complete name, as the store itself lists them."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/current/*/_SUCCESS")
    found = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(at) or []
    folders = [str(x.getPath().getParent().toString()) for x in found]
    return sorted((int(f.rpartition("/")[2].split("-")[0]), f) for f in folders)


def current(spark: SparkSession, path: str) -> DataFrame:
    names = _names(spark, path)
    if not names:
        raise FileNotFoundError(f"no version is current under {path}")
    return spark.read.parquet(spark.read.schema("version string").json(names[-1][1]).first()[0])
