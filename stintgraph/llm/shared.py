"""Where operators keep what several tasks or jobs read, and how arrays travel between tasks."""

from __future__ import annotations

import ctypes
import functools
import uuid
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from stintgraph.llm.shingles import forget
from stintgraph.sources.places import shared_dir


Work = Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]
#: Parameters of the C library's mallopt.
M_TRIM_THRESHOLD, M_MMAP_THRESHOLD = -1, -3


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{_folder(spark)}/{name}-{uuid.uuid4().hex}"


def _folder(spark: SparkSession) -> str:
    return f"stintgraph-{spark.sparkContext.applicationId}"


def clear(spark: SparkSession) -> None:
    """Removes all that operators of this application keep in the shared folder. What they returned before
    can't be read any more then, so it is for the end of a job."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/{_folder(spark)}")
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet in the shared folder and read again: cuts lineage, survives lost
    executors, and gives later joins sizes to plan with."""
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def n_shuffle(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def portions(batches: Iterable[pa.RecordBatch], most: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``most`` bytes, so that what is made of a batch stays small."""
    for b in batches:
        step = max(1, b.num_rows * most // max(1, b.nbytes))
        for at in range(0, b.num_rows, step):
            yield b.slice(at, step)


@lru_cache(1)
def _libc() -> ctypes.CDLL:
    """The C library, told to give large blocks back at once: workers stay when their task has ended."""
    lib = ctypes.CDLL(None)
    if hasattr(lib, "mallopt"):
        lib.mallopt(M_MMAP_THRESHOLD, 1 << 18)
        lib.mallopt(M_TRIM_THRESHOLD, 1 << 18)
    return lib


def lean(work: Work) -> Work:
    """``work``, after which its worker gives back the memory that it doesn't use."""

    @functools.wraps(work)
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lib = _libc()
        try:
            yield from work(batches)
        finally:
            forget()
            pa.default_memory_pool().release_unused()
            if hasattr(lib, "malloc_trim"):
                lib.malloc_trim(0)

    return run


def raw(array: np.ndarray) -> bytes:
    return np.ascontiguousarray(array).tobytes()


def batch(schema: pa.Schema, columns: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, t) for c, t in zip(columns, schema.types, strict=True)], schema=schema)
