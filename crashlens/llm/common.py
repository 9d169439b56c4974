"""Helpers shared by the operators: table access, written intermediates, input columns."""

from __future__ import annotations

import ctypes
from contextlib import contextmanager
from zlib import crc32

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from crashlens.session import scratch_path

#: White space of the word rule ``[^\x20\x09-\x0D]+``.
WORD_BREAKS = " \t\n\x0b\x0c\r"
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@contextmanager
def setting(spark: SparkSession, key: str, value: str):
    """A session setting for the length of a block; settings the session refuses are left."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


_scratch: list[list[str]] = []


@contextmanager
def scratch(spark: SparkSession):
    """Tables written within the block are deleted at its end, but those written to be kept."""
    _scratch.append([])
    try:
        yield
    finally:
        for path in map(spark._jvm.org.apache.hadoop.fs.Path, _scratch.pop()):
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def written(df: DataFrame, name: str, keep: bool = False) -> DataFrame:
    """Write an intermediate table to the shared checkpoint folder and read it back.

    This cuts the lineage: a lost executor costs a re-read of the files, not the steps
    before them. The shuffle files of the write are dropped as soon as it has ended.
    """
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{name}")
    if _scratch and not keep:
        _scratch[-1].append(path)
    with setting(spark, CLEANUP, "true"):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def texts(docs: DataFrame) -> DataFrame:
    """doc_id and text alone, a null text as the empty one: extra columns, whatever their
    names, cannot meet a name that an operator makes."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))


def words(text: Column) -> Column:
    """The words ``[^\\x20\\x09-\\x0D]+`` of a text as an array."""
    return F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z, every other character as it is."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def fold(doc_id: Column, of: int) -> Column:
    """crc32 of the id written as text, modulo ``of``."""
    return F.crc32(doc_id.cast("string").cast("binary")) % of


def fold_of(doc_id: int, of: int) -> int:
    return crc32(str(doc_id).encode()) % of


def release_memory() -> None:
    """Give freed memory back to the system. Spark goes on with a Python worker in the next
    stage, and what its allocators keep from the last one counts against the executor."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def parallelism(spark: SparkSession) -> int:
    return max(int(spark.conf.get("spark.sql.shuffle.partitions", "200")), spark.sparkContext.defaultParallelism)


_caches: dict = {}


def worker_cache(name, make):
    """What an operator remembers in a Python worker from task to task. Spark goes on with the
    worker for other operators, so there is one such cache at a time."""
    if name not in _caches:
        drop_caches()
        _caches[name] = make()
    return _caches[name]


def drop_caches() -> None:
    """Called by tasks that remember nothing themselves: what an earlier stage left is freed."""
    if _caches:
        _caches.clear()
        release_memory()
