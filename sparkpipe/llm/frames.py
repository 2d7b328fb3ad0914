"""Small helpers that the operators of this subpackage share."""

from __future__ import annotations

import os
from collections.abc import Mapping

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F

from sparkpipe.session import work_dir

#: Word separators: space, tab, line feed, vertical tab, form feed, carriage return.
#: ``bytes.split()`` separates by exactly these six.
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"

#: Workers live on between tasks. These settings let them give freed memory back, so that
#: what one stage needed is not held through the next.
WORKER_MEMORY = {
    "ARROW_DEFAULT_MEMORY_POOL": "system",
    "MALLOC_ARENA_MAX": "2",
    "MALLOC_MMAP_THRESHOLD_": str(4 << 20),
    "MALLOC_TRIM_THRESHOLD_": str(16 << 20),
}


def visible_to_workers(spark: SparkSession, memory: Mapping[str, str] = WORKER_MEMORY) -> None:
    """Let Python workers find this library where the driver found it, and set up their memory.

    That serves a driver started in another folder; on machines of their own, workers
    get the library as any other, installed or through ``--py-files``.
    """
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    environment = spark.sparkContext.environment
    paths = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([root, *paths])
    for name, value in memory.items():
        environment.setdefault(name, value)


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` after a write to the shared work folder, so nothing above it runs again."""
    spark = df.sparkSession
    folder = work_dir(spark, label)
    df.write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


def discard(*tables: DataFrame) -> None:
    """Remove tables made by :func:`written`, once all that reads them is itself written."""
    for table in tables:
        spark = table.sparkSession
        for file in table.inputFiles()[:1]:
            folder = spark._jvm.org.apache.hadoop.fs.Path(file).getParent()
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def tasks(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def id_and_text(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Only the two columns that matter, under names of our own."""
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")
    )


def word_hashes(words: list[bytes]) -> np.ndarray:
    """A 64-bit hash of each word."""
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def mixed(values: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values so that every bit depends on every bit."""
    values = (values ^ (values >> np.uint64(32))) * np.uint64(0x9FB21C651E98DF25)
    values = (values ^ (values >> np.uint64(29))) * np.uint64(0xD6E8FEB86659FD93)
    return values ^ (values >> np.uint64(32))


def window_hashes(hashes: np.ndarray, length: int) -> np.ndarray:
    """A 64-bit hash of each run of ``length`` consecutive word hashes."""
    n = max(0, len(hashes) - length + 1)
    total = hashes[:n].copy()
    for k in range(1, length):
        total *= np.uint64(0xD6E8FEB86659FD93)
        total += hashes[k : k + n]
    return mixed(total)


def few_at_a_time(column: pa.Array, rows: int = 256):
    """The values of a column; only some rows at a time become objects."""
    for begin in range(0, len(column), rows):
        yield from column.slice(begin, rows).to_pylist()


def slices(values: list, sizes: list[int], most: int):
    """Consecutive slices of ``values`` whose sizes add up to about ``most``."""
    begin = 0
    while begin < len(values):
        end, size = begin, 0
        while end < len(values) and size < most:
            size += sizes[end]
            end += 1
        yield values[begin:end]
        begin = end
