"""Shared-folder tables that cut lineage, so a lost executor never loses an intermediate result."""

from __future__ import annotations

import contextlib
import ctypes
import functools
import uuid
from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.saved import filesystem, shared_dir

#: A side of a join is broadcast only when its counted rows times their width stay below this.
BROADCAST_BYTES = 32 << 20
#: Rows of documents that a Python function takes and gives at once.
SLICE = 512


class Workspace:
    """A folder of its own in the shared one, for the intermediate tables of one operator call; what is left goes when the session's process ends."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{shared_dir(spark)}/maskline-{name}-{uuid.uuid4().hex[:12]}"
        system, target = filesystem(spark, self.root)
        system.mkdirs(target)
        system.deleteOnExit(target)
        self.made = 0
        self.saved: list[str] = []

    def save(self, df: DataFrame, name: str = "t", codec: str = "zstd") -> DataFrame:
        """Write df as Parquet and read it back: later plans start from the files, in any order and as often as they like."""
        self.made += 1
        path = f"{self.root}/{self.made:03d}-{name}"
        df.write.option("compression", codec).parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._saved_at = path
        self.saved.append(path)
        return out

    def only(self, *kept: DataFrame) -> None:
        """Delete every saved table but these."""
        paths = {getattr(df, "_saved_at", None) for df in kept}
        for path in [p for p in self.saved if p not in paths]:
            self.delete(path)

    def close(self) -> None:
        """Delete every saved table."""
        self.only()

    def drop(self, df: DataFrame) -> None:
        """Delete a saved table that no later plan reads."""
        if path := getattr(df, "_saved_at", None):
            self.delete(path)

    def delete(self, path: str) -> None:
        """Delete a table or another folder of this workspace."""
        self.saved = [p for p in self.saved if p != path]
        system, target = filesystem(self.spark, path)
        with contextlib.suppress(Exception):  # a leftover file costs disk, not correctness
            system.delete(target, True)


def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of batches, SLICE at most at a time: workers keep what their largest piece took, and so does the executor that reads it."""
    for batch in batches:
        for at in range(0, batch.num_rows, SLICE):
            yield batch.slice(at, SLICE)


#: The store of this Python worker ([key, value] or empty), and whether its task has asked for it.
_store: list[Any] = []
_asked = False


def worker_store(make: Callable, *key: Any) -> Any:
    """make(*key), kept over a Python worker's tasks; a worker holds one store at a time, and only while its tasks ask for it."""
    global _asked
    _asked = True
    if not _store or _store[0] != (make, *key):
        _store.clear()
        _store[:] = [(make, *key), make(*key)]
    return _store[1]


def begin_task() -> None:
    global _asked
    _asked = False


def end_task() -> None:
    """Drop a store that the task did not ask for, and return what Arrow and the C library hold of freed memory to the system."""
    if not _asked:
        _store.clear()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(AttributeError, OSError):  # a C library without malloc_trim
        ctypes.CDLL(None).malloc_trim(0)


def lean(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """run for mapInArrow or mapInPandas; at its end the worker, which outlives the stage, gives back memory. Its state is the module's, as run itself may be sent by value."""

    @functools.wraps(run)
    def leanly(batches: Iterator) -> Iterator:
        begin_task()
        try:
            yield from run(batches)
        finally:
            end_task()

    return leanly


def sized(df: DataFrame, rows: int, row_bytes: int) -> DataFrame:
    """df marked for broadcast if rows * row_bytes is within BROADCAST_BYTES; beyond that, unmarked: a shuffled join."""
    return F.broadcast(df) if rows * row_bytes <= BROADCAST_BYTES else df


def numbered(docs: DataFrame, rid: str, work: Workspace) -> DataFrame:
    """docs with rid, a number of each row that is the same however often, and on whatever executors, it is read.

    Rows of Parquet files, with no more than columns and rows chosen from them, are numbered by file, in order of the paths, and place in it.
    Anything else is saved with the numbers it happens to get.
    """
    plan = docs._jdf.queryExecution().analyzed()
    plain = plan.deterministic()
    while plan.nodeName() in ("Project", "Filter", "SubqueryAlias"):
        plan = plan.children().head()
    if not plain or plan.nodeName() != "LogicalRelation" or "parquet" not in plan.simpleString(100):
        return work.save(docs.withColumn(rid, F.monotonically_increasing_id()), "held")
    (path, place, number) = free_name(docs.withColumn(rid, F.lit(0)), "file_path", "row_index", "file_number")
    found = docs.select("*", F.col("_metadata.file_path").alias(path), F.col("_metadata.row_index").alias(place))
    paths = sorted(r[0] for r in found.select(path).distinct().collect())  # one short row per file
    files = work.spark.createDataFrame(list(zip(paths, range(len(paths)))), f"{path} string, {number} long")
    both = found.join(sized(files, len(paths), 512), path)
    return both.select(*[F.col(f"`{c}`") for c in docs.columns], (F.col(number) * (1 << 40) + F.col(place)).alias(rid))


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def free_name(df: DataFrame, *names: str) -> list[str]:
    """Column names close to those wanted that df does not have (in any case), so extra columns never clash."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out
