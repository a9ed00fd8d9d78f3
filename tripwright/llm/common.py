"""Small helpers that several operators share."""

from __future__ import annotations

import ctypes
import os
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripwright.session import work_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(frame: DataFrame, label: str) -> DataFrame:
    """The frame written to the shared folder and read back.

    It cuts the lineage, survives lost executors and gives later plans the true size.
    """
    path = work_dir(frame.sparkSession, label)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def fresh(taken: Iterable[str], *names: str) -> list[str]:
    """The names, each with underscores added until no column has it in any case."""
    used, out = {name.lower() for name in taken}, []
    for name in names:
        while name.lower() in used:
            name += "_"
        used.add(name.lower())
        out.append(name)
    return out


def with_places(docs: DataFrame) -> tuple[DataFrame, dict[str, Column]]:
    """The rows, and two columns under free names that tell each from all others.

    These are a hash of its file's path and its place there. Rows that aren't read from files that
    say so are stored first.
    """
    try:
        docs.select(docs.metadataColumn("_metadata")["row_index"]).schema  # noqa: B018
    except AnalysisException:
        docs = stored(docs, "placed")
    at = docs.metadataColumn("_metadata")
    file, row = fresh(docs.columns, "place_file", "place_row")
    return docs, {file: F.xxhash64(at["file_path"]), row: at["row_index"]}


def signed(hashes: np.ndarray) -> pa.Array:
    """Unsigned 64-bit hashes as Spark's long."""
    return pa.array(hashes.view(np.int64))


def ragged(values: np.ndarray, starts: np.ndarray) -> pa.Array:
    """One list for each pair of neighbouring starts."""
    return pa.ListArray.from_arrays(pa.array(starts.astype(np.int32)), pa.array(values))


def big_enough(total: int, unit: int) -> int:
    """How many parts of at most about ``unit`` hold the total; at least one."""
    return max(1, -(-int(total) // unit))


def give_back() -> None:
    """Return freed memory to the system.

    Python workers live on between tasks, and several share an executor's memory with the JVM:
    what their allocators keep for later is lost to the others.
    """
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim:
        trim(0)


def share(total: int) -> int:
    """This worker's part of what all Python workers of an executor may keep together.

    They are children of one daemon. Tasks take turns on them, so each comes to hold a store of
    its own, and only the sum has to fit beside the JVM.
    """
    try:
        parent = os.getppid()
        with open(f"/proc/{parent}/task/{parent}/children") as children:
            return total // max(1, len(children.read().split()))
    except OSError:  # not a system that tells
        return total // 4


#: What a Python worker keeps from task to task, such as a tokenizer.
KEPT: dict[str, object] = {}


def lean(batches: Iterable[pa.RecordBatch], keep: str = "") -> Iterator[pa.RecordBatch]:
    """The batches, with freed memory given back around each.

    ``keep`` names the entry of ``KEPT`` that the task uses; the others go first.
    """
    for other in KEPT.keys() - {keep}:
        del KEPT[other]
    give_back()
    for batch in batches:
        yield batch
        give_back()


@contextmanager
def arrow_rows(spark: SparkSession, rows: int) -> Iterator[None]:
    """At most so many rows in an Arrow batch of the jobs run inside; a setting of the session.

    The JVM holds a batch outside its heap, in buffers that grow by doubling.
    """
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(min(rows, int(before)) if int(before) > 0 else rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


class Bloom:
    """A filter of fixed size: it never misses a member, and lets a few others through.

    Its size is a parameter, not a function of the data, so it may be sent to every task. With
    more members than it is made for it lets more through, up to all: callers check what passes.
    """

    def __init__(self, words: np.ndarray):
        self.words = words

    @classmethod
    def of(cls, hashes: DataFrame, bits: int = 1 << 23) -> Bloom:
        """From a frame of one column of longs; the driver gets at most ``bits / 64`` rows."""
        h = F.col(hashes.columns[0])
        places = F.array(
            h.bitwiseAND(bits - 1), F.shiftrightunsigned(h, 32).bitwiseAND(F.lit(bits - 1))
        )
        cells = (
            hashes.where(h.isNotNull())
            .select(F.explode(places).alias("place"))
            .groupBy(F.shiftright("place", 6).cast("int").alias("cell"))
            .agg(F.bit_or(F.expr("shiftleft(1L, cast(place & 63 as int))")).alias("bits"))
            .toArrow()
        )
        words = np.zeros(bits // 64, np.int64)
        words[cells["cell"].to_numpy()] = cells["bits"].to_numpy()
        return cls(words.view(np.uint64))

    def __contains__(self, value: int) -> bool:
        return bool(self.has(np.array([value], np.uint64))[0])

    def has(self, hashes: np.ndarray) -> np.ndarray:
        mask = np.uint64(len(self.words) * 64 - 1)
        found = np.ones(len(hashes), bool)
        for place in (hashes & mask, (hashes >> np.uint64(32)) & mask):
            bit = self.words[place >> np.uint64(6)] >> (place & np.uint64(63))
            found &= (bit & np.uint64(1)).astype(bool)
        return found
