"""What goes to all executors: joined sides only as far as they have been measured, and bounded objects."""

from __future__ import annotations

import ctypes
import pickle
from collections.abc import Callable

import pyarrow as pa
from py4j.protocol import Py4JJavaError
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes up to which a side is broadcast.
BROADCAST_BYTES = 8 << 20
#: Bytes of rows that reach a Python worker at once.
BATCH_BYTES = 2 << 20
#: Bytes of rows, about, for which a narrow table gets another task and file.
PIECE_BYTES = 4 << 20
BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


def by_size(written: DataFrame, row_bytes: int) -> DataFrame:
    """The written table, marked for broadcast if its rows of at most `row_bytes` fit the limit."""
    return F.broadcast(written) if written.count() * row_bytes <= BROADCAST_BYTES else written


def in_pieces(df: DataFrame, rows: int, row_bytes: int) -> DataFrame:
    """The frame in as few tasks as so many rows of about `row_bytes` need, one per core at least; no row is moved for it.

    For tables to be written whose rows can be counted beforehand, or bounded. Every file costs its executor a process
    or more for its rights (Hadoop without its native library), and every task sets up its sorters and writers anew.
    """
    return df.coalesce(max(df.sparkSession.sparkContext.defaultParallelism, -(-rows * row_bytes // PIECE_BYTES)))


def small_batches(spark: SparkSession) -> None:
    """Let Arrow batches end at `BATCH_BYTES`, so that long texts and sets do not add up to the record limit.

    A limit that the session sets itself stays. The setting remains, as results are computed later; they do not depend on it.
    """
    if spark.conf.get(BATCH_SETTING, None) is None:
        spark.conf.set(BATCH_SETTING, BATCH_BYTES)


def release_memory() -> None:
    """Give back to the system what this Python process has freed, as far as its C library can."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def release_driver_memory(spark: SparkSession) -> None:
    """Give back to the system what the driver has freed, in its Python process and outside the heap of its JVM.

    The C library keeps what is freed in an arena per thread, and planning, compiling and broadcasting use hundreds of threads.
    The JVM is asked through the commands it offers inside its own process; one without this command (before 17.0.9) keeps its arenas.
    """
    release_memory()
    jvm = spark._jvm
    offered = jvm.javax.management.ObjectName("com.sun.management:type=DiagnosticCommand")
    known = jvm.java.lang.Class.forName("javax.management.MBeanServer").getMethods()
    call = next(m for m in known if m.getName() == "invoke")  # py4j finds no methods of the class behind this interface
    values = spark.sparkContext._gateway.new_array(jvm.java.lang.Object, 4)  # without arguments of its own
    values[0], values[1] = offered, "systemTrimNativeHeap"
    try:
        call.invoke(jvm.java.lang.management.ManagementFactory.getPlatformMBeanServer(), values)
    except Py4JJavaError:
        pass


def releasing(run: Callable) -> Callable:
    """The function over batches, whose worker keeps no freed memory once it is through: idle workers count beside those that work."""

    def through(batches):
        try:
            yield from run(batches)
        finally:
            release_memory()

    return through


class Shipped:
    """A bounded object for all executors, pickled with its code, so that workers need no copy of this package."""

    def __init__(self, spark: SparkSession, thing):
        self._sent, self._value = spark.sparkContext.broadcast(cloudpickle.dumps(thing)), None

    @property
    def value(self):
        if self._value is None:
            self._value = pickle.loads(self._sent.value)
        return self._value

    def __getstate__(self):
        return {"_sent": self._sent, "_value": None}
