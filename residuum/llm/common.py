"""What the corpus operators share: a durable cut of the lineage, word splitting, rolling hashes."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import tempfile
from collections.abc import Callable, Hashable, Iterable

import numpy as np
import pyarrow as pa
import xxhash
from py4j.protocol import Py4JError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

#: Odd multipliers of the rolling hash and their inverses modulo 2**64.
BASE = 0x9E3779B97F4A7C15
UNBASE = pow(BASE, -1, 1 << 64)


def shared_folder(spark: SparkSession) -> str:
    """The session's ``spark.checkpoint.dir``; only on a local master, as in tests, a temporary one."""
    context = spark.sparkContext
    folder = context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        folder = tempfile.mkdtemp(prefix="residuum-")
        context.setCheckpointDir(folder)
    return folder


def cut(df: DataFrame) -> DataFrame:
    """``df`` materialised in the shared folder, so that a lost executor costs no recomputation."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def freed(spark: SparkSession) -> None:
    """Have the driver collect its garbage, so that Spark drops the shuffles, broadcasts and checkpoints that nothing refers to.

    A long row of small jobs leaves plans and such in the driver faster than it collects them by itself, and its heap grows
    to its limit with hardly anything in it. A collection that is asked for gives free memory back as well. Python's goes
    first, as its objects hold on to those of the JVM. Spark starts a thread for nearly each exchange, and what these and the
    compiler have freed outside of the heap stays with the allocator, so both processes are told to give that back, too.
    """
    gc.collect()
    jvm = spark.sparkContext._jvm
    jvm.System.gc()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # allocators other than glibc's
        ctypes.CDLL(None).malloc_trim(0)
    with contextlib.suppress(Py4JError):  # JVMs without that command
        _trim_native_heap(spark.sparkContext._gateway)


def _trim_native_heap(gateway) -> str:
    """Have the driver's JVM give memory back that it has freed outside of its heap; what the command says."""
    jvm = gateway.jvm
    of = jvm.java.lang.Class.forName

    def array(kind, *values):
        out = gateway.new_array(kind, len(values))
        for i, x in enumerate(values):
            out[i] = x
        return out

    strings, objects = of("[Ljava.lang.String;"), of("[Ljava.lang.Object;")
    # by the interface: the server's own class is not open to callers
    invoke = of("javax.management.MBeanServer").getMethod("invoke", array(jvm.java.lang.Class, of("javax.management.ObjectName"), of("java.lang.String"), objects, strings))
    server = jvm.java.lang.management.ManagementFactory.getPlatformMBeanServer()
    commands = jvm.javax.management.ObjectName("com.sun.management:type=DiagnosticCommand")
    return invoke.invoke(server, array(jvm.java.lang.Object, commands, "systemTrimNativeHeap", array(jvm.java.lang.Object), array(jvm.java.lang.String)))


def kept_in_worker(key: Hashable, make: Callable):
    """What ``make`` gives, made once for each Python worker and kept from task to task.

    The functions of this package travel by value and have no globals of their own there, so
    it is kept with a module that every worker has.
    """
    import pyspark

    store = pyspark.__dict__.setdefault("_kept_by_residuum", {})
    if key not in store:
        store[key] = make()
    return store[key]


def free_name(taken: Iterable[str], wish: str) -> str:
    """``wish`` with as many underscores in front as it takes not to clash."""
    taken = {c.lower() for c in taken}
    while wish.lower() in taken:
        wish = f"_{wish}"
    return wish


def quoted(name: str) -> str:
    """A column name for ``df[...]`` and DDL, also if it has dots or spaces."""
    return "`" + name.replace("`", "``") + "`"


def map_batches(df: DataFrame, run: Callable, schema: T.StructType) -> DataFrame:
    """``mapInArrow`` over columns by place, so that their names may hold dots or spaces."""
    return df.toDF(*(f"c{i}" for i in range(len(df.columns)))).mapInArrow(run, schema)


class WordHashes(dict):
    """64-bit hash of a word, remembered for as many words as ``most``."""

    def __init__(self, most: int = 400_000):
        super().__init__()
        self.most = most

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.most:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


class Rolling:
    """Hashes of every run of ``k`` values: equal runs have equal hashes wherever they stand."""

    def __init__(self):
        self.powers = self.inverses = np.ones(1, np.uint64)

    def _grow(self, n: int) -> None:
        if len(self.powers) < n:
            n = max(n, 2 * len(self.powers), 4096)
            for name, base in (("powers", BASE), ("inverses", UNBASE)):
                x = np.full(n, base, np.uint64)
                x[0] = 1
                setattr(self, name, np.cumprod(x, dtype=np.uint64))

    def __call__(self, values: np.ndarray, k: int) -> np.ndarray:
        n = len(values) - k + 1
        if n <= 0:
            return np.empty(0, np.uint64)
        self._grow(len(values))
        sums = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * self.powers[: len(values)], dtype=np.uint64, out=sums[1:])
        return mix((sums[k:] - sums[:n]) * self.inverses[:n])


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the entropy of 64-bit values over all their bits."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def covered(starts: np.ndarray, length: int, n: int) -> np.ndarray:
    """Mask of ``n`` places, true within ``length`` of any of ``starts``."""
    edge = np.zeros(n + 1, np.int32)
    np.add.at(edge, starts, 1)
    np.add.at(edge, np.minimum(starts + length, n), -1)
    return np.cumsum(edge[:n]) > 0


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
