"""What the driver's processes no longer use goes back to the system."""

import re
from pathlib import Path

import numpy as np
import pyarrow as pa

from residuum.llm import common


def _held() -> float:
    return int(re.search(r"\nPss_Anon:\s+(\d+)", Path("/proc/self/smaps_rollup").read_text())[1]) / 1024


def test_memory_of_the_driver_is_given_back(spark):
    """Small pieces of freed memory between those in use stay with the allocator unless it is told."""
    assert common._trim_native_heap(spark.sparkContext._gateway)
    common.freed(spark)
    before = _held()
    pieces = [np.zeros(1000) for _ in range(25_000)]  # 200 MB
    last, arrow = np.zeros(1000), pa.array(np.zeros(10**6))
    filled = _held()
    del pieces, arrow
    common.freed(spark)
    assert filled - before > 150
    assert _held() - before < 60
    assert len(last) == 1000
