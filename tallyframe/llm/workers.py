"""Python workers that find this package and hand back memory."""

from __future__ import annotations

import ctypes
import os
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import SparkSession

import tallyframe

#: What tasks leave in a worker for later tasks of their kind.
KEPT: dict[str, dict] = {}


def reach_package(spark: SparkSession) -> None:
    """Let Python workers import the package from where the driver has it, whatever folder they start in.

    On machines without that folder it changes nothing: there the package is installed or shipped.
    """
    root = os.path.dirname(os.path.dirname(os.path.abspath(tallyframe.__file__)))
    environment = spark.sparkContext.environment
    paths = environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([root, *filter(None, paths)])


def lean(
    function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], kind: str | None = None
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The function with freed memory handed back to the system at the end of each task; workers are used again, and would keep it.

    What tasks of another kind have kept in the worker goes before the task begins.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from tallyframe.llm import workers  # the worker's own, not a copy sent with the task

        for other, held in workers.KEPT.items():
            if other != kind:
                held.clear()
        yield from function(batches)
        pa.default_memory_pool().release_unused()
        if hasattr(trim := ctypes.CDLL(None), "malloc_trim"):
            trim.malloc_trim(0)

    return run
