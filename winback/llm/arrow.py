"""Running a function over the texts of a table, Arrow batch by Arrow batch."""

from __future__ import annotations

import ctypes
import gc
import sys
from collections.abc import Callable, Hashable, Iterator
from types import ModuleType
from typing import TypeVar

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

import winback.llm
from winback.llm.common import id_and_text

# functions of this subpackage travel with the job, so workers need not have it installed
cloudpickle.register_pickle_by_value(winback.llm)

#: texts handled at a time inside an Arrow batch; bounds what a task holds as Python objects
SLICE = 1000
#: bytes of an Arrow batch between Spark and a Python worker (one row at least)
BATCH_BYTES = "8m"
BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"

T = TypeVar("T")


def small_batches(docs: DataFrame) -> DataFrame:
    """The table itself; its session sends Arrow batches of BATCH_BYTES from now on, unless it names a size of its own.

    Batches are counted in rows otherwise, and 10,000 long texts do not fit a worker.
    """
    conf = docs.sparkSession.conf
    if conf.get(BATCH_SETTING, None) is None:
        conf.set(BATCH_SETTING, BATCH_BYTES)
    return docs


def return_freed() -> None:
    """Return freed memory of this process to the system, as far as its allocators can."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library, which has no such call
        pass


def give_back_memory() -> None:
    """The same after freeing what only refers to itself, which takes a walk over all objects."""
    gc.collect()
    return_freed()


Run = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def tidied(run: Run) -> Run:
    """``run`` of mapInArrow, after which the worker gives back what it does not use; it waits for other tasks beside a JVM."""

    def inner(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        give_back_memory()

    return inner


def kept_by_worker(key: Hashable, make: Callable[[], T]) -> T:
    """What a Python worker keeps between its tasks, made on first use; only one thing, the last asked for.

    Code that travels with the job brings new module globals for every task, so they can't hold it.
    """
    state = sys.modules.setdefault("winback_worker_state", ModuleType("winback_worker_state"))
    if getattr(state, "key", None) != key:
        state.kept = None  # let go of the old before the new is made
        give_back_memory()
        state.key, state.kept = key, make()
    return state.kept


def sliced(batches: Iterator[pa.RecordBatch], rows: int = SLICE) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def sliced_by_bytes(batches: Iterator[pa.RecordBatch], column: str, most: int) -> Iterator[pa.RecordBatch]:
    """Slices whose texts hold at most ``most`` bytes, or one text."""
    for batch in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy().astype(np.int64))
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + most, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def map_texts(docs: DataFrame, schema: str, work: Callable[[list, list], dict[str, list]]) -> DataFrame:
    """``work(doc_ids, texts)`` for slices of the table (null text: empty); returns columns by name."""
    struct = StructType.fromDDL(schema)
    arrow = to_arrow_schema(struct)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            columns = work(batch.column(0).to_pylist(), batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([pa.array(columns[field.name], field.type) for field in arrow], schema=arrow)

    return small_batches(docs).select(*id_and_text()).mapInArrow(tidied(run), struct)


def take_rows(docs: DataFrame, choose: Callable[..., np.ndarray], also: str | None = None) -> DataFrame:
    """The rows whose positions ``choose(doc_ids, texts)`` returns for slices of the table, with all their columns.

    A position may come several times. Columns keep their names, types and order. The column ``also`` is handed on too.
    """
    text_at, id_at = docs.columns.index("text"), docs.columns.index("doc_id")
    more_at = [docs.columns.index(also)] if also else []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            texts = ["" if text is None else text for text in batch.column(text_at).to_pylist()]
            more = [batch.column(at).to_pylist() for at in more_at]
            yield batch.take(pa.array(choose(batch.column(id_at).to_pylist(), texts, *more), pa.int64()))

    return small_batches(docs).mapInArrow(tidied(run), docs.schema)
