"""Small helpers shared by the operators."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import inspect
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Words are runs of anything but these six characters.
WORD = r"[^\x20\x09-\x0D]+"


def id_and_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the id and the text, a null text as the empty one; other columns cannot clash."""
    return docs.select(
        docs[id_col].cast("bigint").alias("doc_id"),
        F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("text"),
    )


def free_names(df: DataFrame, *names: str) -> list[str]:
    """The names, lengthened until no column of ``df`` has them, whatever its case."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def binary(column: pa.ChunkedArray | pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string column."""
    return column.cast(pa.large_binary()).to_pylist()


def tidy(task: Callable) -> Callable:
    """A task that gives the memory it used back to the machine when it ends.

    Python workers are kept for later stages, and freed memory with them: without this, a
    worker stays as large as its largest task for as long as the job runs.
    """

    def ended() -> None:
        gc.collect()
        pa.default_memory_pool().release_unused()
        with contextlib.suppress(OSError, AttributeError):  # other C libraries do without
            ctypes.CDLL(None).malloc_trim(0)

    if inspect.isgeneratorfunction(task):

        def generated(batches):
            try:
                yield from task(batches)
            finally:
                ended()

        return generated
    # Group tasks are told apart by their number of arguments.
    if len(inspect.signature(task).parameters) == 2:

        def of_two(left, right):
            try:
                return task(left, right)
            finally:
                ended()

        return of_two

    def of_one(group):
        try:
            return task(group)
        finally:
            ended()

    return of_one


#: Bytes of texts that a Python task holds as objects of their own at a time.
HELD_BYTES = 4 << 20


def small(batches: Iterator[pa.RecordBatch], column: str = "text", most: int = HELD_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of the batches, none with more bytes of text than ``most`` unless it is one row.

    A batch stays in Arrow's memory; what is made of its rows is limited by bytes, not rows.
    """
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes, dtype=np.int64)
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            end = max(start + 1, int(np.searchsorted(ends, before + most, "right")))
            yield batch.slice(start, end - start)
            start = end


def by_batch(
    df: DataFrame, work: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str, column: str | None = None
) -> DataFrame:
    """Map Arrow batches one by one; no shuffle, bounded memory. With ``column``: slices of them, see ``small``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches if column is None else small(batches, column):
            if batch.num_rows and (out := work(batch)) is not None:
                yield out

    return df.mapInArrow(tidy(run), schema)


def running_sum(lengths: Column, chunk: int = 256) -> Column:
    """Running totals of an array of longs.

    Totals are built chunk by chunk and then shifted, so an array of n costs about
    n * chunk copies rather than n * n.
    """
    empty = F.expr("CAST(array() AS array<bigint>)")
    last = lambda acc: F.coalesce(F.try_element_at(acc, F.lit(-1)), F.lit(0).cast("bigint"))
    grow = lambda acc, x: F.concat(acc, F.array(last(acc) + x))
    n_chunks = F.ceil(F.size(lengths) / F.lit(chunk)).cast("int")
    chunks = F.transform(
        F.sequence(F.lit(0), n_chunks - 1),
        lambda c: F.aggregate(F.slice(lengths, c * chunk + 1, F.lit(chunk)), empty, grow),
    )
    ends = lambda sums: F.aggregate(F.transform(sums, last), empty, grow)
    # A let-binding over the chunk sums: they are needed twice.
    shifted = F.flatten(
        F.transform(
            F.array(chunks),
            lambda sums: F.flatten(
                F.zip_with(
                    sums,
                    F.concat(F.array(F.lit(0).cast("bigint")), ends(sums)),
                    lambda part, before: F.transform(F.coalesce(part, empty), lambda x: x + before),
                )
            ),
        )
    )
    return F.when(F.size(lengths) == 0, empty).otherwise(shifted)
