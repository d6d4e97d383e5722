"""Helpers shared by the operators: narrow inputs, bounded Arrow pieces, words, folds."""

import contextlib
import ctypes
import shutil
import tempfile
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

PIECE_BYTES = 4 << 20
"""Text bytes that a Python worker handles at a time; a longer text comes alone."""


def id_and_text(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The two columns that operators work on, as ``doc_id`` (bigint) and ``text``.

    Any other column, whatever its name, is left behind, so it can't clash with a result.
    """
    return df.select(df[id_col].cast("bigint").alias("doc_id"), df[text_col].cast("string").alias("text"))


def pieces(batch: pa.RecordBatch, text_col: str = "text", limit: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch that hold about ``limit`` bytes of text each."""
    sizes = pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index(text_col))), 0)
    ends = np.cumsum(sizes.to_numpy(zero_copy_only=False), dtype=np.int64)
    start = 0
    while start < batch.num_rows:
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + limit, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def map_pieces(df: DataFrame, schema: str, make: Callable[[], Callable], text_col: str = "text", limit: int = PIECE_BYTES) -> DataFrame:
    """``make()`` gives each task a function from a piece of a batch to a batch of results."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            for piece in pieces(batch, text_col, limit):
                yield work(piece)

    return df.mapInArrow(run, schema)


def give_back() -> None:
    """Return freed memory to the system: a Python worker stays alive, idle, beside the stages after its own."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # only glibc has it
        ctypes.CDLL(None).malloc_trim(0)


def frugal(work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``work`` for a task, whose memory is given back when it ends."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from work(batches)
        give_back()

    return run


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def strings(batch: pa.RecordBatch, name: str = "text") -> list[str]:
    """The texts of a batch; null counts as empty.

    Spark does not check that a text is UTF-8; bytes that aren't become the replacement
    character (U+FFFD), here and in :func:`octets`.
    """
    texts = column(batch, name)
    try:
        return [x or "" for x in texts.to_pylist()]
    except UnicodeDecodeError:
        return [(x or b"").decode("utf-8", "replace") for x in texts.cast(pa.binary()).to_pylist()]


def octets(batch: pa.RecordBatch, name: str = "text") -> list[bytes]:
    """The texts of a batch as UTF-8; null counts as empty."""
    raw = column(batch, name).cast(pa.binary())
    try:
        raw.cast(pa.string())  # checks the bytes
    except pa.ArrowInvalid:
        return [t.encode() for t in strings(batch, name)]
    return [x or b"" for x in raw.to_pylist()]


def words_of(text: bytes) -> list[bytes]:
    """Runs of bytes other than space and 0x09 to 0x0D; in UTF-8 no other character holds such a byte."""
    return text.split()


class Numbers(dict):
    """Numbers keys in the order in which they are first looked up."""

    def __missing__(self, key) -> int:
        self[key] = number = len(self)
        return number


def id_fold(modulus: int, id_col: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo ``modulus``; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % modulus


def list_array(values: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    """One list per count, of consecutive values."""
    offsets = np.zeros(len(counts) + 1, np.int32)
    np.cumsum(counts, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, kind))


def fresh_name(df: DataFrame, base: str) -> str:
    """``base``, or a longer name where the frame has that column already."""
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base = f"_{base}"
    return base


def with_computed(df: DataFrame, name: str, kind: str, make: Callable[[], Callable], text_col: str = "text", limit: int = PIECE_BYTES) -> DataFrame:
    """All columns of ``df`` and one more; ``make()`` gives each task a function from a batch to the array of that column."""

    def per_task():
        values = make()
        return lambda batch: pa.RecordBatch.from_arrays([*batch.columns, values(batch)], [*batch.schema.names, name])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
    return map_pieces(df, f"{fields}, `{name}` {kind}", per_task, text_col, limit)


def labelled(labels: DataFrame, label_col: str, id_col: str = "doc_id") -> DataFrame:
    """One row per labelled id: ``doc_id``, ``y`` (0 or 1). A null id or label does not count; of several, the largest does."""
    rows = labels.select(labels[id_col].cast("bigint").alias("doc_id"), (labels[label_col] > 0).cast("int").alias("y")).dropna()
    return rows.groupBy("doc_id").agg(F.max("y").alias("y"))


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application, as they may run where it isn't installed."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parents[1]
    archive = shutil.make_archive(f"{tempfile.mkdtemp()}/{package.name}", "zip", package.parent, package.name)
    context.addPyFile(archive)
    _shipped.add(context.applicationId)
