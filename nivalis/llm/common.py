"""Shared helpers of the training-data operators: tables, shared scratch, word batches."""

from __future__ import annotations

import ctypes
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

#: The white space of every contract: space and the characters 9 to 13.
WHITE_SPACE = " \t\n\x0b\f\r"


#: Bytes of one Arrow batch on its way to a Python worker: ten thousand long texts would be gigabytes.
BATCH_BYTES = 4 << 20


def bound_batches(spark: SparkSession) -> None:
    """Bound Arrow batches by bytes, unless the session has a bound of its own."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(name, None) is None:
        spark.conf.set(name, str(BATCH_BYTES))


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    bound_batches(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stage(df: DataFrame, name: str, files: int | None = None) -> DataFrame:
    """Write ``df`` once to the shared scratch folder and read it back.

    This cuts the lineage with files every executor can see, so a lost
    executor costs only its running tasks.  With ``files``, at most so many
    tasks write it, each taking several partitions of the plan's last shuffle.
    """
    bound_batches(df.sparkSession)
    df = df.coalesce(files) if files else df
    path = scratch_path(df.sparkSession, name)
    df.write.mode("error").option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def partitions_for(spark: SparkSession, rows: int, each: int):
    """Plans that are made and run inside shuffle into partitions of about ``each`` rows, into the session's number at most.

    For tables much smaller than the corpus: the session's number fits the corpus, and a task per partition
    costs more than its rows there.  Holds for the whole session while it lasts.  Gives the number of files of
    such tables: that of the partitions, or of the session's cores where those are more.
    """
    name = "spark.sql.shuffle.partitions"
    own = spark.conf.get(name)
    parts = min(int(own), 1 + rows // each)
    spark.conf.set(name, str(parts))
    try:
        yield max(parts, spark.sparkContext.defaultParallelism)
    finally:
        spark.conf.set(name, own)


def id_crc32(col) -> F.Column:
    """Unsigned crc32 of an integer id written as decimal text (null counts as the empty text)."""
    return F.crc32(F.coalesce(col.cast("string"), F.lit("")).cast("binary"))


def plain_text(table: pa.Table | pa.RecordBatch, name: str = "text") -> pa.Array:
    """The text column of a batch as one large_string array, null as the empty text."""
    col = table.column(name)
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if isinstance(col, pa.ChunkedArray):
        col = pa.concat_arrays(col.chunks) if col.num_chunks else pa.array([], pa.large_string())
    # Rebased: some Arrow kernels misread an array whose first offset is not 0.
    borders, data = raw_text(pc.fill_null(col.cast(pa.large_string()), ""))
    return pa.LargeStringArray.from_buffers(len(borders) - 1, pa.py_buffer(borders), pa.py_buffer(data), null_count=0)


def _words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """ASCII-white-space words of all texts, in order, and each text's offsets in them (texts + 1 values)."""
    lists = pc.ascii_split_whitespace(texts)
    offsets = lists.offsets.to_numpy().astype(np.int64)
    words = lists.values.slice(offsets[0], offsets[-1] - offsets[0])
    offsets = offsets - offsets[0]
    sizes = pc.binary_length(words).to_numpy(zero_copy_only=False)
    if len(sizes) and sizes.min() == 0:  # borders of a text that starts or ends with white space
        full = sizes > 0
        kept = np.concatenate(([0], np.cumsum(full)))
        return words.filter(pa.array(full)), kept[offsets]
    return words, offsets


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Words ``[^\\x20\\x09-\\x0D]+`` with A-Z in lower case."""
    return _words(pc.ascii_lower(texts))


#: Byte map of the alphanumeric words: A-Z to lower case, every other ASCII byte but 0-9 and a-z to a space.
ALNUM = bytes(b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else b + 32 if 0x41 <= b <= 0x5A else 0x20
              for b in range(256))


def split_alnum(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` with A-Z in lower case.

    The map is byte for byte, so it is applied to the whole buffer of a batch.
    """
    borders, data = raw_text(texts)
    plain = pa.py_buffer(data.tobytes().translate(ALNUM))
    return _words(pa.LargeStringArray.from_buffers(len(texts), pa.py_buffer(borders), plain, null_count=0))


def raw_text(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Borders of the texts (texts + 1 values) and their bytes, of a large_string array that may be a slice."""
    _, offsets, data = texts.buffers()
    if not len(texts) or data is None:
        return np.zeros(len(texts) + 1, np.int64), np.empty(0, np.uint8)
    borders = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    return borders - borders[0], np.frombuffer(data, np.uint8)[borders[0] : borders[-1]]


def slices(batch: pa.RecordBatch, name: str = "text", most: int = 4 << 20):
    """Slices of a batch whose text column holds about ``most`` bytes (a single longer text stays whole)."""
    sizes = pc.fill_null(pc.binary_length(batch.column(name)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    if not len(sizes):
        return
    ends = np.cumsum(sizes)
    at = 0
    while at < len(sizes):
        stop = int(np.searchsorted(ends, (ends[at - 1] if at else 0) + most, side="right"))
        stop = max(at + 1, stop)
        yield batch.slice(at, stop - at)
        at = stop
    give_back()


def give_back() -> None:
    """Return freed memory to the system: Python workers live on between tasks and would keep a batch's room."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def ragged_take(values: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Concatenate ``values[starts[i] : starts[i] + sizes[i]]`` for all i."""
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    return values[np.repeat(starts - (ends - sizes), sizes) + np.arange(total)]
