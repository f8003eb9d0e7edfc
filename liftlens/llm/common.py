"""Helpers shared by the operators: shared storage, Arrow text chunks, rolling hashes."""

from __future__ import annotations

import math
import uuid
import weakref
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from liftlens.sources.store import remove, remove_at_exit

# Bytes of text that a task works on at a time (a longer text is one chunk).
CHUNK_BYTES = 512 << 10

ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ASCII_LOWER = "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; where it is unset, the warehouse folder."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    configured = configured or spark.sparkContext.getCheckpointDir()
    return (configured or spark.conf.get("spark.sql.warehouse.dir")).rstrip("/")


#: Folders and catalog tables that this session's operators wrote on the way.
_FOLDERS: list[str] = []
_TABLES: list[str] = []
_FOLDER_OF: weakref.WeakKeyDictionary[DataFrame, str] = weakref.WeakKeyDictionary()

#: Whether Spark removes an execution's shuffle files when it ends. Else they stay until the
#: driver happens to collect the garbage of its plan.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def new_folder(spark: SparkSession, name: str) -> str:
    """A path in the shared folder for one intermediate table, removed when the driver ends."""
    _FOLDERS.append(f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}")
    remove_at_exit(spark, _FOLDERS[-1])
    return _FOLDERS[-1]


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """What is written inside leaves no shuffle files behind: nobody reads them again."""
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder, read back: cuts the lineage."""
    path = new_folder(df.sparkSession, name)
    with shuffles_removed(df.sparkSession):
        df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    _FOLDER_OF[out] = path
    return out


def discard(*tables: DataFrame) -> None:
    """Remove tables that ``written`` returned, once all that reads them is written itself."""
    for df in tables:
        path = _FOLDER_OF.pop(df)
        remove(df.sparkSession, path)
        _FOLDERS.remove(path)


def bucketed(df: DataFrame, name: str, column: str, buckets: int) -> DataFrame:
    """``df`` as a table in the shared folder, bucketed and sorted by a column."""
    spark, table_name = df.sparkSession, f"{name}_{uuid.uuid4().hex}"
    _TABLES.append(table_name)
    with shuffles_removed(spark):
        (df.write.bucketBy(buckets, column).sortBy(column).option("compression", "zstd")
         .option("path", new_folder(spark, name)).saveAsTable(table_name))
    return spark.table(table_name)


def remove_written(spark: SparkSession) -> None:
    """Remove the intermediate tables of this session's operators.

    For when their results are stored: results that are still lazy read them.
    """
    for name in _TABLES:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    for path in _FOLDERS:
        remove(spark, path)
    _TABLES.clear()
    _FOLDERS.clear()


def id_remainder(key: Column, n: int) -> Column:
    """crc32 of the key as text, modulo n (NULL key: NULL)."""
    return F.crc32(key.cast("string").cast("binary")) % n


def ascii_lower(text: Column) -> Column:
    return F.translate(text, ASCII_UPPER, ASCII_LOWER)


def blocks_of(rows: int, per_block: int) -> int:
    return max(1, math.ceil(rows / per_block))


# --------------------------------------------------------------- text in tasks

def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(all bytes, offsets of each row) of an Arrow string column; NULL counts as empty."""
    column = column.fill_null("") if column.null_count else column
    if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type):
        width = np.int64
    else:
        width = np.int32
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, width)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return data, offsets.astype(np.int64)


def text_chunks(column: pa.Array, limit: int = CHUNK_BYTES
                ) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, bytes, offsets in these bytes) of runs of whole texts."""
    data, offsets = text_bytes(column)
    row, rows = 0, len(column)
    while row < rows:
        end = int(np.searchsorted(offsets, offsets[row] + limit, side="right")) - 1
        end = min(max(end, row + 1), rows)
        yield row, end, data[offsets[row]:offsets[end]], offsets[row:end + 1] - offsets[row]
        row = end


def letters(data: np.ndarray) -> np.ndarray:
    """Which bytes of lower-case text belong to words: ASCII letters and bytes over 127."""
    return ((data >= 97) & (data <= 122)) | (data >= 128)


def word_safe_pieces(data: np.ndarray, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """(start, end) of pieces of up to ``limit`` bytes that cut no word; a longer word is whole."""
    start, n = 0, len(data)
    while start < n:
        seen, end = start, min(n, start + limit)
        while end < n:
            gaps = np.flatnonzero(~letters(data[seen:end] | np.uint8(32)))
            if len(gaps):
                end = seen + int(gaps[-1]) + 1
                break
            seen, end = end, min(n, end + limit)
        yield start, end
        start = end


BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(BASE, -1, 1 << 64)
_POWERS: dict[str, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i modulo 2**64 for i < n."""
    if "up" not in _POWERS or len(_POWERS["up"]) < n:
        size = max(n, 1 << 16)
        for name, base in (("up", BASE), ("down", _INVERSE)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _POWERS[name] = np.multiply.accumulate(steps)
    return _POWERS["up"][:n], _POWERS["down"][:n]


def mix(h: np.ndarray) -> np.ndarray:
    """Finalizer that spreads every input bit over the 64 output bits."""
    h = h ^ (h >> np.uint64(32))
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    return h


_BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x2545F4914F6CDD1D))


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """Prefix sums of a polynomial hash; see ``span_hash``."""
    up, _ = powers(len(data) + 1)
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE_VALUES[data] * up[:len(data)], out=out[1:])
    return out


def span_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of bytes [start, end): depends on these bytes and their order only."""
    _, down = powers(len(prefix))
    return mix((prefix[end] - prefix[start]) * down[start])


def lower_latin(data: np.ndarray) -> np.ndarray:
    """Lower-case ASCII and Latin-1 letters of UTF-8 bytes, length unchanged."""
    out = np.where((data >= 65) & (data <= 90), data + np.uint8(32), data)
    if len(out) > 1:
        accented = ((data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E)
                    & (data[1:] != 0x97))
        out[1:][accented] += np.uint8(32)
    return out


def word_spans(is_word: np.ndarray, offsets: np.ndarray
               ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, text number) of the maximal runs of True bytes; no run crosses a text."""
    n = len(is_word)
    if not n:
        return (np.empty(0, np.int64),) * 3
    edges = np.empty(n + 1, bool)
    edges[0], edges[n] = is_word[0], is_word[-1]
    edges[1:n] = is_word[1:] != is_word[:-1]
    inner = offsets[1:-1]
    inner = np.unique(inner[(inner > 0) & (inner < n)])
    both = inner[is_word[inner] & is_word[inner - 1]]
    marks = np.flatnonzero(edges)
    if len(both):
        marks = np.sort(np.concatenate([marks, both, both]), kind="stable")
    start, end = marks[0::2], marks[1::2]
    owner = np.searchsorted(offsets, start, side="right") - 1
    return start, end, owner


def reduce_rows(ufunc: np.ufunc, values: np.ndarray, owner: np.ndarray, rows: int,
                empty: float) -> np.ndarray:
    """``ufunc`` over the values of each row number (``owner`` is sorted); ``empty`` elsewhere."""
    out = np.full((rows, *values.shape[1:]), empty, values.dtype)
    if len(owner):
        first = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
        out[owner[first]] = ufunc.reduceat(values, first, axis=0)
    return out
