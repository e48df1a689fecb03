"""Words of texts: as Spark columns, and as numpy arrays inside tasks.

A word is a maximal run of characters other than the six ASCII white-space characters. White space is ASCII, so the
numpy form works on UTF-8 bytes without decoding. Null texts are empty.
"""

from __future__ import annotations

import contextlib
import ctypes
import gc
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from accountwise.session import run_dir

WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"

#: Bytes of text that a task turns into arrays at once; a longer text makes a slice of its own.
SLICE_BYTES = 1 << 18

_GOLD = np.uint64(0x9E3779B97F4A7C15)


def finished() -> None:
    """Frees what a task leaves in its worker, which serves many tasks: tables, and functions that refer to each other.

    What is free goes back to the system, as an idle worker's memory counts for its executor.
    """
    _powers.release()
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(AttributeError, OSError, TypeError):  # only the GNU library has it
        ctypes.CDLL(None).malloc_trim(0)


def tidied(task: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """The function over a task's batches, and ``finished`` after it: not before its own batches and tables are gone."""

    def run(batches: Iterator) -> Iterator:
        yield from task(batches)
        finished()

    return run


def text_of(column: str | Column) -> Column:
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def words(column: str | Column) -> Column:
    """The words of a text, in order."""
    return F.filter(F.split(text_of(column), SPACE), lambda w: w != "")


def n_words(column: str | Column) -> Column:
    return F.regexp_count(text_of(column), F.lit(WORD)).cast("long")


def bucket(column: str, buckets: int) -> Column:
    """The remainder of crc32 of the id as text; ids that are null count as the empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")), F.lit(buckets))


def uniform(*columns: Column) -> Column:
    """A number in (0, 1) that depends on the columns alone, so that reruns agree."""
    return (F.shiftrightunsigned(F.xxhash64(*columns), 11).cast("double") + 0.5) / float(1 << 53)


def stored(df: DataFrame, label: str) -> DataFrame:
    """Writes the rows to the shared folder and reads them back: lineage ends there and no executor's loss undoes it."""
    path = run_dir(df.sparkSession, f"llm-{label}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_CLEANED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored_alone(df: DataFrame, label: str) -> DataFrame:
    """As ``stored``; the shuffle files of the write go when it ends, not when the driver happens to collect its garbage."""
    conf = df.sparkSession.conf
    before = conf.get(_CLEANED, None)
    conf.set(_CLEANED, "true")
    try:
        return stored(df, label)
    finally:
        conf.unset(_CLEANED) if before is None else conf.set(_CLEANED, before)


def dropped(*frames: DataFrame) -> None:
    """Removes the folders of stored tables that nothing reads any more; others are left alone."""
    for df in frames:
        spark = df.sparkSession
        for folder in {file.rsplit("/", 1)[0] for file in df.inputFiles()}:
            if folder.rsplit("/", 1)[-1].startswith("llm-"):
                path = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(folder))
                path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def tables(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def set_apart(docs: DataFrame) -> DataFrame:
    """The documents with ``in_`` before every column's name, so that none is like a name that begins with ``_``."""
    return docs.toDF(*[f"in_{c}" for c in docs.columns])


def put_back(rows: DataFrame, names: list[str]) -> DataFrame:
    return rows.select(*[F.col(f"`in_{c}`").alias(c) for c in names])


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers (splitmix64's finaliser)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def stream(seed: int, n: int) -> np.ndarray:
    """n numbers of 64 bits from a seed, the same everywhere."""
    return mix(np.arange(1, n + 1, dtype=np.uint64) * _GOLD + np.uint64(seed))


_BYTES = stream(1, 256)
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[ord("A") : ord("Z") + 1] += 32
_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_BASE = 0xD6E8FEB86659FD93


class _Powers:
    """Powers of the base and of its inverse modulo 2^64; each process makes its own."""

    def __init__(self) -> None:
        self.size, self.both = 0, (np.empty(0, np.uint64), np.empty(0, np.uint64))

    def __reduce__(self):
        return _Powers, ()

    def release(self) -> None:
        """Called when a task ends: workers live longer than tasks."""
        self.__init__()

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if self.size < n:
            self.size = max(n, SLICE_BYTES + SLICE_BYTES // 4)
            out = []
            for base in (_BASE, pow(_BASE, -1, 1 << 64)):
                p = np.full(self.size, base, dtype=np.uint64)
                p[0] = 1
                out.append(np.multiply.accumulate(p))
            self.both = (out[0], out[1])
        return self.both


_powers = _Powers()


def slices(column: pa.Array) -> Iterator[tuple[int, int]]:
    """Row ranges of about SLICE_BYTES of text."""
    offsets = _offsets(column)
    row = 0
    while row < len(column):
        end = int(np.searchsorted(offsets, offsets[row] + SLICE_BYTES, side="right")) - 1
        end = min(max(end, row + 1), len(column))
        yield row, end
        row = end


def _offsets(column: pa.Array) -> np.ndarray:
    wide = pa.types.is_large_string(column.type)
    raw = np.frombuffer(column.buffers()[1], dtype=np.int64 if wide else np.int32)
    return raw[column.offset : column.offset + len(column) + 1].astype(np.int64)


def texts_array(column: pa.Array) -> pa.Array:
    """The column without nulls, in one piece."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.fill_null("") if column.null_count else column


def word_hashes(column: pa.Array, fold: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of every word of every text, and the offsets of each text's words.

    ``fold`` lowers A-Z. A word's hash is a polynomial in its bytes, taken from running sums over the whole slice.
    """
    offsets = _offsets(column)
    first, last = int(offsets[0]), int(offsets[-1])
    if last == first:
        return np.empty(0, np.uint64), np.zeros(len(column) + 1, np.int64)
    data = np.frombuffer(column.buffers()[2], dtype=np.uint8)[first:last]
    offsets = offsets - first
    if fold:
        data = _FOLD[data]
    inside = ~_IS_SPACE[data]
    begin, stop = inside.copy(), inside.copy()
    begin[1:] &= ~inside[:-1]
    stop[:-1] &= ~inside[1:]
    filled = offsets[:-1][offsets[:-1] < offsets[1:]]
    begin[filled] = inside[filled]
    closed = offsets[1:][offsets[:-1] < offsets[1:]] - 1
    stop[closed] = inside[closed]
    starts, ends = np.flatnonzero(begin), np.flatnonzero(stop) + 1
    power, inverse = _powers.upto(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTES[data] * power[: len(data)], out=total[1:])
    hashes = mix((total[ends] - total[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))
    return hashes, np.searchsorted(starts, offsets)


def shingle_hashes(
    hashes: np.ndarray, offsets: np.ndarray, size: int, short: bool = False
) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``size`` words within a text, and the text of each, in order.

    With ``short`` a text of 1 to size - 1 words has one shingle, all its words; else it has none.
    """
    counts = np.diff(offsets)
    n = len(hashes)
    owner = np.repeat(np.arange(len(counts)), counts)
    factors = stream(77, size) | np.uint64(1)
    if n >= size:
        s = np.zeros(n - size + 1, np.uint64)
        for k in range(size):
            s += hashes[k : n - size + 1 + k] * factors[k]
        whole = owner[: n - size + 1] == owner[size - 1 :]
        s, docs = mix(s[whole]), owner[: n - size + 1][whole]
    else:
        s, docs = np.empty(0, np.uint64), np.empty(0, np.int64)
    if short:
        few = np.flatnonzero((counts > 0) & (counts < size))
        if len(few):
            extra = np.array(
                [np.sum(hashes[offsets[d] : offsets[d + 1]] * factors[: counts[d]]) for d in few], dtype=np.uint64
            )
            s, docs = np.concatenate([s, mix(extra + counts[few].astype(np.uint64))]), np.concatenate([docs, few])
            order = np.argsort(docs, kind="stable")
            s, docs = s[order], docs[order]
    return s, docs
