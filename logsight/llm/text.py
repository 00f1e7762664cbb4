"""Arrow text columns as byte arrays, and content hashes over them, for use inside tasks."""

from __future__ import annotations

import ctypes
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
U64 = np.uint64


def prepare(spark: SparkSession) -> SparkSession:
    """Lets Python workers import this package where it is run from a source folder."""
    env = spark.sparkContext.environment
    parts = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if ROOT not in parts:
        env["PYTHONPATH"] = os.pathsep.join([ROOT, *parts])
    return spark


def give_back() -> None:
    """Return what a task has freed to the system, so that an idle worker does not hold on to it."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the GNU library only
    if trim is not None:
        trim(0)


def whole_text(text_col: str = "text") -> Column:
    """The text, with null as the empty string."""
    return F.coalesce(F.col(text_col).cast("string"), F.lit(""))


def spread(df: DataFrame, columns: list[str | Column], partitions: int | None = None) -> DataFrame:
    """The rows dealt out by a hash of columns, into as many partitions as a shuffle has."""
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(n, *columns)


class Texts:
    """The texts of an Arrow column as one byte array with the start of each."""

    def __init__(self, column: pa.Array):
        if column.null_count:
            column = column.fill_null(b"" if pa.types.is_binary(column.type) else "")
        wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
        _, offsets, data = column.buffers()
        kind = np.int64 if wide else np.int32
        n = len(column)
        at = np.frombuffer(offsets, kind)[column.offset : column.offset + n + 1] if n else np.zeros(1, kind)
        self.offsets = at.astype(np.int64)
        self.data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def blocks(self, most_bytes: int, most_rows: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """(first row, end row, bytes, starts in them) of blocks; a longer text is a block of its own."""
        row, n = 0, len(self)
        while row < n:
            end = int(np.searchsorted(self.offsets, self.offsets[row] + most_bytes, "right")) - 1
            end = min(max(end, row + 1), row + most_rows, n)
            lo, hi = self.offsets[row], self.offsets[end]
            yield row, end, self.data[lo:hi], self.offsets[row : end + 1] - lo
            row = end


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words whose every output bit depends on every input bit."""
    with np.errstate(over="ignore"):
        x = x ^ (x >> U64(33))
        x = x * U64(0xFF51AFD7ED558CCD)
        x = x ^ (x >> U64(33))
        x = x * U64(0xC4CEB9FE1A85EC53)
        return x ^ (x >> U64(33))


_BASE = 0x9E3779B97F4A7C15 | 1
_BYTE_VALUES = mix(np.arange(1, 257, dtype=U64) * U64(0xD6E8FEB86659FD93))


class Powers:
    """Powers of the hash base and of its inverse modulo 2^64, grown as needed."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, U64)

    def upto(self, n: int) -> None:
        if len(self.up) <= n:
            size = n + 1 + (n >> 2)
            self.up, self.down = (self._table(b, size) for b in (_BASE, pow(_BASE, -1, 1 << 64)))

    @staticmethod
    def _table(base: int, size: int) -> np.ndarray:
        steps = np.full(size, U64(base), U64)
        steps[0] = 1
        with np.errstate(over="ignore"):
            return np.multiply.accumulate(steps)


_POWERS = Powers()


class Hashed:
    """Content hashes of any slices of a byte array in constant time each."""

    def __init__(self, data: np.ndarray):
        _POWERS.upto(len(data))
        self.sums = np.zeros(len(data) + 1, U64)
        with np.errstate(over="ignore"):
            np.cumsum(_BYTE_VALUES[data] * _POWERS.up[: len(data)], out=self.sums[1:])

    def slices(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return mix((self.sums[ends] - self.sums[starts]) * _POWERS.down[starts])


def word_bounds(inside: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of runs of `inside` bytes that no text boundary cuts, and the text of each.

    starts holds the first byte of each text and, last, the number of bytes.
    """
    n = len(inside)
    before = np.empty(n + 1, bool)
    before[0], before[n] = False, False
    before[1:n] = inside[: n - 1] if n else False
    cut = starts[:-1][starts[:-1] < n]
    first = before[:n].copy()
    first[cut] = False
    begin = np.flatnonzero(inside & ~first)
    after = np.zeros(n, bool)
    after[: n - 1] = inside[1:]
    ends_at = starts[1:][(starts[1:] > 0) & (starts[1:] <= n)] - 1
    after[ends_at] = False
    end = np.flatnonzero(inside & ~after) + 1
    return begin, end, np.searchsorted(starts, begin, "right") - 1


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """All positions starts[i] .. starts[i] + lengths[i] - 1, one after the other."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    first = np.repeat(starts - (np.cumsum(lengths) - lengths), lengths)
    return first + np.arange(total)
