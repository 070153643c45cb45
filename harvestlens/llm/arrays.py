"""Numpy helpers on Arrow text columns that several operators of this package share."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

_RNG = np.random.Generator(np.random.PCG64(20240601))
BYTE_VALUE = _RNG.integers(1, 2**63, 256, dtype=np.uint64)
STEP = np.uint64(0x9E3779B97F4A7C15)
#: Bytes A-Z to a-z, all others unchanged.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def byte_class(excluded: str) -> np.ndarray:
    """True for every byte but those in `excluded` (code points below 128)."""
    table = np.ones(256, bool)
    table[list(excluded.encode("ascii"))] = False
    return table


#: Words as runs of anything but blank, tab, line ends and the like.
NOT_BLANK = byte_class(" \t\n\v\f\r")


#: Bytes of text that a worker of a memory-bound step takes at once: a byte of text becomes several numbers of 8 bytes.
SMALL = 1 << 19


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of unsigned 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def chunks(batch: pa.RecordBatch, column: str, limit: int = 1 << 21) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about `limit` bytes of text at most, or one row."""
    offsets = text_buffer(batch.column(column))[1]
    row = 0
    while row < batch.num_rows:
        stop = max(row + 1, int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1)
        yield batch.slice(row, stop - row)
        row = stop


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all rows one after another, and where each row begins (and the end); null as empty."""
    column = column.cast(pa.large_binary()).fill_null(b"")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def words(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, ...]:
    """Start and end byte of every word, and the number of each row's first word (and their total).

    A word is a longest run of bytes for which `inside` is true; no word crosses rows.
    """
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(offsets), np.int64)
    inner, cut = inside[data], np.zeros(len(data) + 1, bool)
    cut[offsets] = True
    begin, end = inner.copy(), inner.copy()
    begin[1:] &= ~inner[:-1] | cut[1:-1]
    end[:-1] &= ~inner[1:] | cut[1:-1]
    starts = np.flatnonzero(begin)
    return starts, np.flatnonzero(end) + 1, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word's bytes; words must be in order and must not overlap."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    sizes = ends - starts
    first = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    at = np.arange(int(sizes.sum())) - np.repeat(first, sizes)
    powers = np.cumprod(np.full(int(sizes.max()), STEP, np.uint64))
    sums = np.add.reduceat(BYTE_VALUE[data[at + np.repeat(starts, sizes)]] * powers[at], first)
    return mix(sums + sizes.astype(np.uint64))


def _crc_table() -> np.ndarray:
    """The table of the reflected CRC-32 polynomial, by its rule."""
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1)
    return table


CRC_TABLE = _crc_table()


def crc32(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, before: np.ndarray | int = 0, long: int = 64) -> np.ndarray:
    """The unsigned CRC-32 of each byte range, carried on from the CRC `before` it; ranges over `long` bytes one by one."""
    out = np.broadcast_to(np.asarray(before, np.uint32), starts.shape).copy()
    sizes = ends - starts
    order = np.argsort(-np.minimum(sizes, long + 1).astype(np.int16), kind="stable")
    n_long = int((sizes > long).sum())
    for i in order[:n_long].tolist():
        out[i] = zlib.crc32(data[starts[i] : ends[i]].tobytes(), int(out[i]))
    order = order[n_long:]
    at, sizes, state = starts[order], sizes[order], ~out[order]
    live = len(order) - np.searchsorted(sizes[::-1], np.arange(int(sizes.max(initial=0))), "right")
    for j, n in enumerate(live.tolist()):
        state[:n] = CRC_TABLE[(state[:n] ^ data[at[:n] + j]) & np.uint32(255)] ^ (state[:n] >> np.uint32(8))
    out[order] = ~state
    return out


def strings(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The byte ranges, in order and without overlaps, as an Arrow text column."""
    sizes = ends - starts
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    at = np.arange(offsets[-1]) + np.repeat(starts - offsets[:-1], sizes)
    return pa.LargeStringArray.from_buffers(len(sizes), pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data[at])))


def rolling(symbols: np.ndarray, length: int) -> np.ndarray:
    """A 64-bit hash of every run of `length` symbols, built from runs of powers of two."""
    part, size, power = mix(symbols.astype(np.uint64) + np.uint64(1)), 1, STEP
    out, covered = None, 0
    with np.errstate(over="ignore"):
        while length:
            if length & 1:
                n = len(symbols) - covered - size + 1
                out = part if out is None else out[:n] * power + part[covered : covered + n]
                covered += size
            length >>= 1
            if length:
                n = len(symbols) - 2 * size + 1
                part = part[:n] * power + part[size : size + n]
                power, size = power * power, 2 * size
    return mix(out)


def sliding(values: np.ndarray, length: int, best=np.minimum) -> np.ndarray:
    """The least (or with np.maximum largest) of every `length` neighbours."""
    size, out = 1, values
    while 2 * size <= length:
        out, size = best(out[: len(out) - size], out[size:]), 2 * size
    n = len(values) - length + 1
    return best(out[:n], out[length - size : length - size + n])


def merged(starts: np.ndarray, stops: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The union of intervals as sorted intervals that neither overlap nor touch."""
    if not len(starts):
        return starts, stops
    order = np.argsort(starts, kind="stable")
    starts, stops = starts[order], np.maximum.accumulate(stops[order])
    new = np.concatenate([[True], starts[1:] > stops[:-1]])
    return starts[new], stops[np.concatenate([new[1:], [True]])]


def order_of(values: np.ndarray) -> np.ndarray:
    """A stable order of non-negative integers, by radix passes of 16 bits."""
    order = np.argsort((values & 0xFFFF).astype(np.uint16), kind="stable")
    rest = values >> 16
    while rest.any():
        order = order[np.argsort((rest[order] & 0xFFFF).astype(np.uint16), kind="stable")]
        rest = rest >> 16
    return order


def dense(values: np.ndarray, least: int = 0) -> np.ndarray:
    """The rank of each value among the distinct ones, from `least` on."""
    return np.unique(values, return_inverse=True)[1].astype(np.int64) + least


def table_of(columns: dict, schema: pa.Schema) -> pa.RecordBatch:
    """A record batch of arrays or lists by name."""
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) for f in schema], schema=schema)


def schema_with(returns: str, docs: DataFrame, keep: list[str]) -> StructType:
    """What an operator returns, and the columns of its input that it hands on."""
    return StructType([*StructType.fromDDL(returns).fields, *(docs.schema[c] for c in keep)])
