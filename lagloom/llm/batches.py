"""Arrow batches of a text table cut to bounded pieces, and words of such a piece as flat arrays.

A piece holds whole rows; its arrays are proportional to its bytes, so memory is bounded by the piece size or
by the longest single text. A null text counts as an empty one everywhere.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PIECE_BYTES = 1 << 21

GOLDEN = np.uint64(0x9E3779B97F4A7C15)
_TABLE_POSITIONS = 32


def mix64(values: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64: a bijection of 64-bit values that spreads every bit."""
    x = values ^ (values >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _byte_at(codes: np.ndarray) -> np.ndarray:
    return mix64((codes.astype(np.uint64) + np.uint64(1)) * GOLDEN)


_TABLE = _byte_at(np.arange(256 * _TABLE_POSITIONS))


def texts_of(batch: pa.RecordBatch | pa.Table, column: str = "text") -> pa.Array:
    """The text column without nulls, with 64-bit offsets."""
    values = pc.fill_null(batch.column(batch.schema.get_field_index(column)).cast(pa.large_string()), "")
    return values.combine_chunks() if isinstance(values, pa.ChunkedArray) else values


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts and the offsets of each, from 0."""
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if not len(texts) or offsets[0] == offsets[-1]:
        return np.zeros(0, dtype=np.uint8), np.zeros(len(texts) + 1, dtype=np.int64)
    data = np.frombuffer(texts.buffers()[2], dtype=np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def pieces(batches: Iterator[pa.RecordBatch], column: str = "text", size: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut so that a piece has about ``size`` bytes of text, one row at least; ``column`` without nulls."""
    for batch in batches:
        if not batch.num_rows:
            continue
        texts = texts_of(batch, column)
        batch = batch.set_column(batch.schema.get_field_index(column), column, texts)
        offsets = buffers(texts)[1]
        start = 0
        while start < batch.num_rows:
            stop = max(start + 1, int(np.searchsorted(offsets, offsets[start] + size, side="right")) - 1)
            yield batch.slice(start, stop - start)
            start = stop


class Words(NamedTuple):
    """Words ``[^\\x20\\x09-\\x0D]+`` of a piece: hash of each, and where those of each row begin (n rows + 1)."""

    hashes: np.ndarray
    rows: np.ndarray


def lowered(data: np.ndarray) -> np.ndarray:
    """The bytes with A-Z as a-z."""
    return data + ((data - np.uint8(65)) < 26) * np.uint8(32)


def word_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First byte and end of every word; a word never reaches over the end of a row."""
    size = len(data)
    if not size:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    inside = (data != 32) & ((data - np.uint8(9)) > 4)
    cut = np.zeros(size + 1, dtype=bool)
    cut[offsets] = True
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1] | cut[1:size]
    last[:-1] &= ~inside[1:] | cut[1:size]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of every byte span; spans are ascending, not empty and don't overlap.

    The sum over a span of a random value for each (byte, position) pair, with the length mixed in. Spans are taken from
    the longest to the shortest, so that those which have a position are the first ones.
    """
    if not len(starts):
        return np.zeros(0, dtype=np.uint64)
    lengths = ends - starts
    near = np.minimum(lengths, _TABLE_POSITIONS).astype(np.uint8)  # sorted by radix
    order = np.argsort(near, kind="stable")[::-1]
    at, sums = starts[order], np.zeros(len(starts), dtype=np.uint64)
    for position, count in enumerate(len(starts) - np.cumsum(np.bincount(near))[:-1]):
        sums[:count] += _TABLE[256 * position : 256 * position + 256].take(data.take(at[:count]))
        at[:count] += 1
    values = np.empty_like(sums)
    values[order] = sums
    if len(far := np.flatnonzero(lengths > _TABLE_POSITIONS)):
        rest = lengths[far] - _TABLE_POSITIONS
        heads = np.cumsum(rest) - rest
        behind = np.arange(heads[-1] + rest[-1]) - np.repeat(heads, rest) + _TABLE_POSITIONS
        codes = behind * 256 + data[behind + np.repeat(starts[far], rest)]
        values[far] += np.add.reduceat(_byte_at(codes), heads)
    return mix64(values + lengths.astype(np.uint64) * GOLDEN)


def words_of(texts: pa.Array, lower: bool = False) -> Words:
    """Words of all rows of a piece; with ``lower``, A-Z count as a-z."""
    data, offsets = buffers(texts)
    if lower:
        data = lowered(data)
    starts, ends = word_bounds(data, offsets)
    return Words(hash_spans(data, starts, ends), np.searchsorted(starts, offsets).astype(np.int64))


def window_hashes(hashes: np.ndarray, size: int, base: int = 0xD6E8FEB86659FD93) -> np.ndarray:
    """Rabin-Karp hash of every ``size`` consecutive values, 64 bits, of the flat array (also across rows).

    h = v[i] * base^(size-1) + ... + v[i+size-1] modulo 2^64, put together from windows of doubled lengths.
    """
    if len(hashes) < size:
        return np.zeros(0, dtype=np.uint64)
    power, part, length = np.uint64(base), hashes, 1
    out, done = None, 0
    with np.errstate(over="ignore"):
        rest = size
        while rest:
            if rest & 1:  # windows of the lengths in size's binary digits, side by side
                if out is None:
                    out, done = part, length
                else:
                    out = out[: len(hashes) - done - length + 1] * power + part[done : done + len(hashes) - done - length + 1]
                    done += length
            rest >>= 1
            if rest:
                part = part[: len(part) - length] * power + part[length:]
                power, length = power * power, 2 * length
    return mix64(out[: len(hashes) - size + 1])


def in_row(rows: np.ndarray, size: int) -> np.ndarray:
    """Flags of the flat positions at which ``size`` consecutive words lie in one row."""
    total = int(rows[-1])
    if total < size:
        return np.zeros(0, dtype=bool)
    counts = np.diff(rows)
    left = np.repeat(rows[1:], counts) - np.arange(total)
    return left[: total - size + 1] >= size
