"""64-bit hashes of all words of Arrow string columns, by NumPy over the raw UTF-8 bytes.

A word is a maximal run of bytes that the byte table maps to non-zero; the table also folds A-Z.
All separators are ASCII, so cutting bytes equals cutting characters.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes handled at once; a longer text is handled in pieces that end at separators.
CHUNK = 1 << 18
_RANDOM = np.random.default_rng(20_011)
_BYTE = _RANDOM.integers(1, 2**63, 257, np.uint64) * np.uint64(2) + np.uint64(1)
_PLACE = _RANDOM.integers(1, 2**63, 1024, np.uint64) * np.uint64(2) + np.uint64(1)
_FAR = np.uint64(0x9E3779B97F4A7C15)


def byte_table(separators: bytes) -> np.ndarray:
    """uint16[256]: 0 for separators, else 1 + the byte with A-Z folded to a-z."""
    table = np.arange(1, 257, dtype=np.uint16)
    table[65:91] = table[97:123]
    table[np.frombuffer(separators, np.uint8)] = 0
    return table


SPACE_TABLE = byte_table(b" \t\n\x0b\x0c\r")
#: Separators of [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ after folding A-Z.
ALNUM_TABLE = byte_table(bytes([*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of uint64 values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _hash(data: np.ndarray, cuts: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of ``data`` and their start bytes; no word crosses a position in ``cuts``."""
    codes = table[data]
    inside = codes != 0
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    cuts = cuts[(cuts > 0) & (cuts < len(data))]
    begins[cuts] |= inside[cuts]
    starts = np.flatnonzero(begins)
    if not len(starts):
        return np.zeros(0, np.uint64), starts
    where = np.flatnonzero(inside)
    first = np.cumsum(begins)[inside] - 1
    offset = where - starts[first]
    weight = _PLACE[offset & 1023]
    far = offset >> 10
    if far.any():
        weight = weight ^ (far.astype(np.uint64) * _FAR)
    heads = np.flatnonzero(begins[inside])
    return mix(np.add.reduceat(_BYTE[codes[inside]] * weight, heads)), starts


def hash_bytes(data: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Word hashes of one text; texts of any length in pieces of bounded size."""
    parts, at = [], 0
    while at < len(data):
        end = min(at + CHUNK, len(data))
        while end < len(data):  # go back to a separator; a longer word makes the piece longer
            stop = np.flatnonzero(table[data[at:end]] == 0)
            if len(stop):
                end = at + int(stop[-1]) + 1
                break
            end = min(end + CHUNK, len(data))
        parts.append(_hash(data[at:end], np.zeros(0, np.int64), table)[0])
        at = end
    return np.concatenate(parts) if parts else np.zeros(0, np.uint64)


def _bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    wide = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    offs = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset:column.offset + len(column) + 1]
    return np.frombuffer(data or b"", np.uint8), offs.astype(np.int64)


def column_words(column: pa.Array, table: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Runs of rows as (first row, word counts per row, their word hashes); null rows have no words."""
    if not len(column):
        return
    data, offs = _bytes_of(column)
    row, rows = 0, len(column)
    while row < rows:
        if offs[row + 1] - offs[row] > CHUNK:
            hashes = hash_bytes(data[offs[row]:offs[row + 1]], table)
            yield row, np.array([len(hashes)]), hashes
            row += 1
            continue
        end = max(row + 1, int(np.searchsorted(offs, offs[row] + CHUNK, "right")) - 1)
        end = min(end, rows)
        cuts = offs[row:end + 1] - offs[row]
        hashes, starts = _hash(data[offs[row]:offs[end]], cuts, table)
        at = np.searchsorted(starts, cuts)
        yield row, np.diff(at), hashes
        row = end
