"""Word boundaries and 64-bit word hashes of whole Arrow batches, without a Python loop over words.

A word is a maximal run of bytes other than \\x20 and \\x09-\\x0D.  The hash of a word is a polynomial
over its bytes modulo 2**64, taken from one running sum over the batch and then mixed, so equal words
hash alike wherever they stand.  Sequences of words hash the same way over the word hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_SEED = np.random.default_rng(20240131)
#: A value for each byte: as it is, with A-Z as a-z, and so but with ASCII punctuation left out.
EXACT = _SEED.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
LOWER = EXACT.copy()
LOWER[65:91] = EXACT[97:123]
BARE = LOWER.copy()
BARE[[b for b in range(33, 127) if not chr(b).isalnum()]] = 0
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True

# A multiplier and its inverse modulo 2**64: for bytes, and for words.
_BYTE_MUL = 0x9E3779B97F4A7C15
_WORD_MUL = 0xC2B2AE3D27D4EB4F
#: Bytes that are hashed at once; longer batches are cut at word boundaries.
BLOCK = 1 << 20
_powers: dict[tuple[int, bool], np.ndarray] = {}


def powers(multiplier: int, n: int, inverse: bool = False) -> np.ndarray:
    """multiplier ** (0 .. n-1), or those of its inverse, modulo 2**64; kept between calls."""
    got = _powers.get((multiplier, inverse))
    if got is None or len(got) < n:
        size = 1 << max(10, (n - 1).bit_length())
        base = pow(multiplier, -1, 1 << 64) if inverse else multiplier
        got = np.ones(size, np.uint64)
        got[1:] = np.uint64(base)
        got = np.multiply.accumulate(got)
        _powers[(multiplier, inverse)] = got
    return got[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every input bit (the splitmix64 finalizer)."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _block(data: np.ndarray, values: np.ndarray, gaps: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    gap = np.ones(len(data) + 2, bool)
    np.take(gaps, data, out=gap[1:-1])
    edge = np.flatnonzero(gap[1:] != gap[:-1])
    starts, ends = edge[::2], edge[1::2]
    value = np.take(values, data)
    value *= powers(_BYTE_MUL, len(data))
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(value, out=total[1:])
    hashes = (total[ends] - total[starts]) * powers(_BYTE_MUL, len(data) + 1, True)[starts]
    return starts, ends, mix(hashes)


def words(
    data: np.ndarray, values: np.ndarray = EXACT, gaps: np.ndarray = _SPACE,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends (byte offsets, end exclusive) and hashes of all words of a byte array.

    `values` says what counts in a byte, `gaps` which bytes stand between words.  Memory stays near
    the result's for any length: blocks are cut at a gap.
    """
    parts, at = [], 0
    while at < len(data):
        to = min(len(data), at + BLOCK)
        while to < len(data):
            found = np.flatnonzero(gaps[data[max(at, to - 4096) : to]])
            if len(found):
                to = max(at, to - 4096) + int(found[-1]) + 1
                break
            to = min(len(data), to + 4096)
        s, e, h = _block(data[at:to], values, gaps)
        parts.append((s + at, e + at, h))
        at = to
    if not parts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    return tuple(np.concatenate(x) for x in zip(*parts))


def runs(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of every run of n consecutive words; len(hashes) - n + 1 of them, none if there are fewer."""
    if len(hashes) < n:
        return np.zeros(0, np.uint64)
    total = np.zeros(len(hashes) + 1, np.uint64)
    np.cumsum(hashes * powers(_WORD_MUL, len(hashes)), out=total[1:])
    total = total[n:] - total[:-n]
    total *= powers(_WORD_MUL, len(total), True)
    return mix(total + np.uint64(n))


def bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column, one text after another, and the offsets; a null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    body = column.buffers()[2]
    data = np.frombuffer(body, np.uint8) if body is not None and body.size else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(batch: pa.RecordBatch, column: str, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with about `most` bytes of text each, at least a row."""
    if not batch.num_rows:
        return
    _, offsets = bytes_of(batch.column(column))
    at = 0
    while at < batch.num_rows:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + most, "right")) - 1)
        yield batch.slice(at, to - at)
        at = to


def byte_set(members) -> np.ndarray:
    """Which of the 256 bytes are members, as a table."""
    table = np.zeros(256, bool)
    table[list(members)] = True
    return table


def words_of(column: pa.Array, values: np.ndarray = EXACT, gaps: np.ndarray = _SPACE, between: int = 0x20):
    """Words of a string column: data, starts, ends, hashes, and for each row where its words begin.

    A gap byte (`between`) is put between rows, so that no word spans two of them.
    """
    data, offsets = bytes_of(column)
    n = len(offsets) - 1
    spaced = np.full(len(data) + n, between, np.uint8)
    if len(data):
        spaced[np.arange(len(data)) + np.repeat(np.arange(n), np.diff(offsets))] = data
    starts, ends, hashes = words(spaced, values, gaps)
    first = np.searchsorted(starts, offsets + np.arange(n + 1))
    return spaced, starts, ends, hashes, first
