"""Words and hashes of Arrow text columns, computed on their bytes with numpy.

A text column is cut into slices of about half a megabyte, so the arrays below stay
small whatever the batch; one text alone may exceed that and is then a slice.
All hashes are 64 bits and depend on bytes only, so every worker agrees.

Sequences have polynomial hashes modulo 2**64. Of those, a sequence of 1,024 or more units that
alternate by the parity of their places' bits and its mirror image are alike whatever the base,
so they serve short sequences only: words of up to 32 bytes, and up to a hundred words or bytes.
Longer ones are hashed by xxHash, which is not linear.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

SLICE_BYTES = 1 << 19
#: Bytes of a word up to which its hash is a polynomial.
LONG_WORD = 32
U64 = np.uint64

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_ALNUM = np.zeros(256, bool)
_ALNUM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


@dataclass(frozen=True)
class Rule:
    """Which bytes belong to words, and whether A-Z is lower-cased first."""

    word: np.ndarray
    lower: bool


#: Runs of anything but ASCII white space, as they are.
TOKENS = Rule(~_SPACE, False)
#: The same with A-Z lower-cased.
LOWER_TOKENS = Rule(~_SPACE, True)
#: Runs of ASCII letters and digits and of all other characters, lower-cased.
LOWER_WORDS = Rule(_ALNUM, True)

_BASE = 0x9E3779B97F4A7C15 | 1
_VALUES = np.random.default_rng(20240607).integers(1, 1 << 63, 256, dtype=np.uint64) * U64(2) + U64(1)
_powers = (np.ones(1, np.uint64), np.ones(1, np.uint64))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of the hash base modulo 2**64, and their inverses."""
    global _powers
    if len(_powers[0]) < n:
        size = max(n + n // 8, SLICE_BYTES + 64)
        made = []
        for base in (_BASE, pow(_BASE, -1, 1 << 64)):
            factors = np.full(size, base, np.uint64)
            factors[0] = 1
            made.append(np.multiply.accumulate(factors))
        _powers = tuple(made)
    return _powers[0][:n], _powers[1][:n]


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread every bit of 64-bit hashes over all others."""
    x = x ^ (x >> U64(33))
    x *= U64(0xFF51AFD7ED558CCD)
    x ^= x >> U64(33)
    x *= U64(0xC4CEB9FE1A85EC53)
    x ^= x >> U64(33)
    return x


def prefix_hashes(values: np.ndarray) -> np.ndarray:
    """C with C[b] - C[a] times the inverse power of a being the hash of values[a:b]."""
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * powers(len(values))[0], out=out[1:])
    return out


def byte_values(data: np.ndarray) -> np.ndarray:
    return _VALUES[data]


def range_hashes(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    return mixed((prefix[end] - prefix[start]) * powers(len(prefix))[1][start])


def window_hashes(prefix: np.ndarray, width: int) -> np.ndarray:
    """Hashes of every ``width`` consecutive values."""
    n = max(0, len(prefix) - width)
    return mixed((prefix[width:] - prefix[:n]) * powers(len(prefix))[1][:n])


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column, null as empty, and where each row begins and the last ends."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw, at


#: What an operator keeps in this worker for its later tasks. Slicing texts, as all other operators
#: on texts do, lets it go, and so does decoding, so that their memory and this do not add up.
kept: dict[str, object] = {}


_trim = getattr(ctypes.CDLL(None), "malloc_trim", None)


def release() -> None:
    """Give back what is free in this worker. Workers live on between tasks, more of them than run
    at a time, and each would keep the most that it ever held."""
    pa.default_memory_pool().release_unused()
    if _trim:
        _trim(0)


def slices(column: pa.Array, size: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, bytes, row offsets into them) of successive slices."""
    kept.clear()
    data, at = utf8(column)
    row = 0
    while row < len(at) - 1:
        end = max(row + 1, int(np.searchsorted(at, at[row] + size, "right")) - 1)
        yield row, end, data[at[row] : at[end]], at[row : end + 1] - at[row]
        row = end
    del data, at
    release()


def parts(batch: pa.RecordBatch, column: int, size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in successive pieces of about ``size`` bytes of a text or binary column."""
    lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    at = np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)])
    row = 0
    while row < batch.num_rows:
        end = max(row + 1, int(np.searchsorted(at, at[row] + size, "right")) - 1)
        yield batch.slice(row, end - row)
        row = end
    release()


@dataclass(frozen=True)
class Words:
    """Words of a slice: byte ranges, 64-bit hashes, and the index of each row's first word."""

    start: np.ndarray
    end: np.ndarray
    hashes: np.ndarray
    rows: np.ndarray

    @property
    def row_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.rows) - 1), np.diff(self.rows))


def words(data: np.ndarray, offsets: np.ndarray, rule: Rule) -> Words:
    inside = rule.word[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    before = np.empty(len(data), bool)
    before[:1] = False
    before[1:] = inside[:-1]
    start = np.flatnonzero(inside & (~before | edge[:-1]))
    after = np.empty(len(data), bool)
    after[-1:] = False
    after[:-1] = inside[1:]
    end = np.flatnonzero(inside & (~after | edge[1:])) + 1
    values = _VALUES[_LOWER] if rule.lower else _VALUES
    hashes = range_hashes(prefix_hashes(values[data]), start, end)
    for i in np.flatnonzero(end - start > LONG_WORD):
        word = data[start[i] : end[i]]
        hashes[i] = xxhash.xxh3_64_intdigest((_LOWER[word] if rule.lower else word).tobytes())
    return Words(start, end, hashes, np.searchsorted(start, offsets))


def sequence_hashes(found: Words) -> np.ndarray:
    """128 bits, as two signed numbers, of each row's whole sequence of words."""
    raw, at = found.hashes.tobytes(), (found.rows * 8).tolist()
    digests = b"".join(xxhash.xxh3_128_digest(raw[a:b]) for a, b in zip(at[:-1], at[1:], strict=True))
    return np.frombuffer(digests, np.int64).reshape(-1, 2)


def hash_word(word: bytes) -> int:
    """The hash that :func:`words` gives a word, already lower-cased where the rule says so."""
    if len(word) > LONG_WORD:
        return xxhash.xxh3_64_intdigest(word)
    data = np.frombuffer(word, np.uint8)
    ends = np.array([len(data)])
    return int(range_hashes(prefix_hashes(_VALUES[data]), np.zeros(1, np.int64), ends)[0])


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive values."""
    done, span = x, 1
    while span * 2 <= width:
        done = np.minimum(done[:-span], done[span:])
        span *= 2
    return np.minimum(done[: len(x) - width + 1], done[width - span :]) if width > span else done


def row_windows(rows: np.ndarray, width: int) -> np.ndarray:
    """Which positions of all rows' values begin ``width`` values within one row."""
    n = int(rows[-1])
    valid = np.zeros(n + 1, np.int32)
    long = np.diff(rows) >= width
    np.add.at(valid, rows[:-1][long], 1)
    np.add.at(valid, rows[1:][long] - width + 1, -1)
    return np.flatnonzero(np.cumsum(valid[:n]))


def covered(n: int, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Which of n places lie in any of the ranges."""
    steps = np.zeros(n + 1, np.int64)
    np.add.at(steps, start, 1)
    np.add.at(steps, end, -1)
    return np.cumsum(steps[:n]) > 0


def runs(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Beginnings and ends of the stretches of True."""
    steps = np.diff(np.concatenate([[0], mask.astype(np.int8), [0]]))
    return np.flatnonzero(steps == 1), np.flatnonzero(steps == -1)
