"""Exact byte-substring deduplication by a hash-compared suffix sort.

Contexts that may repeat (see :mod:`repeats`) meet in shards. There, all suffixes that
begin a window are put in order: first by their leading 16 bytes, and ties by a
mergesort whose comparisons look for the common extension of two suffixes by binary
search over prefix polynomial hashes, so a comparison takes log2(length) steps.
Neighbours that agree over a whole window are compared once more byte by byte; where
hashes have collided, the group is parted by its bytes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import repeats, text

LENGTH = 50
SPEC = repeats.Spec(rule=None, length=LENGTH, gram=28)
_LEAD = 16
#: Suffix pairs handled at once.
_CHUNK = 1 << 20


class Suffixes:
    """Suffixes of ``data`` beginning at ``starts``, each with ``length`` bytes at least, compared over those."""

    def __init__(self, data: np.ndarray, length: int, prefix: np.ndarray | None = None):
        self.data, self.length = data, length
        self.prefix = text.prefix_hashes(text.byte_values(data)) if prefix is None else prefix

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Length of the common beginning of suffixes, ``length`` at most, by binary search."""
        inverse = text.powers(len(self.prefix))[1]
        known = np.zeros(len(a), np.int64)
        step = 1 << (self.length.bit_length() - 1)
        while step:
            tried = np.flatnonzero(known + step <= self.length)
            x, y = a[tried] + known[tried], b[tried] + known[tried]
            same = (self.prefix[x + step] - self.prefix[x]) * inverse[x] == (self.prefix[y + step] - self.prefix[y]) * inverse[y]
            known[tried[same]] += step
            step >>= 1
        return known

    def less(self, a: np.ndarray, b: np.ndarray, or_equal: np.ndarray) -> np.ndarray:
        """a < b, or a <= b where ``or_equal``."""
        out = np.empty(len(a), bool)
        for i in range(0, len(a), _CHUNK):
            part = slice(i, i + _CHUNK)
            x, y = a[part], b[part]
            common = self.common(x, y)
            ends = common >= self.length
            at = np.where(ends, 0, common)
            out[part] = np.where(ends, or_equal[part], self.data[x + at] < self.data[y + at])
        return out

    def _lead(self, starts: np.ndarray, skip: int) -> np.ndarray:
        key = np.zeros(len(starts), np.uint64)
        for j in range(skip, skip + 8):
            key = (key << np.uint64(8)) | (self.data[starts + j] if j < self.length else np.uint64(0))
        return key

    def sort(self, starts: np.ndarray) -> np.ndarray:
        """Order that puts the suffixes in lexicographic order of their first ``length`` bytes."""
        high, low = self._lead(starts, 0), self._lead(starts, 8)
        order = np.lexsort((low, high))
        high, low = high[order], low[order]
        begins = np.flatnonzero(np.concatenate([[True], (high[1:] != high[:-1]) | (low[1:] != low[:-1])])[: len(order)])
        sizes = np.diff(np.append(begins, len(order)))
        tied = np.flatnonzero(sizes > 1)
        begin, size = np.repeat(begins[tied], sizes[tied]), np.repeat(sizes[tied], sizes[tied])
        place = begin + np.arange(len(begin)) - np.repeat(np.cumsum(sizes[tied]) - sizes[tied], sizes[tied])
        width = 1
        while len(place):
            place, begin, size = (x[size > width] for x in (place, begin, size))
            if len(place):
                self._merge(starts, order, place, begin, size, width)
            width *= 2
        return order

    def _merge(self, starts, order, place, begin, size, width) -> None:
        """Merge neighbouring sorted runs of ``width`` within each group of ties, all groups at once."""
        own = place - begin
        run = own // width
        other = begin + (run ^ 1) * width
        end = np.minimum(other + width, begin + size)
        other = np.minimum(other, end)
        left = run % 2 == 0
        low, high = other.copy(), end.copy()
        mine = starts[order[place]]
        active = np.flatnonzero(low < high)
        while len(active):
            middle = (low[active] + high[active]) // 2
            # A suffix stands after those of the other run that are less, and of a left run also after equal ones.
            before = self.less(starts[order[middle]], mine[active], ~left[active])
            low[active[before]] = middle[before] + 1
            high[active[~before]] = middle[~before]
            active = active[low[active] < high[active]]
        target = begin + (run // 2) * 2 * width + own % width + (low - other)
        order[target] = order[place]

    def groups(self, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(order, number of the group of equal windows of each place in it); equality is checked on the bytes."""
        order = self.sort(starts)
        ordered = starts[order]
        same = np.zeros(len(order), bool)
        collided = []
        for i in range(1, len(order), _CHUNK // 8):
            here = np.arange(i, min(len(order), i + _CHUNK // 8))
            a, b = ordered[here - 1], ordered[here]
            equal = self.common(a, b) >= self.length
            at = np.flatnonzero(equal)
            span = np.arange(self.length)
            true = (self.data[a[at][:, None] + span] == self.data[b[at][:, None] + span]).all(axis=1)
            same[here[at]] = True
            collided.append(here[at[~true]])
        number = np.cumsum(~same) - 1
        for group in np.unique(number[np.concatenate(collided)]) if any(map(len, collided)) else ():
            members = np.flatnonzero(number == group)
            seen: dict[bytes, int] = {}
            for m in members:
                window = self.data[ordered[m] : ordered[m] + self.length].tobytes()
                number[m] = seen.setdefault(window, int(group) if not seen else len(order) + int(m))
        return order, number


def first_ids(content: np.ndarray, offsets: np.ndarray, n: np.ndarray, least: np.ndarray) -> np.ndarray:
    """Smallest id of every window of the contexts; see :data:`repeats.Resolver`."""
    owner = np.repeat(np.arange(len(n)), n)
    starts = offsets[:-1][owner] + np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)
    order, number = Suffixes(content, LENGTH).groups(starts)
    _, group = np.unique(number, return_inverse=True)
    smallest = np.full(int(group.max(initial=-1)) + 1, repeats.LAST)
    np.minimum.at(smallest, group, least[owner[order]])
    out = np.empty(len(owner), np.int64)
    out[order] = smallest[group]
    return out


def _finish(units: repeats.Units, cover: np.ndarray) -> dict[str, pa.Array]:
    rows = units.rows
    n = len(rows) - 1
    begin, end = text.runs(cover)
    # A run of removed bytes ends where its document does.
    cuts = rows[1:-1]
    inner = cuts[(cuts > 0) & (cuts < len(cover))]
    inner = inner[cover[inner - 1] & cover[inner]]
    inner = np.unique(inner)
    begin, end = np.sort(np.concatenate([begin, inner])), np.sort(np.concatenate([end, inner]))
    removed = np.concatenate([[0], np.cumsum(cover)])
    kept_bytes = units.data[~cover].tobytes()
    kept_at = rows - removed[rows]
    span_row = np.searchsorted(rows, begin, "right") - 1
    at = np.searchsorted(span_row, np.arange(n + 1))
    flat = np.stack([begin - rows[span_row], end - rows[span_row]], axis=1).ravel()
    spans = pa.ListArray.from_arrays(pa.array(2 * at, pa.int32()), pa.array(flat, pa.int64()))
    return {
        "n_bytes": pa.array(np.diff(rows), pa.int64()),
        "n_removed": pa.array(np.diff(removed[rows]), pa.int64()),
        "n_spans": pa.array(np.diff(at), pa.int64()),
        "spans": spans,
        "kept": pa.array([kept_bytes[a:b] for a, b in zip(kept_at[:-1], kept_at[1:], strict=True)], pa.binary()),
    }


def deduplicate(docs: DataFrame, columns: tuple[str, ...] = ("doc_id",), id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``columns`` with n_bytes, n_removed, n_spans, spans (byte pairs) and the bytes kept, per document.

    Every byte covered by a 50-byte string that also starts in a document of smaller id goes.
    Nulls, short texts, repeated rows and ties: see :mod:`repeats`.
    """
    made = "n_bytes bigint, n_removed bigint, n_spans bigint, spans array<bigint>, kept binary"
    return repeats.find(docs, SPEC, first_ids, _finish, made, columns, id_column, text_column)
