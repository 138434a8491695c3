"""Sorted 64-bit keys as bytes, dealt to shards by their leading bits."""

from __future__ import annotations

import numpy as np


def pack(keys: np.ndarray, size: int = 8) -> bytes:
    """Byte planes, leading bytes first, which shuffle compression shrinks for sorted keys; the first ``size`` bytes."""
    return np.ascontiguousarray(keys.astype(">u8").view(np.uint8).reshape(-1, 8)[:, :size].T).tobytes()


def unpack(packed: bytes, size: int = 8) -> np.ndarray:
    """The keys; bytes that were not packed are 0."""
    planes = np.frombuffer(packed, np.uint8).reshape(size, -1)
    out = np.zeros((planes.shape[1], 8), np.uint8)
    out[:, :size] = planes.T
    return out.view(">u8").ravel().astype(np.uint64)


def shard_of(keys: np.ndarray, shards: int) -> np.ndarray:
    """Shards are ranges of keys, equal in size as hashes are even."""
    return ((keys >> np.uint64(32)) * np.uint64(shards)) >> np.uint64(32)


def shard_bounds(keys: np.ndarray, shards: int) -> np.ndarray:
    """Where each shard's part of sorted keys begins, and the last one ends."""
    return np.searchsorted(shard_of(keys, shards), np.arange(shards + 1, dtype=np.uint64))


def summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, sorted, each with its total."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    begins = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])[: len(keys)])
    return keys[begins], np.add.reduceat(counts[order], begins) if len(begins) else counts[:0]


def look_up(table: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Index of each key in a sorted table, or -1."""
    if not len(table):
        return np.full(len(keys), -1)
    at = np.minimum(np.searchsorted(table, keys), len(table) - 1)
    return np.where(table[at] == keys, at, -1)
