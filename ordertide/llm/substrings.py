"""Word-passage deduplication by matching statistics against suffix automata.

Passages that may repeat (see :mod:`repeats`) meet in shards; the contexts of a shard,
cut to the windows that more than one of them holds and each distinct passage once,
are its reference. They enter a suffix automaton in the order of their smallest ids.
Before it enters, a passage is streamed through the automaton: at every word, the
length of the longest match that ends there. Where the length reaches a window, the
window stands in a smaller document.

The automata of all shards together grow with the corpus and have no size bound, so
they are not broadcast; passages are sent to the shard whose automaton concerns them.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import repeats, text

LENGTH = 50
SPEC = repeats.Spec(rule=text.TOKENS, length=LENGTH, gram=16)


class Automaton:
    """Suffix automaton of several sequences; no match runs from one into another."""

    def __init__(self):
        self.next: list[dict] = [{}]
        self.link = [-1]
        self.length = [0]

    def matched(self, sequence: list) -> list[int]:
        """At each element, the length of the longest match that ends there."""
        out, state, size = [], 0, 0
        following, link, length = self.next, self.link, self.length
        for x in sequence:
            while state and x not in following[state]:
                state = link[state]
                size = length[state]
            if (to := following[state].get(x)) is not None:
                state, size = to, size + 1
            out.append(size)
        return out

    def add(self, sequence: list) -> None:
        last = 0
        following, link, length = self.next, self.link, self.length
        for x in sequence:
            if (to := following[last].get(x)) is not None:
                last = to if length[to] == length[last] + 1 else self._clone(last, x, to)
                continue
            new = len(following)
            following.append({})
            link.append(0)
            length.append(length[last] + 1)
            p = last
            while p != -1 and x not in following[p]:
                following[p][x] = new
                p = link[p]
            if p != -1:
                to = following[p][x]
                link[new] = to if length[to] == length[p] + 1 else self._clone(p, x, to)
            last = new

    def _clone(self, p: int, x, to: int) -> int:
        following, link, length = self.next, self.link, self.length
        new = len(following)
        following.append(dict(following[to]))
        link.append(link[to])
        length.append(length[p] + 1)
        link[to] = new
        while p != -1 and following[p].get(x) == to:
            following[p][x] = new
            p = link[p]
        return new


def first_ids(content: np.ndarray, offsets: np.ndarray, n: np.ndarray, least: np.ndarray) -> np.ndarray:
    """Smallest id, or EARLIER, of every window of the contexts; see :data:`repeats.Resolver`."""
    found = text.words(content, offsets, text.TOKENS)
    prefix = text.prefix_hashes(found.hashes)
    owner = np.repeat(np.arange(len(n)), n)
    inner = np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)
    window = found.rows[:-1][owner] + inner
    hashes = text.range_hashes(prefix, window, window + LENGTH)
    _, inverse, counts = np.unique(hashes, return_inverse=True, return_counts=True)
    several = counts[inverse] > 1
    out = least[owner].copy()
    # Passages: stretches of a context's windows that other contexts have as well.
    new = several & np.concatenate([[True], ~several[:-1] | (owner[1:] != owner[:-1])])
    ends = several & np.concatenate([~several[1:] | (owner[1:] != owner[:-1]), [True]])
    begin, last = np.flatnonzero(new), np.flatnonzero(ends)
    own = text.range_hashes(prefix, window[begin], window[last] + LENGTH)
    _, one, passage = np.unique(own, return_index=True, return_inverse=True)
    smallest = np.full(len(one), repeats.LAST)
    np.minimum.at(smallest, passage, least[owner[begin]])
    automaton = Automaton()
    raw = content.tobytes()
    earlier: dict[int, np.ndarray] = {}
    order = np.argsort(smallest, kind="stable")
    groups = np.split(order, np.flatnonzero(np.diff(smallest[order])) + 1) if len(order) else []
    for group in groups:
        sequences = []
        for p in group.tolist():
            w0, w1 = window[begin[one[p]]], window[last[one[p]]] + LENGTH - 1
            sequence = raw[found.start[w0] : found.end[w1]].split()
            sequences.append(sequence)
            earlier[p] = np.array(automaton.matched(sequence)[LENGTH - 1 :]) >= LENGTH
        for sequence in sequences:
            automaton.add(sequence)
    for b, e, p in zip(begin.tolist(), last.tolist(), passage.tolist(), strict=True):
        out[b : e + 1] = np.where(earlier[p], repeats.EARLIER, smallest[p])
    return out


def _finish(units: repeats.Units, cover: np.ndarray) -> dict[str, pa.Array]:
    rows = units.rows
    raw = units.data.tobytes()
    removed = np.concatenate([[0], np.cumsum(cover)])
    kept = []
    start, end = units.start, units.end
    for a, b in zip(rows[:-1].tolist(), rows[1:].tolist(), strict=True):
        if removed[b] == removed[a]:
            kept.append(b" ".join(raw[start[a] : end[b - 1]].split()) if b > a else b"")
            continue
        begin, after = text.runs(~cover[a:b])
        parts = [b" ".join(raw[start[a + x] : end[a + y - 1]].split()) for x, y in zip(begin.tolist(), after.tolist(), strict=True)]
        kept.append(b" ".join(parts))
    return {
        "n_words": pa.array(np.diff(rows), pa.int64()),
        "n_removed": pa.array(np.diff(removed[rows]), pa.int64()),
        "kept": pa.array(kept, pa.binary()).cast(pa.string()),
    }


def deduplicate(docs: DataFrame, columns: tuple[str, ...] = ("doc_id",), id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``columns`` with n_words, n_removed and the kept words joined by one space, per document.

    Every word covered by a 50-word window that also starts in a document of smaller id goes.
    Nulls, short texts, repeated rows and ties: see :mod:`repeats`.
    """
    made = "n_words bigint, n_removed bigint, kept string"
    return repeats.find(docs, SPEC, first_ids, _finish, made, columns, id_column, text_column)
