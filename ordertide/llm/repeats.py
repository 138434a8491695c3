"""Passages that repeat across documents, found without comparing documents in pairs.

A text is a row of units, words or bytes. A window is ``length`` consecutive units; it
is a repeat in a document if it also begins in a document of smaller id. Four steps,
each by blocks of documents and shards of keys:

1. Every window is represented by its anchor, the ``gram`` units in it with the least
   hash, so equal windows have equal anchors wherever they stand. A block sends the
   distinct anchors of its documents to the shards of their hashes.
2. A shard answers with the anchors that occur more than once.
3. The windows of one such anchor overlap, and together are a context. A block sends
   its distinct contexts, as text, with the smallest id and whether others have them, to
   the anchor's shard. An anchor with more than ``hot`` occurrences is split: each of
   its windows goes alone to the shard of its own hash, so a passage that very many
   documents share gives one row per block and window, spread over all shards.
4. A shard's resolver finds, by the texts, the smallest id of each window; the block
   marks the windows of larger ids.

Work and messages are linear in the text; groups are a block's documents and a shard's
keys, and no list of all occurrences of a passage is ever made. More partitions make
both smaller.

Null is an empty text. Texts shorter than a window have no repeats. Repeated rows and
rows of equal id never count against each other, and each gives a result row. A null
id sorts after all others. No documents give no rows. Only the named columns are read.
Anchors, contexts and windows are told apart by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from . import keys as k
from . import store, text

#: Marks, beside the number of windows, a context that more than one document of the block has.
SEVERAL = 1 << 31
#: Text that a shard resolves at once.
PORTION_BYTES = 1 << 18
LAST = np.iinfo(np.int64).max
#: Smaller than any id: every document that has the window is past its first occurrence.
EARLIER = np.iinfo(np.int64).min
_HIGH, _LOW = np.uint64(0xFFFFFFFF00000000), np.uint64(0xFFFFFFFF)


@dataclass(frozen=True)
class Spec:
    """What a unit is (a rule for words, None for bytes), and the three lengths."""

    rule: text.Rule | None
    length: int
    gram: int
    hot: int = 2000


@dataclass(frozen=True)
class Contexts:
    """Context i: ``n`` windows from unit ``first``, in row ``row``; ``key`` is its anchor's hash, ``hash`` its own."""

    first: np.ndarray
    n: np.ndarray
    row: np.ndarray
    key: np.ndarray
    hash: np.ndarray


class Units:
    """Units of a slice with their prefix hashes."""

    def __init__(self, spec: Spec, data: np.ndarray, offsets: np.ndarray):
        self.spec, self.data = spec, data
        if spec.rule is None:
            self.rows, values = offsets, text.byte_values(data)
            self.start = self.end = None
        else:
            found = text.words(data, offsets, spec.rule)
            self.rows, values, self.start, self.end = found.rows, found.hashes, found.start, found.end
        self.prefix = text.prefix_hashes(values)

    def byte_range(self, first: np.ndarray, after: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of the units from ``first`` to before ``after``; ranges hold a unit at least."""
        return (first, after) if self.start is None else (self.start[first], self.end[after - 1])

    def window_hashes(self, first: np.ndarray) -> np.ndarray:
        return text.range_hashes(self.prefix, first, first + self.spec.length)

    def contexts(self) -> Contexts:
        length, gram = self.spec.length, self.spec.gram
        windows = text.row_windows(self.rows, length)
        if not len(windows):
            none = np.zeros(0, np.int64)
            return Contexts(none, none, none, none.astype(np.uint64), none.astype(np.uint64))
        grams = text.window_hashes(self.prefix, gram)
        marked = (grams & _HIGH) | np.arange(len(grams), dtype=np.uint64)
        anchor = (text.sliding_min(marked, length - gram + 1)[windows] & _LOW).astype(np.int64)
        begins = np.flatnonzero(np.concatenate([[True], anchor[1:] != anchor[:-1]]))
        n = np.diff(np.append(begins, len(anchor)))
        first = windows[begins]
        row = np.searchsorted(self.rows, first, "right") - 1
        own = text.range_hashes(self.prefix, first, first + n - 1 + length)
        # Least hashes crowd at the low end of their range; mixed again, they spread evenly over the shards.
        return Contexts(first, n, row, text.mixed(grams[anchor[begins]]), own)


def _ids(table: pa.Table) -> np.ndarray:
    return pa.compute.fill_null(table.column("_id"), LAST).combine_chunks().to_numpy(zero_copy_only=False)


def _bytes(values) -> pa.Array:
    return pa.array(values, pa.binary())


def _joined(table: pa.Table, column: str, kind) -> list[np.ndarray]:
    return [np.frombuffer(x.as_py(), kind) for x in table.column(column)]


def _concat(parts: list[np.ndarray], kind) -> np.ndarray:
    return np.concatenate(parts) if parts else np.zeros(0, kind)


def _anchors(spec: Spec, shards: int):
    """Step 1: a block's distinct anchors and how often each one occurs there."""

    def run(table: pa.Table) -> pa.Table:
        found = []
        for _, _, data, offsets in text.slices(table.column("_text")):
            own = Units(spec, data, offsets).contexts()
            found.append(own.key)
        keys, counts = np.unique(_concat(found, np.uint64), return_counts=True)
        at = k.shard_bounds(keys, shards)
        filled = np.flatnonzero(np.diff(at))
        return pa.table(
            {
                "block": pa.array([table.column("_block")[0].as_py()] * len(filled), pa.int32()),
                "shard": pa.array(filled, pa.int32()),
                "keys": _bytes([k.pack(keys[at[s] : at[s + 1]]) for s in filled]),
                "counts": _bytes([np.minimum(counts[at[s] : at[s + 1]], 0xFFFF).astype(np.uint16).tobytes() for s in filled]),
            }
        )

    return run, "block int, shard int, keys binary, counts binary"


def _shared(spec: Spec):
    """Step 2: for every block, those of its anchors that occur more than once, and which are hot."""

    def run(table: pa.Table) -> pa.Table:
        keys = [k.unpack(x.as_py()) for x in table.column("keys")]
        ends = np.cumsum([0, *map(len, keys)])
        distinct, inverse = np.unique(_concat(keys, np.uint64), return_inverse=True)
        total = np.bincount(inverse, _concat(_joined(table, "counts", np.uint16), np.uint16), len(distinct))
        out: list[list] = [[], [], []]
        for i, block in enumerate(table.column("block").to_pylist()):
            own = total[inverse[ends[i] : ends[i + 1]]]
            if (own > 1).any():
                for column, value in zip(out, (block, k.pack(keys[i][own > 1]), (own[own > 1] > spec.hot).tobytes()), strict=True):
                    column.append(value)
        return pa.table({"block": pa.array(out[0], pa.int32()), "keys": _bytes(out[1]), "hot": _bytes(out[2])})

    return run, "block int, keys binary, hot binary"


def _gather(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The bytes of the ranges, one after the other."""
    size = end - begin
    shift = np.repeat(begin - np.concatenate([[0], np.cumsum(size)[:-1]]), size) if len(size) else begin
    return data[shift + np.arange(int(size.sum()))]


def _contexts(spec: Spec, shards: int):
    """Step 3: a block's distinct contexts of shared anchors, with their text."""

    def run(table: pa.Table, shared: pa.Table) -> pa.Table:
        names = ("shard", "block", "to", "anchor", "least", "n", "size", "text")
        schema = [pa.int32(), pa.int32(), *[pa.binary()] * 6]
        if not table.num_rows or not shared.num_rows:
            return pa.table([pa.array([], t) for t in schema], names=names)
        keys = np.concatenate([k.unpack(x.as_py()) for x in shared.column("keys")])
        order = np.argsort(keys)
        keys, hot = keys[order], np.concatenate(_joined(shared, "hot", bool))[order]
        ids = _ids(table)
        column = table.column("_text").combine_chunks()
        raw, row_at = text.utf8(column)
        parts: list[tuple] = []
        for first_row, _, data, offsets in text.slices(column):
            units = Units(spec, data, offsets)
            own = units.contexts()
            at = k.look_up(keys, own.key)
            kept = np.flatnonzero(at >= 0)
            split = hot[at[kept]] if len(kept) else np.zeros(0, bool)
            whole, cut = kept[~split], kept[split]
            copies = own.n[cut]
            inner = np.arange(int(copies.sum())) - np.repeat(np.cumsum(copies) - copies, copies)
            first = np.concatenate([own.first[whole], np.repeat(own.first[cut], copies) + inner])
            n = np.concatenate([own.n[whole], np.ones(len(inner), np.int64)])
            single = np.repeat(own.first[cut], copies) + inner
            single_hash = units.window_hashes(single)
            own_hash = np.concatenate([own.hash[whole], single_hash])
            to = np.concatenate([own.key[whole], single_hash])
            anchor = np.concatenate([np.zeros(len(whole), np.uint64), np.repeat(own.key[cut], copies)])
            id_ = ids[first_row + np.concatenate([own.row[whole], np.repeat(own.row[cut], copies)])]
            if not len(first):
                continue
            distinct, one, inverse = np.unique(own_hash, return_index=True, return_inverse=True)
            least = np.full(len(distinct), LAST)
            np.minimum.at(least, inverse, id_)
            most = np.full(len(distinct), EARLIER)
            np.maximum.at(most, inverse, id_)
            begin, end = units.byte_range(first[one], first[one] + n[one] - 1 + spec.length)
            parts.append((distinct, least, most, n[one], to[one], anchor[one], row_at[first_row] + begin, end - begin))
        if not parts:
            return pa.table([pa.array([], t) for t in schema], names=names)
        own_hash, least, most, n, to, anchor, begin, size = (np.concatenate(x) for x in zip(*parts, strict=True))
        del parts
        distinct, one, inverse = np.unique(own_hash, return_index=True, return_inverse=True)
        low = np.full(len(distinct), LAST)
        np.minimum.at(low, inverse, least)
        high = np.full(len(distinct), EARLIER)
        np.maximum.at(high, inverse, most)
        del inverse, own_hash, least, most
        shard = k.shard_of(to[one], shards).astype(np.int64)
        order = np.argsort(shard, kind="stable")
        at = np.searchsorted(shard[order], np.arange(shards + 1))
        block = table.column("_block")[0].as_py()
        rows = []
        for s in np.flatnonzero(np.diff(at)):
            chosen = order[at[s] : at[s + 1]]
            source = one[chosen]
            # A context's text stays where it is in the block until its shard's message is made.
            content = _gather(raw, begin[source], begin[source] + size[source])
            rows.append(
                (
                    int(s), block, (to[source] & np.uint64(0xFFFF)).astype(np.uint16).tobytes(), anchor[source].tobytes(),
                    low[chosen].tobytes(), (n[source] | np.where(high[chosen] > low[chosen], SEVERAL, 0)).astype(np.uint32).tobytes(),
                    size[source].astype(np.uint32).tobytes(), pa.compress(content.tobytes(), codec="zstd", asbytes=True),
                )
            )
        text.release()
        return pa.table([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), schema, strict=True)], names=names)

    return run, "shard int, block int, to binary, anchor binary, least binary, n binary, size binary, text binary"


#: Given distinct contexts (their text with offsets, windows, smallest ids), the smallest id of each
#: context's windows, one after the other. EARLIER may stand for any id below the context's own smallest.
Resolver = Callable[[np.ndarray, np.ndarray, np.ndarray, np.ndarray], np.ndarray]


def _portions(to: np.ndarray, size: np.ndarray) -> list[np.ndarray]:
    """Contexts in portions of bounded text; those sent by the same hash stay together, as others share no window."""
    order = np.argsort(to, kind="stable")
    ends = np.cumsum(size[order])
    last = np.concatenate([to[order][1:] != to[order][:-1], [True]])
    cuts, taken = [], 0
    for at in np.flatnonzero(last):
        if ends[at] - taken >= PORTION_BYTES:
            cuts.append(at + 1)
            taken = ends[at]
    return [x for x in np.split(order, cuts) if len(x)]


def _context_hashes(spec: Spec, raw: np.ndarray, size: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The hashes that the contexts of these texts, one after the other, have in their blocks."""
    ends = np.cumsum(size)
    out, at = [np.zeros(0, np.uint64)], 0
    while at < len(size):
        after = max(at + 1, int(np.searchsorted(ends, ends[at] + text.SLICE_BYTES)))
        begin = ends[at] - size[at]
        units = Units(spec, raw[begin : ends[after - 1]], np.concatenate([[0], ends[at:after] - begin]))
        first = units.rows[:-1]
        out.append(text.range_hashes(units.prefix, first, first + n[at:after] - 1 + spec.length))
        at = after
    return np.concatenate(out)


def _resolved(spec: Spec, resolver: Resolver):
    """Step 4, in a shard: which windows of which context are repeats past which id."""

    def run(table: pa.Table) -> pa.Table:
        least, anchor = np.concatenate(_joined(table, "least", np.int64)), np.concatenate(_joined(table, "anchor", np.uint64))
        sizes = _joined(table, "size", np.uint32)
        counts = np.array([len(x) for x in sizes])
        size = np.concatenate(sizes).astype(np.int64)
        n = np.concatenate(_joined(table, "n", np.uint32)).astype(np.int64)
        several, n = n & SEVERAL > 0, n & ~SEVERAL
        ends = np.cumsum(size)
        raw, filled = np.empty(int(ends[-1]), np.uint8), 0
        for packed, own in zip(table.column("text"), sizes, strict=True):
            unpacked = pa.decompress(packed.as_py(), int(own.sum()), codec="zstd", asbytes=True)
            raw[filled : filled + len(unpacked)] = np.frombuffer(unpacked, np.uint8)
            filled += len(unpacked)
        distinct, one, inverse = np.unique(_context_hashes(spec, raw, size, n), return_index=True, return_inverse=True)
        low = np.full(len(distinct), LAST)
        np.minimum.at(low, inverse, least)
        found = []
        for part in _portions(np.concatenate(_joined(table, "to", np.uint16))[one], size[one]):
            chosen = one[part]
            content = _gather(raw, ends[chosen] - size[chosen], ends[chosen])
            offsets = np.concatenate([[0], np.cumsum(size[chosen])])
            first_id = resolver(content, offsets, n[chosen], low[part])
            # Runs of windows of a context with the same first id.
            owner = np.repeat(np.arange(len(part)), n[chosen])
            begins = np.flatnonzero(np.concatenate([[True], (owner[1:] != owner[:-1]) | (first_id[1:] != first_id[:-1])]))
            shift = (np.cumsum(n[chosen]) - n[chosen])[owner[begins]]
            found.append((part[owner[begins]], begins - shift, np.append(begins[1:], len(owner)) - shift, first_id[begins]))
        run_owner, run_first, run_end, run_id = (np.concatenate(x) for x in zip(*found, strict=True))
        order = np.argsort(run_owner, kind="stable")
        run_owner, run_first, run_end, run_id = (x[order] for x in (run_owner, run_first, run_end, run_id))
        runs_at = np.searchsorted(run_owner, np.arange(len(distinct) + 1))
        entries = np.cumsum(counts)
        out: list[list] = [[], [], [], [], [], []]
        for i, block in enumerate(table.column("block").to_pylist()):
            part = slice(entries[i] - counts[i], entries[i])
            own = inverse[part]
            per = runs_at[own + 1] - runs_at[own]
            run = np.repeat(runs_at[own], per) + np.arange(int(per.sum())) - np.repeat(np.cumsum(per) - per, per)
            told = (run_id[run] < np.repeat(least[part], per)) | np.repeat(several[part], per)
            if told.any():
                run = run[told]
                split = np.repeat(anchor[part], per)[told]
                values = (block, distinct[run_owner[run]], split, run_first[run].astype(np.uint32), run_end[run].astype(np.uint32), run_id[run])
                for column, value in zip(out, values, strict=True):
                    column.append(value if isinstance(value, int) else value.tobytes())
        text.release()
        return pa.table({"block": pa.array(out[0], pa.int32())} | {x: _bytes(v) for x, v in zip(("hash", "anchor", "first", "end", "id"), out[1:], strict=True)})

    return run, "block int, hash binary, anchor binary, first binary, end binary, id binary"


#: Makes the result columns of a slice from its units and which of them are repeats.
Finish = Callable[[Units, np.ndarray], dict[str, pa.Array]]


def _marked(spec: Spec, columns: tuple[str, ...], finish: Finish, schema: pa.Schema):
    """Step 4, in a block: units covered by windows that are repeats in their document."""

    def run(table: pa.Table, told: pa.Table) -> pa.Table:
        if not table.num_rows:
            return schema.empty_table()
        hashes = _concat(_joined(told, "hash", np.uint64), np.uint64)
        order = np.argsort(hashes, kind="stable")
        hashes = hashes[order]
        first, end = (_concat(_joined(told, x, np.uint32), np.uint32).astype(np.int64)[order] for x in ("first", "end"))
        past = _concat(_joined(told, "id", np.int64), np.int64)[order]
        hot = np.unique(_concat(_joined(told, "anchor", np.uint64), np.uint64))
        hot = hot[hot != 0]
        ids = _ids(table)
        made = []
        for first_row, last_row, data, offsets in text.slices(table.column("_text")):
            units = Units(spec, data, offsets)
            cover = np.zeros(int(units.rows[-1]), bool)
            if len(hashes):
                own = units.contexts()
                cut = np.flatnonzero(k.look_up(hot, own.key) >= 0)
                copies = own.n[cut]
                inner = np.arange(int(copies.sum())) - np.repeat(np.cumsum(copies) - copies, copies)
                single = np.repeat(own.first[cut], copies) + inner
                begin = np.concatenate([own.first, single])
                row = np.concatenate([own.row, np.repeat(own.row[cut], copies)])
                own_hash = np.concatenate([own.hash, units.window_hashes(single)])
                low, high = np.searchsorted(hashes, own_hash, "left"), np.searchsorted(hashes, own_hash, "right")
                per = high - low
                at = np.repeat(low, per) + np.arange(int(per.sum())) - np.repeat(np.cumsum(per) - per, per)
                repeat = past[at] < np.repeat(ids[first_row + row], per)
                begin, at = np.repeat(begin, per)[repeat], at[repeat]
                cover = text.covered(len(cover), begin + first[at], begin + end[at] - 1 + spec.length)
            kept = {name: table.column(name).slice(first_row, last_row - first_row).combine_chunks() for name in columns}
            made.append(pa.table(kept | finish(units, cover)))
        text.release()
        return pa.concat_tables(made).cast(schema)

    return run


def find(
    docs: DataFrame,
    spec: Spec,
    resolver: Resolver,
    finish: Finish,
    made: str,
    columns: tuple[str, ...] = ("doc_id",),
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """``columns`` of every document and what ``finish`` makes of its repeats (``made`` is that schema)."""
    store.ship(docs.sparkSession)
    parts = store.partitions(docs.sparkSession)
    id_ = F.col(id_column).cast("bigint")
    # Two blocks a partition: a task holds one block's texts at a time.
    block = F.pmod(F.xxhash64(id_), F.lit(2 * parts)).cast("int").alias("_block")
    blocks = docs.select(*columns, id_.alias("_id"), F.col(text_column).alias("_text"), block)
    fields = ", ".join(f"`{name}` {kind}" for name, kind in docs.select(*columns).dtypes)
    full = f"{fields}, {made}" if fields else made
    arrow = to_arrow_schema(StructType.fromDDL(full))
    anchors, anchors_schema = _anchors(spec, parts)
    shared, shared_schema = _shared(spec)
    contexts, contexts_schema = _contexts(spec, parts)
    resolved, resolved_schema = _resolved(spec, resolver)
    keys = blocks.groupBy("_block").applyInArrow(anchors, anchors_schema).groupBy("shard").applyInArrow(shared, shared_schema)
    sent = blocks.groupBy("_block").cogroup(keys.groupBy("block")).applyInArrow(contexts, contexts_schema)
    told = sent.groupBy("shard").applyInArrow(resolved, resolved_schema)
    return blocks.groupBy("_block").cogroup(told.groupBy("block")).applyInArrow(_marked(spec, columns, finish, arrow), full)
