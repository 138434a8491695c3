"""Language-model scoring with n-gram counts in a log-frequency Bloom filter.

Training counts every word and word pair of the learning documents; an end mark
closes each document and also stands before the next one's first word. A count c
is kept as its level, the number of thresholds 1, 2, 3, 4, 6, 8, ... (steps of 1.5)
that it reaches, and a word or pair of level q is put into the filter as the q
entries (key, 1) to (key, q). A lookup probes level 1, 2, ... until one is absent;
the last one present stands for the mean count of its range. Then, with c~ for such
counts, P1(w) = (c~(w) + 0.1) / (N + 0.1 (V + 1)) and
P(w | v) = (c~(vw) + mu P1(w)) / (c~(v) + mu), c~(vw) being at most c~(v).

The filter grows with the corpus and holds every word and pair. It is cut into segments
of equal size, each for a range of keys: one per shard, and more where a shard has more
entries (the sum of its levels) than one has room for: at ENTRY_BITS bits per entry an
absent one seems present once in 200 times. Segments are broadcast in blocks of at
most ``bits`` bits. A task holds one block at a time: it looks up the keys of a stretch
of its rows in block after block and then scores them. With one block, that stays loaded.

The base score needs exact counts of words, which have no size bound. The most
frequent words (at most ``heavy``) are broadcast with their counts; all other words
of a document are joined with the count table by key, where no key is frequent.

Null is an empty text; an empty text has one token, its end. Repeated rows are
scored, and learned from, as often as they occur. No documents give no rows; where
none teaches, every word is unknown and N is 0. Words are told apart by 64-bit
hashes. Only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import keys as k
from . import store, text

#: Bits of the filter that a task holds at a time, and that are broadcast at a time.
FILTER_BITS = 1 << 28
HEAVY = 1 << 20
PROBES = 5
#: Bits of the filter per entry at least. The fewer, the more unseen pairs seem seen, and the higher the scores.
ENTRY_BITS = 12
SMOOTHING = 100.0
#: Leading bytes of a pair's key that are counted and stored.
PAIR_BYTES = 7
#: Words gathered by a task before it sends its counts on.
GATHERED = 4_000_000
#: Words and pairs, each, that a task looks up at a time if the filter has several blocks.
STRETCH = 300_000
_STEP = 1.5
_LEVELS = 80
_LOWEST = np.ceil(_STEP ** np.arange(_LEVELS + 1))
#: Mean count of each level; level 0 is absence.
_MEAN = np.concatenate([[0.0], (_LOWEST[:-1] + _LOWEST[1:] - 1) / 2])
END = np.uint64(text.hash_word(b"\x00end of text"))
_PAIR = np.uint64(0xD6E8FEB86659FD93)


def levels(counts: np.ndarray) -> np.ndarray:
    return np.searchsorted(_LOWEST[:-1], counts, "right").astype(np.int8)


def _sequence(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words of a slice with an end mark before each row and after the last; and the row of each step."""
    found = text.words(data, offsets, text.LOWER_TOKENS)
    n = len(found.rows) - 1
    out = np.full(len(found.hashes) + n + 1, END, np.uint64)
    lengths = np.diff(found.rows) + 1
    marks = found.rows + np.arange(n + 1)
    words = np.ones(len(out), bool)
    words[marks] = False
    out[words] = found.hashes
    return out, np.repeat(np.arange(n), lengths)


def _pairs(sequence: np.ndarray) -> np.ndarray:
    """Keys of adjacent words, cut to the bytes that are kept."""
    made = text.mixed(sequence[:-1] * _PAIR + sequence[1:])
    drop = np.uint64(8 * (8 - PAIR_BYTES))
    return (made >> drop) << drop


class Filter:
    """Bits of all segments, one after the other."""

    def __init__(self, bits: np.ndarray, shards: int):
        self.bits, self.shards = bits, shards
        self.segment = len(bits) * 8 // shards

    @staticmethod
    def places(keys: np.ndarray, level: int | np.ndarray, size: int) -> Iterator[np.ndarray]:
        """Bit numbers within a segment of ``size`` bits."""
        made = text.mixed(keys ^ (np.asarray(level, np.uint64) * np.uint64(0xA0761D6478BD642F)))
        first, step = made >> np.uint64(32), (made & np.uint64(0xFFFFFFFF)) | np.uint64(1)
        for i in range(PROBES):
            yield (first + np.uint64(i) * step) % np.uint64(size)

    def counts(self, keys: np.ndarray, segments: np.ndarray | None = None) -> np.ndarray:
        """Mean count of the highest level found present without a gap from level 1; ``segments`` are those of the keys."""
        found = np.zeros(len(keys), np.int64)
        alive = np.arange(len(keys))
        base = (k.shard_of(keys, self.shards) if segments is None else segments.astype(np.uint64)) * np.uint64(self.segment)
        for level in range(1, _LEVELS):
            present = np.ones(len(alive), bool)
            for place in self.places(keys[alive], level, self.segment):
                at = base[alive] + place
                bit = (self.bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1
                present &= bit.astype(bool)
            alive = alive[present]
            if not len(alive):
                break
            found[alive] = level
        return _MEAN[found]


COUNTS = "shard int, pairs boolean, keys binary, counts binary"


def _count(docs: DataFrame, learn: Column, text_column: str, shards: int) -> DataFrame:
    """(shard, pairs, keys, counts): every task's words and pairs with their training counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gathered: dict[bool, list] = {False: [], True: []}
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            for pairs, parts in gathered.items():
                if not parts:
                    continue
                keys, counts = k.summed(np.concatenate([x for x, _ in parts]), np.concatenate([n for _, n in parts]))
                at = k.shard_bounds(keys, shards)
                filled = np.flatnonzero(np.diff(at))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(filled, pa.int32()), pa.array([pairs] * len(filled)),
                        pa.array([k.pack(keys[at[s] : at[s + 1]], PAIR_BYTES if pairs else 8) for s in filled], pa.binary()),
                        pa.array([counts[at[s] : at[s + 1]].astype(np.uint32).tobytes() for s in filled], pa.binary()),
                    ],
                    names=["shard", "pairs", "keys", "counts"],
                )
                parts.clear()

        for batch in batches:
            learned = batch.column(1).to_numpy(zero_copy_only=False).astype(bool)
            for first, last, data, offsets in text.slices(batch.column(0)):
                sequence, row = _sequence(data, offsets)
                own = learned[first:last][row]
                for pairs, found in ((False, sequence[1:]), (True, _pairs(sequence))):
                    gathered[pairs].append(np.unique(found[own], return_counts=True))
                size += int(own.sum())
                if size >= GATHERED:
                    yield from flush()
                    size = 0
        yield from flush()

    chosen = docs.select(F.col(text_column).alias("text"), F.coalesce(learn, F.lit(False)).alias("learn"))
    return chosen.mapInArrow(run, COUNTS)


def _segment_bits(bits: int, shards: int) -> int:
    return max(64, bits // shards // 8 * 8)


def _lowest_key(shard: int, shards: int) -> int:
    return -(-(shard << 32) // shards) << 32


def _cut(both: tuple[tuple[np.ndarray, np.ndarray], ...], room: float, lowest: int) -> np.ndarray:
    """First keys of as many segments as the entries of (sorted keys, levels) need, with about equally many entries each."""
    starts = np.array([lowest], np.uint64)
    total = sum(int(own_levels.sum(dtype=np.int64)) for _, own_levels in both)
    parts = int(np.ceil(total / room))
    if parts > 1:
        keys, own_levels = (np.concatenate(x) for x in zip(*both, strict=True))
        order = np.argsort(keys)
        before = np.cumsum(own_levels[order], dtype=np.int64) - own_levels[order]
        at = np.searchsorted(before, np.arange(1, parts) * total / parts)
        starts = np.unique(np.concatenate([starts, keys[order][at[at < len(keys)]]]))
    return starts


def _shard_model(shards: int, bits: int, heavy: int):
    size = _segment_bits(bits, shards)

    def run(table: pa.Table) -> pa.Table:
        merged = {}
        for pairs in (False, True):
            part = table.filter(pa.compute.equal(table.column("pairs"), pairs))
            found = [k.unpack(x.as_py(), PAIR_BYTES if pairs else 8) for x in part.column("keys")]
            counts = [np.frombuffer(x.as_py(), np.uint32).astype(np.int64) for x in part.column("counts")]
            empty = np.zeros(0, np.uint64), np.zeros(0, np.int64)
            merged[pairs] = k.summed(np.concatenate(found), np.concatenate(counts)) if found else empty
        (words, word_counts), (pair_keys, pair_counts) = merged[False], merged[True]
        word_levels, pair_levels = levels(word_counts), levels(pair_counts)
        both = (words, word_levels), (pair_keys, pair_levels)
        shard = table.column("shard")[0].as_py()
        starts = _cut(both, size / ENTRY_BITS, _lowest_key(shard, shards))
        segments = []
        for i in range(len(starts)):
            segment = np.zeros(size, np.uint8)
            for own, own_levels in both:
                # Keys are sorted, so a segment's are one range.
                at = [*np.searchsorted(own, starts), len(own)]
                own, own_levels = own[at[i] : at[i + 1]], own_levels[at[i] : at[i + 1]]
                for level in range(1, int(own_levels.max(initial=0)) + 1):
                    for place in Filter.places(own[own_levels >= level], level, size):
                        segment[place] = 1
            segments.append(np.packbits(segment, bitorder="little").tobytes())
        frequent = np.zeros(len(words), bool)
        frequent[np.argsort(-word_counts, kind="stable")[: heavy // shards]] = True
        columns = {
            "shard": pa.array([shard], pa.int32()),
            "starts": pa.array([starts.tobytes()], pa.binary()),
            "segments": pa.array([b"".join(segments)], pa.binary()),
            "heavy_keys": pa.array([words[frequent].tobytes()], pa.binary()),
            "heavy_counts": pa.array([word_counts[frequent].tobytes()], pa.binary()),
            "rare_keys": pa.array([words[~frequent].view(np.int64)], pa.list_(pa.int64())),
            "rare_counts": pa.array([word_counts[~frequent]], pa.list_(pa.int64())),
            "n_words": pa.array([len(words)], pa.int64()),
            "total": pa.array([int(word_counts.sum())], pa.int64()),
        }
        return pa.table(columns)

    return run


MODEL = (
    "shard int, starts binary, segments binary, heavy_keys binary, heavy_counts binary,"
    " rare_keys array<bigint>, rare_counts array<bigint>, n_words bigint, total bigint"
)


class Model:
    """The broadcast part: frequent words with exact counts, totals, and where the filter's segments begin.

    The driver's copy also has the broadcasts of the segments, ``shards`` in a block.
    """

    def __init__(self, made: DataFrame, shards: int, bits: int):
        rows = made.drop("rare_keys", "rare_counts", "segments").collect()
        found = {r["shard"]: np.frombuffer(r["starts"], np.uint64) for r in rows}
        # A shard without rows has one empty segment.
        starts = [found.get(x, np.array([_lowest_key(x, shards)], np.uint64)) for x in range(shards)]
        self.shards, self.starts = shards, np.concatenate(starts)
        first = np.concatenate([[0], np.cumsum([len(x) for x in starts])])
        self.blocks = [
            _block(made, first, at, min(at + shards, len(self.starts)), _segment_bits(bits, shards) // 8)
            for at in range(0, len(self.starts), shards)
        ]
        heavy = np.concatenate([np.zeros(0, np.uint64), *(np.frombuffer(r["heavy_keys"], np.uint64) for r in rows)])
        counts = np.concatenate([np.zeros(0, np.int64), *(np.frombuffer(r["heavy_counts"], np.int64) for r in rows)])
        order = np.argsort(heavy)
        self.heavy, self.heavy_counts = heavy[order], counts[order]
        self.total = sum(r["total"] for r in rows)
        self.n_words = sum(r["n_words"] for r in rows)

    @property
    def denominator(self) -> float:
        return self.total + 0.1 * (self.n_words + 1)

    def __getstate__(self) -> dict:
        return {name: x for name, x in self.__dict__.items() if name != "blocks"}

    def log_probabilities(self, sequence: np.ndarray, lookup: Lookup) -> np.ndarray:
        """log10 P of each word given the one before, from the filter alone."""
        distinct, at = np.unique(sequence, return_inverse=True)
        pairs, pair_at = np.unique(_pairs(sequence), return_inverse=True)
        single, both = lookup.counts(distinct, pairs)
        both = both[pair_at]
        before, own = single[at[:-1]], (single[at[1:]] + 0.1) / self.denominator
        return np.log10((np.minimum(both, before) + SMOOTHING * own) / (before + SMOOTHING))


def _block(made: DataFrame, first: np.ndarray, begin: int, end: int, size: int) -> Broadcast:
    """Segments ``begin`` to below ``end`` of ``size`` bytes; ``first`` has the number of each shard's first segment."""
    low, high = (int(x) for x in np.searchsorted(first, [begin, end - 1], "right") - 1)
    # Of the first and the last shard, only the segments wanted.
    skip = F.when(F.col("shard") == low, int(begin - first[low]) * size).otherwise(0)
    last = F.when(F.col("shard") == high, int(end - first[high]) * size).otherwise(F.octet_length("segments"))
    wanted = F.substring("segments", skip + 1, last - skip)
    joined = np.zeros((end - begin) * size, np.uint8)
    for row in made.where(F.col("shard").between(low, high)).select("shard", wanted.alias("segments")).collect():
        at = max(0, int(first[row["shard"]] - begin)) * size
        joined[at : at + len(row["segments"])] = np.frombuffer(row["segments"], np.uint8)
    return made.sparkSession.sparkContext.broadcast(joined)


class Lookup:
    """Counts from the blocks of a filter, of which one is held at a time."""

    def __init__(self, model: Model, blocks: list[Broadcast]):
        self.model, self.blocks = model, blocks
        self.held, self.filter = -1, None

    def _load(self, block: int) -> Filter:
        if block != self.held:
            self.filter = None
            shared = self.blocks[block]
            segments = min(self.model.shards, len(self.model.starts) - block * self.model.shards)
            # Its value would stay with the worker. With encryption there is no file.
            again = len(self.blocks) > 1 and getattr(shared, "_path", None)
            self.held, self.filter = block, Filter(shared.load_from_path(shared._path) if again else shared.value, segments)
        return self.filter

    def counts(self, words: np.ndarray, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if len(self.blocks) == 1:
            # Each shard has one segment.
            return self._load(0).counts(words), self._load(0).counts(pairs)
        keys = np.concatenate([words, pairs])
        segments = np.searchsorted(self.model.starts, keys, "right") - 1
        found = np.zeros(len(keys))
        blocks = segments // self.model.shards
        # The block at hand comes first.
        for block in sorted(np.unique(blocks).tolist(), key=lambda x: x != self.held):
            own = np.flatnonzero(blocks == block)
            found[own] = self._load(block).counts(keys[own], segments[own] - block * self.model.shards)
        return found[: len(words)], found[len(words) :]


def _joined(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """Batches of about ``size`` bytes at least, but for the last."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(x.nbytes for x in held) >= size:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held = []
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def _stretches(column: pa.Array, words: int) -> Iterator[list[tuple[int, np.ndarray, np.ndarray]]]:
    """Successive slices of a column as (rows, words, row of each step), as many as have ``words`` words together."""
    held, size = [], 0
    for first, last, data, offsets in text.slices(column):
        sequence, row = _sequence(data, offsets)
        held.append((last - first, sequence, row))
        size += len(sequence)
        if size >= words:
            yield held
            held, size = [], 0
    if held:
        yield held


def learn(
    docs: DataFrame, where: Column, text_column: str = "text", bits: int = FILTER_BITS, heavy: int = HEAVY
) -> tuple[Model, DataFrame]:
    """The broadcast model and the exact counts (key, c) of all words that it does not list."""
    store.ship(docs.sparkSession)
    shards = store.partitions(docs.sparkSession)
    shards = max(1, min(shards, bits // 64, heavy))
    counted = _count(docs, where, text_column, shards)
    made = store.written(counted.groupBy("shard").applyInArrow(_shard_model(shards, bits, heavy), MODEL), "lm")
    rare = made.select(F.explode(F.arrays_zip("rare_keys", "rare_counts")).alias("x"))
    return Model(made, shards, bits), rare.select(F.col("x.rare_keys").alias("key"), F.col("x.rare_counts").alias("c"))


def score(
    docs: DataFrame, model: Model, rare: DataFrame, text_column: str = "text", columns: tuple[str, ...] = ("doc_id",)
) -> DataFrame:
    """``columns`` with n_tokens, n_known, train_tokens, base_score and score of every document."""
    shared, blocks = docs.sparkSession.sparkContext.broadcast(model), model.blocks
    # With one block each slice is a stretch.
    stretch = STRETCH if len(blocks) > 1 else 0
    kinds = docs.select(*columns).dtypes
    fields = ", ".join(f"`{name}` {kind}" for name, kind in kinds)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        lookup = Lookup(own, blocks)
        part, number = TaskContext.get().partitionId(), 0
        known_log = np.log10((own.heavy_counts + 0.1) / own.denominator)
        for batch in _joined(batches, 8 * stretch) if stretch else batches:
            out: dict[str, list] = {name: [] for name in ("id", "n", "known", "base", "score", "keys", "times")}
            for slices in _stretches(batch.column(0), stretch):
                logs, done = own.log_probabilities(np.concatenate([x for _, x, _ in slices]), lookup), 0
                for n, sequence, row in slices:
                    # The step from one slice's last mark to the next one's first is left out.
                    out["score"].append(np.bincount(row, logs[done : done + len(row)], n))
                    done += len(sequence)
                    distinct, inverse = np.unique(sequence[1:], return_inverse=True)
                    listed = k.look_up(own.heavy, distinct)
                    at = listed[inverse]
                    frequent = at >= 0
                    out["n"].append(np.bincount(row, minlength=n))
                    out["known"].append(np.bincount(row[frequent], minlength=n))
                    out["base"].append(np.bincount(row[frequent], known_log[at[frequent]], n))
                    seldom = row[~frequent] * np.int64(len(distinct)) + inverse[~frequent]
                    seldom, times = np.unique(seldom, return_counts=True)
                    ends = np.searchsorted(seldom, np.arange(n + 1) * np.int64(len(distinct)))
                    sent = distinct.view(np.int64)[seldom % np.int64(max(1, len(distinct)))]
                    out["keys"] += [sent[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]
                    out["times"] += [times[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]
                    out["id"] += [f"{part}/{number + x}" for x in range(n)]
                    number += n
            arrays = [pa.array(np.concatenate(out[x]), t) for x, t in (("n", pa.int64()), ("known", pa.int64()), ("base", pa.float64()), ("score", pa.float64()))]
            lists = [pa.array(out["keys"], pa.list_(pa.int64())), pa.array(out["times"], pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i + 1) for i in range(len(columns))), pa.array(out["id"], pa.string()), *arrays, *lists],
                names=[*columns, "_row", "n_tokens", "_known", "_base", "score", "_keys", "_times"],
            )

    schema = f"{fields}, _row string, n_tokens bigint, _known bigint, _base double, score double, _keys array<bigint>, _times array<bigint>"
    made = store.written(docs.select(F.col(text_column).alias("_text"), *columns).mapInArrow(run, schema), "lm-scores")
    for used in (shared, *blocks):
        # Executors let go of their copies; a later call sends them again.
        used.unpersist()
    words = made.select("_row", F.explode(F.arrays_zip("_keys", "_times")).alias("x"))
    words = words.select("_row", F.col("x._keys").alias("key"), F.col("x._times").alias("times"))
    count = F.coalesce("c", F.lit(0))
    rest = words.join(rare, "key", "left").groupBy("_row").agg(
        F.sum(F.when(count > 0, F.col("times")).otherwise(0)).alias("_rest_known"),
        F.sum(F.col("times") * F.log10((count + 0.1) / F.lit(model.denominator))).alias("_rest"),
    )
    return made.drop("_keys", "_times").join(rest, "_row", "left").select(
        *columns, "n_tokens", (F.col("_known") + F.coalesce("_rest_known", F.lit(0))).alias("n_known"),
        F.lit(model.total).cast("bigint").alias("train_tokens"),
        (F.col("_base") + F.coalesce("_rest", F.lit(0.0))).alias("base_score"), "score",
    )
