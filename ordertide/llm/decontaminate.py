"""Benchmark decontamination by a document-sharded positional inverted index.

Every batch of documents becomes one index shard: its distinct terms and, per
term, the sorted list of the places where it stands. A phrase is looked up in
each shard by taking the list of its rarest term there, shifting it by the
term's offset, and intersecting it with the shifted lists of the other terms,
rarest first. Shards are independent, so nothing is shuffled, a hot source or
term has no effect on other shards, and a lost task rebuilds its shard alone.
The index is written to the shared folder and searched from there; it takes about
six bytes a word.

Null or empty texts have no words. An item of fewer words than a window, but
not none, is one window. Repeated items (same id) count once by id; a null
item_id takes part in hits but not in the list of ids. Repeated documents
give repeated rows. No documents give no rows; without items nothing is hit.
Only the named columns are read. Words are told apart by 64-bit hashes.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import store, text

WINDOW = 10
#: Benchmark windows are broadcast, in blocks of at most this many items' rows.
ITEM_BLOCK = 20_000
#: Bytes of the items' words in a block, eight for each word; windows take about ten times as many.
BLOCK_BYTES = 1 << 24
SHARD_BYTES = 1 << 20

INDEX = "shard string, doc_ids array<bigint>, doc_starts binary, terms binary, lists binary, places binary"


def build_index(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Index shards: terms (sorted hashes), where each one's list begins, and all lists of places.

    A place counts words from the shard's start; ``doc_starts`` has the place of each
    document's first word. Every word of every text is posted. Write the frame to
    search it more than once.
    """

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_pylist()
            for first, last, data, offsets in text.slices(batch.column(1), SHARD_BYTES):
                own = Shard.of(data, offsets)
                packed = own.doc_starts.tobytes(), own.terms.tobytes(), own.begins.tobytes(), own.places.tobytes()
                yield pa.RecordBatch.from_arrays(
                    [pa.array([uuid.uuid4().hex]), pa.array([ids[first:last]], pa.list_(pa.int64())), *(pa.array([x], pa.binary()) for x in packed)],
                    names=["shard", "doc_ids", "doc_starts", "terms", "lists", "places"],
                )

    store.ship(docs.sparkSession)
    chosen = docs.select(F.col(id_column).cast("bigint").alias("doc_id"), F.col(text_column).alias("text"))
    return chosen.mapInArrow(shards, INDEX)


@dataclass(frozen=True)
class Shard:
    """Lists of places by term, of some documents."""

    doc_starts: np.ndarray
    terms: np.ndarray
    begins: np.ndarray
    places: np.ndarray

    @classmethod
    def of(cls, data: np.ndarray, offsets: np.ndarray) -> Shard:
        found = text.words(data, offsets, text.LOWER_WORDS)
        order = np.argsort(found.hashes, kind="stable")
        ordered = found.hashes[order]
        begins = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]])[: len(ordered)])
        return cls(found.rows.astype(np.int64), ordered[begins], np.append(begins, len(ordered)).astype(np.uint32), order.astype(np.uint32))

    @classmethod
    def read(cls, row: dict) -> Shard:
        kinds = (("doc_starts", np.int64), ("terms", np.uint64), ("lists", np.uint32), ("places", np.uint32))
        return cls(*(np.frombuffer(row[name], kind) for name, kind in kinds))

    def numbers(self, terms: np.ndarray) -> np.ndarray:
        """The shard's number of each term, or -1."""
        if not len(self.terms):
            return np.full(terms.shape, -1)
        at = np.minimum(np.searchsorted(self.terms, terms), len(self.terms) - 1)
        return np.where(self.terms[at] == terms, at, -1)

    def lengths(self, numbers: np.ndarray) -> np.ndarray:
        return np.where(numbers < 0, 0, self.begins[numbers + 1].astype(np.int64) - self.begins[numbers])

    def listed(self, number: int) -> np.ndarray:
        return self.places[self.begins[number] : self.begins[number + 1]].astype(np.int64)

    def document(self, places: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.doc_starts, places, "right") - 1


def _holds(sorted_list: np.ndarray, values: np.ndarray) -> np.ndarray:
    at = np.minimum(np.searchsorted(sorted_list, values), len(sorted_list) - 1)
    return sorted_list[at] == values


def phrase(shard: Shard, terms: np.ndarray) -> np.ndarray:
    """Places where the terms stand one after the other within one document."""
    numbers = shard.numbers(terms)
    if (numbers < 0).any():
        return np.zeros(0, np.int64)
    by_rarity = np.argsort(shard.lengths(numbers), kind="stable")
    starts = shard.listed(numbers[by_rarity[0]]) - by_rarity[0]
    for k in by_rarity[1:]:
        if not len(starts):
            return starts
        starts = starts[_holds(shard.listed(numbers[k]), starts + k)]
    starts = starts[starts >= 0]
    return starts[shard.document(starts) == shard.document(starts + len(terms) - 1)]


def proximity(shard: Shard, terms: np.ndarray, within: int) -> np.ndarray:
    """Places of the rarest term with every other term at most ``within`` words away, in its document."""
    numbers = shard.numbers(np.unique(terms))
    if (numbers < 0).any() or not len(numbers):
        return np.zeros(0, np.int64)
    by_rarity = numbers[np.argsort(shard.lengths(numbers), kind="stable")]
    places = shard.listed(by_rarity[0])
    for number in by_rarity[1:]:
        document = shard.document(places)
        low = np.maximum(places - within, shard.doc_starts[document])
        high = np.minimum(places + within, shard.doc_starts[document + 1] - 1)
        listed = shard.listed(number)
        places = places[np.searchsorted(listed, low, "left") < np.searchsorted(listed, high, "right")]
    return places


def _items(benchmark: DataFrame, item_column: str, text_column: str) -> DataFrame:
    """(item, terms): the words of each benchmark row as hashes."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, data, offsets in text.slices(batch.column(1)):
                found = text.words(data, offsets, text.LOWER_WORDS)
                lists = [found.hashes[a:b].tobytes() for a, b in zip(found.rows[:-1], found.rows[1:], strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, last - first), pa.array(lists, pa.binary())], names=["item", "terms"]
                )

    store.ship(benchmark.sparkSession)
    chosen = benchmark.select(F.col(item_column).cast("string").alias("item"), F.col(text_column).alias("text"))
    return chosen.mapInArrow(hashed, "item string, terms binary").where(F.length("terms") > 0)


class Windows:
    """Distinct windows of benchmark items, each with the ids that have it."""

    def __init__(self, items: list[tuple[str | None, bytes]], window: int):
        found: dict[bytes, set[str | None]] = {}
        for item, terms in items:
            terms = np.frombuffer(terms, np.uint64)
            for start in range(max(1, len(terms) - window + 1)):
                found.setdefault(terms[start : start + window].tobytes(), set()).add(item)
        self.terms = [np.frombuffer(x, np.uint64) for x in found]
        self.items = list(found.values())
        self.flat = np.concatenate([np.zeros(0, np.uint64), *self.terms])
        self.ends = np.cumsum([len(x) for x in self.terms])

    def hits(self, shard: Shard, within: int | None = None) -> dict[int, tuple[list, set]]:
        """By the number of the document in the shard: word spans hit, and ids of the items found."""
        found: dict[int, tuple[list, set]] = {}
        missing = np.concatenate([[0], np.cumsum(shard.numbers(self.flat) < 0)])
        begins = self.ends - [len(x) for x in self.terms]
        for w in np.flatnonzero(missing[self.ends] == missing[begins]) if self.terms else ():
            terms = self.terms[w]
            places = phrase(shard, terms) if within is None else proximity(shard, terms, within)
            size = len(terms) if within is None else 1
            for place, number in zip(places.tolist(), shard.document(places).tolist(), strict=True):
                spans, ids = found.setdefault(number, ([], set()))
                spans.append((place, place + size))
                ids.update(self.items[w])
        return found


def _blocks(items: DataFrame, window: int, item_block: int) -> Iterator[Broadcast]:
    """Broadcast windows of about ``item_block`` items and BLOCK_BYTES of their words at most, one
    block at a time; at least one. Items are dealt by words and id, so equal texts spread too."""
    size = items.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.octet_length("terms")), F.lit(0)).alias("bytes")).first()
    blocks = max(1, -(-size["n"] // item_block), -(-size["bytes"] // BLOCK_BYTES))
    if blocks > 1:
        items = store.written(items.withColumn("block", F.pmod(F.xxhash64("terms", "item"), F.lit(blocks))), "items")
    for k in range(blocks):
        part = items if blocks == 1 else items.where(F.col("block") == k)
        rows = [(r["item"], bytes(r["terms"])) for r in part.select("item", "terms").collect()]
        yield items.sparkSession.sparkContext.broadcast(Windows(rows, window))


FOUND = "doc_id bigint, n_words bigint, row string, spans array<bigint>, items array<string>"
#: Batches to batches, as a task runs them.
Step = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def _search(shared: Broadcast, within: int | None) -> Step:
    """Index shards to FOUND: word spans hit and item ids found by document; ``row`` tells documents apart."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                row = batch.slice(at, 1).to_pylist()[0]
                shard = Shard.read(row)
                hits = shared.value.hits(shard, within)
                out: list[list] = [[], [], [], [], []]
                for number, doc_id in enumerate(row["doc_ids"]):
                    spans, ids = hits.get(number, ((), ()))
                    first = int(shard.doc_starts[number])
                    n = int(shard.doc_starts[number + 1]) - first
                    flat_spans = [x - first for span in spans for x in span]
                    values = (doc_id, n, f"{row['shard']}/{number}", flat_spans, sorted(x for x in ids if x is not None))
                    for column, value in zip(out, values, strict=True):
                        column.append(value)
                kinds = (pa.int64(), pa.int64(), pa.string(), pa.list_(pa.int64()), pa.list_(pa.string()))
                names = ["doc_id", "n_words", "row", "spans", "items"]
                yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(out, kinds, strict=True)], names=names)

    return search


def _merge(spans: list[int]) -> tuple[list[int], int]:
    """Flat (first, after last) pairs as disjoint ones, and how many words they hold."""
    merged: list[int] = []
    for first, last in sorted(zip(spans[::2], spans[1::2], strict=True)):
        if merged and first <= merged[-1]:
            merged[-1] = max(merged[-1], last)
        else:
            merged += [first, last]
    return merged, sum(merged[1::2]) - sum(merged[::2])


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of FOUND to result rows, with spans made disjoint."""
    for batch in batches:
        spans = [_merge(x) for x in batch.column(3).to_pylist()]
        ids = batch.column(4).to_pylist()
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0), batch.column(1), pa.array([n for _, n in spans], pa.int64()),
                pa.array([len(x) for x in ids], pa.int64()),
                pa.array([hashlib.sha256(",".join(x).encode()).hexdigest() for x in ids], pa.string()),
                pa.array([n > 0 for _, n in spans], pa.bool_()),
                pa.array(ids, pa.list_(pa.string())), pa.array([x for x, _ in spans], pa.list_(pa.int64())),
            ],
            names=["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated", "items", "spans"],
        )


def matches(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    within: int | None = None,
    item_column: str = "item_id",
    item_block: int = ITEM_BLOCK,
) -> DataFrame:
    """Per document: n_words, n_hit, item ids found (sorted) and word spans hit.

    ``within`` asks for proximity instead of phrases: all words of a window at most so
    many words from its rarest one. A benchmark of more than ``item_block`` rows is
    searched block after block, and so is one of more bytes than a block may have.
    """
    index = store.written(build_index(docs), "postings")
    schema = (
        "doc_id bigint, n_words bigint, n_hit bigint, n_items bigint, items_sha256 string,"
        " contaminated boolean, items array<string>, spans array<bigint>"
    )
    blocks = _blocks(_items(benchmark, item_column, "text"), window, item_block)
    found, shared = [], next(blocks)
    for following in blocks:
        # Each block's hits are written before the next block is made, so one is held at a time.
        found.append(store.written(index.mapInArrow(_search(shared, within), FOUND), "hits"))
        shared.unpersist()
        shared = following
    if not found:
        # Nothing to bring together: search and merge in one Python process of a task.
        search = _search(shared, within)
        return index.mapInArrow(lambda batches: _merged(search(batches)), schema)
    found = reduce(DataFrame.unionByName, [*found, index.mapInArrow(_search(shared, within), FOUND)])
    found = found.groupBy("row").agg(
        F.first("doc_id").alias("doc_id"), F.first("n_words").alias("n_words"),
        F.flatten(F.collect_list("spans")).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
    )
    return found.select("doc_id", "n_words", "row", "spans", "items").mapInArrow(_merged, schema)


def clean(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    text_column: str = "text",
    item_column: str = "item_id",
    item_block: int = ITEM_BLOCK,
) -> DataFrame:
    """The rows of ``docs``, all columns, in whose text no window of the benchmark occurs."""
    fields = ", ".join(f"`{name}` {kind}" for name, kind in docs.dtypes)
    at = docs.columns.index(text_column)
    for shared in _blocks(_items(benchmark, item_column, "text"), window, item_block):

        def keep(batches: Iterator[pa.RecordBatch], shared: Broadcast = shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                kept = np.ones(batch.num_rows, bool)
                for first, _, data, offsets in text.slices(batch.column(at), SHARD_BYTES):
                    kept[[first + number for number in shared.value.hits(Shard.of(data, offsets))]] = False
                yield batch.filter(pa.array(kept))

        docs = docs.mapInArrow(keep, fields)
    return docs
