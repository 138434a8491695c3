"""Near-duplicate documents: MinHash bands for candidates, odd sketches and full sets to confirm them.

A document's set is its distinct shingles of five lower-cased words, or all its words
as one shingle if it has fewer. Documents of the same words are one node. Each node
has 128 MinHash values; every four of them make a band, and nodes that agree in a band
are in one bucket. An odd sketch folds the (position, value) pairs of a node's MinHash
into 512 parity bits; the bits in which two sketches differ tell in how many positions
the values differ, and pairs that differ too much to be links are left at that. All
others are confirmed on their full sets.

A bucket is not expanded into pairs. First each node is compared with the smallest one
of all its buckets; then with the smallest of each of them, where the two are still in
different components; last, members that are not in the component of their bucket's
smallest are compared with members of other components, in blocks. No other pair of a bucket
could join components. A true link at similarity 0.75 shares no band with
probability 5e-6, and fails the sketch with less than 1e-6.

Documents without words or text have an empty set and are linked with nothing. Rows of
the same id are one component. A null id gives n_shingles, a null component and is kept.
Of a component the smallest id is kept, so there are no ties. No documents give no rows.
Only the named columns are read. Shingles are told apart by 64-bit hashes, word sequences
by 128 bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import components, store, text

SHINGLE = 5
SIMILARITY = 75
VALUES = 128
BAND = 4
SKETCH_BITS = 512
#: Sketch bits in which two sets of similarity 0.5 differ on average; 5 standard deviations above 0.75.
MOST_DIFFERENT = 100
#: Nodes of a block whose bucket's smallest is in another component, and nodes they are compared with.
OPEN_BLOCK = 1000
MEMBER_BLOCK = 4000
_RNG = np.random.default_rng(8)
_XOR = _RNG.integers(0, 1 << 32, VALUES, dtype=np.uint32)[:, None]
_FACTOR = (_RNG.integers(0, 1 << 31, VALUES, dtype=np.uint32) * np.uint32(2) + np.uint32(1))[:, None]


def shingles(found: text.Words, row: int, windows: np.ndarray) -> np.ndarray:
    """Sorted distinct shingle hashes of one row; ``windows`` has the hash of every five words."""
    a, b = int(found.rows[row]), int(found.rows[row + 1])
    if b - a >= SHINGLE:
        return np.unique(windows[a : b - SHINGLE + 1])
    if b == a:
        return np.zeros(0, np.uint64)
    return text.window_hashes(text.prefix_hashes(found.hashes[a:b]), b - a)


def minhash(hashes: np.ndarray) -> np.ndarray:
    """The least of the hashes under each of 128 permutations of 32 bits."""
    least = np.full(VALUES, 0xFFFFFFFF, np.uint32)
    for i in range(0, len(hashes), 2048):
        part = (hashes[i : i + 2048] >> np.uint64(32)).astype(np.uint32)
        np.minimum(least, ((part ^ _XOR) * _FACTOR).min(axis=1), out=least)
    return least


def odd_sketches(values: np.ndarray) -> np.ndarray:
    """Parity bitmaps, as eight 64-bit numbers a row, of rows of MinHash values."""
    n = len(values)
    place = text.mixed((values.astype(np.uint64) << np.uint64(8)) | np.arange(VALUES, dtype=np.uint64)) % np.uint64(SKETCH_BITS)
    flat = (place.astype(np.int64) + np.arange(n)[:, None] * SKETCH_BITS).ravel()
    bits = (np.bincount(flat, minlength=n * SKETCH_BITS) & 1).astype(np.uint8)
    return np.packbits(bits.reshape(n, -1), axis=1).view(np.int64)


def bands(values: np.ndarray) -> np.ndarray:
    parts = values.astype(np.uint64).reshape(len(values), -1, BAND)
    made = np.broadcast_to(np.arange(parts.shape[1], dtype=np.uint64), parts.shape[:2]).copy()
    for j in range(BAND):
        made = text.mixed(made ^ (parts[:, :, j] + (np.uint64(j + 1) << np.uint64(40))))
    return made.view(np.int64)


SIGNATURE = "doc_id bigint, n_shingles bigint, k1 bigint, k2 bigint, sketch array<bigint>, bands array<bigint>"


def signatures(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per row: set size, two hashes of the word sequence, odd sketch, band hashes (empty for an empty set)."""
    store.ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, data, offsets in text.slices(batch.column(1)):
                found = text.words(data, offsets, text.LOWER_TOKENS)
                prefix = text.prefix_hashes(found.hashes)
                windows = text.window_hashes(prefix, SHINGLE)
                n = last - first
                sizes, values = np.zeros(n, np.int64), np.zeros((n, VALUES), np.uint32)
                for row in range(n):
                    own = shingles(found, row, windows)
                    sizes[row] = len(own)
                    values[row] = minhash(own)
                k1, k2 = text.sequence_hashes(found).T
                filled = np.where(sizes > 0, VALUES // BAND, 0)
                lists = pa.ListArray.from_arrays(
                    pa.array(np.concatenate([[0], np.cumsum(filled)]), pa.int32()), pa.array(bands(values[sizes > 0]).ravel(), pa.int64())
                )
                sketch = pa.ListArray.from_arrays(
                    pa.array(np.arange(n + 1) * (SKETCH_BITS // 64), pa.int32()), pa.array(odd_sketches(values).ravel(), pa.int64())
                )
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, n), pa.array(sizes), pa.array(k1), pa.array(k2), sketch, lists],
                    names=["doc_id", "n_shingles", "k1", "k2", "sketch", "bands"],
                )

    chosen = docs.select(F.col(id_column).cast("bigint").alias("doc_id"), F.col(text_column).alias("text"))
    return chosen.mapInArrow(run, SIGNATURE)


def _differ(a: str, b: str) -> Column:
    """In how many bits two sketches differ."""
    each = [F.bit_count(F.col(a)[i].bitwiseXOR(F.col(b)[i])) for i in range(SKETCH_BITS // 64)]
    return sum(each[1:], each[0])


def _sets(column: pa.Array) -> list[np.ndarray]:
    """The shingles of every row of a text column."""
    out: list[np.ndarray] = []
    for first, last, data, offsets in text.slices(column):
        found = text.words(data, offsets, text.LOWER_TOKENS)
        windows = text.window_hashes(text.prefix_hashes(found.hashes), SHINGLE)
        out += [shingles(found, row, windows) for row in range(last - first)]
    return out


def confirmed(pairs: DataFrame, texts: DataFrame, similarity: int = SIMILARITY) -> DataFrame:
    """Those pairs (a, b) whose full shingle sets have ``similarity`` percent of their union in common."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [_sets(batch.column(column)) for column in (2, 3)]
            linked = []
            for x, y in zip(*sets, strict=True):
                common = len(np.intersect1d(x, y, assume_unique=True))
                linked.append(common > 0 and 100 * common >= similarity * (len(x) + len(y) - common))
            yield batch.select(["a", "b"]).filter(pa.array(linked, pa.bool_()))

    left = texts.select(F.col("doc_id").alias("a"), F.col("text").alias("_a"))
    right = texts.select(F.col("doc_id").alias("b"), F.col("text").alias("_b"))
    both = pairs.join(left, "a").join(right, "b").select("a", "b", "_a", "_b")
    return both.mapInArrow(run, "a bigint, b bigint")


def _alike(pairs: DataFrame, sketches: DataFrame) -> DataFrame:
    """Those pairs (a, b) whose sketches do not differ too much."""
    for side in ("a", "b"):
        pairs = pairs.join(sketches.select(F.col("node").alias(side), F.col("sketch").alias(f"_{side}")), side)
    return pairs.where(_differ("_a", "_b") <= MOST_DIFFERENT).select("a", "b")


def _open_links(members: DataFrame, texts: DataFrame, similarity: int) -> DataFrame:
    """Links between members that are outside the component of their bucket's smallest and other components.

    Buckets of one such component are taken together. Its open nodes and all its nodes are cut into
    blocks of bounded size, every block of the ones meets every block of the others in a task of
    its own, and only links are put out, one for a node and another component.
    """
    open_ = F.col("label") != F.col("_least")
    buckets = members.where(open_).select("bucket").distinct()
    nodes = members.join(buckets, "bucket", "left_semi").select(F.col("_least").alias("group"), "node", "label").distinct()
    nodes = store.written(nodes.withColumn("open", F.col("label") != F.col("group")), "open")
    blocks = nodes.groupBy("group").agg(
        F.ceil(F.count_if("open") / OPEN_BLOCK).cast("int").alias("_opens"), F.ceil(F.count(F.lit(1)) / MEMBER_BLOCK).cast("int").alias("_all")
    )
    nodes = nodes.join(blocks.hint("rebalance"), "group")
    own = F.pmod(F.xxhash64("node"), F.col("_opens")).cast("int")
    rows = nodes.where("open").select("group", own.alias("i"), F.explode(F.sequence(F.lit(0), F.col("_all") - 1)).alias("j"), F.lit(True).alias("asks"), "node", "label")
    own = F.pmod(F.xxhash64("node"), F.col("_all")).cast("int")
    rows = rows.unionByName(
        nodes.select("group", F.explode(F.sequence(F.lit(0), F.col("_opens") - 1)).alias("i"), own.alias("j"), F.lit(False).alias("asks"), "node", "label")
    )

    def run(table: pa.Table) -> pa.Table:
        asks = table.column("asks").to_numpy()
        node, label = table.column("node").to_numpy(), table.column("label").to_numpy()
        sets = _sets(table.column("text").combine_chunks())
        others = np.flatnonzero(~asks)
        sizes = np.array([len(sets[i]) for i in others], np.int64)
        flat = np.concatenate([np.zeros(0, np.uint64), *(sets[i] for i in others)])
        filled = sizes > 0
        begins = (np.cumsum(sizes) - sizes)[filled]
        out: list[tuple[int, int]] = []
        order = np.argsort(flat, kind="stable")
        ordered = flat[order]
        for i in np.flatnonzero(asks):
            own = sets[i]
            # Places in `flat` of the shingles that this node has.
            low, high = np.searchsorted(ordered, own, "left"), np.searchsorted(ordered, own, "right")
            per = high - low
            at = order[np.repeat(low, per) + np.arange(int(per.sum())) - np.repeat(np.cumsum(per) - per, per)]
            common = np.zeros(len(others), np.int64)
            common[filled] = np.bincount(np.searchsorted(begins, at, "right") - 1, minlength=len(begins))
            linked = (common > 0) & (100 * common >= similarity * (len(own) + sizes - common)) & (label[others] != label[i])
            _, one = np.unique(label[others][linked], return_index=True)
            out += [(max(node[i], m), min(node[i], m)) for m in node[others][linked][one]]
        return pa.table({"a": pa.array([a for a, _ in out], pa.int64()), "b": pa.array([b for _, b in out], pa.int64())})

    rows = rows.join(texts.withColumnRenamed("doc_id", "node"), "node")
    return rows.groupBy("group", "i", "j").applyInArrow(run, "a bigint, b bigint").distinct()


def _extended(links: DataFrame, found: DataFrame, more: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Links and components with more links, if there are any."""
    more = store.written(more, "links")
    if more.isEmpty():
        return links, found
    links = links.unionByName(more)
    return links, store.written(components.labels(links), "components")


def components_of(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", similarity: int = SIMILARITY) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest id reachable by links), kept (is that document)."""
    signed = store.written(signatures(docs, id_column, text_column), "signatures")
    filled = signed.where((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull())
    copies = filled.groupBy("k1", "k2").agg(
        F.min("doc_id").alias("node"), F.first("sketch").alias("sketch"), F.first("bands").alias("bands")
    )
    nodes = store.written(copies, "nodes")
    banded = nodes.select("node", F.explode("bands").alias("bucket"))
    shared = banded.groupBy("bucket").agg(F.min("node").alias("least"), F.max("node").alias("most"))
    # The rebalance hints feed joins by plain shuffles: a side summed by the key would arrive placed by
    # it, and Spark could then not split a bucket or node that very many rows have.
    shared = shared.where(F.col("least") < F.col("most")).select("bucket", "least").hint("rebalance")
    members = banded.join(shared, "bucket")
    members = store.written(members, "members")
    wanted = members.select(F.col("node").alias("doc_id")).distinct()
    texts = docs.select(F.col(id_column).cast("bigint").alias("doc_id"), F.col(text_column).alias("text"))
    texts = store.written(texts.join(wanted, "doc_id", "left_semi"), "candidates")
    sketches = nodes.select("node", "sketch").groupBy("node").agg(F.first("sketch").alias("sketch")).hint("rebalance")

    # Round 1: every node with the smallest that any of its buckets has, one pair a node.
    to_least = members.where(F.col("node") != F.col("least"))
    first_pairs = to_least.groupBy("node").agg(F.min("least").alias("least")).select(F.col("node").alias("a"), F.col("least").alias("b"))
    links = store.written(confirmed(_alike(first_pairs, sketches), texts, similarity), "links")
    found = store.written(components.labels(links), "components")

    # Round 2: with the smallest of each other bucket, where that is still in another component.
    def apart(pairs: DataFrame) -> DataFrame:
        for side in ("a", "b"):
            own = found.select(F.col("node").alias(side), F.col("component").alias(f"_{side}"))
            pairs = pairs.join(own, side, "left")
        return pairs.where(F.coalesce("_a", "a") != F.coalesce("_b", "b")).select("a", "b").distinct()

    stars = apart(to_least.select(F.col("node").alias("a"), F.col("least").alias("b")))
    links, found = _extended(links, found, confirmed(_alike(stars, sketches), texts, similarity))

    # Round 3: members whose component is not that of their bucket's smallest, with members of other components.
    label = F.coalesce("component", "node")
    own = members.join(found, "node", "left").select("bucket", "node", "least", label.alias("label"))
    first = found.select(F.col("node").alias("least"), F.col("component").alias("_least"))
    own = own.join(first, "least", "left").withColumn("_least", F.coalesce("_least", "least"))
    links, found = _extended(links, found, _open_links(own, texts, similarity))

    named = filled.join(nodes.select("k1", "k2", "node"), ["k1", "k2"]).select("doc_id", "node").distinct()
    grouped = named.join(found, "node", "left").select("doc_id", F.coalesce("component", "node").alias("component"))
    grouped = grouped.groupBy("doc_id").agg(F.min("component").alias("component_id"))
    component = F.coalesce("component_id", "doc_id")
    out = signed.select("doc_id", "n_shingles").join(grouped, "doc_id", "left")
    kept = F.coalesce(F.col("doc_id") == component, F.lit(True))
    return out.select("doc_id", "n_shingles", component.alias("component_id"), kept.alias("kept"))
