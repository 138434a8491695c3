"""Toxicity scores by a small convolutional network over hashed word embeddings.

A word's vector is the sum of two embeddings, one by the hash of the word and one by the
hash of its first four bytes, so inflected forms share something. Filters of one, two
and three words slide over a text; each filter keeps its largest response in the whole
text (at least 0), and a logistic unit reads these. All labelled texts teach, whole. They are
dealt into blocks by the hash of their id; in each of EPOCHS rounds a task goes over its blocks
in numpy by Adam, from the round's network, and what the blocks changed is averaged by Spark,
a word's vector over the blocks that changed it. The first coordinate of an embedding begins
as its log odds over all blocks. A tenth of the texts, by hash, teaches no weights: their
logits, counted in steps of 1/64, set the slope and offset of the scores (Platt), and
per language the threshold at which the share of wrong decisions is least. Averages are of
whole numbers, so they do not depend on the order in which tasks end.

Texts that are null or without words have the score of no response at all. Words that
fewer than five of the teaching texts hold have a zero vector. Without both kinds of
labels all scores are the share of label 1 (0.5 if there is none). Rows of equal
id share the largest of their labels; repeated texts are scored each, equal texts alike.
No documents give no rows. Only the named columns are read; the label, language, source and id
never enter a score.
"""

from __future__ import annotations

import copy
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import store, text

#: Texts of each label at most that :func:`sample` draws, by a hash of the id.
SAMPLE_ROWS = 2500
#: Bytes of one text at most in such a sample; of a longer one a piece is in it.
SAMPLE_BYTES = 20_000
BUCKETS = 1 << 21
SIZE = 8
WIDTHS = (1, 2, 3)
FILTERS = 8
PREFIX = 4
SEEN_IN = 5
EPOCHS = 8
BATCH = 32
#: Words of a batch, unless one text alone has more.
BATCH_WORDS = 200_000
#: About how many labelled texts are one block, and words at which a block is cut.
BLOCK_ROWS = 2048
BLOCK_WORDS = 400_000
#: Bits per labelled id of the table that tells which texts may have a label, and bits of one row of it.
ID_BITS, ROW_BITS = 16, 1 << 15
#: Steps in which changes of parameters are counted, and logits of the held-out texts.
UNIT, LOGIT_UNIT = 1 << 20, 64
RATE = 0.01
_OTHER = np.uint64(0x94D049BB133111EB)


def _maybe_among(docs: DataFrame, ids: DataFrame, n: int) -> DataFrame:
    """The rows of ``docs`` whose id is one of the ``n`` of ``ids``, and about a sixteenth of the others.

    A join of ids would send all texts through a shuffle once they are too many to broadcast. A table of
    bits by the hash of an id, two bytes for each labelled one, stays small enough at any size; ids compare as text.
    """
    place = F.pmod(F.xxhash64(F.col("doc_id").cast("string")), F.lit(ID_BITS * max(1, n)))
    row, bit = F.floor(place / ROW_BITS).alias("_row"), (place % ROW_BITS).alias("_bit")
    table = ids.select(row, bit).groupBy("_row").agg(F.bitmap_construct_agg("_bit").alias("_bits"))
    byte = F.conv(F.hex(F.expr("substring(_bits, cast(_bit div 8 as int) + 1, 1)")), 16, 10).cast("int")
    found = docs.select("*", row, bit).join(F.broadcast(table), "_row")
    return found.where(byte.bitwiseAND(F.expr("shiftleft(1, cast(_bit % 8 as int))")) != 0).select(*docs.columns)


def labelled(docs: DataFrame, labels: DataFrame, learn: Column, label: str = "toxic") -> DataFrame:
    """(_block, _hash, label, lang, text) of every labelled document, whole, dealt by block;
    ``learn`` is about ``doc_id``. Of an id in several rows one text counts."""
    lang = F.col("lang") if "lang" in docs.columns else F.lit(None).cast("string")
    own = learn & F.col("doc_id").isNotNull()
    marks = labels.where(own & F.col(label).isin(0, 1)).select("doc_id", F.col(label).cast("int").alias("label"))
    n = marks.count()
    blocks = max(1, -(-n // BLOCK_ROWS))
    # Most texts without a label stay out of the shuffle; the others are left out after it.
    texts = docs.where(own).select("doc_id", F.struct("text", lang.alias("lang")).alias("_one"))
    texts = _maybe_among(texts, marks, n)
    # One shuffle of the texts serves the join, the choice among rows of one id, and the blocks.
    both = texts.unionByName(marks, allowMissingColumns=True).withColumn("_hash", F.xxhash64("doc_id"))
    both = both.withColumn("_block", F.pmod("_hash", F.lit(blocks)).cast("int")).repartition(blocks, "_block")
    one = both.groupBy("_block", "_hash", "doc_id").agg(F.max("label").alias("label"), F.min("_one").alias("_one"))
    one = one.where(F.col("label").isNotNull() & F.col("_one").isNotNull())
    return one.select("_block", "_hash", "label", "_one.lang", "_one.text")


def sample(docs: DataFrame, labels: DataFrame, learn: Column, label: str = "toxic", rows: int = SAMPLE_ROWS) -> DataFrame:
    """(label, lang, text) of at most ``rows`` documents of each label; ``learn`` is about ``doc_id``.

    Labels without a document are left out before ids are drawn. Of an id in several rows one
    text counts. Ids are drawn by hash, first those below a share of its range that is about
    four times what is wanted, however many there are, so no task ranks all labelled ids.
    """
    lang = F.col("lang") if "lang" in docs.columns else F.lit(None).cast("string")
    known = docs.select("doc_id")
    chosen = labels.where(learn & F.col(label).isin(0, 1) & F.col("doc_id").isNotNull()).join(known, "doc_id", "left_semi")
    chosen = chosen.groupBy("doc_id").agg(F.max(label).alias("label")).withColumn("_h", F.xxhash64("doc_id"))
    share = F.least(F.lit(1.0), F.lit(4.0 * rows) / F.count(F.lit(1)))
    # One row per label, of two.
    counts = chosen.groupBy("label").agg(((2 * share - 1) * float(1 << 63)).alias("_most"))
    few = chosen.join(F.broadcast(counts), "label").where(F.col("_h").cast("double") <= F.col("_most"))
    ranked = Window.partitionBy("label").orderBy("_h", "doc_id")
    few = few.withColumn("_n", F.row_number().over(ranked)).where(F.col("_n") <= rows).select("doc_id", "label")
    # At most 2 * rows ids.
    texts = docs.select("doc_id", lang.alias("lang"), "text").join(F.broadcast(few), "doc_id")
    one = texts.groupBy("doc_id", "label").agg(F.min(F.struct("text", "lang")).alias("_one"))
    return one.select(F.col("label").cast("int"), "_one.lang", store.piece(F.col("_one.text"), SAMPLE_BYTES).alias("text"))


def _buckets(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(two buckets of every word, index of each row's first word)."""
    found = text.words(data, offsets, text.LOWER_WORDS)
    values = text.byte_values(text._LOWER[data])
    begins = text.range_hashes(text.prefix_hashes(values), found.start, np.minimum(found.end, found.start + PREFIX))
    both = np.stack([found.hashes, text.mixed(begins ^ _OTHER)], axis=1) % np.uint64(BUCKETS)
    return both.astype(np.int64), found.rows


def hashed(texts: DataFrame) -> DataFrame:
    """``texts`` of (_block, held, label, lang, text) with the words of the last as pairs of buckets."""
    store.ship(texts.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, end, data, offsets in text.slices(batch.column(4)):
                both, rows = _buckets(data, offsets)
                both = both.astype(np.int32)
                lists = [both[a:b].tobytes() for a, b in zip(rows[:-1], rows[1:], strict=True)]
                kept = [batch.column(k).slice(begin, end - begin) for k in range(4)]
                yield pa.RecordBatch.from_arrays([*kept, pa.array(lists, pa.binary())], names=["_block", "held", "label", "lang", "words"])

    columns = texts.select("_block", "held", "label", "lang", "text")
    return columns.mapInArrow(run, "_block int, held boolean, label int, lang string, words binary")


def _words(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All rows' pairs of buckets, and the index of each row's first."""
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None and data.size else np.zeros(0, np.uint8)
    return raw.copy().view(np.int32).reshape(-1, 2), (at - at[0]) // 8


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(block, labels, pairs of buckets of all its texts, index of each text's first) from rows of
    (_block, label, words) that are in order of their blocks; a block of very many words in pieces."""
    block, held = None, []

    def joined() -> tuple[int, np.ndarray, np.ndarray, np.ndarray]:
        sizes = np.concatenate([np.diff(rows) for _, _, rows in held])
        return block, np.concatenate([y for y, _, _ in held]), np.concatenate([w for _, w, _ in held]), np.concatenate([[0], np.cumsum(sizes)])

    for whole in batches:
        for batch in text.parts(whole, 2, 8 * BLOCK_WORDS):
            blocks, label = (batch.column(k).to_numpy(zero_copy_only=False) for k in range(2))
            words, rows = _words(batch.column(2))
            cuts = [0, *(np.flatnonzero(np.diff(blocks)) + 1).tolist(), len(blocks)]
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                if a == b:
                    continue
                if held and (blocks[a] != block or sum(len(w) for _, w, _ in held) + rows[b] - rows[a] > BLOCK_WORDS):
                    yield joined()
                    held = []
                block = int(blocks[a])
                held.append((label[a:b].astype(np.float64), words[rows[a] : rows[b]], rows[a : b + 1] - rows[a]))
    if held:
        yield joined()


def _valid(rows: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows within a row; rows that have any; where those rows' windows begin."""
    windows = text.row_windows(rows, width)
    counts = np.maximum(0, np.diff(rows) - width + 1)
    filled = np.flatnonzero(counts)
    return windows, filled, (np.cumsum(counts) - counts)[filled]


class Network:
    """Parameters, responses and gradients."""

    def __init__(self, known: np.ndarray, vectors: np.ndarray, seed: int = 2):
        rng = np.random.default_rng(seed)
        #: Buckets with a vector, sorted; row 0 of ``vectors`` is that of all others.
        self.known, self.vectors = known, vectors
        self.filters = [rng.normal(0, 0.1, (w, vectors.shape[1], FILTERS)).astype(np.float32) for w in WIDTHS]
        for own in self.filters:
            own[:, 0, : FILTERS // 2] += 1 / len(own)
        self.offsets = [np.zeros(FILTERS, np.float32) for _ in WIDTHS]
        self.out = np.full(len(WIDTHS) * FILTERS, 0.1, np.float32)
        self.bias = np.float32(-1)
        self.slope, self.shift = 1.0, 0.0
        self.thresholds: dict[str | None, float] = {}

    def index(self) -> np.ndarray:
        dense = np.zeros(BUCKETS, np.int32)
        dense[self.known] = np.arange(1, len(self.known) + 1)
        return dense

    def parameters_of(self, used: np.ndarray) -> Network:
        """The same network with these rows of its vectors."""
        own = copy.copy(self)
        own.known, own.vectors = used, self.vectors[used]
        return own

    def pooled(self, x: np.ndarray, rows: np.ndarray, where: bool = False):
        """Largest response of every filter per row, and, if asked, the window that gave it (-1: none above 0)."""
        n = len(rows) - 1
        out = np.zeros((n, len(WIDTHS) * FILTERS), np.float32)
        at = np.full(out.shape, -1)
        for k, width in enumerate(WIDTHS):
            windows, filled, begins = _valid(rows, width)
            if not len(windows):
                continue
            columns = slice(k * FILTERS, (k + 1) * FILTERS)
            response = x[windows] @ self.filters[k][0] + self.offsets[k]
            for j in range(1, width):
                response += x[windows + j] @ self.filters[k][j]
            top = np.maximum.reduceat(response, begins, axis=0)
            out[filled, columns] = np.maximum(0, top)
            if where:
                hit = response == np.repeat(top, np.diff([*begins, len(windows)]), axis=0)
                first = np.minimum.reduceat(np.where(hit, windows[:, None], len(x)), begins, axis=0)
                at[filled, columns] = np.where(top > 0, first, -1)
        return (out, at) if where else out

    def logits(self, pooled: np.ndarray) -> np.ndarray:
        return (pooled @ self.out + self.bias).astype(np.float64)

    def scores(self, pooled: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * self.logits(pooled) + self.shift, -60, 60)))


class _Adam:
    """Adam; of a table of vectors only the rows that a batch concerns are touched."""

    def __init__(self, parameter: np.ndarray):
        self.parameter = parameter
        self.steps = np.zeros((len(parameter), *[1] * (parameter.ndim - 1)), np.int64)
        self.first, self.second = np.zeros_like(parameter), np.zeros_like(parameter)

    def step(self, gradient: np.ndarray, rows: np.ndarray | slice = slice(None)) -> None:
        self.steps[rows] += 1
        steps = self.steps[rows]
        first = self.first[rows] + 0.1 * (gradient - self.first[rows])
        second = self.second[rows] + 0.001 * (gradient * gradient - self.second[rows])
        self.first[rows], self.second[rows] = first, second
        first, second = first / (1 - 0.9**steps), second / (1 - 0.999**steps)
        self.parameter[rows] -= (RATE * first / (np.sqrt(second) + 1e-8)).astype(np.float32)


def _embeddings(known: np.ndarray, seen: np.ndarray, positive: np.ndarray, ones: int, zeros: int) -> Network:
    """Buckets that enough texts hold, with their log odds as first coordinate."""
    odds = np.log((positive + 0.5) / (ones + 1)) - np.log((seen - positive + 0.5) / (zeros + 1))
    vectors = np.random.default_rng(1).normal(0, 0.01, (len(known) + 1, SIZE)).astype(np.float32)
    vectors[0] = 0
    vectors[1:, 0] = odds / 4
    return Network(known, vectors)


def _gradients(network: Network, own: np.ndarray, rows: np.ndarray, label: np.ndarray) -> tuple:
    """Of a batch: the rows of the vectors that it concerns, and the gradients of them, of the filters,
    the offsets, the output and the bias."""
    x = network.vectors[own].sum(axis=1)
    pooled, at = network.pooled(x, rows, where=True)
    error = ((1 / (1 + np.exp(-np.clip(network.logits(pooled), -60, 60))) - label) / len(label)).astype(np.float32)
    passed = np.where(at >= 0, error[:, None] * network.out, np.float32(0))
    filters, offsets, touched, back = [], [], [], []
    for k, width in enumerate(WIDTHS):
        columns = slice(k * FILTERS, (k + 1) * FILTERS)
        g, place = passed[:, columns], np.maximum(at[:, columns], 0)
        offsets.append(g.sum(axis=0))
        active = at[:, columns] >= 0
        found = np.zeros_like(network.filters[k])
        for j in range(width):
            # Texts without a window of this width have no active place.
            there = np.where(active, place + j, 0)
            if len(x):
                found[j] = np.einsum("rf,rfs->sf", g, x[there])
                touched.append(own[there[active]].ravel())
                back.append(np.repeat((g[:, :, None] * network.filters[k][j].T[None])[active], 2, axis=0))
        filters.append(found)
    if not touched:
        return np.zeros(0, np.int64), np.zeros((0, SIZE), np.float32), filters, offsets, pooled.T @ error, error.sum()
    concerned, inverse = np.unique(np.concatenate(touched), return_inverse=True)
    vectors = np.zeros((len(concerned), SIZE), np.float32)
    np.add.at(vectors, inverse, np.concatenate(back))
    if len(concerned) and concerned[0] == 0:
        concerned, vectors = concerned[1:], vectors[1:]
    return concerned, vectors, filters, offsets, pooled.T @ error, error.sum()


def _batches(order: np.ndarray, sizes: np.ndarray) -> Iterator[np.ndarray]:
    """The texts in their order, so many at once as make a batch."""
    begin, total = 0, 0
    for i, d in enumerate(order):
        if i > begin and (i - begin == BATCH or total + sizes[d] > BATCH_WORDS):
            yield order[begin:i]
            begin, total = i, 0
        total += sizes[d]
    if begin < len(order):
        yield order[begin:]


def train(network: Network, label: np.ndarray, inputs: np.ndarray, rows: np.ndarray, seed: tuple[int, ...]) -> int:
    """One pass over a block by Adam, in place; the number of batches."""
    parameters = [network.vectors, *network.filters, *network.offsets, network.out]
    adam = [_Adam(p) for p in parameters]
    bias = np.array([network.bias], np.float32)
    adam_bias = _Adam(bias)
    n = 0
    for batch in _batches(np.random.default_rng(seed).permutation(len(label)), np.diff(rows)):
        own = np.concatenate([inputs[rows[d] : rows[d + 1]] for d in batch])
        at = np.concatenate([[0], np.cumsum([rows[d + 1] - rows[d] for d in batch])])
        concerned, vectors, filters, offsets, out, error = _gradients(network, own, at, label[batch])
        adam[0].step(vectors, concerned)
        for optimizer, gradient in zip(adam[1:], [*filters, *offsets, out], strict=True):
            optimizer.step(gradient)
        adam_bias.step(np.array([error], np.float32))
        network.bias = bias[0]
        n += 1
    return n


def _dense(network: Network) -> np.ndarray:
    """All parameters but the vectors, in rows as long as a vector."""
    flat = np.concatenate([*(x.ravel() for x in (*network.filters, *network.offsets, network.out)), [network.bias]])
    return np.concatenate([flat, np.zeros(-len(flat) % SIZE)]).reshape(-1, SIZE)


def _counts(stored: DataFrame) -> DataFrame:
    """(bucket, seen, positive) over the teaching texts: how many hold it, and how many of those are of label 1."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, label, words, rows in _blocks(batches):
            owner = np.repeat(np.arange(len(label)), 2 * np.diff(rows))
            once = np.unique(words.ravel().astype(np.int64) * len(label) + owner)
            known, inverse, seen = np.unique(once // len(label), return_inverse=True, return_counts=True)
            positive = np.bincount(inverse, label[once % len(label)], len(known)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (known, seen.astype(np.int64), positive)], names=["bucket", "seen", "positive"])

    found = stored.select("_block", "label", "words").mapInArrow(run, "bucket bigint, seen bigint, positive bigint")
    found = found.groupBy("bucket").agg(F.sum("seen").alias("seen"), F.sum("positive").alias("positive"))
    return found.where(F.col("seen") >= SEEN_IN)


def _round(stored: DataFrame, network: Network, number: int) -> None:
    """One pass over all blocks, each from this network; then the network with their average."""
    shared = stored.sparkSession.sparkContext.broadcast(network)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole = shared.value
        index = whole.index()
        for block, label, words, rows in _blocks(batches):
            # The block's own vectors, after that of all other words.
            used, inputs = np.unique(np.concatenate([[0], index[words].ravel()]), return_inverse=True)
            own = copy.deepcopy(whole.parameters_of(used))
            before, dense = own.vectors.copy(), _dense(own)
            steps = train(own, label, inputs[1:].reshape(-1, 2), rows, (3, number, block))
            changed = np.flatnonzero((own.vectors != before).any(axis=1))
            changes = np.concatenate([own.vectors[changed] - before[changed], _dense(own) - dense])
            keys = np.concatenate([used[changed], -1 - np.arange(len(dense))])
            counted = np.rint(changes * (float(UNIT) * steps)).astype(np.int64)
            columns = [keys.astype(np.int64), np.full(len(keys), steps, np.int64), *counted.T]
            yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(x)) for x in columns], names=names)

    sums = ["steps", *(f"d{i}" for i in range(SIZE))]
    names = ["key", *sums]
    found = stored.select("_block", "label", "words").mapInArrow(run, ", ".join(f"{x} bigint" for x in names))
    # At most one row per bucket, whatever the corpus.
    table = found.groupBy("key").agg(*(F.sum(x).alias(x) for x in sums)).toArrow()
    key, steps, *changes = (table.column(x).to_numpy() for x in names)
    mean = np.stack(changes, axis=1) / (float(UNIT) * steps[:, None])
    network.vectors[key[key > 0]] += mean[key > 0].astype(np.float32)
    dense = _dense(network)
    dense[-1 - key[key < 0]] += mean[key < 0]
    at = 0
    for parameter in (*network.filters, *network.offsets, network.out):
        parameter[...] = dense.ravel()[at : at + parameter.size].reshape(parameter.shape)
        at += parameter.size
    network.bias = np.float32(dense.ravel()[at])
    shared.destroy()


def _held_logits(stored: DataFrame, network: Network) -> DataFrame:
    """(lang, label, z, n): how many held-out texts have a logit, in steps."""
    shared = stored.sparkSession.sparkContext.broadcast(network)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        index = own.index()
        for whole in batches:
            for batch in text.parts(whole, 2):
                words, rows = _words(batch.column(2))
                logits = own.logits(own.pooled(own.vectors[index[words]].sum(axis=1), rows))
                z = np.rint(np.clip(logits, -60, 60) * LOGIT_UNIT).astype(np.int64)
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(z)], names=["lang", "label", "z"])

    found = stored.select("lang", "label", "words").mapInArrow(run, "lang string, label int, z bigint")
    return found.groupBy("lang", "label", "z").agg(F.count("*").alias("n"))


def _calibrate(network: Network, found: list[tuple[str | None, int, int, int]]) -> None:
    """Slope and offset by a few Newton steps on the held-out texts; thresholds by language."""
    label, z, n = (np.array([r[k] for r in found], np.float64) for k in (1, 2, 3))
    if len(set(label.tolist())) < 2:
        return
    z /= LOGIT_UNIT
    # Targets short of 0 and 1, after Platt.
    ones, total = n[label == 1].sum(), n.sum()
    target = np.where(label == 1, (ones + 1) / (ones + 2), 1 / (total - ones + 2))
    design = np.stack([z, np.ones_like(z)], axis=1)
    # A prior of slope 1 and offset 0 keeps the scores finite where the held-out part is told apart without error.
    start = np.array([1.0, 0.0])
    weights = start.copy()
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(design @ weights, -60, 60)))
        gradient = design.T @ (n * (p - target)) + 10 * (weights - start)
        curve = (design * (n * p * (1 - p))[:, None]).T @ design + 10 * np.eye(2)
        weights = weights - np.clip(np.linalg.solve(curve, gradient), -0.5, 0.5)
    if np.isfinite(weights).all() and weights[0] > 0:
        network.slope, network.shift = float(weights[0]), float(weights[1])
    scores = 1 / (1 + np.exp(-np.clip(network.slope * z + network.shift, -60, 60)))
    langs = [r[0] for r in found]
    for lang in {*langs, None}:
        own = np.array([lang is None or x == lang for x in langs])
        order = np.argsort(scores[own], kind="stable")
        s, y, m = scores[own][order], label[own][order], n[own][order]
        cuts = np.unique(np.concatenate([[0.5], (s[1:] + s[:-1]) / 2]))
        below = np.searchsorted(s, cuts, "left")
        missed, kept = (np.concatenate([[0], np.cumsum(m * (y == k))]) for k in (1, 0))
        wrong = missed[below] + kept[-1] - kept[below] + np.abs(cuts - 0.5) / 10
        network.thresholds[lang] = float(cuts[int(np.argmin(wrong))])


def learn(texts: DataFrame) -> Network:
    """The network of all given texts (see :func:`labelled`); those without a block are one block."""
    if "_block" not in texts.columns:
        texts = texts.withColumns({"_block": F.lit(0), "_hash": F.xxhash64("text")}).repartition(1)
        texts = texts.sortWithinPartitions("_hash", "label", "lang")
    held = F.pmod(F.shiftright("_hash", 33), F.lit(10)) == 0
    stored = store.written(hashed(texts.withColumn("held", held)), "toxicity")
    used = stored.where(~F.col("held"))
    totals = {r["label"]: r["n"] for r in stored.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if len(totals) < 2:
        network = Network(np.zeros(0, np.int64), np.zeros((1, SIZE), np.float32))
        network.out[:] = 0
        network.bias = np.float32(0)
        share = (totals.get(1, 0) + 0.5) / (sum(totals.values()) + 1)
        network.shift = float(np.log(share / (1 - share)))
        return network
    # At most one row per bucket, whatever the corpus.
    counts = _counts(used).toArrow().sort_by("bucket")
    known, seen, positive = (counts.column(x).to_numpy() for x in ("bucket", "seen", "positive"))
    teaching = {r["label"]: r["n"] for r in used.groupBy("label").agg(F.count("*").alias("n")).collect()}
    network = _embeddings(known, seen, positive, teaching.get(1, 0), teaching.get(0, 0))
    for number in range(EPOCHS):
        _round(used, network, number)
    found = _held_logits(stored.where("held"), network).collect()
    _calibrate(network, sorted((tuple(r) for r in found), key=lambda r: (r[0] or "", *r[1:])))
    return network


def score(docs: DataFrame, network: Network, text_column: str = "text", columns: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``columns`` with the score of every whole text."""
    store.ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(network)
    fields = ", ".join(f"`{name}` {kind}" for name, kind in docs.select(*columns).dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        index = own.index()
        for batch in batches:
            parts = [np.zeros(0)]
            for _, _, data, offsets in text.slices(batch.column(0), text.SLICE_BYTES // 2):
                both, rows = _buckets(data, offsets)
                x = own.vectors[index[both[:, 0]]] + own.vectors[index[both[:, 1]]]
                parts.append(own.scores(own.pooled(x, rows)))
            kept = [batch.column(k + 1) for k in range(len(columns))]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(np.concatenate(parts))], names=[*columns, "score"])

    schema = f"{fields}{', ' if fields else ''}score double"
    return docs.select(F.col(text_column).alias("_text"), *columns).mapInArrow(run, schema)


def decided(scored: DataFrame, network: Network, lang: str = "lang") -> DataFrame:
    """``scored`` with ``toxic``: whether the score reaches the threshold of the row's language."""
    default = network.thresholds.get(None, 0.5)
    threshold = F.lit(default)
    for name, own in network.thresholds.items():
        if name is not None:
            threshold = F.when(F.col(lang) == name, own).otherwise(threshold)
    return scored.withColumn("toxic", F.col("score") >= threshold)
