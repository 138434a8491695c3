"""Vectors as short codes: parts quantised by codebooks, distances gathered from value dictionaries.

Components become whole numbers, floor(scale * x), and a vector is cut into equal consecutive
parts, each coded by the nearest entry of its part position's codebook. Vectors are stored once
in blocks of bounded size: per dimension a dictionary of the distinct whole numbers that the block
holds, and for each vector its index into it. A pass tabulates, per dimension, the squared
difference of every distinct number to all entries; the distances of the block's parts to all
entries are then gathers from those tables by the indexes, and additions. Every pass, the six
that move the codebooks and the one that writes the codes, reads the same stored blocks.

A codebook starts as that part of the vectors with the smallest ids. Each round assigns every part to
its nearest entry (ties to the lower index) and replaces an entry by floor(sum / count) of its parts;
entries without parts stay. Only sums and counts per entry leave a task, and Spark adds them; the driver
holds codebooks, whose size is parts x entries x dimensions of a part.

All arithmetic is on whole numbers and exact; magnitudes above 2**26 after scaling, at which sums might
not be, are an error. Vectors that are null, or hold null or non-finite components, take no part.
Vectors of differing lengths, or of a length that the parts do not divide, are an error; vectors
of length 0 have codes of zeros. Fewer vectors than entries make as many entries as there are.
Repeated rows are coded each and weigh as often as they occur; of the rows with one id, that with the
smallest vector counts at the start, so equal rows start one entry. A null id comes after all others.
Null labels are one label. Empty tables give no rows and empty codebooks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import store

#: Components of a block at most, so its indexes and distances stay within some tens of megabytes.
BLOCK = 1 << 21
#: Magnitude of whole numbers up to which all sums are exact.
LARGEST = 1 << 26


@dataclass(frozen=True)
class Codebooks:
    """Whole-number entries of each part position: parts x entries x width."""

    entries: np.ndarray

    @property
    def digest(self) -> str:
        """SHA-256 of all components by part, entry and position, comma-joined."""
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()


def _whole(vectors: DataFrame, columns: Sequence[str], vector_column: str, scale: int) -> DataFrame:
    """``columns`` and the floored vector of the rows that take part."""
    vector = F.col("_vector").cast("array<double>")
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    chosen = vectors.select(*columns, F.col(vector_column).alias("_vector")).where(F.col("_vector").isNotNull() & ~bad)
    return chosen.select(*columns, F.transform(vector, lambda x: F.floor(x * scale)).alias("_whole"))


def _blocks(columns: Sequence[str], size: int):
    """Rows of a partition as blocks: the columns as lists, and the dictionaries and indexes as bytes."""

    def encoded(batches: list[pa.RecordBatch], rows: int) -> pa.RecordBatch:
        flat = np.concatenate([b.column(len(columns)).flatten().to_numpy(zero_copy_only=False) for b in batches]).astype(np.int64, copy=False)
        matrix = flat.reshape(rows, -1) if flat.size else np.zeros((rows, 0), np.int64)
        if matrix.size and max(-int(matrix.min()), int(matrix.max())) > LARGEST:
            raise ValueError("components beyond exact whole numbers")
        values, sizes, indexes = [], [], []
        for column in matrix.T:
            distinct, index = np.unique(column, return_inverse=True)
            values.append(distinct)
            sizes.append(len(distinct))
            indexes.append(index.astype(np.uint32))
        kept = [pa.concat_arrays([b.column(i) for b in batches]) for i in range(len(columns))]
        lists = [pa.ListArray.from_arrays(pa.array([0, rows], pa.int32()), x) for x in kept]
        made = [
            pa.array([rows], pa.int64()),
            pa.array([matrix.shape[1]], pa.int64()),
            pa.array([np.array(sizes, np.int64).tobytes()]),
            pa.array([np.concatenate([np.zeros(0, np.int64), *values]).tobytes()]),
            pa.array([np.concatenate([np.zeros(0, np.uint32), *indexes]).tobytes()]),
        ]
        return pa.RecordBatch.from_arrays([*lists, *made], names=[*columns, "_rows", "_width", "_sizes", "_values", "_indexes"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        rows = width = 0
        for batch in batches:
            lengths = np.diff(batch.column(len(columns)).offsets.to_numpy())
            at = 0
            while at < batch.num_rows:
                # A block ends where the length changes, so that each holds vectors of one length.
                same = int(np.argmax(np.append(lengths[at:] != lengths[at], True)))
                if held and (width != lengths[at] or rows * max(1, width) >= size):
                    yield encoded(held, rows)
                    held, rows = [], 0
                width = int(lengths[at])
                taken = min(same, max(1, size // max(1, width) - rows))
                held.append(batch.slice(at, taken))
                rows, at = rows + taken, at + taken
        if held:
            yield encoded(held, rows)

    return run


@dataclass(frozen=True)
class Block:
    """Dictionaries and indexes of a block's vectors."""

    rows: int
    values: list[np.ndarray]
    indexes: np.ndarray

    @classmethod
    def read(cls, rows: int, width: int, sizes: bytes, values: bytes, indexes: bytes) -> Block:
        at = np.cumsum(np.frombuffer(sizes, np.int64))[:-1]
        own = np.split(np.frombuffer(values, np.int64), at) if width else []
        return cls(rows, own, np.frombuffer(indexes, np.uint32).reshape(width, rows))

    def nearest(self, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each vector's entry per part, and the squared distance to it: (parts, rows) each.

        Per dimension, the squared differences of every dictionary value to all entries are
        tabulated; a part's distances are rows of those tables, gathered by index and added.
        """
        parts, many, width = entries.shape
        chosen, error = np.zeros((parts, self.rows), np.int64), np.zeros((parts, self.rows), np.int64)
        for part in range(parts):
            distances = np.zeros((self.rows, many), np.int64)
            for d in range(width):
                dimension = part * width + d
                table = (self.values[dimension][:, None] - entries[part, :, d][None, :]) ** 2
                distances += table[self.indexes[dimension]]
            chosen[part] = distances.argmin(axis=1)
            error[part] = distances[np.arange(self.rows), chosen[part]]
        return chosen, error

    def sums(self, chosen: np.ndarray, many: int, width: int) -> tuple[np.ndarray, np.ndarray]:
        """Count and component sums of the parts of each entry: (parts, many), (parts, many, width).

        Vectors are counted per entry and dictionary value, and the counts multiply the values."""
        parts = len(chosen)
        counts, totals = np.zeros((parts, many), np.int64), np.zeros((parts, many, width), np.int64)
        for part in range(parts):
            counts[part] = np.bincount(chosen[part], minlength=many)
            for d in range(width):
                values = self.values[part * width + d]
                pairs = chosen[part] * len(values) + self.indexes[part * width + d]
                found = np.bincount(pairs, minlength=many * len(values)).reshape(many, len(values))
                totals[part, :, d] = found @ values
        return counts, totals


@dataclass(frozen=True)
class Encoded:
    """Vectors stored as blocks, with the columns that stay with them."""

    blocks: DataFrame
    columns: tuple[str, ...]
    first: list[list[int]]
    width: int

    def blocks_of(self, *columns: str) -> DataFrame:
        return self.blocks.select("_rows", "_width", "_sizes", "_values", "_indexes", *columns)


def encode_values(
    vectors: DataFrame,
    columns: Sequence[str] = ("vec_id", "label"),
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    scale: int = 4096,
    entries: int = 16,
    block: int = BLOCK,
) -> Encoded:
    """The vectors that take part, written as blocks with dictionaries; and the vectors of the smallest ids."""
    spark = vectors.sparkSession
    store.ship(spark)
    if not 1 <= entries <= 256:
        raise ValueError("two hex digits name 256 entries at most")
    columns = tuple(columns)
    own = [f"c{i}" for i in range(len(columns))]
    renamed = vectors.select(*(F.col(c).alias(x) for c, x in zip(columns, own, strict=True)), F.col(id_column).alias("_id"), F.col(vector_column).alias("_source"))
    whole = _whole(renamed, [*own, "_id"], "_source", scale)
    lists = ", ".join(f"{name} array<{kind}>" for name, kind in whole.select(*own).dtypes)
    schema = f"{lists}{', ' if lists else ''}_rows bigint, _width bigint, _sizes binary, _values binary, _indexes binary"
    blocks = store.written(whole.select(*own, "_whole").mapInArrow(_blocks(own, block), schema), "blocks")
    lengths = [r[0] for r in blocks.select("_width").distinct().limit(2).collect()]
    if len(lengths) > 1:
        raise ValueError("vectors of differing lengths cannot share codebooks")
    return Encoded(blocks, columns, _first(whole, entries), lengths[0] if lengths else 0)


def _first(whole: DataFrame, entries: int) -> list[list[int]]:
    """The vectors of the smallest ids, null last: the ids by a bounded top-k, then their rows alone."""
    by_id = F.col("_id").asc_nulls_last()
    ids = [r["_id"] for r in whole.select("_id").distinct().orderBy(by_id).limit(entries).collect()]
    named = F.col("_id").isin([i for i in ids if i is not None])
    wanted = whole.where(named | F.col("_id").isNull() if None in ids else named)
    return [r["_whole"] for r in wanted.groupBy("_id").agg(F.min("_whole").alias("_whole")).orderBy(by_id).collect()]


def learn(encoded: Encoded, parts: int = 8, rounds: int = 6) -> Codebooks:
    """Codebooks after ``rounds`` of assigning all parts and moving the entries to their means."""
    if encoded.width % parts:
        raise ValueError(f"vectors of {encoded.width} components cannot be cut into {parts} equal parts")
    width = encoded.width // parts
    start = np.array(encoded.first, np.int64).reshape(len(encoded.first), parts, width)
    entries = np.ascontiguousarray(start.transpose(1, 0, 2))
    if not entries.size:
        return Codebooks(entries)
    for _ in range(rounds):
        entries = _moved(encoded, entries)
    return Codebooks(entries)


def _moved(encoded: Encoded, entries: np.ndarray) -> np.ndarray:
    """One round: per partition, counts and sums per entry; Spark adds them; the driver divides."""
    shared = encoded.blocks.sparkSession.sparkContext.broadcast(entries)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = shared.value
        parts, many, width = now.shape
        counts, totals = np.zeros((parts, many), np.int64), np.zeros((parts, many, width), np.int64)
        for block in _read(batches):
            chosen, _ = block.nearest(now)
            n, t = block.sums(chosen, many, width)
            counts, totals = counts + n, totals + t
        used = np.argwhere(counts > 0)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(used[:, 0], pa.int32()),
                pa.array(used[:, 1], pa.int32()),
                pa.array(counts[used[:, 0], used[:, 1]], pa.int64()),
                pa.array(list(totals[used[:, 0], used[:, 1]]), pa.list_(pa.int64())),
            ],
            names=["part", "entry", "n", "total"],
        )

    found = encoded.blocks_of().mapInArrow(run, "part int, entry int, n bigint, total array<bigint>")
    each = found.select("part", "entry", "n", F.posexplode("total").alias("place", "total"))
    rows = each.groupBy("part", "entry", "place").agg(F.sum("n").alias("n"), F.sum("total").alias("total")).collect()
    moved = entries.copy()
    for r in rows:
        moved[r["part"], r["entry"], r["place"]] = r["total"] // r["n"]
    shared.unpersist()
    return moved


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[Block]:
    for batch in batches:
        for row in range(batch.num_rows):
            yield Block.read(*(batch.column(i)[row].as_py() for i in range(5)))


def assign(encoded: Encoded, codebooks: Codebooks) -> DataFrame:
    """The columns with ``code`` (two hex digits per part) and ``error`` (squared distance) of every vector."""
    spark: SparkSession = encoded.blocks.sparkSession
    own = [f"c{i}" for i in range(len(encoded.columns))]
    shared = spark.sparkContext.broadcast(codebooks.entries)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = shared.value
        for batch in batches:
            for row in range(batch.num_rows):
                one = batch.slice(row, 1)
                chosen, error = next(_read(iter([one]))).nearest(now)
                digits = np.frombuffer(np.ascontiguousarray(chosen.T.astype(np.uint8)).tobytes().hex().encode(), f"S{2 * len(chosen)}")
                kept = [one.column(5 + i).flatten() for i in range(len(own))]
                yield pa.RecordBatch.from_arrays(
                    [*kept, pa.array(digits.astype(str)), pa.array(error.sum(axis=0), pa.int64())], names=[*own, "code", "error"]
                )

    kinds = [kind[len("array<") : -1] for _, kind in encoded.blocks.select(*own).dtypes]
    fields = "".join(f"{name} {kind}, " for name, kind in zip(own, kinds, strict=True))
    coded = encoded.blocks_of(*own).mapInArrow(run, f"{fields}code string, error bigint")
    return coded.select(*(F.col(x).alias(c) for x, c in zip(own, encoded.columns, strict=True)), "code", "error")


def decode(coded: DataFrame, codebooks: Codebooks, scale: int = 4096) -> DataFrame:
    """``coded`` with ``decoded``, the entries that the code names, as components."""
    parts, _, width = codebooks.entries.shape
    books = F.array(*(F.array(*(F.array(*(F.lit(int(x)) for x in entry)) for entry in book)) for book in codebooks.entries))
    entry = F.transform(
        F.sequence(F.lit(0), F.lit(parts - 1)),
        lambda p: books[p][F.conv(F.substring("code", p * 2 + 1, F.lit(2)), 16, 10).cast("int")],
    )
    return coded.withColumn("decoded", F.transform(F.flatten(entry), lambda x: x.cast("double") / scale))


def with_label_error(coded: DataFrame, label_column: str = "label") -> DataFrame:
    """Add ``label_error``, the error summed over all vectors of the label; nulls are one label.

    Summed before the shuffle; the rebalance hint lets Spark split a label that most vectors have.
    """
    label = F.col(label_column)
    totals = coded.groupBy(label.alias("_label")).agg(F.sum("error").alias("label_error")).hint("rebalance")
    return coded.join(totals, label.eqNullSafe(F.col("_label"))).drop("_label")
