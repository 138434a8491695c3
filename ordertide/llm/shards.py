"""Contiguous shards of nearly equal size whose largest is as small as can be, and that keep equal texts together.

Equal texts are one atomic group (texts of one SHA-256 digest). Groups are ordered by their
smallest doc_id, so shards follow the documents' order, and documents within a group by doc_id.
A capacity is feasible if filling shards greedily, one group after the other, takes no more
shards than asked; the smallest feasible capacity is found by binary search, and the greedy
cuts at it are the shards' bounds. A group larger than all else is the capacity by itself.

A greedy check needs no scan of the groups: from running totals of their sizes in order, each
cut is the last group that ends within the capacity. The driver holds those totals only by
bins, the first and last group end of each, a bounded number at once. A check over bins tells
"feasible", "not feasible" or "unclear"; the search narrows the capacity as far as that tells, and
then looks again, with finer bins, at only the stretches where a cut of an unclear capacity may
lie. Each look divides them by thousands, so a few looks settle any table, exactly.

Null text has no bytes; each document counts its UTF-8 bytes plus 1, so an empty text has a size
too. A null doc_id comes after all others. Rows that repeat an id and text stay rows of their own,
in any order among themselves. With fewer groups than shards the last shards are empty, and an
empty table has no rows. Shards and slots are whole numbers from 0 without gaps.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordertide.operators import ordering

from . import store

#: Bins that the driver asks for in one look, over all stretches.
BINS = 1 << 15


def _sizes(docs: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Narrow rows, written once: the texts are read here and nowhere else."""
    data = F.coalesce(F.col("_text"), F.lit("")).cast("binary")
    narrow = docs.select(
        *columns,
        "_id",
        F.monotonically_increasing_id().alias("_row"),
        (F.octet_length(data) + F.lit(1)).cast("bigint").alias("size"),
        F.crc32(data).alias("text_crc32"),
        F.unhex(F.sha2(data, 256)).alias("_digest"),
    )
    return store.written(narrow, "sizes")


def _in_order(sizes: DataFrame) -> DataFrame:
    """Documents group by group with ``_start``, the size of all before, ``place``, and ``_head``
    for the first of a group. A text of very many copies is one row per partition of the sum,
    and the rebalance hint lets Spark split its documents in the join."""
    head = F.min(F.struct(F.col("_id").isNull().alias("unnamed"), F.col("_id").alias("id"), F.col("_row").alias("row")))
    groups = sizes.groupBy("_digest").agg(head.alias("_first")).hint("rebalance")
    joined = sizes.join(groups, "_digest").withColumn("_head", F.col("_first.row") == F.col("_row"))
    # The head comes first, then its copies by id; the row parts rows that are alike in all else.
    ordered = joined.orderBy(F.col("_first.id").asc_nulls_last(), "_digest", F.col("_id").asc_nulls_last(), "_row")
    return ordering.placed(ordered.drop("_digest", "_first"), {"_start": "size"}, "documents")


class Ends:
    """What the driver knows of the groups' ends: the first and last end in each bin looked at.

    What lies within a bin between the two, and outside of the stretches last looked at, is not
    known; the latter is never asked for, as every cut of an open capacity lies in a stretch.
    """

    def __init__(self, total: int):
        self.total = total
        self.first: list[int] = []
        self.last: list[int] = []

    def put(self, bins: list[tuple[int, int]]) -> None:
        """Exchange what is known for finer bins, sorted; the total is always an end."""
        bins = sorted({*bins, (self.total, self.total)})
        self.first, self.last = [a for a, _ in bins], [b for _, b in bins]

    def up_to(self, x: int) -> tuple[int, int]:
        """The least and the greatest that the largest end up to ``x`` can be; 0 where there is none."""
        at = bisect_right(self.first, x) - 1
        if at < 0:
            return 0, 0
        if self.last[at] <= x:
            return self.last[at], self.last[at]
        return self.first[at], x


def _cuts(ends: Ends, capacity: int, shards: int) -> list[tuple[int, int]]:
    """Where each shard may end if all are filled up to ``capacity``: bounds of each end."""
    low = high = 0
    out = []
    for _ in range(shards):
        low, high = ends.up_to(low + capacity)[0], ends.up_to(high + capacity)[1]
        out.append((low, high))
    return out


def _feasible(ends: Ends, capacity: int, shards: int) -> bool | None:
    """Whether the shards hold everything; None where the bins do not tell."""
    low, high = _cuts(ends, capacity, shards)[-1]
    return True if low >= ends.total else False if high < ends.total else None


def _search(ends: Ends, low: int, high: int, shards: int) -> tuple[int, int]:
    """Narrow the least feasible capacity, which lies in (low, high], as far as the bins tell."""
    def narrowed(begin: int, end: int, answers: tuple) -> int:
        """The last in [begin, end) whose answer is among ``answers``, which hold up to some point."""
        while end - begin > 1:
            middle = (begin + end) // 2
            if _feasible(ends, middle, shards) in answers:
                begin = middle
            else:
                end = middle
        return begin

    low = narrowed(low, high, (False,))
    return low, narrowed(low, high, (False, None)) + 1


def _look(heads: DataFrame, stretches: list[tuple[int, int]], width: int) -> list[tuple[int, int]]:
    """The first and last group end in each bin of ``width`` of the stretches [low, high]."""
    end = F.col("_start")
    number, before = F.lit(None).cast("bigint"), 0
    for low, high in stretches:
        inside = F.floor((end - F.lit(low)) / F.lit(width)).cast("bigint") + F.lit(before)
        number = F.when(end.between(low, high), inside).otherwise(number)
        before += -(-(high - low + 1) // width)
    found = heads.where(end > 0).select(end, number.alias("bin")).where(F.col("bin").isNotNull())
    rows = found.groupBy("bin").agg(F.min("_start").alias("first"), F.max("_start").alias("last")).collect()
    return [(r["first"], r["last"]) for r in rows]


def _joined(stretches: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for low, high in sorted(stretches):
        if out and low <= out[-1][1] + 1:
            out[-1] = (out[-1][0], max(high, out[-1][1]))
        else:
            out.append((low, high))
    return out


def least_capacity(heads: DataFrame, total: int, shards: int, bins: int = BINS) -> tuple[int, list[int]]:
    """The least feasible capacity of the groups that begin at ``_start``, and the ends of the shards."""
    ends = Ends(total)
    low, high = -(-total // shards) - 1, total
    stretches, width = [(1, max(1, total))], 2 * total
    while True:
        # About ``bins`` bins, but always finer ones than before, so the looks come to an end.
        width = max(1, min(width // 2, -(-sum(b - a + 1 for a, b in stretches) // bins)))
        ends.put(_look(heads, stretches, width))
        low, high = _search(ends, low, high, shards)
        at_least, at_most = _cuts(ends, low + 1, shards), _cuts(ends, high, shards)
        if high - low == 1 and all(a == b for a, b in at_most):
            return high, [end for end, _ in at_most]
        stretches = _joined([(a, b) for (a, _), (_, b) in zip(at_least, at_most, strict=True)])


def assign(
    docs: DataFrame, shards: int = 16, columns: Sequence[str] = ("doc_id",), text_column: str = "text", id_column: str = "doc_id", bins: int = BINS
) -> DataFrame:
    """``columns`` with size, text_crc32, shard and slot (the place within its shard) of every document."""
    added = ("size", "text_crc32", "shard", "slot")
    if shards < 1 or bins < 1:
        raise ValueError("give a shard and a bin at least")
    if taken := set(columns) & set(added):
        raise ValueError(f"the documents already have {', '.join(sorted(taken))}; leave them out of the columns")
    # Columns are numbered, so that no name of theirs clashes with one used in between.
    own = {c: f"c{i}" for i, c in enumerate(columns)}
    read = docs.select(*(F.col(c).alias(x) for c, x in own.items()), F.col(text_column).alias("_text"), F.col(id_column).alias("_id"))
    placed = store.written(_in_order(_sizes(read, tuple(own.values()))), "placed")
    total = placed.agg(F.sum("size")).first()[0] or 0
    ends = least_capacity(placed.where("_head"), total, shards, bins)[1] if total else []
    cuts = sorted({end for end in ends if end < total})
    at_cuts = placed.where(F.col("_head") & F.col("_start").isin([0, *cuts])).select("_start", "place").collect()
    first = {r["_start"]: r["place"] for r in at_cuts}
    shard, begin = F.lit(0), F.lit(first.get(0, 1)).cast("bigint")
    for k, cut in enumerate(cuts, 1):
        beyond = F.col("_start") >= cut
        shard, begin = F.when(beyond, F.lit(k)).otherwise(shard), F.when(beyond, F.lit(first[cut])).otherwise(begin)
    return placed.select(
        *(F.col(x).alias(c) for c, x in own.items()), "size", "text_crc32", shard.alias("shard"), (F.col("place") - begin).alias("slot")
    )


def write(docs: DataFrame, path: str, shards: int = 16, text_column: str = "text", id_column: str = "doc_id") -> DataFrame:
    """Write the documents, all columns, in a folder per shard, in the order of their slots within
    and across its files; returns what was written. Texts pass the sort here, as they move anyway."""
    assigned = assign(docs, shards, docs.columns, text_column, id_column)
    ordered = assigned.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot")
    ordered.write.partitionBy("shard").parquet(path)
    return docs.sparkSession.read.parquet(path)
