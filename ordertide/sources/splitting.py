"""Ranges of a key that hold about equally many rows each, found by counts that the database makes.

Equal ranges of a sparse or skewed key leave one connection with most rows. Here the database
counts its rows in bins of the key; a bin with more than its share is counted again in finer
bins; neighbouring bins are then joined to as many ranges as there are connections. Only
counts come back, a bounded number of rows for each question.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from decimal import Decimal
from itertools import accumulate
from numbers import Real

#: Bins per range in the first question.
BINS = 16
#: How often heavy bins are counted again at most. Whole numbers of 64 bits are settled before.
LEVELS = 12

Ask = Callable[[str], Sequence[Sequence[object]]]


@dataclass(frozen=True)
class Bin:
    """Rows with low <= key < high."""

    low: Real
    high: Real
    rows: int


def _number(value: object) -> Real | None:
    """A bound as a number, whole where it can be; None for dates and all else."""
    if isinstance(value, bool) or not isinstance(value, (int, float, Decimal)):
        return None
    return int(value) if value == int(value) else float(value)


def counts_query(table: str, column: str, stretches: Sequence[tuple[Real, Real, Real]]) -> str:
    """Rows per bin of each stretch (low, high, width), as (stretch, bin, n)."""
    parts = []
    for i, (low, high, width) in enumerate(stretches):
        number = f"FLOOR(({column} - {_text(low)}) / {_text(width)})"
        parts.append(
            f"SELECT {i} AS stretch, {number} AS bin, COUNT(*) AS n FROM {table} "
            f"WHERE {column} >= {_text(low)} AND {column} < {_text(high)} GROUP BY {number}"
        )
    return f"({' UNION ALL '.join(parts)}) counts"


def _text(value: Real) -> str:
    """A number as every database reads it; a negative one in parentheses."""
    found = str(value) if isinstance(value, int) else repr(float(value))
    return f"({found})" if value < 0 else found


def _counted(ask: Ask, table: str, column: str, stretches: Sequence[tuple[Real, Real]], bins: int) -> list[Bin]:
    whole = all(isinstance(x, int) for stretch in stretches for x in stretch)
    asked = []
    for low, high in stretches:
        width = max(1, -(-(high - low) // bins)) if whole else (high - low) / bins
        asked.append((low, high, width))
    found = []
    for stretch, number, n in ask(counts_query(table, column, asked)):
        low, high, width = asked[int(stretch)]
        begin = low + int(number) * width
        found.append(Bin(begin, min(high, begin + width), int(n)))
    return sorted(found, key=lambda x: x.low)


def bins_of(ask: Ask, table: str, column: str, low: Real, high: Real, partitions: int) -> list[Bin]:
    """Non-empty bins of the key, none of which has more than half of a range's share of the rows,
    but for single values of a whole-number key, which no range can part."""
    end = high + 1 if isinstance(low, int) and isinstance(high, int) else high + max(abs(high), 1) * 1e-9
    found = _counted(ask, table, column, [(low, end)], partitions * BINS)
    share = max(1, sum(x.rows for x in found) // (2 * partitions))
    for _ in range(LEVELS):
        heavy = [x for x in found if x.rows > share and not (isinstance(x.low, int) and x.high - x.low <= 1)]
        if not heavy:
            break
        finer = _counted(ask, table, column, [(x.low, x.high) for x in heavy], 2 * BINS)
        found = sorted([x for x in found if x not in heavy] + finer, key=lambda x: x.low)
    return found


def cuts(bins: Sequence[Bin], partitions: int) -> list[Real]:
    """Where the second and each further range begins: as near as bins allow to equal counts."""
    ends = list(accumulate(x.rows for x in bins))
    out = []
    for k in range(1, partitions):
        wanted = ends[-1] * k / partitions if ends else 0
        at = bisect_left(ends, wanted)
        # The bin that the cut falls in goes to the side that it disturbs least.
        before = ends[at - 1] if at else 0
        cut = at if at < len(ends) and wanted - before <= ends[at] - wanted else at + 1
        if 0 < cut < len(bins):
            out.append(bins[cut].low)
    return sorted(set(out))


def predicates(column: str, starts: Sequence[Real]) -> list[str]:
    """Conditions of which each row meets one; null keys are in the first range."""
    if not starts:
        return ["1 = 1"]
    first = f"{column} < {_text(starts[0])} OR {column} IS NULL"
    inner = [
        f"{column} >= {_text(a)} AND {column} < {_text(b)}" for a, b in zip(starts[:-1], starts[1:], strict=True)
    ]
    return [first, *inner, f"{column} >= {_text(starts[-1])}"]


def balanced(ask: Ask, table: str, column: str, low: object, high: object, partitions: int) -> list[str] | None:
    """Conditions of ranges with about equal counts; None for keys that are not numbers, or so far
    apart that the database could not subtract them."""
    low, high = _number(low), _number(high)
    if low is None or high is None or (isinstance(high, int) and high - low >= 1 << 63):
        return None
    return predicates(column, cuts(bins_of(ask, table, column, low, high, partitions), partitions))
