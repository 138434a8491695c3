from ordertide.functions.columns import (
    calendar_parts,
    line_revenue,
    month_parts,
    missing,
    ratio,
    typed,
)

__all__ = ["calendar_parts", "line_revenue", "missing", "month_parts", "ratio", "typed"]
