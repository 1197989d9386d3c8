"""Column-expression helpers (all JVM-side, codegen-friendly)."""

from mercato.functions.scalar import (
    cents_to_double,
    day_diff,
    month_label,
    month_start,
    round_half_away,
    safe_div,
    to_cents,
    ts_literal,
)

__all__ = ["cents_to_double", "to_cents", "day_diff", "month_label", "month_start", "round_half_away", "safe_div", "ts_literal"]
