"""Small helpers that write DuckDB oracle SQL text."""

from __future__ import annotations


def r8(expr: str, alias: str) -> str:
    return f"round({expr}, 8) AS {alias}"


def interp_cols(col: str, key: str, order: str, rn: str = "rn") -> str:
    """Select-list items computing the neighbours used by linear interpolation."""
    wb = f"(PARTITION BY {key} ORDER BY {order} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    wf = f"(PARTITION BY {key} ORDER BY {order} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"
    at = f"CASE WHEN {col} IS NOT NULL THEN {rn} END"
    return (
        f"last_value({col} IGNORE NULLS) OVER {wb} AS {col}_lo_v, "
        f"last_value({at} IGNORE NULLS) OVER {wb} AS {col}_lo_r, "
        f"first_value({col} IGNORE NULLS) OVER {wf} AS {col}_hi_v, "
        f"first_value({at} IGNORE NULLS) OVER {wf} AS {col}_hi_r"
    )


def interp_value(col: str, rn: str = "rn", fill_edges: bool = True) -> str:
    line = f"{col}_lo_v + ({col}_hi_v - {col}_lo_v) * ({rn} - {col}_lo_r) / ({col}_hi_r - {col}_lo_r)"
    tail = f" WHEN {col}_lo_r IS NOT NULL THEN {col}_lo_v ELSE {col}_hi_v" if fill_edges else ""
    return (
        f"CASE WHEN {col} IS NOT NULL THEN {col} "
        f"WHEN {col}_lo_r IS NOT NULL AND {col}_hi_r IS NOT NULL THEN {line}{tail} END"
    )


def rolling(agg: str, col: str, n: int, key: str, order: str) -> str:
    return f"{agg}({col}) OVER (PARTITION BY {key} ORDER BY {order} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"
