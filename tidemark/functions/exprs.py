"""Column expressions shared by operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def slot_pick(slot: Column, weighted: list[tuple[str, int]]) -> Column:
    """Map an integer slot in [0, sum(weights)) to a value by cumulative weight."""
    expr, upper = None, 0
    for value, weight in weighted[:-1]:
        upper += weight
        cond = slot < upper
        expr = F.when(cond, F.lit(value)) if expr is None else expr.when(cond, F.lit(value))
    last = F.lit(weighted[-1][0])
    return last if expr is None else expr.otherwise(last)


def slot_pick_sql(slot_sql: str, weighted: list[tuple[str, int]]) -> str:
    """The same mapping as SQL text (used by the DuckDB oracle)."""
    parts, upper = [], 0
    for value, weight in weighted[:-1]:
        upper += weight
        parts.append(f"WHEN {slot_sql} < {upper} THEN '{value}'")
    return f"CASE {' '.join(parts)} ELSE '{weighted[-1][0]}' END"


def day_key(ts: Column | str) -> Column:
    """Partition key yyyyMMdd of a timestamp."""
    return F.date_format(ts, "yyyyMMdd")


def trunc_ms(ts: Column | str) -> Column:
    """Millisecond precision, keeping timestamp_ntz inputs as timestamp_ntz."""
    return F.date_trunc("MILLISECOND", ts)


def seconds_between(start: Column, end: Column) -> Column:
    """Whole seconds from start to end (TIMESTAMPDIFF(SECOND, start, end))."""
    return F.timestamp_diff("SECOND", start, end)


def first_match(rules: list[tuple[str, str]]) -> Column:
    """CASE over (condition SQL, label) pairs in order; NULL when no rule matches."""
    expr = None
    for cond, label in rules:
        c = F.expr(cond)
        expr = F.when(c, F.lit(label)) if expr is None else expr.when(c, F.lit(label))
    return expr


def any_match(rules: list[tuple[str, str]]) -> Column:
    cond = None
    for text, _ in rules:
        c = F.expr(text)
        cond = c if cond is None else (cond | c)
    return cond
