"""SQL text for wide operators.

An operator on dozens of columns builds its expressions as text and hands them over in one call;
building them one Column at a time costs a driver round trip for each part.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def listed(names: Sequence[str]) -> str:
    return ", ".join(quoted(n) for n in names)


def over(
    keys: Sequence[str], order: Sequence[str] = (), reverse: bool = False, frame: str = ""
) -> str:
    """``OVER (…)`` with the order of all columns reversed if asked."""
    parts = [f"PARTITION BY {listed(keys)}"] if keys else []
    if order:
        way = " DESC" if reverse else ""
        parts.append("ORDER BY " + ", ".join(quoted(c) + way for c in order))
    if frame:
        parts.append(f"ROWS BETWEEN {frame}")
    return f"OVER ({' '.join(parts)})"


UP_TO = "UNBOUNDED PRECEDING AND CURRENT ROW"
BEFORE = "UNBOUNDED PRECEDING AND 1 PRECEDING"


def with_expressions(df: DataFrame, expressions: Mapping[str, str]) -> DataFrame:
    """Add or replace columns, in place, given as SQL text."""
    kept = [
        f"{expressions[c]} AS {quoted(c)}" if c in expressions else quoted(c) for c in df.columns
    ]
    added = [f"{e} AS {quoted(c)}" for c, e in expressions.items() if c not in df.columns]
    return df.selectExpr(*kept, *added)


def aggregates(expressions: Mapping[str, str]) -> list[Column]:
    return [F.expr(f"{e} AS {quoted(c)}") for c, e in expressions.items()]
