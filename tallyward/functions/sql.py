"""Names and values as SQL text.

Reports with dozens of generated columns state them as SQL text: one call per column,
where a chain of column methods costs a call to the JVM for each of its links.
"""

from __future__ import annotations

from collections.abc import Mapping
from decimal import Decimal


def name(column: str) -> str:
    return "`" + column.replace("`", "``") + "`"


def literal(value: object) -> str:
    if isinstance(value, bool):
        return str(value).lower()
    if isinstance(value, int):
        return str(value)
    if isinstance(value, Decimal):
        return f"{value:f}BD"
    if isinstance(value, str):
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
    raise TypeError(f"no SQL literal for {value!r}")


def all_equal(values: Mapping[str, object]) -> str:
    """Test that every named column has its value."""
    return " AND ".join(f"{name(c)} = {literal(v)}" for c, v in values.items())
