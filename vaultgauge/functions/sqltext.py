"""Names and literals in SQL text. Expressions that are built once per table are written as SQL text: one call to the
JVM each, however deep they are."""

from __future__ import annotations

from collections.abc import Iterable


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def array_of(texts: Iterable[str]) -> str:
    return "array(" + ", ".join(map(literal, texts)) + ")"


def quoted_where_needed(name: str) -> str:
    """Expression: the name held by a column, in backticks unless it is a plain word."""
    return (
        f"CASE WHEN {name} RLIKE '^[A-Za-z_][A-Za-z0-9_]*$' THEN {name} "
        f"ELSE concat('`', replace({name}, '`', '``'), '`') END"
    )
