"""Naming conventions as SQL expressions over one row per table with an array of column names."""

from __future__ import annotations

import re

from vaultgauge.functions.sqltext import array_of, literal
from vaultgauge.rules import HASH_KEY_SUFFIX, OTHER


def table_kind(upper_name: str, prefixes: dict[str, list[str]]) -> str:
    branches = " ".join(
        f"WHEN startswith({upper_name}, {literal(start)}) THEN {literal(kind)}"
        for kind, starts in prefixes.items()
        for start in starts
    )
    return f"CASE {branches} ELSE {literal(OTHER)} END"


def without_prefix(upper_name: str, kind: str, prefixes: dict[str, list[str]]) -> str:
    branches = " ".join(
        f"WHEN {literal(k)} THEN regexp_replace({upper_name}, {literal('^(' + '|'.join(map(re.escape, starts)) + ')')}, '')"
        for k, starts in prefixes.items()
    )
    return f"CASE {kind} {branches} ELSE {upper_name} END"


def by_synonym(columns: str, synonyms: list[str]) -> str:
    """The synonym of highest priority among the columns (array_intersect keeps the order of its first argument)."""
    return f"get(array_intersect({array_of(synonyms)}, {columns}), 0)"


def by_fuzzy_rules(columns: str, fuzzy_rules: list[list[str]]) -> str:
    """The first column that holds all parts of the first rule any column satisfies."""
    found = [
        f"get(filter({columns}, name -> {' AND '.join(f'contains(name, {literal(p)})' for p in parts)}), 0)"
        for parts in fuzzy_rules
    ]
    return f"coalesce({', '.join(found)}, CAST(NULL AS STRING))"


def audit_column(columns: str, synonyms: list[str], fuzzy_rules: list[list[str]]) -> str:
    return f"coalesce({by_synonym(columns, synonyms)}, {by_fuzzy_rules(columns, fuzzy_rules)})"


def hash_keys(columns: str) -> str:
    return f"filter({columns}, name -> endswith(name, {literal(HASH_KEY_SUFFIX)}))"


def conventional_key(upper_name: str, kind: str, prefixes: dict[str, list[str]]) -> str:
    return f"concat({without_prefix(upper_name, kind, prefixes)}, {literal(HASH_KEY_SUFFIX)})"


def own_key(candidate: str, keys: str) -> str:
    return f"CASE WHEN array_contains({keys}, {candidate}) THEN {candidate} ELSE get({keys}, 0) END"
