"""One vault table with everything the naming rules found out about it."""

from __future__ import annotations

from typing import NamedTuple


class Target(NamedTuple):
    name: str
    source_name: str
    table_type: str
    own_hk: str | None
    load_dts: str | None
    record_source: str | None
    hash_diff: str | None
    hk_columns: tuple[str, ...]
    references: dict[str, str | None]  # foreign or parent key -> table that owns it
    columns_error: str | None = None  # why its columns could not be listed
