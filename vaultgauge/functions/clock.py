"""Load times and day boundaries."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from vaultgauge.functions.sqltext import quoted
from vaultgauge.settings import Settings

TEXT = (T.StringType, T.CharType, T.VarcharType)
TIME = (T.TimestampType, T.TimestampNTZType, T.DateType)


class LoadTime(NamedTuple):
    raw: str
    value: str  # as timestamp; NULL where a text is no timestamp
    dtype: T.DataType

    @property
    def is_text(self) -> bool:
        return isinstance(self.dtype, TEXT)

    @property
    def is_usable(self) -> bool:
        return isinstance(self.dtype, TEXT + TIME)

    def extreme(self, function: str) -> str:
        """The first or last load time (min, max) as an aggregate. Dates are cast afterwards, so that it can be pushed down."""
        if isinstance(self.dtype, T.DateType):
            return f"CAST({function}({self.raw}) AS TIMESTAMP)"
        return f"{function}({self.value})"

    def within(self, low: str, high: str | None = None) -> str | None:
        """A condition on the stored column that a scan can push down, from one date to another. It keeps a day more
        on either side, so it never decides what is counted. Text has no such condition."""
        if self.is_text or not self.is_usable:
            return None
        stored = self.dtype.simpleString()
        condition = f"{self.raw} >= CAST({low} - 1 AS {stored})"
        return f"({condition} AND {self.raw} < CAST({high} + 2 AS {stored}))" if high else f"({condition})"


def column_type(df: DataFrame, name: str) -> T.DataType:
    wanted = name.upper()
    found = [f.dataType for f in df.schema if f.name.upper() == wanted]
    if len(found) != 1:
        raise ValueError(f"column {name} occurs {len(found)} times")
    return found[0]


def load_time(df: DataFrame, name: str) -> LoadTime:
    raw = quoted(name)
    dtype = column_type(df, name)
    if isinstance(dtype, TEXT):
        value = f"try_cast({raw} AS TIMESTAMP)"
    elif isinstance(dtype, TIME):
        value = f"CAST({raw} AS TIMESTAMP)"
    else:
        value = "CAST(NULL AS TIMESTAMP)"
    return LoadTime(raw, value, dtype)


def day(settings: Settings, days_ago: int) -> str:
    return f"date_sub({settings.today}, {days_ago})"


def on_day(value: str, settings: Settings, days_ago: int) -> str:
    """Compares with constants, so no row needs calendar arithmetic."""
    return (
        f"({value} >= CAST({day(settings, days_ago)} AS TIMESTAMP)"
        f" AND {value} < CAST({day(settings, days_ago - 1)} AS TIMESTAMP))"
    )
