"""Duplicate keys: how many key groups hold more than one row. NULLs count as equal."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vaultgauge.functions.clock import column_type
from vaultgauge.functions.sqltext import literal, quoted
from vaultgauge.functions.storage import stored

# Types whose equal values have equal hashes.
HASHABLE = (
    T.StringType, T.BinaryType, T.BooleanType, T.IntegralType, T.DecimalType,
    T.DateType, T.TimestampType, T.TimestampNTZType,
)
# Bits and bytes of one bitmap of Spark's bitmap functions.
BITMAP_BITS, BITMAP_BYTES = 32_768, 4096


def duplicate_groups(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One shuffle on all the keys. Copies collapse before it, so a key with most of the rows is one row per task."""
    copies = df.groupBy(*map(quoted, keys)).agg(F.expr("count(*) AS copies"))
    return copies.selectExpr("count(CASE WHEN copies > 1 THEN 1 END) AS value")


def duplicate_groups_of(df: DataFrame, key_sets: Mapping[str, Sequence[str]]) -> DataFrame:
    """slot, value: duplicate groups of several key sets of one table from one scan and one shuffle.

    Each row is grouped once per set, with the columns outside the set left out; the number of the set, not the NULLs that
    stand for these columns, tells the groups apart. Copies collapse before the shuffle, as with one set. Sets must differ.
    """
    columns = sorted({c.upper() for keys in key_sets.values() for c in keys})
    numbers = {}
    for slot, keys in key_sets.items():
        own = {k.upper() for k in keys}
        numbers[sum(1 << (len(columns) - 1 - i) for i, c in enumerate(columns) if c not in own)] = slot  # bits of columns left out
    if len(numbers) < len(key_sets):
        raise ValueError("two sets have the same keys")
    sets = [[F.col(quoted(c)) for c in columns if c in {k.upper() for k in keys}] for keys in key_sets.values()]
    groups = df.groupingSets(sets, *[F.col(quoted(c)) for c in columns]).agg(
        F.grouping_id().alias("set_number"), F.count(F.lit(1)).alias("copies")
    )
    found = groups.agg(
        *[F.count(F.when((F.col("set_number") == n) & (F.col("copies") > 1), 1)).alias(f"value_{n}") for n in numbers]
    )
    cells = ", ".join(f"{literal(slot)}, value_{n}" for n, slot in numbers.items())
    return found.selectExpr(f"stack({len(numbers)}, {cells}) AS (slot, value)")


def can_hash_first(df: DataFrame, keys: Sequence[str]) -> bool:
    types = [column_type(df, k) for k in keys]
    return all(isinstance(t, HASHABLE) and (not isinstance(t, T.StringType) or t.isUTF8BinaryCollation()) for t in types)


def duplicate_groups_hash_first(df: DataFrame, keys: Sequence[str], bitmap_bytes: int) -> DataFrame:
    """The same number for large tables whose rows are mostly no duplicates.

    The first round shuffles one 64-bit hash per row instead of the wide keys and marks the places (hash modulo a fixed
    number) of hashes that occur twice, one bit per place. Rows at other places cannot be duplicates, so the second round groups
    the rows at marked places by their full keys; rows that are there by chance change nothing, whatever their number. With no
    marked place there is no second round. So the table is read once more at most.
    The bitmaps have bitmap_bytes at most, which alone decides how many places there are, and are stored and broadcast.
    """
    bitmaps = bitmap_bytes // BITMAP_BYTES
    if bitmaps < 1:
        return duplicate_groups(df, keys)
    columns = [quoted(k) for k in keys]
    hash_of_keys = f"xxhash64({', '.join(columns)})"
    place = f"(pmod({{}}, {bitmaps * BITMAP_BITS}L) + 1)"  # the bitmap functions count from 1
    copies = df.selectExpr(f"{hash_of_keys} AS key_hash").groupBy("key_hash").agg(F.expr("count(*) AS copies"))
    marked = copies.filter("copies > 1").selectExpr(f"{place.format('key_hash')} AS place")
    marked = stored(
        marked.groupBy(F.expr("bitmap_bucket_number(place) AS bitmap_no")).agg(
            F.expr("bitmap_construct_agg(bitmap_bit_position(place)) AS bitmap")
        )
    )
    if marked.isEmpty():
        return df.sparkSession.range(1).selectExpr("0L AS value")
    own = [f"{c} AS key_{n}" for n, c in enumerate(dict.fromkeys(columns))]
    rows = df.selectExpr(*own, f"{place.format(hash_of_keys)} AS place").selectExpr(
        "*", "bitmap_bucket_number(place) AS bitmap_no", "bitmap_bit_position(place) AS bit"
    )
    byte = "conv(hex(substring(bitmap, int(bit div 8) + 1, 1)), 16, 10)"
    suspects = rows.join(F.broadcast(marked), "bitmap_no").where(f"shiftright(int({byte}), int(bit % 8)) & 1 = 1")
    return duplicate_groups(suspects, [f"key_{n}" for n in range(len(own))])
