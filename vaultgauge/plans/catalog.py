"""From table and column names to the catalog of the vault. Works on metadata only: one row per table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vaultgauge import rules
from vaultgauge.functions import naming
from vaultgauge.functions.sqltext import literal
from vaultgauge.settings import Settings
from vaultgauge.sources.vault import Vault

AUDIT_COLUMNS = {
    rules.LOAD_DTS: "load_dts_col",
    rules.RECORD_SOURCE: "record_source_col",
    rules.HASH_DIFF: "hash_diff_col",
}


class EmptyVaultError(Exception):
    """The database holds no hub, link or satellite."""


def all_columns(vault: Vault) -> DataFrame:
    """Every table of the database with its columns in order, upper-cased."""
    return vault.columns_of(list(range(len(vault.names)))).selectExpr(
        "upper(source_name) AS table_name", "posexplode(transform(column_names, c -> upper(c))) AS (ordinal, column_name)"
    )


def classified(listing: DataFrame, settings: Settings) -> DataFrame:
    """Every listed table with its kind."""
    return listing.selectExpr("*", "upper(source_name) AS table_name").selectExpr(
        "*", f"{naming.table_kind('table_name', settings.prefixes)} AS table_type"
    )


def catalog(vault: Vault, settings: Settings) -> DataFrame:
    """One row per vault table: kind, upper-cased columns, audit columns, hash keys and own key. Columns are listed
    for vault tables only."""
    listed = classified(vault.listing(), settings).filter(f"table_type <> {literal(rules.OTHER)}")
    columns = vault.columns_of([r.position for r in listed.collect()])
    tables = (
        classified(columns, settings)
        .selectExpr("*", "transform(column_names, c -> upper(c)) AS columns")
        .selectExpr(
            "*",
            f"{naming.hash_keys('columns')} AS hk_columns",
            f"{naming.conventional_key('table_name', 'table_type', settings.prefixes)} AS conventional_hk",
        )
    )
    audit_columns = [
        f"{naming.audit_column('columns', settings.synonyms[logical], settings.fuzzy_rules[logical])} AS {name}"
        for logical, name in AUDIT_COLUMNS.items()
    ]
    return tables.selectExpr("*", f"{naming.own_key('conventional_hk', 'hk_columns')} AS own_hk", *audit_columns)


# Expression: the foreign keys of a link, the parent key of a satellite.
REFERENCED_KEYS = """CASE table_type WHEN 'LINK' THEN filter(hk_columns, k -> k <> own_hk)
                                     WHEN 'SAT' THEN array_compact(array(own_hk)) END"""


def owners(tables: DataFrame, settings: Settings) -> DataFrame:
    """One row per hash key that a hub or link is keyed on, with that table. Of several such tables the last one
    counts, and links come after hubs."""
    found = tables.filter("table_type IN ('HUB', 'LINK') AND own_hk IS NOT NULL")
    if settings.strict_parents:
        found = found.filter("own_hk = conventional_hk")
    last = "max_by(struct(table_name, source_name), struct(table_type = 'LINK', position))"
    return (
        found.groupBy(F.expr("own_hk AS key_column"))
        .agg(F.expr(f"{last} AS owner"))
        .selectExpr("key_column", "owner.table_name AS parent_name", "owner.source_name AS parent_source_name")
    )


def references(tables: DataFrame, settings: Settings) -> DataFrame:
    """One row per foreign key of a link and per parent key of a satellite, with the table that owns the key."""
    keys = tables.selectExpr("table_name", f"posexplode({REFERENCED_KEYS}) AS (reference_no, key_column)")
    return keys.join(owners(tables, settings), "key_column", "left").select(
        "table_name", "reference_no", "key_column", "parent_name"
    )


def diagnostics(tables: DataFrame) -> DataFrame:
    """Resolved audit columns per table and the names of those that could not be resolved."""
    missing = ", ".join(f"CASE WHEN {name} IS NULL THEN {literal(logical)} END" for logical, name in AUDIT_COLUMNS.items())
    return tables.selectExpr(
        "table_name", "table_type", *AUDIT_COLUMNS.values(), "hk_columns", f"array_compact(array({missing})) AS missing"
    )


def require_distinct_names(found: list) -> None:
    """Checks and results name tables in upper case; two tables of one such name would share their values."""
    by_name: dict[str, list[str]] = {}
    for r in found:
        by_name.setdefault(r.table_name, []).append(r.source_name)
    if clashes := [names for names in by_name.values() if len(names) > 1]:
        raise ValueError(f"Tables whose names differ by case only cannot be told apart: {clashes}")


def require_tables(found: list, vault: Vault, settings: Settings) -> None:
    if found:
        return
    names = ", ".join(vault.names[: rules.NAMES_IN_EMPTY_CATALOG_MESSAGE]) or "(none)"
    raise EmptyVaultError(
        f"'{settings.database}' holds no hub, link or satellite. It has {len(vault.names)} table(s), first of them: "
        f"{names}. Check the database and the name prefixes {settings.prefixes}."
    )
