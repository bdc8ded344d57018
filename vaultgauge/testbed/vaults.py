"""The two vaults of FIXTURES.md: views with planted defects over the given tables.

The text of each view runs in Spark and in DuckDB; {name} stands for a base table.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from vaultgauge.settings import Settings
from vaultgauge.sources.vault import Vault

AS_OF = "2024-01-30 12:00:00"
BASE_TABLES = ("customer", "orders", "lineitem", "events")

MAIN_VIEWS = {
    "hub_customer": """
        SELECT CASE WHEN c_custkey % 500 = 99 THEN NULL ELSE md5(CAST(c_custkey AS STRING)) END AS customer_hk, c_custkey AS customer_bk,
            CAST('2024-01-29 08:00:00' AS TIMESTAMP) AS load_dts, 'crm' AS record_source
        FROM {customer}
        UNION ALL SELECT md5(CAST(c_custkey AS STRING)), c_custkey,
            CAST('2024-01-29 09:00:00' AS TIMESTAMP), 'crm'
        FROM {customer}
        WHERE c_custkey % 100 = 1
    """,
    "hub_order": """
        SELECT md5(CAST(o_orderkey AS STRING)) AS order_hk, o_orderkey AS order_bk, CAST(o_orderdate AS TIMESTAMP) AS load_date, o_orderpriority AS rec_src
        FROM {orders}
    """,
    "hub_user": """
        SELECT md5(CAST(user_id AS STRING)) AS user_hk, user_id AS user_bk, CAST(min(ts) AS TIMESTAMP) AS batch_ts,
            CASE WHEN user_id % 10 = 3 THEN NULL ELSE 'web' END AS src_name
        FROM {events}
        WHERE user_id % 50 <> 0
        GROUP BY user_id
    """,
    "link_customer_order": """
        SELECT CASE WHEN o_orderkey % 777 = 5 THEN NULL ELSE md5(concat(CAST(o_custkey AS STRING), '|', CAST(o_orderkey AS STRING))) END AS customer_order_hk,
            CASE WHEN o_orderkey % 97 = 0 THEN NULL WHEN o_orderkey % 1000 = 7 THEN md5(concat('missing', CAST(o_orderkey AS STRING))) ELSE md5(CAST(o_custkey AS STRING)) END AS customer_hk,
            md5(CAST(o_orderkey AS STRING)) AS order_hk, CAST(o_orderdate AS TIMESTAMP) AS load_dts,
            CASE WHEN o_orderkey % 200 = 0 THEN 'edi' ELSE 'erp' END AS record_source
        FROM {orders}
        UNION ALL SELECT md5(concat(CAST(o_custkey AS STRING), '|', CAST(o_orderkey AS STRING))),
            md5(CAST(o_custkey AS STRING)),
            md5(CAST(o_orderkey AS STRING)), CAST(o_orderdate AS TIMESTAMP), 'erp'
        FROM {orders}
        WHERE o_orderkey % 250 = 3
    """,
    "sat_customer": """
        SELECT md5(CAST(c_custkey AS STRING)) AS customer_hk, c_name, c_mktsegment,
            CASE WHEN c_custkey % 300 = 5 THEN NULL ELSE CAST('2024-01-30 06:00:00' AS TIMESTAMP) END AS load_dts,
            CASE WHEN c_custkey % 250 = 11 THEN NULL ELSE md5(concat(c_name, '|', c_mktsegment)) END AS hash_diff,
            CASE WHEN c_custkey % 2 = 0 THEN 'crm' ELSE 'web' END AS record_source
        FROM {customer}
        UNION ALL SELECT md5(CAST(c_custkey AS STRING)), c_name, c_mktsegment,
            CAST('2024-01-30 06:00:00' AS TIMESTAMP),
            md5(concat(c_name, '|', c_mktsegment)), 'crm'
        FROM {customer}
        WHERE c_custkey % 100 = 42
    """,
    "sat_user": """
        SELECT CASE WHEN event_id % 1000 = 1 THEN NULL ELSE md5(CAST(user_id AS STRING)) END AS user_hk, event_type, value,
            CAST(CASE WHEN event_id % 4 = 0 THEN CAST('2024-01-30 06:00:00' AS TIMESTAMP) ELSE ts END AS TIMESTAMP) AS load_timestamp,
            md5(event_type) AS hashdiff, event_type AS source_system
        FROM {events}
    """,
    "s_user_daily": """
        SELECT md5(CAST(user_id AS STRING)) AS user_hk, CAST(ts AS TIMESTAMP) AS loaded_at,
            md5(concat(CAST(event_id AS STRING), event_type)) AS row_hash, event_type AS data_source
        FROM {events}
        WHERE ts < CAST('2024-01-30 00:00:00' AS TIMESTAMP)
    """,
    "sat_empty": """
        SELECT md5(CAST(o_orderkey AS STRING)) AS order_hk, CAST(o_orderdate AS TIMESTAMP) AS load_dts,
            md5(o_orderstatus) AS hash_diff, o_orderstatus AS record_source
        FROM {orders}
        WHERE o_orderkey < 0
    """,
    "orders_raw": """
        SELECT o_orderkey, o_orderdate
        FROM {orders}
    """,
}

QUIRK_VIEWS = {
    "h_order": """
        SELECT md5(CAST(o_orderkey AS STRING)) AS order_hk
        FROM {orders}
    """,
    "l_order_part": """
        SELECT md5(CAST(l_orderkey AS STRING)) AS order_hk,
            md5(CAST(l_partkey AS STRING)) AS part_hk
        FROM {lineitem}
        WHERE l_orderkey % 3 <> 0
    """,
    "s_order": """
        SELECT md5(CAST(o_orderkey AS STRING)) AS order_hk,
            md5(o_orderstatus) AS payload_hash, CAST(o_orderdate AS TIMESTAMP) AS payload_at
        FROM {orders}
    """,
}


def frames(spark: SparkSession, sf_dir: str, views: dict[str, str]) -> dict[str, DataFrame]:
    used = {b for b in BASE_TABLES for sql in views.values() if "{" + b + "}" in sql}
    base = {b: spark.read.parquet(f"{sf_dir.rstrip('/')}/{b}.parquet") for b in sorted(used)}
    return {
        name: spark.sql(sql, **{b: df for b, df in base.items() if "{" + b + "}" in sql}) for name, sql in views.items()
    }


def main_vault(spark: SparkSession, sf_dir: str) -> Vault:
    return Vault.from_frames(spark, frames(spark, sf_dir, MAIN_VIEWS))


def quirk_vault(spark: SparkSession, sf_dir: str) -> Vault:
    return Vault.from_frames(spark, frames(spark, sf_dir, QUIRK_VIEWS))


BUCKETS = 8
# The key that each table of the main vault is bucketed by: that of its parent, where it has one.
BUCKET_KEYS = {
    "hub_customer": "customer_hk", "hub_order": "order_hk", "hub_user": "user_hk", "link_customer_order": "customer_hk",
    "sat_customer": "customer_hk", "sat_user": "user_hk", "s_user_daily": "user_hk", "sat_empty": "order_hk",
}


@contextmanager
def bucketed_main_vault(spark: SparkSession, sf_dir: str) -> Iterator[Vault]:
    """The main vault as bucketed tables of a database, which is dropped in the end."""
    database = f"vaultgauge_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {database}")
    try:
        for name, df in frames(spark, sf_dir, MAIN_VIEWS).items():
            writer = df.write
            if name in BUCKET_KEYS:
                writer = writer.bucketBy(BUCKETS, BUCKET_KEYS[name])
            writer.saveAsTable(f"{database}.{name}")
        yield Vault.from_database(spark, database)
    finally:
        spark.sql(f"DROP DATABASE {database} CASCADE")


def settings(**changes) -> Settings:
    return Settings(**{
        "database": "Main-Vault 1", "schema_label": "MAIN.VAULT", "as_of": AS_OF, "lenient_timestamps": False, **changes
    })


def duckdb_ctes(views: dict[str, str]) -> str:
    """The views as the WITH clause of a query."""
    plain = {b: b for b in BASE_TABLES}
    return "WITH " + ",\n".join(f"{name} AS ({sql.format(**plain).strip()})" for name, sql in views.items())
