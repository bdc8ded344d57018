"""Exact deduplication as a stateful stream.

Digests of the texts are streamed through a keyed aggregation whose state lives in RocksDB and never expires: per digest
the identifier that stays, where its content lies, and the number of rows. Whatever shares a digest is then compared byte
by byte with the text that stays; texts that differ in spite of equal digests are regrouped by their bytes.

Native: DataFrame and Structured Streaming operators only.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vaultgauge.llm.shared import shared_folder, text_of, written

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def normalised(text: Column) -> Column:
    """Lower-cases A-Z only. lower() does the same for pure ASCII and is much faster than translate()."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def sha256(body: Column) -> Column:
    return F.sha2(body, 256)


def exact_groups(
    docs: DataFrame,
    digest: Callable[[Column], Column] = sha256,
    bytes_per_batch: int = 64 << 30,
) -> DataFrame:
    """One row per row of docs: doc_id, digest, keep_id, group_size, kept, content_file.

    Rows are equal when their texts are, lower-casing A-Z only; null text is empty. The largest doc_id of a group stays
    (a null id is smaller than any other). Of rows that repeat the same id and text one is kept. content_file is the file that held
    the text that stays ('' where docs isn't read from files). An empty table gives no row. Other columns of docs are ignored.
    digest maps the normalised text to a string; bytes_per_batch bounds a micro-batch of the stream.
    """
    spark = docs.sparkSession
    folder = shared_folder(spark, "exact-dedup")
    body = normalised(text_of())
    rows = written(
        docs.select("doc_id", digest(body).cast("string").alias("digest"), F.input_file_name().alias("content_file")),
        f"{folder}/rows",
    )
    state = (
        _streamed(spark, rows, folder, bytes_per_batch)
        .groupBy("digest")
        .agg(F.max_by(F.struct("keeper", "group_size"), "batch").alias("s"))  # the state as the last batch left it
        .select("digest", F.col("s.keeper.doc_id").alias("keep_id"), "s.keeper.content_file", "s.group_size")
    )
    ids = rows.groupBy("digest", "doc_id").agg(F.count("*").alias("n_rows"))
    bodies = docs.select("doc_id", body.alias("body")).withColumn("digest", digest(F.col("body")).cast("string"))
    collisions = written(_differing(bodies, state), f"{folder}/collisions")
    grouped = ids.join(state, "digest")
    if not collisions.isEmpty():
        grouped = grouped.join(collisions, "digest", "left_anti").unionByName(_by_bytes(bodies, collisions, state))
    return grouped.select(
        "doc_id", "digest", "keep_id", "group_size", "content_file", F.explode(F.sequence(F.lit(1), F.col("n_rows").cast("int"))).alias("copy")
    ).select(
        "doc_id", "digest", "keep_id", "group_size",
        (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)).alias("kept"), "content_file",
    )


def _streamed(spark: SparkSession, rows: DataFrame, folder: str, bytes_per_batch: int) -> DataFrame:
    """Runs the digests through the keyed state; each batch writes the states that it changed, which are returned."""
    session = spark.newSession()  # own settings, the caller's stay as they are
    session.conf.set("spark.sql.shuffle.partitions", spark.conf.get("spark.sql.shuffle.partitions"))
    session.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    session.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")
    session.conf.set("spark.sql.streaming.stateStore.rocksdb.allowFAllocate", "false")  # else each state reserves some MB
    changed = (
        session.readStream.schema(rows.schema)
        .option("maxBytesPerTrigger", bytes_per_batch)
        .parquet(f"{folder}/rows")
        .groupBy("digest")
        .agg(F.max(F.struct("doc_id", "content_file")).alias("keeper"), F.count("*").alias("group_size"))
    )

    def write(batch: DataFrame, number: int) -> None:
        batch.withColumn("batch", F.lit(number).cast("bigint")).write.mode("overwrite").parquet(f"{folder}/state/{number}")

    write(session.createDataFrame([], changed.schema), -1)  # so that there is a table, too, when there is no row
    query = (
        changed.writeStream.outputMode("update")
        .option("checkpointLocation", f"{folder}/stream")
        .trigger(availableNow=True)
        .foreachBatch(write)
        .start()
    )
    query.awaitTermination()
    return spark.read.schema(changed.withColumn("batch", F.lit(0).cast("bigint")).schema).parquet(f"{folder}/state/*")


def _differing(bodies: DataFrame, state: DataFrame) -> DataFrame:
    """Digests of groups in which some text isn't, byte by byte, the text that stays."""
    hits = state.where("group_size > 1").select("digest", "keep_id")
    members = bodies.join(hits, "digest")
    stays = F.col("doc_id").eqNullSafe(F.col("keep_id"))
    keepers = members.where(stays).groupBy("digest").agg(F.min("body").alias("keeper_body"), F.max("body").alias("other_body"))
    same_id = keepers.where(F.col("keeper_body") != F.col("other_body")).select("digest")  # one id, several texts
    return members.where(~stays).join(keepers, "digest").where(F.col("body") != F.col("keeper_body")).select("digest").union(same_id).distinct()


def _by_bytes(bodies: DataFrame, collisions: DataFrame, state: DataFrame) -> DataFrame:
    """The groups of these digests, told apart by their bytes."""
    members = bodies.join(collisions, "digest", "left_semi").groupBy("digest", "body", "doc_id").agg(F.count("*").alias("n_rows"))
    groups = members.groupBy("digest", "body").agg(F.max("doc_id").alias("keep_id"), F.sum("n_rows").alias("group_size"))
    return members.join(groups, ["digest", "body"]).select(
        "digest", "doc_id", "n_rows", "keep_id", F.lit("").alias("content_file"), "group_size"
    )


def exact_dedup(docs: DataFrame) -> DataFrame:
    """The rows of docs that stay, with all their columns: one of each group of equal texts, that of the largest doc_id."""
    name = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("null"))  # noqa: E731  null ids are one key
    kept = exact_groups(docs).where("kept").select(F.col("digest").alias("__digest"), name("doc_id").alias("__id"))
    return (
        docs.withColumns({"__digest": sha256(normalised(text_of())), "__id": name("doc_id")})
        .join(kept, ["__digest", "__id"], "left_semi")
        .dropDuplicates(["__digest", "__id"])
        .drop("__digest", "__id")
        .select(*docs.columns)
    )
