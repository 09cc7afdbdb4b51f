"""Sharding by proportional stratified interleaving (operator 4).

Rows of each source are put in a seeded pseudorandom order and ranked. The rank as a fraction of the source's rows is the
row's place between 0 and 1; all rows are sorted by it and the order is cut into shards whose counts differ by one at most. Each
shard, and each stretch of a shard, so holds the sources in the proportions of the whole.

Ranks and positions come from running sums over buckets of about a thousand rows: no source and no order is ever in one task.

Defined results: rows with a null source are a source of their own; null and empty texts are rows like others; rows that are
equal in all of source, doc_id and text are interchangeable; other columns pass through; an empty table has no shards.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gustline.llm.order import buckets, packed, running
from gustline.session import write_stage

SHARDS, SEED = 8, 17


def interleaved(docs: DataFrame, shards: int = SHARDS, seed: int = SEED, keys: tuple[str, ...] = ("doc_id", "text")) -> DataFrame:
    """docs with shard and slot (place in the shard, from 0), which take the place of columns of these names. `keys` are the columns that tell
    rows of a source apart."""
    spark = docs.sparkSession
    rows, names = packed(docs)
    source = F.coalesce(F.concat(F.lit("="), F.col("row_.source")), F.lit(""))
    tie = F.xxhash64(F.lit(seed + 1), *[F.col(f"row_.{c}") for c in keys])
    rows = rows.select("row_", source.alias("s_"), F.xxhash64(F.lit(seed), *[F.col(f"row_.{c}") for c in keys]).alias("h_"), tie.alias("t_"), F.lit(1).alias("one_"))
    sizes = spark.read.parquet(write_stage(rows.groupBy("s_").agg(F.count("*").alias("n_")), "sources"))
    total = sizes.agg(F.sum("n_")).first()[0] or 0
    parts = buckets(total)
    rows = rows.withColumn("b_", F.pmod(F.col("h_"), F.lit(parts)))
    ranked = running(rows, ["s_"], "b_", [F.col("h_"), F.col("t_")], "one_", "rank_").drop("b_")
    own = sizes.select(F.col("s_").alias("own_"), "n_")
    placed = ranked.join(own, F.col("s_") == F.col("own_")).withColumn("place_", (F.col("rank_") + 0.5) / F.col("n_"))
    placed = placed.withColumn("b_", F.floor(F.col("place_") * parts)).select("row_", "s_", "rank_", "place_", "one_", "b_")
    cut = running(placed, [], "b_", [F.col("place_"), F.col("s_"), F.col("rank_")], "one_", "at_")
    cut = cut.withColumn("shard", F.expr(f"at_ * {shards} div {max(total, 1)}").cast("int"))
    first = F.expr(f"(shard * {total} + {shards - 1}) div {shards}")
    return cut.select(*[F.col(f"row_.`{c}`").alias(c) for c in names if c.lower() not in ("shard", "slot")], "shard", (F.col("at_") - first).cast("long").alias("slot"))


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    light = docs.select("doc_id", "source", (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
                        F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"))
    return interleaved(light, keys=("doc_id", "text_crc32", "size")).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


QUERIES = {"op4_sharding": op4_sharding}
ORACLE: dict[str, str] = {}
