"""Mixing sources to target weights with DataFrame functions only (operator 6).

The words of a source, its documents in a seeded pseudorandom order, are packed into blocks of fixed length. A source whose target
is t words fills t / block slots. Every slot draws its output shard at random, so that the source counts of a shard are
multinomial given its size, while every source keeps its target exactly. The j-th slot of a source maps to a block
by a pseudorandom permutation of the block indexes, one pass over all blocks after the other, and slots and blocks are joined by
(source, block). No block is taken more often than passes are begun, hence no document beyond the cap.

Targets: shares by weight (1, 2, 3, repeating over the sources by code point, null last) of all words, at most `cap` times the
source's words, the excess going to the others by weight until none is above.

Defined results: null, empty and blank texts have size 0 and are never taken; a null source is a source of its own; repeated
rows are documents of their own, interchangeable; other columns pass through `mixed`; an empty table gives an empty mix.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gustline.llm.order import buckets, running
from gustline.session import write_stage

WORD = r"[^\x20\x09-\x0D]+"
BLOCK, SHARD_BLOCKS, CAP, SEED, CHUNK = 64, 4096, 3, 17, 4096
PRIMES = (2147483647, 2147483629, 2147483587, 2147483579)


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sources: DataFrame, cap: int = CAP) -> DataFrame:
    """s_, source_size, target: weighted shares of all words with capped sources; one row per source in, one out."""
    whole = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ranked = sources.withColumn("w", F.row_number().over(Window.orderBy(F.col("s_") == "", "s_")) % 3)
    ranked = ranked.withColumn("w", F.when(F.col("w") == 0, 3).otherwise(F.col("w")).cast("double"))
    full = cap * F.col("source_size").cast("double")
    by_ratio = Window.orderBy(full / F.col("w"), "s_")
    earlier = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    level = (F.sum("source_size").over(whole) - F.coalesce(F.sum(full).over(earlier), F.lit(0.0))) / (
        F.sum("w").over(whole) - F.coalesce(F.sum("w").over(earlier), F.lit(0.0)))
    ranked = ranked.withColumn("level", level).withColumn("fits", F.when(F.col("level") <= full / F.col("w"), F.row_number().over(by_ratio)))
    ranked = ranked.withColumn("level", F.min(F.when(F.col("fits").isNotNull(), F.struct("fits", "level"))).over(whole)["level"])
    return ranked.select("s_", "source_size", F.coalesce(F.least(full, F.col("level") * F.col("w")), full).alias("target"))


class Mix:
    """Plan of a mix: `sources` with targets, `placed` documents (key columns, s_, size, start), `slots` and `taken` pieces."""

    def __init__(self, docs: DataFrame, keys: list[str], block: int = BLOCK, seed: int = SEED):
        """docs: the columns `keys`, source and size (words)."""
        spark = docs.sparkSession
        key = F.coalesce(F.concat(F.lit("="), "source"), F.lit(""))
        rows = docs.select(*keys, "size", key.alias("s_"))
        rows = spark.read.parquet(write_stage(rows, "sized"))
        found = rows.groupBy("s_").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_rows"))
        found = spark.read.parquet(write_stage(found, "found"))
        total = found.agg(F.sum("source_size"), F.sum("n_rows")).first()
        n = F.ceil(F.col("source_size") / block)
        passes = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
        rest = F.round(F.col("target") - F.col("passes") * F.col("source_size")).cast("long")
        plan = targets(found.select("s_", "source_size")).withColumn("n", n.cast("long")).withColumn("passes", passes.cast("long"))
        plan = plan.withColumn("rest", rest).withColumn(
            "n_slots", F.col("passes") * F.col("n") + F.ceil(F.col("rest") / block).cast("long"))
        self.sources = spark.read.parquet(write_stage(plan, "targets"))
        rows = rows.withColumn("h_", F.xxhash64(F.lit(seed), *keys)).withColumn("b_", F.pmod("h_", F.lit(buckets(total[1] or 0))))
        placed = running(rows, ["s_"], "b_", [F.col("h_"), *[F.col(k) for k in keys]], "size", "start").drop("h_", "b_")
        self.placed = spark.read.parquet(write_stage(placed, "placed"))

        shards = F.lit(max(1, (total[0] or 0) // (block * SHARD_BLOCKS)))
        chunk = self.sources.where("n_slots > 0").withColumn("c", F.explode(F.sequence(F.lit(0), F.expr(f"(n_slots - 1) div {CHUNK}"))))
        low = F.col("c") * CHUNK
        slots = chunk.repartition(F.col("s_"), F.col("c")).withColumn("j", F.explode(F.sequence(low, F.least(low + CHUNK, F.col("n_slots")) - 1)))
        step = F.coalesce(*[F.when(F.col("n") % p != 0, F.lit(p)) for p in PRIMES]).cast("decimal(12,0)")
        shift = F.pmod(F.xxhash64(F.lit(seed), "s_"), F.col("n"))
        index = ((F.col("j") % F.col("n")).cast("decimal(18,0)") * step + shift.cast("decimal(18,0)")) % F.col("n").cast("decimal(18,0)")
        last = (F.col("j") == F.col("n_slots") - 1) & (F.col("rest") % block > 0)
        self.slots = slots.select(
            "s_", "j", F.expr("j div n").cast("int").alias("pass"), index.cast("long").alias("block"),
            F.when(last, F.col("rest") % block).otherwise(block).alias("words"), F.pmod(F.xxhash64(F.lit(seed + 1), "s_", "j"), shards).alias("shard"))

        used = self.placed.where("size > 0")
        spread = used.withColumn("block", F.explode(F.expr(f"sequence(start div {block}, (start + size - 1) div {block})")))
        begin = F.greatest(F.col("start"), F.col("block") * block)
        end = F.least(F.col("start") + F.col("size"), F.col("block") * block + F.col("words"))
        # sizes after an explode are not known to the planner: a merge join, never a broadcast of slots
        self.taken = (spread.hint("merge").join(self.slots.hint("merge"), ["s_", "block"]).where(begin < end)
                      .select(*keys, "s_", "start", "pass", "shard", (begin - F.col("start")).alias("first"), (end - begin).alias("words")))

    def draws(self) -> DataFrame:
        """Slots of each source in each output shard."""
        return self.slots.groupBy("shard", "s_").agg(F.count("*").alias("slots"))


def mixed(docs: DataFrame) -> DataFrame:
    """Rows of docs as the mix takes them: a row per document and pass, with all columns, the text cut to the words taken.

    Words of one pass are joined by one space where any is left out; a text taken whole stays as it is. n_chars follows the text."""
    spark = docs.sparkSession
    names = docs.columns
    own = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row_"))
    own = own.withColumn("k1", F.xxhash64("row_")).withColumn("k2", F.xxhash64(F.lit(1), "row_"))
    counted = own.select("k1", "k2", F.col("row_.source").alias("source"), word_count(F.col("row_.text").cast("string")).alias("size"))
    # equal rows are told apart by a number, so that each is a document of its own
    counted = counted.groupBy("k1", "k2", "source", "size").agg(F.count("*").alias("copies"))
    counted = counted.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).drop("copies")
    mix = Mix(counted, ["k1", "k2", "copy"])
    pieces = mix.taken.groupBy("k1", "k2", "copy", "pass").agg(
        F.array_sort(F.collect_list(F.struct("first", "words"))).alias("pieces"), F.sum("words").alias("got"))
    pieces = spark.read.parquet(write_stage(pieces, "pieces"))
    text = F.col("row_.text").cast("string")
    whole = F.col("got") == word_count(text)
    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    cut = F.array_join(F.flatten(F.transform("pieces", lambda p: F.slice("words_", p["first"].cast("int") + 1, p["words"].cast("int")))), " ")
    rows = own.groupBy("k1", "k2").agg(F.first("row_").alias("row_")).join(pieces, ["k1", "k2"])
    rows = rows.withColumn("words_", F.when(~whole, words)).withColumn("text_", F.when(F.col("words_").isNull(), text).otherwise(cut))
    new = {"text": F.col("text_"), "n_chars": F.char_length("text_").cast("long")}
    return rows.select(*[new.get(c, F.col(f"row_.`{c}`")).alias(c) for c in names])


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    mix = Mix(docs.select("doc_id", "source", word_count(F.col("text")).alias("size")), ["doc_id"])
    got = mix.taken.groupBy(F.col("s_").alias("t_"), F.col("start").alias("at_")).agg(F.sum("words").alias("taken"))
    rows = mix.placed.join(mix.sources.select(F.col("s_").alias("own_"), "source_size", "target"), F.col("s_") == F.col("own_"))
    rows = rows.join(got.hint("merge"), (F.col("s_") == F.col("t_")) & (F.col("start") == F.col("at_")) & (F.col("size") > 0), "left")
    return rows.select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))


QUERIES = {"op6_mixing": op6_mixing}
ORACLE: dict[str, str] = {}
