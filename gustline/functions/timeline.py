"""Time-slot arithmetic and bounded windows that stay parallel inside one series.

A reading's slot is its minute count since 1970 divided by the sampling interval. Every window with
a bounded reach runs on (series, chunk) partitions, a chunk being a fixed number of slots. Rows
within reach of a chunk edge are repeated in the neighbouring chunk and dropped again afterwards, so
a series that holds most of the data is still spread over many tasks.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

CHUNK_SLOTS = 2016


def minutes_since_epoch(ts: Column) -> Column:
    day = F.datediff(ts, F.to_date(F.lit("1970-01-01"))).cast("long")
    return day * 1440 + F.hour(ts) * 60 + F.minute(ts)


def slot_of(ts: Column, minutes: int) -> Column:
    return F.floor(minutes_since_epoch(ts) / F.lit(minutes)).cast("long")


def slot_start(slot: Column, minutes: int) -> Column:
    return F.lit("1970-01-01").cast("timestamp_ntz") + F.make_dt_interval(
        mins=(slot * minutes).cast("int")
    )


def chunk_span(back: int, ahead: int, span: int | None = None) -> int:
    return span or max(CHUNK_SLOTS, 4 * (back + ahead))


Stage = Callable[[WindowSpec], dict[str, Column]]


def over_slots(
    df: DataFrame,
    series: Sequence[str],
    minutes: int,
    back: int,
    ahead: int,
    columns: Stage | Sequence[Stage],
    ts: str = "ts",
    span: int | None = None,
    meet: Sequence[Column] | None = None,
    tasks: int | None = None,
) -> DataFrame:
    """Add window columns that look at most `back` slots behind and `ahead` slots forward.

    `df` must hold one row per (series, slot) on a regular grid. `columns` is one function from the
    window to new columns, or several applied in turn so that later ones may use earlier results;
    all share one shuffle and one sort. Columns named with a leading underscore are not returned.
    With `meet`, `df` may hold several rows per (series, slot): they become one row of these aggregates
    after the same shuffle, so only the rows as given are moved. `tasks` is the number of tasks of that shuffle: rows that are small when
    they are moved and wide afterwards need more tasks than their size tells Spark.
    """
    span = chunk_span(back, ahead, span)
    home = F.floor(F.col("_slot") / F.lit(span)).cast("long")
    first = F.floor((F.col("_slot") - ahead) / F.lit(span)).cast("long")
    last = F.floor((F.col("_slot") + back) / F.lit(span)).cast("long")
    frame = df.withColumn("_slot", slot_of(F.col(ts), minutes)).withColumn(
        "_chunk", F.explode(F.sequence(first, last)) if back or ahead else home
    )
    window = Window.partitionBy(*series, "_chunk").orderBy("_slot")
    names = list(df.columns)
    if tasks:
        frame = frame.repartition(tasks, *series, "_chunk")
    if meet:
        keys = [*series, "_chunk", "_slot", ts]
        frame = frame.repartition(*series, "_chunk").groupBy(*keys).agg(*meet)
        names = [*series, ts, *frame.columns[len(keys):]]
    for stage in [columns] if callable(columns) else columns:
        added = stage(window)
        names = [c for c in names if c not in added] + [c for c in added if not c.startswith("_")]
        frame = frame.select(
            *[c for c in frame.columns if c not in added],
            *[c.alias(name) for name, c in added.items()],
        )
    return frame.where(F.col("_chunk") == home).select(*names)


def regular_slots(
    series: DataFrame, low: Column, high: Column, minutes: int, span: int = CHUNK_SLOTS
) -> DataFrame:
    """One row per series and slot between two slots, produced chunk by chunk."""
    keys = series.columns
    chunks = series.select(
        *keys,
        low.alias("_low"),
        high.alias("_high"),
        F.explode(
            F.sequence(F.floor(low / F.lit(span)), F.floor(high / F.lit(span)))
        ).alias("_chunk"),
    ).repartition(*keys, "_chunk")
    first = F.greatest(F.col("_low"), F.col("_chunk") * span)
    last = F.least(F.col("_high"), F.col("_chunk") * span + (span - 1))
    slots = chunks.select(*keys, F.explode(F.sequence(first, last)).alias("_slot"))
    return slots.select(*keys, slot_start(F.col("_slot"), minutes).alias("ts"))


def run_positions(
    df: DataFrame,
    series: Sequence[str],
    minutes: int,
    is_hit: Column,
    name: str,
    ts: str = "ts",
    span: int = CHUNK_SLOTS,
) -> DataFrame:
    """Number the consecutive hits of each series; a miss restarts at 0.

    Runs may be longer than any chunk: positions are counted inside a chunk first, and the count
    left open at a chunk's end is carried over through one summary row per chunk.
    """
    keys = [*series, "_chunk"]
    marked = df.withColumn("_slot", slot_of(F.col(ts), minutes)).withColumn(
        "_chunk", F.floor(F.col("_slot") / F.lit(span)).cast("long")
    ).withColumn("_hit", F.coalesce(is_hit, F.lit(False)).cast("int"))
    inside = Window.partitionBy(*keys).orderBy("_slot")
    marked = marked.withColumn("_miss", F.sum(1 - F.col("_hit")).over(inside))
    island = Window.partitionBy(*keys, "_miss").orderBy("_slot")
    counted = marked.withColumn("_local", F.sum("_hit").over(island))
    edges = counted.groupBy(*keys).agg(
        F.max("_miss").alias("_misses"),
        F.max_by("_local", "_slot").alias("_open"),
    )
    along = Window.partitionBy(*series).orderBy("_chunk")
    edges = edges.withColumn(
        "_stretch", F.sum((F.col("_misses") > 0).cast("int")).over(along)
    )
    stretch = Window.partitionBy(*series, "_stretch").orderBy("_chunk")
    edges = edges.withColumn("_sofar", F.sum("_open").over(stretch))
    edges = edges.select(*keys, F.lag("_sofar", 1, 0).over(along).alias("_carry"))
    joined = counted.join(edges, keys)
    carried = F.when(F.col("_miss") == 0, F.col("_carry")).otherwise(F.lit(0))
    return joined.select(*df.columns, (F.col("_local") + carried).cast("long").alias(name))


def with_previous(df: DataFrame, series: Sequence[str], ts: str = "ts", days: int = 14) -> DataFrame:
    """Add `previous`, the series' last timestamp before this one, over gaps of any length.

    Neighbours are found inside fixed spans of days; the last timestamp of each span is carried to the
    next one through a table with one row per span. `df` holds distinct (series, ts).
    """
    span = F.floor(minutes_since_epoch(F.col(ts)) / F.lit(days * 1440)).cast("long")
    marked = df.withColumn("_span", span)
    keys = [*series, "_span"]
    local = marked.withColumn("_local", F.lag(ts).over(Window.partitionBy(*keys).orderBy(ts)))
    edges = marked.groupBy(*keys).agg(F.max(ts).alias("_max"))
    along = (Window.partitionBy(*series) if series else Window.partitionBy(F.lit(0))).orderBy("_span")
    carried = edges.select(*keys, F.lag("_max").over(along).alias("_carry"))
    return local.join(carried, keys).select(*df.columns, F.coalesce("_local", "_carry").alias("previous"))
