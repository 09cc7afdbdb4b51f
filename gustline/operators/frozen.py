"""Frozen signals: greedy runs of readings within a band of the run's first reading, however long they are.

A run is anchored at its first reading, so where it ends depends on where it began, and a series is one long path of runs. The path is cut into chunks
of slots. What a chunk does to a run that enters it is a small table: the first reading that leaves the band of an anchor `a` is always a new highest or lowest reading of
the chunk (or a missing one), and from there on the chunk's own readings settle the rest. The table lists these readings, and for each the runs that close
behind it and the run that is still open at the end. Tables of FAN neighbouring chunks are put together to one, and so on until a series has one table. No task holds more than one
chunk of readings or FAN tables, and a group of tables is never one series as a whole.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gustline.functions.joins import attach
from gustline.functions.timeline import slot_of
from gustline.session import write_stage
from gustline.settings import DEFAULTS, FarmSettings

FROZEN_BAND, FROZEN_LENGTH, CHUNK, FAN = 1.0, 5, 512, 64
#: Result of a path through a chunk: frozen runs closed, their readings, and start and anchor of the run still open (start -1: none).
Result = tuple[int, int, int, float]


@dataclass
class Table:
    """What a stretch of slots does to the run that enters it."""

    last: int  # last slot of the whole series
    begin: int
    end: int
    fresh: Result = (0, 0, -1, 0.0)  # without an open run
    highs: list[float] = field(default_factory=list)  # rising new highest readings, their slots and what follows from them
    high_at: list[int] = field(default_factory=list)
    high_to: list[Result] = field(default_factory=list)
    lows: list[float] = field(default_factory=list)
    low_at: list[int] = field(default_factory=list)
    low_to: list[Result] = field(default_factory=list)
    gap_at: int = -1  # first missing reading
    gap_to: Result = (0, 0, -1, 0.0)

    def closed(self, start: int, end: int) -> tuple[int, int]:
        frozen = end - start >= FROZEN_LENGTH and start <= self.last - FROZEN_LENGTH
        return (1, end - start) if frozen else (0, 0)

    def after(self, state: Result) -> Result:
        """The state behind the stretch from the state before it."""
        blocks, samples, start, anchor = state
        if start < 0:
            return (blocks + self.fresh[0], samples + self.fresh[1], *self.fresh[2:])
        up = int(np.searchsorted(np.asarray(self.highs) - anchor, FROZEN_BAND))
        down = int(np.searchsorted(anchor - np.asarray(self.lows), FROZEN_BAND))
        ends = [(self.high_at[up], self.high_to[up])] if up < len(self.highs) else []
        ends += [(self.low_at[down], self.low_to[down])] if down < len(self.lows) else []
        ends += [(self.gap_at, self.gap_to)] if self.gap_at >= 0 else []
        if not ends:
            return state
        at, to = min(ends, key=lambda e: e[0])
        one, length = self.closed(start, at)
        return (blocks + one + to[0], samples + length + to[1], *to[2:])


def table_of(values: np.ndarray, begin: int, last: int) -> Table:
    """The table of one chunk; a missing reading is NaN."""
    m, out = len(values), Table(last, begin, begin + len(values))
    missing = np.isnan(values)
    with np.errstate(invalid="ignore"):
        leaves = (np.abs(values[None, :] - values[:, None]) >= FROZEN_BAND) | missing[None, :]
    leaves = np.triu(leaves, 1)
    following = np.where(leaves.any(axis=1), leaves.argmax(axis=1), m)
    to: list[Result] = [(0, 0, -1, 0.0)] * (m + 1)
    for j in range(m - 1, -1, -1):
        k = int(following[j])
        if missing[j]:
            to[j] = to[j + 1]
        elif k == m:
            to[j] = (0, 0, begin + j, float(values[j]))
        else:
            one, length = out.closed(begin + j, begin + k)
            to[j] = (to[k][0] + one, to[k][1] + length, *to[k][2:])
    out.fresh = to[0]
    gap = int(missing.argmax()) if missing.any() else m
    if gap < m:
        out.gap_at, out.gap_to = begin + gap, to[gap]
    for j in range(gap):
        v = float(values[j])
        if not out.highs or v > out.highs[-1]:
            out.highs.append(v), out.high_at.append(begin + j), out.high_to.append(to[j])
        if not out.lows or v < out.lows[-1]:
            out.lows.append(v), out.low_at.append(begin + j), out.low_to.append(to[j])
    return out


def joined(tables: Sequence[Table]) -> Table:
    """One table of neighbouring stretches in order; slots between them are missing readings."""
    parts: list[Table] = []
    for t in tables:
        if parts and parts[-1].end < t.begin:
            parts.append(Table(t.last, parts[-1].end, t.begin, gap_at=parts[-1].end))
        parts.append(t)
    out = Table(parts[0].last, parts[0].begin, parts[-1].end)

    def through(result: Result, k: int) -> Result:
        for t in parts[k + 1 :]:
            result = t.after(result)
        return result

    out.fresh = through(parts[0].fresh, 0)
    for k, t in enumerate(parts):
        for v, at, to in zip(t.highs, t.high_at, t.high_to, strict=True):
            if not out.highs or v > out.highs[-1]:
                out.highs.append(v), out.high_at.append(at), out.high_to.append(through(to, k))
        for v, at, to in zip(t.lows, t.low_at, t.low_to, strict=True):
            if not out.lows or v < out.lows[-1]:
                out.lows.append(v), out.low_at.append(at), out.low_to.append(through(to, k))
        if t.gap_at >= 0:
            out.gap_at, out.gap_to = t.gap_at, through(t.gap_to, k)
            break
    return out


RESULT = "struct<a:bigint,b:bigint,c:bigint,d:double>"
COLUMNS = {"last": "bigint", "begin": "bigint", "end": "bigint", "fresh": RESULT, "highs": "array<double>", "high_at": "array<bigint>", "high_to": f"array<{RESULT}>",
           "lows": "array<double>", "low_at": "array<bigint>", "low_to": f"array<{RESULT}>", "gap_at": "bigint", "gap_to": RESULT}
_RESULT = pa.struct([("a", pa.int64()), ("b", pa.int64()), ("c", pa.int64()), ("d", pa.float64())])
_ARROW = {"bigint": pa.int64(), RESULT: _RESULT, "array<double>": pa.list_(pa.float64()), "array<bigint>": pa.list_(pa.int64()), f"array<{RESULT}>": pa.list_(_RESULT)}


def _row(t: Table) -> dict:
    def packed(r: Result) -> dict:
        return dict(zip("abcd", r, strict=True))

    return {n: packed(v) if k == RESULT else [packed(r) for r in v] if k.startswith("array<struct") else v
            for n, k in COLUMNS.items() for v in [getattr(t, n)]}


def _table(row: dict) -> Table:
    def whole(r: dict) -> Result:
        return (r["a"], r["b"], r["c"], r["d"])

    return Table(**{n: whole(row[n]) if k == RESULT else [whole(r) for r in row[n]] if k.startswith("array<struct") else row[n] for n, k in COLUMNS.items()})


def frozen_runs(df: DataFrame, groups: Sequence[str] = ("turbine_id",), settings: FarmSettings = DEFAULTS, value: str = "power",
                chunk: int = CHUNK, fan: int = FAN) -> DataFrame:
    """Frozen runs per group: (groups, frozen_blocks, frozen_samples, n_rows, frozen_ratio).

    `df` has one row per slot of a group; a slot without a row counts as a missing reading. A run is counted if it holds at least five
    readings and begins at least five slots before the group's last.
    """
    groups, spark = list(groups), df.sparkSession
    rows = df.select(*groups, slot_of(F.col("ts"), settings.interval_minutes).alias("at_"), F.col(value).cast("double").alias("v_"))
    ends = rows.groupBy(*groups).agg(F.min("at_").alias("first_"), F.max("at_").alias("last_"), F.count("*").alias("n_rows"))
    ends = spark.read.schema(ends.schema).parquet(write_stage(ends, "ends"))
    kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    schema = ", ".join([*[f"`{g}` {kinds[g]}" for g in groups], "chunk_ bigint", *[f"`{n}` {k}" for n, k in COLUMNS.items()]])
    names = list(COLUMNS)

    def answer(table: pa.Table, t: Table) -> pa.Table:
        own = table.select([*groups, "chunk_"]).slice(0, 1)
        for n, v in _row(t).items():
            own = own.append_column(n, pa.array([v], _ARROW[COLUMNS[n]]))
        return own

    def first(table: pa.Table) -> pa.Table:
        at, begin = table.column("at_").to_numpy(), int(table.column("chunk_")[0].as_py()) * chunk
        low = max(begin, int(table.column("first_")[0].as_py()))
        last = int(table.column("last_")[0].as_py())
        values = np.full(min(begin + chunk, last + 1) - low, np.nan)
        values[at - low] = table.column("v_").to_numpy()
        return answer(table, table_of(values, low, last))

    def further(table: pa.Table) -> pa.Table:
        parts = sorted(table.select(names).to_pylist(), key=lambda r: r["begin"])
        return answer(table, joined([_table(r) for r in parts]))

    dealt = attach(rows, ends.drop("n_rows"), groups).withColumn("chunk_", F.floor(F.col("at_") / F.lit(chunk)).cast("long"))
    missing = F.coalesce(F.col("v_"), F.lit(float("nan")))
    level = dealt.withColumn("v_", missing).groupBy(*groups, "chunk_").applyInArrow(first, schema)
    level = spark.read.schema(schema).parquet(write_stage(level, "frozen"))
    edge = ends.agg(F.min(F.floor(F.col("first_") / F.lit(chunk))).alias("low"), F.max(F.floor(F.col("last_") / F.lit(chunk))).alias("high")).first()
    low, span = int(edge.low or 0), int((edge.high or 0) - (edge.low or 0))
    level = level.withColumn("chunk_", F.col("chunk_") - F.lit(low))
    while span > 0:
        level = level.withColumn("chunk_", F.floor(F.col("chunk_") / F.lit(fan)).cast("long")).groupBy(*groups, "chunk_").applyInArrow(further, schema)
        level = spark.read.schema(schema).parquet(write_stage(level, "frozen"))
        span //= fan
    begun, length = F.col("fresh.c"), F.col("end") - F.col("fresh.c")
    counts = (begun >= 0) & (length >= FROZEN_LENGTH) & (begun <= F.col("last") - FROZEN_LENGTH)
    zero = F.lit(0).cast("long")
    totals = level.select(*groups, (F.col("fresh.a") + counts.cast("long")).alias("frozen_blocks"), (F.col("fresh.b") + F.when(counts, length).otherwise(zero)).alias("frozen_samples"))
    out = attach(ends, totals, groups, "left").select(*groups, F.coalesce("frozen_blocks", zero).alias("frozen_blocks"), F.coalesce("frozen_samples", zero).alias("frozen_samples"), "n_rows")
    return out.withColumn("frozen_ratio", F.col("frozen_samples") / F.col("n_rows"))
