"""Reading, listing, auditing, previewing and editing input files; writing processed tables."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator, Sequence
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gustline.functions.timeline import slot_of
from gustline.operators.cleaning import first_reading
from gustline.settings import SENSORS

WEATHER_SCHEMA = T.StructType([
    T.StructField("timestamp", T.TimestampNTZType()), T.StructField("lead_minutes", T.LongType()),
    T.StructField("wind_speed", T.DoubleType()), T.StructField("wind_direction", T.DoubleType()),
    T.StructField("temperature", T.DoubleType()),
])
PIECE = 8 << 20
FORMATS = {"csv": {"header": True}, "json": {"multiLine": True}, "parquet": {}}


def extension(path: str) -> str:
    return path.rstrip("/").rsplit(".", 1)[-1].lower()


def _read(spark: SparkSession, kind: str, paths: Sequence[str], schema: T.StructType | None) -> DataFrame:
    if kind not in FORMATS:
        raise ValueError(f"no reader for .{kind}")
    reader = spark.read.format(kind).options(**FORMATS[kind])
    reader = reader.schema(schema) if schema is not None else reader
    return reader.load(list(paths))


def with_sensor_types(df: DataFrame) -> DataFrame:
    """Text columns named after a sensor (`power`, `TB01_power`) as doubles, null where they do not parse.

    Types follow names, not data, so a CSV input is read once and all inputs agree.
    """
    named = [c for c, t in df.dtypes if t == "string" and any(c == s or c.endswith(f"_{s}") for s in SENSORS)]
    return df.withColumns({c: F.expr(f"try_cast(`{c}` AS double)") for c in named})


def as_timestamp(column: Column, kind: str) -> Column:
    """Text that does not parse becomes null; other types are cast."""
    return F.try_to_timestamp(column).cast("timestamp_ntz") if kind == "string" else column.cast("timestamp_ntz")


def read_one(spark: SparkSession, path: str, ts: str = "ts", schema: T.StructType | None = None) -> DataFrame:
    """One Parquet, CSV or JSON input; rows without a timestamp are dropped.

    A CSV input without a schema gives doubles for sensor columns and text for others; JSON is read once more to find
    its fields unless a schema is given.
    """
    df = with_sensor_types(_read(spark, extension(path), [path], schema))
    return df.withColumn(ts, as_timestamp(F.col(ts), dict(df.dtypes)[ts])).dropna(subset=[ts])


def list_files(spark: SparkSession, folder: str) -> DataFrame:
    """(file_name, path, size_bytes, modified) of every data file below a folder; contents stay unread."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    inside = F.regexp_extract("path", r"([^/]+)$", 1)
    return files.where(F.lower(F.regexp_extract("path", r"\.([A-Za-z]+)$", 1)).isin(*FORMATS)).select(
        inside.alias("file_name"), "path", F.col("length").alias("size_bytes"),
        F.col("modificationTime").alias("modified"))


def read_all(spark: SparkSession, paths: Sequence[str], keys: Sequence[str], ts: str = "ts") -> DataFrame:
    """Union of the inputs, one row per key: that of the first input in name order.

    Inside an input the order is file, place in the file (row for Parquet, block for text), then readings before nulls
    and smaller values first, since text has no row numbers.
    One read per format. A row's input is the part of its file path right below the input's folder, so
    the work does not depend on how many inputs there are.
    """
    by_kind: dict[str, list[str]] = {}
    for path in paths:
        by_kind.setdefault(extension(path), []).append(path)
    folders = sorted({p.rstrip("/").rsplit("/", 1)[0] for p in paths})
    below = F.col("_metadata.file_path")
    name = F.lit("")
    for folder in folders:
        rest = F.substring_index(below, f"{folder}/", -1)
        name = F.when(below.contains(f"{folder}/"), F.substring_index(rest, "/", 1)).otherwise(name)
    out = None
    for kind, group in by_kind.items():
        row = F.col("_metadata.row_index" if kind == "parquet" else "_metadata.file_block_start")
        place = F.struct(name.alias("input"), below.alias("file"), row.alias("row"))
        df = with_sensor_types(_read(spark, kind, group, None).withColumn("_place", place))
        df = df.withColumn(ts, as_timestamp(F.col(ts), dict(df.dtypes)[ts])).dropna(subset=[ts])
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    rest = [c for c in out.columns if c not in (*keys, "_place")]
    values = [e for c in rest for e in (F.col(c).isNull().alias(f"no_{c}"), F.col(c))]
    ordered = out.withColumn("_order", F.struct("_place", *values)).drop("_place")
    return first_reading(ordered, keys, ["_order"]).drop("_order")


def load_weather(spark: SparkSession, path: str) -> DataFrame:
    """Weather forecast table; a missing column is an error."""
    kind = extension(path)
    if kind == "csv":
        header = spark.read.option("header", True).csv(path).columns
        missing = [f.name for f in WEATHER_SCHEMA if f.name not in header]
        if missing:
            raise ValueError(f"weather table lacks {missing}")
        raw = spark.read.option("header", True).csv(path)
    else:
        raw = _read(spark, kind, [path], None)
        missing = [f.name for f in WEATHER_SCHEMA if f.name not in raw.columns]
        if missing:
            raise ValueError(f"weather table lacks {missing}")
    return raw.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in WEATHER_SCHEMA])


def save_processed(df: DataFrame, path: str, ts: str = "ts", kind: str = "parquet") -> None:
    """Table partitioned by turbine and year, so that both prune a later read."""
    if kind == "csv":
        df.write.mode("overwrite").option("header", True).csv(path)
        return
    year = df.withColumn("year", F.year(ts))
    year.repartition("turbine_id", "year", F.month(ts)).write.mode("overwrite").partitionBy(
        "turbine_id", "year").parquet(path)


def load_processed(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def _opened(uri: str):
    """Arrow's file system for a path as Spark lists it, and the path in it."""
    if uri.startswith("file:/"):
        return fs.LocalFileSystem(), re.sub(r"^file:/+", "/", uri)
    return fs.FileSystem.from_uri(quote(uri, safe=":/@%"))


def file_digests(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """(file_name, size_bytes, sha256) of each file, one file a row.

    Spark lists the files without reading them; a task then feeds a file to the hasher piece by piece, so its size does not matter. In a store that only
    Spark's own readers reach a file is read as one value instead, which ends at 2 GB.
    """
    listed = spark.read.format("binaryFile").load(list(paths))
    name = F.regexp_extract("path", r"([^/]+)$", 1)
    files = listed.select("path", name.alias("file_name"), F.col("length").alias("size_bytes"))
    some = files.select("path").first()
    try:
        if some:
            _opened(some.path)
    except (pa.ArrowInvalid, pa.ArrowNotImplementedError, OSError):
        return listed.select(name.alias("file_name"), F.col("length").alias("size_bytes"), F.sha2("content", 256).alias("sha256"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sums = []
            for path in batch.column(0).to_pylist():
                store, own = _opened(path)
                digest = hashlib.sha256()
                with store.open_input_stream(own, compression=None) as stream:
                    while piece := stream.read(PIECE):
                        digest.update(piece)
                sums.append(digest.hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(1), batch.column(2), pa.array(sums, pa.string())], ["file_name", "size_bytes", "sha256"])

    return files.repartition(min(10_000, max(1, files.count())), "path").mapInArrow(run, "file_name string, size_bytes long, sha256 string")


def file_manifest(spark: SparkSession, paths: Sequence[str], ts: str = "ts") -> DataFrame:
    """Size, SHA-256, rows, first and last timestamp of each file."""
    hashes = file_digests(spark, paths)
    return hashes.join(file_coverage(spark, paths, ts), "file_name", "left")


def file_coverage(spark: SparkSession, paths: Sequence[str], ts: str = "ts") -> DataFrame:
    out = None
    for kind in sorted({extension(p) for p in paths}):
        df = _read(spark, kind, [p for p in paths if extension(p) == kind], None)
        when = as_timestamp(F.col(ts), dict(df.dtypes)[ts])
        part = df.groupBy(F.col("_metadata.file_name").alias("file_name")).agg(
            F.count("*").alias("n_rows"), F.min(when).alias("first_ts"), F.max(when).alias("last_ts"))
        out = part if out is None else out.unionByName(part)
    return out


def overlapping_windows(coverage: DataFrame, start: str = "first_ts", end: str = "last_ts") -> DataFrame:
    """How many other windows each window overlaps.

    Others that end before it starts or start after it ends are counted along the sorted boundaries, so
    windows are never paired. Boundaries are counted per moment, then per ten-minute slot; only the slot
    totals, whose number follows the calendar, are added up in one order.
    """
    windows = coverage.where(F.col(start).isNotNull())
    marks = windows.select(F.col(start).alias("_at"), F.lit(1).alias("_s"), F.lit(0).alias("_e")).union(
        windows.select(F.col(end), F.lit(0), F.lit(1)))
    moments = marks.groupBy("_at").agg(F.sum("_s").alias("_s"), F.sum("_e").alias("_e")).withColumn(
        "_slot", slot_of(F.col("_at"), 10))
    slots = moments.groupBy("_slot").agg(F.sum("_s").alias("_ss"), F.sum("_e").alias("_se"))
    along = Window.orderBy("_slot")
    slots = slots.select(
        "_slot", (F.sum("_se").over(along) - F.col("_se")).alias("_ended"),
        (F.sum("_ss").over(along)).alias("_started"))
    inside = Window.partitionBy("_slot").orderBy("_at")
    total = windows.agg(F.count("*")).scalar()
    slot_sum = F.sum("_s").over(Window.partitionBy("_slot"))
    placed = moments.join(slots, "_slot").select(
        "_at", (F.col("_ended") + F.sum("_e").over(inside) - F.col("_e")).alias("_before"),
        (total - (F.col("_started") - slot_sum + F.sum("_s").over(inside))).alias("_after"))
    left = placed.select(F.col("_at").alias(start), "_before")
    right = placed.select(F.col("_at").alias(end), "_after")
    return coverage.join(left, start, "left").join(right, end, "left").select(
        *coverage.columns, (total - 1 - F.col("_before") - F.col("_after")).cast("long").alias("overlapping_files"))


def preview(df: DataFrame, order: Sequence[str], n: int = 100) -> DataFrame:
    return df.orderBy(*order).limit(n)


def summarise(df: DataFrame, ts: str = "ts") -> DataFrame:
    """(column, type, n_rows, null_count, null_pct, first_ts, last_ts), one row per column."""
    counts = df.agg(
        F.count("*").alias("_rows"), F.min(ts).alias("_first"), F.max(ts).alias("_last"),
        *[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    cells = F.array(*[
        F.struct(F.lit(c).alias("column"), F.lit(t).alias("type"), F.col(c).alias("null_count")) for c, t in df.dtypes])
    return counts.select("_rows", "_first", "_last", F.explode(cells).alias("_c")).select(
        "_c.*", F.col("_rows").alias("n_rows"),
        F.coalesce(F.try_divide(F.col("_c.null_count") * 100, F.col("_rows")), F.lit(0.0)).alias("null_pct"),
        F.col("_first").alias("first_ts"), F.col("_last").alias("last_ts"))


def declared_period(name: Column) -> tuple[Column, Column]:
    """First and past-the-end month of a file named like `01.2021-06.2021`."""
    pattern = r"(\d{2})\.(\d{4})-(\d{2})\.(\d{4})"

    def part(i: int) -> Column:
        return F.try_to_number(F.regexp_extract(name, pattern, i), F.lit("9999")).cast("int")

    low = F.make_date(part(2), part(1), F.lit(1))
    return low, F.add_months(F.make_date(part(4), part(3), F.lit(1)), 1)


def repair_swapped_days(df: DataFrame, period_name: Column, ts: str = "ts") -> DataFrame:
    """Swap day and month where the read date is outside the declared period and the swapped one inside."""
    t = F.col(ts)
    low, high = declared_period(period_name)
    swapped = F.when(F.dayofmonth(t) <= 12, F.make_timestamp_ntz(
        F.year(t), F.dayofmonth(t), F.month(t), F.hour(t), F.minute(t), F.second(t).cast("decimal(16,6)")))

    def inside(x: Column) -> Column:
        return (x >= low) & (x < high)

    wrong = ~inside(t) & swapped.isNotNull() & inside(swapped)
    return df.withColumn("day_swapped", F.coalesce(wrong, F.lit(False))).withColumn(
        ts, F.when(F.col("day_swapped"), swapped).otherwise(t))


def _matched(df: DataFrame, update: dict, ts: str) -> tuple[Column | None, str | None]:
    column, value, target = (update.get(k) for k in ("condition_column", "condition_value", "target_column"))
    column = column or ts
    if not value or not target:
        return None, "missing condition_value or target_column"
    if target not in df.columns:
        return None, f"column '{target}' not found"
    if column not in df.columns:
        return None, f"condition column '{column}' not found"
    wanted = F.lit(value).cast(dict(df.dtypes)[column])
    return F.coalesce(F.col(column) == wanted, F.lit(False)), None


def apply_edits(df: DataFrame, updates: Sequence[dict], ts: str = "ts") -> tuple[DataFrame, DataFrame]:
    """Set a column where another equals a value, edits in order; returns rows and the log.

    The request is a short list, so it becomes a chain of conditions inside one scan. The log has one row
    per edit with the number of rows matched at that point.
    """
    out, flags, reasons = df, [], []
    for i, update in enumerate(updates):
        matched, reason = _matched(df, update, ts)
        reasons.append(reason)
        flag = f"_hit{i}"
        out = out.withColumn(flag, F.lit(False) if matched is None else matched)
        if matched is not None:
            target = update["target_column"]
            new = F.lit(update.get("new_value")).cast(dict(df.dtypes)[target])
            out = out.withColumn(target, F.when(F.col(flag), new).otherwise(F.col(target)))
        flags.append(flag)
    counts = out.agg(*[F.count_if(F.col(f)).alias(f) for f in flags])
    cells = F.array(*[
        F.struct(F.lit(i).alias("edit"), F.col(f).alias("n_matched"), F.lit(r).cast("string").alias("reason"))
        for i, (f, r) in enumerate(zip(flags, reasons, strict=True))])
    log = counts.select(F.explode(cells).alias("_e")).select("_e.*").withColumns({
        "applied": F.col("n_matched") > 0,
        "reason": F.when(F.col("reason").isNull() & (F.col("n_matched") == 0), "no rows matched").otherwise(F.col("reason"))})
    return out.drop(*flags), log


def apply_edit_table(df: DataFrame, edits: DataFrame, keys: Sequence[str], target: str) -> DataFrame:
    """Edits given as a table (keys, position, new_value): the last one per key wins."""
    last = edits.groupBy(*keys).agg(F.max_by("new_value", "position").alias("_new"))
    return df.join(last, list(keys), "left").withColumn(
        target, F.coalesce("_new", target)).select(*df.columns)


def check_input(spark: SparkSession, path: str, schema: T.StructType, lines: bool = True) -> DataFrame:
    """Pre-ingest check of a CSV or JSON input: rows, unparseable rows and a verdict."""
    corrupt = "_corrupt_record"
    full = T.StructType([*schema.fields, T.StructField(corrupt, T.StringType())])
    kind = extension(path)
    reader = spark.read.schema(full).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", corrupt)
    df = reader.option("header", True).csv(path) if kind == "csv" else reader.option("multiLine", not lines).json(path)
    first = schema.fields[0].name
    return df.agg(
        F.count("*").alias("n_rows"), F.count(first).alias("n_present"), F.count(corrupt).alias("n_corrupt")
    ).withColumn("is_valid", (F.col("n_rows") > 0) & (F.col("n_corrupt") == 0))
