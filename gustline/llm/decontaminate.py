"""Benchmark decontamination on templates (operator 1).

A template replaces numbers, names and units by typed placeholders; all other words stay, in lower case, without punctuation.
Every window of eight words of an item is looked up as it is, and also as a template window if it has at least five literal words.
The hits of a document and an item on one alignment (position in the document minus position in the item) belong together:
their slots must be consistent, so that each value of the item stands for one value of the document throughout. A
re-parameterised question passes that test, text that only has the same shape doesn't. Where a value of the item meets several,
it stands for its own value if that is among them, else for the one at most slots if that has two; the template windows that
disagree are not counted. At least `HITS` windows of the item at different places (all, where it has fewer) must be left, of its
template windows or of all.

The windows of the benchmark and of the documents are hash-joined by Spark, so neither side passes through the driver or one task. Beforehand
a bit map of the benchmark's windows (16 MB at most; once it fills up, more windows are joined and the result is the same) tells which
windows of documents can have a partner. Documents of equal text are joined once, items of equal text too.

Defined results: null and empty texts and items match nothing; an item shorter than a window is one window of its own length; one
of fewer than five words is found only in documents of just these words; a result row per matching row of documents, repeated rows and
rows without doc_id included; items of equal text are all named; other columns pass through.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gustline.llm.order import packed
from gustline.llm.text import GAP, bounded_batches, mix, slices, span_hashes, spans, utf8, window_starts
from gustline.session import write_stage

WINDOW, LITERALS, HITS, MAP_BITS = 8, 5, 3, 27
_PLAIN, _WHOLE = 1 << 32, 1 << 33
_SLOTS = "array<struct<k: int, value: binary>>"
UNITS = """mm cm m km inch inches feet foot mile miles mg g kg lb lbs pound pounds ounce ounces ton tons ml l liter liters litre litres
gallon gallons second seconds minute minutes hour hours day days week weeks month months year years percent dollar dollars cent cents
euro euros degree degrees meter meters metre metres kilometer kilometers gram grams kilogram kilograms""".split()
_NUMBER, _NAME, _UNIT = (np.uint64(x) for x in (11, 12, 13))

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BREAK = GAP.copy()
_BREAK[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = True
_STOP = np.zeros(256, bool)
_STOP[list(b".!?:\n")] = True
_UNIT_HASHES = None


def _unit_hashes() -> np.ndarray:
    global _UNIT_HASHES
    if _UNIT_HASHES is None:
        data, bounds = utf8(pa.array(UNITS))
        _UNIT_HASHES = span_hashes(data, bounds[:-1], bounds[1:])
    return _UNIT_HASHES


class Template:
    """Words of a batch of texts with their template hashes; `slot` marks placeholders."""

    def __init__(self, column: pa.Array):
        data, bounds = utf8(column)
        self.data = data
        gap = _BREAK[data]
        if len(data) > 2:
            digit = (data >= 48) & (data <= 57)
            gap[1:-1] &= ~(((data[1:-1] == 44) | (data[1:-1] == 46)) & digit[:-2] & digit[2:])
        lower = _LOWER[data]
        if len(data) > 1:
            wide = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E)
            lower[1:][wide] += 32
        self.starts, self.ends, self.rows = spans(gap.view(np.uint8), bounds, np.array([False, True] + [True] * 254))
        s, e = self.starts, self.ends
        hashes = span_hashes(lower, s, e)
        first = data[s] if len(s) else np.zeros(0, np.uint8)
        second = lower[np.minimum(s + 1, np.maximum(e - 1, s))] if len(s) else first
        opens = np.ones(len(s), bool)
        stops = np.concatenate([[0], np.cumsum(_STOP[data])])
        opens[1:] = stops[s[1:]] > stops[e[:-1]]
        opens[self.rows[:-1][np.diff(self.rows) > 0]] = True
        number = (first >= 48) & (first <= 57)
        small = len(s) and np.where(e - s > 1, data[np.minimum(s + 1, len(data) - 1)] == second, True)
        name = (first >= 65) & (first <= 90) & small & ~opens if len(s) else number
        if len(s):
            name |= (first == 0xC3) & (second != data[np.minimum(s + 1, len(data) - 1)]) & ~opens
        unit = np.zeros(len(s), bool)
        unit[1:] = number[:-1] & np.isin(hashes[1:], _unit_hashes())
        unit[self.rows[:-1][np.diff(self.rows) > 0]] = False
        self.slot = number | name | unit
        self.plain = hashes
        self.hashes = np.where(number, _NUMBER, np.where(unit, _UNIT, np.where(name, _NAME, hashes)))
        self.literal = np.concatenate([[0], np.cumsum(~self.slot)])

    def windows(self, size: int, plain: bool = False, whole: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Hash, row and first word of the windows with enough literal words, of all by their plain words, or of texts of `size` words."""
        first, row = window_starts(self.rows, size)
        if whole:
            own = np.diff(self.rows)[row] == size
            first, row = first[own], row[own]
        elif not plain:
            enough = self.literal[first + size] - self.literal[first] >= LITERALS
            first, row = first[enough], row[enough]
        rolled = np.full(len(first), size + (_WHOLE if whole else _PLAIN if plain else 0), np.uint64)
        words = self.plain if plain or whole else self.hashes
        for k in range(size):
            rolled = rolled * np.uint64(0xD6E8FEB86659FD93) + words[first + k]
        return mix(rolled), row, first

    def slots(self, first: int, size: int) -> list[tuple[int, bytes]]:
        return [(k, self.data[self.starts[first + k] : self.ends[first + k]].tobytes().lower()) for k in range(size) if self.slot[first + k]]


def _kinds(size: int) -> list[tuple[bool, bool]]:
    """(plain, whole) of the windows of this size that are looked up."""
    return [(False, True)] if size < LITERALS else [(False, False), (True, False)]


def agreeing(windows: list[tuple]) -> list[tuple]:
    """The windows (place, plain, slots of the item, slots of the document) of one alignment whose slots agree."""
    stands: dict[bytes, dict] = defaultdict(lambda: defaultdict(set))
    met = []
    for place, _, wanted, value in windows:
        own = [(place + k, wanted[k], v) for k, v in value.items() if k in wanted]
        for at, w, v in own:
            stands[w][v].add(at)
        met.append(own)
    chosen = {}
    for w, by_value in stands.items():
        best = min(by_value, key=lambda v: (v != w, -len(by_value[v]), v))
        chosen[w] = best if len(by_value) == 1 or best == w or len(by_value[best]) > 1 else None
    return [x for x, own in zip(windows, met) if all(chosen[w] == v for _, w, v in own)]


def _item_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch):
            template, out = Template(part.column(1)), []
            counts = np.diff(template.rows)
            places = np.maximum(counts - WINDOW + 1, 1)
            for size in sorted({int(min(WINDOW, c)) for c in counts if c}):
                mine = np.minimum(WINDOW, counts) == size
                typed = np.bincount(template.windows(size)[1], minlength=len(counts))
                for plain, whole in _kinds(size):
                    hashes, rows, firsts = template.windows(size, plain, whole)
                    for i in np.flatnonzero(mine[rows]).tolist():
                        row, first = int(rows[i]), int(firsts[i])
                        out.append((part.column(0)[row].as_py(), int(hashes[i].view(np.int64)), size, first - int(template.rows[row]), plain or whole,
                                    [] if plain or whole else [{"k": k, "value": v} for k, v in template.slots(first, size)],
                                    int(min(HITS, places[row])), 0 if whole else int(min(HITS, typed[row]))))
            names = ["item", "hash", "size", "place", "plain", "wanted", "least", "least_typed"]
            types = [pa.string(), pa.int64(), pa.int32(), pa.int64(), pa.bool_(), pa.list_(pa.struct([("k", pa.int32()), ("value", pa.binary())])), pa.int32(), pa.int32()]
            yield pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], t) for i, t in enumerate(types)], names)


def item_windows(benchmark: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Windows of the distinct item texts, and (item, item_id) of all items; an item is known by the digest of its text."""
    spark = benchmark.sparkSession
    rows = benchmark.select("item_id", F.col("text").cast("string").alias("text")).where("text is not null and item_id is not null")
    rows = rows.select("item_id", F.md5("text").alias("item"), "text")
    found = rows.groupBy("item").agg(F.min("text").alias("text")).mapInArrow(
        _item_windows, f"item string, hash long, size int, place long, plain boolean, wanted {_SLOTS}, least int, least_typed int")
    return spark.read.parquet(write_stage(found, "windows")), rows.select("item", F.col("item_id").cast("long").alias("item_id")).distinct()


def bit_map(windows: DataFrame) -> np.ndarray:
    """Bits of the windows' hashes, two each, about one of 32 set; at most 2^MAP_BITS bits, whatever the number of windows."""
    bits = min(MAP_BITS, max(16, (64 * windows.count()).bit_length()))
    both = F.array(F.col("hash").bitwiseAND(F.lit((1 << bits) - 1)), F.shiftrightunsigned("hash", 64 - bits))
    words = windows.select(F.explode(both).alias("bit")).groupBy(F.shiftright("bit", 6).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(bit & 63 as int))")).alias("set"))
    found = words.toArrow()
    out = np.zeros(1 << (bits - 6), np.uint64)
    out[found.column("word").to_numpy()] = found.column("set").to_numpy().view(np.uint64)
    return out


def _listed(known: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Places of the hashes whose bits are set."""
    bits, at = int(len(known)).bit_length() + 5, np.arange(len(hashes))
    for probe in (lambda h: h & np.uint64((1 << bits) - 1), lambda h: h >> np.uint64(64 - bits)):
        bit = probe(hashes[at])
        at = at[(known[(bit >> np.uint64(6)).astype(np.int64)] >> (bit & np.uint64(63))) & np.uint64(1) == 1]
    return at


def fingerprint(text: Column) -> list[Column]:
    return [F.xxhash64(F.lit(1), text).alias("fa"), F.xxhash64(F.lit(2), text).alias("fb")]


def matched(texts: DataFrame, windows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(doc_id, fa, fb) of the rows of texts (doc_id, text) with any window in common, and (fa, fb, item, n) of the items found in each distinct text."""
    spark = texts.sparkSession
    bounded_batches(spark)
    known = spark.sparkContext.broadcast(bit_map(windows))
    sizes = sorted(r["size"] for r in windows.select("size").distinct().collect())  # WINDOW sizes at most

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                template, hits = Template(part.column(part.schema.get_field_index("text"))), defaultdict(list)
                for size in sizes:
                    for plain, whole in _kinds(size):
                        hashes, rows, firsts = template.windows(size, plain, whole)
                        for i in _listed(known.value, hashes).tolist():
                            row, first = int(rows[i]), int(firsts[i])
                            hits[row].append({"hash": int(hashes[i].view(np.int64)), "first": first - int(template.rows[row]),
                                              "value": [] if plain or whole else [{"k": k, "value": v} for k, v in template.slots(first, size)]})
                own = pa.array(sorted(hits), pa.int64())
                kind = pa.struct([("hash", pa.int64()), ("first", pa.int64()), ("value", pa.list_(pa.struct([("k", pa.int32()), ("value", pa.binary())])))])
                yield pa.RecordBatch.from_arrays([*[part.column(i).take(own) for i in range(3)], pa.array([hits[r] for r in sorted(hits)], pa.list_(kind))],
                                                 ["doc_id", "fa", "fb", "hits"])

    plain = texts.select("doc_id", *fingerprint(F.col("text")), "text").where("text is not null")
    rows = spark.read.parquet(write_stage(plain.mapInArrow(
        run, f"doc_id long, fa long, fb long, hits array<struct<hash: long, first: long, value: {_SLOTS}>>"), "hits"))
    once = rows.dropDuplicates(["fa", "fb"]).select("fa", "fb", F.explode("hits").alias("h")).select("fa", "fb", "h.hash", "h.first", "h.value")
    pairs = once.join(windows, "hash").groupBy("fa", "fb", "item", (F.col("first") - F.col("place")).alias("shift")).agg(
        F.max("least").alias("least"), F.max("least_typed").alias("least_typed"), F.collect_list(F.struct("place", "plain", "wanted", "value")).alias("windows"))
    enough = pairs.where("size(windows) >= least or least_typed > 0 and size(windows) >= least_typed")

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                slots = lambda found: {x["k"]: x["value"] for x in found}
                left = agreeing([(w["place"], w["plain"], slots(w["wanted"]), slots(w["value"])) for w in r["windows"]])
                n, typed = len({w[0] for w in left}), len({w[0] for w in left if not w[1]})
                if n >= r["least"] or r["least_typed"] and typed >= r["least_typed"]:
                    out.append((r["fa"], r["fb"], r["item"], n))
            types = [pa.int64(), pa.int64(), pa.string(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], t) for i, t in enumerate(types)], ["fa", "fb", "item", "n"])

    judged = enough.mapInArrow(judge, "fa long, fb long, item string, n long")
    return rows.select("doc_id", "fa", "fb"), spark.read.parquet(write_stage(judged, "found"))


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_ids, n_windows) of each row of docs that holds a benchmark item, n_windows being the most of one item."""
    windows, items = item_windows(benchmark)
    rows, found = matched(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")), windows)
    named = found.join(items, "item").groupBy("fa", "fb").agg(F.array_sort(F.collect_set("item_id")).alias("item_ids"), F.max("n").alias("n_windows"))
    return rows.join(named, ["fa", "fb"]).select("doc_id", "item_ids", "n_windows")


def keep_clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Rows of docs without any benchmark item, with all their columns."""
    own, names = packed(docs)
    text = F.col("row_.`text`").cast("string")
    rows = own.select("row_", text.alias("text"), F.lit(None).cast("long").alias("doc_id"))
    _, found = matched(rows, item_windows(benchmark)[0])
    clean = own.select("row_", *fingerprint(text)).join(found.select("fa", "fb").distinct(), ["fa", "fb"], "left_anti")
    return clean.select(*[F.col(f"row_.`{c}`").alias(c) for c in names])


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


QUERIES = {"op1_decontaminate": op1_decontaminate}
ORACLE: dict[str, str] = {}
