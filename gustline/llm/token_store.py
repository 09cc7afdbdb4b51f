"""Token ids in Re-Pair compressed shard files (operator 5).

Documents are put in order of doc_id, encoded, and written in shards of about `shard_ids` ids. A shard file holds a grammar: rounds of
frequent pairs of adjacent symbols are replaced by nonterminals, the pairs of a round all at once, as long as
a pair is found at least `least` times; the rules, the length each symbol expands to, and the compressed sequence are stored. With the
lengths summed at every `STRIDE`-th symbol a document is decoded without the rest of its shard (`Shard.ids`).

Texts are cut before each run of ASCII white space, where the tokenizer's own splitting always cuts; equal pieces of a batch are encoded once, all
together (`Coder`). Pieces it has no tables for go to the tokenizer itself.

Defined results: null and empty texts have the end id alone; a null doc_id comes first; repeated rows are documents of their own, in any order;
other columns are ignored; an empty table has no shard.
"""

from __future__ import annotations

import io
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gustline.llm.prefix_counts import BLANK, cuts, grammar
from gustline.llm.text import bounded_batches, slices, utf8
from gustline.session import shared_dir, write_stage

END_ID, SHARD_IDS, LEAST, ROUNDS, PAIRS, STRIDE, BITS = 0, 2_000_000, 32, 4, 2048, 1024, 20
LETTER, DIGIT, OTHER, SPACE = range(4)
STRETCH, SLICE_BYTES = 1 << 18, 8 << 20  # bytes of atoms, and of texts, encoded together
_LOADED: dict = {}


class Coder:
    """Ids of many distinct pieces at once: split by tables of character classes, then encoded by the prefix rule of the merges.

    The classes of all characters of up to two bytes are read off the tokenizer's own splitting. Pieces with other characters, with white space inside or with
    special tokens go to the tokenizer itself.
    """

    def __init__(self, path: str):
        self.grammar = grammar(path)
        split = self.grammar.own.pre_tokenizer.pre_tokenize_str
        classes = np.full(0x800, OTHER, np.uint8)
        for cp in range(0x800):
            c = chr(cp)
            if c in BLANK:
                classes[cp] = SPACE
            elif len(split("a" + c)) == 1:
                classes[cp] = LETTER
            elif len(split("1" + c)) == 1:
                classes[cp] = DIGIT
        self.classes = classes
        sizes = np.zeros(self.grammar.own.get_vocab_size(), np.int64)
        for text, i in self.grammar.own.get_vocab().items():
            sizes[i] = len(text)
        self.sizes = sizes
        self.marks = [m.encode() for m in self.grammar.special]

    def encode(self, data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of the pieces data[at[i]:at[i + 1]] in some order, and first id and number of ids of each piece."""
        piece = np.repeat(np.arange(len(at) - 1, dtype=np.int32), np.diff(at))
        lead = (data & 0xE0) == 0xC0
        cp = data.astype(np.int32)
        where = np.flatnonzero(lead)
        cp[where] = ((cp[where] & 0x1F) << 6) | (cp[where + 1] & 0x3F)
        follows = (data & 0xC0) == 0x80
        kind = self.classes[np.where(cp < 0x800, cp, 0)]
        kind[1:][follows[1:]] = kind[:-1][follows[1:]]
        own = np.zeros(len(at) - 1, bool)  # for the tokenizer itself
        own[piece[(data >= 0xE0)]] = True
        first = np.zeros(len(data), bool)
        first[at[:-1]] = True
        inner = (kind == SPACE) & ~first
        inner[1:] &= ~(kind[:-1] == SPACE)
        own[piece[inner | (kind == SPACE) & (data > 0x7F)]] = True
        raw = data.tobytes()
        for mark in self.marks:
            low = raw.find(mark)
            while low >= 0:
                own[piece[low]] = True
                low = raw.find(mark, low + 1)
        begins = self._borders(data, kind, first)
        begins &= ~own[piece]
        starts = np.flatnonzero(begins | (first & ~own[piece]))
        ends = np.append(starts[1:], len(data))
        ends = np.minimum(ends, at[1:][piece[starts]])
        edges = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int64)
        order = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(edges), pa.py_buffer(np.ascontiguousarray(data[~own[piece]]))]).dictionary_encode()
        flat, to = utf8_of(order.dictionary)
        token = np.full(len(flat), -1, np.int32)
        low = 0
        while low < len(to) - 1:  # in stretches, so that memory does not follow the number of atoms
            high = max(low + 1, int(np.searchsorted(to, to[low] + STRETCH, side="right")) - 1)
            begin, end = to[low:high] - to[low], to[low + 1 : high + 1] - to[low]
            last, _ = self.grammar.last_tokens(flat[to[low] : to[high]], begin, end)
            open_, limit = end, begin
            while len(open_):  # walk back from the end of each atom, one token at a time
                t = last[open_ - 1]
                open_ = open_ - self.sizes[t]
                token[to[low] + open_] = t
                more = open_ > limit
                open_, limit = open_[more], limit[more]
            low = high
        ids = token[token >= 0]
        edges = np.concatenate([[0], np.cumsum(token >= 0)])[to]
        out, rows = spread(ids, edges[:-1], np.diff(edges), order.indices.to_numpy().astype(np.int64))
        per_piece = np.bincount(piece[starts], weights=np.diff(rows), minlength=len(at) - 1).astype(np.int64)
        begin = np.cumsum(per_piece) - per_piece
        rest = np.flatnonzero(own)
        if len(rest):
            found = self.grammar.own.encode_batch([raw[at[i] : at[i + 1]].decode() for i in rest], add_special_tokens=False)
            listed = [e.ids for e in found]
            per_piece[rest] = [len(i) for i in listed]
            begin[rest] = len(out) + np.cumsum(per_piece[rest]) - per_piece[rest]
            out = np.concatenate([out, *(np.array(i, np.int64) for i in listed)])
        return out.astype(np.uint32), begin, per_piece

    def _borders(self, data: np.ndarray, kind: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Where the tokenizer's splitting begins a piece, within pieces of white space followed by other characters."""
        out = first.copy()
        out[1:] |= kind[1:] != kind[:-1]
        space = kind == SPACE
        last_space = np.zeros(len(data), bool)
        last_space[:-1] = space[:-1] & ~space[1:] & ~first[1:]
        # the last of several blanks stands alone, or goes to what follows if it is a space
        out |= last_space
        joins = last_space & (data == 0x20)
        out[1:][joins[:-1]] = False
        # an apostrophe alone, not after a joined space, takes the letters of a contraction with it
        quote = np.flatnonzero(out & (data == 0x27))
        quote = quote[quote + 1 < len(data)]
        quote = quote[(kind[quote + 1] == LETTER) & out[quote + 1] & ~first[quote + 1]]
        one, two = data[np.minimum(quote + 1, len(data) - 1)], data[np.minimum(quote + 2, len(data) - 1)]
        inside = (quote + 2 < len(data)) & ~first[np.minimum(quote + 2, len(data) - 1)]
        short = np.isin(one, np.frombuffer(b"stmd", np.uint8))
        long = inside & np.isin(one.astype(np.int32) << 8 | two, [int.from_bytes(p, "big") for p in (b"re", b"ve", b"ll")])
        hit = short | long
        quote, size = quote[hit], np.where(short[hit], 1, 2)
        out[quote + 1] = False
        after = quote + 1 + size
        after = after[after < len(data)]
        out[after] = True
        return out


def utf8_of(column: pa.LargeBinaryArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a binary column end to end, and the row bounds in them."""
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(column.buffers()[2], np.uint8)[offsets[0] : offsets[-1]], (offsets - offsets[0]).astype(np.int64)


def coder(path: str) -> Coder:
    if path not in _LOADED:
        _LOADED[path] = Coder(path)
    return _LOADED[path]


def encode(column: pa.Array, path: str) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts end to end, without end ids, and the row bounds in them."""
    data, bounds = utf8(column)
    if not len(data):
        return np.zeros(0, np.uint32), np.zeros(len(bounds), np.int64)
    at = np.flatnonzero(cuts(data, bounds)).astype(np.int64)
    pieces = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(at) - 1, [None, pa.py_buffer(at), pa.py_buffer(np.ascontiguousarray(data))])
    codes = pieces.dictionary_encode()
    flat, first, lengths = coder(path).encode(*utf8_of(codes.dictionary))
    out, edges = spread(flat, first, lengths, codes.indices.to_numpy().astype(np.int64))
    return out, edges[np.searchsorted(at, bounds)]


def spread(flat: np.ndarray, first: np.ndarray, lengths: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs flat[first[c] : first[c] + lengths[c]] of all codes end to end, and their edges."""
    n = lengths[codes]
    edges = np.concatenate([[0], np.cumsum(n)])
    at = np.repeat(first[codes] - edges[:-1], n) + np.arange(edges[-1])
    return flat[at], edges


def compress(ids: np.ndarray, symbols: int) -> tuple[np.ndarray, np.ndarray]:
    """Sequence and rules (pairs) of a grammar; symbols from `symbols` on are nonterminals, in the order of the rules."""
    seq, rules = ids.astype(np.int64), []
    count = symbols
    for _ in range(ROUNDS):
        if len(seq) < 2:
            break
        key = (seq[:-1] << 32) | seq[1:]
        bucket = (key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - BITS)).astype(np.int32)
        sizes = np.bincount(bucket, minlength=1 << BITS)
        top = max(LEAST, int(np.partition(sizes, -PAIRS)[-PAIRS]))
        maybe = np.flatnonzero((sizes >= top)[bucket])
        pairs, inverse, times = np.unique(key[maybe], return_inverse=True, return_counts=True)
        chosen = times >= top
        if not chosen.any():
            break
        hit = chosen[inverse]
        at, which = maybe[hit], inverse[hit]
        fresh = np.ones(len(at), bool)
        fresh[1:] = np.diff(at) > 1
        start = np.maximum.accumulate(np.where(fresh, np.arange(len(at)), 0))
        free = (np.arange(len(at)) - start) % 2 == 0
        at, which = at[free], which[free]
        number = np.cumsum(chosen) - 1 + count
        seq[at] = number[which]
        keep = np.ones(len(seq), bool)
        keep[at + 1] = False
        seq = seq[keep]
        rules.append(np.stack([pairs[chosen] >> 32, pairs[chosen] & 0xFFFFFFFF], 1))
        count += int(chosen.sum())
    return seq.astype(np.uint32), np.concatenate(rules).astype(np.uint32) if rules else np.zeros((0, 2), np.uint32)


def write_shard(ids: np.ndarray, doc_ids: list, bounds: np.ndarray, symbols: int) -> bytes:
    seq, rules = compress(ids, symbols)
    lengths = np.ones(symbols + len(rules), np.int64)
    for i, (a, b) in enumerate(rules):  # a rule names earlier symbols only
        lengths[symbols + i] = lengths[a] + lengths[b]
    marks = np.concatenate([[0], np.cumsum(lengths[seq])])[::STRIDE]
    out = io.BytesIO()
    np.savez(out, symbols=symbols, rules=rules, lengths=lengths[symbols:].astype(np.uint32), marks=marks, bounds=bounds,
             docs=np.array([-1 if d is None else d for d in doc_ids], np.int64), null=np.array([d is None for d in doc_ids], bool),
             seq=np.frombuffer(zlib.compress(seq.tobytes(), 1), np.uint8))
    return out.getvalue()


class Shard:
    """Reader of a shard file."""

    def __init__(self, data: bytes):
        z = np.load(io.BytesIO(data))
        self.symbols, self.bounds, self.marks = int(z["symbols"]), z["bounds"], z["marks"]
        self.docs = [None if n else int(d) for d, n in zip(z["docs"], z["null"])]
        self.seq = np.frombuffer(zlib.decompress(z["seq"].tobytes()), np.uint32).astype(np.int64)
        self.lengths = np.concatenate([np.ones(self.symbols, np.int64), z["lengths"].astype(np.int64)])
        rules = z["rules"]
        self.first = np.concatenate([np.arange(self.symbols), self.symbols + np.concatenate([[0], np.cumsum(z["lengths"].astype(np.int64))[:-1]]) if len(rules) else []]).astype(np.int64)
        self.flat = np.arange(self.symbols + int(z["lengths"].sum()), dtype=np.uint32)
        for i, (a, b) in enumerate(rules):
            at = self.first[self.symbols + i]
            for s in (a, b):
                n = self.lengths[s]
                self.flat[at : at + n] = self.flat[self.first[s] : self.first[s] + n]
                at += n

    def all(self) -> np.ndarray:
        return spread(self.flat, self.first, self.lengths, self.seq)[0]

    def ids(self, k: int) -> np.ndarray:
        """Ids of the k-th document, decoding only the symbols around it."""
        low, high = self.bounds[k], self.bounds[k + 1]
        a = int(np.searchsorted(self.marks, low, side="right")) - 1
        b = int(np.searchsorted(self.marks, high, side="left"))
        part = spread(self.flat, self.first, self.lengths, self.seq[a * STRIDE : b * STRIDE])[0]
        return part[low - self.marks[a] : high - self.marks[a]]


def write_tokens(docs: DataFrame, path: str, shard_ids: int = SHARD_IDS) -> DataFrame:
    """Writes all shards; the manifest (part, number, file, n_ids), whose order is that of the documents."""
    spark = docs.sparkSession
    bounded_batches(spark)
    folder = f"{shared_dir(spark)}/ids-{uuid.uuid4().hex}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        store, top = fs.FileSystem.from_uri(folder)
        symbols, part, number = len(coder(path).sizes), TaskContext.get().partitionId(), 0
        docs_, held, sizes = [], [], []

        def flush() -> pa.RecordBatch:
            nonlocal docs_, held, sizes, number
            ids, bounds, name = np.concatenate(held), np.concatenate([[0], np.cumsum(sizes)]), f"{uuid.uuid4().hex}.repair"
            store.create_dir(top, recursive=True)
            with store.open_output_stream(f"{top}/{name}", compression=None) as out:
                out.write(write_shard(ids, docs_, bounds, symbols))
            row = pa.RecordBatch.from_arrays([pa.array([part]), pa.array([number]), pa.array([f"{folder}/{name}"]), pa.array([len(ids)])], ["part", "number", "file", "n_ids"])
            docs_, held, sizes, number = [], [], [], number + 1
            return row

        for batch in batches:
            for some in slices(batch, "text", SLICE_BYTES):
                ids, rows = encode(some.column(1), path)
                n = np.diff(rows) + 1
                edges = np.concatenate([[0], np.cumsum(n)])
                closed = np.full(edges[-1], END_ID, np.uint32)
                keep = np.ones(edges[-1], bool)
                keep[edges[1:] - 1] = False
                closed[keep] = ids
                held.append(closed), sizes.extend(n), docs_.extend(some.column(0).to_pylist())
                if sum(map(len, held)) >= shard_ids:
                    yield flush()
        if docs_:
            yield flush()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    ordered = rows.repartitionByRange(max(1, rows.rdd.getNumPartitions()), "doc_id").sortWithinPartitions("doc_id")
    return spark.read.parquet(write_stage(ordered.mapInArrow(run, "part long, number long, file string, n_ids long"), "shards"))


def read_tokens(manifest: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document of the shards."""
    before = Window.orderBy("part", "number").rowsBetween(Window.unboundedPreceding, -1)
    starts = manifest.withColumn("start", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                store, name = fs.FileSystem.from_uri(file)
                with store.open_input_file(name) as f:
                    shard = Shard(f.read())
                raw = shard.all().astype("<u4").tobytes()
                sums = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(shard.bounds, shard.bounds[1:])]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(shard.docs, pa.int64()), pa.array(start + shard.bounds[:-1]), pa.array(np.diff(shard.bounds)), pa.array(sums, pa.int64())],
                    ["doc_id", "start", "n_tokens", "ids_crc32"])

    dealt = starts.select("file", "start").repartition(max(1, manifest.count()), "file")
    return dealt.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def op5_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return read_tokens(write_tokens(docs, public_tokenizers.path("byte_bpe_50k.json")))


QUERIES = {"op5_token_store": op5_token_store}
ORACLE: dict[str, str] = {}
