"""Exact token counts of every prefix of every text, by dynamic programming over prefixes (operator 12).

A byte-level BPE has one valid last token for every prefix: the token t with prefix = shorter prefix + t whose pair with the last
token of the shorter prefix is left alone by the merges. So last(prefix) and count(prefix) = count(shorter) + 1 follow from
shorter prefixes alone, and no prefix is encoded on its own. `last_tokens` runs this for all distinct pieces of a batch at once, one prefix
length at a time. Texts are cut before white space, where the tokenizer's own splitting always cuts; pieces met before are
looked up. The steps from prefix to prefix of a text are stored in blocks of BLOCK code points, each with the count before it and the
least count in it, so `counts_at` and `longest_within` inflate one block of a text and encode nothing.

The count of a prefix is that of the library for the prefix as a text of its own. It may fall as the prefix grows ("th" may be
two tokens and "the" one). White space before a word is one piece as long as the prefix ends in it; a special token counts one from its last
character on; both are taken in.

Defined results: a null text is empty and has no block; repeated rows give rows each; a null id stays null; other columns are ignored;
an empty table gives no row. Only byte-level BPE files without normalizer are read, others are an error.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gustline.llm.text import GAP, bounded_batches, mix, slices, utf8
from gustline.session import write_stage

BLOCK, LIMIT, SLICE_BYTES = 4096, 1024, 8 << 20
MEMO_BITS, MOST_PIECES, TOGETHER = 20, 1_000_000, 32_768
OPTIONS = ("spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.execution.arrow.maxBytesPerBatch")
STORED = "n_bytes long, n_chars long, n_tokens long, marks array<bigint>, least array<bigint>, steps array<binary>"
# Contractions that the tokenizer's splitting takes as pieces of three characters.
CONTRACTIONS = ("'re", "'ve", "'ll")
# Last bytes of white space other than ASCII: U+0085, U+00A0, U+1680, U+2000 to U+205F, U+3000.
ODD_ENDS = np.zeros(256, bool)
ODD_ENDS[[0x9F, 0xA0, 0xA8, 0xA9, 0xAF, *range(0x80, 0x8B)]] = True
# White space as the tokenizer's splitting has it.
BLANK = frozenset(c for c in map(chr, range(0x3001)) if c.isspace() and not "\x1c" <= c <= "\x1f")
_LOADED: dict[str, Grammar] = {}


def byte_of() -> np.ndarray:
    """Byte by code point of the printable alphabet in which byte-level vocabularies are written."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    out = np.zeros(512, np.uint8)
    out[plain] = plain
    rest = [b for b in range(256) if b not in set(plain)]
    out[256 + np.arange(len(rest))] = rest
    return out


class Grammar:
    """Vocabulary as a byte trie, merges as ranked pairs, and the steps of all pieces met so far."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.own = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        before = spec.get("pre_tokenizer") or {}
        if spec["model"]["type"] != "BPE" or before.get("type") != "ByteLevel" or spec.get("normalizer") or before.get("add_prefix_space"):
            raise ValueError(f"{path} is not a byte-level BPE without normalizer")
        self.special = [t["content"] for t in spec["added_tokens"]]
        vocab, merges = spec["model"]["vocab"], [tuple(m.split(" ") if isinstance(m, str) else m) for m in spec["model"]["merges"]]
        size = max(vocab.values()) + 1
        self.rank, self.left, self.right = (np.full(size, -1, np.int64) for _ in range(3))
        for r, (a, b) in enumerate(merges):
            t = vocab[a + b]
            if self.rank[t] < 0:
                self.rank[t], self.left[t], self.right[t] = r, vocab[a], vocab[b]
        keys = np.array([vocab[a] << 32 | vocab[b] for a, b in merges], np.int64)
        order = np.argsort(keys)
        self.pairs, self.pair_rank = keys[order], order
        self.alphabet = byte_of()
        self._build_trie({w: i for w, i in vocab.items() if w not in self.special})
        self.memo_key, self.memo = np.full(1 << MEMO_BITS, -1, np.int64), np.zeros(1 << MEMO_BITS, bool)
        self.forget()

    def _build_trie(self, vocab: dict[str, int]) -> None:
        rows: list[dict[int, int]] = [{}]
        token: list[int] = [-1]
        for word, i in vocab.items():
            node = 0
            for byte in self.alphabet[[ord(c) for c in word]].tolist():
                if byte not in rows[node]:
                    rows[node][byte] = len(rows)
                    rows.append({}), token.append(-1)
                node = rows[node][byte]
            token[node] = i
        inner = [n for n, row in enumerate(rows) if row]
        self.row = np.full(len(rows), -1, np.int32)
        self.row[inner] = np.arange(len(inner))
        self.child = np.full((len(inner), 256), -1, np.int32)
        for at, n in enumerate(inner):
            self.child[at, list(rows[n])] = list(rows[n].values())
        self.token = np.array(token, np.int64)

    def forget(self) -> None:
        """Drop the pieces met so far; they only save time."""
        self.seen: dict[bytes, int] = {}
        self.steps, self.first, self.length = np.zeros(1 << 16, np.int16), np.zeros(1 << 12, np.int64), np.zeros(1 << 12, np.int64)
        self.used = 0

    def valid(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether the merges leave token a before token b as they are."""
        key = a << 32 | b
        at = (mix(key.astype(np.uint64)) >> np.uint64(64 - MEMO_BITS)).astype(np.int64)
        out = self.memo[at]
        miss = np.flatnonzero(self.memo_key[at] != key)
        if len(miss):
            found = self._valid(a[miss], b[miss])
            out[miss] = found
            self.memo_key[at[miss]], self.memo[at[miss]] = key[miss], found
        return out

    def _valid(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        # Undo the later of the two tokens' merges, again and again. At each state a merge across the border would have come first
        # if its rank is below that of the merge last undone (or equal and to its left).
        out = np.ones(len(a), bool)
        open_ = np.arange(len(a))
        a, b = a.copy(), b.copy()
        limit = np.full(len(a), np.iinfo(np.int64).max)
        while len(open_):
            key = a << 32 | b
            at = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
            crossed = (self.pairs[at] == key) & (self.pair_rank[at] < limit)
            out[open_[crossed]] = False
            ra, rb = self.rank[a], self.rank[b]
            go = ~crossed & ((ra >= 0) | (rb >= 0))
            open_, a, b, ra, rb = open_[go], a[go], b[go], ra[go], rb[go]
            undo_a = ra > rb
            limit = np.where(undo_a, ra, rb + 1)
            a, b = np.where(undo_a, self.right[a], a), np.where(undo_a, b, self.left[b])
        return out

    def last_tokens(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Last token and number of tokens of the prefix that ends with each byte, for all spans of bytes at once."""
        count, last = np.zeros(len(data), np.int64), np.zeros(len(data), np.int64)
        begin, end = np.repeat(starts, ends - starts), np.repeat(ends, ends - starts)
        origin = np.arange(len(data))
        node, found = np.zeros(len(data), np.int32), []
        at = origin
        while len(origin):  # all tokens that start at each byte, one byte longer each time
            node = self.child[self.row[node], data[at]]
            alive = node >= 0
            origin, at, node = origin[alive], at[alive], node[alive]
            hit = self.token[node] >= 0
            found.append((origin[hit], at[hit], self.token[node[hit]]))
            on = (self.row[node] >= 0) & (at + 1 < end[at])
            origin, at, node = origin[on], at[on] + 1, node[on]
        if not found:
            return last, count
        origin, at, token = (np.concatenate(parts) for parts in zip(*found, strict=True))
        size = at - begin[at]
        order = np.argsort(size, kind="stable")
        edges = np.flatnonzero(np.diff(size[order], prepend=-1, append=-1))
        for low, high in zip(edges, edges[1:]):  # by length of the prefix
            some = order[low:high]
            o, e, t = origin[some], at[some], token[some]
            opens = o == begin[e]
            good = opens.copy()
            good[~opens] = self.valid(last[o[~opens] - 1], t[~opens])
            o, e, t, opens = o[good], e[good], t[good], opens[good]
            last[e], count[e] = t, np.where(opens, 0, count[o - 1]) + 1
        return last, count

    def pieces_of(self, texts: list[str]) -> Iterator[tuple[int, str, str]]:
        """(index of the text, piece as written in the vocabulary, its characters) of all texts by the library's own splitting.

        Texts that open with white space and end without are split many in one call: pieces never reach across such a border.
        """
        split = self.own.pre_tokenizer.pre_tokenize_str
        joint, alone = [], []
        for i, t in enumerate(texts):
            (joint if t[0] in BLANK and t[-1] not in BLANK else alone).append(i)
        for group in [*(joint[low : low + 4096] for low in range(0, len(joint), 4096)), *([i] for i in alone)]:
            whole = "".join(texts[i] for i in group)
            owners = iter(group)
            own, to = -1, 0
            for word, (a, b) in split(whole):
                if a >= to:
                    own = next(owners)
                    to += len(texts[own])
                yield own, word, whole[a:b]

    def plain_counts(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Token counts of all prefixes of all texts end to end, and code points of each; special tokens are not looked for."""
        number: dict[str, int] = {}
        plan: list[tuple[int, int, int, bool, bool]] = []  # (text, atom, code points hidden at its start, shown or not, counted or not)
        run, run_of, skip = "", -1, 0  # white space that may go on in the next piece
        for own, word, chars in self.pieces_of(texts):
            if run and own == run_of and chars[0] in BLANK:
                # white space before more: one piece while the prefix ends in it, but without its last character afterwards
                before = plan.pop()[1]
                size = len(chars[0].encode())
                plan.append((own, number.setdefault(run + word[:size], len(number)), 0, True, False))
                plan.append((own, before, 0, False, True))
                skip = 1
                if len(word) == size:
                    plan.append((own, number.setdefault(word, len(number)), 0, False, True))
                    run, skip = "", 0
                    continue
            plan.append((own, number.setdefault(word, len(number)), skip, True, True))
            skip = 0
            run, run_of = (word, own) if chars[-1] in BLANK else ("", -1)
        words = list(number)
        data = self.alphabet[np.frombuffer("".join(words).encode("utf-16-le"), np.uint16)]
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)))
        starts = np.concatenate([[0], ends[:-1]])
        counts = self.last_tokens(data, starts, ends)[1]
        closes = np.ones(len(data), bool)  # the last byte of a code point
        closes[:-1] = (data[1:] & 0xC0) != 0x80
        by_char = counts[closes]
        edges = np.concatenate([[0], np.cumsum(closes)])[np.append(starts, len(data))]
        for w in CONTRACTIONS:
            if w in number:
                by_char[edges[number[w]] + 1] = 2
        text, atom, hidden, shown, counted = (np.array(column) for column in zip(*plan, strict=True))
        order = np.argsort(text, kind="stable")
        text, atom, hidden, shown, counted = text[order], atom[order], hidden[order], shown[order], counted[order]
        base = np.concatenate([[0], np.cumsum(np.where(counted, counts[ends - 1][atom], 0))])
        opens = np.searchsorted(text, np.arange(len(texts)))
        base = base[:-1] - base[opens][text]
        n = np.where(shown, edges[atom + 1] - edges[atom] - hidden, 0)
        to = np.concatenate([[0], np.cumsum(n)])
        flat = by_char[np.repeat(edges[atom] + hidden - to[:-1], n) + np.arange(to[-1])] + np.repeat(base, n)
        return flat, np.diff(to[np.append(opens, len(text))])

    def learn(self, pieces: list[bytes]) -> None:
        """Steps of pieces not met before."""
        texts = [p.decode() for p in pieces]
        whole = " ".join(texts)
        marked = [i for i, t in enumerate(texts) if any(s in t for s in self.special)] if any(s in whole for s in self.special) else []
        skip = set(marked)
        normal = [i for i in range(len(texts)) if i not in skip]
        flat, sizes = self.plain_counts([texts[i] for i in normal]) if normal else (np.zeros(0, np.int64), np.zeros(0, np.int64))
        more = [self.marked_counts(texts[i]) for i in marked]
        flat = np.concatenate([flat, *more])
        sizes = np.concatenate([sizes, [len(m) for m in more]]).astype(np.int64)
        edges = np.concatenate([[0], np.cumsum(sizes)])
        steps = np.diff(flat, prepend=0)
        steps[edges[:-1]] = flat[edges[:-1]]
        while self.used + len(flat) > len(self.steps):
            self.steps = np.concatenate([self.steps, np.zeros_like(self.steps)])
        known = len(self.seen)
        while known + len(pieces) > len(self.first):
            self.first, self.length = (np.concatenate([x, np.zeros_like(x)]) for x in (self.first, self.length))
        self.steps[self.used : self.used + len(flat)] = steps
        self.first[known : known + len(pieces)] = self.used + edges[:-1]
        self.length[known : known + len(pieces)] = sizes
        self.seen.update(zip((pieces[i] for i in (*normal, *marked)), range(known, known + len(pieces)), strict=True))
        self.used += len(flat)

    def marked_counts(self, text: str) -> np.ndarray:
        """Counts of a text with special tokens: each is plain text up to its last character, and ends what is before it."""
        parts, base = [], 0
        while text:
            at, mark = min(((text.find(s), s) for s in self.special if s in text), default=(-1, ""))
            if at < 0:
                parts.append(base + self.plain_counts([text])[0])
                break
            counts = self.plain_counts([text[: at + len(mark) - 1]])[0]
            base_after = base + (int(counts[at - 1]) if at else 0) + 1
            parts += [base + counts, np.array([base_after])]
            base, text = base_after, text[at + len(mark) :]
        return np.concatenate(parts)

    def batch(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Steps of all texts end to end, one per code point, and the row bounds in code points."""
        data, bounds = utf8(column)
        if not len(data):
            return np.zeros(0, np.int64), np.zeros(len(bounds), np.int64)
        at = np.flatnonzero(cuts(data, bounds))
        pieces = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(at) - 1, [None, pa.py_buffer(at.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data))])
        codes = pieces.dictionary_encode()
        words = codes.dictionary.to_pylist()
        if len(self.seen) + len(words) > MOST_PIECES:
            self.forget()
        fresh = [w for w in words if w not in self.seen]
        for low in range(0, len(fresh), TOGETHER):  # so that memory does not follow the number of new pieces
            self.learn(fresh[low : low + TOGETHER])
        index = np.fromiter((self.seen[w] for w in words), np.int64, len(words))[codes.indices.to_numpy()]
        n = self.length[index]
        edges = np.concatenate([[0], np.cumsum(n)])
        steps = self.steps[np.repeat(self.first[index] - edges[:-1], n) + np.arange(edges[-1])]
        return steps.astype(np.int64), edges[np.searchsorted(at, bounds)]


def cuts(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Places where pieces begin (and the end): row bounds, and ASCII white space after a character that is no white space.

    Bytes that may end white space of other kinds prevent a cut after them; a piece is then longer, never wrong.
    """
    gap = GAP[data]
    out = np.zeros(len(data) + 1, bool)
    out[1:-1] = gap[1:] & ~gap[:-1] & ~ODD_ENDS[data[:-1]]
    out[bounds] = True
    out[-1] = True
    return out


def grammar(path: str) -> Grammar:
    if path not in _LOADED:
        _LOADED[path] = Grammar(path)
    return _LOADED[path]


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Arrow batches bounded in rows and bytes for the jobs run inside; the caller's options come back."""
    before = {k: spark.conf.get(k, None) for k in OPTIONS}
    bounded_batches(spark)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def prefix_counts(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Stored table of `key` and the counts of every prefix of every text, in blocks; read it with the functions below."""
    spark = docs.sparkSession
    schema = f"`{key}` {docs.schema[key].dataType.simpleString()}, {STORED}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in slices(batch, "text", SLICE_BYTES):
                steps, rows = grammar(path).batch(some.column(1))
                counts = np.concatenate([[0], np.cumsum(steps)])
                begins = [np.arange(a, b, BLOCK) for a, b in zip(rows, rows[1:])]
                marks, least, packed = [], [], []
                for at, a, b in zip(begins, rows, rows[1:]):
                    marks.append((counts[at] - counts[a]).tolist())
                    least.append((np.minimum.reduceat(counts[1 : b + 1], at) - counts[a]).tolist() if len(at) else [])
                    packed.append([pack(steps[i : min(i + BLOCK, b)]) for i in at])
                yield pa.RecordBatch.from_arrays([
                    some.column(0), pa.array(np.diff(utf8(some.column(1))[1])), pa.array(np.diff(rows)), pa.array(counts[rows[1:]] - counts[rows[:-1]]),
                    pa.array(marks, pa.list_(pa.int64())), pa.array(least, pa.list_(pa.int64())), pa.array(packed, pa.list_(pa.binary()))],
                    [key, "n_bytes", "n_chars", "n_tokens", "marks", "least", "steps"])

    rows = docs.select(F.col(f"`{key}`"), F.col(f"`{text}`").cast("string").alias("text"))
    with small_batches(spark):
        return spark.read.schema(schema).parquet(write_stage(rows.mapInArrow(run, schema), "prefix-counts"))


def pack(steps: np.ndarray) -> bytes:
    """Steps deflated, one byte each where all fit and two otherwise; the first byte tells."""
    kind = "i1" if steps.min() >= -128 and steps.max() <= 127 else "<i2"
    return kind[-1:].encode() + zlib.compress(steps.astype(kind).tobytes(), 1)


def unpack(block: bytes) -> np.ndarray:
    return np.frombuffer(zlib.decompress(block[1:]), "i1" if block[:1] == b"1" else "<i2").astype(np.int64)


def _asked(counts: DataFrame, asked: Column, answer, name: str) -> DataFrame:
    """counts without the stored blocks, with `name`: answer(row of the stored table, asked value), null if that is null."""
    kept = [c for c in counts.columns if c not in ("marks", "least", "steps", "asked_")]
    schema = ", ".join([*(f"`{c}` {counts.schema[c].dataType.simpleString()}" for c in kept), f"`{name}` long"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table = batch.select(["n_chars", "marks", "least", "steps", "asked_"]).to_pylist()
            out = [None if r["asked_"] is None else answer(r, r["asked_"]) for r in table]
            yield pa.RecordBatch.from_arrays([*(batch.column(batch.schema.get_field_index(c)) for c in kept), pa.array(out, pa.int64())], [*kept, name])

    return counts.withColumn("asked_", asked.cast("long")).mapInArrow(run, schema)


def counts_at(counts: DataFrame, position: Column, name: str = "tokens_at") -> DataFrame:
    """Tokens of the first `position` code points of each text (of all, if it has fewer)."""
    def answer(row: dict, asked: int) -> int:
        at = min(max(asked, 0), row["n_chars"])
        if not at:
            return 0
        k = (at - 1) // BLOCK
        return row["marks"][k] + int(unpack(row["steps"][k])[: at - k * BLOCK].sum())

    return _asked(counts, position, answer, name)


def longest_within(counts: DataFrame, budget: Column, name: str = "chars_within") -> DataFrame:
    """Code points of the longest prefix of each text with at most `budget` tokens."""
    def answer(row: dict, asked: int) -> int:
        for k in reversed(range(len(row["least"]))):
            if row["least"][k] <= asked:
                own = row["marks"][k] + np.cumsum(unpack(row["steps"][k]))
                return k * BLOCK + int(np.flatnonzero(own <= asked)[-1]) + 1
        return 0

    return _asked(counts, budget, answer, name)


def op12_prefix_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    counts = prefix_counts(docs, public_tokenizers.path("byte_bpe_50k.json"))
    return counts.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > LIMIT).alias("over_limit"))


QUERIES = {"op12_prefix_counts": op12_prefix_counts}
ORACLE: dict[str, str] = {}
