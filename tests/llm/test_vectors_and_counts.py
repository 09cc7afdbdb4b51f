"""Vector codes, prefix counts and whitening against brute force."""

from __future__ import annotations

import hashlib
import math
import random

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from gustline.llm import prefix_counts, vector_codes, vectors, whitening

SCHEMA = "vec_id long, embedding array<float>, label int, code string, n long, component int, of_ int, x int"
public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = public_tokenizers.path("byte_bpe_50k.json")


def rows(dims: int = 16, n: int = 60) -> list[tuple]:
    rng = np.random.default_rng(5)
    base = [(i, rng.normal(0, 0.2, dims).astype(np.float32).tolist(), [None, 1, 2][i % 3], "c", 1, 2, 3, 4) for i in range(n)]
    hot = [(1000 + i, base[0][1], 7, None, None, None, None, None) for i in range(40)]
    short = [(3000 + i, [*base[i][1][:9], *base[0][1][9:]], None, None, None, None, None, None) for i in range(5)]
    bad = [(2000, None, 1), (2001, [None, *base[0][1][1:]], 1), (2002, [float("nan"), *base[0][1][1:]], 1),
           (2003, [float("inf"), *base[0][1][1:]], 1), (2004, [], 1), (2005, [1.0, 2.0], 1)]
    return [*base, *hot, *short, base[3], base[3], (None, base[4][1], None, None, None, None, None, None), *[(*b, None, None, None, None, None) for b in bad]]


@pytest.fixture(scope="module")
def table(spark):
    return spark.createDataFrame(rows(), SCHEMA).repartition(3)


def kept(table_rows: list[tuple], scale: int, dims: int = 16) -> list[tuple]:
    return [(r[0], [math.floor(scale * float(np.float32(v))) for v in r[1]], r[2]) for r in table_rows
            if r[1] is not None and len(r[1]) == dims and all(v is not None and math.isfinite(v) for v in r[1])]


def brute_codes(table_rows: list[tuple]) -> tuple[list[tuple], str]:
    """Codes, errors and digest in plain Python."""
    own = kept(table_rows, 4096)
    own.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    size = len(own[0][1]) // 8
    part = lambda x, p: x[p * size : (p + 1) * size]
    books = [[list(part(x, p)) for _, x, _ in own[:16]] for p in range(8)]

    def best(v, book):
        return min((sum((a - b) ** 2 for a, b in zip(v, e)), k) for k, e in enumerate(book))

    for _ in range(6):
        for p in range(8):
            groups: dict[int, list] = {}
            for _, x, _ in own:
                groups.setdefault(best(part(x, p), books[p])[1], []).append(part(x, p))
            for k, g in groups.items():
                books[p][k] = [sum(c) // len(g) for c in zip(*g)]
    out, sums = [], {}
    for i, x, label in own:
        found = [best(part(x, p), books[p]) for p in range(8)]
        error = sum(d for d, _ in found)
        sums[label] = sums.get(label, 0) + error
        out.append((i, "".join(f"{k:02x}" for _, k in found), error, label))
    text = ",".join(str(v) for b in books for e in b for v in e)
    return [(i, c, e, sums[label]) for i, c, e, label in out], hashlib.sha256(text.encode()).hexdigest()


def by_key(found) -> list[tuple]:
    return sorted(found, key=lambda r: (r[0] is None, r[0] or 0, r[1:]))


def test_codes_match_plain_python(table):
    found = [tuple(r) for r in vector_codes.vector_codes(table, "embedding", "vec_id", "label").collect()]
    expected, sha = brute_codes(rows())
    assert by_key(r[:4] for r in found) == by_key(expected)
    assert {r[4] for r in found} == {sha}


def test_codes_match_their_sql(spark, tmp_path):
    clean = [r for r in rows() if r[0] is not None and r[0] < 2000 and r[1] is not None]
    clean = list({r[0]: r for r in clean}.values())
    spark.createDataFrame(clean, SCHEMA).write.parquet(f"{tmp_path}/embeddings.parquet")
    db = duckdb.connect()
    db.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{tmp_path}/embeddings.parquet/*.parquet'")
    found = vector_codes.op11_vector_codes(spark, str(tmp_path)).collect()
    assert sorted(tuple(r) for r in found) == sorted(db.execute(vector_codes.ORACLE["op11_vector_codes"]).fetchall())


@pytest.mark.parametrize("scale", [3, 2 ** 40])
def test_trie_walk_gives_all_distances(scale):
    rng = np.random.default_rng(1)
    parts = rng.integers(-scale, scale, (9000, 4))
    parts[1000:3000] = parts[0]
    entries = rng.integers(-scale, scale, (5, 4))
    shared, numbers, held, leaf = vector_codes.trie(parts)
    assert held.sum() == len(parts) and len(held) == len(np.unique(parts, axis=0))
    plain = ((parts[:, None, :].astype(object) - entries.astype(object)) ** 2).sum(axis=2)
    for low, values, distances in vector_codes.leaves(shared, numbers, vector_codes.exact(entries, numbers)):
        for k in range(0, len(values), 97):
            at = np.flatnonzero(leaf == low + k)[0]
            assert (values[k] == parts[at]).all() and (distances[k] == plain[at]).all()
    code, far = vector_codes.nearest(parts, entries)
    assert (code == plain.argmin(axis=1)).all() and (far == plain.min(axis=1)).all()


def test_few_and_no_vectors(spark):
    few = spark.createDataFrame([r for r in rows() if r[0] in (1, 2, 2000)], SCHEMA)
    assert [r.code for r in vector_codes.vector_codes(few, "embedding", "vec_id", "label").orderBy("vec_id").collect()] == ["00" * 8, "01" * 8]
    none = spark.createDataFrame([], SCHEMA)
    assert vector_codes.vector_codes(none, "embedding", "vec_id", "label").collect() == []
    assert whitening.whitened(none, "embedding", "vec_id").collect() == []
    one = whitening.whitened(few.where("vec_id = 1"), "embedding", "vec_id").collect()
    assert [(r.component, r.n, r.deviation, r.whitened) for r in one] == [(k, 1, 0, None) for k in range(1, 5)]


@pytest.mark.parametrize("n,dims,most", [(1, 1, 1), (5, 3, 10), (1000, 7, 100), (130, 4, 2 ** 40), (64, 5, 2 ** 62)])
def test_scatter_is_exact(n, dims, most):
    x = np.random.default_rng(0).integers(-most, most, (n, dims))
    ones = np.column_stack([np.ones(n, object), x.astype(object)])
    assert (whitening.scatter(x) == ones.T @ ones).all()


def test_packed_rows_round_trip():
    x = np.array([[0, -128], [127, 5], [128, 0], [-32769, 1], [2 ** 40, -1], [0, -128]])
    column = whitening.packed(x)
    assert (whitening.unpacked(column, 2) == x).all() and len(column.unique()) == 5


def test_whitening_matches_numpy(table):
    own = kept(rows(), 256)
    fit = np.array(sorted({tuple(x) for _, x, _ in own}), object)
    n, sums = len(fit), fit.sum(axis=0)
    covariance = ((n * fit.T @ fit - np.outer(sums, sums)) / n ** 2).astype(float)
    values, axes = np.linalg.eigh(covariance)
    values, axes = values[::-1], axes[:, ::-1]
    found = whitening.whitened(table, "embedding", "vec_id").collect()
    assert len(found) == 4 * len(own)
    assert {r.n for r in found} == {n} and max(r.identity_error for r in found) < 1e-9
    expected = {(i, tuple(x)) for i, x, _ in own}
    of = dict(expected)
    for r in found:
        x = np.array(of[r.vec_id], object)
        assert r.deviation == int(((n * x - sums) ** 2).sum())
        plain = float(((x * n - sums).astype(float) / n) @ axes[:, r.component - 1] / math.sqrt(values[r.component - 1]))
        assert abs(abs(r.whitened) - abs(plain)) < 1e-8
        assert math.isclose(r.explained, values[r.component - 1] / np.trace(covariance), rel_tol=1e-9)


def test_width_takes_the_most_frequent_length(table):
    assert vectors.width(table, "embedding") == 16 and vectors.width(table, "embedding", 5) == 0


ODD = ["the", "'ll", "'re", "'s", "'", "l", "r", " ", "  ", "\n", "\n\n", "\t", " ", "　", "\xa0", "é", "日本", "<|endoftext|>", "<|endof", "!", "!!", "--------",
       "1234", "x", "don't", " 's", "\x1c", "\x85", "ё", "🙂", "ing", " ab", "​", "\r\n", "'ve", "'VE"]


def texts() -> list:
    rng = random.Random(1)
    mixed = ["".join(rng.choice(ODD) for _ in range(rng.randrange(1, 14))) for _ in range(400)]
    return [None, "", *mixed, " " * 50 + "x", "-" * 200 + " b", "ab" * 300, "word " * 3000, "z" * 9000, "same", "same", "<|endoftext|>" * 3]


def count(own, text: str) -> int:
    return len(own.encode(text, add_special_tokens=False).ids)


@pytest.fixture(scope="module")
def own():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(PATH)


def test_every_prefix_counts_as_the_library_does(own):
    column = pa.array(texts())
    steps, bounds = prefix_counts.Grammar(PATH).batch(column)
    counts = np.concatenate([[0], np.cumsum(steps)])
    for text, a, b in zip(column.to_pylist(), bounds, bounds[1:]):
        text = text or ""
        assert b - a == len(text)
        places = range(1, len(text) + 1) if len(text) < 700 else [*range(1, 40), len(text) // 2, len(text)]
        assert [counts[a + k] - counts[a] for k in places] == [count(own, text[:k]) for k in places]


def test_pairs_are_valid_as_the_merges_say(own):
    grammar = prefix_counts.Grammar(PATH)
    rng = np.random.default_rng(2)
    a, b = rng.integers(256, 3000, (2, 4000))
    name = own.id_to_token
    joined = [[t.id for t in own.model.tokenize(name(int(x)) + name(int(y)))] for x, y in zip(a, b)]
    assert grammar.valid(a, b).tolist() == [j == [x, y] for j, x, y in zip(joined, a, b)]
    assert grammar.valid(a, b).tolist() == grammar._valid(a, b).tolist()


def test_stored_counts_answer_questions(spark, own):
    schema = "doc_id long, text string, n_tokens string, steps int, marks int, asked_ int"
    docs = spark.createDataFrame([(i if i else None, t, "x", 1, 2, 3) for i, t in enumerate(texts())], schema).repartition(3)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    stored = prefix_counts.prefix_counts(docs, PATH)
    assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == before
    text_of = dict(enumerate(texts()))
    at = prefix_counts.counts_at(stored, F.lit(37))
    both = prefix_counts.longest_within(prefix_counts.counts_at(stored, F.lit(5000)).drop("tokens_at").join(stored.select("doc_id", "marks", "least", "steps"), "doc_id"), F.lit(6))
    assert {(r.doc_id, r.tokens_at) for r in at.collect()} == {(i or None, count(own, (t or "")[:37])) for i, t in text_of.items()}
    rows_ = both.collect()
    assert len(rows_) == len(text_of) - 1
    for r in rows_:
        text = text_of[r.doc_id] or ""
        assert (r.n_bytes, r.n_chars, r.n_tokens) == (len(text.encode()), len(text), count(own, text))
        assert count(own, text[: r.chars_within]) <= 6
        if len(text) < 700:
            assert all(count(own, text[:k]) > 6 for k in range(r.chars_within + 1, len(text) + 1))
    assert prefix_counts.prefix_counts(docs.limit(0), PATH).collect() == []


def test_other_tokenizers_are_refused():
    with pytest.raises(ValueError):
        prefix_counts.Grammar(public_tokenizers.path("word_bpe_49k.json"))


def test_ids_of_many_pieces_are_the_library_s(own):
    from gustline.llm import token_store

    rng = random.Random(7)
    more = [*ODD, "'t", "'d", "'m", "'re's", "½", "٣", "א", "'é"]
    own_texts = ["".join(rng.choice(more) for _ in range(rng.randrange(1, 14))) for _ in range(3000)]
    column = pa.array([*own_texts, None, "", "'", "' ", "'s", "x'", " " * 40 + "x", "ab" * 300, "<|endoftext|>"])
    ids, bounds = token_store.encode(column, PATH)
    assert [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:])] == [own.encode(t or "", add_special_tokens=False).ids for t in column.to_pylist()]
