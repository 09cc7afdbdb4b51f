"""Operators of gustline.llm on small tables against brute force, round trips and held-out accuracy."""

from __future__ import annotations

import base64
import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from gustline.llm import (
    decontaminate, extract, language, mixing, near_join, quality_rules, sharding, text, token_store, toxicity, warc,
)

DOCS = "doc_id long, text string, lang string, source string, n_chars long, shard string, row_ int, key string, fp string, size string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sentence(rng: random.Random, n: int, stem: str = "w") -> str:
    return " ".join(f"{stem}{rng.randrange(400)}" for _ in range(n))


def documents() -> list[tuple]:
    rng = random.Random(3)
    base = sentence(rng, 120).split()
    edited = [*base[:60], "other", *base[61:]]
    texts = [None, "", " \n\t ", "one", "one", "two words", "two words", " ".join(base), " ".join(base), " ".join(edited), " ".join([*edited, "tail"]),
             sentence(rng, 30000, "long"), "a b c d e f g h\n" * 8, "é ü ß — ¿qué? " * 6, "x" * 5000, "### $$$ *** " * 9, "<|endoftext|> and   more　text  "]
    texts += [sentence(rng, rng.randrange(8, 60)) for _ in range(60)]
    rows = [(i, t, ["en", "fr", None][i % 3], [None, "a", "b", "c"][min(i % 5, 3)], None if t is None else len(t), "x", i, "k", "f", "s") for i, t in enumerate(texts)]
    return [*rows, rows[7], rows[7], (None, "no id but words", "en", "a", 1, None, None, None, None, None)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(documents(), DOCS)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def labels_of(spark, rows: list[tuple] = ()):
    return spark.createDataFrame(list(rows), "doc_id long, quality int, toxic int")


def test_words_and_windows_match_plain_python():
    column = pa.array([r[1] for r in documents()])
    data, bounds = text.utf8(column)
    starts, ends, rows = text.spans(data, bounds)
    words = [data[a:b].tobytes().decode() for a, b in zip(starts, ends)]
    assert words == [w for t in column.to_pylist() for w in WORD.findall(t or "")]
    hashes = text.span_hashes(data, starts, ends)
    assert len(set(hashes.tolist())) == len(set(words)) and len({(h, w) for h, w in zip(hashes.tolist(), words)}) == len(set(words))
    windows, row = text.windows(hashes, rows, 5)
    plain = [(i, tuple(w[k : k + 5])) for i, w in enumerate(WORD.findall(t or "") for t in column.to_pylist()) for k in range(len(w) - 4)]
    assert row.tolist() == [i for i, _ in plain] and len(set(windows.tolist())) == len({p for _, p in plain})
    keys = np.array([1, 2, 1, 3], np.uint64) << np.uint64(60)
    assert text.repeated(keys).tolist() == [True, False, True, False]


def classes_by_force(rows: list[tuple]) -> tuple[dict, dict]:
    sets = {}
    for i, t, *_ in rows:
        w = WORD.findall(t or "")
        sets.setdefault(i, frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset())
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    links: dict = collections.defaultdict(set)
    ids = [i for i in sets if sets[i] and i is not None]
    for a in ids:
        for b in ids:
            if a < b and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
                if sets[a] != sets[b]:
                    links[a].add(sets[b]), links[b].add(sets[a])
    return {i: root(i) for i in sets}, {i: len(links[i]) for i in sets}


def test_near_join_matches_all_pairs(spark, docs, empty):
    rng = random.Random(5)
    base = sentence(rng, 200, "hot").split()
    hot = []
    for i in range(60):
        w = list(base)
        for _ in range(rng.randrange(1, 4)):
            w[rng.randrange(200)] = f"new{rng.randrange(10**6)}"
        hot.append((1000 + i, " ".join(w), *[None] * 8))
    every = spark.createDataFrame([*documents(), *hot], DOCS)
    want, links = classes_by_force([*documents(), *hot])
    got = near_join.near_classes(every, few=8, block=16).collect()
    assert len(got) == len(documents()) + len(hot)
    assert all(r["class_id"] == want[r["doc_id"]] for r in got)
    assert all(r["n_links"] == links[r["doc_id"]] for r in got)
    kept = near_join.keep_one(docs)
    assert kept.columns == docs.columns
    rooted, _ = classes_by_force(documents())
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted({str(v) for v in rooted.values()})
    assert near_join.near_classes(empty).count() == 0 and near_join.keep_one(empty).count() == 0
    assert near_join.prefix_depth(0.8, 24, 8, 0.99) == 7


def test_misses_at_the_threshold_are_negligible():
    prefix = near_join.prefix_depth(near_join.THRESHOLD, near_join.TREES, near_join.DEPTH, near_join.RECALL)
    assert (1 - near_join.THRESHOLD**prefix) ** near_join.TREES < 1e-6


def test_keep_one_goes_by_text_not_by_id(spark):
    rng = random.Random(8)
    texts = [sentence(rng, 40, f"t{k}x") for k in range(6)]
    near = " ".join([*texts[1].split()[:-1], "other"])
    rows = [(None, texts[0]), (None, texts[1]), (5, near), (7, texts[2]), (7, texts[3]), (7, texts[3]), (8, texts[2]), (None, ""), (None, None), (9, " ")]
    kept = near_join.keep_one(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    want = [rows[0], rows[2], rows[3], rows[4], *rows[7:]]
    assert sorted(map(str, map(tuple, kept))) == sorted(map(str, want))


def test_templates_find_reparameterised_items(spark, docs, empty):
    item = "A farmer called Alice buys 12 red apples and Alice sells 5 of them for 3 dollars each to the old man. How many are left?"
    rows = [(1, "Intro words here. " + item.replace("Alice", "Bob").replace("12", "40") + " More words follow."),
            (2, item.replace("Alice", "Bob", 1)), (3, "12 13 14 15 16 17 18 19 20 21"), (4, item.upper()), (5, None), (6, ""), (7, item)]
    table = spark.createDataFrame(rows, "doc_id long, text string").withColumn("item_id", F.lit("clash"))
    bench = spark.createDataFrame([(9, item), (10, None), (11, ""), (12, "short one"), (13, item)], "item_id long, text string")
    got = {r["doc_id"]: r["item_ids"] for r in decontaminate.contaminated(table, bench).collect()}
    assert {1, 7} <= set(got) and not {3, 5, 6} & set(got) and got[7] == [9, 13]
    clean = decontaminate.keep_clean(table, bench)
    assert clean.columns == table.columns and {r["doc_id"] for r in clean.collect()} == {i for i, _ in rows} - set(got)
    assert decontaminate.contaminated(docs, bench).count() == 0
    assert decontaminate.contaminated(empty, bench).count() == 0
    assert decontaminate.contaminated(table, bench.limit(0)).count() == 0 and decontaminate.keep_clean(table, bench.limit(0)).count() == 7


def finder(spark, ids: list[int], items: list[str]):
    """The items found in one text, with their windows."""
    bench = spark.createDataFrame(list(zip(ids, items)), "item_id long, text string")

    def find(*texts: str) -> dict:
        table = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
        return {i: r["n_windows"] for r in decontaminate.contaminated(table, bench).collect() for i in r["item_ids"]}

    return find


def test_slots_must_agree(spark):
    find = finder(spark, [1], ["then Alice gives 5 green pears to her friend and then Alice walks home with 2 bags"])
    assert find("then Bob gives 7 green pears to her friend and then Bob walks home with 9 bags")
    assert not find("then Bob gives 7 green pears to her friend and then Carol walks home with 9 bags")


def test_one_changed_slot_does_not_clear_a_copy(spark):
    rng = random.Random(9)
    words = [w if k % 9 else "Alice" for k, w in enumerate(sentence(rng, 200, "q").replace("q", "plain").split())]
    find = finder(spark, [1], [" ".join(["So", *words])])
    for value in ("Alice", "Bob"):
        doc = ["So", *(value if w == "Alice" else w for w in words)]
        doc[100] = "Carol"
        assert doc.count(value) >= 20 and find(" ".join(doc))
    rest = ["So", *("Bob" if w == "Alice" else f"else{k}" for k, w in enumerate(words))]
    assert not find(" ".join(rest))


def test_items_of_slots_and_repeated_items_are_found(spark):
    dense = "So Alice 12 Bob 15 Carol 18 Dave 21 and Erin 24"
    find = finder(spark, [1, 2, 2], [dense, *["then add the four small numbers up again now"] * 2])
    assert find("words before it. " + dense + " and after") == {1: 5}
    assert find("words said before So Alice" + dense[8:]) == {1: 5}
    assert find("well then add the four small numbers up again now please") == {2: 2}
    assert not find("So Alice 13 Bob 15 Carol 18 Dave 22 and Erin 24") and not find("12 15 18 21")


def test_copies_are_found_whatever_their_place_and_length(spark):
    find = finder(spark, [1, 2, 3], ["What is the capital city of the country?", "Name it, Bob", "He met Ann and Bob in Rome"])
    assert set(find("Question 5 What is the capital city of the country? Paris")) == {1}
    assert set(find("name it bob")) == {2} and not find("please name it, Bob") and not find("Name it")
    assert set(find("Long ago he met Ann and Bob in Rome twice")) == {3} and not find("Long ago he met Ann and Joe in Rome twice")


def test_windows_match_brute_force_for_any_partitioning(spark):
    rng = random.Random(5)
    pool = [f"w{i}" if i % 3 else "q" * (i + 1) for i in range(12)]
    items = [" ".join(rng.choice(pool[1::3] + pool[2::3]) for _ in range(rng.randrange(5, 14))) for _ in range(12)]
    docs = [" ".join(rng.choice(pool) for _ in range(40)) for _ in range(20)]
    docs = [d + " " + items[k % 12] + " end" if k % 2 else d for k, d in enumerate(docs)] + ["", None]

    def places(item: str, doc: str) -> int:
        a, b = item.split(), (doc or "").split()
        n = min(8, len(a))
        by_shift = collections.defaultdict(set)
        for i in range(len(a) - n + 1):
            for j in range(len(b) - n + 1):
                if a[i : i + n] == b[j : j + n]:
                    by_shift[j - i].add(i)
        return max(map(len, by_shift.values()), default=0)

    want = {}
    for k, d in enumerate(docs):
        hits = {i: n for i, item in enumerate(items) if (n := places(item, d)) >= min(3, max(1, len(item.split()) - 7))}
        if hits:
            want[k] = (sorted(hits), max(hits.values()))
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    for parts in (1, 7):
        table = spark.createDataFrame([(k, d) for k, d in enumerate(docs)], "doc_id long, text string").repartition(parts)
        got = {r["doc_id"]: (r["item_ids"], r["n_windows"]) for r in decontaminate.contaminated(table, bench.repartition(parts)).collect()}
        assert got == want and len(got) >= 10
    nobody = spark.createDataFrame([(None, docs[1]), (None, docs[3]), (4, docs[0])], "doc_id long, text string")
    assert decontaminate.contaminated(nobody, bench).count() == 2


def test_full_bit_map_changes_nothing(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "bit_map", lambda windows: np.full(1 << 10, ~np.uint64(0), np.uint64))
    find = finder(spark, [1], ["then Alice gives 5 green pears to her friend and then Alice walks home with 2 bags"])
    assert set(find("then Bob gives 7 green pears to her friend and then Bob walks home with 9 bags", "other words that say nothing of it at all")) == {1}


def test_quality_features_and_bounds(spark, docs, empty):
    labels = labels_of(spark, [(i, i % 2, 0) for i in range(40)] + [(None, 1, 0), (10**6, 1, 0), (5, None, None)])
    rows = quality_rules.measured(docs)
    got = quality_rules.judged(rows, quality_rules.thresholds(rows, labels)).orderBy("id").collect()
    texts = collections.defaultdict(list)
    for i, t, *_ in documents():
        texts[i].append(t)
    assert len(got) == len(documents())
    for r in got:
        t = texts[r["id"]][0] or ""
        w = WORD.findall(t)
        seen = collections.Counter(tuple(w[k : k + 5]) for k in range(len(w) - 4))
        cover = {k + j for k in range(len(w) - 4) if seen[tuple(w[k : k + 5])] > 1 for j in range(5)}
        lines = [x for x in t.split("\n") if WORD.search(x)]
        want = (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(cover))
        assert tuple(r[c] for c in quality_rules.BASE) == want
        assert r["base_failed"] == (len(w) < 10 or 100 * len(cover) > 20 * len(w)) and (not r["kept"] or not r["base_failed"])
    kept = quality_rules.keep_good(docs, labels)
    assert kept.columns == docs.columns and kept.count() == sum(r["kept"] for r in got)
    assert quality_rules.keep_good(empty, labels_of(spark)).count() == 0
    assert abs(quality_rules.binomial_cdf(2, 10, 0.3) - 0.3827827864) < 1e-9
    assert quality_rules.bound_holds(0, 500, 0.01, 0.05) and not quality_rules.bound_holds(0, 200, 0.01, 0.05)


def test_cutoffs_are_certified_or_absent():
    import pandas as pd

    good = pd.DataFrame({"bin": [0] * 4, "good": [True] * 4, "hold": [True, True, False, False], "n": [2000, 1000, 500, 500]})
    bad = pd.DataFrame({"bin": [40, 60], "good": [False] * 2, "hold": [True, False], "n": [300, 100]})
    cut = quality_rules.choose(pd.concat([good, bad]), 0.01)
    assert cut is not None and 1 <= cut <= 60
    assert quality_rules.choose(pd.concat([good.assign(n=20), bad]), 0.01) is None
    assert quality_rules.choose(good, 0.01) is None


def test_mix_meets_targets(spark, docs, empty):
    rng = random.Random(1)
    rows = [(i, sentence(rng, rng.randrange(0, 300)) or None, None, ["a", "b", "c", "d", None][min(rng.randrange(40) // 2, 4)], 0, *[None] * 5) for i in range(400)]
    for table in (spark.createDataFrame(rows, DOCS), docs):
        mix = mixing.Mix(table.select("doc_id", "source", mixing.word_count(F.col("text")).alias("size")), ["doc_id"])
        sources = {r["s_"]: r for r in mix.sources.collect()}
        size = {s: r["source_size"] for s, r in sources.items()}
        order, total = sorted(size, key=lambda s: (s == "", s)), sum(size.values())
        weight, target, free = {s: k % 3 + 1 for k, s in enumerate(order)}, {}, set(size)
        while free:
            left, w = total - sum(target.values()), sum(weight[s] for s in free)
            over = {s for s in free if left * weight[s] / w > 3 * size[s]}
            target |= {s: 3 * size[s] for s in over} or {s: left * weight[s] / w for s in free}
            free = free - over if over else set()
        assert all(abs(sources[s]["target"] - target[s]) < 1e-6 * max(1, target[s]) for s in size)
        taken = mix.taken.groupBy("s_").agg(F.sum("words").alias("n")).collect()
        assert all(abs(r["n"] - target[r["s_"]]) <= mixing.BLOCK for r in taken)
        out = mixing.mixed(table)
        assert out.columns == table.columns
        words = out.select("doc_id", mixing.word_count(F.col("text")).alias("n")).groupBy("doc_id").agg(F.sum("n").alias("n")).collect()
        assert sum(r["n"] for r in words) == sum(r["n"] for r in taken)
    assert mixing.mixed(empty).count() == 0


def test_documents_are_never_taken_over_the_cap(spark, tmp_path):
    rng = random.Random(2)
    rows = [(i, sentence(rng, rng.randrange(0, 90)), ["tiny", "b"][i % 50 > 0]) for i in range(300)]
    spark.createDataFrame(rows, "doc_id long, text string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    got = mixing.op6_mixing(spark, str(tmp_path)).collect()
    assert len(got) == 300 and all(r["taken"] <= 3 * r["size"] for r in got)
    assert sorted(map(tuple, got)) == sorted(map(tuple, mixing.op6_mixing(spark, str(tmp_path)).collect()))


def test_shards_hold_the_mixture(spark, docs, empty):
    out = sharding.interleaved(docs.drop("shard"))
    rows = out.collect()
    assert sorted(collections.Counter(r["shard"] for r in rows).values())[0] >= len(rows) // 8
    assert all(sorted(r["slot"] for r in rows if r["shard"] == k) == list(range(sum(r["shard"] == k for r in rows))) for k in range(8))
    for source in {r["source"] for r in rows}:
        own = collections.Counter(r["shard"] for r in rows if r["source"] == source)
        assert max(own[k] for k in range(8)) - min(own[k] for k in range(8)) <= 2
    assert sharding.interleaved(empty.drop("shard")).count() == 0
    assert sharding.interleaved(docs.drop("shard").limit(3)).count() == 3


def test_tokens_round_trip(spark, docs, empty):
    from tokenizers import Tokenizer

    public = pytest.importorskip("public_tokenizers")
    path = public.path("byte_bpe_50k.json")
    own, start = Tokenizer.from_file(path), 0
    got = {(r["doc_id"], r["start"]): r for r in token_store.read_tokens(token_store.write_tokens(docs, path, shard_ids=5000)).collect()}
    assert len(got) == len(documents())
    for i, t, *_ in sorted(documents(), key=lambda r: -1 if r[0] is None else r[0]):
        ids = np.array([*own.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
        r = got[i, start]
        assert (r["n_tokens"], r["ids_crc32"]) == (len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    assert token_store.read_tokens(token_store.write_tokens(empty, path)).count() == 0


def test_grammar_decodes_at_random():
    rng = np.random.default_rng(0)
    ids = np.concatenate([rng.integers(0, 50, 20000), np.tile([1, 2, 3, 4, 4, 4], 3000)]).astype(np.uint32)
    bounds = np.array([0, 0, 7, 5000, 20001, len(ids)])
    shard = token_store.Shard(token_store.write_shard(ids, [None, 1, 2, 3, 4], bounds, 60))
    assert (shard.all() == ids).all() and len(shard.seq) < 0.7 * len(ids)
    assert all((shard.ids(k) == ids[bounds[k] : bounds[k + 1]]).all() for k in range(5))


def test_archives_round_trip(spark, tmp_path):
    pages = [(i, [None, "", "http://b.example.org/x?q=1", "https://A.example.com:81/é p", "http://[bad"][i % 5], [None, "", "<p>é</p>", "<p>two</p>" * 900][i % 4], "x") for i in range(60)]
    pages += [pages[3], (None, "http://b.example.org/", "<p>é</p>", "x"), (99, "http://h.example/", "only", "y")]
    table = spark.createDataFrame(pages, "page_id long, url string, html string, key string")
    table.write.parquet(f"{tmp_path}/pages.parquet")
    got = warc.op3_warc(spark, str(tmp_path)).collect()
    last: dict = {}
    for i, _, h, _ in pages:
        if i is not None:
            last[h or ""] = max(i, last.get(h or "", -1))
    assert len(got) == len(pages)
    by_id = {i: (h or "").encode() for i, _, h, _ in pages}
    for r in got:
        h = by_id[r["page_id"]]
        top = last[h.decode()]
        want = ("response", None) if r["page_id"] == top else ("revisit", top)
        assert (r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) == (len(h), base64.b32encode(hashlib.sha1(h).digest()).decode(), *want)
    assert warc.url_key("https://A.example.com:81/p?q") == "com,example,a:81)/p?q"
    spark.createDataFrame([], "page_id long, url string, html string").write.parquet(f"{tmp_path}/none/pages.parquet")
    assert warc.op3_warc(spark, f"{tmp_path}/none").count() == 0


def test_main_text_of_pages(spark):
    def page(k: int, body: str) -> str:
        return (f"<!DOCTYPE html><html><head><title>t{k}</title><script>var a='</p>';</script></head><body><nav><ul><li><a href=/>menu {k}</a></li></ul></nav><!-- c -->"
                f"<div class='ad'>buy {k}</div><article><h1>Head&amp;line {k}</h1><p>Share this now</p>{body}</article><section class=comments>nice {k}</section><footer>&copy; {k}</footer></body></html>")

    pages = [(k, "http://h.example/%d" % k, page(k, f"<p>First <b>part</b>{k}.\n  Next<br>line<p>Second &lt;{k}&gt;")) for k in range(8)]
    pages += [(20, None, None), (21, "http://one.example/", "<div><p>alone &amp; <i>plain</i></p></div>"), (22, "x", "")]
    pages += [pages[0], (23, "http://h.example/cut", page(9, "<p>cut he")[:260])]
    got = collections.defaultdict(list)
    for r in extract.extracted(spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("text", F.lit("clash")).withColumn("main", F.lit(1))).collect():
        got[r["page_id"]].append(r["text"])
        assert r["n_chars"] == len(r["text"])
    assert len(got[0]) == 2
    assert got[3] == ["Head&line 3 First part3. Next line Second <3>"]
    assert got[20] == [""] and got[22] == [""] and got[21] == ["alone & plain"]
    assert extract.extracted(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_articles_stay_whole(spark):
    pages = [(k, f"http://h.example/{k}", f"<body class='has-sidebar'><nav>menu</nav><article class='post has-comments'><p>Story {k} told.</p></article></body>") for k in range(5)]
    pages += [pages[2]] * 4
    got = {(r["page_id"], r["text"]) for r in extract.extracted(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    assert got == {(k, f"Story {k} told.") for k in range(5)}


def test_templates_are_ordered_and_nested_classes(spark):
    """Blocks of a class found on part of the pages are boilerplate if they keep their order and place; repeated text without an element of its own stays."""
    def page(k: int) -> str:
        box = "<div class=box><h3>Join us</h3><p>Write to the editors</p></div>" if k % 5 < 3 else ""
        duo = ["<h4>Left</h4>", "<h5>Right</h5>"][:: 1 if k % 4 else -1] if k % 5 > 1 else []
        again = "<p>Said before</p>" if k % 10 < 7 else ""
        return f"<body><article><h1>Head {k}</h1><p>Story {k}</p>{box}{again}<div class=duo>{''.join(duo)}</div><p>End {k}</p></article></body>"

    pages = [(k, f"http://h.example/{k}", page(k)) for k in range(20)]
    got = {r["page_id"]: r["text"] for r in extract.extracted(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    for k in range(20):
        duo = ["Left", "Right"][:: 1 if k % 4 else -1] if k % 5 > 1 else []
        assert got[k] == " ".join([f"Head {k}", f"Story {k}", *["Said before"] * (k % 10 < 7), *duo, f"End {k}"])


def test_order_and_gaps_of_classes():
    classes = [[1, 2, 3], [4, 5], [6, 7]]

    def checked(*sequences):
        values = collections.defaultdict(set)
        for sequence in sequences:
            for c, code, value in extract.order(sequence, classes):
                values[c, code].add(value)
        return {key for key, own in values.items() if len(own) > 1}

    assert checked([1, 4, 5, 2, 9, 3], [1, 2, 3]) == set()
    assert checked([1, 4, 5, 2, 3], [1, 2, 4, 5, 3]) == {(1, None)}  # two gaps
    assert checked([1, 4, 2, 5, 3]) >= {(1, None)} and not checked([1, 4, 2, 5, 3]) & {(0, None)}  # not whole in a gap
    assert checked([1, 6, 7, 2, 3], [1, 7, 6, 2, 3]) == {(2, 6), (2, 7)}  # two orders
    assert checked([1, 4, 5, 4, 5, 2, 3], [1, 4, 5, 2, 3]) == set()  # repeated in its gap
    assert checked([1, 4, 6, 7, 5, 2, 3]) == set()  # a class in a class


def test_head_and_empty_elements_end():
    read = lambda h: [t for _, t in extract.blocks(h)]
    assert read("<html><head><title>a <b>title</b></title><meta x><script>d.write('<div>no</div>')</script><body><p>yes</p>") == ["yes"]
    assert read("<head><meta charset=x><p>yes <svg/>and</p> no end</svg>") == ["yes and", "no end"]
    assert read("<head><title>t</title>words at once<p>more</p>") == ["words at once", "more"]
    assert read("<html><head><title>t</title></head><body><header>top</header><svg><text>no</text></svg><p>end</p>") == ["top", "end"]


def test_toxicity_learns_pairs(spark, docs, empty):
    rng = random.Random(4)
    rows = []
    for i in range(1500):
        w = sentence(rng, 30).split()
        bad, group = rng.random() < 0.5, rng.random() < 0.5
        w[3:3] = ["insult"] * bad + ["group"] * group
        rows.append((i, " ".join(w), int(bad and group)))
    table = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    machine = toxicity.fit(table.select("doc_id", "text").where(~toxicity.held_out()), table.select("doc_id", "toxic"))
    truth = {i: y for i, _, y in rows}
    got = [r for r in toxicity.scored(table, machine).collect() if r["held_out"]]
    assert sum(r["predicted"] == truth[r["doc_id"]] for r in got) >= 0.97 * len(got)
    assert toxicity.scored(docs, machine).count() == len(documents()) and toxicity.scored(empty, machine).count() == 0
    none = toxicity.fit(empty, labels_of(spark))
    assert all(0 <= r["score"] < 0.5 for r in toxicity.scored(docs, none).collect())


def test_toxicity_learns_pairs_of_equal_shares():
    rng = random.Random(8)
    texts, y = [], []
    for _ in range(3000):
        one, other = rng.random() < 0.5, rng.random() < 0.5
        texts.append(sentence(rng, 30) + " insult" * one + " group" * other)
        y.append(one != other)
    column, y = pa.array(texts), np.array(y, float)
    row, bucket = toxicity.terms(column)
    sets = [np.unique(bucket[row == i]) for i in range(len(texts))]
    machine = toxicity.Machine(sets[:2400], y[:2400], np.ones(2400))
    assert ((machine.score(column[2400:]) >= 0.5) == y[2400:]).mean() >= 0.97


def test_languages(spark, docs, empty):
    rng = random.Random(6)
    parts = {"aa": "ba be bi bo bu", "bb": "ka ke ki ko ku", "cc": "za ze zi zo zu"}
    rows = [(i, " ".join("".join(rng.choice(parts[k].split()) for _ in range(3)) for _ in range(20)), k) for i, k in enumerate(rng.choices(list(parts), k=600))]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.fit(table.where(~toxicity.held_out()))
    truth = {i: k for i, _, k in rows}
    got = [r for r in language.identified(table, model).collect() if r["held_out"]]
    assert sum(r["lang_pred"] == truth[r["doc_id"]] for r in got) >= 0.98 * len(got)
    odd = {r["doc_id"]: r for r in language.identified(docs, model).collect()}
    assert odd[0]["lang_pred"] == odd[1]["lang_pred"] == odd[15]["lang_pred"] == "und" and all(0 <= r["score"] <= 1 for r in odd.values())
    assert language.identified(empty, model).count() == 0
    assert {r["lang_pred"] for r in language.identified(docs, language.fit(empty)).collect()} == {"und"}


def test_pipeline_stages(spark, tmp_path, docs):
    import corpus_pipeline

    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    docs.select(columns).write.parquet(f"{tmp_path}/documents.parquet")
    labels_of(spark, [(i, 1, 0) for i in range(30)]).write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, documents()[30][1])], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    rows = corpus_pipeline.run(spark, str(tmp_path))
    assert rows.columns == [*columns, "shard", "slot"]
    got = {r["doc_id"] for r in rows.collect()}
    texts = {i: WORD.findall(t or "") for i, t, *_ in documents()}
    assert got and 30 not in got and not got & {0, 1, 2, 3, 4, 12} and len(got & {7, 8, 9, 10}) <= 1
    assert all(len(texts[i]) >= 10 for i in got)


def test_warc_keeps_negative_and_missing_ids_apart(spark, tmp_path):
    rows = [(-1, "https://a.example/x", "<p>one</p>"), (None, "https://a.example/x", "<p>two</p>"), (-2 ** 63, "https://a.example/y", "<p>three</p>"), (0, None, None)]
    spark.createDataFrame(rows, "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    got = {(r.page_id, r.payload_bytes) for r in warc.op3_warc(spark, str(tmp_path)).collect()}
    assert got == {(i, len(h or "")) for i, _, h in rows}


def test_keep_one_leaves_columns_as_they_are(spark):
    same = " ".join(f"w{i}" for i in range(40))
    docs = spark.createDataFrame([(1, same, 7, "a"), (2, same, 8, "b"), (3, "other words are here", 9, "c")], "doc_id long, text string, row_ int, kept_ string")
    kept = near_join.keep_one(docs)
    assert kept.schema == docs.schema
    assert sorted(tuple(r) for r in kept.collect()) == [(1, same, 7, "a"), (3, "other words are here", 9, "c")]


def test_shards_take_the_place_of_their_names(docs):
    out = sharding.interleaved(docs)
    assert out.columns == [*(c for c in docs.columns if c != "shard"), "shard", "slot"]
    assert out.count() == docs.count()
