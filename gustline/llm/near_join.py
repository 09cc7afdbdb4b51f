"""N-gram Jaccard join by banded MinHash with exact verification (operator 10).

Every text is a set of hashed five-word shingles (a text of one to four words is one shingle of all its words). Each of
`trees` bands holds one hash of some MinHash values of a text; texts that share a band are candidates, verified on the whole
shingle sets. The number of values (`depth` at most) is the largest at which a pair at the threshold shares a band with the target
recall. This is not an LSH forest: there are no tries and nothing is shortened per text. With one threshold for all texts the descent of
a forest with these trees would end at this length for every text, and texts that share a longer prefix share this one too. Expected
misses of pairs at similarity 0.8: (1 - 0.8^7)^64 = 2.9e-7; fewer above.

Texts with equal shingle sets are one node of the graph, so copies are never expanded. Nodes of up to `few` texts are compared
pair by pair. Larger ones are united to clusters, cut into blocks, and each pair of blocks is compared by matrix
products: no pair leaves its task, only counts of links and a spanning forest.

Defined results: null, empty and blank texts have no shingle, link to nothing and are a class of their own; repeated rows share a
class; class_id is the smallest doc_id of a class; other columns are ignored. An empty table gives an empty result. keep_one goes by
texts, not by ids: different texts under one id or under none are different classes, and rows of blank text all stay.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gustline.llm.text import bounded_batches, mix, slices, span_hashes, spans, utf8, windows
from gustline.session import write_stage

WORDS, THRESHOLD, TREES, DEPTH, RECALL, FEW, BLOCK = 5, 0.8, 64, 8, 0.999999, 16, 128


def prefix_depth(threshold: float, trees: int, depth: int, recall: float) -> int:
    """Most MinHash values a band can hold so that a pair at the threshold shares a band with the wanted chance."""
    while depth > 1 and 1 - (1 - threshold**depth) ** trees < recall:
        depth -= 1
    return depth


def shingles(part: pa.RecordBatch, size: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of all rows, row by row, and the row bounds in them."""
    data, bounds = utf8(part.column(part.schema.get_field_index("text")))
    starts, ends, rows = spans(data, bounds)
    hashes = span_hashes(data, starts, ends)
    found, row = windows(hashes, rows, size)
    counts = np.diff(rows)
    for n in range(1, size):
        own = np.flatnonzero(counts == n)
        if len(own):
            at = rows[:-1][own]
            whole = np.full(len(own), n, np.uint64)
            for k in range(n):
                whole = mix(whole + hashes[at + k])
            found, row = np.concatenate([found, whole]), np.concatenate([row, own])
    order = np.lexsort((found, row))
    found, row = found[order], row[order]
    fresh = np.ones(len(found), bool)
    fresh[1:] = (found[1:] != found[:-1]) | (row[1:] != row[:-1])
    found, row = found[fresh], row[fresh]
    return found, np.searchsorted(row, np.arange(part.num_rows + 1))


def prints(found: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows that have shingles, and the 16-byte fingerprint of the shingle set of each."""
    has = np.flatnonzero(np.diff(bounds))
    at = bounds[:-1][has]
    if not len(has):
        return has, np.zeros((0, 2), np.uint64)
    halves = [np.add.reduceat(mix(found + np.uint64(salt)), at) for salt in (1, 2)]
    return has, np.stack(halves, 1)


def _sign(trees: int, depth: int, prefix: int):
    factors = np.random.default_rng(10).integers(1, 1 << 63, (trees, depth), dtype=np.uint64) | np.uint64(1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                found, bounds = shingles(part)
                has, fp = prints(found, bounds)
                at = bounds[:-1][has]
                nodes = np.zeros((len(has), trees), np.uint64)
                for t in range(trees if len(has) else 0):
                    for k in range(prefix):
                        nodes[:, t] = mix(nodes[:, t] * np.uint64(31) + np.minimum.reduceat(found * factors[t, k], at))
                keys, labels = np.full(part.num_rows, None, object), np.full(part.num_rows, None, object)
                for i, r in enumerate(has):
                    keys[r], labels[r] = fp[i].tobytes(), nodes[i].view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(part.schema.get_field_index(c)) for c in ("doc_id", "row_")), pa.array(keys, pa.binary()),
                     pa.array(labels, pa.list_(pa.int64()))], ["doc_id", "row_", "fp", "nodes"])

    return run


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch):
            found, bounds = shingles(part)
            has, fp = prints(found, bounds)
            lists = [found[bounds[r] : bounds[r + 1]].view(np.int64) for r in has]
            yield pa.RecordBatch.from_arrays(
                [pa.array([x.tobytes() for x in fp], pa.binary()), pa.array(lists, pa.list_(pa.int64()))], ["fp", "grams"])


def _common(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Number of shingles each left set shares with each right set, by matrix products over runs of the vocabulary."""
    values = np.concatenate([*left, *right])
    row = np.repeat(np.arange(len(left) + len(right)), [len(x) for x in (*left, *right)])
    _, code, times = np.unique(values, return_inverse=True, return_counts=True)
    keep = times[code] > 1
    code, row = code[keep], row[keep]
    order = np.argsort(code, kind="stable")
    code, row = code[order], row[order]
    out = np.zeros((len(left), len(right)), np.float32)
    width = 4096
    wide = int(code[-1]) + 1 if len(code) else 0
    for low in range(0, wide, width):
        a, b = np.searchsorted(code, [low, low + width])
        if a == b:
            continue
        hit = np.zeros((len(left) + len(right), width), np.float32)
        hit[row[a:b], code[a:b] - low] = 1
        out += hit[: len(left)] @ hit[len(left) :].T
    return out


def _compare(threshold: float):
    def run(frame: pd.DataFrame) -> pd.DataFrame:
        i, j = int(frame["bi"].iloc[0]), int(frame["bj"].iloc[0])
        frame = frame.sort_values("fp")
        a, b = frame[frame["block"] == i], frame[frame["block"] == j]
        left, right = list(a["grams"]), list(b["grams"])
        shared = _common(left, right)
        na, nb = np.array([len(x) for x in left]), np.array([len(x) for x in right])
        linked = shared >= threshold * (na[:, None] + nb[None, :] - shared) - 1e-6
        if i == j:
            np.fill_diagonal(linked, False)
            keys = list(a["fp"])
            graph, links = linked, linked.sum(1)
        else:
            keys = [*a["fp"], *b["fp"]]
            graph = np.zeros((len(keys), len(keys)), bool)
            graph[: len(left), len(left) :] = linked
            graph |= graph.T
            links = np.concatenate([linked.sum(1), linked.sum(0)])
        root = np.arange(len(keys))
        while True:
            low = np.minimum(root, np.where(graph, root[None, :], len(keys)).min(1, initial=len(keys)))
            low = low[low]
            if (low == root).all():
                break
            root = low
        return pd.DataFrame({"fp": keys, "other": [keys[r] for r in root], "n_links": links.astype("int64")})

    return run


def components(edges: DataFrame) -> DataFrame:
    """(id, root) of every id on an edge (a, b): smallest id of its component, by alternating large and small stars.

    Each round is two joins on minima and never holds the neighbours of an id; rounds are written to the shared folder."""
    spark = edges.sparkSession
    edges = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    state, before = spark.read.parquet(write_stage(edges, "cc")), None
    while True:
        both = state.union(state.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.greatest("b", "m").alias("x"), F.least("b", "m").alias("m")).union(low.select("a", "m"))
        state = spark.read.parquet(write_stage(small.toDF("a", "b").where("a <> b").distinct(), "cc"))
        now = state.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    roots = state.select(F.col("a").alias("id"), F.col("b").alias("root"))
    return spark.read.parquet(write_stage(roots.union(state.select("b", "b").distinct()), "cc"))


def _graph(texts: DataFrame, threshold: float = THRESHOLD, trees: int = TREES, depth: int = DEPTH,
           recall: float = RECALL, few: int = FEW, block: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """(doc_id, row_, fp, nodes) of every row of texts (doc_id, text, row_), and (fp, doc_id, first, n_copies, root, n_links) of every
    text that has shingles; first is (no id, doc_id, row_) of its row with the smallest id."""
    spark = texts.sparkSession
    bounded_batches(spark)
    prefix = prefix_depth(threshold, trees, depth, recall)
    signed = spark.read.parquet(write_stage(
        texts.mapInArrow(_sign(trees, depth, prefix), "doc_id long, row_ long, fp binary, nodes array<long>"), "forest"))
    reps = spark.read.parquet(write_stage(
        signed.where("fp is not null").groupBy("fp").agg(
            F.min("doc_id").alias("doc_id"), F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row_")).alias("first"), F.count("*").alias("n_copies"), F.first("nodes").alias("nodes")), "texts"))
    leaves = reps.select("fp", F.posexplode("nodes").alias("tree", "node"))
    shared = spark.read.parquet(write_stage(
        leaves.groupBy("tree", "node").agg(F.count("*").alias("n"), F.min("fp").alias("head")).where("n > 1"), "nodes"))
    members = spark.read.parquet(write_stage(leaves.join(shared, ["tree", "node"]).select("tree", "node", "fp", "n", "head"), "members"))
    hot = components(members.where(F.col("n") > few).select(F.col("fp").alias("a"), F.col("head").alias("b")))
    hot = hot.select(F.col("id").alias("fp"), F.col("root").alias("cluster"))
    member = F.struct("fp", "cluster")
    inner = F.transform(F.col("all"), lambda x: F.struct(
        x["fp"].alias("a"), F.filter("all", lambda y: (y["fp"] > x["fp"]) & ~F.coalesce(y["cluster"] == x["cluster"], F.lit(False))).alias("bs")))
    pairs = (members.where(F.col("n") <= few).join(hot, "fp", "left").groupBy("tree", "node").agg(F.collect_list(member).alias("all"))
             .select(F.explode(inner).alias("p")).select("p.a", F.explode("p.bs.fp").alias("b")).distinct())
    pairs = spark.read.parquet(write_stage(pairs, "pairs"))

    wanted = pairs.select("a").union(pairs.select("b")).union(hot.select("fp")).toDF("fp").distinct()
    wanted = spark.read.parquet(write_stage(reps.join(wanted, "fp").select("fp", "doc_id"), "wanted"))
    own = texts.join(wanted.select(F.col("doc_id").alias("wanted_id")).distinct(), F.col("doc_id").eqNullSafe(F.col("wanted_id")), "left_semi")
    grams = own.mapInArrow(_sets, "fp binary, grams array<long>").join(wanted.select("fp"), "fp", "left_semi").dropDuplicates(["fp"])
    grams = spark.read.parquet(write_stage(grams, "grams"))

    left = pairs.join(grams.toDF("a", "ga"), "a").join(grams.toDF("b", "gb"), "b")
    same = F.size(F.array_intersect("ga", "gb"))
    links = left.where(same >= threshold * (F.size("ga") + F.size("gb") - same) - 1e-6).select("a", "b")
    links = spark.read.parquet(write_stage(links, "links"))

    sizes = hot.groupBy("cluster").agg(F.ceil(F.count("*") / block).cast("int").alias("blocks"))
    placed = hot.join(sizes, "cluster").join(grams, "fp").withColumn("block", F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int"))
    placed = placed.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "fp", "grams", "cluster", "block", F.least("block", "with").alias("bi"), F.greatest("block", "with").alias("bj"))
    compared = placed.groupBy("cluster", "bi", "bj").applyInPandas(_compare(threshold), "fp binary, other binary, n_links long")
    compared = spark.read.parquet(write_stage(compared, "blocks"))

    edges = links.union(compared.where("fp <> other").select("fp", "other"))
    roots = components(edges.toDF("a", "b"))
    counts = (links.select(F.col("a").alias("fp")).union(links.select("b")).groupBy("fp").agg(F.count("*").alias("n_links"))
              .union(compared.groupBy("fp").agg(F.sum("n_links"))).groupBy("fp").agg(F.sum("n_links").alias("n_links")))
    nodes = reps.select("fp", "doc_id", "first", "n_copies").join(roots.toDF("fp", "root"), "fp", "left").join(counts, "fp", "left")
    nodes = nodes.select("fp", "doc_id", "first", "n_copies", F.coalesce("root", "fp").alias("root"), F.coalesce("n_links", F.lit(0)).alias("n_links"))
    return signed, spark.read.parquet(write_stage(nodes, "graph"))


def near_classes(docs: DataFrame, threshold: float = THRESHOLD, trees: int = TREES, depth: int = DEPTH,
                 recall: float = RECALL, few: int = FEW, block: int = BLOCK) -> DataFrame:
    """One row per row of docs: doc_id, class_id, n_links (other texts at the threshold or above), n_copies (rows of this text)."""
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), F.lit(0).cast("long").alias("row_"))
    signed, nodes = _graph(texts, threshold, trees, depth, recall, few, block)
    classes = nodes.groupBy("root").agg(F.min("doc_id").alias("class_id"))
    nodes = nodes.join(classes, "root").select("fp", "class_id", "n_links", "n_copies")
    nodes = docs.sparkSession.read.parquet(write_stage(nodes, "classes"))
    return signed.select("doc_id", "fp").join(nodes, "fp", "left").select(
        "doc_id", F.coalesce("class_id", "doc_id").alias("class_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("n_copies", F.lit(1)).cast("long").alias("n_copies"))


def keep_one(docs: DataFrame) -> DataFrame:
    """Documents with one row of each class of texts, that of the smallest doc_id, and every row of blank text."""
    row = F.xxhash64(*docs.columns)
    _, nodes = _graph(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), row.alias("row_")))
    kept = nodes.groupBy("root").agg(F.min("first")["row_"].alias("kept_")).select("kept_")
    kept = docs.sparkSession.read.parquet(write_stage(kept, "kept"))
    worded = F.coalesce(F.col("text").cast("string"), F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])  # so that no column can clash with the helpers
    rows = docs.where(worded).select(whole.alias("whole_"), row.alias("row_")).join(kept, F.col("row_") == F.col("kept_"), "left_semi")
    return rows.dropDuplicates(["row_"]).select("whole_.*").union(docs.where(~worded))


def op10_near_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_classes(spark.read.parquet(f"{sf_dir}/documents.parquet"))


QUERIES = {"op10_near_join": op10_near_join}
ORACLE: dict[str, str] = {}
