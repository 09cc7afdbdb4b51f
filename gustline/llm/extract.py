"""Main text of web pages by equivalence classes of tokens and tag rules (operator 9).

Tokens are elements that hold text, as their path of block elements, and text runs in the context of their path; the two ends of a page are tokens too.
Tokens of a host with equal occurrence vectors (the exclusive or of one hash per page and count, summed before the shuffle) found on half of its distinct pages
make a class; those not found on every page must share their container too. A class is valid if its tokens come in the same order on every page, and if it is nested: each of its
occurrences lies whole in one gap, always the same, of the class around it. Tokens out of order leave their class; a class is of two or more tokens, one of them
an element. Valid classes, each in a gap of another, are the template of the host; text runs in them are boilerplate, all other runs are slots. The slots inside the element that holds most slot text of the host, an article if
there is one, are the main text; menus, headers, footers, sidebars, notices, adverts, forms and comments are left out by tag and name.

Hosts with fewer than `pages` distinct pages have no template; their pages are read by structure alone.
Defined results: null and empty html give empty text; a null url is a host of its own; a page cut off anywhere is read as far
as it goes; repeated rows get equal texts and count as one page of the host; other columns pass.
"""

from __future__ import annotations

import html as references
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gustline.llm.text import bounded_batches
from gustline.session import write_stage

SUPPORT, PAGES = 0.5, 5
BEGIN, END, ROOT = -1, -2, -1
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<![^>]*>?|<\?[^>]*>?|<(script|style|noscript|template|svg|textarea|select|iframe)\b[^>]*(?<!/)>.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-zA-Z][\w:-]*)([^>]*)>?|[^<]+|<", re.S | re.I)
INLINE = set("a abbr b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
ALONE = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
ASIDE_TAGS = set("nav footer aside form menu dialog button header".split())
ASIDE_WORDS = set("""ad ads advert adverts advertisement banner sidebar menu nav navbar navigation footer header cookie cookies notice consent comment comments
reply share social related popup modal promo sponsor sponsored newsletter breadcrumb breadcrumbs widget login signup subscribe""".split())
MAIN = {"article", "main"}
WHOLE = MAIN | {"html", "body"}
HEAD = set("meta link base basefont bgsound noframes title script style noscript template svg textarea select iframe".split())
NAMED = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)


def _label(tag: str, attributes: str) -> str:
    names = " ".join("".join(m.groups("")) for m in NAMED.finditer(attributes)) if attributes else ""
    return tag + "".join("." + re.sub(r"\d+", "0", n) for n in names.lower().split())


def blocks(html: str | None) -> Iterator[tuple[str, str]]:
    """(path, text) of each block of text in page order; the text is decoded and its white space single."""
    stack: list[tuple[str, str]] = []
    path, run = "", []
    head = title = False  # inside head, which ends at its end tag, the first element of the body or text outside a title
    for m in TOKEN.finditer(html or ""):
        piece = m.group(0)
        if piece[0] != "<" or piece == "<":
            head = head and (title or not piece.strip())
            if not head:
                run.append(piece)
            continue
        tag = m.group(3)
        if not tag:
            if not head and m.group(1) and m.group(1).lower() in {"textarea", "select"}:
                run.append("\n")
            continue
        tag = tag.lower()
        if tag == "head" and not m.group(4).endswith("/") and all(t == "html" for t, _ in stack):
            head, title = not m.group(2), False
            run.append("\n")
            continue
        if head:
            if tag == "title":
                title = not m.group(2) and not m.group(4).endswith("/")
            if tag in HEAD or title and tag != "body" or m.group(2) and tag not in {"html", "body"}:
                continue
            head = False
        if tag in INLINE or tag == "svg":
            continue
        if tag == "br":
            run.append(" ")
            continue
        if run:
            text = " ".join(references.unescape("".join(run)).split())
            run = []
            if text:
                yield path, text
        if m.group(2):
            if any(t == tag for t, _ in stack):
                while stack.pop()[0] != tag:
                    pass
        elif tag not in VOID and not m.group(4).endswith("/"):
            while stack and stack[-1][0] in ALONE.get(tag, ()):
                stack.pop()
            if tag not in {"p"} and stack and stack[-1][0] == "p":
                stack.pop()
            stack.append((tag, _label(tag, m.group(4))))
        path = "/".join(s for _, s in stack)
    text = " ".join(references.unescape("".join(run)).split())
    if text:
        yield path, text


def aside(path: str) -> bool:
    """Whether an element on the path is no part of an article."""
    inside = False
    for label in path.split("/"):
        tag, *names = label.split(".")
        if tag in MAIN:
            inside = True
        if tag in ASIDE_TAGS and not (inside and tag == "header"):
            return True
        if tag not in WHOLE and any(w in ASIDE_WORDS for n in names for w in re.split(r"[-_]", n)):
            return True
    return False


def container(path: str) -> str:
    """Innermost article or main element of the path; else the path without its last element."""
    labels = path.split("/")
    for i in range(len(labels) - 1, -1, -1):
        if labels[i].split(".")[0] in MAIN:
            return "/".join(labels[: i + 1])
    return "/".join(labels[:-1])


def _code(*parts: str) -> int:
    return int(np.frombuffer(__import__("hashlib").blake2b("\x00".join(parts).encode("utf-8", "replace"), digest_size=8).digest(), np.int64)[0])


def tokens(html: str | None) -> Iterator[tuple[int, int, str, int]]:
    """(token, kind, container, characters of an article) in page order; kind 0: element or end of the page, 1: text run."""
    codes: dict[str, tuple[int, str, bool]] = {}
    yield BEGIN, 0, "", 0
    for path, text in blocks(html):
        if path not in codes:
            codes[path] = _code(path), container(path), aside(path)
        element, place, out = codes[path]
        yield element, 0, place, 0
        yield _code(path, text), 1, place, 0 if out else len(text)
    yield END, 0, "", 0


def order(sequence: list[int], classes: list[list[int]]) -> Iterator[tuple[int, int | None, int]]:
    """(class, token, rank) of each token of the classes on a page, and (class, None, gap) of each occurrence of a class.

    The rank is the token's place among those of its class in one occurrence, the gap tells the class around it and how many tokens of that came before. A class
    that is not ended before the one around it goes on has two gaps.
    """
    of = {code: c for c, own in enumerate(classes) for code in own}
    seen, done = Counter(), Counter()
    stack: list[list[int]] = []  # class and tokens so far of each occurrence that is not ended
    for code in sequence:
        c = of.get(code)
        if c is None:
            continue
        size = len(classes[c])
        yield c, code, done[c] - seen[code] * size
        seen[code] += 1
        if done[c] % size == 0:
            yield c, None, stack[-1][0] * 1_000_000 + stack[-1][1] if stack else ROOT
            stack.append([c, 0])
        done[c] += 1
        if all(own != c for own, _ in stack):  # cut off by the class around it
            continue
        while stack[-1][0] != c:
            yield stack[-1][0], None, ROOT - 1
            yield stack.pop()[0], None, ROOT - 2
        stack[-1][1] += 1
        if stack[-1][1] >= size:
            stack.pop()


def templates(pages: DataFrame) -> DataFrame:
    """(host_, main, constant, classes) per host: main container by slot text, codes of the text runs and number of the valid classes."""
    spark = pages.sparkSession

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            host, code, kind, where, hashed, chars = [], [], [], [], [], []
            for h, page, html in zip(*(batch.column(i).to_pylist() for i in range(3))):
                length: Counter = Counter()
                times: Counter = Counter()
                for key, k, place, n in tokens(html):
                    times[key, k, place] += 1
                    length[key, k, place] += n
                for key, n in times.items():
                    host.append(h), code.append(key[0]), kind.append(key[1]), where.append(key[2])
                    hashed.append(_code(str(page), str(n))), chars.append(length[key])
            yield pa.RecordBatch.from_arrays(
                [pa.array(host, pa.string()), pa.array(code, pa.int64()), pa.array(kind, pa.int32()), pa.array(where, pa.string()),
                 pa.array(hashed, pa.int64()), pa.array(chars, pa.int64())], ["host_", "code", "kind", "place", "page", "chars"])

    def ordered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(h, c, code, value) for h, html, classes in zip(*(batch.column(i).to_pylist() for i in range(3)))
                    for c, code, value in set(order([t[0] for t in tokens(html)], classes))]
            host, c, code, value = zip(*rows) if rows else ([], [], [], [])
            yield pa.RecordBatch.from_arrays([pa.array(host, pa.string()), pa.array(c, pa.int32()), pa.array(code, pa.int64()), pa.array(value, pa.int64())],
                                             ["host_", "class", "code", "value"])

    # one page of each group of equal pages of a host, found on hashes only
    first = pages.groupBy("host_", F.xxhash64("html").alias("page_")).agg(F.min(F.struct("page_id", "row_"))["row_"].alias("row_"))
    first = spark.read.parquet(write_stage(first, "pages"))
    counts = first.groupBy("host_").agg(F.count("*").alias("n_pages"))
    distinct = pages.join(first.select(F.col("row_").alias("kept_")), F.col("row_") == F.col("kept_"), "left_semi").dropDuplicates(["row_"])
    found = distinct.select("host_", "row_", "html").mapInArrow(run, "host_ string, code long, kind int, place string, page long, chars long")
    # a place or text run found on one page only can't be of the template, but its characters count for its container
    summed = spark.read.parquet(write_stage(found.groupBy("host_", "place", "kind", "code").agg(
        F.count("*").alias("df"), F.bit_xor("page").alias("vector"), F.sum("chars").alias("chars")), "tokens"))
    known = summed.join(spark.read.parquet(write_stage(counts, "hosts")).withColumnRenamed("host_", "of_"), F.col("host_") == F.col("of_"))
    wide = known.where((F.col("n_pages") >= PAGES) & (F.col("df") >= SUPPORT * F.col("n_pages")))
    groups = wide.groupBy("host_", "df", "vector", F.when(F.col("df") < F.col("n_pages"), F.col("place")).alias("place")).agg(
        F.sort_array(F.collect_list("code")).alias("codes"), F.collect_set(F.when(F.col("kind") == 1, F.col("code"))).alias("runs"))
    groups = groups.where((F.size("codes") > F.size("runs")) & (F.size("codes") > 1))
    listed = groups.groupBy("host_").agg(F.sort_array(F.collect_list(F.struct("codes", "runs"))).alias("c"))
    listed = spark.read.parquet(write_stage(listed.select(F.col("host_").alias("of_"), F.col("c.codes").alias("codes"), F.col("c.runs").alias("runs")), "classes"))
    # a page of the host for each check of its classes: the shuffle holds one row per token and task
    checked = pages.join(listed.select("of_", "codes"), F.col("host_") == F.col("of_")).select("host_", "html", "codes").mapInArrow(
        ordered, "host_ string, class int, code long, value long")
    same = checked.groupBy("host_", "class", "code").agg((F.min("value") == F.max("value")).alias("same"))
    valid = same.groupBy("host_", "class").agg(
        F.min(F.when(F.col("code").isNull(), F.col("same"))).alias("nested"), F.collect_list(F.when(F.col("same"), F.col("code"))).alias("kept"))
    runs = valid.where("nested").join(listed, F.col("host_") == F.col("of_")).withColumn("runs", F.array_intersect("kept", F.col("runs")[F.col("class")]))
    runs = runs.where((F.size("kept") > 1) & (F.size("kept") > F.size("runs")))
    constant = runs.groupBy("host_").agg(F.flatten(F.collect_list("runs")).alias("constant"), F.count("*").alias("classes"))
    constant = spark.read.parquet(write_stage(constant.withColumnRenamed("host_", "of_"), "constant"))
    slots = known.where("kind = 1").drop("of_").join(constant, F.col("host_") == F.col("of_"), "left").where(
        F.col("constant").isNull() | ~F.array_contains("constant", F.col("code")))
    main = slots.groupBy("host_", "place").agg(F.sum("chars").alias("chars")).groupBy("host_").agg(
        F.max(F.struct("chars", "place"))["place"].alias("main"))
    out = main.join(constant, F.col("host_") == F.col("of_"), "left").select("host_", "main", "constant", "classes")
    return spark.read.parquet(write_stage(out, "templates"))


def main_text(html: str | None, main: str | None, constant: set[int]) -> str:
    """Slots of the main element in page order."""
    found = [(p, t) for p, t in blocks(html) if not aside(p)]
    own = [x for x in found if any(label.split(".")[0] in MAIN for label in x[0].split("/"))]
    if not own and main is not None:
        own = [x for x in found if x[0] == main or x[0].startswith(main + "/") or not main]
    kept = [t for p, t in own or found if not constant or _code(p, t) not in constant]
    return " ".join(kept)


def extracted(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every row of pages."""
    spark = pages.sparkSession
    bounded_batches(spark)
    host = F.lower(F.regexp_extract(F.coalesce(F.col("url").cast("string"), F.lit("")), r"^(?:[A-Za-z][\w+.-]*:)?//(?:[^/@?#]*@)?([^/:?#]*)", 1))
    plain = pages.select("page_id", "url", F.col("html").cast("string").alias("html"), host.alias("host_"))
    plain = plain.withColumn("row_", F.xxhash64("page_id", "url", "html"))
    known = templates(plain).withColumnRenamed("host_", "of_")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(h, m, set(c or ())) for h, m, c in zip(*(batch.column(i).to_pylist() for i in (2, 3, 4)))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                                             ["page_id", "url", "text", "n_chars"])

    joined = plain.join(known, F.col("host_") == F.col("of_"), "left").select("page_id", "url", "html", "main", "constant")
    schema = joined.select("page_id", "url").schema.add("text", "string").add("n_chars", "long")
    return joined.mapInArrow(run, schema)


def op9_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extracted(spark.read.parquet(f"{sf_dir}/pages.parquet"))


QUERIES = {"op9_extract": op9_extract}
ORACLE: dict[str, str] = {}
