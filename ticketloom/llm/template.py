"""Main text of pages: templates deduced from equivalence classes of tokens over the pages of a host.

A token is an element with its path. Tokens that occur equally often on every page of a host share their occurrence
vector and form an equivalence class; classes on a fair share of the pages are valid and nest by path into the host's
template. The text between template tokens fills its slots. Slots of menus, footers, forms and the like, slots whose
text is the same on all pages, and slots outside the content root are dropped; what remains is the article.

Blocks of text are tokens too. A block whose occurrence vector is that of an element around it comes once with each of
those elements: it is wording of the template and no slot, on a host of any size from two pages on, in a layout on any
share of the pages. An element whose text repeats for the most part is a copied page, no layout, and loses nothing.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from itertools import chain

import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketloom.llm.common import local_if_small, read
from ticketloom.llm.html_walk import BLOCK, walk
from ticketloom.llm.url_rules import host_of
from ticketloom.session import settle_table

#: A block is constant if its class has so many pages, in an element of whose text constant blocks are under a half.
LEAST_PAGES = 2
COPIED = 0.5
SUPPORT = 0.2
MIN_PAGES = 5
SHARE = 0.5
LINKED = 0.6
SIDE_TAGS = frozenset("head title nav footer aside form script style noscript template iframe svg button select textarea menu dialog input label object embed canvas audio video".split())
SIDE_WORDS = frozenset("""ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments cookie cookies disclaimer discussion
disqus footer forum menu modal nav navbar navigation newsletter notice notices pager pagination popup promo promotion recommended related replies reply respond
responses share sharing sidebar social sponsor sponsored subscribe thread threads toolbar widget widgets""".split())
CONTENT_WORDS = frozenset("article content entry post story body main".split())


def _words(step: str) -> list[str]:
    return re.findall(r"[a-z]+", step[len(_tag(step)):])


def _tag(step: str) -> str:
    return re.match(r"[^#.@\[]*", step).group()


def is_side(path: str) -> bool:
    """Whether an element on the path is a menu, footer, form, notice, advert or the like; headers count outside articles."""
    inside = False
    for step in path.split("/")[1:]:
        tag, words = _tag(step), _words(step)
        if tag in SIDE_TAGS or any(w in SIDE_WORDS for w in words):
            return True
        inside = inside or tag == "article"
        if not inside and (tag == "header" or "header" in words):
            return True
    return False


def block_key(path: str, text: str) -> int:
    return xxhash.xxh64_intdigest(f"{path}\n{text}".encode("utf-8", "replace")) >> 1


def blocks_of(events: list[tuple]) -> Iterator[tuple[str, list[tuple[str, str]], str]]:
    """(path, pieces with their paths, text) of each block of text; the path is that of its first piece."""
    held: list[tuple[str, str]] = []
    for kind, path, text, _ in chain(events, [("break", "", "", False)]):
        if kind == "text":
            held.append((path, text))
        elif kind == "break" and held:
            if text := " ".join("".join(t for _, t in held).split()):
                yield next(p for p, t in held if t.strip()), held, text
            held = []


def events_of(page: str | None) -> list[tuple]:
    """What one walk over a page meets; everything else is taken from it."""
    return list(walk(page or "", is_side))


def tokens(events: list[tuple]) -> dict[str, list]:
    """Per path: occurrences, own characters, characters in links, and the own text."""
    out: dict[str, list] = defaultdict(lambda: [0, 0, 0, []])
    out[""][0] = 1
    for kind, path, text, linked in events:
        if kind == "open":
            out[path][0] += 1
        elif kind == "text" and (own := " ".join(text.split())):
            row = out[path]
            row[1] += len(own)
            row[2] += len(own) * linked
            row[3].append(own)
    return out


def block_tokens(events: list[tuple]) -> dict[int, list]:
    """Per block outside menus and the like, by its key: path, occurrences, characters."""
    out: dict[int, list] = {}
    known: dict[str, bool] = {}
    for path, _, text in blocks_of(events):
        if path not in known:
            known[path] = is_side(path)
        if not known[path]:
            row = out.setdefault(block_key(path, text), [path, 0, 0])
            row[1] += 1
            row[2] += len(text)
    return out


def page_tokens(pages: DataFrame, url: str = "url", page: str = "html", page_id: str = "page_id") -> DataFrame:
    """(host, path, key, page, n, chars, linked, content) for each distinct token of each page; ``key`` is null for elements."""
    narrow = pages.select(host_of(F.col(url)).alias("host"), F.xxhash64(page_id, url, page).alias("page"), F.col(page).alias("html"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 64):
                out = []
                for host, own, html in zip(*(c.to_pylist() for c in whole.slice(at, 64).columns)):
                    events = events_of(html)
                    for path, (n, chars, linked, texts) in tokens(events).items():
                        out.append((host, path, None, own, n, chars, linked, xxhash.xxh64_intdigest("\n".join(texts).encode("utf-8", "replace")) >> 1))
                    out += [(host, path, key, own, n, chars, 0, 0) for key, (path, n, chars) in block_tokens(events).items()]
                kinds = [pa.string(), pa.string(), *[pa.int64()] * 6]
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out) if out else [[]] * 8, kinds)], names=["host", "path", "key", "page", "n", "chars", "linked", "content"])

    return narrow.mapInArrow(run, "host string, path string, key long, page long, n long, chars long, linked long, content long")


def equivalence_classes(found: DataFrame) -> DataFrame:
    """(host, path, key, vector, pages, n, chars, linked, same): the tokens of each host.

    ``vector`` identifies the occurrence vector: a sum of keyed hashes of (page, occurrences), so it is formed from
    partial sums and a host with a third of all pages is no hot group. Tokens of a host with equal vectors are one class.
    """
    mark = F.xxhash64("page", "n").cast("decimal(38,0)")
    return found.groupBy("host", "path", "key").agg(
        F.sum(mark).alias("vector"), F.count(F.lit(1)).alias("pages"), F.sum("n").alias("n"), F.sum("chars").alias("chars"), F.sum("linked").alias("linked"),
        (F.min("content") == F.max("content")).alias("same"))


def deduce(rows: pd.DataFrame) -> tuple[list[str], list[str]]:
    """Content roots of one host, and the slots to drop in them, from its tokens; ``rows`` as in :func:`equivalence_classes`.

    Valid classes are those whose tokens' parents are valid too, so that they nest. Roots are the article elements of
    the template, else its main element, else a container named like content, else the smallest container that holds
    more than ``SHARE`` of the text outside side elements and links. Dropped are blocks with one and the same text on
    all pages whose other text varies and, unless the root is an article or main element, slots made of links.
    """
    total = int(rows.loc[rows["path"] == "", "pages"].iloc[0])
    classes: dict = defaultdict(list)
    for path, vector in zip(rows["path"], rows["vector"]):
        classes[vector].append(path)
    valid = {""}
    for group in sorted(classes.values(), key=lambda g: min(map(len, g))):
        valid.update(p for p in sorted(group, key=len) if p == "" or p.rpartition("/")[0] in valid)
    text: dict[str, int] = defaultdict(int)
    for path, chars, linked in zip(rows["path"], rows["chars"], rows["linked"]):
        if not is_side(path):
            steps = path.split("/")
            for i in range(1, len(steps) + 1):
                text["/".join(steps[:i])] += chars - linked
    open_ = [p for p in sorted(valid, key=lambda p: (p.count("/"), p)) if p and not is_side(p) and text[p]]
    last = {p: p.rpartition("/")[2] for p in open_}

    def top(paths: list[str]) -> list[str]:
        kept: list[str] = []
        for p in paths:
            if not any(p.startswith(k + "/") for k in kept):
                kept.append(p)
        return kept

    roots = top([p for p in open_ if _tag(last[p]) == "article"]) or top([p for p in open_ if _tag(last[p]) == "main" or "@main" in last[p]])
    clear = bool(roots)
    if not roots:
        named = [p for p in open_ if _tag(last[p]) in ("div", "section", "td") and any(w in CONTENT_WORDS for w in _words(last[p]))]
        roots = [p for p in named if text[p] > SHARE * text[""]][-1:]
    if not roots:
        roots = [p for p in open_ if _tag(last[p]) in ("body", "div", "section", "td", "html") and text[p] > SHARE * text[""]][-1:] or [""]
    varied = any(not s and c for p, s, c in zip(rows["path"], rows["same"], rows["chars"]) if any(p == r or p.startswith(r + "/") for r in roots))
    constant = [p for p, s, c, n, g in zip(rows["path"], rows["same"], rows["chars"], rows["n"], rows["pages"]) if s and c and n == g >= MIN_PAGES and g >= SHARE * total and _tag(p.rpartition("/")[2]) in BLOCK] if varied else []
    menus = [] if clear else [p for p, c, k in zip(rows["path"], rows["chars"], rows["linked"]) if k > LINKED * c]
    return roots, sorted({*constant, *menus})


def constant_blocks(classes: DataFrame) -> DataFrame:
    """(host, dropped): keys of each host's blocks that belong to its templates.

    Such a block shares its occurrence vector, on ``LEAST_PAGES`` or more, with an element around it, and the blocks
    that do make up under ``COPIED`` of the text in that element. Elements and blocks of a class meet by (host, vector).
    """
    elements = classes.where("key is null")
    blocks = classes.where(F.col("key").isNotNull() & (F.col("pages") >= LEAST_PAGES)).select("host", "vector", F.col("path").alias("inner"), "key", F.col("chars").alias("own"))
    around = elements.where(F.col("pages") >= LEAST_PAGES).select("host", "vector", "path")
    inside = (F.col("path") == "") | (F.col("inner") == F.col("path")) | F.col("inner").startswith(F.concat("path", F.lit("/")))
    shared = settle_table(blocks.join(around, ["host", "vector"]).where(inside).select("host", "path", "key", "own"), "template-shared")
    # All text of those elements: that of each block below them, partially summed by element before it is shuffled.
    steps = F.split("inner", "/")
    above = F.transform(F.sequence(F.lit(1), F.size(steps)), lambda i: F.array_join(F.slice(steps, 1, i), "/"))
    held = classes.where("key is not null").groupBy("host", F.col("path").alias("inner")).agg(F.sum("chars").alias("chars"))
    held = held.select("host", "chars", F.explode(above).alias("path")).groupBy("host", "path").agg(F.sum("chars").alias("held"))
    layouts = shared.groupBy("host", "path").agg(F.sum("own").alias("constant")).join(held, ["host", "path"]).where(F.col("constant") < F.col("held") * COPIED)
    return shared.join(layouts.select("host", "path"), ["host", "path"]).groupBy("host").agg(F.sort_array(F.collect_set("key")).alias("dropped"))


def templates(pages: DataFrame, url: str = "url", page: str = "html", page_id: str = "page_id") -> DataFrame:
    """(host, roots, constant, dropped) of every host, from all its pages."""
    classes = settle_table(equivalence_classes(page_tokens(pages, url, page, page_id)), "template-classes")
    elements = classes.where("key is null").drop("key")
    hosts = settle_table(elements.where("path = ''").select("host", F.col("pages").alias("total")), "template-hosts")
    # Pages hold finitely many tokens, so only finitely many are on a fifth of them: one host's are a bounded group.
    valid = elements.join(hosts, "host").where(F.col("pages") >= F.col("total") * SUPPORT).withColumn("vector", F.col("vector").cast("string")).drop("total")

    def of_host(rows: pd.DataFrame) -> pd.DataFrame:
        roots, constant = deduce(rows)
        return pd.DataFrame({"host": [rows["host"].iloc[0]], "roots": [roots], "constant": [constant]})

    found = valid.groupBy("host").applyInPandas(of_host, "host string, roots array<string>, constant array<string>")
    return found.join(constant_blocks(classes), "host", "left")


def extract(page: str | None, roots: list[str] | None, constant: list[str] | None, dropped: list[int] | None = None) -> str:
    """Blocks under the roots, joined by line feeds, without the template's. A page without its host's root is taken by its own tokens."""
    events, keys = events_of(page), frozenset(dropped or ())

    def blocks(roots, constant) -> list[str]:
        out, known = [], {}
        for first, pieces, text in blocks_of(events):
            taken = []
            for path, piece in pieces:
                if path not in known:
                    known[path] = any(path == r or path.startswith(r + "/") for r in roots) and path not in constant and not is_side(path)
                if known[path]:
                    taken.append(piece)
            if taken and not (keys and block_key(first, text) in keys):
                out.append(" ".join("".join(taken).split()))
        return [b for b in out if b]

    if roots and ("" in roots or any(kind == "open" and path in roots for kind, path, _, _ in events)):
        return "\n".join(blocks(roots, frozenset(constant or ())))
    rows = pd.DataFrame([(p, str(n), 1, n, c, k, False) for p, (n, c, k, _) in tokens(events).items()], columns=["path", "vector", "pages", "n", "chars", "linked", "same"])
    roots, menus = deduce(rows)
    return "\n".join(blocks(roots, frozenset(menus)))


def main_texts(pages: DataFrame, url: str = "url", page: str = "html", page_id: str = "page_id") -> DataFrame:
    """page_id, url, text and n_chars (code points) of every page's main text.

    A null or empty page has an empty text; pages with a null URL or none with ``://`` share the host of the empty
    name. Nothing of a kept slot is dropped, however long. Repeated rows come out alike; other columns are ignored,
    so their names cannot clash; an empty table gives an empty result. Wording of a host's template goes wherever it
    stands; nested elements cost no more than others, those below ``DEPTH`` levels count as one.
    """
    known = local_if_small(templates(pages, url, page, page_id), "template")
    rows = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"), F.col(page).alias("html"), host_of(F.col(url)).alias("host"))
    rows = rows.join(known, "host", "left").select("page_id", "url", "html", "roots", "constant", "dropped")
    kind = rows.schema["page_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 64):
                batch = whole.slice(at, 64)
                texts = [extract(*x).encode("utf-8", "replace").decode() for x in zip(*(batch.column(i).to_pylist() for i in (2, 3, 4, 5)))]
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return rows.mapInArrow(run, f"page_id {kind}, url string, text string, n_chars long")


def op2_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_texts(read(spark, sf_dir, "pages"))
