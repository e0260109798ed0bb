"""Main text of web pages by equivalence-class template deduction.

Tokens are tags and text chunks, told apart by their path of block elements. Per host, tokens
that occur equally often on the same pages (equal occurrence vectors) form an equivalence
class. Classes with enough tokens and pages are valid; they nest by their paths and make up
the host's template. What is left between template tokens are slots; the slot of the article,
or else the innermost one with most of the host's running text, holds the main text, less the
template's own text in it. Pages of hosts without a template, and pages without the slot, use
their own article, or all their running text.

Occurrence vectors are compared by a sum of hashes of (page, count), an aggregate that is
combined before the shuffle, so a host may have any number of pages. A host's template is a
few rows: a token in it is on at least half of the host's pages.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanloom.llm.storage import Scratch

MIN_TOKENS = 3
MIN_SHARE = 0.5
MIN_RESTS, SURE_SHARE = 3, 0.9  # different texts a chunk stands beside to be template; share of slots beyond which it surely is
SLOT_MASS = 0.6
BROADCAST_BYTES = 8_000_000

_TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+>?|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*+"|'[^']*+'|["'])*+)(?:>|\Z)""", re.S)
_MARK = re.compile(r"""(?:^|\s)(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_CLOSER = {t: re.compile(rf"</{t}\b[^>]*>", re.I) for t in ("script", "style", "title", "textarea", "noscript", "template", "iframe")}

INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup "
                   "time tt u var wbr br img".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CLOSES_P = frozenset("address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main "
                     "menu nav ol p pre section table ul".split())
ITEMS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
CHROME = frozenset("head title script style noscript template iframe nav footer aside form button select option textarea input svg canvas menu "
                   "dialog object".split())
CHROME_WORDS = frozenset("ad ads advert advertisement adverts advertising sponsor sponsored promo banner sidebar menu nav navbar navigation breadcrumb "
                         "breadcrumbs cookie cookies consent notice notices alert popup modal comment comments reply replies discussion "
                         "newsletter subscribe signup share sharing social related recommended footer header masthead copyright form".split())
MAIN = ("article", "main")


@dataclass
class Node:
    """A run of text inside one block: the path of elements it stands in, whether one of them is page
    furniture by its tag or role, and the depth of the innermost one that is so by its class (0: none)."""

    path: str
    block: int
    text: str
    hard: bool
    marked: int

    @property
    def chrome(self) -> bool:
        return self.hard or self.marked > 0

    def furniture_below(self, depth: int) -> bool:
        """A class mark on an element that holds the main slot does not count, only one inside it."""
        return self.hard or self.marked > depth

    @property
    def chunk(self) -> int:
        return xxhash.xxh3_64_intdigest(" ".join(self.text.split())) - 2**63


def _name(tag: str, attributes: str) -> tuple[str, bool, bool]:
    """Element with its class and id, and whether it marks page furniture by tag or role, and by class."""
    words: list[str] = []
    role = ""
    for kind, *value in _MARK.findall(attributes) if attributes else ():
        text = "".join(value).lower()
        if kind.lower() == "role":
            role = text
        else:
            words += text.split()
    parts = {p for w in words for p in re.split(r"[^a-z]+", w)}
    name = "main" if role == "main" else tag
    label = name + "".join("." + re.sub(r"\d+", "0", w).replace(">", "_") for w in sorted(set(words)))
    hard = tag in CHROME and tag != "form" or role in ("navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alert")
    marked = (tag == "form" or tag not in MAIN and bool(parts & CHROME_WORDS)
              or tag == "article" and bool(parts & {"comment", "comments", "reply", "replies"}))
    return label, hard, marked


def parse(page: str, opened: list[str] | None = None) -> list[Node]:
    """Text runs in page order; ``opened`` gets the path of every block element. Unclosed
    paragraphs and items end where a browser would end them."""
    nodes: list[Node] = []
    stack: list[tuple[str, str, bool, int]] = []  # tag, label, page furniture (own or inherited): by tag, depth of the class
    block, at, size = 0, 0, len(page)

    def text(raw: str) -> None:
        if raw and not raw.isspace():
            furniture = stack[-1][2:] if stack else (False, 0)
            nodes.append(Node(">".join(x[1] for x in stack), block, entities.unescape(raw) if "&" in raw else raw, *furniture))
        elif raw and nodes and nodes[-1].block == block:
            nodes[-1].text += " "

    while at < size:
        found = _TOKEN.search(page, at)
        if not found:
            text(page[at:])
            break
        text(page[at:found.start()])
        at = found.end()
        tag = (found[2] or "").lower()
        if not tag:
            continue
        if tag in INLINE:
            if tag == "br" and nodes and nodes[-1].block == block:
                nodes[-1].text += " "
            continue
        block += 1
        if found[1]:
            if any(x[0] == tag for x in stack):
                while stack.pop()[0] != tag:
                    pass
            continue
        if tag in CLOSES_P and any(x[0] == "p" for x in stack):
            while stack.pop()[0] != "p":
                pass
        if tag in ITEMS:
            while stack and stack[-1][0] in ITEMS[tag] | {"p"}:
                stack.pop()
        if tag in VOID or found[3].endswith("/"):
            continue
        if tag in _CLOSER:
            end = _CLOSER[tag].search(page, at)
            at = end.end() if end else size
            continue
        label, hard, marked = _name(tag, found[3])
        inside, above = stack[-1][2:] if stack else (False, 0)
        if tag == "header" and not any(x[0] in MAIN for x in stack):
            hard = True
        stack.append((tag, label, inside or hard, len(stack) + 1 if marked else above))
        if opened is not None:
            opened.append(">".join(x[1] for x in stack))
    return nodes


def _tokens(page: str) -> tuple[Counter, Counter, Counter]:
    """Occurrences of each token (path, text hash or 0), and running text below each path: of no
    furniture at all, and of none that begins below the path."""
    counts: Counter = Counter()
    mass: Counter = Counter()
    inner: Counter = Counter()
    opened: list[str] = []
    for n in parse(page, opened):
        size = len(" ".join(n.text.split()))
        counts[n.path, n.chunk] += 1
        if not n.hard:
            parts = n.path.split(">")
            for depth in range(max(1, n.marked), len(parts) + 1):
                inner[">".join(parts[:depth])] += size
            for depth in range(1, 1 if n.marked else len(parts) + 1):
                mass[">".join(parts[:depth])] += size
    counts.update((path, 0) for path in opened)
    counts["", 0] = 1
    return counts, mass, inner


_ROWS = "host string, path string, chunk bigint, n int, mass bigint, inner bigint, page bigint"


def occurrences(pages: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for host, page in zip(*(c.to_pylist() for c in batch.columns)):
                counts, mass, inner = _tokens(page or "")
                key = xxhash.xxh3_64_intdigest(page or "") >> 1
                rows += [(host, path, chunk, n, 0 if chunk else mass[path], 0 if chunk else inner[path], key) for (path, chunk), n in counts.items()]
            types = (pa.string(), pa.string(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            names = ["host", "path", "chunk", "n", "mass", "inner", "page"]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * 7, types)], names=names)

    return pages.select("host", "html").mapInArrow(run, _ROWS)


def _key(path: str, chunk: int) -> int:
    """A text chunk at its path, as one number."""
    return xxhash.xxh3_64_intdigest(f"{path}\n{chunk}") - 2**63


_TEMPLATE = "host string, slot string, fixed array<bigint>, classes int, depth int"


def deduce(rows: DataFrame) -> DataFrame:
    """One template per host: the main slot's path, its fixed text chunks, the number and nesting depth of its classes."""
    vector = F.sum(F.pmod(F.xxhash64("page", "n"), F.lit(2**31)))
    tokens = rows.groupBy("host", "path", "chunk").agg(
        vector.alias("vector"), F.count(F.lit(1)).alias("pages"), F.sum("n").alias("n"), F.sum("mass").alias("mass"),
        F.sum("inner").alias("inner"), (F.min("page") < F.max("page")).alias("varied"))
    # every page has the empty token once; tokens of one page only are in no template, without them a host's rows are few
    sizes = tokens.where((F.col("path") == "") & (F.col("chunk") == 0)).select("host", F.col("pages").alias("all"))
    tokens = tokens.where("pages >= 2").join(sizes, "host").where(F.col("pages") >= MIN_SHARE * F.col("all"))
    types = {"host": pa.string(), "slot": pa.string(), "fixed": pa.list_(pa.int64()), "classes": pa.int32(), "depth": pa.int32()}

    def build(key: tuple, group: pa.Table) -> pa.Table:
        classes: dict[tuple, list[dict]] = {}
        for token in group.to_pylist():
            classes.setdefault((token["vector"], token["pages"], token["n"]), []).append(token)
        valid = {c: t for c, t in classes.items() if len(t) >= MIN_TOKENS}
        slot, depth = choose_slot(valid)
        # text that only copies of one page share is their own
        fixed = sorted(_key(t["path"], t["chunk"]) for tokens in valid.values() for t in tokens if t["chunk"] and t["varied"])
        return pa.table({n: pa.array([v], types[n]) for n, v in
                         {"host": key[0].as_py(), "slot": slot, "fixed": fixed, "classes": len(valid), "depth": depth}.items()})

    return tokens.groupBy("host").applyInArrow(build, _TEMPLATE)


def choose_slot(classes: dict[tuple, list[dict]]) -> tuple[str | None, int]:
    """Nest the classes' element tokens by path and pick the article's slot, else the innermost with most text.

    Furniture by class holds no slot, unless it holds most of the host's running text: then the
    class is that of a wrapper.
    """
    elements = [t for tokens in classes.values() for t in tokens if not t["chunk"] and t["path"]]
    paths = {t["path"]: t["mass"] for t in elements}
    if not paths:
        return None, 0
    if max(paths.values()) < (1 - SLOT_MASS) * max(t["inner"] for t in elements):
        paths = {t["path"]: t["inner"] for t in elements}
    parents: dict[str, str | None] = {}
    for path in paths:
        parts = path.split(">")
        parents[path] = next((p for d in range(len(parts) - 1, 0, -1) if (p := ">".join(parts[:d])) in paths), None)

    def depth(path: str) -> int:
        return 1 + depth(parents[path]) if parents[path] else 1

    deepest = max(map(depth, paths))
    whole = max(paths.values())
    article = [p for p in paths if p.rsplit(">", 1)[-1].split(".")[0] in MAIN and paths[p]]
    if article:
        return max(article, key=lambda p: (paths[p], -depth(p), p)), deepest
    good = [p for p in paths if whole and paths[p] >= SLOT_MASS * whole]
    return (max(good, key=lambda p: (depth(p), paths[p], p)) if good else None), deepest


def slot_nodes(page: str | None, slot: str | None) -> list:
    """The slot's nodes without furniture; of a page without the slot those of its own article, or all running text."""
    nodes = parse(page or "")
    main = [n for n in nodes if slot and (n.path + ">").startswith(slot + ">")]
    if main:
        depth = slot.count(">") + 1
        return [n for n in main if not n.furniture_below(depth)]
    nodes = [n for n in nodes if not n.chrome]
    return [n for n in nodes if any(x.split(".")[0] in MAIN for x in n.path.split(">"))] or nodes


def _size(nodes: list) -> int:
    return sum(len(" ".join(n.text.split())) for n in nodes)


def extract(page: str | None, slot: str | None, fixed: frozenset, likely: frozenset = frozenset()) -> str:
    """Text of the slot: blocks in order, furniture and the template's text left out. No slot is emptied that way,
    and text that is only likely the template's stays where it is more than half of the slot."""
    main = slot_nodes(page, slot)
    main = [n for n in main if _key(n.path, n.chunk) not in fixed] or main
    if likely:
        left = [n for n in main if _key(n.path, n.chunk) not in likely]
        main = left if 2 * _size(left) >= _size(main) else main
    blocks: list[str] = []
    last = None
    for n in main:
        if n.block == last:
            blocks[-1] += n.text
        else:
            blocks.append(n.text)
        last = n.block
    return " ".join(x for b in blocks if (x := " ".join(b.split())))


def confirm(pages: DataFrame, templates: DataFrame) -> DataFrame:
    """Templates whose ``fixed`` holds only chunks that stand beside different text: at least ``MIN_RESTS``
    times with another rest of the slot, and in ``SURE_SHARE`` of a host's different slots; ``likely`` holds those
    of ``MIN_SHARE``. The chunks of an article that several pages share have one rest among them, whatever
    else on those pages differs outside the slot."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for host, page, slot, fixed in zip(*(c.to_pylist() for c in batch.columns)):
                keys = sorted(_key(n.path, n.chunk) for n in slot_nodes(page, slot))
                rows.append((host, None, _digest(keys)))
                rows += [(host, key, _digest([k for k in keys if k != key])) for key in set(fixed).intersection(keys)]
            types = (pa.string(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * 3, types)], names=["host", "key", "rest"])

    asked = pages.join(templates.where(F.size("fixed") > 0).select("host", "slot", "fixed"), "host").select("host", "html", "slot", "fixed")
    rests = asked.mapInArrow(run, "host string, key bigint, rest bigint").distinct().groupBy("host", "key").agg(F.count(F.lit(1)).alias("n"))
    slots = rests.where("key IS NULL").select("host", F.col("n").alias("slots"))
    rests = rests.where("key IS NOT NULL").join(slots, "host").where((F.col("n") >= MIN_RESTS) & (F.col("n") >= MIN_SHARE * F.col("slots")))
    sure = F.col("n") >= SURE_SHARE * F.col("slots")
    # a host's chunks are few: each is on a large part of its pages
    kept = rests.groupBy("host").agg(F.sort_array(F.collect_list(F.when(sure, F.col("key")))).alias("sure"),
                                     F.sort_array(F.collect_list(F.when(~sure, F.col("key")))).alias("likely"))
    none = F.array().cast("array<bigint>")
    return templates.join(kept, "host", "left").withColumn("fixed", F.coalesce("sure", none)).withColumn("likely", F.coalesce("likely", none)).drop("sure")


def _digest(keys: list[int]) -> int:
    return xxhash.xxh3_64_intdigest(np.array(keys, dtype=np.int64).tobytes()) >> 1


def main_text(pages: DataFrame, scratch: Scratch) -> DataFrame:
    """``text`` for every row of ``pages`` (page_id, url, html): page_id, url, text.

    Null html gives an empty text; pages without a readable host share one template. Repeated
    rows repeat. White space, also non-breaking, becomes one space; nothing else is cut.
    """
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@]*@)?([^/:?#]+)", 1))
    named = pages.select("page_id", "url", "html", host.alias("host"))
    deduced = scratch.store(deduce(occurrences(named)))
    templates = scratch.store(confirm(named.select("host", "html"), deduced))
    scratch.drop(deduced)
    size = templates.agg(F.sum(F.length("host") + F.coalesce(F.length("slot"), F.lit(0)) + 8 * F.size("fixed") + 8 * F.size("likely") + 32)).first()[0] or 0
    # one small row per host: sent to all tasks while that stays small, else joined by host
    templates = F.broadcast(templates) if size <= BROADCAST_BYTES else templates

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [extract(h, s, frozenset(f or ()), frozenset(m or ())) for h, s, f, m in zip(*(batch.column(i).to_pylist() for i in (2, 3, 4, 5)))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string())], names=["page_id", "url", "text"])

    both = named.join(templates.select("host", "slot", "fixed", "likely"), "host", "left").select("page_id", "url", "html", "slot", "fixed", "likely")
    return both.mapInArrow(run, "page_id bigint, url string, text string")
