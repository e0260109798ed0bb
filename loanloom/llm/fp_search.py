"""Ranked lexical search with a document FP-tree and branch and bound.

Documents are reduced to the terms that occur in the items, most frequent term first, so that
documents share the beginnings of their vectors. A task turns its documents, shard after shard, into
a tree of such shared beginnings: documents sorted by vector, nodes as ranges of that order, leaves
of at most ``LEAF_DOCS`` documents. For subtrees it keeps the largest frequency of every term below
and the smallest length factor m. As a term's part of a score grows with its frequency and falls
with m, these bound every score in the subtree. An item walks the tree depth first, best bound first,
and leaves out subtrees that cannot enter its list; its list goes on from shard to shard of a task.
The lists of all tasks are merged by a window.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loanloom.llm.caches import using
from loanloom.llm.storage import Scratch

#: Distinct (item, term) pairs held by the driver and each task at once; items beyond go in further blocks.
BLOCK_TERMS = 500_000
LEAF_DOCS = 16
SHARD_ENTRIES = 1 << 20  # vector entries of a tree, but for one longer document
FANOUT = 4  # a node keeps own maxima if it has at most a quarter of the documents of the last one above that does
NO_ID = 2**63 - 1

K1_PART, M_FLOOR, M_SLOPE, UNIT = 8, 25, 75, 1_000_000_000
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: The same words on UTF-8 bytes: what is no word becomes a space, A-Z their small letters, all else stays.
_PLAIN = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))

_VECTORS = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("terms", pa.list_(pa.int32())), ("tfs", pa.list_(pa.int32()))])
_FOUND = pa.schema([("item", pa.int64()), ("doc_id", pa.int64()), ("score", pa.int64())])


def terms_of(text: Column) -> Column:
    return F.regexp_extract_all(F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER), F.lit(f"({WORD})"), F.lit(1))


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def length_factor(n: int, n_docs: int, n_terms: int) -> int:
    return M_FLOOR + (M_SLOPE * n * n_docs) // n_terms


def part(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    """A term's part of a score before its weight; grows with tf and falls with m."""
    return (UNIT * tf) // (1000 * tf + K1_PART * m)


# -- the tree ---------------------------------------------------------------

class Tree:
    """Documents of one shard below shared vector beginnings.

    ``terms`` are ranks in descending document frequency, ascending within a document; no document is
    without terms. Arrays are flat: node i covers the sorted documents ``lo[i]:hi[i]``; ``own[i]`` is the
    number of the maxima that bound it.
    """

    def __init__(self, ids: np.ndarray, m: np.ndarray, sizes: np.ndarray, terms: np.ndarray, tfs: np.ndarray, n_terms: int,
                 leaf_docs: int = LEAF_DOCS):
        starts = np.concatenate([[0], np.cumsum(sizes)])
        raw = terms.astype(">u4").tobytes()
        keys = [raw[4 * a:4 * b] for a, b in zip(starts, starts[1:])]
        order = np.array(sorted(range(len(keys)), key=keys.__getitem__), dtype=np.int64)
        shared = self._shared([keys[i] for i in order])
        self.ids, self.m, sizes = ids[order], m[order], sizes[order]
        self.starts = np.concatenate([[0], np.cumsum(sizes)])
        place = np.repeat(starts[:-1][order] - self.starts[:-1], sizes) + np.arange(self.starts[-1])
        self.terms, tfs = terms[place], tfs[place].astype(np.int64)
        self.parts = part(tfs, np.repeat(self.m, sizes))
        self.n_terms, self.leaf_docs = n_terms, leaf_docs
        self._grow(shared)
        self._bound(tfs)

    @staticmethod
    def _shared(keys: list[bytes]) -> np.ndarray:
        """Terms that neighbours in the order share at their beginning; entry i is for i - 1 and i."""
        out = np.zeros(len(keys), dtype=np.int64)
        for i in range(1, len(keys)):
            a, b = keys[i - 1], keys[i]
            n = min(len(a), len(b))
            if a[:n] == b[:n]:
                out[i] = n // 4
            else:
                out[i] = np.argmax(np.frombuffer(a, "u4", n // 4) != np.frombuffer(b, "u4", n // 4))
        return out

    def _grow(self, shared: np.ndarray) -> None:
        self.lo, self.hi, self.children, self.own = [0], [len(shared)], [[]], [0]
        self.maps, self.generation = [0], [0]  # nodes with own maxima, and how many such nodes are above each
        at = 0
        while at < len(self.lo):
            lo, hi = self.lo[at], self.hi[at]
            if hi - lo > self.leaf_docs:
                inside = shared[lo + 1:hi]
                cuts = [lo, *(np.flatnonzero(inside == inside.min()) + lo + 1).tolist(), hi]
                start = lo
                for left, right in zip(cuts[1:], cuts[2:] + [None]):
                    # neighbours that fit into one leaf stay together
                    if right is not None and right - start <= self.leaf_docs:
                        continue
                    self._add(at, start, left)
                    start = left
            at += 1

    def _add(self, parent: int, lo: int, hi: int) -> None:
        child = len(self.lo)
        self.children[parent].append(child)
        self.lo.append(lo)
        self.hi.append(hi)
        self.children.append([])
        above = self.maps[self.own[parent]]
        if hi - lo <= self.leaf_docs or FANOUT * (hi - lo) <= self.hi[above] - self.lo[above]:
            self.own.append(len(self.maps))
            self.generation.append(self.generation[self.own[parent]] + 1 if hi - lo > self.leaf_docs else -1)
            self.maps.append(child)
        else:
            self.own.append(self.own[parent])

    def _bound(self, tfs: np.ndarray) -> None:
        """Per term: the nodes with own maxima that hold it, and what it can add there at most."""
        lows, highs = (np.array([x[i] for i in self.maps]) for x in (self.lo, self.hi))
        m_min = np.array([self.m[a:b].min() for a, b in zip(lows, highs)])
        self.first_id = [int(self.ids[a:b].min()) for a, b in zip(lows, highs)]
        found = []
        generation = np.array(self.generation)
        for g in sorted(set(self.generation)):  # nodes of a generation are disjoint
            nodes = np.flatnonzero(generation == g)
            a, b = self.starts[lows[nodes]], self.starts[highs[nodes]]
            lengths = b - a
            rows = np.repeat(a - np.concatenate([[0], np.cumsum(lengths)[:-1]]), lengths) + np.arange(lengths.sum())
            key = self.terms[rows].astype(np.int64) * len(self.maps) + np.repeat(nodes, lengths)
            order = np.argsort(key, kind="stable")
            key = key[order]
            heads = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
            found.append((key[heads], np.maximum.reduceat(tfs[rows[order]], heads)))
        key = np.concatenate([k for k, _ in found])
        order = np.argsort(key, kind="stable")
        key, tf_max = key[order], np.concatenate([t for _, t in found])[order]
        self.map_node = key % len(self.maps)
        self.map_part = part(tf_max, m_min[self.map_node])
        self.map_starts = np.searchsorted(key // len(self.maps), np.arange(self.n_terms + 1))

    def search(self, item: tuple[np.ndarray, np.ndarray], dense: np.ndarray, best: list[tuple[int, int]], k: int) -> int:
        """Put the item's best documents into the heap ``best`` of (score, -id); returns the leaves read.

        ``item`` is its term ranks and their weights times repeats; ``dense`` is all zeros, and again so
        afterwards.
        """
        ranks, weights = item
        spans = [(a, b, w) for a, b, w in zip(self.map_starts[ranks].tolist(), self.map_starts[ranks + 1].tolist(), weights.tolist()) if b > a]
        if not spans:
            return 0
        rows = np.concatenate([np.arange(a, b) for a, b, _ in spans])
        factor = np.repeat([w for _, _, w in spans], [b - a for a, b, _ in spans])
        bounds = np.zeros(len(self.maps), dtype=np.int64)
        np.add.at(bounds, self.map_node[rows], factor * self.map_part[rows])
        limit = bounds.tolist()
        dense[ranks] = weights
        leaves, stack = 0, [0]
        while stack:
            node = stack.pop()
            own = self.own[node]
            if limit[own] <= 0 or (len(best) == k and (limit[own], -self.first_id[own]) <= best[0]):
                continue
            if self.children[node]:
                stack += sorted(self.children[node], key=lambda c: limit[self.own[c]])
                continue
            leaves += 1
            lo, hi = self.lo[node], self.hi[node]
            a, b = self.starts[lo], self.starts[hi]
            scores = np.add.reduceat(dense[self.terms[a:b]] * self.parts[a:b], self.starts[lo:hi] - a)
            least = best[0][0] if len(best) == k else 1
            for i in np.flatnonzero(scores >= least).tolist():
                entry = (int(scores[i]), -int(self.ids[lo + i]))
                if len(best) < k:
                    heapq.heappush(best, entry)
                elif entry > best[0]:
                    heapq.heapreplace(best, entry)
        dense[ranks] = 0
        return leaves


# -- jobs -------------------------------------------------------------------

def item_blocks(items: DataFrame, scratch: Scratch, block_terms: int) -> Iterator[dict]:
    """The items in blocks of about ``block_terms`` pairs of item and term: key -> {term: repeats}.

    Exact repeats of a row count once; different texts under one id make one item.
    """
    words = items.select("item_id", "text").distinct().select("item_id", F.explode(terms_of(F.col("text"))).alias("term"))
    pairs = scratch.store(words.groupBy("item_id", "term").agg(F.count(F.lit(1)).alias("n")))
    blocks = max(1, math.ceil(pairs.count() / block_terms))
    for block in range(blocks):
        found: dict = {}
        for r in pairs.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == block).toLocalIterator():
            found.setdefault(r.item_id, {})[r.term] = r.n
        if found:
            yield found


def vectors(docs: DataFrame, vocabulary: Broadcast) -> DataFrame:
    """(doc_id, n, terms, tfs): of documents with any term their number of terms and those of the vocabulary."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        using("fp_search")
        number = vocabulary.value
        for batch in batches:
            ids, ns, terms, tfs = [], [], [], []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                words = (text.as_py() or b"").translate(_PLAIN).split()
                if not words:
                    continue
                counts = Counter(w for w in words if w in number)
                ids.append(doc)
                ns.append(len(words))
                terms.append([number[w] for w in counts])
                tfs.append(list(counts.values()))
            if ids:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip((ids, ns, terms, tfs), _VECTORS)], schema=_VECTORS)

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").cast("binary").alias("text"))
    return rows.mapInArrow(run, "doc_id bigint, n bigint, terms array<int>, tfs array<int>")


def _search_task(shared: Broadcast, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        using("fp_search")
        n_docs, n_terms, rank, items = shared.value
        dense = np.zeros(len(rank), dtype=np.int64)
        best: list[list] = [[] for _ in items]
        held, size = [], 0

        def flush() -> None:
            ids, ns, lengths, terms, tfs = (np.concatenate(c) for c in zip(*held))
            m = np.array([length_factor(n, n_docs, n_terms) for n in ns.tolist()], dtype=np.int64)
            # within a document by rank: most frequent term first
            order = np.lexsort((rank[terms], np.repeat(np.arange(len(lengths)), lengths)))
            tree = Tree(ids, m, lengths, rank[terms][order], tfs[order], len(rank), LEAF_DOCS)
            for item, heap in zip(items, best):
                tree.search(item, dense, heap, k)

        for batch in batches:
            lists, counts = batch.column(2), batch.column(3)
            lengths = np.diff(lists.offsets.to_numpy()).astype(np.int64)
            keep = lengths > 0
            if not keep.any():
                continue
            held.append((batch.column(0).fill_null(NO_ID).to_numpy(zero_copy_only=False)[keep], batch.column(1).to_numpy()[keep], lengths[keep],
                         lists.flatten().to_numpy(), counts.flatten().to_numpy()))
            size += len(held[-1][3])
            if size >= SHARD_ENTRIES:
                flush()
                held, size = [], 0
        if held:
            flush()
        rows = [(i, None if -doc == NO_ID else -doc, score) for i, heap in enumerate(best) for score, doc in heap]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _FOUND)], schema=_FOUND)

    return run


def search(docs: DataFrame, items: DataFrame, k: int, scratch: Scratch, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` best documents with a score above 0 of every item.

    Null texts have no terms; items and documents without terms find nothing and are not found. Rows of
    equal doc_id are documents of their own, null ids come last among equal scores. An item_id may be
    null. Further columns are ignored; empty tables give no rows. A further block of items costs a
    further pass over the documents.
    """
    spark, context = docs.sparkSession, docs.sparkSession.sparkContext
    out = None
    for block in item_blocks(items, scratch, block_terms):
        keys = list(block)
        number = {t: i for i, t in enumerate(sorted({t for terms in block.values() for t in terms}))}
        vocabulary = context.broadcast({t.encode(): i for t, i in number.items()})
        stored = scratch.store(vectors(docs, vocabulary))
        vocabulary.unpersist()
        n_docs, n_terms = stored.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
        df = dict(map(tuple, stored.select(F.explode("terms").alias("t")).groupBy("t").count().toLocalIterator()))  # at most the vocabulary
        rank = np.empty(len(number), dtype=np.int64)
        rank[sorted(range(len(number)), key=lambda t: (-df.get(t, 0), t))] = np.arange(len(number))
        asked = []
        for terms in block.values():
            pairs = [(rank[number[t]], n * weight(n_docs, df[number[t]])) for t, n in terms.items() if number[t] in df]
            asked.append(tuple(np.array([p[i] for p in pairs if p[1] > 0], dtype=np.int64) for i in (0, 1)))
        shared = context.broadcast((n_docs, n_terms, rank, asked))
        found = stored.mapInArrow(_search_task(shared, k), "item bigint, doc_id bigint, score bigint")
        names = spark.createDataFrame([(i, key) for i, key in enumerate(keys)], f"item bigint, item_id {items.schema['item_id'].dataType.simpleString()}")
        best = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
        ranked = scratch.store(found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).join(names, "item"))
        shared.unpersist()
        scratch.drop(stored)
        ranked = ranked.select("item_id", "rank", "doc_id", "score")
        out = ranked if out is None else out.unionByName(ranked)
    if out is None:
        return items.select("item_id").limit(0).selectExpr("item_id", "0 AS rank", "0L AS doc_id", "0L AS score")
    return out
