"""Document FP-tree: bounds and rankings against plain scoring of every document."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from loanloom.llm import fp_search
from loanloom.llm.storage import Scratch

SCHEMA = "text string, doc_id bigint, item_id string, rank int, item int, n int, terms string, score string"
WORD = re.compile(fp_search.WORD)


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def plain(docs, items, k):
    bags = [(d, words(t)) for d, t in docs]
    bags = [(d, w) for d, w in bags if w]
    n_docs, n_terms = len(bags), sum(len(w) for _, w in bags)
    df = Counter(t for _, w in bags for t in set(w))
    asked = {}
    for item, text in set(items):
        asked.setdefault(item, Counter()).update(words(text))
    out = set()
    for item, terms in asked.items():
        scored = []
        for d, w in bags:
            tf, m = Counter(w), 100 - 75 + 75 * len(w) * n_docs // n_terms
            score = sum(n * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * tf[t] // (1000 * tf[t] + 8 * m))
                        for t, n in terms.items() if tf[t])
            if score > 0:
                scored.append((-score, d is None, d or 0, d))
        out |= {(item, i + 1, d, -s) for i, (s, _, _, d) in enumerate(sorted(scored, key=lambda x: x[:3])[:k])}
    return out


def corpus(seed, n=600):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)] + ["Ünder", "über", "a1"]
    draw = lambda: rng.choice(vocabulary[:int(3 + rng.random() ** 3 * 300)])
    docs = [(d, " ".join(draw() for _ in range(rng.randrange(0, 60)))) for d in range(n)]
    copies = [(n + i, docs[7][1] + " w250 w251") for i in range(150)]
    odd = [(None, "w250 w251 W3"), (None, "w250 w251 w3"), (-5, "w250, w251; W3!"), (3, "w250 w250"), (3, "w250 w250"), (9_000, None), (9_001, " ,.!"), (9_002, ""),
           (9_003, "w9 " * 50_000)]
    items = [(f"i{i}", " ".join(draw() for _ in range(rng.randrange(1, 40)))) for i in range(40)]
    items += [("copies", docs[7][1] + " w250 w251"), ("ties", "w250 w251 w250"), ("none", "nowhere"), ("empty", None), ("empty2", "?"), ("ties", "w250 w251 w250"),
              ("two", "w1"), ("two", "w2 w2"), (None, "w17")]
    return docs + copies + odd, items


@pytest.mark.parametrize(("leaf", "entries", "block"), [(32, 1 << 20, 500_000), (2, 500, 100), (8, 4_000, 500_000)])
def test_equals_plain_scoring(spark, monkeypatch, leaf, entries, block):
    monkeypatch.setattr(fp_search, "LEAF_DOCS", leaf)
    monkeypatch.setattr(fp_search, "SHARD_ENTRIES", entries)
    docs, items = corpus(leaf)
    frame = spark.createDataFrame([(t, d, "x", 1, 2, 3, "y", "z") for d, t in docs], SCHEMA).repartition(3)
    asked = spark.createDataFrame([(t, i, 1, 2) for i, t in items], "text string, item_id string, doc_id int, score int")
    got = {tuple(r) for r in fp_search.search(frame, asked, 10, Scratch(spark, "fp"), block).collect()}
    assert got == plain(docs, items, 10)


def test_bounds_hold_and_prune():
    """No document scores above the bound of a node over it, and most leaves are not read."""
    rng = np.random.default_rng(3)
    n, n_terms = 4_000, 200
    kinds = [np.flatnonzero(rng.random(n_terms) < 0.5 / np.sqrt(1 + np.arange(n_terms))) for _ in range(200)]
    sets = [np.unique(np.append(kinds[rng.integers(200)], rng.integers(n_terms))) for _ in range(n)]
    sizes, terms = np.array([len(s) for s in sets]), np.concatenate(sets)
    tfs = rng.geometric(0.5, len(terms))
    tree = fp_search.Tree(np.arange(n), rng.integers(25, 400, n), sizes, terms, tfs, n_terms)
    leaves = [i for i, c in enumerate(tree.children) if not c]
    assert sorted(x for i in leaves for x in range(tree.lo[i], tree.hi[i])) == list(range(n))
    assert max(tree.hi[i] - tree.lo[i] for i in leaves) <= fp_search.LEAF_DOCS
    for i in range(len(tree.lo)):
        own = tree.maps[tree.own[i]]
        assert tree.lo[own] <= tree.lo[i] and tree.hi[i] <= tree.hi[own]
    dense, read = np.zeros(n_terms, dtype=np.int64), 0
    for q in range(30):
        ranks = np.sort(rng.choice(n_terms, 6, replace=False))
        weights = 1000 + 20 * ranks
        scores = np.zeros(n, dtype=np.int64)
        for r, w in zip(ranks, weights):
            hit = np.flatnonzero(tree.terms == r)
            scores[np.searchsorted(tree.starts, hit, "right") - 1] += w * tree.parts[hit]
        for m in range(len(tree.maps)):
            bound = sum(w * tree.map_part[p] for r, w in zip(ranks, weights) for p in range(tree.map_starts[r], tree.map_starts[r + 1]) if tree.map_node[p] == m)
            assert scores[tree.lo[tree.maps[m]]:tree.hi[tree.maps[m]]].max() <= bound
        best = []
        read += tree.search((ranks, weights), dense, best, 10)
        want = sorted(zip((-scores).tolist(), tree.ids.tolist()))[:10]
        assert sorted(((-s, -d) for s, d in best)) == want and not dense.any()
    assert read < 0.6 * 30 * len(leaves)


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string")
    items = spark.createDataFrame([(1, "some words")], "item_id bigint, text string")
    some = spark.createDataFrame([(1, "some words")], "doc_id bigint, text string")
    assert fp_search.search(docs, items, 10, Scratch(spark, "fp")).count() == 0
    assert fp_search.search(some, items.limit(0), 10, Scratch(spark, "fp")).columns == ["item_id", "rank", "doc_id", "score"]
    part = 10**9 // (1000 + 8 * 100)
    assert [tuple(r) for r in fp_search.search(some, items, 10, Scratch(spark, "fp")).collect()] == [(1, 1, 1, 2 * 287 * part)]
