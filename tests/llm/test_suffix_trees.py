"""Substring deduplication against brute force over all windows."""

import hashlib
import random
import re

import numpy as np
import pytest

from loanloom.llm import suffix_trees as st
from loanloom.llm.storage import Scratch


def brute(rows, window):
    words = [(d, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for d, t in rows]
    first = {}
    for d, w in words:
        if d is not None:
            for i in range(len(w) - window + 1):
                key = tuple(w[i:i + window])
                first[key] = min(first.get(key, d), d)
    out = []
    for d, w in words:
        gone = {j for i in range(len(w) - window + 1) if d is not None and first[tuple(w[i:i + window])] < d for j in range(i, i + window)}
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((d, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


def solve(spark, rows, window):
    frame = spark.createDataFrame([(t, "f", d) for d, t in rows], "text string, first string, doc_id bigint").repartition(3)
    found = st.remove_repeats(frame, Scratch(spark, "repeats"), window).collect()
    assert all(r.n_removed == sum(s.end - s.start for s in r.spans) for r in found)
    return sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in found), key=str)


def corpus(seed, window):
    rng = random.Random(seed)
    some = lambda n: [f"w{rng.randrange(9)}" if rng.random() < 0.3 else f"w{rng.randrange(3000)}é" for _ in range(n)]
    passages = [some(rng.randrange(window - 2, 3 * window)) for _ in range(6)]
    rows = []
    for d in range(60):
        text = some(rng.randrange(3 * window))
        for _ in range(rng.randrange(3)):
            at = rng.randrange(len(text) + 1)
            p = rng.choice(passages)
            a = rng.randrange(3)
            text[at:at] = p[a:len(p) - rng.randrange(3)]
        rows.append((rng.randrange(10**6), "\n".join([" ".join(text[:5]), "\t ".join(text[5:])])))
    rows += [(10**6 + 1, rows[0][1]), (10**6 + 2, rows[0][1]), (5, rows[1][1]), (10**6 + 3, None), (10**6 + 4, "  "), (None, rows[2][1]),
             (rows[3][0], "another text of the same id " * 30), (rows[3][0], rows[3][1]), (10**6 + 5, "a b " * 4_000), (10**6 + 6, "a b " * 4_000 + "c")]
    return rows


@pytest.mark.parametrize("window, anchor, group, pack", [(50, 16, 30_000, 12_000), (7, 3, 30_000, 5), (7, 3, 2, 5), (6, 16, 30_000, 40)])
def test_equals_brute_force(spark, monkeypatch, window, anchor, group, pack):
    monkeypatch.setattr(st, "ANCHOR", anchor)
    monkeypatch.setattr(st, "GROUP", group)
    monkeypatch.setattr(st, "PACK", pack)
    rows = corpus(window + group, window)
    assert solve(spark, rows, window) == brute(rows, window)


def test_windows_are_anchored_by_content():
    rng = random.Random(1)
    named = {}
    for n in (50, 51, 200, 400):
        words = [b"%d" % rng.randrange(2) for _ in range(n)] * 2
        hashes, first, count = st.anchors(words, 50)
        assert first[0] == 0 and (first[1:] == (first + count)[:-1]).all() and first[-1] + count[-1] == len(words) - 49
        for h, a, c in zip(hashes.tolist(), first.tolist(), count.tolist()):
            for i in range(a, a + c):
                assert named.setdefault(tuple(words[i:i + 50]), h) == h


def plain_repeats(text, least):
    """Every run of ``least`` or more that repeats and is longer wherever it is extended: {run: starts}."""
    met, n = {}, len(text)
    for size in range(least, n):
        again = {}
        for i in range(n - size + 1):
            again.setdefault(tuple(text[i:i + size]), []).append(i)
        met |= {run: at for run, at in again.items() if len(at) > 1}
    follows = lambda at, size: {text[i + size] if i + size < n else None for i in at}
    precedes = lambda at: {text[i - 1] if i else None for i in at}
    return {run: at for run, at in met.items() if len(follows(at, len(run))) > 1 and len(precedes(at)) > 1}


@pytest.mark.parametrize("seed, words, least", [(0, 2, 3), (1, 3, 2), (2, 5, 1), (3, 40, 1), (4, 1, 4)])
def test_nodes_are_maximal_repeats(seed, words, least):
    rng = np.random.default_rng(seed)
    parts, text = [rng.integers(0, words, rng.integers(1, 25)) for _ in range(6)], [words + 10]
    for i, p in enumerate([*parts, parts[0]]):
        text += [*p.tolist(), words + 20 + i]
    text = np.array(text)
    depth, low, high, leaves = st.maximal_repeats(text, least, 25)
    got = {}
    for d, a, b in zip(depth.tolist(), low.tolist(), high.tolist()):
        at = sorted(leaves[a:b].tolist())
        assert got.setdefault(tuple(text[at[0]:at[0] + d].tolist()), at) is at
    assert got == plain_repeats(text.tolist(), least)


def test_empty(spark):
    assert solve(spark, [], 50) == []
