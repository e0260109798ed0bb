"""Class language model: gains and scores against plain counting, any block and group size, odd rows."""

import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from loanloom.llm import brown
from loanloom.llm.storage import Scratch

SCHEMA = "text string, doc_id bigint, block int, held string, word int, c int, gid string, score string"
def HELD():  # noqa: N802
    return F.crc32(F.col("doc_id").cast("string")) % 7 == 2



def words(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").encode().split() + [b""]


def held(doc):
    return doc is not None and zlib.crc32(str(doc).encode()) % 7 == 2


def corpus(seed=1, n=400):
    rng = random.Random(seed)
    kinds = [[f"{k}{i}" for i in range(40)] for k in ("det", "Noun", "verb", "ÄDJ")]

    def sentence():
        return " ".join(rng.choice(kinds[k])if rng.random() > 0.02 else f"new{rng.randrange(10**6)}" for k in (0, 3, 1, 2, 0, 1)[:rng.randrange(2, 7)])

    docs = [(d, ". ".join(sentence() for _ in range(rng.randrange(1, 8)))) for d in range(n)]
    return docs + [(None, "det1 noun2"), (None, None), (-3, ""), (-4, " \t\n"), (-4, "verb1 verb1 verb1"), (9_999, "det0 Noun1 " * 30_000), (5, "det0"), (5, "det0")]


def frame(spark, docs):
    return spark.createDataFrame([(t, d, 1, "x", 2, 3, "y", "z") for d, t in docs], SCHEMA).repartition(3)


def fitted(spark, docs, limit=None):
    scratch = Scratch(spark, "brown")
    coded = brown.encode(frame(spark, docs), F.coalesce(HELD(), F.lit(False)), scratch)
    classes, path = brown.cluster(coded, scratch, limit)
    return coded, classes, path, brown.fit(coded, classes)


def plain_scores(docs, of_word, model_classes=brown.CLASSES):
    """Scores by dictionaries, given each word's class."""
    train = [words(t) for d, t in docs if not held(d)]
    count = Counter(w for t in train for w in t)
    total, kinds = sum(count.values()), len(count)

    def cls(w):
        return brown.STOP if w == b"" else of_word.get(w, brown.OPEN)

    tri = Counter()
    for t in train:
        cs = [brown.STOP, brown.STOP, *map(cls, t)]
        tri.update(zip(cs, cs[1:], cs[2:]))
    pairs, single, after3, after2 = Counter(), Counter(), defaultdict(set), defaultdict(set)
    rows3, rows2 = Counter(), Counter()
    for (a, b, c), n in tri.items():
        pairs[b, c] += n
        single[c] += n
        rows3[a, b] += n
        rows2[b] += n
        after3[a, b].add(c)
        after2[b].add(c)
    used = {c for c in single} | {brown.OPEN, brown.STOP}
    rare = sum(1 for w, n in count.items() if n == 1 and w)

    def step(a, b, c):
        p1 = (single[c] + (c in used)) / (sum(single.values()) + len(used))
        p2 = (pairs[b, c] + len(after2[b]) * p1) / (rows2[b] + len(after2[b])) if rows2[b] else p1
        return (tri[a, b, c] + len(after3[a, b]) * p2) / (rows3[a, b] + len(after3[a, b])) if rows3[a, b] else p2

    def word(w):
        c = cls(w)
        return 1.0 if c == brown.STOP else (count[w] + 1) / (single[c] + rare + 1) if c == brown.OPEN else count[w] / single[c]

    out = []
    for d, t in docs:
        w = words(t)
        cs = [brown.STOP, brown.STOP, *map(cls, w)]
        out.append((d, held(d), len(w), sum(count[x] > 0 for x in w), total, round(sum(math.log10((count[x] + 1) / (total + kinds + 1)) for x in w), 6),
                    round(sum(math.log10(step(a, b, c) * word(x)) for a, b, c, x in zip(cs, cs[1:], cs[2:], w)), 6)))
    return sorted(out, key=str)


def classes_by_word(docs, classes):
    count = Counter(w for d, t in docs if not held(d) for w in words(t))
    ranked = sorted((w for w, n in count.items() if n > 1 and w), key=lambda w: (-count[w], w))
    moved = {r.gid: r["class"] for r in classes.moved.collect()} if classes.moved is not None else {}
    first = brown.first_class(np.arange(len(ranked) + 2), classes.exchanged)
    return {w: int(classes.table[g] if g < len(classes.table) else moved.get(g, first[g])) for g, w in enumerate(ranked, 2)}


@pytest.mark.parametrize("limit", [None, 30])
def test_scores_equal_plain_counting(spark, monkeypatch, limit):
    """Small blocks, several groups, merges in steps; with and without words beyond the table."""
    docs = corpus()
    for name, value in (("BLOCK_TOKENS", 700), ("GROUP_TOKENS", 20_000), ("MERGE", 3), ("TOLERANCE", 0.01)):
        monkeypatch.setattr(brown, name, value)
    coded, classes, path, _ = fitted(spark, docs, limit)
    assert coded.n_blocks > 9 and len(path) > 2 and path[-2] > path[0]
    assert (classes.moved is not None) == (limit is not None)
    got = brown.score(frame(spark, docs), HELD(), Scratch(spark, "b"), limit).collect()
    assert sorted(((*r[:5], round(r[5], 6), round(r[6], 6)) for r in got), key=str) == plain_scores(docs, classes_by_word(docs, classes))
    outside = [r for r in got if r.held_out]
    assert sum(r.score for r in outside) > sum(r.base_score for r in outside)
    by_class = defaultdict(Counter)
    for w, c in classes_by_word(docs, classes).items():
        by_class[c][w[:3]] += 1
    assert sum(max(k.values()) for k in by_class.values()) > 0.8 * sum(sum(k.values()) for k in by_class.values())  # kinds of word are found again


def test_probabilities_add_up_to_one(spark):
    docs = corpus(2, 100)
    _, classes, _, model = fitted(spark, docs)
    count = Counter(w for d, t in docs if not held(d) for w in words(t))
    of_word = classes_by_word(docs, classes)
    kinds = np.array([brown.STOP if w == b"" else of_word.get(w, brown.OPEN) for w in count] + [brown.OPEN])
    emitted = model.emissions(kinds, np.array([*count.values(), 0]))
    for a, b in ((1, 1), (1, 5), (7, 30), (0, 0), (63, 2)):
        assert abs((model.transitions[a, b][kinds] * emitted).sum() - 1) < 1e-9


def test_gains_are_differences_of_information():
    rng = np.random.default_rng(4)
    stream = rng.integers(0, 50, 3_000)
    of_word = rng.integers(brown.FREE, 8, 50)

    def bigrams(of):
        return np.bincount(of[stream[:-1]] * brown.CLASSES + of[stream[1:]], minlength=brown.CLASSES**2).reshape(brown.CLASSES, -1)

    def beside(w):
        left = np.bincount(of_word[stream[:-1][stream[1:] == w]], minlength=brown.CLASSES)
        right = np.bincount(of_word[stream[1:][stream[:-1] == w]], minlength=brown.CLASSES)
        return left, right, float(((stream[1:] == w) & (stream[:-1] == w)).sum())

    chosen = []
    for w in range(10):
        values = [brown.information(bigrams(np.where(np.arange(50) == w, c, of_word))) for c in range(brown.FREE, brown.CLASSES)]
        state = brown.Exchange(bigrams(of_word))
        left, right, own = (np.array([x]) for x in beside(w))
        best = int(state.move(left, right, own, of_word[[w]])[0])
        chosen.append(best)
        assert abs(values[best - brown.FREE] - max(values)) < 1e-6
        assert np.allclose(state.n, bigrams(np.where(np.arange(50) == w, best, of_word)))
        assert np.allclose(state.rows, state.n.sum(1)) and np.allclose(state.columns, state.n.sum(0))
    left, right, own = (np.array(x) for x in zip(*map(beside, range(10))))
    assert brown.Exchange(bigrams(of_word)).move(left, right, own, of_word[:10]).tolist() == chosen  # at once: each as if alone


def test_empty_and_nothing_to_learn_from(spark):
    assert brown.score(frame(spark, []), HELD(), Scratch(spark, "b")).count() == 0
    docs = [(d, "a b") for d in range(40) if held(d)]
    got = brown.score(frame(spark, docs), HELD(), Scratch(spark, "b")).collect()
    assert len(got) == len(docs) > 0 and all(r.n_known == 0 and r.base_score == 0 and math.isfinite(r.score) for r in got)
