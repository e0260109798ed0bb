"""Jaccard classes and components against all pairs."""

import random
import re
from functools import partial

import pytest

from loanloom.llm import jaccard
from loanloom.llm.components import components
from loanloom.llm.storage import Scratch


def shingles(text, size):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return frozenset()
    size = min(size, len(words))
    return frozenset(tuple(words[i:i + size]) for i in range(len(words) - size + 1))


def brute(rows, size, num, den):
    sets = [(d, shingles(t, size)) for d, t in rows]
    parent = {d: d for d, _ in rows if d is not None}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (a, s) in enumerate(sets):
        for b, t in sets[:i]:
            if s and t and a is not None and b is not None and den * len(s & t) >= num * len(s | t):
                p, q = root(a), root(b)
                parent[max(p, q)] = min(p, q)
    return sorted(((d, len(s), root(d) if d is not None and s else d) for d, s in sets), key=str)


def solve(spark, rows, size, num, den):
    frame = spark.createDataFrame([(t, d, "c", 1) for d, t in rows], "text string, doc_id bigint, class string, n int").repartition(3)
    found = jaccard.link_documents(frame, Scratch(spark, "jaccard"), size, num, den)
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in found.collect()), key=str)


def corpus(seed, families, members, longest):
    rng = random.Random(seed)
    word = lambda: f"w{min(rng.randrange(400), rng.randrange(400))}"
    rows, common = [], [word() for _ in range(12)]
    for _ in range(families):
        base = [word() for _ in range(rng.randrange(1, longest))]
        if rng.random() < 0.3:
            base = common + base
        for _ in range(rng.randrange(1, members)):
            text = list(base)
            for _ in range(rng.randrange(4)):
                at = rng.randrange(len(text) + 1)
                text[at:at + rng.randrange(2)] = [word()] if rng.random() < 0.5 else []
            rows.append((len(rows) * 3, " ".join(x.upper() if rng.random() < 0.1 else x for x in text)))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("size, num, den, near, list_rows, block", [
    (3, 90, 100, 8, 100_000, 1024), (5, 80, 100, 8, 100_000, 1024), (3, 90, 100, 1, 3, 4), (1, 80, 100, 1, 3, 4),
])
def test_components_equal_all_pairs(spark, monkeypatch, size, num, den, near, list_rows, block):
    monkeypatch.setattr(jaccard, "NEAR", near)
    monkeypatch.setattr(jaccard, "LIST_ROWS", list_rows)
    monkeypatch.setattr(jaccard, "BLOCK_SETS", block)
    rows = corpus(size + near, 60, 9, 60) + [(9001, None), (9003, ""), (9004, " \t"), (9005, "one"), (9006, "ONE"), (9007, "one two"),
                                             (None, "one two"), (9008, "x y z " * 2_000), (9009, "x y z " * 2_001)]
    rows += [(9010, "a b c d e f g h i j k l"), (9010, "quite another text for the same id here"), (9012, "A b c d e f g h i j k l")]
    assert solve(spark, rows, size, num, den) == brute(rows, size, num, den)


def test_group_of_near_copies(spark, monkeypatch):
    """A long list whose members link only in part, in several blocks."""
    monkeypatch.setattr(jaccard, "BLOCK_SETS", 16)
    monkeypatch.setattr(jaccard, "NEAR", 2)
    rng = random.Random(4)
    base = [f"b{i}" for i in range(120)]
    rows = []
    for d in range(70):
        text = list(base)
        for at in rng.sample(range(120), rng.choice([1, 1, 2, 3, 4])):
            text[at] = f"e{rng.randrange(60)}"
        rows.append((d, " ".join(text)))
    assert solve(spark, rows, 3, 90, 100) == brute(rows, 3, 90, 100)


def test_pieces_of_a_long_subset_list_share_their_first_set(spark, monkeypatch):
    """A subset's list longer than a task holds still links every member to its smallest one, lists around it as well."""
    monkeypatch.setattr(jaccard, "LIST_ROWS", 50)
    monkeypatch.setattr(jaccard, "_gathered", partial(jaccard._gathered, rows=1))
    rows = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(rows)
    try:
        spark.conf.set(rows, "64")
        lists = [(key, 4, 0, 1, 4, key * 10_000 + i, 0) for key, size in ((1, 3), (2, 2_000), (3, 201), (4, 1)) for i in range(size)]
        frame = spark.createDataFrame(lists, "key bigint, c int, part int, parts int, n bigint, id bigint, pos bigint").repartition(3)
        found = jaccard._scan_lists(frame, jaccard.Threshold(80, 100)).collect()
    finally:
        spark.conf.set(rows, before)
    assert sorted((r.kind, r.a, r.b) for r in found) == [
        (jaccard.LINK, key * 10_000, key * 10_000 + i) for key, size in ((1, 3), (2, 2_000), (3, 201)) for i in range(1, size)]


def test_boundary_takes_the_cheaper_side(spark):
    threshold = jaccard.Threshold(90, 100)
    assert [threshold.subsets(s) for s in (5, 10, 20)] == [1, 11, 211]
    rows = [(f"c{i}", i, n, list(range(i * 100, i * 100 + n))) for i, n in enumerate([4] * 9 + [12] * 9 + [40] * 9)]
    reps = spark.createDataFrame(rows, "class string, rep bigint, n bigint, small array<bigint>")
    light = jaccard.boundary(reps, threshold)
    assert light < 12  # 13 subsets against 2 prefix rows with lists of one member


def test_empty(spark):
    assert solve(spark, [], 3, 90, 100) == []
    assert solve(spark, [(1, None)], 3, 90, 100) == [(1, 0, 1)]


def test_components_of_long_chains(spark):
    n = 300
    order = list(range(n))
    random.Random(2).shuffle(order)
    edges = spark.createDataFrame(list(zip(order, order[1:])) + [(1000, 1001), (1000, 1000)], "a bigint, b bigint")
    got = {r.node: r.label for r in components(edges, Scratch(spark, "chain")).collect()}
    assert got == {**{i: 0 for i in range(n)}, 1000: 1000, 1001: 1000}
