"""Raking with limited cells against a plain version of it, and the draw."""

import hashlib
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from loanloom.llm import mixing
from loanloom.llm.storage import Scratch


def plain(cells, targets=None, keep=mixing.KEEP_TOKENS, rounds=400):
    """(probability of every cell, target of every dimension's values): raking with full cells fixed."""
    total = sum(cells.values())
    most = {c: t / (keep * total) for c, t in cells.items()}
    share = {c: min(most[c], t / total) for c, t in cells.items()}
    aims = []
    for i, d in enumerate(mixing.DIMENSIONS):
        own, cap = defaultdict(float), defaultdict(float)
        for c, t in cells.items():
            own[c[i]] += t
            cap[c[i]] += most[c]
        weight = {v: float(targets[d].get(v, 0)) if d in (targets or {}) else t ** mixing.ALPHA for v, t in own.items()}
        low, high = 0.0, 1e9  # the level by halving
        for _ in range(200):
            level = (low + high) / 2
            low, high = (level, high) if sum(min(cap[v], level * w) for v, w in weight.items()) < 1 else (low, level)
        aims.append({v: min(cap[v], high * w) for v, w in weight.items()})
    for _ in range(rounds):
        for i, aim in enumerate(aims):
            fixed, free = defaultdict(float), defaultdict(float)
            for c, s in share.items():
                (fixed if s >= most[c] else free)[c[i]] += s
            for c, s in share.items():
                v = c[i]
                if aim[v] < fixed[v]:
                    share[c] = s * aim[v] / (fixed[v] + free[v])
                elif s < most[c]:
                    share[c] = min(most[c], s * (aim[v] - fixed[v]) / free[v])
    return {c: share[c] / most[c] if most[c] else 0.0 for c in cells}, aims


def cells(seed):
    rng = random.Random(seed)
    return {(f"s{a}", b, c): rng.randrange(1, 10_000) for a in range(6) for b in ("en", "de", "") for c in ("prose", "legal") if rng.random() < 0.8}


def frame_of(spark, table):
    return spark.createDataFrame([(*c, t) for c, t in table.items()], "source string, lang string, topic string, tokens bigint")


@pytest.mark.parametrize("targets, keep, broadcast", [
    (None, 0.5, 50_000), ({"lang": {"en": 0.5, "de": 0.4, "": 0.1, "xx": 3.0}, "topic": {"prose": 3, "legal": 1}}, 0.3, 10), (None, 0.5, 0)])
def test_rake_equals_plain_and_meets_marginals(spark, monkeypatch, targets, keep, broadcast):
    monkeypatch.setattr(mixing, "BROADCAST_CELLS", broadcast)
    table = cells(1)
    fitted, aims = mixing.rake(frame_of(spark, table), Scratch(spark, "mix"), targets, keep=keep)
    want, plain_aims = plain(table, targets, keep)
    got = {(r.source, r.lang, r.topic): r.share / r.most for r in fitted.collect()}
    assert got.keys() == want.keys() and all(abs(got[c] - want[c]) < 1e-7 for c in want)
    rows = mixing.reached(fitted, aims).collect()
    assert len(rows) == sum(map(len, plain_aims))
    for r in rows:
        aim = plain_aims[mixing.DIMENSIONS.index(r.dimension)][r.value]
        assert abs(r.target - aim) < 1e-7 and abs(r.share - aim) < 1e-7


def test_scarce_values_are_kept_whole_and_the_rest_moves(spark):
    """Legal asks for a third of the sample but is 2 % of the tokens: all of it stays, the others take its place."""
    table = {("a", "en", "prose"): 5_000, ("a", "en", "legal"): 100, ("b", "en", "prose"): 4_800, ("b", "de", "legal"): 100}
    targets = {"topic": {"prose": 2, "legal": 1}, "source": {"a": 1, "b": 1}, "lang": {"en": 1, "de": 1}}
    fitted, aims = mixing.rake(frame_of(spark, table), Scratch(spark, "mix"), targets, keep=0.5)
    p = {(r.source, r.lang, r.topic): r.share / r.most for r in fitted.collect()}
    assert p["a", "en", "legal"] == 1 and p["b", "de", "legal"] == 1
    kept = {c: p[c] * t for c, t in table.items()}
    assert abs(sum(kept.values()) - 5_000) < 1e-3 and abs(kept["a", "en", "prose"] + 100 - 2_500) < 1e-3
    report = {(r.dimension, r.value): r for r in mixing.reached(fitted, aims).collect()}
    legal = report["topic", "legal"]
    assert abs(legal.asked - 1 / 3) < 1e-12 and abs(legal.target - 0.04) < 1e-12 and abs(legal.share - 0.04) < 1e-9


def test_too_few_tokens_for_what_is_asked(spark):
    """Where all values asked for are too small together, they are kept whole and the others not at all."""
    table = {("a", "en", "prose"): 900, ("a", "en", "legal"): 100, ("b", "", "prose"): 0}
    fitted, _ = mixing.rake(frame_of(spark, table), Scratch(spark, "mix"), {"topic": {"legal": 1}}, keep=0.5, rounds=5)
    # the marginals of source and language contradict that of the topic, which comes last
    assert {(r.source, r.topic): r.share / r.most if r.most else 0.0 for r in fitted.collect()} == {
        ("a", "prose"): 0.0, ("a", "legal"): 1.0, ("b", "prose"): 0.0}


def test_sample_follows_probabilities(spark):
    rng = random.Random(2)
    rows = [("w " * rng.randrange(1, 60) + rng.choice(["", "a@b", " | "]), d, f"s{min(rng.randrange(5), rng.randrange(5))}", rng.choice(["en", "de", None]), "x")
            for d in range(1500)]
    rows += [(None, 9001, None, None, "x"), ("", 9002, "s1", "en", "x"), ("word", None, "s1", "en", "x"), ("other word", None, "s1", "en", "x"),
             ("word", 9003, "s1", "en", "x"), ("word", 9003, "s1", "en", "x"), ("v " * 60_000, 9004, "s2", "de", "x"), (None, None, None, None, "x")]
    docs = spark.createDataFrame(rows, "text string, doc_id bigint, source string, lang string, topic string").repartition(3)
    for clashing in ("__cell", "__p", "row", "cell", "drawn", "probability", "__mix", "tokens"):
        docs = docs.withColumn(clashing, F.col("topic"))
    out = mixing.mix(docs, Scratch(spark, "mix"))
    assert sorted(out.columns) == sorted(docs.columns)
    got = out.collect()
    assert len(got) == len(rows) and {(r.topic, r["__cell"], r.row, r.cell) for r in got} == {("x",) * 4}
    tokens = defaultdict(int)
    for r in got:
        tokens[tuple(r["__mix"][d] for d in mixing.DIMENSIONS)] += len((r.text or "").split())
    p, aims = plain({c: t for c, t in tokens.items() if t})
    assert any(x == 1 for x in p.values())
    for r in got:
        m = r["__mix"]
        cell = tuple(m[d] for d in mixing.DIMENSIONS)
        assert abs(m.probability - (p[cell] if tokens[cell] else 0.0)) < 1e-6
        key = "text " + hashlib.md5((r.text or "").encode()).hexdigest() if r.doc_id is None else str(r.doc_id)
        u = int(hashlib.md5(f"mix:{key}".encode()).hexdigest()[:13], 16) / 16**13
        assert m.keep == (u < m.probability)
    for i, aim in enumerate(aims):
        for value, target in aim.items():
            expected = sum(p[c] * t for c, t in tokens.items() if c[i] == value and t)
            assert abs(expected / (mixing.KEEP_TOKENS * sum(tokens.values())) - target) < 1e-6


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string, source string, lang string")
    assert mixing.mix(docs, Scratch(spark, "mix")).count() == 0
    silent = spark.createDataFrame([(1, None, "s", "en"), (2, "", "s", None)], "doc_id bigint, text string, source string, lang string")
    assert [r["__mix"].probability for r in mixing.mix(silent, Scratch(spark, "mix")).collect()] == [0.0, 0.0]


@pytest.mark.parametrize("whole", [True, False])
def test_a_round_over_few_cells_reads_them_once(spark, whole):
    """By joins a round's plan reads the cells eight times, which the driver plans and keeps for every round."""
    frame = frame_of(spark, cells(3)).withColumns({c: F.lit(0.1) for c in ("share", "most", *[f"to_{d}" for d in mixing.DIMENSIONS])})
    new = Scratch(spark, "mix").store(frame).coalesce(1)
    for d in mixing.DIMENSIONS:
        new = mixing._step(new, d, whole, True)
    plan = new._jdf.queryExecution().executedPlan().toString()
    assert (plan.count("FileScan") == 1 and "Exchange" not in plan) == whole
