"""The FM-index against plain search, and decontamination against brute force."""

import random

import numpy as np
import pytest

from loanloom.llm import fm_index as fm


def test_search_and_locate_equal_plain_search():
    rng = random.Random(3)
    for _ in range(30):
        sigma = rng.choice([2, 3, 9])
        text = np.array([1] + [x for _ in range(rng.randrange(1, 8))
                               for x in [rng.randrange(2, sigma + 2) for _ in range(rng.randrange(1, 30))] + [1]])
        index = fm.FmIndex(text, sigma + 1)
        for length in (1, 2, 5):
            phrases = np.array([[rng.randrange(2, sigma + 2) for _ in range(length)] for _ in range(40)])
            low, high = index.search(phrases)
            for p, a, b in zip(phrases, low, high):
                real = [i for i in range(len(text) - length + 1) if (text[i:i + length] == p).all()]
                assert sorted(index.locate(np.arange(a, b)).tolist()) == real


def brute(docs, items, size=10):
    windows = {}
    for item, text in items:
        w = fm.words(text)
        for i in range(max(1, len(w) - size + 1) if w else 0):
            windows.setdefault(tuple(w[i:i + size]), set()).add(item)
    out = []
    for doc, text in docs:
        w = fm.words(text)
        hit, ids = set(), set()
        for n in {len(x) for x in windows}:
            for i in range(len(w) - n + 1):
                if (found := windows.get(tuple(w[i:i + n]))) is not None:
                    hit.update(range(i, i + n))
                    ids |= found
        out.append((doc, len(w), len(hit), sorted(i for i in ids if i is not None)))
    return out


@pytest.mark.parametrize("shard_chars, block_chars", [(24_000_000, 32_000_000), (200, 60)])
def test_contamination_equals_brute_force(spark, monkeypatch, shard_chars, block_chars):
    monkeypatch.setattr(fm, "SHARD_CHARS", shard_chars)
    monkeypatch.setattr(fm, "PHRASE_BLOCK_CHARS", block_chars)
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(12)] + ["Ünï", "9"]
    some = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(i, some(rng.choice([2, 4, 5, 7, 14]))) for i in range(12)] + [(90, None), (91, "?!"), (None, some(4)), (3, some(6))]
    texts = [t for _, t in items if t]
    docs = [(i, some(rng.randrange(60))) for i in range(0, 40, 2)]
    docs += [(i, some(rng.randrange(40)) + "; " + rng.choice(texts).upper().replace(" ", " - ")) for i in range(1, 40, 2)]
    docs += [(50, None), (51, ""), (7, "twin"), (7, "twin"), (None, some(30)), (52, "x " * 3000 + docs[-1][1])]
    frame = spark.createDataFrame([(t, "a", i) for i, t in docs], "text string, items string, doc_id bigint")
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    key = lambda r: (r[0] is None, r[0] or 0, r[1], r[2], r[3])
    got = [(r.doc_id, r.n_words, sum(s.end - s.start for s in r.spans), r.items)
           for r in fm.contamination(frame, bench, 5).collect()]
    assert sorted(got, key=key) == sorted(brute(docs, items, 5), key=key)


def test_removal_leaves_clean_text_alone(spark):
    leak = "one two three four five six seven eight nine ten"
    docs = spark.createDataFrame(
        [(1, f"Start here, {leak.upper()}! and; on.", 9, None), (2, "one two three four", 9, "x"), (3, None, None, "y"), (4, leak, 9, "z")],
        "doc_id bigint, text string, n_chars bigint, spans string")
    bench = spark.createDataFrame([(1, leak)], "item_id bigint, text string")
    got = {r.doc_id: r for r in fm.remove_contamination(docs, bench).collect()}
    assert got[1].text == "Start here, and; on." and got[1].n_chars == 20
    assert (got[2].text, got[2].n_chars, got[2].spans) == ("one two three four", 9, "x")
    assert got[3].text is None and got[4].text == "" and got[4].n_chars == 0


@pytest.mark.parametrize("block_chars", [32_000_000, 20])
def test_removal_does_not_depend_on_blocks(spark, monkeypatch, block_chars):
    """Overlapping items of different blocks are all cut from the original text; words brought together by a cut are no window."""
    monkeypatch.setattr(fm, "PHRASE_BLOCK_CHARS", block_chars)
    items = [(i, " ".join(f"w{j}" for j in range(3 * i, 3 * i + 5))) for i in range(8)] + [(20 + i, f"left{i} right{i}") for i in range(8)]
    chain = " ".join(f"w{j}" for j in range(26))
    docs = [(1, f"a {chain} z", 9, "x"), (2, chain, 9, "y"), (3, "clean words", 9, None), (4, None, None, None)]
    docs += [(100 + 10 * i + k, f"left{i} {items[k][1]} right{i}", 9, "s") for i in range(8) for k in range(8)]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string, n_chars bigint, __spans string")
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    got = {r.doc_id: (r.text, r.n_chars, r["__spans"]) for r in fm.remove_contamination(frame, bench, 5, drop_emptied=True).collect()}
    want = {1: ("a z", 3, "x"), 3: ("clean words", 9, None), 4: (None, None, None)}
    want |= {100 + 10 * i + k: (f"left{i} right{i}", len(f"left{i} right{i}"), "s") for i in range(8) for k in range(8)}
    assert got == want


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string")
    bench = spark.createDataFrame([], "item_id bigint, text string")
    assert fm.contamination(docs, bench).count() == 0
    one = spark.createDataFrame([(1, "a b")], "doc_id bigint, text string")
    assert fm.contamination(one, bench).first() == (1, 2, [], [])
