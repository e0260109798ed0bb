"""Every pipeline stage against a brute-force version of it, on the smallest tables."""

import hashlib
import re
import zlib
from collections import defaultdict
from pathlib import Path

import numpy as np
import pytest

import corpus_pipeline as cp
from loanloom.llm import fm_index, mixing, quality

from test_mixing import plain as plain_mix

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="driver tables not present")


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """(input rows, output rows) of every stage, written and read in between."""
    folder, docs, out = tmp_path_factory.mktemp("stages"), spark.read.parquet(f"{FOLDER}/documents.parquet"), {}
    for name, stage in cp.STAGES:
        before = rows_of(docs)
        stage(spark, docs, FOLDER).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        out[name] = before, rows_of(docs), docs.columns
    return out


def test_order_and_columns(spark, stages):
    assert [n for n, _ in cp.STAGES] == ["quality", "near_duplicates", "decontaminate", "mix", "token_files"]
    columns = spark.read.parquet(f"{FOLDER}/documents.parquet").columns
    assert all(set(c) == set(columns) for _, _, c in list(stages.values())[:-1])


def test_quality(spark, stages):
    before, after, _ = stages["quality"]
    assert set(after) <= set(before)
    known = {r.doc_id: r.quality for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    kept = {r[0] for r in after}
    judged = [(d in kept, known[d] == 1) for d in (r[0] for r in before) if d in known]
    assert all(k for k, good in judged if good) and sum(k != good for k, good in judged) <= 0.02 * len(judged)
    model = quality.fit(np.array([quality.features(r[1]) for r in before if r[0] in known]),
                        np.array([float(known[r[0]]) for r in before if r[0] in known]))
    sure = [(r[0] in kept, z) for r in before if abs(z := float(np.dot(model[0], quality.features(r[1])) + model[1])) > 2]
    assert all(k == (z > 0) for k, z in sure)


def test_near_duplicates(stages):
    before, after, _ = stages["near_duplicates"]

    def shingles(text):
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
        return frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()

    sets, parent = {r[0]: shingles(r[1]) for r in before}, {r[0]: r[0] for r in before}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, s in sets.items():
        for b, t in sets.items():
            if a < b and s and t and 100 * len(s & t) >= 80 * len(s | t):
                p, q = root(a), root(b)
                parent[max(p, q)] = min(p, q)
    assert after == sorted((r for r in before if root(r[0]) == r[0]), key=str)


def test_decontaminate(spark, stages):
    before, after, columns = stages["decontaminate"]
    text, chars = columns.index("text"), columns.index("n_chars")
    windows = set()
    for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect():
        w = fm_index.words(r.text)
        windows |= {tuple(w[i:i + 10]) for i in range(max(1, len(w) - 9)) if w}
    left = {r[0]: r for r in after}
    touched = 0
    for r in before:
        w = fm_index.words(r[text])
        hit = {j for n in {len(x) for x in windows} for i in range(len(w) - n + 1) if tuple(w[i:i + n]) in windows for j in range(i, i + n)}
        touched += bool(hit)
        if not hit:
            assert left[r[0]] == r
        elif len(hit) == len(w):
            assert r[0] not in left
        else:
            assert fm_index.words(left[r[0]][text]) == [x for i, x in enumerate(w) if i not in hit]
            assert left[r[0]][chars] == len(left[r[0]][text])
    assert touched


def test_mix(stages):
    before, after, columns = stages["mix"]
    cells, tokens = {}, defaultdict(int)
    for r in before:
        d = dict(zip(columns, r))
        topic = next((t for t, mark in mixing.TOPICS if mark in d["text"]), "prose")
        cells[d["doc_id"]] = (d["source"], d["lang"], topic)
        tokens[cells[d["doc_id"]]] += len(d["text"].split())
    probability, _ = plain_mix(tokens, keep=cp.KEEP_TOKENS)
    draw = lambda d: int(hashlib.md5(f"mix:{d}".encode()).hexdigest()[:13], 16) / 16**13
    assert after == [r for r in before if draw(r[0]) < round(probability[cells[r[0]]], 9)]


def test_token_files(stages):
    from tokenizers import Tokenizer

    public_tokenizers = pytest.importorskip("public_tokenizers")
    coder, start, want = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), 0, []
    before, after, _ = stages["token_files"]
    for r in sorted(before):
        ids = coder.encode(r[1], add_special_tokens=False).ids + [cp.END_ID]
        want.append((r[0], start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted(after) == want


def test_one_row_of_each_group_stays_with_odd_ids(spark):
    a, b = "calm words about rivers and stones " * 5, "another story of ships and harbours " * 6
    rows = [(7, a, "x"), (5, a, "x"), (5, a, "x"), (None, a, "x"), (9, b, "x"), (None, b, "x"), (8, "alone " * 9, "x"), (8, b + "tail", "x"),
            (None, "no id but its own words here", "x"), (3, None, "x"), (4, "", "x"), (4, "", "x")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, key string").repartition(3)
    kept = cp.keep_one_of_a_group(spark, docs, FOLDER)
    assert kept.columns == docs.columns
    assert rows_of(kept) == sorted([(5, a, "x"), (8, b + "tail", "x"), (8, "alone " * 9, "x"), (None, "no id but its own words here", "x"),
                                    (3, None, "x"), (4, "", "x"), (4, "", "x")], key=str)


def test_odd_documents_pass_all_stages(spark, tmp_path):
    leak = "one two three four five six seven eight nine ten"
    rows = [(1, "calm words about rivers and stones " * 5, "en", "s", 9), (2, "calm words about rivers and stones " * 5, "en", "s", 9),
            (3, None, None, None, None), (4, "", "en", "s", 0), (None, "no key here at all", "en", "s", 1), (5, leak, "en", "s", 1),
            (6, f"before {leak} after", "en", None, 1), (7, "long text " * 40_000, "de", "t", 1)]
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    folder = str(tmp_path)
    spark.createDataFrame(rows, schema).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, 1, 0), (None, 0, 0)], "doc_id bigint, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, leak), (None, None)], "item_id bigint, text string").write.parquet(f"{folder}/benchmark.parquet")
    out = cp.run(spark, folder).collect()
    assert {r.doc_id for r in out} <= {1, 3, 4, None, 6, 7} and len({r.start for r in out}) == len(out)
    empty = str(tmp_path / "empty")
    spark.createDataFrame([], schema).write.parquet(f"{empty}/documents.parquet")
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{folder}/{name}.parquet").limit(0).write.parquet(f"{empty}/{name}.parquet")
    assert cp.run(spark, empty).count() == 0
