"""Quality: features, fit, shrinkage against a plain version, and what it keeps."""

import math
import random
from collections import defaultdict

import numpy as np

from loanloom.llm import quality
from loanloom.llm.storage import Scratch

WORDS = ["river", "stone", "quiet", "morning", "letter", "garden", "walk", "under", "light", "always"]


def corpus(seed, n):
    rng = random.Random(seed)
    rows, labels = [], []
    for d in range(n):
        good = rng.random() < 0.8
        words = [rng.choice(WORDS) + (str(rng.randrange(99)) if rng.random() < 0.2 else "") for _ in range(rng.randrange(5, 120))]
        text = " ".join(words) + "." if good else " ".join(w.upper() + "!!" if d % 2 else w + "$$$" for w in words)
        rows.append((text, f"h{d % 7}", "en" if d % 3 else None, d, "extra"))
        if d % 2:
            labels.append((d, int(good)))
    return rows, labels, {d: r for d, r in enumerate(rows)}


def judged(spark, rows, labels):
    docs = spark.createDataFrame(rows, "text string, source string, lang string, doc_id bigint, path string").repartition(3)
    known = spark.createDataFrame(labels, "doc_id bigint, quality int")
    return quality.judge(docs, known, Scratch(spark, "quality")).collect()


def test_keeps_good_and_rejects_bad_on_held_out(spark):
    rows, labels, _ = corpus(1, 400)
    known = dict(labels)
    got = judged(spark, rows, labels)
    assert len(got) == 400 and all(r.path == "extra" for r in got)
    held = [(r["__verdict"].keep, "$$$" not in r.text and "!!" not in r.text) for r in got if r.doc_id not in known]
    assert all(a == b for a, b in held)


def test_posteriors_equal_plain_version(spark):
    rng = random.Random(3)
    rows = [(f"h{rng.randrange(9)}", f"p{rng.randrange(3)}", rng.random()) for _ in range(300)] + [("lone", "x", 0.05)]
    got = quality.site_posteriors(spark.createDataFrame(rows, "host string, path string, p double"), Scratch(spark, "sites")).collect()
    paths, hosts = defaultdict(list), defaultdict(list)
    for h, p, x in rows:
        paths[h, p].append(x)
        hosts[h].append(x)
    prior = (sum(x for *_, x in rows) + 1) / (len(rows) + 2)

    def strength(groups):
        noise = sum(len(x) * c * (1 - c) for x, c in groups)
        spread = sum(len(x) * (np.mean(x) - c) ** 2 for x, c in groups)
        n = sum(len(x) for x, _ in groups)
        between = max(0, (spread - sum(c * (1 - c) for _, c in groups)) / n)
        return min(quality.MAX_STRENGTH, max(quality.MIN_STRENGTH, noise / n / between - 1)) if between else quality.MAX_STRENGTH

    k = strength([(x, prior) for x in hosts.values()])
    host = {h: (k * prior + sum(x)) / (k + len(x)) for h, x in hosts.items()}
    k = strength([(x, host[h]) for (h, _), x in paths.items()])
    for r in got:
        x = paths[r.host, r.path]
        assert math.isclose(r.host_posterior, host[r.host], rel_tol=1e-9)
        assert math.isclose(r.path_posterior, (k * host[r.host] + sum(x)) / (k + len(x)), rel_tol=1e-9)


def test_verdict_equals_plain_version(spark):
    """Every document's quality from its own evidence and the posterior of all others of its site."""
    rows, labels, _ = corpus(4, 120)
    rows += [("river stone quiet morning.", "lone", "en", 500, "x"), ("RIVER!! STONE!! QUIET!!", "lone2", None, 501, "x")]
    got = judged(spark, rows, labels)
    known = dict(labels)
    x = np.array([quality.features(r[0]) for r in rows])
    at = [i for i, r in enumerate(rows) if r[3] in known]
    w, b = quality.fit(x[at], np.array([known[rows[i][3]] for i in at], dtype=float))
    p = 1 / (1 + np.exp(-np.clip(x @ w + b, -30, 30)))
    prior = (p.sum() + 1) / (len(p) + 2)
    host = [r[1] or "" for r in rows]
    site = [(r[1] or "", r[2] or "") for r in rows]

    def group(keys, centre):
        sums = defaultdict(list)
        for k, v in zip(keys, p):
            sums[k].append(v)
        noise = sum(len(v) * centre(k) * (1 - centre(k)) for k, v in sums.items())
        n = sum(map(len, sums.values()))
        spread = sum(len(v) * (np.mean(v) - centre(k)) ** 2 for k, v in sums.items()) - sum(centre(k) * (1 - centre(k)) for k in sums)
        between = max(0, spread / n)
        return sums, min(1e6, max(1.0, noise / n / between - 1)) if between else 1e6

    hosts, ks = group(host, lambda k: prior)
    sites, kp = group(site, lambda k: (ks * prior + sum(hosts[k[0]])) / (ks + len(hosts[k[0]])))
    want = {}
    for i, r in enumerate(rows):
        above = (ks * prior + sum(hosts[host[i]]) - p[i]) / (ks + len(hosts[host[i]]) - 1)
        post = (kp * above + sum(sites[site[i]]) - p[i]) / (kp + len(sites[site[i]]) - 1)
        odds = p[i] / (1 - p[i]) * post / (1 - post) / (prior / (1 - prior))
        want[r[3]] = odds / (1 + odds)
    assert len(got) == len(rows)
    assert all(math.isclose(r["__verdict"].quality, want[r.doc_id], abs_tol=2e-6) for r in got)


def test_clashing_names(spark):
    rows, labels, _ = corpus(6, 60)
    names = "text string, source string, lang string, doc_id bigint, row string, post string, site string, __quality string, __verdict string"
    docs = spark.createDataFrame([(*r[:4], "a", "b", "c", "d", "e") for r in rows], names)
    got = quality.judge(docs, spark.createDataFrame(labels, "doc_id bigint, quality int"), Scratch(spark, "quality"))
    assert got.columns == docs.columns
    assert all((r.row, r.post, r.site, r["__quality"]) == ("a", "b", "c", "d") and 0 <= r["__verdict"].quality <= 1 for r in got.collect())


def test_odd_rows(spark):
    rows, labels, _ = corpus(2, 60)
    rows += [(None, None, None, 900, "e"), ("", "h1", "en", 901, "e"), ("long " * 50_000, "h1", "en", 902, "e"), (rows[0][0], "h0", "en", None, "e"),
             rows[1], rows[1]]
    labels += [(None, 1), (5, None), (labels[0][0], labels[0][1]), (77_777, 1)]
    assert len(judged(spark, rows, labels)) == len(rows)
    assert judged(spark, [], labels) == []
    kept = judged(spark, rows, [])
    assert all(r["__verdict"].keep for r in kept)


def test_one_class_fits_its_share():
    w, b = quality.fit(np.zeros((3, len(quality.FEATURES))), np.ones(3))
    assert not w.any() and math.isclose(b, math.log(4))
