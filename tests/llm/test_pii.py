"""Base spans against Python's patterns, and contextual discovery on a planted context."""

import hashlib
import random
import re

import numpy as np
from pyspark.sql import functions as F

from loanloom.llm import pii
from loanloom.llm.storage import Scratch

BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def brute(text):
    out = []
    for k, (kind, pattern) in enumerate(BASE.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            if (kind == "email" or kind == "ip" and all(int(x) <= 255 for x in m[0].split("."))
                    or kind == "card" and 14 <= len(digits) <= 19 and luhn(digits) or kind == "phone" and 10 <= len(digits) <= 15):
                out.append((m.start(), k, m.end()))
    return sorted(out)


def spans(spark, rows):
    docs = spark.createDataFrame([(t, "r", i) for i, t in rows], "text string, row string, doc_id bigint").repartition(3)
    return [(r.doc_id, [tuple(s) for s in r.spans]) for r in pii.find_pii(docs, Scratch(spark, "pii")).collect()]


def test_base_spans_equal_python(spark):
    rng = random.Random(1)
    bits = ["a.b@c.d.e", "x@y", "@", "_q@r.st", "é4111111111111111", "4111-1111 1111 1111", "+1 (632) 555-4827", "+12", "1.2.3.4",
            "300.1.1.1", "1.2.3.4.5.6.7.8", "0001.02.3.255", " ", "  ", "-", ".", "+", "7", "00", "word", "ünï", "\n", "😀", "12345678901234"]
    rows = [(i, "".join(rng.choice(bits) for _ in range(rng.randrange(1, 14)))) for i in range(600)]
    rows += [(1000, None), (1001, ""), (1004, "1.2.3.4 " * 3_000), (None, "a@b.cd"), (1005, "me@me.me"), (1005, "me@me.me")]
    got = sorted(((i if i is not None else -1, [s for s in x if s[1] < 4]) for i, x in spans(spark, rows)), key=str)
    assert got == sorted(((i if i is not None else -1, brute(t)) for i, t in rows), key=str)


def test_very_long_runs_take_linear_time(spark):
    rows = [(1, "9" * 200_000), (2, "a" * 200_000 + "1"), (3, "+1" + " " * 100_000), (4, "a." * 50_000 + "@"), (5, "a." * 50_000 + "@b.c")]
    got = {i: [s for s in x if s[1] < 4] for i, x in spans(spark, rows)}
    assert got == {1: [], 2: [], 3: [], 4: [], 5: [(0, 0, 100_004)]}


def test_context_discovers_unseen_identifiers(spark):
    rows = [(i, f"prose mail: user{i}@host{i}.example.com and more {i}") for i in range(12)]
    rows += [(100, "prose mail: handle-77123 and more"), (101, "version: 12.34567x is out"), (102, "mail: plain words")]
    found = {i: x for i, x in spans(spark, rows)}
    assert found[100] == [(12, 4, 24)]
    assert found[101] == [] and found[102] == []
    assert all(len(found[i]) == 1 and found[i][0][1] == 0 for i in range(12))


def test_every_base_span_sets_up_its_context(spark):
    """Emails without digits, phones and cards in groups seed the word before the whole span."""
    cards = ["4111 1111 1111 1111", "5555 5555 5555 4444", "4012 8888 8888 1881", "3782 822463 10005", "6011 1111 1111 1117"]
    rows = [(i, f"prose mail: ({x}ane.doe@example.com) and") for i, x in enumerate("abcdef")]
    rows += [(10 + i, f"prose call: +1 (017) 555-771{i} and") for i in range(6)]
    rows += [(20 + i, f"prose paid: {x} and") for i, x in enumerate(cards)]
    rows += [(30, "x mail: handle-77123 and"), (31, "x call: desk-77123 and"), (32, "x paid: slip-77123 and"), (33, "x (017) 555-9999 and")]
    found = {i: x for i, x in spans(spark, rows)}
    assert [found[i] for i in range(30, 34)] == [[(8, 4, 20)], [(8, 4, 18)], [(8, 4, 18)], []]
    assert all(len(found[i]) == 1 and found[i][0][1] != 4 for i in range(24) if i in found)


def test_found_identifiers_bring_in_new_contexts(spark):
    rows = [(i, f"prose mail: user{i}@host.example.com and") for i in range(30)]
    rows += [(100 + i, f"x mail: tok-{1000 + i} and then login: tok-{1000 + i} there") for i in range(8)]
    rows += [(200, "x login: zed-90001 there"), (201, "x ticket: abc-90001 there")]
    found = {i: x for i, x in spans(spark, rows)}
    assert found[200] == [(9, 4, 18)] and found[201] == []
    assert all(len(found[100 + i]) == 2 for i in range(8))


def plain_score(edges, totals):
    """The same graph in Python: edges {(pattern, instance): (n, seed)}."""
    seed = {i: 0.0 for _, i in edges}
    for (_, i), (_, s) in edges.items():
        seed[i] = max(seed[i], float(s))
    floor = pii.LIFT * sum(n for n, s in edges.values() if s) / max(1, sum(totals.values()))
    own = {}
    for (p, _), (n, _) in edges.items():
        own[p] = own.get(p, 0) + n
    scored, accepted, before = dict(seed), {i for i in seed if seed[i] == 1}, None
    while accepted != before:
        before, strength = accepted, {}
        for p in own:
            mine = [(i, n) for (q, i), (n, _) in edges.items() if q == p]
            if sum(i in accepted for i, _ in mine) >= pii.MIN_SEEDS:
                x = sum(scored[i] * n for i, n in mine) / (max(own[p], totals.get(p, 0)) + 1)
                if x >= min(floor, pii.PATTERN_SCORE):
                    strength[p] = x
        scored, accepted = dict(seed), {i for i in seed if seed[i] == 1}
        for i in seed:
            near = [strength[p] for p, j in edges if j == i and p in strength]
            reached = 1 - np.prod([1 - x for x in near])
            scored[i] = max(seed[i], reached)
            if near and reached >= pii.INSTANCE_SCORE and max(near) >= pii.PATTERN_SCORE:
                accepted = accepted | {i}
    good = {p for p, x in strength.items() if x >= pii.PATTERN_SCORE}
    return sorted((p, i) for p, i in edges if p in good and i in accepted)


def test_scores_equal_plain_graph(spark):
    rng = random.Random(5)
    for _ in range(3):
        instances = {i: rng.random() < 0.4 for i in range(60)}
        edges = {(f"p{rng.randrange(12)}: ", i): (rng.randrange(1, 4), instances[i]) for i in instances for _ in range(2)}
        totals = {f"p{k}: ": rng.choice([5, 12, 20, 400]) for k in range(11)} | {"other ": 5_000}
        frame = spark.createDataFrame([(p, i, n, s) for (p, i), (n, s) in edges.items()], "pattern string, instance bigint, n bigint, seed boolean")
        known = spark.createDataFrame(list(totals.items()), "pattern string, total bigint")
        got = pii.score(frame, known, Scratch(spark, "score")).collect()
        assert sorted((r.pattern, r.instance) for r in got) == plain_score(edges, totals)


def test_planted_identifiers_and_common_words(spark):
    """Identifiers in planted contexts are found, tokens and rejected cards after common words are not."""
    rng = random.Random(9)
    common, rows, planted = ["the", "of", "was", "in", "report"], [], set()

    def say(n):
        return " ".join(rng.choice(common) for _ in range(n))

    for d in range(200):
        text = say(rng.randrange(5, 20)) + " "
        kind = d % 5
        if kind == 0:
            text += f"mail: {rng.choice('abc')}x{d}@host.example.com"
        elif kind == 1:
            text += f"call: +1 (017) 555-{1000 + d}"
        elif kind == 2:
            text += f'token = "{rng.getrandbits(160):040x}"'
            planted.add((d, text.index('"') + 1, len(text) - 1))
        elif kind == 3 and d % 2:
            text += f"{rng.choice(['mail', 'call'])}: user-{d * 7919}"
            planted.add((d, text.index("user-"), len(text)))
        else:  # no identifiers: numbers after common words, cards that fail, a lone digest
            text += f"the build-{d}77 of 4111111111111112 was 12345678901234567890 in {rng.getrandbits(128):032x}"
        rows.append((d, text + " " + say(6)))
    found = {(i, s[0], s[2]) for i, x in spans(spark, rows) for s in x if s[1] == 4}
    assert len(found & planted) >= 0.9 * len(planted) and len(found & planted) >= 0.9 * len(found)


def test_context_is_the_whole_word(spark):
    """Words that agree in their last 48 characters are different patterns."""
    tail = "x" * 60 + ":"
    rows = [(i, f"a{tail} user{i}@host.example.com now") for i in range(9)] + [(50, f"a{tail} id-12345 now"), (51, f"b{tail} id-12346 now")]
    found = {i: x for i, x in spans(spark, rows)}
    assert found[50] and not found[51]


def test_empty(spark):
    assert spans(spark, []) == []
