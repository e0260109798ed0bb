"""Conversation repair: cheapest and ASCII-least edits against brute force, blocks of any length, odd rows."""

import hashlib
import random
import re
from functools import cache

import pytest

from loanloom.llm import queries, repair
from loanloom.llm.storage import Scratch

SCHEMA = "role string, text string, turn bigint, conv_id bigint, conv string, pos string, fault int, edit boolean, __conv int"
WHITE = " \t\n\x0b\x0c\r"


def faults(rows):
    seen, out = set(), []
    for role, text in rows:
        kept = text.strip(WHITE)
        out.append("blank" if not kept else "duplicate" if (role, text) in seen else "" if kept[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return out


def plain(rows):
    """Every edit sequence, one by one: (cost, audit, lines) of the least."""
    marks = faults(rows)

    @cache
    def best(i, roles):
        if len(roles) > 2 * len(rows) + 3 or not re.fullmatch("s?(ua)*u?", roles):
            return None
        found = [(0, "", ())] if i == len(rows) and re.fullmatch("(s?(ua)+)?", roles) else []

        def add(cost, letter, line, rest):
            if rest is not None:
                found.append((cost + rest[0], letter + rest[1], ((line,) if line is not None else ()) + rest[2]))

        for name in ("user", "assistant"):
            add(3, "I", f"{name}:", best(i, roles + name[0]))
        if i < len(rows):
            role, text = rows[i]
            add(4, "D", None, best(i + 1, roles))
            if marks[i] not in ("blank", "duplicate"):
                cut = 3 * (marks[i] == "truncated")
                if role[:1] in ("s", "u", "a") and role:
                    add(cut, "K", f"{role}:{text}", best(i + 1, roles + role[0]))
                for name in ("user", "assistant"):
                    add(cut + 3, "R", f"{name}:{text}", best(i + 1, roles + name[0]))
        return min(found, default=None)

    return best(0, "")


def expected(conversation):
    rows = [(" " if r is None else r, " " if t is None else t) for _, r, t in sorted(
        conversation, key=lambda x: (x[0] is not None, x[0] or 0, " " if x[1] is None else x[1], " " if x[2] is None else x[2]))]
    turns = [n for n, _, _ in conversation if n is not None]
    cost, audit, lines = plain(rows)
    marks = faults(rows)
    illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    return (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *[marks.count(k) for k in ("blank", "duplicate", "truncated")],
            illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


def found(spark, conversations, **options):
    rows = [(r, t, n, c, "x", "y", 7, True, 1) for c, turns in conversations.items() for n, r, t in turns]
    frame = spark.createDataFrame(rows, SCHEMA).repartition(3)
    edits, summary = repair.repair(frame, Scratch(spark, "repair"), **options)
    joined = summary.join(repair.digest(edits), "conv")
    return {r.conv_id: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.repaired_sha256) for r in joined.collect()}


ODD = {
    None: [(0, "user", "Hi."), (1, "assistant", "Yes.")], 1: [(None, None, None), (None, "user", "a.")], 2: [(3, "tool", "x."), (3, "tool", "x."), (9, "", "")],
    3: [(0, "system", "Be kind."), (1, "system", "Be kind.")], 4: [(0, "assistant", "first.")], 5: [(0, "user", "no end"), (1, "assistant", "cut  ")],
    6: [(0, "user", "."), (1, "assistant", "? \n"), (2, "user", "w" * 200_000 + "!"), (3, "assistant", "é!\x0b")], 7: [(0, "user", "same."), (0, "user", "same.")],
    8: [(0, "undecided", "keeps its name."), (1, "assistant", "a.")],
}


@pytest.mark.parametrize("block_rows", [1, 2, 1_024])
def test_equals_every_edit_tried(spark, block_rows):
    rng = random.Random(5)
    texts = ["Yes.", "No!", "Why?", "cut", "", " \t", "and so", "Yes."]
    cases = dict(ODD)
    for c in range(10, 60):
        cases[c] = [(rng.choice([i, i + 1]), rng.choice(["system", "user", "assistant", "user", "assistant", "tool"]), rng.choice(texts) or str(i)[:i % 2])
                    for i in range(rng.randrange(1, 7))]
    got = found(spark, cases, block_rows=block_rows)
    assert got == {c: expected(turns) for c, turns in cases.items()}


def test_hot_conversation_is_cut(spark, monkeypatch):
    """A conversation with most of the rows: numbered by range, cut into square-root blocks, same edits."""
    from loanloom.operators import ordered

    rng = random.Random(6)
    long = [(i, rng.choice(["user", "assistant"]), f"{i}{rng.choice(['.', ''])}") for i in range(700)]
    cases = {1: long, 2: long[:5], 3: long[5:12]}
    whole = found(spark, cases)
    monkeypatch.setattr(ordered, "MAX_GROUP_ROWS", 100)
    assert found(spark, cases, block_rows=4) == whole
    spans = {r.conv: r.span for r in repair.cut_blocks(repair.row_faults(repair.number_rows(
        spark.createDataFrame([(1, n, r, t) for n, r, t in long], "conv_id int, turn int, role string, text string"), Scratch(spark, "x"))), 4).collect()}
    assert spans == {"c1": 27}


def test_edits_are_the_repaired_rows(spark):
    rows = [(1, 0, "assistant", "a."), (1, 1, "user", " "), (1, 2, "user", "q?")]
    edits, _ = repair.repair(spark.createDataFrame(rows, "conv_id int, turn int, role string, text string"), Scratch(spark, "r"))
    got = [(r.edit, r.role, r.text) for r in edits.orderBy("pos", "step").collect()]
    assert got == [("I", "user", ""), ("K", "assistant", "a."), ("D", None, None), ("K", "user", "q?"), ("I", "assistant", "")]


def test_empty_and_dropped(spark, tmp_path):
    empty = spark.createDataFrame([], "conv_id bigint, turn bigint, role string, text string")
    edits, summary = repair.repair(empty, Scratch(spark, "r"))
    assert edits.count() == summary.count() == repair.digest(edits).count() == 0
    import zlib

    gone = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    spark.createDataFrame([(gone, 0, "user", "x."), (None, None, None, None)], empty.schema).write.parquet(str(tmp_path / "conversations.parquet"))
    got = {r.conv_id: r for r in queries.op12_structure_repair(spark, str(tmp_path)).collect()}
    none = got[gone]
    assert (none.cost, none.audit, none.repaired_sha256) == (0, "", hashlib.sha256(b"").hexdigest())
    assert got.keys() == {gone, None}
