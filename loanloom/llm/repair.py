"""Conversation structure repair by square-root checkpointed dynamic programming.

A conversation's rows, in order of turn, are brought to roles of the form ``(s?(ua)+)?`` by the
cheapest edits: Keep (0), Rerole to user or assistant (3), Delete (4) and Insert of an empty user or
assistant row (3). Blank and repeated rows have to go; a truncated row that stays costs 3 more.

The roles so far are one of four states (nothing, system, after user, after assistant), so a row is a
4 x 4 matrix over (min, +) and so is a run of rows. A conversation of n rows is cut into blocks of
about the square root of n rows (``BLOCK_ROWS`` at least). Backward state-cost vectors are kept at
block ends only: they come from the blocks' matrices. Each block then recomputes its own vectors and
walks forward from every state it may be entered in, always along the tight edit (cost of the edit
plus cost from there on equals the cost from here) whose initial comes first in ASCII. Which of its
walks a block takes follows from the exits of the blocks before it. So no task holds a conversation:
a block's codes are one character a row, and texts only stream by.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanloom.llm.caches import using
from loanloom.llm.storage import Scratch
from loanloom.operators.ordered import number_within

BLOCK_ROWS = 1_024
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
FAR = 1 << 40

NOTHING, SYSTEM, USER, ASSISTANT = range(4)
ROLE_NAMES = {"u": "user", "a": "assistant"}
#: What has to follow a state: the role's initial and the state after it.
NEXT = {NOTHING: ("u", USER), SYSTEM: ("u", USER), USER: ("a", ASSISTANT), ASSISTANT: ("u", USER)}
LEGAL_PAIRS = {"su", "ua", "au"}

#: One character a row: initial of its role ("o" for others), in capitals if truncated, as a digit if it has to go.
KEEP, CUT, GONE = "suao", "SUAO", "0123"
CODES = KEEP + CUT + GONE


def edits(code: str, state: int) -> list[tuple[str, int, int]]:
    """(letters, cost, state after) of the edits of one row in a state, initials in ASCII order."""
    out = [("D", DELETE, state)]
    if code in GONE:
        return out
    initial, extra = (code, 0) if code in KEEP else (KEEP[CUT.index(code)], TRUNCATED)
    want, after = NEXT[state]
    if initial == want:
        out.append(("K", extra, after))
    elif initial == "s" and state == NOTHING:
        out.append(("K", extra, SYSTEM))
    return [*out, ("R" + want, extra + REROLE, after)]


def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Inserts as a closed matrix, and a matrix per code: inserts, then one edit of the row."""
    insert = np.full((4, 4), FAR)
    for state, (_, after) in NEXT.items():
        insert[state, state] = 0
        insert[state, after] = min(insert[state, after], INSERT)
        beyond = NEXT[after][1]
        insert[state, beyond] = min(insert[state, beyond], 2 * INSERT)
    rows = np.full((len(CODES), 4, 4), FAR)
    for i, code in enumerate(CODES):
        step = np.full((4, 4), FAR)
        for state in range(4):
            for _, cost, after in edits(code, state):
                step[state, after] = min(step[state, after], cost)
        rows[i] = (insert[:, :, None] + step[None]).min(1)
    return insert, np.minimum(rows, FAR)


_INSERT, _ROWS = _tables()
#: Cost from each state once no rows are left: inserts up to nothing at all or a last assistant.
END = _INSERT[:, [NOTHING, ASSISTANT]].min(1)


def block_matrices(codes: list[str]) -> np.ndarray:
    """The (min, +) matrix of every block, all blocks of a batch side by side."""
    lengths = np.array([len(c) for c in codes], dtype=np.int64)
    ids = np.zeros((len(codes), lengths.max(initial=0)), dtype=np.int64)
    for i, c in enumerate(codes):
        ids[i, :len(c)] = [CODES.index(x) for x in c]
    out = np.where(np.eye(4, dtype=bool), 0, FAR)[None].repeat(len(codes), 0)
    for at in range(ids.shape[1] - 1, -1, -1):
        live = np.flatnonzero(lengths > at)
        out[live] = np.minimum((_ROWS[ids[live, at]][:, :, :, None] + out[live][:, None]).min(2), FAR)
    return out


def walk(codes: str, end: np.ndarray, entries: range, last: bool) -> tuple[list[list[str]], list[int]]:
    """Edits of a block for each state it may be entered in, one text a row, and the states it is left in.

    An edit is K, D, R or I, the latter two with the initial of the role; inserts stand before the row's
    own edit. ``end`` is the vector at the block's end; the last block ends with closing inserts.
    """
    after = [np.asarray(end, dtype=np.int64)]  # the block's own vectors, last row first
    for code in reversed(codes):
        after.append((_ROWS[CODES.index(code)] + after[-1]).min(1))
    after.reverse()
    texts, exits = [], []
    for state in entries:
        pieces = []
        for at, code in enumerate(codes):
            piece = ""
            while True:
                here, chosen = after[at][state], None
                options = [(*e, after[at + 1]) for e in edits(code, state)]
                options.insert(1, ("I" + NEXT[state][0], INSERT, NEXT[state][1], after[at]))
                for letters, cost, then, rest in options:  # D, I, K, R
                    if cost + rest[then] == here:
                        chosen = (letters, then)
                        break
                piece += chosen[0]
                state = chosen[1]
                if not chosen[0].startswith("I"):
                    break
            pieces.append(piece)
        while last and END[state] > 0:
            pieces[-1] += "I" + NEXT[state][0]
            state = NEXT[state][1]
        texts.append(pieces)
        exits.append(int(state))
    return texts, exits


# -- rows and blocks --------------------------------------------------------

_WHITE = r"\x20\x09-\x0D"


def _faults(role: Column, text: Column) -> tuple[Column, Column]:
    blank = ~text.rlike(f"[^{_WHITE}]")
    return blank, ~blank & ~text.rlike(rf"[.!?][{_WHITE}]*\z")


def number_rows(turns: DataFrame, scratch: Scratch) -> DataFrame:
    """The rows with ``conv`` (a text key that tells null apart) and ``pos``, 1 upwards in order of turn
    (nulls first), role and text; null roles and texts are one space. Conversations may have any size."""
    rows = turns.select(
        F.when(F.col("conv_id").isNull(), "").otherwise(F.concat(F.lit("c"), F.col("conv_id").cast("string"))).alias("conv"),
        "conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"))
    order = [F.col("turn").asc_nulls_first(), F.col("role").asc(), F.col("text").asc()]
    return scratch.store(number_within(rows, "conv", order, "pos"))


def row_faults(rows: DataFrame) -> DataFrame:
    """(conv, pos, turn, initial, fault): the first of blank, duplicate and truncated, or an empty text."""
    blank, cut = _faults(F.col("role"), F.col("text"))
    digest = F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256)
    facts = rows.select("conv", "pos", "turn", F.substring("role", 1, 1).alias("initial"), blank.alias("blank"), cut.alias("cut"), digest.alias("digest"))
    first = facts.groupBy("conv", "digest").agg(F.min("pos").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    fault = F.when(F.col("blank"), "blank").when(F.col("pos") > F.col("first"), "duplicate").when(F.col("cut"), "truncated").otherwise("")
    return facts.join(first, ["conv", "digest"], "left").select("conv", "pos", "turn", "initial", fault.alias("fault"))


def cut_blocks(facts: DataFrame, block_rows: int) -> DataFrame:
    """(conv, span, block, codes): a block's rows in order, one character each."""
    # conversations whose square root exceeds the least block: at most one in block_rows ** 2 rows
    long = facts.groupBy("conv").count().where(F.col("count") > block_rows * block_rows).select(
        "conv", F.ceil(F.sqrt("count")).cast("long").alias("span"))
    kind = F.when(F.col("initial").isin("s", "u", "a"), F.instr(F.lit(KEEP), F.col("initial"))).otherwise(len(KEEP))
    alphabet = F.when(F.col("fault").isin("blank", "duplicate"), F.lit(GONE)).when(F.col("fault") == "truncated", F.lit(CUT)).otherwise(F.lit(KEEP))
    coded = facts.join(long, "conv", "left").select(
        "conv", F.coalesce("span", F.lit(block_rows).cast("long")).alias("span"), "pos", F.substring(alphabet, kind, F.lit(1)).alias("code"))
    block = F.floor((F.col("pos") - 1) / F.col("span"))
    ordered = F.array_sort(F.collect_list(F.struct("pos", "code")))
    return coded.groupBy("conv", "span", block.alias("block")).agg(F.array_join(F.transform(ordered, lambda r: r["code"]), "").alias("codes"))


def _initial(code: str) -> str:
    return KEEP[CODES.index(code) % len(KEEP)]


def _measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    using()
    for batch in batches:
        if len(batch):
            codes = list(batch["codes"])
            roles = ["".join(map(_initial, c)) for c in codes]
            yield pd.DataFrame({
                "conv": batch["conv"], "block": batch["block"], "matrix": list(block_matrices(codes).reshape(len(batch), 16)),
                "edges": [r[0] + r[-1] for r in roles],
                "illegal": [sum(r[i:i + 2] not in LEGAL_PAIRS for i in range(len(r) - 1)) for r in roles]})


def _chain_back(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Vectors at the block ends of each conversation, from its last block to its first."""
    using()
    for batch in batches:
        out = []
        for conv, blocks in zip(batch["conv"], batch["blocks"]):
            illegal = sum(b["illegal"] for b in blocks)
            illegal += sum(a["edges"][1] + b["edges"][0] not in LEGAL_PAIRS for a, b in zip(blocks, blocks[1:]))
            vector = END
            ends = []
            for b in reversed(blocks):
                ends.append(vector)
                vector = (np.asarray(b["matrix"]).reshape(4, 4) + vector).min(1)
            for b, end in zip(blocks, reversed(ends)):
                first = b is blocks[0]
                out.append((conv, b["block"], end, b is blocks[-1], int(vector[NOTHING]) if first else None, illegal if first else None))
        if out:
            yield pd.DataFrame(out, columns=["conv", "block", "end", "last", "cost", "illegal"]).astype({"cost": "Int64", "illegal": "Int64"})


def _walk_blocks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    using()
    for batch in batches:
        out = []
        for conv, span, block, codes, end, last in zip(*(batch[c] for c in ("conv", "span", "block", "codes", "end", "last"))):
            texts, exits = walk(codes, end, range(1) if block == 0 else range(4), last)
            out += [(conv, span, block, entry, texts[entry], exits[entry]) for entry in range(len(texts))]
        if out:
            yield pd.DataFrame(out, columns=["conv", "span", "block", "entry", "pieces", "leave"])


def _chain_on(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The state in which each block of a conversation is entered."""
    using()
    for batch in batches:
        out = []
        for conv, walks in zip(batch["conv"], batch["walks"]):
            leave = {(w["block"], w["entry"]): w["leave"] for w in walks}
            state = NOTHING
            for block in range(max(b for b, _ in leave) + 1):
                out.append((conv, block, state))
                state = leave[block, state]
        if out:
            yield pd.DataFrame(out, columns=["conv", "block", "entry"])


_DIGEST = pa.schema([("conv", pa.string()), ("audit", pa.string()), ("repaired_sha256", pa.string())])


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    using()
    current, letters, sha, empty = None, [], None, True
    for batch in batches:
        done = []
        for conv, edit, role, text in zip(*(c.to_pylist() for c in batch.columns)):
            if conv != current:
                if current is not None:
                    done.append((current, "".join(letters), sha.hexdigest()))
                current, letters, sha, empty = conv, [], hashlib.sha256(), True
            letters.append(edit)
            if edit != "D":
                sha.update(f"{'' if empty else chr(10)}{role}:{text}".encode())
                empty = False
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*done), _DIGEST)], schema=_DIGEST)
    if current is not None:
        yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip((current, "".join(letters), sha.hexdigest()), _DIGEST)], schema=_DIGEST)


# -- the operator -----------------------------------------------------------

def repair(turns: DataFrame, scratch: Scratch, block_rows: int = BLOCK_ROWS) -> tuple[DataFrame, DataFrame]:
    """Edits and summary of ``turns`` (conv_id, turn, role, text; further columns are ignored).

    Edits: ``conv_id, pos, step, edit, role, text``, the edits of row ``pos`` in order; what is left
    without the deleted rows (``edit`` D, null role and text) is the repaired conversation. Summary, one
    row per conversation that has rows: ``gaps, blank, duplicate, truncated, illegal, cost``.

    A null conv_id is a conversation of its own; null turns come first and count for no gap; null roles
    and texts are one space. Rows of equal turn go by role and text, so repeated rows are each other's
    duplicates. Roles that begin with none of s, u, a are reroled or deleted. An empty table gives empty
    results.
    """
    rows = number_rows(turns, scratch)
    facts = scratch.store(row_faults(rows))
    blocks = scratch.store(cut_blocks(facts, block_rows))
    measured = blocks.select("conv", "block", "codes").mapInPandas(
        _measure, "conv string, block bigint, matrix array<bigint>, edges string, illegal bigint")
    gathered = measured.groupBy("conv").agg(F.array_sort(F.collect_list(F.struct("block", "matrix", "edges", "illegal"))).alias("blocks"))
    ends = scratch.store(gathered.mapInPandas(
        _chain_back, "conv string, block bigint, end array<bigint>, last boolean, cost bigint, illegal bigint"))
    walks = scratch.store(blocks.join(ends.select("conv", "block", "end", "last"), ["conv", "block"]).select(
        "conv", "span", "block", "codes", "end", "last").mapInPandas(
        _walk_blocks, "conv string, span bigint, block bigint, entry bigint, pieces array<string>, leave bigint"))
    many = walks.where("block > 0").select("conv").distinct()
    states = walks.select("conv", "block", "entry", "leave").join(many, "conv", "left_semi").groupBy("conv").agg(
        F.collect_list(F.struct("block", "entry", "leave")).alias("walks")).mapInPandas(_chain_on, "conv string, block bigint, entry bigint")
    taken = walks.where("block = 0").unionByName(walks.where("block > 0").join(states, ["conv", "block", "entry"], "left_semi"))
    pieces = taken.select("conv", "span", "block", F.posexplode("pieces").alias("i", "piece")).select(
        "conv", (F.col("block") * F.col("span") + F.col("i") + 1).alias("pos"), "piece")

    letters = F.regexp_extract_all("piece", F.lit("([IR][ua]|K|D)"), F.lit(1))
    edited = rows.join(pieces, ["conv", "pos"]).select(
        "conv", "conv_id", "pos", "role", "text", F.posexplode(letters).alias("step", "op"))
    edit = F.substring("op", 1, 1)
    named = F.create_map(*[F.lit(x) for pair in ROLE_NAMES.items() for x in pair])
    role = F.when(F.length("op") == 2, named[F.substring("op", 2, 1)]).when(edit == "K", F.col("role"))
    text = F.when(edit == "I", "").when(edit != "D", F.col("text"))
    out = scratch.store(edited.select("conv", "conv_id", "pos", "step", edit.alias("edit"), role.alias("role"), text.alias("text")))

    names = rows.groupBy("conv").agg(F.first("conv_id").alias("conv_id"), F.max("turn").alias("__hi"), F.min("turn").alias("__lo"),
                                     F.count_distinct("turn").alias("__distinct"))
    gaps = F.coalesce(F.col("__hi") - F.col("__lo") + 1 - F.col("__distinct"), F.lit(0)).cast("long")
    kinds = facts.groupBy("conv").agg(*[F.count_if(F.col("fault") == k).alias(k) for k in ("blank", "duplicate", "truncated")])
    totals = ends.where("block = 0").select("conv", "illegal", "cost")
    summary = names.withColumn("gaps", gaps).join(kinds, "conv").join(totals, "conv").select(
        "conv", "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return out, summary


def digest(edits: DataFrame) -> DataFrame:
    """(conv, audit, repaired_sha256) of edits. The digest of a conversation is sequential by definition, so
    its rows stream through one task; only the audit, one letter an edit, is held."""
    rows = edits.repartition("conv").sortWithinPartitions("conv", "pos", "step").select("conv", "edit", "role", "text")
    return rows.mapInArrow(_digest, "conv string, audit string, repaired_sha256 string")


def damage(turns: DataFrame) -> DataFrame:
    """The damaged rows of the check: what happens to a row depends on the crc32 of its ``conv_id:turn``."""
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"), F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    rows = turns.select("conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"),
                        (F.crc32(key) % 20).alias("__kind"))
    kind = F.col("__kind")
    text = F.when(kind == 1, "").when(kind == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    copies = F.explode(F.sequence(F.lit(1), F.when(kind == 3, 2).otherwise(1))).alias("__copy")
    return rows.where(kind != 0).select("conv_id", "turn", F.when(kind == 4, "user").otherwise(F.col("role")).alias("role"),
                                        text.alias("text"), copies).drop("__copy")
