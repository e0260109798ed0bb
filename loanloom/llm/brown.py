"""Language-model scoring with Brown classes.

Words are put into ``CLASSES`` classes by exchange clustering: a word moves to the class that raises the
likelihood of the class bigrams most. A text's probability is the product of class transitions (trigrams,
interpolated with bigrams and unigrams by Witten-Bell) and of word emissions.

Jobs. Documents become blocks of token numbers with a dictionary of their own, so that later passes are
array work: the blocks are shuffled once, to meet their dictionaries' counts, and then only neighbour counts. Words are numbered by falling count; words met once, and
words never met in training, are the open class, texts end with a word of a class of its own. The
exchange runs over words met ``EXCHANGE_COUNT`` times or more, in groups of words: all groups start from
the same class bigrams, a group moves its words one after the other on its own copy, and the bigrams are
counted anew after each round (distributed exchange clustering). Less frequent words then take the class
of the highest likelihood once. A word's neighbour classes are summed from block to group in steps of
``MERGE`` blocks, so no group grows with the corpus.
"""

from __future__ import annotations

import math
from array import array
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanloom.llm.caches import using
from loanloom.llm.storage import Scratch
from loanloom.operators.ordered import with_positions

CLASSES = 64
OPEN, STOP, FREE = 0, 1, 2  # the open class, the class of the text's end, the first class of all others
EXCHANGE_COUNT = 10
TOLERANCE = 1e-3  # the exchange ends with a round that raises the likelihood by less than this share of its mutual information
MOST_ROUNDS = 20
BLOCK_TOKENS = 1 << 21
GROUP_TOKENS = 1 << 21  # training tokens a group of words has on average
MERGE = 256
BATCH_WORDS = 256  # words of a group that move at once, at most
TABLE_WORDS = 1 << 24  # most frequent words whose class every task holds, one byte each; others are joined
LARGE_ROWS = 2  # rows of an Arrow batch of blocks

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
BLOCKS = "block bigint, doc_ids array<bigint>, held array<boolean>, ends binary, tokens binary, words array<binary>, counts array<bigint>"
_BLOCKS = pa.schema([("block", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("held", pa.list_(pa.bool_())), ("ends", pa.binary()),
                     ("tokens", pa.binary()), ("words", pa.list_(pa.binary())), ("counts", pa.list_(pa.int64()))])
CELLS = "group bigint, slice bigint, words binary, kinds binary, ns binary"
_CELLS = pa.schema([("group", pa.int64()), ("slice", pa.int64()), ("words", pa.binary()), ("kinds", pa.binary()), ("ns", pa.binary())])
_MOVES = pa.schema([("gid", pa.int64()), ("class", pa.int64())])
_SCORES = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()),
                     ("base_score", pa.float64()), ("score", pa.float64())])


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


class few_rows:
    """Within it, Arrow batches hold few rows: a block is a row of several MB."""

    def __init__(self, spark, rows: int = LARGE_ROWS):
        self.conf, self.rows = spark.conf, rows

    def __enter__(self) -> None:
        self.before = self.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
        self.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(self.rows))

    def __exit__(self, *_) -> None:
        self.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", self.before)


# -- blocks -----------------------------------------------------------------

def _cut_blocks(limit: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        using()
        seq = TaskContext.get().partitionId() << 33

        def start():
            number = defaultdict(int)
            number.default_factory = number.__len__
            number[b""]  # the end of a text; no word is empty
            return number, array("i"), [], [], array("q")

        def block() -> pa.RecordBatch:
            ids = np.frombuffer(tokens, np.int32)
            train = np.repeat(~np.array(held), np.diff(ends, prepend=0))
            counts = np.bincount(ids[train], minlength=len(number))
            return _batch([(seq, doc_ids, held, ends.tobytes(), tokens.tobytes(), list(number), counts)], _BLOCKS)

        number, tokens, doc_ids, held, ends = start()
        for batch in batches:
            for doc, out, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                tokens.extend(map(number.__getitem__, (text.as_py() or b"").translate(_LOWER).split()))
                tokens.append(0)
                doc_ids.append(doc)
                held.append(bool(out))
                ends.append(len(tokens))
                if len(tokens) >= limit:
                    yield block()
                    seq += 1
                    number, tokens, doc_ids, held, ends = start()
        if doc_ids:
            yield block()

    return run


@dataclass
class Corpus:
    """Coded blocks (block, doc_ids, held, ends, tokens, cs, gids), the words and their totals."""

    blocks: DataFrame
    n_blocks: int
    train_tokens: int
    types: int
    numbered: int  # gids run from 2 to this, without it
    exchanged: int  # those below it were met EXCHANGE_COUNT times or more


def encode(docs: DataFrame, held_out: Column, scratch: Scratch) -> Corpus:
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), held_out.alias("held"), F.col("text").cast("string").cast("binary").alias("text"))
    raw = scratch.store(rows.mapInArrow(_cut_blocks(BLOCK_TOKENS), BLOCKS))
    zipped = F.posexplode(F.arrays_zip("words", "counts")).alias("pos", "w")
    entries = raw.select("block", zipped).select("block", "pos", F.col("w.words").alias("word"), F.col("w.counts").alias("n"))
    words = scratch.store(entries.groupBy("word").agg(F.sum("n").alias("c")).where("c > 0"))
    n, types = words.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first()
    frequent = words.where((F.col("c") > 1) & (F.length("word") > 0))
    gids = with_positions(frequent, [F.desc("c"), F.asc("word")]).select("word", "c", (F.col("__pos") + FREE).alias("gid"))
    rare = words.where((F.col("c") == 1) & (F.length("word") > 0)).select("word", "c", F.lit(OPEN).cast("long").alias("gid"))
    end = words.where(F.length("word") == 0).select("word", "c", F.lit(STOP).cast("long").alias("gid"))
    vocabulary = scratch.store(gids.unionByName(rare).unionByName(end))
    numbered, exchanged = vocabulary.where(F.col("gid") >= FREE).agg(F.count(F.lit(1)), F.count_if(F.col("c") >= EXCHANGE_COUNT)).first()
    scratch.drop(words)
    # every block's dictionary with counts and numbers; words never met in training have neither
    known = entries.join(vocabulary, "word", "left").select(
        "block", F.struct("pos", F.coalesce("c", F.lit(0)).alias("c"),
                          F.when(F.length("word") == 0, STOP).otherwise(F.coalesce("gid", F.lit(OPEN))).alias("gid")).alias("w"))
    lists = known.groupBy("block").agg(F.sort_array(F.collect_list("w")).alias("w")).select("block", F.col("w.c").alias("cs"), F.col("w.gid").alias("gids"))
    blocks = scratch.store(raw.drop("words", "counts").join(lists, "block"))
    scratch.drop(raw)
    scratch.drop(vocabulary)
    return Corpus(blocks, blocks.count(), n, types, numbered + FREE, exchanged + FREE)


# -- classes ----------------------------------------------------------------

@dataclass
class Classes:
    """Class of every numbered word: ``table`` for the first ones, ``moved`` (gid, class) for those beyond it
    that are not where they began."""

    table: np.ndarray
    moved: DataFrame | None
    exchanged: int

    def with_moved(self, blocks: DataFrame) -> DataFrame:
        if self.moved is None:
            return blocks.withColumn("moved", F.lit(None).cast("array<struct<gid:bigint,class:bigint>>"))
        asked = blocks.select("block", F.explode("gids").alias("gid")).where(F.col("gid") >= len(self.table))
        found = asked.join(self.moved, "gid").groupBy("block").agg(F.sort_array(F.collect_set(F.struct("gid", "class"))).alias("moved"))
        return blocks.join(found, "block", "left")


def first_class(gid: np.ndarray, exchanged: int) -> np.ndarray:
    """Words of the exchange are dealt by falling count, one class after the other; the rest is open."""
    dealt = np.where(gid < exchanged, FREE + (gid - FREE) % (CLASSES - FREE), OPEN)
    return np.where(gid < FREE, gid, dealt).astype(np.uint8)


def _classes(gids: np.ndarray, table: np.ndarray, exchanged: int, moved: list | None) -> np.ndarray:
    out = first_class(gids, exchanged)
    inside = gids < len(table)
    out[inside] = table[gids[inside]]
    if moved:
        where = {m["gid"]: m["class"] for m in moved}
        for i in np.flatnonzero(~inside).tolist():
            out[i] = where.get(int(gids[i]), out[i])
    return out


def _pairs(batch: pa.RecordBatch, row: int) -> tuple[np.ndarray, np.ndarray]:
    """Token numbers of a block and which of them are trained on."""
    col = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
    tokens = np.frombuffer(col["tokens"][row].as_py(), np.int32)
    lengths = np.diff(np.frombuffer(col["ends"][row].as_py(), np.int64), prepend=0)
    return tokens, np.repeat(~np.array(col["held"][row].as_py(), dtype=bool), lengths)


def _gids(batch: pa.RecordBatch, row: int) -> np.ndarray:
    values = batch.column(batch.schema.names.index("gids"))
    return np.asarray(values[row].values, dtype=np.int64)


def _count_cells(shared: Broadcast, lo: int, hi: int, groups: int):
    """Per block: class bigrams (group -1), and neighbour classes of the words lo <= gid < hi by group.

    A cell's kind is the class to the left, CLASSES + the class to the right, or 2 * CLASSES for a word
    beside itself.
    """
    width = 2 * CLASSES + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        using()
        table, exchanged = shared.value
        for batch in batches:
            names = batch.schema.names
            for row in range(len(batch)):
                gids = _gids(batch, row)
                moved = batch.column(names.index("moved"))[row].as_py()
                classes = _classes(gids, table, exchanged, moved).astype(np.int64)
                tokens, train = _pairs(batch, row)
                before = np.concatenate([[0], tokens[:-1]]).astype(np.int64)[train]
                here = tokens[train].astype(np.int64)
                slice_ = batch.column(names.index("block"))[row].as_py()
                bigrams = np.bincount(classes[before] * CLASSES + classes[here], minlength=CLASSES * CLASSES)
                out = [(-1, slice_, b"", b"", bigrams.astype(np.int64).tobytes())]
                asked = np.flatnonzero((gids >= lo) & (gids < hi))
                asked = asked[np.argsort(gids[asked] % groups, kind="stable")]
                place = np.full(len(gids), -1, dtype=np.int64)
                place[asked] = np.arange(len(asked))
                cells = []
                for word, kind in ((place[here], classes[before]), (place[before], CLASSES + classes[here]),
                                   (np.where(here == before, place[here], -1), np.full(len(here), 2 * CLASSES))):
                    met = word >= 0
                    cells.append(word[met] * width + kind[met])
                keys, ns = np.unique(np.concatenate(cells), return_counts=True)
                words = gids[asked][keys // width]
                cuts = np.searchsorted(words % groups, np.arange(groups + 1))
                for g, (a, b) in enumerate(zip(cuts, cuts[1:])):
                    if b > a:
                        out.append((g, slice_, (words[a:b] // groups).astype(np.uint32).tobytes(), (keys[a:b] % width).astype(np.uint8).tobytes(),
                                    _narrow(ns[a:b])))
                yield _batch(out, _CELLS)

    return run


def _narrow(ns: np.ndarray) -> bytes:
    """Counts in the fewest bytes that hold the largest; the reader tells the width from the length."""
    return ns.astype(np.min_scalar_type(int(ns.max(initial=0)))).tobytes()


def _wide(ns: list[bytes], kinds: list[bytes]) -> np.ndarray:
    return np.concatenate([np.frombuffer(n, f"u{len(n) // len(k)}").astype(np.int64) for n, k in zip(ns, kinds) if len(k)] or [np.empty(0, np.int64)])


def _added(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Cells of one group, equal ones summed: word * (2 * CLASSES + 1) + kind, and counts."""
    words, kinds, ns = (table.column(c).to_pylist() for c in ("words", "kinds", "ns"))
    keys = np.frombuffer(b"".join(words), np.uint32).astype(np.int64) * (2 * CLASSES + 1) + np.frombuffer(b"".join(kinds), np.uint8)
    order = np.argsort(keys, kind="stable")
    keys, ns = keys[order], _wide(ns, kinds)[order]
    heads = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.array([], dtype=np.int64)
    return keys[heads], np.add.reduceat(ns, heads) if len(heads) else ns


def _merge(key: tuple, table: pa.Table) -> pa.Table:
    using()
    group, slice_ = (k.as_py() for k in key)
    if group < 0:
        total = sum(np.frombuffer(b, np.int64) for b in table.column("ns").to_pylist())
        return pa.Table.from_batches([_batch([(group, slice_, b"", b"", total.tobytes())], _CELLS)])
    keys, ns = _added(table)
    width = 2 * CLASSES + 1
    row = (group, slice_, (keys // width).astype(np.uint32).tobytes(), (keys % width).astype(np.uint8).tobytes(), _narrow(ns))
    return pa.Table.from_batches([_batch([row], _CELLS)])


def _xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1.0))


def information(bigrams: np.ndarray) -> float:
    """The part of the log likelihood that depends on the classes: total times mutual information, from raw counts."""
    return float(_xlogx(bigrams).sum() - _xlogx(bigrams.sum(0)).sum() - _xlogx(bigrams.sum(1)).sum())


class Exchange:
    """Moves words between the free classes on one copy of the class bigrams."""

    def __init__(self, bigrams: np.ndarray):
        self.n = bigrams.astype(float)
        self.rows, self.columns = self.n.sum(1), self.n.sum(0)

    def gains(self, left: np.ndarray, right: np.ndarray, own: np.ndarray, now: np.ndarray) -> np.ndarray:
        """For each of some words, what putting it into each class adds once it is taken out of its class ``now``.

        ``left`` and ``right`` hold the neighbours of each word by class, without the word itself, ``own`` how
        often it stands beside itself. Words see each other where they are.
        """
        at, d = np.arange(len(now)), np.arange(CLASSES)
        total = np.zeros((len(now), CLASSES))
        for beside, other, grid in ((left, right, self.n), (right, left, self.n.T)):
            word, c = np.nonzero(beside)
            if not len(word):
                continue
            count, home = beside[word, c], now[word]
            base = grid[c]  # bigrams of the neighbours' class with every class, the word taken out
            cell = np.arange(len(word))
            base[cell, home] -= count
            same = np.flatnonzero(c == home)
            base[same] -= other[word[same]]
            base[same, home[same]] -= own[word[same]]
            added = _xlogx(base + count[:, None]) - _xlogx(base)
            added[cell, c] = 0.0  # the diagonal comes below
            heads = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
            total[word[heads]] += np.add.reduceat(added, heads)
        # on the diagonal both sides and the word itself meet in one cell
        both = left + right + own[:, None]
        base = np.broadcast_to(self.n[d, d], total.shape).copy()
        base[at, now] -= both[at, now]
        total += _xlogx(base + both) - _xlogx(base)
        for margin, beside in ((self.rows, right), (self.columns, left)):
            size = beside.sum(1) + own
            base = np.broadcast_to(margin, total.shape).copy()
            base[at, now] -= size
            total -= _xlogx(base + size[:, None]) - _xlogx(base)
        return total

    def move(self, left: np.ndarray, right: np.ndarray, own: np.ndarray, now: np.ndarray) -> np.ndarray:
        """Put each word into its best free class (ties: where it was, else the smallest), all of them at once.
        ``left`` and ``right`` count a word beside itself as a neighbour of its class."""
        at = np.arange(len(now))
        left, right = left.astype(float), right.astype(float)
        left[at, now] -= own
        right[at, now] -= own
        gains = self.gains(left, right, own, now)
        best = FREE + gains[:, FREE:].argmax(1)
        stays = gains[at, now]
        best = np.where(gains[at, best] <= stays + 1e-9 * np.maximum(1.0, np.abs(stays)), now, best)
        for i in np.flatnonzero(best != now).tolist():
            for c, sign in ((now[i], -1.0), (best[i], 1.0)):
                self.n[:, c] += sign * left[i]
                self.n[c, :] += sign * right[i]
                self.n[c, c] += sign * own[i]
                self.rows[c] += sign * (right[i].sum() + own[i])
                self.columns[c] += sign * (left[i].sum() + own[i])
        return best


def _words_of(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    width = 2 * CLASSES + 1
    words, heads = np.unique(keys // width, return_index=True)
    return words, heads, np.append(heads[1:], len(keys))


def _exchange(shared: Broadcast, bigrams: np.ndarray, groups: int):
    """One round over a group's words, most frequent first, the first ones one by one and then in small batches."""
    width = 2 * CLASSES + 1

    def run(key: tuple, table: pa.Table) -> pa.Table:
        using()
        group = key[0].as_py()
        classes, exchanged = shared.value
        moved = dict(zip(*(table.column("moved").combine_chunks()[0].as_py() or ([], [])))) if "moved" in table.column_names else {}
        keys, ns = _added(table)
        words, heads, tails = _words_of(keys)
        gids = words * groups + group
        now = _classes(gids, classes, exchanged, [{"gid": g, "class": c} for g, c in moved.items()])
        state, out, at = Exchange(bigrams), [], 0
        while at < len(words):  # gids fall by count; the rarer the words, the more move at once
            to = min(len(words), at + 1 + min(at // 32, BATCH_WORDS))
            a, b = heads[at], tails[to - 1]
            counts = np.zeros((to - at, width))
            counts[np.repeat(np.arange(to - at), (tails - heads)[at:to]), keys[a:b] % width] = ns[a:b]
            best = state.move(counts[:, :CLASSES], counts[:, CLASSES:-1], counts[:, -1], now[at:to].astype(np.int64))
            moved_words = np.flatnonzero(best != now[at:to])
            out += zip(gids[at:to][moved_words].tolist(), best[moved_words].tolist())
            at = to
        return pa.Table.from_batches([_batch(out, _MOVES)] if out else [], schema=_MOVES)

    return run


def _place(bigrams: np.ndarray, groups: int, chunk: int = 1 << 15):
    """The likeliest class of each of a group's words while all others stay."""
    width = 2 * CLASSES + 1
    smooth = np.log(bigrams + 1.0)
    margins = np.log(bigrams.sum(0) + CLASSES) + np.log(bigrams.sum(1) + CLASSES)
    per_kind = np.zeros((width, CLASSES))
    per_kind[:CLASSES], per_kind[CLASSES:-1] = smooth, smooth.T
    per_kind[:CLASSES] -= margins  # a word has as many left neighbours as occurrences

    def run(key: tuple, table: pa.Table) -> pa.Table:
        using()
        group = key[0].as_py()
        keys, ns = _added(table)
        words, heads, tails = _words_of(keys)
        batches = []
        at = 0
        while at < len(words):
            to = max(at + 1, int(np.searchsorted(tails, heads[at] + chunk)))
            a, b = heads[at], tails[to - 1]
            votes = np.add.reduceat(ns[a:b, None] * per_kind[keys[a:b] % width], heads[at:to] - a)
            best = FREE + votes[:, FREE:].argmax(1)
            batches.append(pa.RecordBatch.from_arrays([pa.array(words[at:to] * groups + group), pa.array(best.astype(np.int64))], schema=_MOVES))
            at = to
        return pa.Table.from_batches(batches, schema=_MOVES)

    return run


def _gather(corpus: Corpus, classes: Classes, lo: int, hi: int, scratch: Scratch) -> tuple[DataFrame, np.ndarray, int]:
    """Cells by group of the words lo <= gid < hi (group -1: class bigrams), all class bigrams, and the number of groups."""
    spark = corpus.blocks.sparkSession
    groups = max(1, math.ceil(corpus.train_tokens / GROUP_TOKENS))
    shared = spark.sparkContext.broadcast((classes.table, classes.exchanged))
    with few_rows(spark):
        counted = classes.with_moved(corpus.blocks).select("block", "held", "ends", "tokens", "gids", "moved")
        cells = scratch.store(counted.mapInArrow(_count_cells(shared, lo, hi, groups), CELLS))
    shared.unpersist()
    slices = corpus.n_blocks
    while True:  # equal cells of up to MERGE slices become one; the last step leaves MERGE slices at most
        parts = math.ceil(slices / MERGE)
        bigrams = cells.where("group < 0")
        if parts > 1:
            cells = scratch.store(cells.withColumn("slice", F.pmod(F.xxhash64("slice"), F.lit(parts))).groupBy("group", "slice").applyInArrow(_merge, CELLS))
            slices = parts
            continue
        total = np.zeros(CLASSES * CLASSES, dtype=np.int64)
        for r in bigrams.select("ns").toLocalIterator():  # at most MERGE rows on average
            total += np.frombuffer(r.ns, np.int64)
        return cells, total.reshape(CLASSES, CLASSES).astype(float), groups


def _apply(classes: Classes, moves: DataFrame, scratch: Scratch) -> Classes:
    """The classes after ``moves`` (gid, class)."""
    table = classes.table.copy()
    limit = len(table)
    near = moves.where(F.col("gid") < limit).toArrow()  # at most one row a word of the table
    table[near.column("gid").to_numpy()] = near.column("class").to_numpy()
    far = moves.where(F.col("gid") >= limit)
    if classes.moved is not None:
        far = far.unionByName(classes.moved.join(far, "gid", "left_anti"))
    moved = scratch.store(far)
    return Classes(table, None if moved.isEmpty() else moved, classes.exchanged)


def cluster(corpus: Corpus, scratch: Scratch, classes_limit: int | None = None) -> tuple[Classes, list[float]]:
    """Classes of all numbered words, and the information at the start of each round."""
    limit = TABLE_WORDS if classes_limit is None else classes_limit
    start = np.arange(max(FREE, min(corpus.numbered, limit)), dtype=np.int64)
    classes = Classes(first_class(start, corpus.exchanged), None, corpus.exchanged)
    path: list[float] = []
    best = classes
    spark = corpus.blocks.sparkSession
    while corpus.exchanged > FREE:
        cells, bigrams, groups = _gather(corpus, classes, FREE, corpus.exchanged, scratch)
        path.append(information(bigrams))
        total = _xlogx(np.array([bigrams.sum()])).sum()
        if len(path) > 1 and path[-1] - path[-2] <= TOLERANCE * abs(path[-2] + total):
            classes = classes if path[-1] > path[-2] else best
            break
        if len(path) > MOST_ROUNDS:
            break
        best = classes
        shared = spark.sparkContext.broadcast((classes.table, classes.exchanged))
        grouped = cells.where("group >= 0")
        if classes.moved is not None:
            own = classes.moved.withColumn("group", F.pmod("gid", F.lit(groups))).groupBy("group").agg(
                F.array(F.collect_list("gid"), F.collect_list("class")).alias("moved"))
            grouped = grouped.join(own, "group", "left")
        with few_rows(spark, 64):
            moves = scratch.store(grouped.groupBy("group").applyInArrow(_exchange(shared, bigrams, groups), "gid bigint, class bigint"))
        classes = _apply(classes, moves, scratch)
        shared.unpersist()
        scratch.drop(cells)
    if corpus.numbered > corpus.exchanged:
        cells, bigrams, groups = _gather(corpus, classes, corpus.exchanged, corpus.numbered, scratch)
        with few_rows(spark, 64):
            moves = scratch.store(cells.where("group >= 0").groupBy("group").applyInArrow(_place(bigrams, groups), "gid bigint, class bigint"))
        classes = _apply(classes, moves, scratch)
        scratch.drop(cells)
    return classes, path


# -- model and scores -------------------------------------------------------

@dataclass
class Model:
    """Class transitions given two classes, class counts, and what open words need."""

    transitions: np.ndarray
    class_tokens: np.ndarray
    open_types: int
    train_tokens: int
    types: int

    def emissions(self, classes: np.ndarray, cs: np.ndarray) -> np.ndarray:
        """Probability of each word in its class: its share of the class. Open words are met once or never; each
        known one counts twice, and all words never met share the place of one more met once."""
        known = cs / np.maximum(self.class_tokens[classes], 1)
        opened = (cs + 1) / (self.class_tokens[OPEN] + self.open_types + 1)
        return np.where(classes == OPEN, opened, np.where(classes == STOP, 1.0, known))


def witten_bell(counts: np.ndarray) -> np.ndarray:
    """Transitions from trigram counts, interpolated with bigrams, these with unigrams. Classes without a word get nothing."""
    def mix(n: np.ndarray, lower: np.ndarray) -> np.ndarray:
        kinds = (n > 0).sum(-1, keepdims=True)
        return (n + kinds * lower) / np.maximum(n.sum(-1, keepdims=True) + kinds, 1) + (kinds == 0) * lower

    single = counts.sum((0, 1))
    used = single > 0
    used[[OPEN, STOP]] = True
    base = (single + used) / (single.sum() + used.sum())
    pairs = mix(counts.sum(0), np.broadcast_to(base, (CLASSES, CLASSES)))
    return mix(counts, np.broadcast_to(pairs, (CLASSES, CLASSES, CLASSES)))


def _contexts(tokens: np.ndarray, lengths: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """Number of each token's class trigram; before a text stand two ends."""
    c = classes[tokens].astype(np.int64)
    one = np.concatenate([[STOP], c[:-1]])
    two = np.concatenate([[STOP], one[:-1]])
    two[np.cumsum(lengths) - lengths] = STOP
    return (two * CLASSES + one) * CLASSES + c


def _count_trigrams(shared: Broadcast):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        using()
        table, exchanged = shared.value
        total = np.zeros(CLASSES ** 3, dtype=np.int64)
        for batch in batches:
            names = batch.schema.names
            for row in range(len(batch)):
                classes = _classes(_gids(batch, row), table, exchanged, batch.column(names.index("moved"))[row].as_py())
                tokens, train = _pairs(batch, row)
                lengths = np.diff(np.frombuffer(batch.column(names.index("ends"))[row].as_py(), np.int64), prepend=0)
                total += np.bincount(_contexts(tokens, lengths, classes)[train], minlength=len(total))
        keys = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(total[keys])], names=["key", "n"])

    return run


def _score_blocks(shared: Broadcast):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        using()
        table, exchanged, model = shared.value
        steps = np.log10(model.transitions).reshape(-1)
        for batch in batches:
            names = batch.schema.names
            for row in range(len(batch)):
                col = {n: batch.column(i)[row] for i, n in enumerate(names)}
                cs = np.asarray(col["cs"].values, dtype=np.int64)
                classes = _classes(_gids(batch, row), table, exchanged, col["moved"].as_py())
                tokens = np.frombuffer(col["tokens"].as_py(), np.int32)
                ends = np.frombuffer(col["ends"].as_py(), np.int64)
                lengths = np.diff(ends, prepend=0)
                starts = ends - lengths
                base = np.log10((cs + 1) / (model.train_tokens + model.types + 1))
                # the end of texts may be unknown to the training; it stands in no emission
                own = np.log10(np.maximum(model.emissions(classes, cs), 1e-300))
                score = steps[_contexts(tokens, lengths, classes)] + own[tokens]
                columns = [col["doc_ids"].values, col["held"].values, lengths, np.add.reduceat((cs > 0).astype(np.int64)[tokens], starts),
                           np.add.reduceat(base[tokens], starts), np.add.reduceat(score, starts)]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _SCORES)], schema=_SCORES)

    return run


def fit(corpus: Corpus, classes: Classes) -> Model:
    spark = corpus.blocks.sparkSession
    shared = spark.sparkContext.broadcast((classes.table, classes.exchanged))
    with few_rows(spark):
        parts = classes.with_moved(corpus.blocks).select("block", "held", "ends", "tokens", "gids", "moved").mapInArrow(_count_trigrams(shared), "key bigint, n bigint")
        found = parts.groupBy("key").agg(F.sum("n").alias("n")).toArrow()  # at most CLASSES ** 3 rows
    shared.unpersist()
    counts = np.zeros(CLASSES ** 3)
    counts[found.column("key").to_numpy()] = found.column("n").to_numpy()
    counts = counts.reshape((CLASSES,) * 3)
    open_types = corpus.types - (corpus.numbered - FREE) - (corpus.train_tokens > 0)
    return Model(witten_bell(counts), counts.sum((0, 1)), open_types, corpus.train_tokens, corpus.types)


def score(docs: DataFrame, held_out: Column, scratch: Scratch, classes_limit: int | None = None) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row of ``docs`` (doc_id, text).

    Rows with ``held_out`` (null: false) teach nothing. A text is its words in small letters (A-Z only) and
    one end; a null or empty text is an end alone. Scores are log10 probabilities: ``base_score`` of words by
    themselves with one added to every count, ``score`` of the class model. The model spreads probability 1
    over all known words, the end and one place for all unknown words. Repeated rows and null ids are
    scored as rows of their own; further columns are ignored; without rows to learn from every word is unknown.
    """
    spark = docs.sparkSession
    corpus = encode(docs, F.coalesce(held_out, F.lit(False)), scratch)
    classes, _ = cluster(corpus, scratch, classes_limit)
    model = fit(corpus, classes)
    shared = spark.sparkContext.broadcast((classes.table, classes.exchanged, model))
    with few_rows(spark):
        rows = classes.with_moved(corpus.blocks).select("doc_ids", "held", "ends", "tokens", "cs", "gids", "moved")
        scored = scratch.store(rows.mapInArrow(_score_blocks(shared), "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, base_score double, score double"))
    shared.unpersist()
    return scored.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(corpus.train_tokens).cast("long").alias("train_tokens"), "base_score", "score")
