"""Substring deduplication with prefix-partitioned suffix trees.

Suffixes are split over tasks by a prefix, and each task builds the suffix tree over its group
in memory: prefix doubling sorts the suffixes and keeps the ranks of every step, which give the
longest common prefix of neighbours; intervals of neighbours with a common prefix are the tree's
internal nodes. Nodes at the depth of a window or more whose occurrences differ in the word
before are the maximal repeats; those met in several documents go from all but the first one.
Words are compared by themselves, not by hashes.

* Which suffixes: a window repeats only together with the smallest of its ``ANCHOR``-word
  grams (by hash, the first of equals), its anchor. So only anchors are counted over the
  corpus, and only anchors that occur in more than one document bring their suffixes, as one
  segment of text with the windows that have this anchor.
* The prefix is the anchor gram. A group larger than ``GROUP`` segments would not fit a task;
  its prefixes grow to whole windows, which are counted by a plain aggregation.
* Equal texts are one document here: their smallest doc_id stands for all.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanloom.llm.shingles import finish, using_words, word_hashes
from loanloom.llm.storage import BATCH_ROWS, Scratch

ANCHOR = 16
GROUP = 30_000
PACK = 6_000


def split(text: str | None) -> list[bytes]:
    return text.encode().split() if text else []


def _sliding(x: np.ndarray, width: int, best) -> np.ndarray:
    """Smallest (or largest) value of every run of ``width`` values, by doubling."""
    reach, out = 1, x
    while reach * 2 <= width:
        out = best(out[:-reach], out[reach:])
        reach *= 2
    return best(out[:len(x) - width + 1], out[width - reach:width - reach + len(x) - width + 1]) if reach < width else out


def doubled(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of ``size`` words, a power of two."""
    reach = 1
    with np.errstate(over="ignore"):
        while reach < size:
            hashes = finish(hashes[:-reach] * np.uint64(0x9E3779B97F4A7C15) + hashes[reach:]) if len(hashes) > reach else hashes[:0]
            reach *= 2
    return hashes


def anchors(words: list[bytes], window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchor hashes, and for each the first window and the number of windows that it anchors."""
    size = 1 << (min(ANCHOR, window).bit_length() - 1)
    hashes = doubled(word_hashes(words), size)
    width = window - size + 1
    if len(hashes) < width:
        return np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64)
    least = _sliding(hashes, width, np.minimum)
    # a gram is smallest in a window if the largest minimum over the windows around it is itself
    pad = np.zeros(width - 1, dtype=np.uint64)
    at = np.flatnonzero(_sliding(np.concatenate([pad, least, pad]), width, np.maximum) == hashes)
    which = np.searchsorted(at, np.arange(len(least)))
    while len(later := np.flatnonzero(hashes[at[which]] != least)):
        which[later] += 1
    first = np.flatnonzero(np.concatenate([[True], which[1:] != which[:-1]]))
    return hashes[at[which[first]]], first, np.diff(np.append(first, len(least)))


_SCAN = "doc_id bigint, n bigint, text_sha256 string, code bigint, hashes array<bigint>, places array<int>, windows array<int>"


def _code(words: list[bytes]) -> tuple[str, int]:
    """Digest of the words, and its first 64 bits, which with the doc_id name a row's text."""
    digest = hashlib.sha256(b" ".join(words))
    return digest.hexdigest(), int.from_bytes(digest.digest()[:8], "big", signed=True)


def _scan(docs: DataFrame, window: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        using_words()
        for batch in batches:
            ns, digests, codes, lists, ends = [], [], [], [], [0]
            for text in batch.column(1).to_pylist():
                words = split(text)
                ns.append(len(words))
                digest, code = _code(words)
                digests.append(digest)
                codes.append(code)
                found = anchors(words, window) if len(words) >= window else ()
                if found:
                    lists.append(found)
                ends.append(ends[-1] + (len(found[0]) if found else 0))
            offsets = pa.array(ends, pa.int32())
            flat = [np.concatenate([x[i] for x in lists]) if lists else np.empty(0, np.int64) for i in range(3)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(ns, pa.int64()), pa.array(digests, pa.string()), pa.array(codes, pa.int64()),
                 pa.ListArray.from_arrays(offsets, pa.array(flat[0].view(np.int64))),
                 *[pa.ListArray.from_arrays(offsets, pa.array(x.astype(np.int32))) for x in flat[1:]]],
                names=["doc_id", "n", "text_sha256", "code", "hashes", "places", "windows"])

    return docs.select("doc_id", "text").mapInArrow(run, _SCAN)


def _segments(suspects: DataFrame, window: int) -> DataFrame:
    """For each listed anchor of a document, the words of its windows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []

        def full() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()))],
                names=["hash", "doc_id", "code", "start", "segment"])
            rows.clear()
            return out

        for batch in batches:
            for doc, code, text, found in zip(*(c.to_pylist() for c in batch.columns)):
                words = split(text)
                for f in found:
                    rows.append((f["hash"], doc, code, f["place"], b" ".join(words[f["place"]:f["place"] + f["windows"] + window - 1])))
                    if len(rows) >= BATCH_ROWS:
                        yield full()
        if rows:
            yield full()

    return suspects.where(F.size("anchors") > 0).select("doc_id", "code", "text", "anchors").mapInArrow(
        run, "hash bigint, doc_id bigint, code bigint, start bigint, segment binary")


_COVER = "doc_id bigint, code bigint, start bigint, end bigint"


def suffix_tree(text: np.ndarray, longest: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes in order, and the length of each one's common prefix with the one before it.

    ``text`` holds word numbers; no two equal runs are longer than ``longest``, since every segment
    ends in a number of its own.
    """
    depth, ranks = 1, [np.unique(text, return_inverse=True)[1].astype(np.int32)]
    while depth <= longest:
        rank = ranks[-1].astype(np.int64)
        follow = np.zeros_like(rank)
        follow[:max(0, len(rank) - depth)] = rank[depth:] + 1
        ranks.append(np.unique(rank * (int(rank.max()) + 2) + follow, return_inverse=True)[1].astype(np.int32))
        depth *= 2
    order = np.argsort(ranks[-1], kind="stable")
    common = np.zeros(len(order), dtype=np.int64)
    live = np.arange(1, len(order))
    for step in reversed(range(len(ranks))):
        x, y = order[live - 1] + common[live], order[live] + common[live]
        inside = np.maximum(x, y) < len(text)
        same = live[inside][ranks[step][x[inside]] == ranks[step][y[inside]]]
        common[same] += 1 << step
    return order, common


def deep_nodes(order: np.ndarray, common: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Internal nodes at depth ``least`` or more, deepest first: depth, first leaf and the one after the last, counted
    in the leaves, which are the part of ``order`` below such nodes."""
    deep = common >= least
    leaf = deep | np.append(deep[1:], False)
    leaves, common = order[leaf], np.where(deep, common, 0)[leaf]
    depths, lows, highs = [], [], []
    for depth in np.unique(common[common > 0])[::-1]:
        low = np.flatnonzero(common < depth)
        high = np.append(low[1:], len(common))
        # an interval is a node of this depth if some neighbours in it agree in no more
        met = np.concatenate([[0], np.cumsum(common == depth)])
        node = met[high] > met[low]
        depths.append(np.full(int(node.sum()), depth))
        lows.append(low[node])
        highs.append(high[node])
    if not depths:
        none = np.empty(0, np.int64)
        return none, none, none, leaves
    return np.concatenate(depths), np.concatenate(lows), np.concatenate(highs), leaves


def maximal_repeats(text: np.ndarray, least: int, longest: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Deep nodes (as ``deep_nodes``) whose occurrences do not all follow the same word: no longer
    run repeats wherever they do. ``text`` begins with a number of its own."""
    depth, low, high, leaves = deep_nodes(*suffix_tree(text, longest), least)
    before = text[leaves - 1]
    change = np.concatenate([[0], np.cumsum(np.append(False, before[1:] != before[:-1]))]) if len(leaves) else np.zeros(1, np.int64)
    varied = change[high] > change[low + 1] if len(low) else np.empty(0, bool)
    return depth[varied], low[varied], high[varied], leaves


def _tree(rows: list[tuple], window: int) -> pa.RecordBatch:
    """Covered spans of one pack of segments (doc_id, code, start, segment)."""
    numbers: dict[bytes, int] = {}
    pieces = [np.array([numbers.setdefault(w, len(numbers)) for w in r[3].split()], dtype=np.int64) for r in rows]
    sizes = np.array([len(p) for p in pieces])
    base = np.cumsum(np.concatenate([[1], sizes[:-1] + 1]))
    text = np.empty(int(sizes.sum()) + len(rows) + 1, dtype=np.int64)
    text[0] = len(numbers) + len(rows)
    for i, (at, piece) in enumerate(zip(base.tolist(), pieces)):
        text[at:at + len(piece)], text[at + len(piece)] = piece, len(numbers) + i  # each segment ends in its own number
    del pieces
    docs = np.array([r[0] for r in rows], dtype=np.int64)
    depth, low, high, leaves = maximal_repeats(text, window, int(sizes.max(initial=0)))
    owner = np.searchsorted(base, leaves, side="right") - 1
    doc = docs[owner]
    reach = np.zeros(len(leaves), dtype=np.int64)
    for d in np.unique(depth)[::-1]:  # nodes of one depth share no leaf
        here = depth == d
        size = (high - low)[here]
        leaf = np.arange(size.sum()) + np.repeat(low[here] - np.cumsum(size) + size, size)
        first = np.repeat(np.minimum.reduceat(doc[leaf], np.cumsum(size) - size), size)
        later = leaf[(doc[leaf] > first) & (reach[leaf] == 0)]
        reach[later] = d
    start, end = leaves[reach > 0], (leaves + reach)[reach > 0]
    by = np.argsort(start)
    start, end = start[by], np.maximum.accumulate(end[by]) if len(by) else end
    # repeats of a segment that overlap or touch are one span; those of two never touch
    cut = np.flatnonzero(np.append(True, start[1:] > end[:-1])) if len(by) else by
    start, end = start[cut], end[np.append(cut[1:], len(end)) - 1] if len(by) else end
    mine = np.searchsorted(base, start, side="right") - 1
    offset = np.array([r[2] for r in rows], dtype=np.int64)[mine] - base[mine]
    codes = np.array([r[1] for r in rows], dtype=np.int64)
    return pa.RecordBatch.from_arrays(
        [pa.array(docs[mine]), pa.array(codes[mine]), pa.array(start + offset), pa.array(end + offset)], schema=_COVER_ARROW)


_COVER_ARROW = pa.schema([("doc_id", pa.int64()), ("code", pa.int64()), ("start", pa.int64()), ("end", pa.int64())])


def _covered_by_trees(segments: DataFrame, window: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        last = None
        for batch in batches:
            for key, *row in zip(*(c.to_pylist() for c in batch.columns)):
                if key != last and len(held) >= PACK:
                    yield _tree(held, window)
                    held = []
                held.append(tuple(row))
                last = key
        if held:
            yield _tree(held, window)

    return segments.repartition("hash").sortWithinPartitions("hash").mapInArrow(run, _COVER)


def _covered_by_windows(segments: DataFrame, window: int, scratch: Scratch) -> DataFrame:
    """For groups beyond GROUP: each window is its own prefix, and the smallest doc_id an aggregate."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc, code, start, segment in zip(*(c.to_pylist() for c in batch.columns)):
                words = segment.split()
                at = range(len(words) - window + 1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([xxhash.xxh3_128_digest(b" ".join(words[i:i + window])) for i in at], pa.binary()),
                     pa.array([doc] * len(at), pa.int64()), pa.array([code] * len(at), pa.int64()),
                     pa.array([start + i for i in at], pa.int64())], names=["prefix", "doc_id", "code", "start"])

    windows = scratch.store(segments.select("doc_id", "code", "start", "segment").mapInArrow(
        run, "prefix binary, doc_id bigint, code bigint, start bigint"))
    # stored apart, so that the join's own shuffle can split a window that very many documents share
    first = scratch.store(windows.groupBy("prefix").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).where(
        "first < last").select("prefix", "first"))
    return windows.join(first, "prefix").where("doc_id > first").select("doc_id", "code", "start", (F.col("start") + window).alias("end"))


def _kept(suspects: DataFrame, spans: DataFrame) -> DataFrame:
    """What partly covered documents keep."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            removed, digests, merged = [], [], []
            for text, found in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                words, out, at, mine = split(text), [], 0, []
                for s in sorted((f["start"], f["end"]) for f in found):
                    if mine and s[0] <= mine[-1][1]:
                        mine[-1] = (mine[-1][0], max(mine[-1][1], s[1]))
                    else:
                        mine.append(s)
                for s, e in mine:
                    out += words[at:s]
                    at = e
                out += words[at:]
                removed.append(len(words) - len(out))
                digests.append(hashlib.sha256(b" ".join(out)).hexdigest())
                merged.append([{"start": s, "end": e} for s, e in mine])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(removed, pa.int64()), pa.array(digests, pa.string()),
                 pa.array(merged, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))],
                names=["doc_id", "code", "cut", "cut_sha256", "cut_spans"])

    both = suspects.select("doc_id", "code", "text").join(spans, ["doc_id", "code"])
    return both.select("doc_id", "code", "text", "spans").mapInArrow(
        run, "doc_id bigint, code bigint, cut bigint, cut_sha256 string, cut_spans array<struct<start:bigint,end:bigint>>")


def remove_repeats(docs: DataFrame, scratch: Scratch, window: int = 50) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_words, n_removed, kept_sha256, and
    ``spans``, the merged word spans that go.

    A word goes if a window of ``window`` words covers it whose words also start in a document
    with a smaller doc_id. Null, empty and short texts keep everything. Rows without a doc_id
    keep everything and take nothing from others. Rows that share a doc_id are one document
    with several texts, none of which is earlier than the others.
    """
    scan = scratch.store(_scan(docs, window))
    reps = scratch.store(scan.where((F.col("n") >= window) & F.col("doc_id").isNotNull()).groupBy("text_sha256").agg(
        F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("copies")))
    alone = scan.join(reps.select("text_sha256", F.col("first").alias("doc_id")), ["text_sha256", "doc_id"], "left_semi").dropDuplicates(
        ["doc_id", "code"])
    places = scratch.store(alone.select("doc_id", "code", F.explode(F.arrays_zip("hashes", "places", "windows")).alias("a")).select(
        "doc_id", "code", F.col("a.hashes").alias("hash"), F.col("a.places").alias("place"), F.col("a.windows").alias("windows")))
    shared = scratch.store(places.groupBy("hash").agg(
        F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"), F.count(F.lit(1)).alias("members")).where("lo < hi"))
    wanted = places.join(shared.select("hash", "members"), "hash").groupBy("doc_id", "code").agg(
        F.collect_list(F.struct("hash", "members", "place", "windows")).alias("anchors"))
    # a row's own text is known by its code, should rows share a doc_id
    normal = F.sha2(F.trim(F.regexp_replace("text", r"[\x20\x09-\x0D]+", " ")), 256)
    code = F.conv(F.substring(normal, 1, 16), 16, -10).cast("bigint")
    several = scan.groupBy("doc_id").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1").select("doc_id", F.lit(True).alias("several"))
    suspects = docs.select("doc_id", "text").join(wanted.join(several, "doc_id", "left"), "doc_id")
    suspects = suspects.where(F.col("several").isNull() | (code == F.col("code"))).select("doc_id", "code", "text", "anchors", "several")
    suspects = scratch.store(suspects)
    scratch.drop(places)
    # rows that repeat a doc_id and its text would come twice
    once = suspects.where("several IS NULL").unionByName(suspects.where("several").dropDuplicates(["doc_id", "code"]))

    def some(test) -> DataFrame:
        return _segments(once.withColumn("anchors", F.filter("anchors", lambda a: test(a["members"]))), window)

    covered = _covered_by_trees(some(lambda m: m <= GROUP), window)
    if shared.where(F.col("members") > GROUP).limit(1).count():
        covered = covered.union(_covered_by_windows(some(lambda m: m > GROUP), window, scratch))
    suspects = once
    spans = covered.groupBy("doc_id", "code").agg(F.collect_list(F.struct("start", "end")).alias("spans"))
    kept = scratch.store(_kept(suspects, spans))

    whole = F.col("first") < F.col("doc_id")
    nothing = F.array().cast("array<struct<start:bigint,end:bigint>>")
    everything = F.array(F.struct(F.lit(0).cast("bigint").alias("start"), F.col("n").alias("end")))
    out = scan.select("doc_id", "n", "text_sha256", "code").join(reps.select("text_sha256", "first"), "text_sha256", "left").join(
        kept, ["doc_id", "code"], "left")
    return out.select(
        "doc_id", F.col("n").alias("n_words"),
        F.when(whole, F.col("n")).otherwise(F.coalesce("cut", F.lit(0))).cast("bigint").alias("n_removed"),
        F.when(whole, F.sha2(F.lit(""), 256)).otherwise(F.coalesce("cut_sha256", "text_sha256")).alias("kept_sha256"),
        F.when(whole, everything).otherwise(F.coalesce("cut_spans", nothing)).alias("spans"))
