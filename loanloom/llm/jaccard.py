"""Size-aware heavy-light Jaccard join over word shingles, as classes and linked components.

Texts with equal shingle sets form a class, represented by its smallest doc_id; only
representatives go on. Sizes up to a boundary are light, the others heavy.

* Light sets: two sets of sizes s and l link exactly if they share c(s, l) elements, so each
  light set lists all its subsets of every size c that a partner may need. Members of a subset
  link to its smallest member; by the sizes that loses no connection.
* Heavy sets scan inverted lists: elements in one global order (rare first), and only the
  prefix that every partner must meet. In a list a set is paired with the list's first set and
  with its ``NEAR`` predecessors; pairs are then counted exactly. Lists with more members than
  that are *long*: if exact links have not already connected all of a long list's members, its
  members are compared block against block, so no link is lost.
* Before sets travel to be counted, parity bitmaps (2 bits an element) do: the bits in which two
  differ are at most the elements in which the sets differ, so most other pairs end there.
* The boundary is the largest size up to which listing subsets costs fewer rows than the
  prefix rows and list scans it replaces, both counted over all small sets. Light sets that a
  heavy one could link to have prefix rows as well.

The global order uses a fixed-size table of shingle counts over the whole corpus. Any order
gives the same result; this one keeps common shingles out of the prefixes.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanloom.llm.components import components, extend
from loanloom.llm.shingles import finish, shingle_set, using_words
from loanloom.llm.sieve import sieve
from loanloom.llm.storage import Scratch

COUNTERS = 1 << 18
SMALL = 64  # the boundary is looked for up to this size
NEAR = 8
LIST_ROWS = 100_000  # members of a list that one task reads
BLOCK_SETS, BLOCK_ELEMENTS = 1024, 500_000
STRIP = 256  # rows of a block's table that are worked on at a time


class Threshold:
    """Jaccard >= num / den in integers."""

    def __init__(self, num: int, den: int):
        self.num, self.den = num, den

    def overlap(self, s, l):  # noqa: E741
        """Common elements that sizes s and l need."""
        return -(-self.num * (s + l) // (self.num + self.den))

    def shortest(self, s):
        return -(-self.num * s // self.den)

    def longest(self, s):
        return self.den * s // self.num

    def prefix(self, s):
        return s - self.shortest(s) + 1

    def subset_sizes(self, s: int) -> list[int]:
        return sorted({c for l in range(self.shortest(s), self.longest(s) + 1)  # noqa: E741
                       if (c := self.overlap(s, l)) <= min(s, l)})

    def subsets(self, s: int) -> int:
        return sum(comb(s, c) for c in self.subset_sizes(s))

    def linked(self, inter, s, l):  # noqa: E741
        return self.den * inter >= self.num * (s + l - inter)


# -- scan 1: sizes, classes, counts -----------------------------------------

_SCAN = "doc_id bigint, n bigint, class string, small array<bigint>, counts binary"


def _scan(docs: DataFrame, size: int) -> DataFrame:
    def slots(sets: list[np.ndarray]) -> np.ndarray:
        every = np.concatenate(sets) if sets else np.empty(0, np.uint64)
        return np.bincount((every & np.uint64(COUNTERS - 1)).astype(np.int64), minlength=COUNTERS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        using_words()
        counts = np.zeros(COUNTERS, dtype=np.int64)
        types = [pa.int64(), pa.int64(), pa.string(), pa.list_(pa.int64()), pa.binary()]
        names = ["doc_id", "n", "class", "small", "counts"]
        for batch in batches:
            ns, classes, small, every, held = [], [], [], [], 0
            for text in batch.column(1).to_pylist():
                s = shingle_set(text, size)
                ns.append(len(s))
                classes.append(xxhash.xxh3_128_hexdigest(s.tobytes()) if len(s) else None)
                small.append(s.view(np.int64).tolist() if 0 < len(s) <= SMALL else None)
                every.append(s)
                held += len(s)
                if held > 1 << 20:
                    counts, every, held = counts + slots(every), [], 0
            counts += slots(every)
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(x, t) for x, t in zip((ns, classes, small, [None] * n), types[1:])]], names=names)
        yield pa.RecordBatch.from_arrays(
            [pa.array([x], t) for x, t in zip((None, None, None, None, zlib.compress(counts.tobytes(), 1)), types)], names=names)

    return docs.select("doc_id", "text").mapInArrow(run, _SCAN)


def _counts(scan: DataFrame) -> np.ndarray:
    """Sum of the tasks' count tables; 8 of them reach the driver, whatever the input."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(COUNTERS, dtype=np.int64)
        for batch in batches:
            for raw in batch.column(0):
                total += np.frombuffer(zlib.decompress(raw.as_py()), dtype=np.int64)
        yield pa.RecordBatch.from_arrays([pa.array([zlib.compress(total.tobytes(), 1)], pa.binary())], names=["counts"])

    rows = scan.where("counts IS NOT NULL").select("counts").repartition(8).mapInArrow(add, "counts binary").collect()
    return sum((np.frombuffer(zlib.decompress(r.counts), dtype=np.int64) for r in rows), np.zeros(COUNTERS, dtype=np.int64))


def boundary(reps: DataFrame, threshold: Threshold) -> int:
    """The largest size whose subsets cost no more rows than its prefix rows and the lists they meet."""
    entries = reps.where(F.col("n") <= SMALL).select("n", F.explode(F.expr(
        f"slice(small, 1, CAST(n - ceil({threshold.num} * n / {threshold.den}) + 1 AS INT))")).alias("e"))
    lists = entries.groupBy("e", "n").agg(F.count(F.lit(1)).alias("k"))
    length = lists.groupBy("e").agg(F.sum("k").alias("length"))
    heavy = {r.n: r.cost for r in lists.join(length, "e").groupBy("n").agg(F.sum(F.col("k") * (1 + F.col("length"))).alias("cost")).collect()}
    sets = {r.n: r.sets for r in reps.where(F.col("n") <= SMALL).groupBy("n").agg(F.count(F.lit(1)).alias("sets")).collect()}
    best = 0
    for s in range(1, SMALL + 1):
        if sets.get(s, 0) * threshold.subsets(s) > heavy.get(s, 0):
            break
        best = s
    return best


# -- scan 2: subsets and prefixes -------------------------------------------

_ENTRIES = "doc_id bigint, class string, n bigint, bits binary, entries array<struct<key:bigint,c:int,parts:int>>"


def parity(elements: np.ndarray) -> bytes:
    """Bitmap with a bit per residue that an odd number of elements have; its size is a power of two."""
    size = 1 << max(8, (2 * len(elements) - 1).bit_length())
    return np.packbits(np.bincount(((elements >> np.uint64(24)) & np.uint64(size - 1)).astype(np.int64), minlength=size) & 1).tobytes()


def fold(bits: np.ndarray, words: int) -> np.ndarray:
    """Bitmaps (last axis: 64-bit words) brought down to a smaller size: residues of half the modulus."""
    while bits.shape[-1] > words:
        half = bits.shape[-1] // 2
        bits = bits[..., :half] ^ bits[..., half:]
    return bits


def _entries(docs: DataFrame, size: int, threshold: Threshold, light: int, shared: Broadcast) -> DataFrame:
    """Per document its light subsets (c > 0) and its prefix in list order (c = 0); ``shared`` holds the counts."""
    entry = pa.list_(pa.struct([("key", pa.int64()), ("c", pa.int32()), ("parts", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        using_words()
        table = shared.value
        for batch in batches:
            ns, classes, bits, keys, cs, parts, offsets = [], [], [], [], [], [], [0]
            for text in batch.column(1).to_pylist():
                s = shingle_set(text, size)
                n = len(s)
                ns.append(n)
                classes.append(xxhash.xxh3_128_hexdigest(s.tobytes()) if n else None)
                bits.append(parity(s))
                total = 0
                if 0 < n <= light:
                    for c in threshold.subset_sizes(n):
                        with np.errstate(over="ignore"):  # a subset's hash: the sum over its finished elements
                            mine = finish(s + np.uint64(c))
                            sums = np.array([mine[list(x)].sum() for x in combinations(range(n), c)], dtype=np.uint64)
                        keys.append(finish(sums))
                        cs.append(np.full(len(sums), c, dtype=np.int32))
                        parts.append(np.ones(len(sums), dtype=np.int32))
                        total += len(sums)
                if n and threshold.longest(n) > light:
                    seen = table[(s & np.uint64(COUNTERS - 1)).astype(np.int64)]
                    first = np.argsort(seen, kind="stable")[:threshold.prefix(n)]  # equal counts stay in hash order
                    keys.append(s[first])
                    cs.append(np.zeros(len(first), dtype=np.int32))
                    parts.append((seen[first] // LIST_ROWS + 1).astype(np.int32))
                    total += len(first)
                offsets.append(offsets[-1] + total)
            flat = [np.concatenate(x) if x else np.empty(0, t) for x, t in ((keys, np.uint64), (cs, np.int32), (parts, np.int32))]
            structs = pa.StructArray.from_arrays([pa.array(flat[0].view(np.int64)), pa.array(flat[1]), pa.array(flat[2])], names=["key", "c", "parts"])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(classes, pa.string()), pa.array(ns, pa.int64()), pa.array(bits, pa.binary()),
                 pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), structs).cast(entry)],
                names=["doc_id", "class", "n", "bits", "entries"])

    return docs.select("doc_id", "text").mapInArrow(run, _ENTRIES)


# -- lists ------------------------------------------------------------------

_FOUND = "kind int, a bigint, b bigint, key bigint, n bigint"
LINK, FIRST, NEXT, LONG = 0, 1, 2, 3


def _gathered(batches: Iterator[pa.RecordBatch], rows: int = 50_000) -> Iterator[list[np.ndarray]]:
    """Columns of consecutive batches together, as arrays."""
    some: list[pa.RecordBatch] = []
    for batch in batches:
        some.append(batch)
        if sum(b.num_rows for b in some) >= rows:
            yield [c.to_numpy() for c in pa.Table.from_batches(some).columns]
            some = []
    if some:
        yield [c.to_numpy() for c in pa.Table.from_batches(some).columns]


def _scan_lists(entries: DataFrame, threshold: Threshold) -> DataFrame:
    """Streams lists in order of (key, n, id). Rows out: links (light), pairs with the list's
    first set, pairs with near predecessors, and the members of long lists (node in ``a``)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] | None = None
        for new in _gathered(batches):
            cols = [np.concatenate([h, x]) for h, x in zip(held, new)] if held else new
            # whole lists only; the last one may go on. What is longer than a task should hold goes in pieces: a piece
            # of a subset's list begins with the list's first set again, heavy lists of that length are all long ones
            key, c, part = cols[0], cols[1], cols[2]
            change = np.flatnonzero((key[1:] != key[:-1]) | (c[1:] != c[:-1]) | (part[1:] != part[:-1])) + 1
            cut = int(change[-1]) if len(change) else 0
            rest = slice(cut, None)
            if len(key) - cut > 2 * LIST_ROWS:  # beyond any heavy list that counts as whole
                rest = slice(cut, cut + 1) if c[cut] else slice(len(key), None)
                cut = len(key)
            if cut:
                yield from _pairs([x[:cut] for x in cols], threshold)
            held = [x[rest] for x in cols]
        if held and len(held[0]):
            yield from _pairs(held, threshold)

    order = ["key", "c", "part", "n", "id"]
    rows = entries.select("key", "c", "part", "parts", "n", "id", "pos").repartition("key", "c", "part").sortWithinPartitions(*order)
    return rows.select("key", "c", "part", "parts", "n", "id", "pos").mapInArrow(run, _FOUND)


def _pairs(cols: list[np.ndarray], threshold: Threshold) -> Iterator[pa.RecordBatch]:
    key, c, part, parts, n, node, pos = cols
    size = len(key)
    new = np.concatenate([[True], (key[1:] != key[:-1]) | (c[1:] != c[:-1]) | (part[1:] != part[:-1])])
    starts = np.flatnonzero(new)
    which = np.cumsum(new) - 1
    head, length = starts[which], np.diff(np.append(starts, size))[which]
    at = np.arange(size)
    heavy = c == 0

    def possible(i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """By size, and by what is left behind the two positions of a first common element."""
        need = threshold.overlap(n[i], n[j])
        return (n[i] >= threshold.shortest(n[j])) & (1 + np.minimum(n[i] - 1 - pos[i], n[j] - 1 - pos[j]) >= need) & (node[i] != node[j])

    def batch(kind: int, i: np.ndarray, j: np.ndarray) -> pa.RecordBatch:
        a, b = np.minimum(node[i], node[j]), np.maximum(node[i], node[j])
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(i), kind, dtype=np.int32)), pa.array(a), pa.array(b), pa.array(key[i]), pa.array(n[i])],
            names=["kind", "a", "b", "key", "n"])

    j = at[~heavy & ~new]
    i = head[j]
    good = ((threshold.num + threshold.den) * c[j] >= threshold.num * (n[i] + n[j])) & (node[i] != node[j])
    yield batch(LINK, i[good], j[good])
    j = at[heavy & ~new]
    good = possible(head[j], j)
    yield batch(FIRST, head[j][good], j[good])
    for lag in range(1, NEAR + 1):
        j = at[heavy & (at - lag > head)]
        good = possible(j - lag, j)
        yield batch(NEXT, (j - lag)[good], j[good])
    member = at[heavy & ((length > NEAR + 1) | (parts > 1))]
    yield batch(LONG, member, member)


# -- exact links ------------------------------------------------------------

def _possible(pairs: DataFrame, bitmaps: DataFrame, threshold: Threshold) -> DataFrame:
    """The pairs (a, b) that bitmaps do not rule out."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            s, t = (batch.column(i).to_numpy() for i in (2, 3))
            allowed = s + t - 2 * threshold.overlap(s, t)
            keep = []
            for x, y, most in zip(batch.column(4).to_pylist(), batch.column(5).to_pylist(), allowed.tolist()):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                words = min(len(x), len(y))
                keep.append(int(np.bitwise_count(fold(x, words) ^ fold(y, words)).sum()) <= most)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    one = bitmaps.select(F.col("id").alias("a"), F.col("n").alias("s"), F.col("bits").alias("x"))
    two = bitmaps.select(F.col("id").alias("b"), F.col("n").alias("t"), F.col("bits").alias("y"))
    return pairs.join(one, "a").join(two, "b").select("a", "b", "s", "t", "x", "y").mapInArrow(run, "a bigint, b bigint")


def _verified(pairs: DataFrame, sets: DataFrame, threshold: Threshold) -> DataFrame:
    """The pairs (a, b) that link, by exact intersection of their sets."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3)):
                s, t = (np.frombuffer(v.as_buffer(), dtype=np.uint64) for v in (x, y))
                both = np.concatenate([s, t])
                both.sort()
                keep.append(bool(threshold.linked(int((both[1:] == both[:-1]).sum()), len(s), len(t))))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    one = sets.select(F.col("id").alias("a"), F.col("elements").alias("x"))
    two = sets.select(F.col("id").alias("b"), F.col("elements").alias("y"))
    return pairs.join(two, "b").join(one, "a").select("a", "b", "x", "y").mapInArrow(run, "a bigint, b bigint")


def _groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[tuple[list, list[tuple]]]:
    """Consecutive rows with equal first columns."""
    current, rows = None, []
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            if row[:keys] != current:
                if rows:
                    yield current, rows
                current, rows = row[:keys], []
            rows.append(row[keys:])
    if rows:
        yield current, rows


_BLOCK_FOUND = "key bigint, i bigint, j bigint, a bigint, b bigint"
DENSE = 4  # pairs per member that a block may pass on before its sets are compared in place


def _block_candidates(members: DataFrame, threshold: Threshold) -> DataFrame:
    """Pairs of different components in each block that bitmaps do not rule out; one row without a
    pair for a block that has too many of them."""
    def solve(rows: list[tuple]) -> list[tuple[int, int]] | None:
        out: list[tuple[int, int]] = []
        ids, labels, sizes = (np.array([r[i] for r in rows], dtype=np.int64) for i in range(3))
        words = np.array([len(r[3]) // 8 for r in rows])
        for w in np.unique(words):
            small, same_or_double = np.flatnonzero(words == w), np.flatnonzero((words == w) | (words == 2 * w))
            x = np.stack([fold(np.frombuffer(rows[i][3], np.uint64), int(w)) for i in same_or_double])
            where = {int(i): k for k, i in enumerate(same_or_double)}
            for i in small:
                other = same_or_double
                good = (labels[other] != labels[i]) & ((words[other] > w) | (other > i))
                other, y = other[good], x[good]
                apart = np.bitwise_count(y ^ x[where[int(i)]]).sum(axis=1)
                s, t = np.minimum(sizes[other], sizes[i]), np.maximum(sizes[other], sizes[i])
                fits = (s >= threshold.shortest(t)) & (apart <= s + t - 2 * threshold.overlap(s, t))
                out += [(min(int(ids[i]), int(k)), max(int(ids[i]), int(k))) for k in ids[other[fits]]]
                if len(out) > DENSE * len(rows):
                    return None
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, rows in _groups(batches, 3):
            pairs = solve(rows)
            found = [(*key, None, None)] if pairs is None else [(*key, a, b) for a, b in pairs]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in found], pa.int64()) for i in range(5)], names=["key", "i", "j", "a", "b"])

    rows = members.select("key", "i", "j", "id", "label", "n", "bits").repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
    return rows.mapInArrow(run, _BLOCK_FOUND)


def _block_links(members: DataFrame, threshold: Threshold) -> DataFrame:
    """Links between different components inside (key, i, j) blocks; a spanning forest of them."""
    def solve(ids: list[int], labels: list[int], sets: list[np.ndarray]) -> list[tuple[int, int]]:
        size = np.array([len(s) for s in sets])
        every = np.concatenate(sets)
        ordered = np.sort(every)
        common = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])  # what one set alone holds is in no intersection
        del ordered
        owner = np.repeat(np.arange(len(sets), dtype=np.int32), size)
        element = np.searchsorted(common, every)
        held = element < len(common)
        held[held] = common[element[held]] == every[held]
        owner, element = owner[held], element[held].astype(np.int32)
        del every, held, common
        order = np.argsort(element, kind="stable")
        owner, element = owner[order], element[order]
        del order
        inter = np.zeros((len(sets), len(sets)), dtype=np.float32)
        for lo in range(0, int(element[-1]) + 1 if len(element) else 0, STRIP):
            a, b = np.searchsorted(element, [lo, lo + STRIP])
            chunk = np.zeros((len(sets), STRIP), dtype=np.float32)
            chunk[owner[a:b], element[a:b] - lo] = 1
            for at in range(0, len(sets), STRIP):
                inter[at:at + STRIP] += chunk[at:at + STRIP] @ chunk.T
        label = np.array(labels)
        out, parent = [], {x: x for x in set(labels)}

        def root(x: int) -> int:
            while parent[x] != x:
                parent[x] = x = parent[parent[x]]
            return x

        for at in range(0, len(sets), STRIP):
            own = slice(at, at + STRIP)
            both = np.rint(inter[own]).astype(np.int64)
            good = threshold.linked(both, size[own, None], size[None, :]) & (label[own, None] < label[None, :])
            for i, j in np.argwhere(good).tolist():
                i += at
                p, q = root(labels[i]), root(labels[j])
                if p != q:
                    parent[max(p, q)] = min(p, q)
                    out.append((ids[i], ids[j]))
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in _groups(batches, 3):
            links = solve([r[0] for r in rows], [r[1] for r in rows], [np.frombuffer(r[2], dtype=np.uint64) for r in rows])
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in links], pa.int64()) for i in range(2)], names=["a", "b"])

    rows = members.select("key", "i", "j", "id", "label", "elements").repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
    return rows.mapInArrow(run, "a bigint, b bigint")


def _long_list_links(long: DataFrame, bitmaps: DataFrame, labels: DataFrame, threshold: Threshold, scratch: Scratch, sets_of) -> DataFrame:
    """Links that long lists still hide: members of lists with more than one component, compared in blocks."""
    named = long.join(labels.withColumnRenamed("node", "id"), "id", "left").withColumn("label", F.coalesce("label", "id"))
    named = scratch.store(named.select("key", "id", "n", "label"))
    open_lists = (
        named.groupBy("key").agg(F.count(F.lit(1)).alias("members"), F.sum("n").alias("elements"),
                                 F.min("label").alias("lo"), F.max("label").alias("hi"))
        .where("lo < hi")
        .select("key", F.greatest(F.ceil(F.col("members") / BLOCK_SETS), F.ceil(F.col("elements") / BLOCK_ELEMENTS)).alias("blocks"))
    )
    mine = F.pmod(F.xxhash64("id"), F.col("blocks"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    members = named.join(open_lists, "key").withColumn("mine", mine).select("key", "id", "n", "label", "mine", other)
    members = members.select("key", "id", "n", "label", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"))
    found = scratch.store(_block_candidates(members.join(bitmaps.select("id", "bits"), "id"), threshold))
    pairs = scratch.store(found.where("a IS NOT NULL").select("a", "b").distinct())
    dense = scratch.store(members.join(found.where("a IS NULL").select("key", "i", "j"), ["key", "i", "j"]))
    sets = sets_of(pairs.select(F.col("a").alias("id")).union(pairs.select("b")).union(dense.select("id")).distinct())
    return _verified(pairs, sets, threshold).union(_block_links(dense.join(sets.select("id", "elements"), "id"), threshold))


def _sets(docs: DataFrame, ids: DataFrame, reps: DataFrame, size: int) -> DataFrame:
    """Sorted shingle hashes of the given representatives. One Python worker a task sieves and hashes,
    so that no text crosses to Python twice and no join carries texts."""
    sift = sieve(ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        using_words()
        for batch in batches:
            batch = sift(batch)
            found = [shingle_set(t, size) for t in batch.column(1).to_pylist()]
            classes = [xxhash.xxh3_128_hexdigest(s.tobytes()) if len(s) else None for s in found]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(classes, pa.string()), pa.array([s.tobytes() for s in found], pa.binary())],
                names=["id", "class", "elements"])

    rows = docs.select("doc_id", "text").mapInArrow(run, "id bigint, class string, elements binary")
    # the representative's own text, should another row share its doc_id
    wanted = reps.select(F.col("rep").alias("id"), "class").join(ids, "id", "left_semi")
    return rows.join(wanted, ["id", "class"], "left_semi").dropDuplicates(["id", "class"])


def link_documents(docs: DataFrame, scratch: Scratch, size: int, num: int, den: int) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_shingles, class_id, component_id.

    Documents link when the Jaccard similarity of their shingle sets is at least num / den;
    component_id is the smallest doc_id reachable by links. Null or wordless texts have no
    shingles, link with nothing and are their own class and component. Rows without a doc_id
    are counted but link with nothing. Rows that share a doc_id are one document with several
    texts. Shingles are compared by 64-bit hashes.
    """
    threshold = Threshold(num, den)
    scan = scratch.store(_scan(docs, size))
    texts = scan.where("n IS NOT NULL").select("doc_id", "n", "class", "small")
    reps = scratch.store(texts.where("class IS NOT NULL AND doc_id IS NOT NULL").groupBy("class").agg(
        F.min("doc_id").alias("rep"), F.first("n").alias("n"), F.first("small").alias("small")))
    light = boundary(reps, threshold)
    shared = docs.sparkSession.sparkContext.broadcast(_counts(scan))
    rows = _entries(docs, size, threshold, light, shared)
    rows = rows.join(reps.select("class", F.col("rep").alias("doc_id")), ["class", "doc_id"], "left_semi")
    rows = scratch.store(rows.withColumnRenamed("doc_id", "id").dropDuplicates(["id", "class"]))
    shared.unpersist()
    flat = rows.select("id", "n", F.posexplode("entries").alias("p", "e")).select("id", "n", "p", "e.*")
    lead = F.when(F.col("c") == 0, F.col("p")).otherwise(F.lit(0))
    # a prefix follows the subsets, so its positions start behind them
    if light:
        before = {s: threshold.subsets(s) for s in range(1, light + 1)}
        skip = F.element_at(F.create_map(*[F.lit(x) for kv in before.items() for x in kv]), F.col("n").cast("int"))
        lead = lead - F.when(F.col("c") == 0, F.coalesce(skip, F.lit(0))).otherwise(F.lit(0))
    flat = flat.withColumn("pos", lead.cast("bigint")).withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int"))
    found = scratch.store(_scan_lists(flat, threshold))

    bitmaps = rows.select("id", "n", "bits")
    pairs = found.where(F.col("kind").isin(FIRST, NEXT)).select("a", "b").distinct()
    pairs = scratch.store(_possible(pairs, bitmaps, threshold).distinct())
    long = found.where(F.col("kind") == LONG).select(F.col("a").alias("id"), "key", "n")

    def sets_of(ids: DataFrame) -> DataFrame:
        return scratch.store(_sets(docs, scratch.store(ids), reps, size), codec="none")

    # one pair a set first: it connects most groups, and pairs inside a component need no count
    sets = sets_of(pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct())
    links = found.where(F.col("kind") == LINK).select("a", "b").distinct()
    links = scratch.store(links.union(_verified(pairs.groupBy("b").agg(F.min("a").alias("a")).select("a", "b"), sets, threshold)))
    labels = components(links, scratch)

    left = labels.select(F.col("node").alias("a"), F.col("label").alias("la"))
    right = labels.select(F.col("node").alias("b"), F.col("label").alias("lb"))
    apart = pairs.join(left, "a", "left").join(right, "b", "left").where(F.coalesce("la", "a") != F.coalesce("lb", "b"))
    labels = extend(labels, _verified(apart.select("a", "b"), sets, threshold), scratch)
    scratch.drop(sets)
    labels = extend(labels, _long_list_links(long, bitmaps, labels, threshold, scratch, sets_of), scratch)

    classes = reps.select("class", "rep").join(labels.select(F.col("node").alias("rep"), "label"), "rep", "left").select(
        "class", "rep", F.coalesce("label", "rep").alias("label"))
    out = texts.select("doc_id", "n", "class").join(classes, "class", "left")
    # a document with several texts takes the smallest label of them
    keyed = F.col("doc_id").isNotNull()
    return out.select(
        "doc_id", F.col("n").alias("n_shingles"), F.when(keyed, F.coalesce("rep", "doc_id")).alias("class_id"),
        F.when(keyed, F.coalesce("label", "doc_id")).alias("component_id"))
