"""Benchmark decontamination with an FM-index per training shard.

Test phrases are windows of consecutive benchmark words. A task gathers documents into shards
of bounded size and indexes each shard: suffix order, Burrows-Wheeler transform, a wavelet
matrix for rank, and every ``SAMPLE``-th suffix position. All phrases run through backward
search together; occurrences are located by walking to the next sampled position; overlapping
occurrences merge into removal spans.

The alphabet is the phrases' vocabulary. A shard's indexed text is made of its documents' runs
of alphabet words, except runs shorter than the shortest phrase, which cannot hold one; every
run ends in a separator of its own. Nothing is shuffled: documents never leave their task.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanloom.llm.caches import using

WINDOW = 10
SHARD_CHARS = 6_000_000
PHRASE_BLOCK_WINDOWS = 500_000
PHRASE_BLOCK_CHARS = 32_000_000
SAMPLE = 16
SEPARATOR = 1

# ASCII letters and digits and all non-ASCII bytes are word characters; A-Z become a-z.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]++"


def words(text: str | None) -> list[bytes]:
    return text.encode().translate(_FOLD).split() if text else []


class BitVector:
    """Bits with constant-time rank: packed words and a running count per word."""

    def __init__(self, bits: np.ndarray):
        packed = np.packbits(np.append(bits, np.zeros(64 - len(bits) % 64, bool)), bitorder="little")
        self.words = packed.view(np.uint64)
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)])

    def rank(self, at: np.ndarray) -> np.ndarray:
        """Set bits before each position."""
        word = at >> 6
        mask = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & mask)

    def get(self, at: np.ndarray) -> np.ndarray:
        return (self.words[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) == 1


def suffix_order(text: np.ndarray) -> np.ndarray:
    """Sorted suffix positions by prefix doubling; every separator is a symbol of its own."""
    n = len(text)
    stop = text == SEPARATOR
    rank = np.where(stop, np.cumsum(stop) - 1, text.astype(np.int64) + int(stop.sum()))
    width = 1
    while True:
        follow = np.zeros(n, dtype=np.int64)
        follow[:n - width] = rank[width:] + 1
        key = rank * (int(follow.max()) + 1) + follow
        order = np.argsort(key)
        ordered = key[order]
        rank = np.empty(n, dtype=np.int64)
        rank[order] = np.concatenate([[0], np.cumsum(ordered[1:] != ordered[:-1])])
        width *= 2
        if rank[order[-1]] == n - 1 or width >= n:
            return order


class FmIndex:
    """Over a text of symbols >= 1 that begins and ends with a separator."""

    def __init__(self, text: np.ndarray, symbols: int):
        order = suffix_order(text)
        last = text[order - 1]  # the transform; the text's first symbol follows its last one
        self.less = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=symbols + 1))])  # per symbol: smaller ones
        self.n, self.depth = len(text), max(1, int(symbols).bit_length())
        self.levels: list[BitVector] = []
        self.zeros: list[int] = []
        level = last
        for bit in reversed(range(self.depth)):
            ones = (level >> bit) & 1 == 1
            self.levels.append(BitVector(ones))
            self.zeros.append(int(len(ones) - ones.sum()))
            level = np.concatenate([level[~ones], level[ones]])
        self.origin = self._descend(np.arange(symbols + 1), np.zeros(symbols + 1, dtype=np.int64))
        kept = (order % SAMPLE == 0) | (last == SEPARATOR)
        self.sampled, self.samples = BitVector(kept), order[kept]

    def _descend(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        for i, (bits, zeros) in enumerate(zip(self.levels, self.zeros)):
            ones = bits.rank(at)
            at = np.where((symbol >> (self.depth - 1 - i)) & 1 == 1, zeros + ones, at - ones)
        return at

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Occurrences of each symbol before each position of the transform."""
        return self._descend(symbol, at) - self.origin[symbol]

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Backward search of equally long phrases (one per row): row intervals, empty where there is none."""
        low, high = np.zeros(len(phrases), dtype=np.int64), np.full(len(phrases), self.n, dtype=np.int64)
        live = np.arange(len(phrases))
        for column in reversed(range(phrases.shape[1])):
            symbol = phrases[live, column]
            low[live] = self.less[symbol] + self.rank(symbol, low[live])
            high[live] = self.less[symbol] + self.rank(symbol, high[live])
            live = live[low[live] < high[live]]
        return low, np.maximum(low, high)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of suffix rows: step to the preceding symbol until a sampled row."""
        rows, steps, out = rows.copy(), np.zeros(len(rows), dtype=np.int64), np.zeros(len(rows), dtype=np.int64)
        live = np.arange(len(rows))
        while len(live):
            here = self.sampled.get(rows[live])
            done = live[here]
            out[done] = self.samples[self.sampled.rank(rows[done])] + steps[done]
            live = live[~here]
            at, symbol = rows[live], np.zeros(len(live), dtype=np.int64)
            for bits, zeros in zip(self.levels, self.zeros):
                one, ones = bits.get(at), bits.rank(at)
                symbol = symbol * 2 + one
                at = np.where(one, zeros + ones, at - ones)
            rows[live] = self.less[symbol] + at - self.origin[symbol]
            steps[live] += 1
        return out


@dataclass
class Phrases:
    """Distinct windows by length, as symbols, with the items that have them."""

    codes: dict[bytes, int]
    windows: dict[int, np.ndarray]
    items: dict[int, tuple[np.ndarray, np.ndarray]]  # offsets by window, and the ids

    @classmethod
    def of(cls, rows: list[tuple[int | None, str | None]], size: int = WINDOW) -> Phrases:
        codes: dict[bytes, int] = {}
        coded: dict[int, list[np.ndarray]] = {}
        owners: dict[int, list[tuple[int | None, int]]] = {}
        for item, text in rows:
            mine = np.array([codes.setdefault(w, len(codes) + SEPARATOR + 1) for w in words(text)], dtype=np.int32)
            if len(mine):
                length = min(size, len(mine))
                cut = np.lib.stride_tricks.sliding_window_view(mine, length)
                coded.setdefault(length, []).append(cut)
                owners.setdefault(length, []).append((item, len(cut)))
        windows, items = {}, {}
        for length in sorted(coded):
            windows[length], which = np.unique(np.concatenate(coded.pop(length)), axis=0, return_inverse=True)
            known = np.repeat([i is not None for i, _ in owners[length]], [n for _, n in owners[length]])
            ids = np.repeat(np.array([i or 0 for i, _ in owners[length]], dtype=np.int64), [n for _, n in owners[length]])[known]
            which = which.ravel()[known]
            order = np.lexsort((ids, which))
            which, ids = which[order], ids[order]
            once = np.append(True, (which[1:] != which[:-1]) | (ids[1:] != ids[:-1]))[:len(ids)]
            items[length] = np.searchsorted(which[once], np.arange(len(windows[length]) + 1)), ids[once]
        return cls(codes, windows, items)


Found = tuple[int, list[tuple[int, int]], list[int]]  # words, merged spans of hit words, items


def scan_shard(texts: list[str | None], phrases: Phrases) -> list[Found]:
    """Index one shard and search it for every phrase."""
    shortest = min(phrases.windows, default=0)
    counts, docs, offsets, pieces = [], [], [], []
    get = phrases.codes.get
    for d, text in enumerate(texts):
        w = words(text)
        counts.append(len(w))
        if not shortest or len(w) < shortest:
            continue
        coded = np.fromiter(map(get, w, repeat(SEPARATOR)), dtype=np.int64, count=len(w))
        edges = np.flatnonzero(np.diff(np.concatenate([[False], coded != SEPARATOR, [False]]).astype(np.int8)))
        starts, ends = edges[::2], edges[1::2]
        for s, e in zip(starts.tolist(), ends.tolist()):
            if e - s >= shortest:
                docs.append(d)
                offsets.append(s)
                pieces.append(coded[s:e])
    spans: list[list[tuple[int, int]]] = [[] for _ in texts]
    items: list[set[int]] = [set() for _ in texts]
    if pieces:
        one = np.array([SEPARATOR])
        text = np.concatenate([x for p in pieces for x in (one, p)] + [one])
        begins = np.cumsum([1] + [len(p) + 1 for p in pieces[:-1]])  # where each run begins in the indexed text
        index = FmIndex(text, len(phrases.codes) + SEPARATOR)
        for length, windows in phrases.windows.items():
            low, high = index.search(windows)
            size = high - low
            if not size.sum():
                continue
            which = np.repeat(np.arange(len(windows)), size)
            rows = np.repeat(low - np.concatenate([[0], np.cumsum(size)[:-1]]), size) + np.arange(size.sum())
            at = index.locate(rows)
            run = np.searchsorted(begins, at, side="right") - 1
            place, ids = phrases.items[length]
            for r, p, w in zip(run.tolist(), at.tolist(), which.tolist()):
                start = offsets[r] + p - int(begins[r])
                spans[docs[r]].append((start, start + length))
                items[docs[r]].update(ids[place[w]:place[w + 1]].tolist())
    return [(n, merge(s), sorted(i)) for n, s, i in zip(counts, spans, items)]


def merge(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], end))
        else:
            out.append((start, end))
    return out


def cut(text: str, spans: list[tuple[int, int]]) -> str:
    """The text without the words of the spans; each takes what stands between it and the next kept word along."""
    raw = text.encode()
    folded = raw.translate(_FOLD)
    starts, at = [], 0
    for w in folded.split():
        at = folded.index(w, at)
        starts.append(at)
        at += len(w)
    starts.append(len(raw))
    keep, at = [], 0
    for s, e in spans:
        keep.append(raw[at:starts[s]])
        at = starts[e]
    return b"".join([*keep, raw[at:]]).decode()


def phrase_blocks(benchmark: DataFrame, size: int = WINDOW) -> Iterator[tuple[Phrases, bool]]:
    """The benchmark (item_id, text) in blocks of about PHRASE_BLOCK_WINDOWS words and at most PHRASE_BLOCK_CHARS
    characters on average, one in the driver's memory at a time, and whether a block is the last one. An item is
    never divided, so one that is larger makes a larger block."""
    size_of = benchmark.agg(F.sum(F.length("text")), F.sum(F.regexp_count("text", F.lit(_WORD)))).first()
    blocks = max(1, -(-(size_of[0] or 0) // PHRASE_BLOCK_CHARS), -(-(size_of[1] or 0) // PHRASE_BLOCK_WINDOWS))
    block = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))
    for b in range(blocks):
        yield Phrases.of([tuple(r) for r in benchmark.select("item_id", "text").where(block == b).collect()], size), b == blocks - 1


def _shards(batches: Iterator[pa.RecordBatch], text_at: int) -> Iterator[pa.Table]:
    """Batches gathered until their texts reach SHARD_CHARS; large batches are cut."""
    held, chars = [], 0
    for batch in batches:
        step = max(1, int(batch.num_rows * SHARD_CHARS / max(SHARD_CHARS, batch.column(text_at).nbytes)))
        for at in range(0, batch.num_rows, step):
            part = batch.slice(at, step)
            held.append(part)
            chars += part.column(text_at).nbytes
            if chars >= SHARD_CHARS:
                yield pa.Table.from_batches(held)
                held, chars = [], 0
    if held:
        yield pa.Table.from_batches(held)


def _apply(docs: DataFrame, phrases: Phrases, schema: T.StructType,
           emit: Callable[[pa.Table, list[Found]], tuple[pa.Table, dict[str, pa.Array]]]) -> DataFrame:
    spark, names = docs.sparkSession, docs.columns
    shared = spark.sparkContext.broadcast(phrases)
    text_at, out_names = names.index("text"), schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        using()
        for shard in _shards(batches, text_at):
            found = scan_shard(shard.column(text_at).to_pylist(), shared.value)
            shard, columns = emit(shard, found)
            yield from pa.table({n: columns.get(n) if n in columns else shard.column(n) for n in out_names}).to_batches()
            del shard, found, columns
            pa.default_memory_pool().release_unused()

    return docs.mapInArrow(run, schema)


_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
_SPAN = T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])
FOUND_SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("n_words", T.LongType()), T.StructField("spans", T.ArrayType(_SPAN)),
    T.StructField("items", T.ArrayType(T.LongType())),
])


def contamination(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): word count, merged spans of hit words, ids of the items hit.

    A phrase is ``size`` consecutive words of an item, or the whole item if it has fewer words
    but some. Null and empty texts have no words. Rows repeat as given; items without an id hit
    words but are not listed. An empty benchmark hits nothing.
    """
    def first(shard: pa.Table, found: list[Found]) -> tuple[pa.Table, dict[str, pa.Array]]:
        return shard, {"n_words": pa.array([f[0] for f in found], pa.int64()),
                       "spans": pa.array([[{"start": s, "end": e} for s, e in f[1]] for f in found], _SPANS),
                       "items": pa.array([f[2] for f in found], pa.list_(pa.int64()))}

    def more(shard: pa.Table, found: list[Found]) -> tuple[pa.Table, dict[str, pa.Array]]:
        both = [(n, merge([*s, *((x["start"], x["end"]) for x in old)]), sorted({*i, *ids}))
                for (n, s, i), old, ids in zip(found, shard.column("spans").to_pylist(), shard.column("items").to_pylist())]
        return first(shard, both)

    df = docs.select("doc_id", "text")
    with_text = T.StructType([*df.schema.fields, *FOUND_SCHEMA.fields[1:]])
    out = None
    for phrases, _ in phrase_blocks(benchmark, size):
        out = _apply(df, phrases, with_text, first) if out is None else _apply(out, phrases, with_text, more)
    return out.select(*FOUND_SCHEMA.names)


def remove_contamination(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW, drop_emptied: bool = False) -> DataFrame:
    """``docs`` with the words of the removal spans cut from ``text``, and ``n_chars`` (if there) set anew.

    Untouched texts stay as they are. Other columns pass through, whatever their names. With
    ``drop_emptied`` rows whose every word is cut go. All spans are those of the original text:
    blocks of the benchmark before the last one only add theirs to a column, and the last one cuts.
    """
    spans = "__spans"
    while spans in docs.columns:
        spans += "_"

    def joined(shard: pa.Table, found: list[Found]) -> list[Found]:
        if spans not in shard.column_names:
            return found
        return [(n, merge([*s, *((x["start"], x["end"]) for x in old)]), i) for (n, s, i), old in zip(found, shard.column(spans).to_pylist())]

    def gather(shard: pa.Table, found: list[Found]) -> tuple[pa.Table, dict[str, pa.Array]]:
        return shard, {spans: pa.array([[{"start": s, "end": e} for s, e in f[1]] for f in joined(shard, found)], _SPANS)}

    def emit(shard: pa.Table, found: list[Found]) -> tuple[pa.Table, dict[str, pa.Array]]:
        texts, found = shard.column("text").to_pylist(), joined(shard, found)
        if drop_emptied:
            left = [not f[1] or sum(e - s for s, e in f[1]) < f[0] for f in found]
            texts = [cut(t, f[1]) if f[1] else t for t, f, k in zip(texts, found, left) if k]
            found, shard = [f for f, k in zip(found, left) if k], shard.filter(pa.array(left, pa.bool_()))
        else:
            texts = [cut(t, f[1]) if f[1] else t for t, f in zip(texts, found)]
        out = {"text": pa.array(texts, pa.string())}
        if "n_chars" in shard.column_names:
            old = shard.column("n_chars")
            out["n_chars"] = pa.array([len(t) if f[1] else n for t, f, n in zip(texts, found, old.to_pylist())], old.type)
        return shard, out

    schema = docs.schema
    with_spans = T.StructType([*schema.fields, T.StructField(spans, T.ArrayType(_SPAN))])
    for phrases, last in phrase_blocks(benchmark, size):
        docs = _apply(docs, phrases, schema if last else with_spans, emit if last else gather)
    return docs
