"""Token-id shards with a minimal perfect hash index.

A document's text becomes the ids of a given tokenizer plus one end id. Documents are range
partitioned by key, so shards hold ascending keys. A shard is one row of a Parquet table:

* ``payload``: the raw ids, one after the other, as little-endian unsigned integers of the
  smallest width that holds the vocabulary (``id_bytes``);
* ``ends``: for every document in the shard, the id count up to and with its end id (uint32);
* ``seeds``, ``prints``, ``slots``: the index. A key hashes to a bucket, the bucket's seed
  displaces it to its own slot of ``n_keys`` slots (no gaps, no collisions); the slot has a
  32-bit fingerprint of the key, the key's first document in the shard and its document count;
* ``keys``: the keys in order, for scans.

Looking up a key costs two hashes and one slice, however large the shard is. Shards are
closed at ``SHARD_IDS`` ids, so memory is bounded by that and the longest document.
"""

from __future__ import annotations

import zlib
from array import array
from bisect import bisect_right
from codecs import charmap_decode
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanloom.llm.caches import using
from loanloom.llm.storage import Scratch

SHARD_IDS = 1 << 19
CACHE_ENTRIES = 500_000  # parts of a generation, and their words
BUCKET_KEYS = 4
NULL_KEY = -(2**63)

SHARD_SCHEMA = (
    "part int, seq int, first_key bigint, last_key bigint, n_docs bigint, n_keys bigint, n_ids bigint, id_bytes int, "
    "keys binary, ends binary, seeds binary, prints binary, slots binary, payload binary"
)
_INDEX_FIELDS = ("seeds", "prints", "slots")


# -- encoding ---------------------------------------------------------------

# A space after a non-space always starts a new piece of the byte-level pattern, so text may be cut there.
_MARKS = ".,;:!?#%&$*|"
_LATIN = "\u0250"  # letters before it are letters in every version of Unicode
# The byte-level alphabet: printable Latin-1 stands for itself, the other bytes for the characters from U+0100.
_SHOWN = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
_HIDDEN = [b for b in range(0x100) if b not in _SHOWN]
_ALPHABET = "".join(chr(b if b in _SHOWN else 0x100 + _HIDDEN.index(b)) for b in range(0x100))


class Encoder:
    """Encodes texts with a tokenizer file; ids of parts and words seen before come from a bounded cache.

    The cache has two generations: a full one becomes the older, whose entries come back when they are met, and
    the older one before it goes. So what is met often stays.

    Byte-level pre-tokenization never joins a word with a space that follows it, so a text
    whose spaces all follow a non-space is the concatenation of its space-led parts. Any other
    text goes to the tokenizer whole. In the same way a part of letters and trailing marks is
    its letters and its marks. Ids always come from the tokenizers library; a word of Latin letters, which is one
    piece, goes to the tokenizer's model at once.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        # ids above 2^16 need wider integers
        self.id_bytes = 2 if self.tokenizer.get_vocab_size(with_added_tokens=True) <= 1 << 16 else 4
        self.dtype = np.dtype(f"<u{self.id_bytes}")
        self.code = {2: "H", 4: "I"}[self.id_bytes]
        self.line_end = self.tokenizer.encode("\n", add_special_tokens=False).ids
        self.line = array(self.code, self.line_end).tobytes()
        # a token that is looked for before pieces are made could stand inside a word
        self.model = self.tokenizer.model
        added = self.tokenizer.get_added_tokens_decoder().values()
        self.whole_words = self.tokenizer.normalizer is None and not any(t.content.strip().isalpha() for t in added)
        self.parts: dict[str, bytes] = {}
        self.old_parts: dict[str, bytes] = {}

    def _ids(self, texts: list[str]) -> list[bytes]:
        return [array(self.code, e.ids).tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _add_words(self, new: list[str]) -> None:
        """Encode words without inner white space, many in one text: a line end is always an id of its own."""
        for at in range(0, len(new), 2_000):
            some = new[at:at + 2_000]
            ids = np.array(self.tokenizer.encode_batch_fast(["\n".join(some)], add_special_tokens=False)[0].ids, dtype=self.dtype)
            raw, cuts = ids.tobytes(), (np.flatnonzero(ids == self.line_end[0]) * self.id_bytes).tolist()
            if len(cuts) == len(some) - 1:
                told = [raw[a:b] for a, b in zip([0, *[c + self.id_bytes for c in cuts]], [*cuts, len(raw)])]
            else:
                told = self._ids(some)
            self.parts.update(zip(map(_flip, some), told))

    def _word(self, word: str) -> bytes | None:
        """A word's ids, if it is known or of Latin letters only."""
        key = word[1:] if word[:1] == " " else " " + word
        got = self.parts.get(key)
        if got is None:
            got = self.old_parts.get(key)
            if got is None:
                if not self.whole_words or not word.lstrip(" ").isalpha() or not (word.isascii() or max(word) < _LATIN):
                    return None
                shown = charmap_decode(word.encode(), "strict", _ALPHABET)[0]
                got = array(self.code, [t.id for t in self.model.tokenize(shown)]).tobytes()
            self.parts[key] = got
        return got

    def _line(self, line: str) -> bytes | None:
        """The ids of letters and trailing marks, if both are known or the letters Latin."""
        core = line.rstrip(_MARKS)
        if not core.lstrip(" ").isalpha():
            return None
        got = self._word(core)
        if got is None or len(core) == len(line):
            return got
        tail = self._word(line[len(core):])
        return None if tail is None else got + tail

    def _part(self, key: str) -> bytes | None:
        """The ids of a part that the cache lacks: from the older generation or from its words, if they are known."""
        got = self.old_parts.get(key)
        if got is None:
            part = key[1:] if key[:1] == " " else " " + key
            if "\n" not in part:
                return self._line(part)
            ids = list(map(self._line, part.split("\n")))  # a line end between non-spaces is a piece of its own
            got = None if None in ids else self.line.join(ids)
        return got

    def _add(self, keys: set[str]) -> None:
        """Put the ids of parts into the cache: from the older generation, else from their words, else encoded."""
        rest = []
        for key in keys:
            got = self._part(key)
            if got is None:
                rest.append((key, _flip(key)))
            else:
                self.parts[key] = got
        self._add_new(rest)

    def _add_new(self, rest: list[tuple[str, str]]) -> None:
        odd, plain = [], []
        for key, part in rest:
            lines = [(x.rstrip(_MARKS), x) for x in part.split("\n")]
            if all([core.lstrip(" ").isalpha() for core, _ in lines]):
                plain.append((key, [(core, x[len(core):]) for core, x in lines]))
            else:
                odd.append((key, part))
        new = {word for _, lines in plain for line in lines for word in line if word}
        self._add_words([x for x in new if self._word(x) is None])
        for key, lines in plain:
            self.parts[key] = self.line.join([b"".join([self.parts[_flip(word)] for word in line if word]) for line in lines])
        for at in range(0, len(odd), 50_000):
            some = odd[at:at + 50_000]
            self.parts.update(zip([key for key, _ in some], self._ids([part for _, part in some])))

    def encode(self, texts: list[str]) -> list[bytes]:
        if len(self.parts) > CACHE_ENTRIES:
            self.parts, self.old_parts = {}, self.parts
        known, out = self.parts.get, []
        holes: dict[str, list[tuple[list, int]]] = {}
        for text in texts:
            # a part's key is what follows its space; the first part has none, which a space in its key says
            mine = text.split(" ")
            if mine[0]:
                mine[0] = " " + mine[0]
            else:
                del mine[0]
            ids = list(map(known, mine))
            whole = None not in ids
            if not whole:
                ids, whole = self._fill(mine, ids, holes)
            out.append(b"".join(ids) if whole else ids)
        self._add({key for key in holes if not _open(key)})
        last = [key for key in holes if _open(key)]
        told = dict(zip(last, self._ids([_flip(key) for key in last])))
        for key, places in holes.items():
            got = told[key] if key in told else self.parts[key]
            for ids, i in places:
                ids[i] = got
        rest = iter(self._ids([t for t, ids in zip(texts, out) if ids is None]))
        return [next(rest) if ids is None else ids if isinstance(ids, bytes) else b"".join(ids) for ids in out]

    def _fill(self, mine: list[str], ids: list, holes: dict[str, list[tuple[list, int]]]) -> tuple[list | None, bool]:
        """Fill in the ids of a text's missing parts, and whether all are there; a part that must be encoded is noted in
        ``holes``. None for a text with white space before a space: parts that end so are never kept, so all are met here."""
        whole, parts = True, self.parts
        for i in [i for i, got in enumerate(ids) if got is None]:
            key = mine[i]
            got = parts.get(key)
            if got is None:
                got = self._part(key)
                if got is None:
                    if _open(key) and i + 1 < len(mine):
                        return None, False
                    holes.setdefault(key, []).append((ids, i))
                    whole = False
                    continue
                parts[key] = got
            ids[i] = got
        return ids, whole


def _flip(x: str) -> str:
    """A part's key, or the part of a key: without the space that it begins with, or with one."""
    return x[1:] if x[:1] == " " else " " + x


def _open(key: str) -> bool:
    """A part that ends in white space, or a space alone."""
    return not key or key[-1].isspace()


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The worker's encoder for a file; its cache outlives the task."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


# -- minimal perfect hash ---------------------------------------------------

def mix(keys: np.ndarray, seed: np.ndarray | int) -> np.ndarray:
    """A 64-bit finalizer (multiply and xor-shift) over keys and seeds."""
    with np.errstate(over="ignore"):
        x = keys.astype(np.uint64) + np.asarray(seed, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def build_index(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Seeds per bucket, and the slot of every (distinct) key: slots are 0 .. n-1, each used once."""
    n = len(keys)
    buckets = max(1, -(-n // BUCKET_KEYS))
    unsigned = keys.astype(np.int64).view(np.uint64)
    home = (mix(unsigned, 0) % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(home, kind="stable")
    starts = np.searchsorted(home[order], np.arange(buckets + 1))
    seeds, slots, free = np.zeros(buckets, dtype="<u4"), np.zeros(n, dtype="<u4"), np.ones(n, dtype=bool)
    tries = np.arange(1, 257, dtype=np.uint64)
    for b in np.argsort(-np.diff(starts), kind="stable"):
        members = order[starts[b]:starts[b + 1]]
        if not len(members):
            break
        base = 0
        while True:  # displacements in blocks; the first that puts all members on free, distinct slots wins
            at = (mix(unsigned[members][None, :], (tries + np.uint64(base))[:, None]) % np.uint64(n)).astype(np.int64)
            good = free[at].all(axis=1)
            if len(members) > 1:
                spread = np.sort(at, axis=1)
                good &= (spread[:, 1:] != spread[:, :-1]).all(axis=1)
            hit = int(np.argmax(good))
            if good[hit]:
                seeds[b], slots[members] = base + hit + 1, at[hit]
                free[at[hit]] = False
                break
            base += len(tries)
    return seeds, slots


def fingerprint(keys: np.ndarray) -> np.ndarray:
    return (mix(keys.astype(np.int64).view(np.uint64), 0x5BD1E995) >> np.uint64(32)).astype("<u4")


def find(keys: np.ndarray, seeds: np.ndarray, prints: np.ndarray) -> np.ndarray:
    """The slot of each key, -1 where the stored fingerprint says that the key is not there."""
    if not len(prints):
        return np.full(len(keys), -1)
    unsigned = keys.astype(np.int64).view(np.uint64)
    seed = seeds[(mix(unsigned, 0) % np.uint64(len(seeds))).astype(np.int64)]
    at = (mix(unsigned, seed) % np.uint64(len(prints))).astype(np.int64)
    return np.where((seed > 0) & (prints[at] == fingerprint(keys)), at, -1)


# -- writing ----------------------------------------------------------------

def _shard(part: int, seq: int, keys: list[int], ids: list[bytes], width: int) -> dict:
    lengths = np.array([len(x) // width for x in ids], dtype=np.int64)
    distinct, first, count = np.unique(np.array(keys, dtype=np.int64), return_index=True, return_counts=True)
    seeds, slots = build_index(distinct)
    prints, where = np.zeros(len(distinct), dtype="<u4"), np.zeros((len(distinct), 2), dtype="<u4")
    prints[slots] = fingerprint(distinct)
    where[slots] = np.stack([first, count], axis=1)
    return {
        "part": part, "seq": seq, "first_key": int(distinct[0]), "last_key": int(distinct[-1]), "n_docs": len(ids),
        "n_keys": len(distinct), "n_ids": int(lengths.sum()), "id_bytes": width, "keys": distinct.astype("<i8").tobytes(),
        "ends": np.cumsum(lengths).astype("<u4").tobytes(), "seeds": seeds.tobytes(), "prints": prints.tobytes(),
        "slots": where.tobytes(), "payload": b"".join(ids),
    }


def _arrow(schema: pa.Schema, rows: list[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema=schema)


_SHARD_ARROW = pa.schema(
    [pa.field(n, {"int": pa.int32(), "bigint": pa.int64(), "binary": pa.binary()}[t])
     for n, t in (x.strip().split(" ") for x in SHARD_SCHEMA.split(","))]
)


def write_shards(docs: DataFrame, scratch: Scratch, tokenizer_path: str, end_id: int = 0) -> DataFrame:
    """Encode ``docs`` (doc_id, text) into shards in ascending doc_id order; returns the stored shard table.

    Null texts count as empty (only the end id). Rows without a doc_id come first, under
    ``NULL_KEY``. Rows that repeat a doc_id stay separate documents, ordered by text.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        using("encoders", _encoders.clear)
        part, seq, coder = TaskContext.get().partitionId(), 0, encoder(tokenizer_path)
        end = np.array([end_id], dtype=coder.dtype).tobytes()
        keys: list[int] = []
        ids: list[bytes] = []
        held = 0
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                some = batch.slice(at, 512)
                coded = coder.encode([x or "" for x in some.column(1).to_pylist()])
                for key, doc in zip(some.column(0).to_pylist(), coded):
                    if held and held + len(doc) > SHARD_IDS * coder.id_bytes:
                        yield _arrow(_SHARD_ARROW, [_shard(part, seq, keys, ids, coder.id_bytes)])
                        keys, ids, held, seq = [], [], 0, seq + 1
                    keys.append(NULL_KEY if key is None else key)
                    ids.append(doc + end)
                    held += len(doc) + len(end)
        if keys:
            yield _arrow(_SHARD_ARROW, [_shard(part, seq, keys, ids, coder.id_bytes)])

    ordered = docs.select("doc_id", "text").repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    return scratch.store(ordered.mapInArrow(run, SHARD_SCHEMA))


# -- reading ----------------------------------------------------------------

def _slices(shard: dict, keys: np.ndarray) -> Iterator[tuple[int, int, int, memoryview]]:
    """For each key that the shard holds: key, start in the shard, id count and raw ids, per document."""
    seeds, prints = np.frombuffer(shard["seeds"], "<u4"), np.frombuffer(shard["prints"], "<u4")
    slots, ends = np.frombuffer(shard["slots"], "<u4").reshape(-1, 2), np.frombuffer(shard["ends"], "<u4")
    raw, width = memoryview(shard["payload"]), shard["id_bytes"]
    for key, at in zip(keys.tolist(), find(keys, seeds, prints).tolist()):
        if at < 0:
            continue
        first, count = slots[at].tolist()
        for d in range(first, first + count):
            start = int(ends[d - 1]) if d else 0
            yield key, start, int(ends[d]) - start, raw[start * width:int(ends[d]) * width]


DIGEST_SCHEMA = "doc_id bigint, part int, seq int, start_in_shard bigint, n_tokens bigint, ids_crc32 bigint"
_DIGEST_ARROW = pa.schema([("doc_id", pa.int64()), ("part", pa.int32()), ("seq", pa.int32()), ("start_in_shard", pa.int64()),
                           ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])


def _digest(shard: dict, keys: np.ndarray) -> pa.RecordBatch:
    rows = []
    for key, start, n, raw in _slices(shard, keys):
        wide = np.frombuffer(raw, f"<u{shard['id_bytes']}").astype("<u4")
        rows.append({"doc_id": None if key == NULL_KEY else key, "part": shard["part"], "seq": shard["seq"],
                     "start_in_shard": start, "n_tokens": n, "ids_crc32": zlib.crc32(wide.tobytes())})
    return _arrow(_DIGEST_ARROW, rows)


def _shards_of(batch: pa.RecordBatch) -> Iterator[dict]:
    for i in range(batch.num_rows):
        yield batch.slice(i, 1).to_pylist()[0]


def read_documents(shards: DataFrame) -> DataFrame:
    """One row per stored document, each fetched through its shard's index."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard in _shards_of(batch):
                yield _digest(shard, np.frombuffer(shard["keys"], "<i8"))

    return shards.mapInArrow(run, DIGEST_SCHEMA)


def lookup(shards: DataFrame, keys: DataFrame) -> DataFrame:
    """Keyed access: the documents of the distinct, non-null values of the first column of ``keys``.

    Keys are routed to parts by the parts' key ranges (one row per written partition, so the
    directory on the driver is bounded by the partition count), then to shards of the part.
    """
    parts = shards.groupBy("part").agg(F.min("first_key").alias("lo"), F.max("last_key").alias("hi")).orderBy("lo").collect()
    lows, numbers = [r.lo for r in parts], [r.part for r in parts]

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            wanted = [k for k in batch.column(0).to_pylist() if lows and k >= lows[0]]
            yield pa.RecordBatch.from_arrays(
                [pa.array([numbers[bisect_right(lows, k) - 1] for k in wanted], pa.int32()), pa.array(wanted, pa.int64())],
                names=["part", "key"])

    name = keys.columns[0]
    wanted = keys.select(F.col(name).cast("bigint").alias("key")).where("key IS NOT NULL").distinct()
    routed = wanted.mapInArrow(route, "part int, key bigint")
    where = shards.select("part", "seq", "first_key", "last_key").join(routed, "part").where("key BETWEEN first_key AND last_key")
    asked = where.groupBy("part", "seq").agg(F.collect_list("key").alias("asked"))  # at most a shard's keys

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard in _shards_of(batch):
                yield _digest(shard, np.array(shard["asked"], dtype=np.int64))

    return shards.join(asked, ["part", "seq"]).mapInArrow(run, DIGEST_SCHEMA)


def with_starts(documents: DataFrame, shards: DataFrame) -> DataFrame:
    """Add ``start``: the ids of all documents before, over all shards in order.

    Running totals take two levels: inside a part by window, across parts over one row per part.
    """
    from pyspark.sql import Window

    parts = shards.groupBy("part").agg(F.min("first_key").alias("lo"), F.sum("n_ids").alias("n"))
    across = Window.orderBy("lo").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("n").over(across), F.lit(0)).alias("part_start"))
    inside = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    heads = (
        shards.select("part", "seq", "n_ids")
        .withColumn("shard_start", F.coalesce(F.sum("n_ids").over(inside), F.lit(0)))
        .join(parts, "part").select("part", "seq", (F.col("part_start") + F.col("shard_start")).alias("before"))
    )
    return documents.join(heads, ["part", "seq"]).withColumn("start", F.col("before") + F.col("start_in_shard"))
