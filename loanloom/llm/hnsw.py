"""Nearest neighbours with a navigable small-world graph per shard.

Distinct vectors are dealt by hash into shards of about ``SHARD_ROWS``; each shard becomes one
row: its vectors and, per layer, flat neighbour arrays (offsets and neighbours, as in a sparse
matrix). Every query streams past every shard, and the shards' results are merged. Equal
vectors are one node that keeps its smallest ids, so copies neither crowd a graph nor a task.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loanloom.llm.storage import Scratch

SHARD_ROWS = 4096
QUERY_PART = 65_536
M, EF_BUILD, EF_SEARCH = 12, 64, 96


class Graph:
    """One shard's graph. Distances are squared Euclidean on float64."""

    def __init__(self, vectors: np.ndarray, seed: int = 0):
        self.x, self.square = vectors, np.einsum("ij,ij->i", vectors, vectors)
        self.seen = np.zeros(len(vectors), dtype=np.int64)
        self.mark = 0
        self.layers: list[dict[int, list[int]]] = []
        self.entry, self.top = 0, -1
        levels = np.floor(-np.log(1 - np.random.default_rng(seed).random(len(vectors))) / np.log(M)).astype(int)
        for i, level in enumerate(levels.tolist()):
            self._insert(i, level)

    def _far(self, q: np.ndarray, qq: float, ids) -> np.ndarray:
        return self.square[ids] - 2 * (self.x[ids] @ q) + qq

    def _best(self, layer: dict[int, list[int]], q: np.ndarray, qq: float, start: list[tuple[float, int]], ef: int) -> list[tuple[float, int]]:
        """The ef nearest found from the start nodes, as (distance, node), unordered."""
        self.mark += 1
        seen, mark = self.seen, self.mark
        for _, s in start:
            seen[s] = mark
        todo = list(start)
        heapq.heapify(todo)
        found = [(-d, s) for d, s in start]
        heapq.heapify(found)
        while todo:
            d, at = heapq.heappop(todo)
            if len(found) >= ef and d > -found[0][0]:
                break
            near = np.array(layer[at], dtype=np.int64)
            near = near[seen[near] != mark]
            if not len(near):
                continue
            seen[near] = mark
            for e, node in zip(self._far(q, qq, near).tolist(), near.tolist()):
                if len(found) < ef:
                    heapq.heappush(found, (-e, node))
                    heapq.heappush(todo, (e, node))
                elif e < -found[0][0]:
                    heapq.heapreplace(found, (-e, node))
                    heapq.heappush(todo, (e, node))
        return [(-d, s) for d, s in found]

    def _choose(self, found: list[tuple[float, int]], m: int) -> list[int]:
        """Up to m neighbours, each nearer to the new node than to the neighbours chosen before."""
        found = sorted(found)
        ids = [s for _, s in found]
        if len(ids) <= m:
            return ids
        x = self.x[ids]
        between = self.square[ids][:, None] - 2 * (x @ x.T) + self.square[ids][None, :]
        chosen: list[int] = []
        nearest = np.full(len(ids), np.inf)
        for i, (d, _) in enumerate(found):
            if d < nearest[i]:
                chosen.append(i)
                nearest = np.minimum(nearest, between[i])
                if len(chosen) == m:
                    break
        rest = [i for i in range(len(ids)) if i not in set(chosen)]
        return [ids[i] for i in chosen + rest[:m - len(chosen)]]

    def _insert(self, node: int, level: int) -> None:
        while len(self.layers) <= level:
            self.layers.append({})
        for layer in range(level + 1):
            self.layers[layer][node] = []
        if self.top < 0:
            self.entry, self.top = node, level
            return
        q, qq = self.x[node], float(self.square[node])
        start = [(float(self._far(q, qq, [self.entry])[0]), self.entry)]
        for layer in range(self.top, level, -1):
            start = [min(self._best(self.layers[layer], q, qq, start, 1))]
        for layer in range(min(level, self.top), -1, -1):
            links, most = self.layers[layer], M if layer else 2 * M
            start = self._best(links, q, qq, start, EF_BUILD)
            links[node] = self._choose(start, M)
            for other in links[node]:
                links[other].append(node)
                if len(links[other]) > most:
                    ids = links[other]
                    links[other] = self._choose(list(zip(self._far(self.x[other], float(self.square[other]), ids).tolist(), ids)), most)
        if level > self.top:
            self.entry, self.top = node, level

    def flat(self) -> dict:
        """Arrays of every layer: nodes, offsets into the neighbours, neighbours."""
        nodes, offsets, neighbours, sizes = [], [], [], []
        for layer in self.layers:
            sizes.append(len(layer))
            nodes += list(layer)
            lengths = [len(v) for v in layer.values()]
            offsets += np.cumsum([0, *lengths]).tolist()
            neighbours += [x for v in layer.values() for x in v]
        pack = lambda x: np.array(x, dtype="<i4").tobytes()
        return {"entry": self.entry, "sizes": pack(sizes), "nodes": pack(nodes), "offsets": pack(offsets), "neighbours": pack(neighbours)}

    @classmethod
    def of(cls, vectors: np.ndarray, row: dict) -> Graph:
        self = cls.__new__(cls)
        self.x, self.square = vectors, np.einsum("ij,ij->i", vectors, vectors)
        self.seen, self.mark, self.entry, self.layers = np.zeros(len(vectors), dtype=np.int64), 0, row["entry"], []
        sizes, nodes, offsets, neighbours = (np.frombuffer(row[k], "<i4") for k in ("sizes", "nodes", "offsets", "neighbours"))
        a = b = c = 0
        for size in sizes.tolist():
            cuts = offsets[b:b + size + 1]
            self.layers.append({n: neighbours[c + s:c + e] for n, s, e in zip(nodes[a:a + size].tolist(), cuts[:-1].tolist(), cuts[1:].tolist())})
            a, b, c = a + size, b + size + 1, c + int(cuts[-1])
        self.top = len(self.layers) - 1
        return self

    def search(self, q: np.ndarray, k: int) -> list[int]:
        qq = float(q @ q)
        start = [(float(self._far(q, qq, [self.entry])[0]), self.entry)]
        for layer in range(self.top, 0, -1):
            start = [min(self._best(self.layers[layer], q, qq, start, 1))]
        return [s for _, s in sorted(self._best(self.layers[0], q, qq, start, max(EF_SEARCH, k)))[:k]]


def _matrix(column: pa.Array) -> np.ndarray:
    return np.stack(column.to_numpy(zero_copy_only=False)).astype(np.float64)


def clean(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """Rows (id, vector) that take part: a vector with only finite, non-null components, not all
    zero. A repeated id keeps its smallest vector; rows without an id are left out."""
    v = F.col(vector_col).cast("array<double>")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    some = F.exists(v, lambda x: x != 0)
    # -0.0 and 0.0 are the same component
    plain = F.transform(v, lambda x: x + F.lit(0.0))
    return vectors.where(F.col(id_col).isNotNull() & v.isNotNull() & finite & some).groupBy(
        F.col(id_col).cast("bigint").alias("id")).agg(F.min(plain).alias("vector"))


_SHARD = ("shard int, dim int, members bigint, nodes_first binary, vectors binary, entry int, sizes binary, nodes binary, "
          "offsets binary, neighbours binary")


def build_index(nodes: DataFrame, shards: int) -> DataFrame:
    """One row per shard and dimension from rows (first, vector) of distinct vectors."""
    def build(key: tuple, group: pa.Table) -> pa.Table:
        x = _matrix(group.column("vector"))
        first = group.column("first").to_numpy()
        order = np.argsort(first)  # the graph depends on the rows only, not on their order of arrival
        x, first = x[order], first[order]
        row = Graph(x).flat()
        row |= {"shard": key[0].as_py(), "dim": key[1].as_py(), "members": len(first), "nodes_first": first.astype("<i8").tobytes(), "vectors": x.tobytes()}
        return pa.table({n: pa.array([row[n]], t) for n, t in _SHARD_TYPES.items()})

    dealt = nodes.select(F.pmod(F.xxhash64("first"), F.lit(shards)).cast("int").alias("shard"), F.size("vector").alias("dim"), "first", "vector")
    return dealt.groupBy("shard", "dim").applyInArrow(build, _SHARD)


_SHARD_TYPES = {n: {"int": pa.int32(), "bigint": pa.int64(), "binary": pa.binary()}[t]
                for n, t in (x.strip().split(" ") for x in _SHARD.split(","))}
_HITS = "query bigint, first bigint, score double"


def search_index(index: DataFrame, queries: DataFrame, shards: int, k: int) -> DataFrame:
    """The k nearest nodes of every shard for every query (id, vector) of the shard's dimension.

    A shard travels to its task once and its queries stream past it in Arrow batches; only beyond
    ``QUERY_PART`` queries is it copied, so copies stay a small share of what the queries weigh.
    """
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, graph, x, ids = None, None, None, None
        for batch in batches:
            asked, first, score = [], [], []
            columns = {n: batch.column(n) for n in batch.schema.names}
            keys = list(zip(*(columns[n].to_pylist() for n in ("shard", "dim", "part", "id"))))
            for i, (*place, q) in enumerate(keys):
                if q is None:  # the shard itself, which sorts before its queries
                    row = {n: columns[n][i].as_py() for n in _SHARD_TYPES}
                    here, x = place, np.frombuffer(row["vectors"]).reshape(row["members"], row["dim"])
                    graph, ids = Graph.of(x, row), np.frombuffer(row["nodes_first"], "<i8")
                elif place == here:  # else no shard holds vectors of this length
                    v = columns["vector"][i].values.to_numpy()
                    found = graph.search(v, k)
                    asked += [q] * len(found)
                    first += ids[found].tolist()
                    score += np.sqrt(((x[found] - v) ** 2).sum(axis=1)).tolist()
            yield pa.RecordBatch.from_arrays([pa.array(asked, pa.int64()), pa.array(first, pa.int64()), pa.array(score, pa.float64())],
                                             names=["query", "first", "score"])

    parts = max(1, -(-queries.count() // QUERY_PART))
    part = F.pmod(F.xxhash64("id"), F.lit(parts)).cast("int").alias("part")
    every = F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard")
    visits = queries.select(every, F.size("vector").alias("dim"), part, "id", "vector")
    sides = index.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))).unionByName(visits, allowMissingColumns=True)
    place = ["shard", "dim", "part"]
    # tasks are counted by shards, not by bytes: the work is the search
    return sides.repartition(2 * shards * parts, *place).sortWithinPartitions(*place, F.col("id").asc_nulls_first()).mapInArrow(search, _HITS)


def nearest(vectors: DataFrame, queries: DataFrame, k: int, scratch: Scratch, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """The k nearest rows of ``vectors`` for every row of ``queries``: query_id, rank, vec_id, score.

    Score is the Euclidean distance in double precision; ties go to the smaller id. A row is no
    neighbour of itself (by id). See ``clean`` for the rows that take part; vectors of another
    length than the query's are no candidates.
    """
    rows = scratch.store(clean(vectors, id_col, vector_col))
    # a query needs at most its k nearest, other than itself, among equal vectors
    few = Window.partitionBy("vector").orderBy("id")
    members = rows.withColumn("place", F.row_number().over(few)).where(F.col("place") <= k + 1)
    nodes = scratch.store(members.groupBy("vector").agg(F.min("id").alias("first"), F.sort_array(F.collect_list("id")).alias("ids")))
    shards = max(1, -(-nodes.count() // SHARD_ROWS))
    index = scratch.store(build_index(nodes, shards))
    # a query's own node may hold it alone, so one more node is asked for
    found = scratch.store(search_index(index, scratch.store(clean(queries, id_col, vector_col)), shards, k + 1))
    best = Window.partitionBy("query").orderBy("score", "first")
    found = found.withColumn("place", F.row_number().over(best)).where(F.col("place") <= 2 * (k + 1))
    each = found.join(nodes.select("first", "ids"), "first").select("query", "score", F.explode("ids").alias("id")).where("id <> query")
    order = Window.partitionBy("query").orderBy("score", "id")
    ranked = each.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select(F.col("query").alias("query_id"), "rank", F.col("id").alias("vec_id"), "score")
