"""A bounded bit table of ids that lets a scan drop most other rows before a join."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from loanloom.llm.shingles import finish

MAX_BITS = 1 << 25  # 4 MB; more ids than that allows for make the sieve coarser, never wrong
BITS_PER_ID = 16


def _places(ids: np.ndarray, bits: int) -> np.ndarray:
    return (finish(ids.astype(np.int64).view(np.uint64)) % np.uint64(bits)).astype(np.int64)


def sieve(ids: DataFrame) -> Callable[[pa.RecordBatch], pa.RecordBatch]:
    """For a task: leaves of a batch (doc_id first) few rows whose doc_id is not among ``ids`` (one column); an
    exact join must follow. Rows without a doc_id are dropped."""
    count = ids.count()
    bits = min(MAX_BITS, 1 << max(16, (count * BITS_PER_ID).bit_length()))

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(bits, dtype=bool)
        for batch in batches:
            seen[_places(batch.column(0).to_numpy(zero_copy_only=False), bits)] = True
        yield pa.RecordBatch.from_arrays([pa.array([zlib.compress(np.packbits(seen).tobytes(), 1)], pa.binary())], names=["bits"])

    seen = np.zeros(bits, dtype=bool)
    for row in ids.repartition(8).mapInArrow(mark, "bits binary").toLocalIterator():
        seen |= np.unpackbits(np.frombuffer(zlib.decompress(row.bits), np.uint8)).astype(bool)
    shared = ids.sparkSession.sparkContext.broadcast(np.packbits(seen))

    def sift(batch: pa.RecordBatch) -> pa.RecordBatch:
        column, table = batch.column(0), shared.value
        at = _places(column.fill_null(0).to_numpy(), bits)
        keep = ((table[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1).astype(bool) & ~column.is_null().to_numpy(zero_copy_only=False)
        return batch.filter(pa.array(keep))

    return sift
