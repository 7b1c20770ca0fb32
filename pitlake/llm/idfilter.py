"""A bit array of fixed size that tells which ids may be in a set, so other rows needn't be shuffled.

It is ``2**BITS`` bits whatever the set; a large set fills it, and then more
rows pass.  Rows that pass by chance are left to the join that follows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import U64, mix

BITS = 26


def _bit(ids: np.ndarray) -> np.ndarray:
    return (mix(ids.astype(np.int64).view(U64)) >> U64(64 - BITS)).astype(np.int64)


def id_filter(ids: DataFrame, column: str):
    """The broadcast bit array of the longs in ``column``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = np.unique(_bit(batch.column(0).drop_null().to_numpy()))
            words, start = np.unique(at >> 6, return_index=True)
            if len(words):
                yield pa.RecordBatch.from_arrays([pa.array(words), pa.array(np.bitwise_or.reduceat(U64(1) << (at & 63).astype(U64), start).view(np.int64))], names=["at", "word"])

    found = ids.select(F.col(column).cast("long")).mapInArrow(run, "at long, word long").groupBy("at").agg(F.bit_or("word").alias("word")).toArrow()  # 2**20 rows at most
    words = np.zeros(1 << (BITS - 6), dtype=np.int64)
    words[found["at"].to_numpy()] = found["word"].to_numpy()
    return ids.sparkSession.sparkContext.broadcast(words.view(np.uint8))


def hits(bits, ids: pa.Array) -> np.ndarray:
    """Which of the longs may be in the set; a null isn't."""
    at = _bit(ids.fill_null(0).to_numpy(zero_copy_only=False))
    return ((bits.value[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1) & ids.is_valid().to_numpy(zero_copy_only=False)


def passes(rows: DataFrame, bits, keep: bool = True) -> DataFrame:
    """The rows whose first column may be in the set; with ``keep`` false, those that surely aren't."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hit = hits(bits, batch.column(0))
            if (hit if keep else ~hit).any():
                yield batch.filter(pa.array(hit if keep else ~hit))

    return rows.mapInArrow(run, rows.schema)
