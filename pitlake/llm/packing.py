"""Packing by sum of squares.

Each document goes, as it arrives, to the fill level at which placing it
leaves the smallest sum over levels of the squared number of partially filled
windows at that level (Csirik et al., "On the sum-of-squares algorithm for bin
packing").  The counts are kept in one array with an entry for each level, so
a placement is one vector subtraction and one argmin over the capacity.

A document longer than a window first fills whole windows; its rest is placed.
Every partition packs alone, streaming: closed windows leave at once.  Windows
that are still open at its end are poured together, cutting a document wherever
a window is full, so a partition pads one window at most.  The more documents a
partition has, the more windows are closed by the method, so partitions of less
than ``PART_BYTES`` of input are put together.  Open windows can't be more than
what a partition holds; ids in them take two bytes where the vocabulary allows.
``max_open`` bounds them, if it is given, by pouring earlier.

Defined results: null text is empty (its end id alone); repeated doc_ids are
packed each on their own; null doc_ids stay null; an empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import parts_of, short_batches, table
from .tokens import default_vocabulary, encoder

CAPACITY = 2048
#: Bytes of input (compressed) that a partition has at least, if there are that many.
PART_BYTES = 16 << 20

SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


class LevelArray:
    """Open windows by fill level and the cost of every placement."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        # taking a window from level h lowers the sum of squares by 2 n[h] - 1; level 0 is a new window
        self.gain = np.full(capacity + 1, -(2**40), dtype=np.int64)
        self.gain[0] = 0
        # a window that arrives at level l raises it by 2 n[l] + 1; a full window counts no more
        self.pay = np.ones(capacity + 1, dtype=np.int64)
        self.pay[capacity] = 0
        self.windows: list[list] = [[] for _ in range(capacity + 1)]
        self.open = 0

    def _set(self, level: int) -> None:
        n = len(self.windows[level])
        self.gain[level] = 2 * n - 1 if n else -(2**40)
        self.pay[level] = 2 * n + 1

    def place(self, piece, size: int) -> list | None:
        """Put a piece of ``size`` ids into a window; the window, if that fills it."""
        room = self.capacity - size
        cost = self.pay[size:] - self.gain[: room + 1]
        level = room - int(cost[::-1].argmin())  # of equal costs the fullest window
        if level:
            window = self.windows[level].pop()
            self.open -= 1
            self._set(level)
        else:
            window = []
        window.append(piece)
        if level + size == self.capacity:
            return window
        self.windows[level + size].append(window)
        self.open += 1
        self._set(level + size)
        return None

    def drain(self) -> Iterator[list]:
        """All open windows, the fullest first; none is left."""
        for level in range(self.capacity - 1, 0, -1):
            windows, self.windows[level] = self.windows[level], []
            if windows:
                self._set(level)
                yield from windows
        self.open = 0


def pour(windows: Iterator[list], capacity: int, width: int = 4) -> Iterator[list]:
    """Windows filled without gaps from the pieces of others; pieces are cut where a window is full.  ``width``: bytes an id."""
    out, room = [], capacity
    for window in windows:
        for doc, start, payload, total in window:
            while payload:
                head, payload = payload[: width * room], payload[width * room :]
                out.append((doc, start, head, total))
                start += len(head) // width
                room -= len(head) // width
                if not room:
                    yield out
                    out, room = [], capacity
    if out:
        yield out


def windows_of(pieces: Iterator[tuple], capacity: int = CAPACITY, max_open: int | None = None, width: int = 4) -> Iterator[list]:
    """``pieces``: (key, payload of ``width`` bytes an id) of whole documents; yields windows of (key, start, payload, total)."""
    levels = LevelArray(capacity)
    for doc, payload in pieces:
        total = len(payload) // width
        start = 0
        while total - start >= capacity:
            yield [(doc, start, payload[width * start : width * (start + capacity)], total)]
            start += capacity
        if start < total:
            full = levels.place((doc, start, payload[width * start :], total), total - start)
            if full:
                yield full
        if max_open is not None and levels.open > max_open:
            yield from pour(levels.drain(), capacity, width)
    yield from pour(levels.drain(), capacity, width)


def pack(docs: DataFrame, capacity: int = CAPACITY, end_id: int = 1, vocabulary: str | None = None, max_open: int | None = None, part_bytes: int = PART_BYTES) -> DataFrame:
    """One row for each piece of each document.  ``sequence_id`` is the partition's number in the high bits."""
    vocabulary = vocabulary or default_vocabulary()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary)
        kind = "<u2" if max(encode.library.get_vocab_size(), end_id + 1) <= 1 << 16 else "<u4"
        width = np.dtype(kind).itemsize
        end = np.array([end_id], dtype=kind).tobytes()
        sequence = None

        def documents():
            nonlocal sequence
            for batch in batches:
                if sequence is None and batch.num_rows:
                    sequence = batch.column(2)[0].as_py() << 32
                for doc, payload in zip(batch.column(0).to_pylist(), encode.payloads(batch.column(1).to_pylist())):
                    yield doc, np.frombuffer(payload, "<u4").astype(kind).tobytes() + end

        rows: list[tuple] = []
        for window in windows_of(documents(), capacity, max_open, width):
            offset = 0
            for doc, start, payload, total in window:
                ids = np.frombuffer(payload, kind).astype("<u4")
                rows.append((doc, start, len(ids), zlib.crc32(ids), total, sequence, offset))
                offset += len(ids)
            sequence += 1
            if len(rows) > 20_000:
                yield _batch(rows)
                rows = []
        if rows:
            yield _batch(rows)

    short_batches(docs.sparkSession)
    docs = docs.select("doc_id", "text").coalesce(parts_of(docs, part_bytes, unknown=1 << 30))
    # the number of the partition comes with its rows: a task may hold several partitions
    return docs.select("doc_id", "text", F.spark_partition_id().alias("__part")).mapInArrow(run, SCHEMA)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    names = [c.split()[0] for c in SCHEMA.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], names=names)


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))
