"""Benchmark decontamination: which documents contain a test item.

A size-partitioned MinHash containment search.  An item is the set of its
distinct word shingles; items are partitioned by the size of that set in powers
of two.  From one hash function each item keeps the smallest values of its set,
as many as its partition needs: if a document holds ``threshold`` per cent of
the n shingles, it misses at most n - ceil(threshold n / 100), so among one
more than that it holds one at least.  No contained item can be missed, however
long the document.  Documents probe the partitions' inverted lists with their
own shingles (those under the partitions' largest kept value), partitions of
items too large for the document are skipped, and what is hit is verified by
exact shingle containment.

Items are indexed in blocks of ``ITEMS`` rows (documented bound of what is
broadcast at once); each block is searched against all documents.

Words are lower-cased and cut at ASCII punctuation.  Defined results: items
with fewer words than ``width`` are one shingle of their length; items without
words are in no document; null texts have no words; repeated rows each match.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import U64, WordHashes, loose_words, mix, shingle_set, short_batches, table

WIDTH = 5
THRESHOLD = 80  # per cent
ITEMS = 20_000
_BITS = 22

SCHEMA = "doc_id long, item_id long, n_item_shingles long, n_shared long, containment double"


def windows(words: np.ndarray, width: int) -> np.ndarray:
    """The hash of each full window; as ``common.shingles`` hashes them."""
    n = len(words) - width + 1
    if n <= 0:
        return words[:0]
    out = mix(words[:n] + U64(width))
    for k in range(1, width):
        out = mix(out * U64(0x9E3779B97F4A7C15) + words[k : n + k])
    return out


@dataclass
class Partition:
    """Items of one width and of sizes from 2**p to 2**(p + 1) - 1."""

    width: int
    least: int  # shingles that a document needs to contain any of them
    values: np.ndarray  # retained, ascending
    owners: list[np.ndarray]  # places of the items that retain each


@dataclass
class ItemIndex:
    ids: list
    sets: list[np.ndarray]
    needs: list[int]
    partitions: list[Partition]
    widths: list[int]

    @classmethod
    def build(cls, items: list[tuple], width: int = WIDTH, threshold: int = THRESHOLD) -> ItemIndex:
        hashes, ids, sets, needs, groups = WordHashes(), [], [], [], {}
        for key, text in items:
            words = hashes.of(loose_words(text))
            if not len(words):
                continue
            own = min(width, len(words))
            found = shingle_set(words, own)
            groups.setdefault((own, len(found).bit_length()), []).append(len(ids))
            ids.append(key)
            sets.append(found)
            needs.append(-(-len(found) * threshold // 100))
        partitions = []
        for (own, power), places in sorted(groups.items()):
            kept = max(len(sets[i]) - needs[i] for i in places) + 1
            value = np.concatenate([sets[i][:kept] for i in places])
            owner = np.concatenate([np.full(len(sets[i][:kept]), i) for i in places])
            order = np.argsort(value, kind="stable")
            values, start = np.unique(value[order], return_index=True)
            partitions.append(Partition(own, min(needs[i] for i in places), values, np.split(owner[order], start[1:])))
        return cls(ids, sets, needs, partitions, sorted({p.width for p in partitions}))


class Searcher:
    def __init__(self, index: ItemIndex):
        self.index, self.hashes = index, WordHashes()
        self.probe = {}
        for width in index.widths:
            of_width = [p for p in index.partitions if p.width == width]
            values = np.unique(np.concatenate([p.values for p in of_width]))
            bits = np.zeros(1 << _BITS, dtype=bool)
            bits[(mix(values) >> U64(64 - _BITS)).astype(np.int64)] = True
            self.probe[width] = of_width, values, bits

    def matches(self, texts: list[str | None]) -> Iterator[tuple[int, int, int]]:
        """(text's place, item's place, shared shingles) of every text that contains an item."""
        words = [loose_words(t) for t in texts]
        ends = np.cumsum([len(w) for w in words])
        hashed = self.hashes.of([w for some in words for w in some])
        for width, (partitions, values, bits) in self.probe.items():
            every = windows(hashed, width)
            maybe = np.flatnonzero(bits[(mix(every) >> U64(64 - _BITS)).astype(np.int64)]) if len(every) else np.zeros(0, np.int64)
            if not len(maybe):
                continue
            text = np.searchsorted(ends, maybe, side="right")
            inside = maybe + width <= ends[text]  # no window crosses into the next text
            maybe, text = maybe[inside], text[inside]
            hit = values[np.minimum(np.searchsorted(values, every[maybe]), len(values) - 1)] == every[maybe]
            maybe, text = maybe[hit], text[hit]
            for t in np.unique(text):
                begin = int(ends[t]) - len(words[t])
                own = every[begin : int(ends[t]) - width + 1]
                found, whole = every[maybe[text == t]], None
                for part in partitions:
                    if len(own) < part.least:
                        continue
                    at = np.searchsorted(part.values, found)
                    at = np.unique(at[(at < len(part.values)) & (part.values[np.minimum(at, len(part.values) - 1)] == found)])
                    if not len(at):
                        continue
                    whole = np.unique(own) if whole is None else whole
                    for item in np.unique(np.concatenate([part.owners[i] for i in at])):
                        wanted = self.index.sets[item]
                        place = np.minimum(np.searchsorted(whole, wanted), len(whole) - 1)
                        shared = int((whole[place] == wanted).sum())
                        if shared >= self.index.needs[item]:
                            yield int(t), int(item), shared


_SEARCHERS: dict[str, Searcher] = {}


def _searcher(shared, key: str) -> Searcher:
    if key not in _SEARCHERS:
        _SEARCHERS.clear()
        _SEARCHERS[key] = Searcher(shared.value)
    return _SEARCHERS[key]


def _search(docs: DataFrame, shared, key: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        searcher = _searcher(shared, key)
        index = searcher.index
        for batch in batches:
            ids = batch.column(0).to_pylist()
            rows = [(ids[t], index.ids[i], len(index.sets[i]), n, n / len(index.sets[i])) for t, i, n in searcher.matches(batch.column(1).to_pylist())]
            if rows:
                kinds = [pa.int64()] * 4 + [pa.float64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=[c.split()[0] for c in SCHEMA.split(", ")])

    return docs.select("doc_id", "text").mapInArrow(run, SCHEMA)


def _indexes(benchmark: DataFrame, width: int, threshold: int, block: int) -> Iterator:
    """The broadcast index of each block of items, with a key of its own."""
    spark = benchmark.sparkSession
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text")
    blocks = max(1, -(-items.count() // block))
    for b in range(blocks):
        some = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b) if blocks > 1 else items
        index = ItemIndex.build(sorted(((r[0], r[1]) for r in some.collect()), key=lambda r: (str(r[0]), r[1] or "")), width, threshold)
        if index.ids:
            yield spark.sparkContext.broadcast(index), f"{uuid.uuid4().hex}"


def contained_items(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH, threshold: int = THRESHOLD, block: int = ITEMS) -> DataFrame:
    """One row for each document and each item that it contains."""
    short_batches(docs.sparkSession)
    out = None
    for shared, key in _indexes(benchmark, width, threshold, block):
        part = _search(docs, shared, key)
        out = part if out is None else out.unionByName(part)
    return docs.sparkSession.createDataFrame([], SCHEMA) if out is None else out


def without_contaminated(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH, threshold: int = THRESHOLD, block: int = ITEMS) -> DataFrame:
    """The rows of ``docs`` that contain no item."""
    short_batches(docs.sparkSession)
    at = docs.columns.index("text")
    for shared, key in _indexes(benchmark, width, threshold, block):

        def run(batches: Iterator[pa.RecordBatch], shared=shared, key=key) -> Iterator[pa.RecordBatch]:
            searcher = _searcher(shared, key)
            for batch in batches:
                clean = np.ones(batch.num_rows, dtype=bool)
                for t, _, _ in searcher.matches(batch.column(at).to_pylist()):
                    clean[t] = False
                yield batch.filter(pa.array(clean))

        docs = docs.mapInArrow(run, docs.schema)
    return docs


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contained_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
