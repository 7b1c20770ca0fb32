"""Exact substring deduplication by a common-prefix-aware distributed merge sort of suffixes.

A byte goes if it lies in a string of ``LENGTH`` bytes that also starts earlier
(smaller doc_id, or the same document and an earlier start).

1. Anchors.  Of the hashes of all ``GRAM``-byte grams in a window of LENGTH
   bytes the smallest is an anchor.  The choice depends on the window's bytes
   alone, so two equal windows have an anchor at the same place: only suffixes
   that start at anchors need sorting.  Anchors whose hash occurs once in the
   corpus can't repeat and go (the distinguishing-prefix step of distributed
   string sorting); the hashes are exchanged without their text.  A hash that
   repeats among ``CHUNK`` anchors of a task is settled there, and one of its
   anchors stands for all, so a common gram sends a row a chunk, not all.
2. Runs.  Each task sorts the suffixes of its anchors: LENGTH bytes onwards,
   then, to tell equal ones apart, the LENGTH bytes before, backwards.  Equal
   ones in a task are settled there but for the earliest.  The sorted run is
   cut by the hash of the first GRAM bytes and front-coded: for each suffix how
   many bytes it shares with the one before it, and the rest.
3. Merge.  There are as many receivers as the anchors' bytes ask for
   (``RECEIVED`` suffixes each).  Each merges its runs with a loser tree whose nodes
   know how many bytes a candidate shares with the last winner; candidates that
   share different numbers are ordered without reading a byte, others compared
   from the first unknown byte on.  The merge yields the common prefixes again.
4. Windows.  From the sorted order and its common prefixes, forwards and
   backwards, every window of an anchor gets the class of equal windows; all
   but the earliest of a class go.  No hash decides here.

Anchors' hashes, front-coded runs and removed spans are exchanged; the texts of
documents without repeated anchors never are.

Defined results: null and empty texts have no bytes; rows that repeat a doc_id
are one document, of which the longest text counts (of equal ones the greatest);
rows with a null doc_id are left whole and compared with nothing.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import U64, Scratch, few, mix, parts_of, release, short_batches, table
from .idfilter import hits, id_filter, passes

LENGTH = 100
GRAM = 32
#: Suffixes in one run of a task.
RUN = 30_000
#: Anchors in which a task looks for repeats of its own.
CHUNK = 500_000
#: Input bytes (compressed) for each partition that hashes are dealt to, and suffixes for each receiver.
DEALT_BYTES = 16 << 20
RECEIVED = 250_000
_POSITION = 24  # bits of a position that go with 40 bits of hash; longer texts have parts
_BASE = 0x9E3779B97F4A7C15 | 1
_BYTES = mix(np.arange(256, dtype=U64) * U64(0xD6E8FEB86659FD93) + U64(0x5851F42D4C957F2D))


class _Powers:
    """Powers of the base and of its inverse modulo 2**64."""

    def __init__(self):
        self.up = self.down = np.ones(1, dtype=U64)

    def need(self, n: int) -> None:
        if len(self.up) < n:
            n = max(n, 2 * len(self.up), 1 << 16)
            inverse = pow(_BASE, -1, 1 << 64)
            self.up = np.concatenate(([U64(1)], np.full(n - 1, _BASE, dtype=U64))).cumprod(dtype=U64)
            self.down = np.concatenate(([U64(1)], np.full(n - 1, inverse, dtype=U64))).cumprod(dtype=U64)


_POWERS = _Powers()


def gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """A 64-bit hash of each ``gram`` bytes (uint8 array); depends on the bytes alone."""
    n = len(data)
    if n < gram:
        return np.zeros(0, dtype=U64)
    _POWERS.need(n)
    sums = _BYTES[data] * _POWERS.up[:n]
    np.cumsum(sums, out=sums)
    out = sums[gram - 1 :].copy()
    out[1:] -= sums[:-gram]
    out *= _POWERS.down[: len(out)]
    return mix(out)


def _slide(x: np.ndarray, width: int, op) -> np.ndarray:
    """``op`` over each ``width`` neighbours, by doubling."""
    have = 1
    while 2 * have <= width:
        x = op(x[:-have], x[have:])
        have *= 2
    return op(x[: len(x) - (width - have)], x[width - have :]) if have < width else x


def anchors(data: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions and hashes of the grams that are smallest in some window of ``length`` bytes."""
    if len(data) < length:
        return np.zeros(0, np.int64), np.zeros(0, U64)
    hashes = gram_hashes(data, gram)
    order = (hashes >> U64(32)).astype(np.uint32)
    width = length - gram + 1
    least = _slide(order, width, np.minimum)
    # a gram is chosen if the largest of the minima of the windows around it is its own
    edge = np.zeros(width - 1, dtype=np.uint32)
    best = _slide(np.concatenate((edge, least, edge)), width, np.maximum)
    at = np.flatnonzero(best == order)
    return at, hashes[at]


def _bytes(text: str | None) -> bytes:
    return text.encode("utf-8", "surrogatepass") if text else b""


def _repeats(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of each distinct hash's first, which of these have others, and the places of the others."""
    order = np.argsort(hashes, kind="stable")
    same = hashes[order[1:]] == hashes[order[:-1]]
    first = np.append(True, ~same)[: len(order)]
    starts = np.flatnonzero(first)
    many = np.diff(np.append(starts, len(order))) > 1
    return order[first], many, order[~first]


def anchor_rows(docs: DataFrame, length: int, gram: int) -> DataFrame:
    """doc_id, part, key (40 bits of an anchor's hash and 24 of its position), state, deal.

    state: 0 the only anchor of its hash in a chunk of a task, 1 one that stands for several, 2 another of them,
    which needs no comparison any more and is dealt by its place.
    """
    low = (1 << _POSITION) - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out() -> pa.RecordBatch:
            doc, part, key = (np.concatenate(x) for x in zip(*held))
            first, many, others = _repeats(key >> U64(_POSITION))
            at = np.concatenate((first, others))
            state = np.concatenate((many.astype(np.int8), np.full(len(others), 2, dtype=np.int8)))
            key = key[at]
            deal = np.where(state == 2, mix(key + doc[at].astype(U64)), key) >> U64(_POSITION)
            return pa.RecordBatch.from_arrays([pa.array(doc[at]), pa.array(part[at]), pa.array(key.view(np.int64)), pa.array(state), pa.array(deal.view(np.int64))], names=["doc_id", "part", "key", "state", "deal"])

        held, size = [], 0
        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                at, hashes = anchors(np.frombuffer(_bytes(text), np.uint8), length, gram)
                if len(at):
                    held.append((np.full(len(at), doc, dtype=np.int64), (at >> _POSITION).astype(np.int32), (hashes & ~U64(low)) | (at & low).astype(U64)))
                    size += len(at)
                    if size >= CHUNK:
                        yield out()
                        held, size = [], 0
        if size:
            yield out()

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, part int, key long, state tinyint, deal long")


def repeated_anchors(rows: DataFrame, parts: int) -> DataFrame:
    """doc_id, at: the anchors whose hash occurs again.  A task looks through the hashes it was dealt."""
    low = (1 << _POSITION) - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = []

        def found(doc: np.ndarray, part: np.ndarray, key: np.ndarray) -> Iterator[pa.RecordBatch]:
            at = (part.astype(np.int64) << _POSITION) | (key & low)
            for i in range(0, len(doc), 100_000):
                yield pa.RecordBatch.from_arrays([pa.array(doc[i : i + 100_000]), pa.array(at[i : i + 100_000])], names=["doc_id", "at"])

        for batch in batches:
            doc, part, key, state = (batch.column(i).to_numpy() for i in range(4))
            settled = state == 2
            yield from found(doc[settled], part[settled], key[settled])
            held.append(tuple(x[~settled] for x in (doc, part, key, state)))
        if held:
            doc, part, key, state = (np.concatenate(x) for x in zip(*held))
            held.clear()
            first, many, others = _repeats(key.view(U64) >> U64(_POSITION))
            again = np.concatenate((first[many | (state[first] == 1)], others))
            yield from found(doc[again], part[again], key[again])

    return rows.repartition(parts, "deal").select("doc_id", "part", "key", "state").mapInArrow(run, "doc_id long, at long")


# ---------------------------------------------------------------- runs


def contexts(data: np.ndarray, at: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each anchor its ``length`` bytes onwards and those before, backwards, as one row; how many of each there are."""
    padded = np.zeros(len(data) + 2 * length, dtype=np.uint8)
    padded[length : length + len(data)] = data
    around = np.lib.stride_tricks.sliding_window_view(padded, 2 * length)[at]
    return np.concatenate((around[:, length:], around[:, length - 1 :: -1]), axis=1), np.minimum(at, length), np.minimum(len(data) - at, length)


def common_prefixes(rows: np.ndarray) -> np.ndarray:
    """How many bytes each row of a sorted matrix shares with the one before it; 0 for the first."""
    out = np.zeros(len(rows), dtype=np.int64)
    for i in range(1, len(rows), 65536):
        j = min(i + 65536, len(rows))
        other = rows[i:j] != rows[i - 1 : j - 1]
        out[i:j] = np.where(other.any(axis=1), other.argmax(axis=1), rows.shape[1])
    return out


def sort_rows(rows: np.ndarray) -> np.ndarray:
    """The order of the rows as byte strings; equal ones stay in order."""
    words = np.ascontiguousarray(rows).view(">u8").astype(U64)
    # the first words nearly always decide; ties go on to the next ones
    order = np.argsort(words[:, 0], kind="stable")
    word, ties = 0, np.ones(len(rows), dtype=bool)
    group = np.zeros(len(rows), dtype=np.int64)
    while word + 1 < words.shape[1] and ties.any():
        v = words[order, word]
        new = np.append(True, (v[1:] != v[:-1]) | (group[1:] != group[:-1])) if len(v) else np.zeros(0, bool)
        group = np.cumsum(new)
        alone = new & np.append(new[1:], True)
        ties = ~alone
        word += 1
        some = np.flatnonzero(ties)
        if len(some):
            again = np.lexsort((words[order[some], word], group[some]))
            order[some] = order[some][again]
    return order


def encode_run(rows: np.ndarray, shared: np.ndarray) -> bytes:
    """Front coding: the shared lengths, then the bytes that aren't shared; compressed."""
    shared = shared.copy()
    if len(shared):
        shared[0] = 0
    rest = rows[np.arange(rows.shape[1])[None, :] >= shared[:, None]]
    coded = shared.astype("<u2").tobytes() + rest.tobytes()
    return len(coded).to_bytes(8, "little") + pa.compress(coded, codec="zstd", asbytes=True)


def decode_run(data: bytes, n: int, width: int) -> Iterator[tuple[int, bytes]]:
    """(bytes shared with the one before, whole suffix)."""
    data = pa.decompress(data[8:], decompressed_size=int.from_bytes(data[:8], "little"), codec="zstd", asbytes=True)
    at, last = 2 * n, b""
    for shared in np.frombuffer(data, "<u2", n).tolist():
        end = at + width - shared
        last = last[:shared] + data[at:end]
        at = end
        yield shared, last


class LoserTree:
    """Merges sorted runs of (shared with the one before, string); yields (shared with the last winner, string, run).

    A node keeps the loser of its match with the number of bytes the loser shares with the
    match's winner.  Two candidates that share different numbers with the last winner are in
    order already: the one that shares more is smaller, and what the other shares with it is
    what it shared before.  Only equal numbers lead to a comparison, which starts behind them.
    """

    def __init__(self, runs: list[Iterator[tuple[int, bytes]]], width: int):
        self.width = width
        self.runs = runs
        size = 1
        while size < max(1, len(runs)):
            size *= 2
        self.size = size
        self.compared = 0

    def _match(self, a, b):
        """Winner and loser of two candidates [shared, string, run], the loser's shared set to the winner's."""
        if a is None:
            return b, a
        if b is None:
            return a, b
        if a[0] != b[0]:
            return (a, b) if a[0] > b[0] else (b, a)
        x, y, known = a[1], b[1], a[0]
        self.compared += 1
        if x == y:
            shared = self.width
        else:
            x, y = int.from_bytes(x[known:]), int.from_bytes(y[known:])
            shared = self.width - ((x ^ y).bit_length() + 7) // 8
        if x < y or (x == y and a[2] < b[2]):
            b[0] = shared
            return a, b
        a[0] = shared
        return b, a

    def _next(self, run: int):
        if run >= len(self.runs):
            return None
        found = next(self.runs[run], None)
        return None if found is None else [found[0], found[1], run]

    def __iter__(self):
        size, losers = self.size, [None] * self.size
        winners = [None] * size + [self._next(i) for i in range(size)]
        for c in winners[size:]:
            if c is not None:
                c[0] = 0
        for node in range(size - 1, 0, -1):
            winners[node], losers[node] = self._match(winners[2 * node], winners[2 * node + 1])
        best = winners[1]
        match, following = self._match, self._next
        while best is not None:
            yield best[0], best[1], best[2]
            node = (best[2] + size) // 2
            best = following(best[2])
            while node:
                rival = losers[node]
                if rival is not None:
                    best, losers[node] = match(best, rival)
                node //= 2


# ---------------------------------------------------------------- windows


def _spans(doc: np.ndarray, at: np.ndarray, before: np.ndarray, after: np.ndarray, length: int) -> pa.RecordBatch | None:
    use = before + after >= length
    if not use.any():
        return None
    return pa.RecordBatch.from_arrays([pa.array(doc[use]), pa.array((at - before)[use]), pa.array((at + after)[use])], names=["doc_id", "begin", "stop"])


def repeated_windows(rows: np.ndarray, shared: np.ndarray, doc: np.ndarray, at: np.ndarray, before: np.ndarray, after: np.ndarray, length: int) -> Iterator[pa.RecordBatch]:
    """Removed spans of sorted, distinct contexts: of the equal windows of an anchor all but the earliest."""
    n = len(rows)
    backwards = rows[:, length:]
    order = sort_rows(np.ascontiguousarray(np.pad(backwards, ((0, 0), (0, -length % 8)))))
    back_shared = common_prefixes(backwards[order])
    rank = np.lexsort((at, doc))
    earliest = np.empty(n, dtype=np.int64)
    earliest[rank] = np.arange(n)
    back_class = np.empty(n, dtype=np.int64)
    gone = np.zeros((n, length + 1), dtype=bool)
    for lead in range(length + 1):  # bytes of the window before the anchor
        use = np.flatnonzero((before >= lead) & (after >= length - lead))
        if not len(use):
            continue
        front = np.cumsum(shared < length - lead)
        back_class[order] = np.cumsum(back_shared < lead)
        key = front[use] * (n + 1) + back_class[use]
        by = np.lexsort((earliest[use], key))
        key = key[by]
        gone[use[by[1:]][key[1:] == key[:-1]], lead] = True
    # windows next to each other are one span
    edges = np.diff(np.pad(gone, ((0, 0), (1, 1))).astype(np.int8), axis=1)
    row, first = np.nonzero(edges == 1)
    _, last = np.nonzero(edges == -1)
    if len(row):
        yield pa.RecordBatch.from_arrays([pa.array(doc[row]), pa.array(at[row] - (last - 1)), pa.array(at[row] - first + length)], names=["doc_id", "begin", "stop"])


def _settle_equal(rows: np.ndarray, shared: np.ndarray, doc, at, before, after) -> tuple[np.ndarray, np.ndarray]:
    """Of sorted contexts: which are the earliest of their equals, and which aren't."""
    n = len(rows)
    same = np.append(False, (shared[1:] == rows.shape[1]) & (before[1:] == before[:-1]) & (after[1:] == after[:-1])) if n else np.zeros(0, bool)
    group = np.cumsum(~same)
    order = np.lexsort((at, doc, group))
    first = np.append(True, group[order][1:] != group[order][:-1]) if n else np.zeros(0, bool)
    # one occurrence that came twice isn't earlier than itself
    return np.sort(order[first]), order[~first]


_SPAN = "doc_id long, begin long, stop long"
_RUN = "to int, n int, run binary, doc_ids binary, ats binary, befores binary, afters binary"


def sorted_runs(marked: DataFrame, receivers: int, length: int, gram: int) -> DataFrame:
    """``marked``: doc_id, text, ats.  Front-coded sorted runs for each receiver, and spans settled already (n is negative)."""

    def flush(held: list) -> Iterator[dict]:
        rows, before, after, at, doc = (np.concatenate(x) for x in zip(*held))
        # rank in the order of bytes; of equal strings those of equal lengths stay together
        order = sort_rows(np.concatenate((rows, before[:, None].astype(np.uint8), after[:, None].astype(np.uint8), np.zeros((len(rows), -(rows.shape[1] + 2) % 8), np.uint8)), axis=1))
        rows, before, after, at, doc = rows[order], before[order], after[order], at[order], doc[order]
        first, later = _settle_equal(rows, common_prefixes(rows), doc, at, before, after)
        spans = _spans(doc[later], at[later], before[later], after[later], length)
        if spans is not None:
            yield {"to": len(rows) % receivers, "n": -spans.num_rows, "run": b"", "doc_ids": spans["doc_id"].to_numpy().tobytes(), "ats": b"", "befores": spans["begin"].to_numpy().tobytes(), "afters": spans["stop"].to_numpy().tobytes()}
        rows, before, after, at, doc = rows[first], before[first], after[first], at[first], doc[first]
        if not len(rows):
            return
        head = np.ascontiguousarray(rows[:, :gram]).view("<u8")
        mixed = np.zeros(len(rows), dtype=U64)
        for k in range(head.shape[1]):
            mixed = mix(mixed * U64(_BASE) + head[:, k])
        to = (mixed % U64(receivers)).astype(np.int64)
        for r in np.unique(to):
            some = np.flatnonzero(to == r)
            own = rows[some]
            yield {"to": int(r), "n": len(some), "run": encode_run(own, common_prefixes(own)), "doc_ids": doc[some].tobytes(), "ats": at[some].tobytes(), "befores": before[some].astype("<u1").tobytes(), "afters": after[some].astype("<u1").tobytes()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("to", pa.int32()), ("n", pa.int32()), *((c, pa.binary()) for c in ("run", "doc_ids", "ats", "befores", "afters"))])
        held, size = [], 0
        for batch in batches:
            for doc, text, ats in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                data = np.frombuffer(_bytes(text), np.uint8)
                at = np.unique(ats.values.to_numpy())
                at = at[at <= len(data) - gram]
                for i in range(0, len(at), RUN):
                    some = at[i : i + RUN]
                    rows, before, after = contexts(data, some, length)
                    held.append((rows, before, after, some, np.full(len(some), doc, dtype=np.int64)))
                    size += len(some)
                    if size >= RUN:
                        yield pa.RecordBatch.from_pylist(list(flush(held)), schema=schema)
                        held, size = [], 0
        if size:
            yield pa.RecordBatch.from_pylist(list(flush(held)), schema=schema)

    return marked.select("doc_id", "text", "ats").mapInArrow(run, _RUN)


def merged_spans(runs: DataFrame, receivers: int, length: int, gram: int) -> DataFrame:
    """Removed spans: each receiver merges its runs and tells the windows that came earlier."""
    width = 2 * length

    def settle(held: list[tuple]) -> Iterator[pa.RecordBatch]:
        total = sum(h[0] for h in held)
        source = [decode_run(h[1], h[0], width) for h in held]
        rows, shared, place, taken = bytearray(), np.zeros(total, np.int64), np.zeros(total, np.int64), [0] * len(held)
        starts = np.cumsum([0, *(h[0] for h in held)]).tolist()
        for i, (common, string, run) in enumerate(LoserTree(source, width)):
            rows += string
            shared[i] = common
            place[i] = starts[run] + taken[run]
            taken[run] += 1
        rows = np.frombuffer(rows, np.uint8).reshape(total, width)
        doc, at = (np.concatenate([np.frombuffer(h[k], "<i8") for h in held])[place] for k in (2, 3))
        before, after = (np.concatenate([np.frombuffer(h[k], "<u1") for h in held])[place].astype(np.int64) for k in (4, 5))
        # equal strings of unequal lengths may alternate: bring equals together
        string = np.cumsum(shared < width)
        again = np.lexsort((after, before, string))
        rows, doc, at, before, after = rows[again], doc[again], at[again], before[again], after[again]
        first, later = _settle_equal(rows, shared, doc, at, before, after)
        spans = _spans(doc[later], at[later], before[later], after[later], length)
        if spans is not None:
            yield spans
        # the common prefix of two that stay is the least of those between them
        lcp = np.minimum.reduceat(shared, np.append(0, first[:-1] + 1)) if len(first) else shared[:0]
        lcp = lcp if len(first) == 0 else np.append(0, lcp[1:])
        near = lcp >= gram
        many = near | np.append(near[1:], False)
        use = first[many]
        if len(use):
            kept = np.where(near[many], lcp[many], 0)
            yield from repeated_windows(rows[use], kept, doc[use], at[use], before[use], after[use], length)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, to = [], None
        for batch in batches:
            for row in batch.to_pylist():
                if row["n"] < 0:
                    yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(row[c], "<i8")) for c in ("doc_ids", "befores", "afters")], names=["doc_id", "begin", "stop"])
                    continue
                if row["to"] != to:
                    if held:
                        yield from settle(held)
                    held, to = [], row["to"]
                held.append((row["n"], row["run"], row["doc_ids"], row["ats"], row["befores"], row["afters"]))
        if held:
            yield from settle(held)

    return runs.repartition(receivers, "to").sortWithinPartitions("to").mapInArrow(run, _SPAN)


def merge_spans(spans: DataFrame) -> DataFrame:
    """doc_id, spans: the maximal runs of removed bytes of each document, in order."""
    order = Window.partitionBy("doc_id").orderBy("begin", "stop")
    known = spans.withColumn("reach", F.max("stop").over(order.rowsBetween(Window.unboundedPreceding, -1)))
    begins = known.withColumn("new", F.when(F.col("reach").isNull() | (F.col("begin") > F.col("reach")), 1).otherwise(0))
    numbered = begins.withColumn("nr", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    merged = numbered.groupBy("doc_id", "nr").agg(F.min("begin").alias("begin"), F.max("stop").alias("stop"))
    return merged.groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("begin", "stop"))).alias("spans"))


def removed_spans(docs: DataFrame, scratch: Scratch, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """doc_id, spans (begin, stop in bytes) of the documents (unique doc_ids) that lose something."""
    spark = docs.sparkSession
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    marks = repeated_anchors(anchor_rows(docs, length, gram), max(least, parts_of(docs, DEALT_BYTES))).groupBy("doc_id").agg(F.collect_list("at").alias("ats"))
    marks = scratch.stage(marks, "marks")
    receivers = max(least, -(-(marks.agg(F.sum(F.size("ats"))).first()[0] or 0) // RECEIVED))
    some = id_filter(marks, "doc_id")
    release(spark)
    runs = sorted_runs(passes(docs.select("doc_id", "text"), some).join(marks, "doc_id"), receivers, length, gram)
    out = scratch.stage(merge_spans(merged_spans(runs, receivers, length, gram)), "spans")
    scratch.drop("marks")
    del runs
    release(spark)
    return out


def _one_each(docs: DataFrame) -> DataFrame:
    """doc_id (not null) and text, one row for each doc_id."""
    docs = docs.where(F.col("doc_id").isNotNull()).select("doc_id", "text")
    if docs.groupBy("doc_id").count().where("count > 1").isEmpty():
        return docs
    text = F.coalesce("text", F.lit(""))
    return docs.groupBy("doc_id").agg(F.max_by("text", F.struct(F.octet_length(text), text)).alias("text"))


def _kept(data: bytes, spans) -> bytes:
    out, at = [], 0
    for span in spans or ():
        out.append(data[at : span["begin"]])
        at = span["stop"]
    out.append(data[at:])
    return b"".join(out)


_DIGEST = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def _digest(docs: DataFrame, bits=None) -> DataFrame:
    """``docs``: doc_id, text, spans; with ``bits`` only the rows that surely aren't in that set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if bits is not None:
                batch = batch.filter(pa.array(~hits(bits, batch.column(0))))
            rows = []
            for doc, text, spans in zip(*(batch.column(i).to_pylist() for i in range(3))):
                data = _bytes(text)
                kept = _kept(data, spans)
                rows.append((doc, len(data), len(data) - len(kept), len(spans or ()), hashlib.sha256(kept).hexdigest()))
            if rows:
                kinds = [pa.int64()] * 4 + [pa.string()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=[c.split()[0] for c in _DIGEST.split(", ")])

    return docs.select("doc_id", "text", "spans").mapInArrow(run, _DIGEST)


def deduplicate(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """doc_id and text without its removed bytes (a character that loses a byte becomes U+FFFD)."""
    scratch = Scratch(docs.sparkSession, "suffix")
    short_batches(docs.sparkSession)
    one = _one_each(docs)
    spans = removed_spans(one, scratch, length, gram)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [_kept(_bytes(t), s).decode("utf-8", "replace") if s else t for t, s in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return one.join(spans, "doc_id", "left").select("doc_id", "text", "spans").mapInArrow(run, "doc_id long, text string").unionByName(docs.where("doc_id is null").select("doc_id", "text"))


def digests(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """What is left of each document, in digests."""
    scratch = Scratch(docs.sparkSession, "suffix")
    short_batches(docs.sparkSession)
    one = _one_each(docs)
    spans = removed_spans(one, scratch, length, gram)
    some = id_filter(spans, "doc_id")
    none = F.lit(None).cast(spans.schema["spans"].dataType)
    whole = one.withColumn("spans", none)
    cut = passes(one, some).join(spans, "doc_id", "left")
    nameless = docs.where("doc_id is null").select("doc_id", "text").withColumn("spans", none)
    return _digest(whole, some).unionByName(_digest(cut)).unionByName(_digest(nameless))


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return few(digests(table(spark, sf_dir, "documents")))
