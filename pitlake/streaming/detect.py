"""Streams: idempotent detections, window volumes, latest-wins by batch, greedy clusters with state."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.listener import StreamingQueryListener
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..operators.events import supersede
from ..session import cut


def first_seen(stream: DataFrame, key: str, at: str, late: str = "7 days") -> DataFrame:
    """Each key once, however often its message is read again within the watermark."""
    return stream.withWatermark(at, late).dropDuplicatesWithinWatermark([key])


def volumes(stream: DataFrame, at: str, size: str, keys: Sequence[str] = (), late: str = "1 day") -> DataFrame:
    """Rows of each window; windows without rows are found against a calendar afterwards (``quiet_windows``)."""
    return stream.withWatermark(at, late).groupBy(F.window(at, size).alias("w"), *keys).agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("begins"), F.col("w.end").alias("ends"), *keys, "n")


def quiet_windows(counted: DataFrame, calendar: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Expected windows with their count, zero where nothing came: streams can't emit what isn't there."""
    return calendar.join(counted, ["begins", *keys], "left").withColumn("n", F.coalesce("n", F.lit(0))).withColumn("alarm", F.col("n") == 0)


def latest_wins(read: Callable[[], DataFrame], write: Callable[[DataFrame], None], group: Sequence[str], doc: str, knowable: str) -> Callable[[DataFrame, int], None]:
    """A foreachBatch function that recomputes supersession over the whole stored table, for tables that are small.

    Late and repeated documents give the same table in any order, so a replayed batch is harmless.
    Larger tables take ``LatestWins``, which reads and writes only what a batch touches.
    """

    def batch(rows: DataFrame, _: int) -> None:
        stored = read()
        base = [c for c in rows.columns if c not in ("superseded", "supersedes_doc")]
        old = stored.select(*base)
        every = old.join(rows.select(doc).distinct(), doc, "left_anti").unionByName(rows.select(*base)).select(*base)
        write(supersede(every.dropDuplicates(), group, doc, knowable))

    return batch


class LatestWins:
    """A stored table in buckets of its groups; ``batch`` is a foreachBatch function that replaces the touched ones.

    A batch touches the groups of its rows and those that hold its documents now.  The rows of their
    buckets are read, superseded anew and written under the batch's own number; a mark then makes the
    new buckets count.  So a reader sees a batch whole or not at all, and a repeated batch gives the same.
    ``vacuum`` removes buckets that newer ones replaced.
    """

    def __init__(self, spark: SparkSession, path: str, schema: str, group: Sequence[str], doc: str, knowable: str, buckets: int = 256):
        self.spark, self.path, self.schema, self.group, self.doc, self.knowable, self.buckets = spark, path.rstrip("/"), schema, list(group), doc, knowable, buckets

    def _names(self, path: str) -> list[str]:
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        fs = p.getFileSystem(self.spark._jsc.hadoopConfiguration())
        return [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []

    def _current(self) -> dict[int, int]:
        """Bucket -> the newest batch that wrote it and is marked."""
        out: dict[int, int] = {}
        for batch in sorted(int(n[6:]) for n in self._names(self.path) if n.startswith("ready=")):
            out |= {int(n[7:]): batch for n in self._names(f"{self.path}/batch={batch}") if n.startswith("bucket=")}
        return out

    def _read(self, buckets: dict[int, int]) -> DataFrame:
        if not buckets:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*(f"{self.path}/batch={b}/bucket={k}" for k, b in sorted(buckets.items())))

    def table(self) -> DataFrame:
        return self._read(self._current())

    def _bucket(self):
        return F.pmod(F.xxhash64(*self.group), F.lit(self.buckets))

    def batch(self, rows: DataFrame, number: int) -> None:
        if f"ready={number}" in self._names(self.path):
            return  # the batch is repeated
        base = [c for c in self.table().columns if c not in ("superseded", "supersedes_doc")]
        rows = cut(rows.select(*base))
        held = self._current()
        moved = self._read(held).select(*self.group, self.doc).join(rows.select(self.doc).distinct(), self.doc, "left_semi")
        touched = [r[0] for r in rows.select(self._bucket()).union(moved.select(self._bucket())).distinct().collect()]  # as many as there are buckets at most
        old = self._read({k: b for k, b in held.items() if k in touched}).select(*base)
        every = old.join(rows.select(self.doc).distinct(), self.doc, "left_anti").unionByName(rows).dropDuplicates()
        out = f"{self.path}/batch={number}"
        supersede(every, self.group, self.doc, self.knowable).withColumn("bucket", self._bucket()).write.mode("overwrite").partitionBy("bucket").parquet(out)
        p = self.spark._jvm.org.apache.hadoop.fs.Path(out)
        fs = p.getFileSystem(self.spark._jsc.hadoopConfiguration())
        for k in touched:  # a bucket whose last rows moved away is empty now
            fs.mkdirs(self.spark._jvm.org.apache.hadoop.fs.Path(f"{out}/bucket={k}"))
        fs.create(self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/ready={number}"), True).close()

    def vacuum(self) -> int:
        """Remove replaced buckets; nobody may be reading them."""
        held, n = self._current(), 0
        for name in self._names(self.path):
            for inner in self._names(f"{self.path}/{name}") if name.startswith("batch=") else ():
                if inner.startswith("bucket=") and held.get(int(inner[7:]), -1) > int(name[6:]):
                    p = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}/{inner}")
                    n += p.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(p, True)
        return n


class Heartbeat(StreamingQueryListener):
    """Hands each sign of life of a stream to ``write``: a dictionary of name, batch, at, rows, watermark and event.

    Runs without rows count too, so silence means that nothing runs, not that nothing came.
    """

    def __init__(self, write: Callable[[dict], None]):
        self.write = write

    def onQueryStarted(self, event) -> None:
        self.write({"name": event.name, "batch": None, "at": event.timestamp, "rows": 0, "watermark": None, "event": "started"})

    def onQueryProgress(self, event) -> None:
        p = event.progress
        self.write({"name": p.name, "batch": p.batchId, "at": p.timestamp, "rows": p.numInputRows, "watermark": (p.eventTime or {}).get("watermark"), "event": "progress"})

    def onQueryIdle(self, event) -> None:
        self.write({"name": str(event.id), "batch": None, "at": event.timestamp, "rows": 0, "watermark": None, "event": "idle"})

    def onQueryTerminated(self, event) -> None:
        self.write({"name": str(event.id), "batch": None, "at": None, "rows": 0, "watermark": None, "event": "failed" if event.exception else "ended"})


def silent(beats: DataFrame, expected: DataFrame, now, minutes: int) -> DataFrame:
    """The expected streams (name) whose last beat (name, at) is older than some minutes, or that have none."""
    last = beats.groupBy("name").agg(F.max(F.col("at").cast("timestamp")).alias("last"))
    late = F.col("last").isNull() | (F.col("last") < now - F.make_interval(mins=F.lit(minutes)))
    return expected.join(last, "name", "left").where(late)


CLUSTERS = "entity long, window_start date, window_end date, n_persons long"
_STATE = "days array<int>, people array<long>"


def cluster_stream(stream: DataFrame, entity: str, at: str, person: str, days: int = 30, least: int = 2, late: str = "1 day") -> DataFrame:
    """Greedy anchored windows of each entity as a stream.

    An entity's state is its rows since the end of the last window it gave out; a window leaves
    when the watermark has passed it, so late rows within the watermark still count.
    """

    def run(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        held = list(zip(*state.get)) if state.exists else []
        for batch in batches:
            held += [(int(d), int(p)) for d, p in zip(batch["day"], batch["person"])]
        held.sort()
        done = state.getCurrentWatermarkMs() // 86_400_000
        out, i = [], 0
        while i < len(held) and held[i][0] + days < done:
            inside = [h for h in held[i:] if h[0] - held[i][0] <= days]
            people = {p for _, p in inside}
            if len(people) >= least:
                out.append((key[0], held[i][0], inside[-1][0], len(people)))
                i += len(inside)
            else:
                i += 1
        held = held[i:]
        if held:
            state.update(([d for d, _ in held], [p for _, p in held]))
            state.setTimeoutTimestamp(max((held[0][0] + days + 1) * 86_400_000, state.getCurrentWatermarkMs() + 1))
        elif state.exists:
            state.remove()
        day = lambda n: (pd.Timestamp(0) + pd.Timedelta(days=n)).date()
        yield pd.DataFrame([(e, day(a), day(b), n) for e, a, b, n in out], columns=["entity", "window_start", "window_end", "n_persons"])

    rows = stream.withWatermark(at, late).select(F.col(entity).cast("long").alias("entity"), F.col(at).alias("at"), F.unix_date(F.to_date(F.col(at))).alias("day"), F.col(person).cast("long").alias("person"))
    return rows.groupBy("entity").applyInPandasWithState(run, CLUSTERS, _STATE, "append", GroupStateTimeout.EventTimeTimeout)
