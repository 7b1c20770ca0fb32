"""Helpers shared by the operators: tables, the shared scratch folder, words and hashes."""

from __future__ import annotations

import gc
import tempfile
import uuid

import numpy as np
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows in one Arrow batch.  Documents may be long, so batches stay short.
BATCH_ROWS = 250
U64 = np.uint64


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def short_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Bound the memory of one Arrow batch sent to a Python worker, where the session leaves that to Spark.

    These settings are read when a plan runs, which is after the operator returns, so they can't
    be put back; what a session has set itself stays as it is.
    """
    own = spark._jsparkSession.sessionState().conf()
    # texts may be long in a batch of the Parquet reader too
    for key, value in (("spark.sql.execution.arrow.maxRecordsPerBatch", rows), ("spark.sql.execution.arrow.maxBytesPerBatch", 4 << 20), ("spark.sql.parquet.columnarReaderBatchSize", 512)):
        if not own.contains(key):
            spark.conf.set(key, str(value))


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``; a temporary one where it is unset and Spark runs on this machine alone."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        base = getattr(spark.sparkContext, "_pitlake_scratch", None)
        if base is None:
            if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            base = "file://" + tempfile.mkdtemp(prefix="pitlake-")
            spark.sparkContext._pitlake_scratch = base
    return base.rstrip("/")


def input_bytes(df: DataFrame) -> int | None:
    """Bytes of the files and local rows under ``df``, as its plan knows them; None where it doesn't."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())]
    return None if any(n >= 1 << 60 for n in sizes) else sum(sizes)


def parts_of(df: DataFrame, size: int, unknown: int = 1) -> int:
    """How many partitions of about ``size`` bytes of input ``df`` makes, one at least; ``unknown`` where its size isn't known."""
    total = input_bytes(df)
    return unknown if total is None else min(max(1, -(-total // size)), 1 << 30)


#: Bytes of input a task may read.
TASK_BYTES = 64 << 20


def few(df: DataFrame) -> DataFrame:
    """``df`` in no more partitions than help, as each file costs: eight for each core, a quarter of
    the shuffle partitions or one for each ``TASK_BYTES`` of its input, whichever is most."""
    spark = df.sparkSession
    return df.coalesce(max(8 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")) // 4, parts_of(df, TASK_BYTES)))


class Scratch:
    """Tables of one run, written to the shared folder so that later stages survive lost executors."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{shared_dir(spark)}/pitlake/{name}-{uuid.uuid4().hex}"

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def stage(self, df: DataFrame, name: str) -> DataFrame:
        """Write ``df`` and read it again; this cuts its lineage."""
        schema = df.schema
        few(df).write.mode("overwrite").parquet(self.path(name))
        return self.spark.read.schema(schema).parquet(self.path(name))

    def split(self, df: DataFrame, name: str, by: str, most: int) -> DataFrame:
        """Like ``stage``, in a folder for each of the ``most`` values of ``by``, which ``drop`` takes as ``name/by=value``; without sorting."""
        key = "spark.sql.maxConcurrentOutputFileWriters"
        was = self.spark.conf.get(key) if self.spark._jsparkSession.sessionState().conf().contains(key) else None
        self.spark.conf.set(key, str(most + 1))
        try:
            few(df).write.mode("overwrite").partitionBy(by).parquet(self.path(name))
        finally:
            self.spark.conf.unset(key) if was is None else self.spark.conf.set(key, was)
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def drop(self, *names: str) -> None:
        """Delete staged tables that no later result reads."""
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        for name in names:
            path = jvm.org.apache.hadoop.fs.Path(self.path(name))
            path.getFileSystem(conf).delete(path, True)


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of finished stages: it does so once their plans are garbage."""
    gc.collect()
    spark._jvm.System.gc()


class WordHashes(dict):
    """64-bit hash of each word (bytes); forgets everything when it holds too many words."""

    LIMIT = 150_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.LIMIT:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), dtype=U64, count=len(words))


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser: a bijection that spreads every bit."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def shingles(words: np.ndarray, width: int) -> np.ndarray:
    """One hash for each window of ``width`` words; fewer words are one window, no words none."""
    n = len(words)
    if n == 0:
        return words
    size = min(width, n)
    out = mix(words[: n - size + 1] + U64(size))
    for k in range(1, size):
        out = mix(out * U64(0x9E3779B97F4A7C15) + words[k : n - size + 1 + k])
    return out


def shingle_set(words: np.ndarray, width: int) -> np.ndarray:
    """The distinct window hashes, ascending."""
    out = shingles(words, width)
    out.sort()
    return out[np.append(True, out[1:] != out[:-1])] if len(out) else out


#: Contract words: maximal runs without space and the controls 9 to 13, A-Z lower-cased.
def lower_words(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


#: Looser words for searches: punctuation of ASCII separates words too.
_LOOSE = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))


def loose_words(text: str | None) -> list[bytes]:
    return text.lower().encode("utf-8", "surrogatepass").translate(_LOOSE).split() if text else []


def signed(x: np.ndarray) -> np.ndarray:
    """The same bits as a signed long, for Spark."""
    return np.ascontiguousarray(x).view(np.int64)


def row_count_at_most(df: DataFrame, bound: int) -> bool:
    """Whether ``df`` has at most ``bound`` rows; the check a broadcast needs."""
    return df.limit(bound + 1).agg(F.count(F.lit(1))).first()[0] <= bound
