"""Tables as files and back, load bookkeeping, and replacement by partition."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..session import cut


def export(tables: dict[str, tuple[DataFrame, Sequence[str]]], path: str, form: str = "parquet") -> DataFrame:
    """Write each table in the order of its key; table and rows of each."""
    spark = next(iter(tables.values()))[0].sparkSession
    counts = []
    for name, (df, keys) in tables.items():
        writer = df.orderBy(*keys).write.mode("overwrite")
        writer.csv(f"{path}/{name}", header=True) if form == "csv" else writer.format(form).save(f"{path}/{name}")
        counts.append((name, restore(spark, path, {name: df.schema}, form)[name].count()))
    return spark.createDataFrame(counts, "table string, n_rows long")


def restore(spark: SparkSession, path: str, schemas: dict[str, StructType], form: str = "parquet") -> dict[str, DataFrame]:
    """The tables that ``export`` wrote."""
    return {name: spark.read.schema(schema).options(**({"header": "true"} if form == "csv" else {})).format(form).load(f"{path}/{name}") for name, schema in schemas.items()}


def next_id(df: DataFrame, column: str) -> int:
    return (df.agg(F.max(column)).first()[0] or 0) + 1


def numbered(df: DataFrame, column: str, first: int, *order: str | Column) -> DataFrame:
    """``df`` with consecutive numbers from ``first`` in ``order``.

    Ranges of the order are sorted each in its own task; only their sizes, one a task, come together.
    """
    rows = cut(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__at", F.monotonically_increasing_id()))
    task = F.shiftright("__at", 33).cast("long")
    starts, at = [], first
    for k, n in sorted(map(tuple, rows.groupBy(task).count().collect())):
        starts.append((k, at))
        at += n
    offsets = df.sparkSession.createDataFrame(starts, "__task long, __first long")
    placed = rows.withColumn("__task", task).join(F.broadcast(offsets), "__task")
    return placed.withColumn(column, F.col("__first") + F.col("__at").bitwiseAND((1 << 33) - 1)).drop("__at", "__task", "__first")


def load_state(loads: DataFrame, parts: DataFrame) -> DataFrame:
    """Loads with the ordered digests of their parts, and whether the same content was loaded before."""
    lists = parts.groupBy("load_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("part_no", "sha256"))), lambda p: p["sha256"]).alias("digests"))
    out = loads.join(lists, "load_id", "left")
    order = Window.partitionBy("source", "digests").orderBy("load_id")
    return out.withColumn("repeats_load", F.first("load_id").over(order)).withColumn("is_repeat", F.col("repeats_load") != F.col("load_id"))


def same_content(parts: DataFrame) -> DataFrame:
    """Digests that occur twice in one load; an error of whoever put it together."""
    return parts.groupBy("load_id", "sha256").agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def register_loads(loads: DataFrame, parts: DataFrame, offered: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Loads and parts after ``offered`` (source, as_at, part_no, sha256; one extract a source), and what each extract is.

    The first part names the load.  ``new``: it wasn't offered before.  ``unchanged``: all parts are those on
    record, in their order, and ``applied`` stays.  ``changed``: other parts differ; the record takes the new
    list and isn't applied any more.  The same content twice in one extract raises, as it would be counted twice.
    """
    twice = offered.groupBy("source", "sha256").agg(F.count(F.lit(1)).alias("n")).where("n > 1").first()
    if twice:
        raise ValueError(f"the parts of {twice['source']} hold one content {twice['n']} times")
    in_order = F.transform(F.array_sort(F.collect_list(F.struct("part_no", "sha256"))), lambda p: p["sha256"])
    new = offered.groupBy("source").agg(F.max("as_at").alias("__day"), in_order.alias("__new"))
    known = loads.join(parts.groupBy("load_id").agg(in_order.alias("__old")), "load_id").withColumn("__first", F.get("__old", F.lit(0)))
    known = known.groupBy("source", "__first").agg(F.max(F.struct("load_id", "__old")).alias("__k"))
    seen = new.withColumn("__first", F.get("__new", F.lit(0))).join(known, ["source", "__first"], "left")
    outcome = F.when(F.col("__k").isNull(), "new").when(F.col("__k.__old") == F.col("__new"), "unchanged").otherwise("changed")
    seen = cut(seen.select("source", "__day", F.col("__k.load_id").alias("__id"), outcome.alias("outcome")))
    fresh = numbered(seen.where("outcome = 'new'").select("source", F.col("__day").alias("as_at")), "load_id", next_id(loads, "load_id"), "source")
    fresh = cut(fresh.withColumn("applied", F.lit(False)))
    changed = seen.where("outcome = 'changed'").select(F.col("__id").alias("load_id"), F.lit(True).alias("__changed"))
    kept = loads.join(changed, "load_id", "left").withColumn("applied", F.col("applied") & F.col("__changed").isNull()).select(*loads.columns)
    outcomes = seen.join(fresh.select("source", "load_id"), "source", "left").select("source", F.coalesce("__id", "load_id").alias("load_id"), "outcome")
    replaced = outcomes.where("outcome != 'unchanged'").join(offered, "source").select("load_id", "part_no", "sha256")
    lists = parts.join(changed, "load_id", "left_anti").select("load_id", "part_no", "sha256").unionByName(replaced)
    return kept.unionByName(fresh, allowMissingColumns=True), lists, outcomes


def latest_load(loads: DataFrame) -> DataFrame:
    """The newest applied load of each source."""
    return loads.where("applied").groupBy("source").agg(F.max_by("load_id", F.struct("as_at", "load_id")).alias("load_id"), F.max("as_at").alias("as_at"))


def overwrite_version(df: DataFrame, path: str, column: str) -> None:
    """Replace the partitions of the versions in ``df`` and no others."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(column).parquet(path)
