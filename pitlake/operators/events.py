"""Ordered folds over event logs: replay, greedy windows, supersession."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .temporal import as_of_join

#: Exact quantities of the replay.
QUANTITY = "decimal(38,10)"


def replay(anchors: DataFrame, events: DataFrame, keys: Sequence[str], as_of: Column | None = None, known: Column | None = None) -> DataFrame:
    """Quantity of each key: its newest anchor, with the later events applied in order.

    ``anchors``: keys, anchor_date, anchor_qty (end of day) and knowable_at; ``events``: keys,
    event_date, event_id, kind, ratio_num, ratio_den, qty_delta and knowable_at.  Ratio events
    multiply, others add; events that are only proposed, of the anchor's day or earlier, after
    ``as_of`` or not ``known`` by then don't count.  Without an anchor the quantity is null.
    """
    cut = lambda at: (F.lit(True) if as_of is None else F.col(at) <= as_of) & (F.lit(True) if known is None else F.col("knowable_at") <= known)
    order = Window.partitionBy(*keys).orderBy(F.col("anchor_date").desc(), F.col("anchor_qty").desc())
    base = anchors.where(cut("anchor_date")).withColumn("__nr", F.row_number().over(order)).where("__nr = 1").select(*keys, "anchor_date", F.col("anchor_qty").cast(QUANTITY).alias("anchor_qty"))
    step = F.struct("event_date", "event_id", F.col("ratio_num").cast(QUANTITY).alias("num"), F.col("ratio_den").cast(QUANTITY).alias("den"), F.col("qty_delta").cast(QUANTITY).alias("delta"))
    later = events.where(cut("event_date") & (F.col("kind") != "issue_proposed")).join(base.select(*keys, "anchor_date"), list(keys)).where("event_date > anchor_date")
    steps = later.groupBy(*keys).agg(F.array_sort(F.collect_list(step)).alias("__steps"))
    fold = F.aggregate(
        F.coalesce("__steps", F.array().cast(steps.schema["__steps"].dataType)),
        F.col("anchor_qty"),
        lambda q, e: F.when(e["num"].isNotNull(), (q * e["num"] / e["den"]).cast(QUANTITY)).otherwise((q + F.coalesce(e["delta"], F.lit(0))).cast(QUANTITY)),
    )
    everyone = anchors.select(*keys).union(events.select(*keys)).distinct()
    return everyone.join(base, list(keys), "left").join(steps, list(keys), "left").select(*keys, "anchor_date", F.coalesce(F.size("__steps"), F.lit(0)).cast("long").alias("n_events"), F.when(F.col("anchor_qty").isNotNull(), fold).alias("quantity"))


def greedy_windows(rows: DataFrame, entity: str, day: str, person: str, days: int, least: int) -> DataFrame:
    """entity, window_start, window_end: greedy anchored windows with at least ``least`` persons.

    From the first free date of an entity: if the rows within ``days`` after it are of enough
    persons, the window is taken and the next may begin after it; else the next date is tried.
    The persons of every date's window come from one range frame; which windows are taken is a
    fold over the entity's distinct dates, not over its rows.
    """
    daily = rows.where(F.col(day).isNotNull()).groupBy(entity, F.col(day).alias("__day")).agg(F.collect_set(person).alias("__people")).withColumn("__d", F.unix_date("__day"))
    ahead = Window.partitionBy(entity).orderBy("__d").rangeBetween(0, days)
    wide = daily.withColumn("__n", F.size(F.array_distinct(F.flatten(F.collect_list("__people").over(ahead))))).withColumn("__end", F.max("__d").over(ahead))
    good = wide.where(F.col("__n") >= least).groupBy(entity).agg(F.array_sort(F.collect_list(F.struct(F.col("__d").alias("d"), F.col("__end").alias("e")))).alias("__all"))
    start = F.struct(F.lit(-(10**9)).alias("blocked"), F.array().cast("array<struct<d:int,e:int>>").alias("taken"))
    chosen = F.aggregate(
        "__all",
        start,
        lambda s, x: F.when(x["d"] > s["blocked"], F.struct((x["d"] + days).alias("blocked"), F.concat(s["taken"], F.array(x)).alias("taken"))).otherwise(s),
        lambda s: s["taken"],
    )
    return good.select(entity, F.explode(chosen).alias("__w")).select(entity, F.date_from_unix_date("__w.d").alias("window_start"), F.date_from_unix_date("__w.e").alias("window_end"))


def clusters(rows: DataFrame, entity: str, day: str, person: str, row_id: str, amount: str, knowable: str, days: int = 30, least: int = 2) -> DataFrame:
    """Windows with what is in them: persons, total, ids, and when the last of it became knowable."""
    windows = greedy_windows(rows, entity, day, person, days, least)
    # windows of an entity don't overlap, so a row's window is the last that began by its day:
    # carried along the time line instead of meeting every window with every row
    marks = windows.select(entity, F.col("window_start").alias("__begins"), "window_start", "window_end")
    inside = as_of_join(rows, marks, [entity], day, "__begins", ["window_start", "window_end"], "window_end").where(F.col(day) <= F.col("window_end"))
    return inside.groupBy(entity, "window_start", "window_end").agg(
        F.count_distinct(person).alias("n_persons"),
        F.sum(F.coalesce(F.col(amount), F.lit(0))).alias("total_amount"),
        F.max(knowable).alias("knowable_at"),
        F.array_sort(F.collect_list(row_id)).alias("member_ids"),
    )


def supersede(rows: DataFrame, group: Sequence[str], doc: str, knowable: str) -> DataFrame:
    """Latest document wins within a group, whatever order documents came in.

    All rows of the winner stay, pointing at the runner-up; all rows of others are superseded.
    """
    names = rows.columns
    docs = rows.groupBy(*(F.col(g).alias(f"__{g}") for g in group), F.col(doc).alias("__doc")).agg(F.max(knowable).alias("__known"))
    order = Window.partitionBy(*(f"__{g}" for g in group)).orderBy(F.col("__known").desc(), F.col("__doc").desc())
    ranked = docs.withColumn("__nr", F.row_number().over(order)).withColumn("__next", F.lead("__doc").over(order)).drop("__known")
    same = F.col(doc) == F.col("__doc")
    for g in group:
        same = same & F.col(g).eqNullSafe(F.col(f"__{g}"))
    joined = rows.join(ranked, same, "left")
    superseded = F.coalesce(F.col("__nr") > 1, F.lit(False)).alias("superseded")
    return joined.select(*names, superseded, F.when(F.col("__nr") == 1, F.col("__next")).alias("supersedes_doc"))


def replace_documents(stored: DataFrame, incoming: DataFrame, doc: str) -> DataFrame:
    """Apply documents: their stored rows go, the incoming ones come.  With no rows for a document in ``incoming`` use ``retract``."""
    return stored.join(incoming.select(doc).distinct(), doc, "left_anti").unionByName(incoming)


def retract(stored: DataFrame, docs: DataFrame, doc: str) -> DataFrame:
    """All rows of ``docs`` go."""
    return stored.join(docs.select(doc).distinct(), doc, "left_anti")


def record_anchor(stored: DataFrame, incoming: DataFrame, keys: Sequence[str], qty: str) -> DataFrame:
    """Incoming anchors with what to do: 'insert', 'same', or 'conflict' with a stored figure."""
    old = stored.select(*keys, F.col(qty).alias("__old"))
    what = F.when(F.col("__old").isNull(), "insert").when(F.col("__old") == F.col(qty), "same").otherwise("conflict")
    return incoming.join(old, list(keys), "left").withColumn("outcome", what).drop("__old")


def event_shape_errors() -> Column:
    """What is wrong with an event: ratio events carry a ratio, delta events a quantity, and directions agree."""
    ratio = F.col("kind").isin("split", "consolidation", "bonus_issue")
    has_ratio, has_delta = F.col("ratio_num").isNotNull() & F.col("ratio_den").isNotNull(), F.col("qty_delta").isNotNull()
    return F.array_compact(F.array(
        F.when(ratio & ~has_ratio, "ratio missing"),
        F.when(~ratio & ~has_delta, "quantity missing"),
        F.when(has_ratio & has_delta, "both ratio and quantity"),
        F.when((F.col("kind") == "split") & (F.col("ratio_num") <= F.col("ratio_den")), "a split must increase"),
        F.when((F.col("kind") == "consolidation") & (F.col("ratio_num") >= F.col("ratio_den")), "a consolidation must decrease"),
        F.when((F.col("kind").isin("buyback", "cancellation")) & (F.col("qty_delta") >= 0), "must be negative"),
    ))
