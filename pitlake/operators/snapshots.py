"""Dated snapshots: plausibility gate, diff, slowly changing dimensions, name history, upserts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Fixed values of the gate.
LEAST_ROWS, SHRINK_SHARE, SHRINK_ROWS = 500, 0.10, 25


class ImplausibleSnapshot(ValueError):
    """A snapshot that would close too much; most likely it is cut off."""


def gate(open_: DataFrame, snapshot: DataFrame, least_rows: int = LEAST_ROWS, share: float = SHRINK_SHARE, rows: int = SHRINK_ROWS) -> DataFrame:
    """One row: n_open, n_snapshot, implied_closed, refuse."""
    counts = open_.agg(F.count(F.lit(1)).alias("n_open")).crossJoin(snapshot.agg(F.count(F.lit(1)).alias("n_snapshot")))  # one row each
    gone = F.col("n_open") - F.col("n_snapshot")
    too_few = F.col("n_snapshot") < least_rows
    shrinks = (F.col("n_open") > 0) & (gone > F.greatest(F.col("n_open") * F.lit(share), F.lit(float(rows))))
    return counts.withColumn("implied_closed", gone).withColumn("refuse", too_few | shrinks)


def check_gate(open_: DataFrame, snapshot: DataFrame, allow_shrink: bool = False, **limits) -> None:
    found = gate(open_, snapshot, **limits).first()
    if found["refuse"] and not allow_shrink:
        raise ImplausibleSnapshot(f"{found['n_snapshot']} rows against {found['n_open']} open ones")


def diff(open_: DataFrame, snapshot: DataFrame, keys: Sequence[str], compare: Sequence[str] = ()) -> DataFrame:
    """keys and change: opened, closed, changed (a compared column differs) or kept."""
    old = open_.select(*keys, F.lit(True).alias("__old"), *(F.col(c).alias(f"__o_{c}") for c in compare))
    new = snapshot.select(*keys, F.lit(True).alias("__new"), *(F.col(c).alias(f"__n_{c}") for c in compare))
    both = old.join(new, list(keys), "full_outer")
    differs = F.lit(False)
    for c in compare:
        differs = differs | ~F.col(f"__o_{c}").eqNullSafe(F.col(f"__n_{c}"))
    change = F.when(F.col("__old").isNull(), "opened").when(F.col("__new").isNull(), "closed").when(differs, "changed").otherwise("kept")
    return both.select(*keys, change.alias("change"))


def listing_start(as_at: Column, listed: Column, last_seen: Column) -> Column:
    """A code is listed from its own date, but not into the time of an earlier holder, nor after the snapshot."""
    begins = F.coalesce(listed, as_at)
    return F.least(F.when(last_seen.isNotNull(), F.greatest(begins, F.date_add(last_seen, 1))).otherwise(begins), as_at)


def apply_snapshot(history: DataFrame, snapshot: DataFrame, entity: str, code: str, as_at: Column) -> DataFrame:
    """The listing history after a snapshot.

    ``history``: entity, code, valid_from, valid_to; ``snapshot``: entity, code, listed (date or
    null).  A code that moved closes on its old holder the day before; open codes of entities
    that the snapshot doesn't name close the day before too; what is new opens.  Nothing goes.
    """
    now = snapshot.select(F.col(code), F.col(entity).alias("__entity"), "listed").dropDuplicates([code])
    present = snapshot.select(entity).distinct().withColumn("__seen", F.lit(True))
    rows = history.join(now.select(code, "__entity"), code, "left").join(present, entity, "left")
    moved = F.coalesce(F.col("__entity") != F.col(entity), F.lit(False))
    close = F.col("valid_to").isNull() & (moved | F.col("__seen").isNull())
    old = rows.withColumn("valid_to", F.when(close, F.date_sub(as_at, 1)).otherwise(F.col("valid_to"))).select(entity, code, "valid_from", "valid_to")
    last = old.groupBy(code).agg(F.max(F.coalesce("valid_to", "valid_from")).alias("__last"))
    open_ = old.where("valid_to is null").select(entity, code)
    fresh = snapshot.dropDuplicates([code]).join(open_, [entity, code], "left_anti").join(last, code, "left")
    new = fresh.select(entity, code, listing_start(as_at, F.col("listed"), F.col("__last")).alias("valid_from"), F.lit(None).cast("date").alias("valid_to"))
    return old.unionByName(new)


def fused(listings: DataFrame, names: DataFrame, snapshot: DataFrame, entity: str, code: str, norm: str) -> DataFrame:
    """Snapshot rows that would give an entity a second open code under another name; to be split off and reviewed."""
    other = listings.where("valid_to is null").select(entity, F.col(code).alias("__code")).distinct()
    clash = snapshot.join(other, entity).where(F.col("__code") != F.col(code)).drop("__code").dropDuplicates([entity, code])
    same = names.where("valid_to is null").select(entity, norm).distinct()
    return clash.join(same, [entity, norm], "left_anti")


def close_names(names: DataFrame, snapshot: DataFrame, entity: str, norm: str, as_at: Column) -> DataFrame:
    """Legal names after a snapshot: a superseded one closes, a new one opens at ``as_at``; former ones stay."""
    now = snapshot.select(entity, F.col(norm).alias("__norm"), F.col("name").alias("__name")).dropDuplicates([entity])
    rows = names.join(now, entity, "left")
    close = (F.col("name_kind") == "legal") & F.col("valid_to").isNull() & F.coalesce(F.col("__norm") != F.col(norm), F.lit(False))
    old = rows.withColumn("valid_to", F.when(close, as_at).otherwise(F.col("valid_to"))).select(*names.columns)
    have = old.where("valid_to is null").select(entity, F.col(norm).alias("__norm"))
    new = now.join(have, [entity, "__norm"], "left_anti")
    fill = {entity: F.col(entity), "name": F.col("__name"), norm: F.col("__norm"), "name_kind": F.lit("legal"), "valid_from": as_at, "valid_to": F.lit(None).cast("date")}
    return old.unionByName(new.select(*(fill.get(c, F.lit(None).cast(names.schema[c].dataType)).alias(c) for c in names.columns)))


def name_history(registry: DataFrame, key: str) -> DataFrame:
    """Registered names as intervals.

    The current name holds from the published change (else registration, else 1900-01-01);
    former names from registration to the day before that change.  An interval that would end
    before it begins lasts one day.
    """
    whole = Window.partitionBy(key)
    registered = F.min("registration_date").over(whole)
    change = F.min(F.when(~F.col("is_current_name"), F.col("current_name_start_date"))).over(whole)
    early = F.to_date(F.lit("1900-01-01"))
    rows = registry.withColumn("__r", registered).withColumn("__t", change)
    now = F.col("is_current_name")
    begins = F.when(now, F.coalesce("__t", "__r", early)).otherwise(F.coalesce("__r", early))
    ends = F.when(~now, F.date_sub("__t", 1))
    return rows.select(key, "name", "name_norm", F.when(now, "legal").otherwise("former").alias("name_kind"), begins.alias("valid_from"), F.when(ends < begins, begins).otherwise(ends).alias("valid_to"))


def upsert(stored: DataFrame, incoming: DataFrame, keys: Sequence[str], prefer: Column | None = None) -> DataFrame:
    """Incoming rows replace stored ones of their key; null in an incoming column keeps what is stored."""
    order = [prefer] if prefer is not None else [F.lit(0)]
    new = incoming.withColumn("__nr", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("__nr = 1").drop("__nr")
    rest = [c for c in stored.columns if c not in keys]
    both = stored.select(*keys, *(F.col(c).alias(f"__o_{c}") for c in rest)).join(new.select(*keys, *(F.col(c).alias(f"__n_{c}") for c in rest)), list(keys), "full_outer")
    return both.select(*keys, *(F.coalesce(f"__n_{c}", f"__o_{c}").alias(c) for c in rest))


def universe(listings: DataFrame, names: DataFrame, figures: DataFrame, entities: DataFrame, entity: str, code: str, day: Column) -> DataFrame:
    """The listed universe on a day: code, name, newest figures, identity status and rank by capitalisation.

    Unknown capitalisation has no rank; an entity is resolved if it has a number of either register.
    """
    on = (F.col("valid_from") <= day) & (F.col("valid_to").isNull() | (F.col("valid_to") >= day))
    open_ = listings.where(on).select(entity, code)
    legal = F.col("name_kind") == "legal"
    n = F.count(F.when(legal, 1))
    named = names.where(on).groupBy(entity).agg(F.when(n == 1, F.max(F.when(legal, F.col("name")))).when(F.count(F.lit(1)) == 1, F.max("name")).alias("name"))
    order = Window.partitionBy(entity, code).orderBy(F.col("as_at").desc())
    newest = figures.where(F.col("as_at") <= day).withColumn("__nr", F.row_number().over(order)).where("__nr = 1").select(entity, code, "market_cap", "sector", "as_at")
    out = open_.join(named, entity, "left").join(newest, [entity, code], "left").join(entities, entity, "left")
    return rank_down(out.withColumn("identity", F.when(F.col("acn").isNotNull() | F.col("arbn").isNotNull(), "resolved").otherwise("in_review")), "market_cap", "cap_rank")


def rank_down(df: DataFrame, value: str, out: str) -> DataFrame:
    """``df`` with the rank of each value from the largest down; equal values share it, null has none.

    Rows are ranked within slices of about 1.5 % of the value; the rows of larger slices are added.
    There are some thousand slices whatever the rows, and only their counts meet in one task.
    """
    # values that aren't positive have no logarithm and make the last slice
    cut = F.coalesce(F.floor(F.log(F.col(value).cast("double")) * 64), F.lit(-(10**6)))
    rows = df.withColumn("__slice", F.when(F.col(value).isNotNull(), cut))
    larger = F.sum("__n").over(Window.orderBy(F.col("__slice").desc()).rowsBetween(Window.unboundedPreceding, -1))
    counts = rows.where("__slice is not null").groupBy("__slice").agg(F.count(F.lit(1)).alias("__n"))
    above = counts.select("__slice", F.coalesce(larger, F.lit(0)).alias("__above"))
    ranked = rows.join(above, "__slice", "left").withColumn("__r", F.rank().over(Window.partitionBy("__slice").orderBy(F.col(value).desc())))
    return ranked.withColumn(out, F.when(F.col(value).isNotNull(), F.col("__r") + F.col("__above"))).drop("__slice", "__above", "__r")


def size_label(cap: Column, rank: Column, most: float | None = None, top: int | None = None) -> Column:
    """kept, too_large or unknown; what isn't known is counted, not assumed small."""
    large = F.lit(False)
    if most is not None:
        large = large | (cap > most)
    if top is not None:
        large = large | (rank <= top)
    return F.when(cap.isNull(), "unknown").when(large, "too_large").otherwise("kept")
