"""Effective-dated and bitemporal predicates, as-of and interval joins.

Intervals are inclusive at both ends; a null end is open.  A fact has the date
it happened and the time it became knowable, and analytics cut on the latter.
All joins keep an equality key, so none falls back to a nested loop.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

Cols = Sequence[str]

#: Days of a slot of the time line; intervals meet only what lies in one of their slots.
SLOT_DAYS = 512


def _slot(day: Column) -> Column:
    return F.floor(F.unix_date(F.to_date(day)) / SLOT_DAYS)


def _in_slots(df: DataFrame, begins: Column, ends: Column) -> DataFrame:
    """A row for each slot from ``begins`` to ``ends``, the first slot at least."""
    return df.withColumn("__slot", F.explode(F.sequence(_slot(begins), F.greatest(_slot(begins), _slot(ends)))))


def valid_on(day: Column, begins: Column, ends: Column) -> Column:
    """Whether an inclusive interval with an optional end holds on ``day``."""
    return (begins <= day) & (ends.isNull() | (ends >= day))


def known_as_of(knowable_at: Column, cutoff: Column | None) -> Column:
    """Whether a fact was knowable at ``cutoff``; without a cut-off everything is."""
    return F.lit(True) if cutoff is None else cutoff.isNull() | (knowable_at <= cutoff)


def optional(column: Column, value) -> Column:
    """``column = value``, or true where no value is asked for."""
    return F.lit(True) if value is None else column == F.lit(value)


def market_date(at: Column, zone: str = "Australia/Sydney") -> Column:
    """The calendar day of a UTC time at the market."""
    return F.to_date(F.from_utc_timestamp(at.cast("timestamp"), zone))


def latest_per(df: DataFrame, keys: Cols, *order: Column) -> DataFrame:
    """One row for each key: the first in ``order``."""
    nr = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("__nr", nr).where("__nr = 1").drop("__nr")


def as_of_constant(df: DataFrame, keys: Cols, at: str, day: Column, *ties: Column) -> DataFrame:
    """The newest row of each key at or before one date for all."""
    return latest_per(df.where(F.col(at) <= day), keys, F.col(at).desc(), *ties)


def as_of_join(left: DataFrame, right: DataFrame, on: Cols, left_at: str, right_at: str, values: Cols, tie: str, strict: bool = False) -> DataFrame:
    """``left`` with the ``values`` of the newest ``right`` row at or before its time; nulls without one.

    Both sides are laid on one time line for each key and the last right row is carried
    forward: one shuffle, no join, linear however many rows a key has.  ``tie`` orders right
    rows of one time; the last wins.  With ``strict`` a right row of the same time isn't seen.
    """
    carried = F.struct(*(F.col(v) for v in values))
    names = left.columns
    rows = left.select(*(F.col(c) for c in on), F.col(left_at).alias("__at"), F.lit(0 if strict else 1).alias("__side"), F.lit(None).cast(right.schema[tie].dataType).alias("__tie"), F.struct(*names).alias("__row"), F.lit(None).cast(right.select(carried.alias("v")).schema["v"].dataType).alias("__value"))
    marks = right.where(F.col(right_at).isNotNull()).select(*(F.col(c) for c in on), F.col(right_at).alias("__at"), F.lit(1 if strict else 0).alias("__side"), F.col(tie).alias("__tie"), F.lit(None).cast(rows.schema["__row"].dataType).alias("__row"), carried.alias("__value"))
    line = Window.partitionBy(*on).orderBy(F.col("__at"), "__side", F.col("__tie").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0)
    seen = rows.unionByName(marks).withColumn("__value", F.last("__value", ignorenulls=True).over(line)).where("__row is not null")
    return seen.select(*(F.col(f"__row.{c}").alias(c) for c in names), *(F.col(f"__value.{v}").alias(v) for v in values))


def lookup_unique(left: DataFrame, right: DataFrame, on: Cols, key: str, day: str, begins: str, ends: str, value: str, out: str) -> DataFrame:
    """``left`` with the only ``value`` whose interval holds on ``day``; null where there is none or more than one.

    A day meets the intervals of its key in its slot, not all of its key.  All days after the
    last date of ``right`` share one slot, so that open intervals end somewhere.
    """
    last = right.agg(F.max(F.greatest(begins, ends))).scalar()
    probes = left.select(key, day, *on).withColumn("__slot", F.least(_slot(F.col(day)), _slot(last)))
    held = _in_slots(right.select(*on, begins, ends, value), F.col(begins), F.least(F.col(ends), last))
    hits = probes.join(held, [*on, "__slot"]).where(valid_on(F.col(day), F.col(begins), F.col(ends)))
    one = hits.groupBy(key).agg(F.min(value).alias("__low"), F.max(value).alias("__high"))
    return left.join(one, key, "left").withColumn(out, F.when(F.col("__low") == F.col("__high"), F.col("__low"))).drop("__low", "__high")


def single_or_blank(df: DataFrame, keys: Cols, value: str, preferred: Column, out: str) -> DataFrame:
    """For each key: the preferred row's value if exactly one row is preferred, else the only row's, else null."""
    n = F.count(F.when(preferred, 1))
    return df.groupBy(*keys).agg(F.when(n == 1, F.max(F.when(preferred, F.col(value)))).when(F.count(F.lit(1)) == 1, F.max(value)).alias(out))


def overlaps(df: DataFrame, keys: Cols, id_: str, begins: str, ends: str) -> DataFrame:
    """Pairs of intervals of one key that overlap: keys, id_a < id_b, the shared days.

    Two intervals meet in the slot where the later one begins, so none after the last beginning is needed.
    """
    far, last = F.to_date(F.lit("9999-12-31")), df.agg(F.max(begins)).scalar()

    def side(s: str) -> DataFrame:
        rows = df.select(*keys, F.col(id_).alias(f"id_{s}"), F.col(begins).alias(f"from_{s}"), F.coalesce(F.col(ends), far).alias(f"to_{s}"))
        return _in_slots(rows, F.col(f"from_{s}"), F.least(F.col(f"to_{s}"), last))

    both = side("a").join(side("b"), [*keys, "__slot"]).where("id_a < id_b and from_a <= to_b and from_b <= to_a").where(_slot(F.greatest("from_a", "from_b")) == F.col("__slot"))
    return both.select(*keys, "id_a", "id_b", F.greatest("from_a", "from_b").alias("overlap_from"), F.least("to_a", "to_b").alias("overlap_to"))


def intervals(df: DataFrame, keys: Cols, at: str, tie: str) -> DataFrame:
    """Versions as intervals: each holds until the day before the next version's day; the last is open."""
    order = Window.partitionBy(*keys).orderBy(at, tie)
    return df.withColumn("valid_from", F.col(at)).withColumn("valid_to", F.date_sub(F.lead(at).over(order), 1))


def nearest_join(left: DataFrame, right: DataFrame, on: Cols, left_id: str, left_at: str, right_id: str, right_at: str) -> DataFrame:
    """For each left row the right row of its key that is nearest in time (ties: smaller id): left_id, right_id, gap in microseconds.

    The nearest is the last one before or the first one after, so both are carried along the
    time line of the key instead of pairing every two rows.
    """
    rows = left.select(*on, F.col(left_at).alias("__at"), F.col(left_id).alias("__left"), F.lit(None).cast(right.schema[right_id].dataType).alias("__right"))
    marks = right.select(*on, F.col(right_at).alias("__at"), F.lit(None).cast(left.schema[left_id].dataType).alias("__left"), F.col(right_id).alias("__right"))
    line = rows.unionByName(marks).withColumn("__us", F.unix_micros(F.col("__at").cast("timestamp")))
    mark = F.when(F.col("__right").isNotNull(), F.struct("__us", "__right"))
    same = Window.partitionBy(*on).orderBy("__us")
    before = F.max(F.when(F.col("__right").isNotNull(), F.struct(F.col("__us").alias("u"), (-F.col("__right")).alias("i")))).over(same.rangeBetween(Window.unboundedPreceding, 0))
    after = F.min(mark).over(same.rangeBetween(0, Window.unboundedFollowing))
    seen = line.withColumn("__b", before).withColumn("__a", after).where("__left is not null")
    options = F.array_compact(F.array(
        F.when(F.col("__b").isNotNull(), F.struct((F.col("__us") - F.col("__b.u")).alias("gap"), (-F.col("__b.i")).alias("id"))),
        F.when(F.col("__a").isNotNull(), F.struct((F.col("__a.__us") - F.col("__us")).alias("gap"), F.col("__a.__right").alias("id"))),
    ))
    best = F.array_min(options)
    return seen.select(F.col("__left").alias(left_id), best["id"].alias(right_id), best["gap"].alias("gap_us"))


def window_pairs(left: DataFrame, right: DataFrame, on: Cols, left_at: str, right_at: str, before_s: int, after_s: int) -> DataFrame:
    """Pairs of one key with right - left between -before_s and after_s seconds.

    The time line is cut into buckets as long as the window, so that a key's rows meet only
    those of three buckets and not all of the key.
    """
    size = before_s + after_s
    second = lambda c: F.unix_micros(F.col(c).cast("timestamp")) / 1_000_000
    bucket = lambda s: F.floor(s / size)
    a = left.withColumn("__s", second(left_at))
    a = a.withColumn("__b", F.explode(F.sequence(bucket(F.col("__s") - before_s), bucket(F.col("__s") + after_s))))
    b = right.withColumn("__t", second(right_at)).withColumn("__b", bucket(F.col("__t")))
    return a.join(b, [*on, "__b"]).where((F.col("__t") - F.col("__s")).between(-before_s, after_s)).drop("__s", "__t", "__b")


def membership(probes: DataFrame, snapshots: DataFrame, members: DataFrame, key: str, day: str, stale_days: int) -> DataFrame:
    """Three-valued membership of each probe (key, day): null without a snapshot or with a stale one.

    ``snapshots``: as_of, knowable_at (dates); ``members``: as_of, key.  The snapshot is the
    newest that existed and was knowable on the day.
    """
    dated = snapshots.select(F.greatest("as_of", "knowable_at").alias("__seen"), "as_of").withColumn("__one", F.lit(1))
    # a later snapshot of an older date must not replace a newer one
    order = Window.partitionBy("__one").orderBy("__seen", "as_of").rowsBetween(Window.unboundedPreceding, 0)
    best = dated.withColumn("__best", F.max("as_of").over(order)).groupBy("__seen").agg(F.max("__best").alias("__best"), F.lit(1).alias("__one"))
    days = probes.select(day).distinct().withColumn("__one", F.lit(1))
    at = as_of_join(days, best, ["__one"], day, "__seen", ["__best"], "__best").select(day, "__best")
    probed = probes.join(at, day, "left")
    hit = members.select(F.col("as_of").alias("__best"), key, F.lit(True).alias("__hit")).distinct()
    fresh = F.col("__best").isNotNull() & (F.datediff(F.col(day), F.col("__best")) <= stale_days)
    return probed.join(hit, ["__best", key], "left").withColumn("is_member", F.when(fresh, F.coalesce("__hit", F.lit(False)))).drop("__best", "__hit")
