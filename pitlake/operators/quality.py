"""Reconciliation, monitors in which silence is an alarm, coverage and operations reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Fixed values of the checks.
TOLERANCE = 0.005
STUCK_HOURS, CAPTURE_HOURS, CAPTURE_FLOOR, CAPTURE_LEAST = 24, 96, 0.9, 20
REVIEW_DAYS, DRAIN_DAYS = 14, 7
UNIDENTIFIED = 0.06
COVERED = 0.99


def reconcile(rows: DataFrame, replayed: str, external: str, tolerance: float = TOLERANCE) -> DataFrame:
    """``rows`` with rel_diff and within_tolerance (null where a figure is missing) and needs_review."""
    r, e = F.col(replayed), F.col(external)
    known = r.isNotNull() & e.isNotNull()
    rel = F.when(known, F.when(e == 0, F.when(r == 0, F.lit(0.0)).otherwise(1.0)).otherwise((F.abs(r - e) / F.abs(e)).cast("double")))
    within = F.when(known, F.when(e == 0, r == 0).otherwise(rel <= tolerance))
    return rows.withColumn("rel_diff", rel).withColumn("within_tolerance", within).withColumn("needs_review", r.isNull() | F.coalesce(~within, F.lit(False)))


def share(part: Column, whole: Column) -> Column:
    """part / whole; null where the whole is 0."""
    return F.when(whole != 0, part / whole)


def feed_volume(slos: DataFrame, rows: DataFrame, feed: str, at: str, now: Column, staleness_at: str | None = None) -> DataFrame:
    """One row for each feed of ``slos`` (feed, window_days, least, stale_hours): count, newest and alarm.

    The feeds come from the table of what is expected, so a feed without any row is there, with
    zero, and that is an alarm.  Staleness looks at all history, and only where there is volume.
    """
    newest = F.max(F.coalesce(F.col(staleness_at), F.col(at)) if staleness_at else F.col(at))
    joined = slos.join(rows.select(F.col(feed), *dict.fromkeys(c for c in (at, staleness_at) if c)), feed, "left")
    inside = F.col(at) >= now - F.make_interval(days=F.col("window_days"))
    per = joined.groupBy(feed, "window_days", "least", "stale_hours").agg(F.count(F.when(inside, 1)).alias("n"), newest.alias("newest"))
    stale = F.col("newest") < now - F.make_interval(hours=F.col("stale_hours"))
    alarm = F.when(F.col("n") == 0, "zero").when(F.col("n") < F.col("least"), "below_baseline")
    return per.withColumn("volume_alarm", alarm).withColumn("stale_alarm", (F.col("n") > 0) & F.coalesce(stale, F.lit(False)))


def stuck(rows: DataFrame, status: str, at: str, now: Column, waiting: str = "unparsed", hours: int = STUCK_HOURS) -> DataFrame:
    """One row: how many wait longer than they may, the oldest, and whether that is an alarm."""
    late = (F.col(status) == waiting) & (F.col(at) < now - F.make_interval(hours=F.lit(hours)))
    return rows.agg(F.count(F.when(late, 1)).alias("n"), F.min(F.when(late, F.col(at))).alias("oldest")).withColumn("alarm", F.col("n") > 0)


def capture_rate(rows: DataFrame, captured: Column, at: str, now: Column, days: int = 14, least: int = CAPTURE_LEAST, floor: float = CAPTURE_FLOOR) -> DataFrame:
    """One row: detected and captured in the trailing days, the rate, an alarm only on enough volume."""
    inside = F.col(at) >= now - F.make_interval(days=F.lit(days))
    out = rows.agg(F.count(F.when(inside, 1)).alias("detected"), F.count(F.when(inside & captured, 1)).alias("captured"))
    return out.withColumn("rate", share(F.col("captured"), F.col("detected"))).withColumn("alarm", (F.col("detected") >= least) & (F.col("rate") < floor))


def review_sla(items: DataFrame, created: str, now: Column, group: Sequence[str] = ()) -> DataFrame:
    """Open items and the oldest of each group: 'halted' after two weeks, 'late' after one, else null."""
    age = F.col("oldest")
    out = items.where("resolved_at is null").groupBy(*group).agg(F.count(F.lit(1)).alias("n_open"), F.min(created).alias("oldest"))
    return out.withColumn("alarm", F.when(age < now - F.make_interval(days=F.lit(REVIEW_DAYS)), "halted").when(age < now - F.make_interval(days=F.lit(DRAIN_DAYS)), "late"))


def routing_drift(recent_n: Column, recent_hit: Column, prior_n: Column, prior_hit: Column) -> Column:
    """rose, fell or null: the share of routed records, on at least ten of each period."""
    recent, prior = share(recent_hit, recent_n), share(prior_hit, prior_n)
    return F.when((recent_n < 10) | (prior_n < 10), None).when((recent > 2 * prior) & (recent > 0.1), "rose").when((prior > 0.05) & (recent < prior / 3), "fell")


def base_rate_drift(recent_n: Column, recent_hit: Column, prior_n: Column, prior_hit: Column) -> Column:
    """rose, fell or null: the share of a class, on at least 30 recent and 100 prior rows."""
    recent, prior = share(recent_hit, recent_n), share(prior_hit, prior_n)
    return F.when((recent_n < 30) | (prior_n < 100), None).when(recent > F.greatest(prior * 2, prior + 0.1), "rose").when((prior > 0.02) & (recent < prior / 2), "fell")


def two_periods(rows: DataFrame, at: str, now: Column, recent_days: int, prior_days: int, hit: Column, group: Sequence[str] = ()) -> DataFrame:
    """Counts of all rows and of hits in the recent days and in the days before them; one pass."""
    mid, start = now - F.make_interval(days=F.lit(recent_days)), now - F.make_interval(days=F.lit(recent_days + prior_days))
    recent, prior = F.col(at) >= mid, (F.col(at) < mid) & (F.col(at) >= start)
    n = lambda w: F.count(F.when(w, 1))
    return rows.groupBy(*group).agg(n(recent).alias("recent_n"), n(recent & hit).alias("recent_hit"), n(prior).alias("prior_n"), n(prior & hit).alias("prior_hit"))


def identity_rate(entities: DataFrame, listings: DataFrame, entity: str, ceiling: float = UNIDENTIFIED) -> DataFrame:
    """One row: listed entities, those without a number, the rate and the alarm."""
    listed = entities.join(listings.where("valid_to is null").select(entity).distinct(), entity, "left_semi")
    missing = F.col("acn").isNull() & F.col("arbn").isNull() & (F.col("entity_kind") != "foreign")
    out = listed.agg(F.count(F.lit(1)).alias("total"), F.count(F.when(missing, 1)).alias("unidentified"))
    return out.withColumn("rate", share(F.col("unidentified"), F.col("total"))).withColumn("alarm", F.coalesce(F.col("rate") > ceiling, F.lit(False)))


def examples(rows: DataFrame, label: Column, value: str, most: int = 5) -> DataFrame:
    """label, n and the first values of each label in order; only ``most`` rows a label and task are shuffled."""
    named = rows.select(label.alias("label"), F.col(value).alias("__value"))
    first = F.row_number().over(Window.partitionBy("label").orderBy("__value"))
    kept = named.where("__value is not null").withColumn("__nr", first).where(F.col("__nr") <= most)
    some = kept.groupBy("label").agg(F.array_sort(F.collect_list("__value")).alias("examples")).withColumnRenamed("label", "__label")
    counts = named.groupBy("label").agg(F.count(F.lit(1)).alias("n"))
    none = F.array().cast(some.schema["examples"].dataType)
    return counts.join(some, F.col("label").eqNullSafe(F.col("__label")), "left").select("label", "n", F.coalesce("examples", none).alias("examples"))


def number_coverage(entities: DataFrame, listings: DataFrame, entity: str, bar: float = COVERED) -> DataFrame:
    """One row: entities ever listed, those with a company number, foreign ones without, the rest, the covered share and whether it meets the bar."""
    ever = entities.join(listings.select(entity).distinct(), entity, "left_semi")
    has, foreign = F.col("acn").isNotNull(), F.coalesce(F.col("entity_kind") == "foreign", F.lit(False))
    n = lambda w: F.count(F.when(w, 1))
    out = ever.agg(F.count(F.lit(1)).alias("total"), n(has).alias("with_number"), n(~has & foreign).alias("flagged_foreign"), n(~has & ~foreign).alias("unresolved"))
    rate = F.coalesce(share(F.col("with_number") + F.col("flagged_foreign"), F.col("total")), F.lit(0.0))
    return out.withColumn("rate", rate).withColumn("meets", (F.col("total") > 0) & (F.col("rate") >= bar))


def alarms(*checks: tuple[str, DataFrame, Column]) -> DataFrame:
    """One table of (check, detail): ``checks`` are names, rows, and what makes a row an alarm."""
    out = None
    for name, rows, bad in checks:
        some = rows.where(bad).select(F.lit(name).alias("check"), F.to_json(F.struct(*rows.columns)).alias("detail"))
        out = some if out is None else out.unionByName(some)
    return out


def heartbeat(found: DataFrame, now: Column) -> DataFrame:
    """The row that every run of the monitors leaves, alarms or not."""
    return found.agg(F.count(F.lit(1)).alias("n_alarms"), F.sort_array(F.collect_list(F.struct("check", "detail"))).alias("alarms")).select(now.alias("ran_at"), (F.col("n_alarms") == 0).alias("ok"), "alarms")


def violations(rows: DataFrame, rules: dict[str, Column], key: str) -> DataFrame:
    """key and rule for every row that breaks one; a table's constraints as a query."""
    broken = F.array_compact(F.array(*(F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in rules.items())))
    return rows.select(key, F.explode(broken).alias("rule"))


def duplicates(rows: DataFrame, keys: Sequence[str], where: Column | None = None) -> DataFrame:
    """Keys that occur more than once; a unique index as a query."""
    return (rows if where is None else rows.where(where)).groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
