"""Registers, escrow and holdings: float, releases, concentration, chains of owners, tenements, safe sums."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut


def float_series(shares: DataFrame, locked: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Free float of each key and day: shares outstanding less what is locked on that day; flags say what is missing.

    ``shares``: keys, as_of, outstanding; ``locked``: keys, quantity, locked_from, release_date.
    """
    inside = (F.col("locked_from") <= F.col("as_of")) & (F.col("release_date").isNull() | (F.col("release_date") > F.col("as_of")))
    held = shares.select(*keys, "as_of").join(locked, list(keys)).where(inside).groupBy(*keys, "as_of").agg(F.sum("quantity").alias("locked"))
    known = locked.select(*keys).distinct().withColumn("__known", F.lit(True))
    out = shares.join(held, [*keys, "as_of"], "left").join(known, list(keys), "left")
    flags = F.array_compact(F.array(F.when(F.col("__known").isNull(), "no_escrow_data"), F.when(F.col("outstanding").isNull(), "no_share_count")))
    return out.select(*keys, "as_of", "outstanding", F.coalesce("locked", F.lit(0)).alias("locked"), (F.col("outstanding") - F.coalesce("locked", F.lit(0))).alias("float_shares"), flags.alias("coverage_flags"))


def large_releases(locked: DataFrame, floats: DataFrame, keys: Sequence[str], today: Column, days: int, share: float) -> DataFrame:
    """Releases within the horizon that are more than a share of the float, and whether they come on one day or several."""
    soon = locked.where((F.col("release_date") > today) & (F.col("release_date") <= F.date_add(today, days)))
    per = soon.groupBy(*keys).agg(F.sum("quantity").alias("released"), F.count_distinct("release_date").alias("n_dates"), F.min("release_date").alias("first_release"))
    out = per.join(floats.select(*keys, "float_shares"), list(keys)).where((F.col("float_shares") > 0) & (F.col("released") > share * F.col("float_shares")))
    return out.withColumn("shape", F.when(F.col("n_dates") == 1, "cliff").otherwise("staggered"))


def concentration(holders: DataFrame, keys: Sequence[str], holder: str, quantity: str, total: str, tops: Sequence[int] = (5, 20)) -> DataFrame:
    """Share of the largest holders in all, by rank; ties in the order of their names."""
    order = Window.partitionBy(*keys).orderBy(F.col(quantity).desc(), F.col(holder))
    ranked = holders.withColumn("__nr", F.row_number().over(order))
    sums = [F.sum(F.when(F.col("__nr") <= n, F.col(quantity))).alias(f"top_{n}") for n in tops]
    out = ranked.groupBy(*keys).agg(F.max(total).alias("__total"), F.count(F.lit(1)).alias("n_holders"), *sums)
    return out.select(*keys, "n_holders", *(F.when(F.col("__total") != 0, F.col(f"top_{n}") / F.col("__total")).alias(f"top_{n}_share") for n in tops))


def churn(before: DataFrame, after: DataFrame, keys: Sequence[str], holder: str) -> DataFrame:
    """Holders that entered, left and stayed between two registers."""
    old, new = before.select(*keys, holder).distinct().withColumn("__o", F.lit(1)), after.select(*keys, holder).distinct().withColumn("__n", F.lit(1))
    both = old.join(new, [*keys, holder], "full_outer")
    n = lambda c: F.count(F.when(c, 1))
    return both.groupBy(*keys).agg(n(F.col("__o").isNull()).alias("entered"), n(F.col("__n").isNull()).alias("left"), n(F.col("__o").isNotNull() & F.col("__n").isNotNull()).alias("stayed"))


CUSTODIANS = r"\b(nominees?|custod\w*|depositary|trustees?)\b"


def is_custodian(name: Column) -> Column:
    """Whether a holder holds for others, by its name."""
    return F.lower(name).rlike(CUSTODIANS)


def owners(edges: DataFrame, child: str, parent: str) -> DataFrame:
    """child, ancestor, depth: every owner above each entity, however far; a cycle ends where it closes.

    One join a level, each over what the last found, until nothing new is.
    """
    step = cut(edges.select(F.col(child).alias("__c"), F.col(parent).alias("__p")).where("__c is not null and __p is not null").distinct())
    found = last = step.select(F.col("__c").alias("child"), F.col("__p").alias("ancestor"), F.lit(1).alias("depth"))
    depth = 1
    while not last.isEmpty():
        depth += 1
        last = last.join(step, F.col("ancestor") == F.col("__c")).select("child", F.col("__p").alias("ancestor"), F.lit(depth).alias("depth"))
        last = cut(last.distinct().join(found.select("child", "ancestor"), ["child", "ancestor"], "left_anti"))
        found = found.unionByName(last)
        if depth % 10 == 0:  # many small parts would be read again at each level
            found = cut(found.coalesce(max(8, step.sparkSession.sparkContext.defaultParallelism)))
    return found.where("child != ancestor")


def grossed_up(amount: Column, basis: Column, rate: float = 0.3) -> Column:
    """A dividend before tax by how it was franked: 'franked' carries the credit, 'unfranked' none, anything else is unknown."""
    return F.when(basis == "franked", amount / (1 - F.lit(rate))).when(basis == "unfranked", amount)


def tenement_events(before: DataFrame, after: DataFrame, key: str) -> DataFrame:
    """What happened to each tenement between two snapshots (key, status, holder, expiry)."""
    old = before.select(key, *(F.col(c).alias(f"__o_{c}") for c in ("status", "holder", "expiry")), F.lit(True).alias("__o"))
    new = after.select(key, *(F.col(c).alias(f"__n_{c}") for c in ("status", "holder", "expiry")), F.lit(True).alias("__n"))
    both = old.join(new, key, "full_outer")
    events = F.array_compact(F.array(
        F.when(F.col("__o").isNull() & (F.col("__n_status") == "pending"), "applied"),
        F.when(F.coalesce(F.col("__o_status"), F.lit("")).isin("", "pending") & (F.col("__n_status") == "live"), "granted"),
        F.when(F.col("__o").isNotNull() & F.col("__n").isNotNull() & ~F.col("__o_holder").eqNullSafe(F.col("__n_holder")), "transferred"),
        F.when(F.col("__o_expiry") < F.col("__n_expiry"), "renewed"),
        F.when(F.col("__n").isNull() | (F.col("__n_status") == "expired") & (F.col("__o_status") != "expired"), "expired"),
    ))
    return both.select(key, F.explode(events).alias("event"))


def category_sums(rows: DataFrame, keys: Sequence[str], category: str, quantity: str, unit: str, factors: dict[str, float], allowed: Sequence[str]) -> DataFrame:
    """Sums within one category of allowed units; what is left out is counted, not converted by guess."""
    factor = F.create_map(*(F.lit(x) for pair in factors.items() for x in pair))[F.col(unit)]
    use = F.col(category).isin(*allowed) & factor.isNotNull()
    return rows.groupBy(*keys, category).agg(F.sum(F.when(use, F.col(quantity) * factor)).alias("total"), F.count(F.when(use, 1)).alias("n_used"), F.count(F.when(~F.coalesce(use, F.lit(False)), 1)).alias("n_left_out"))


def pairing_rate(notices: DataFrame, follow_ups: DataFrame, keys: Sequence[str], at: str, id_: str, days: int) -> DataFrame:
    """Which notices have a follow-up of their key within the days after them."""
    hit = notices.select(*keys, F.col(at).alias("__a"), id_).join(follow_ups.select(*keys, F.col(at).alias("__b")), list(keys)).where(F.col("__b").between(F.col("__a"), F.date_add("__a", days))).select(id_).distinct().withColumn("__hit", F.lit(True))
    return notices.join(hit, id_, "left").withColumn("paired", F.coalesce("__hit", F.lit(False))).drop("__hit")
