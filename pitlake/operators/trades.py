"""Classification and pricing of notified trades, and the screens built on them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The classes in the order in which they are tried, with the wording of each.
# The first that matches decides; every key word is anchored at word boundaries.
CLASS_PATTERNS = [
    ("offmkt_transfer", r"off[\s-]?market"),
    ("margin_or_forced", r"margin\s+(call|loan)|forced\s+(sale|sell)|lender\s+disposal"),
    ("buyback_into", r"buy[\s-]?back"),
    ("exercise", r"exercise\s+of\s+(unlisted\s+)?(options?|rights?)|options?\s+exercise[d]?|conversion\s+of\s+(options?|notes?|convertible)"),
    ("drp", r"dividend\s+reinvestment|reinvestment\s+of\s+(dividends?|distributions?)|\bdrp\b"),
    ("spp_participation", r"share\s+purchase\s+plan|\bspp\b"),
    ("placement_participation", r"\bplacement\b"),
    ("rights_participation", r"rights\s+issue|entitlement\s+offer|(non[\s-]?)?renounceable"),
    ("vesting_incentive", r"\bvest(ing|ed)?\b|performance\s+(rights?|shares?)|incentive\s+plan|employee\s+share|\besop\b|\bltip?\b|\bstip?\b|remuneration|director\s+fee"),
]
ON_MARKET = r"\bon[\s-]?market\b"
# A price reference or a transfer, not a trade on the market.
NOT_A_TRADE = r"based\s+on\s+market|market\s+(value|price)|on[\s-]?market\s+terms|\btransfer\b"
NIL = r"\bnil\b|no\s+consideration"
CASH = r"\$|\baud\b|\bcash\b|per\s+(share|security|unit)"
LIST_MARKER = r"(?im)(?:^)\s*(?:\d{1,2}[.)]|[ivx]{1,4}[.)]|[a-h][.)])\s+"

ACCEPTED = ("auto", "human_accepted", "human_corrected")
CASH_BUY = "onmkt_buy_cash"
STAKE_BAR = 0.25
SMALL_SPEND = 20_000


def classify(text: Column, acquired: Column, disposed: Column, amount: Column) -> Column:
    """The class of a trade from its wording and quantities; what is ambiguous is 'unknown'."""
    said = F.trim(F.coalesce(text, F.lit("")))
    has = lambda pattern: said.rlike(f"(?i){pattern}")
    got, lost = F.coalesce(acquired > 0, F.lit(False)), F.coalesce(disposed > 0, F.lit(False))
    # a field that lists several transactions has no single class
    out = F.when(F.regexp_count(said, F.lit(LIST_MARKER)) >= 2, "unknown")
    for label, pattern in CLASS_PATTERNS:
        out = out.when(has(pattern), label)
    paid = has(CASH) | F.coalesce(amount > 0, F.lit(False))
    on_market = F.when(has(NOT_A_TRADE) | has(NIL), "unknown").when(got & ~lost, F.when(paid, CASH_BUY).otherwise("unknown")).when(lost & ~got, "onmkt_sell").otherwise("unknown")
    return out.when(has(ON_MARKET), on_market).otherwise("unknown")


def unit_price(amount: Column, acquired: Column, disposed: Column) -> Column:
    """Amount for each unit, where money was paid and exactly one side moved; else null."""
    got, lost = F.coalesce(acquired, F.lit(0)), F.coalesce(disposed, F.lit(0))
    return F.when((amount > 0) & ((got > 0) != (lost > 0)), amount / F.when(got > 0, got).otherwise(lost))


def accepted(classification: str = "classification", superseded: str = "superseded", status: str = "review_status") -> Column:
    """Cash buys that count: neither superseded nor waiting for review."""
    return (F.col(classification) == CASH_BUY) & ~F.col(superseded) & F.col(status).isin(*ACCEPTED)


def coverage_flags(base: str, is_member: Column, *more: Column) -> Column:
    """What a reader has to know about a row; a null membership is said, not assumed."""
    return F.array_compact(F.array(F.lit(base), F.when(is_member.isNull(), "membership_unknown"), *more))


def conviction(trades: DataFrame, qty: str, held: str, amount: str, is_member: str, bar: float = STAKE_BAR, small: float = SMALL_SPEND, base: str = "size_ceiling_proxy") -> DataFrame:
    """Buys that raise a holding by at least ``bar`` in entities that aren't members."""
    rows = trades.where((F.col(held) > 0) & (F.col(qty) > 0)).withColumn("stake_increase", F.col(qty) / F.col(held))
    rows = rows.where((F.col("stake_increase") >= bar) & ~F.coalesce(F.col(is_member), F.lit(False)))
    spent = F.col(amount)
    flags = coverage_flags(base, F.col(is_member), F.when(F.coalesce(spent, F.lit(0)) < small, "small_absolute_spend"), F.when(spent.isNull(), "consideration_not_stated"))
    return rows.withColumn("coverage_flags", flags)


def screen(clusters: DataFrame, trades: DataFrame, key: str, ids: str, row_id: str, shares: str, amount: str, person: str) -> DataFrame:
    """Clusters with people, shares and the average price over the trades that state both."""
    members = clusters.select(key, F.explode(ids).alias(row_id)).join(trades, row_id).drop(trades[key] if key in trades.columns else "__none")
    priced = F.col(shares).isNotNull() & F.col(amount).isNotNull()
    total = F.sum(F.when(priced, F.col(shares)))
    spend = F.sum(F.when(priced, F.col(amount)))
    about = members.groupBy(key).agg(
        F.count(F.lit(1)).alias("n_trades"),
        F.count(F.when(priced, 1)).alias("n_priced"),
        total.alias("total_shares"),
        spend.alias("priced_amount"),
        F.round(F.when(total != 0, spend / total), 4).alias("avg_price"),
        F.array_join(F.array_sort(F.collect_set(person)), "; ").alias("people"),
    )
    return clusters.join(about, key, "left").withColumn("partial_price_coverage", F.col("n_priced") < F.col("n_trades"))


def persons(names: DataFrame, norm: Column, raw: str, stored: DataFrame | None = None) -> DataFrame:
    """One live person for each normalised name: stored ones keep their id, new ones get one from their name."""
    new = names.select(norm.alias("name_norm"), F.trim(F.col(raw)).alias("display_name")).where("name_norm != ''").groupBy("name_norm").agg(F.min("display_name").alias("display_name"))
    fresh = new.select(F.xxhash64("name_norm").alias("person_id"), "name_norm", "display_name")
    if stored is None:
        return fresh
    live = stored.where("merged_into is null").groupBy("name_norm").agg(F.min("person_id").alias("person_id"), F.min("display_name").alias("display_name")).select("person_id", "name_norm", "display_name")
    return live.unionByName(fresh.join(live, "name_norm", "left_anti"))
