"""The registered queries of the core engine and their SQL oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.forms import extract_notices
from ..operators import documents as D
from ..operators import events as E
from ..operators import identity as I
from ..operators import quality as Q
from ..operators import registers as G
from ..operators import review as R
from ..operators import snapshots as S
from ..operators import temporal as P
from ..operators import trades as C
from .tables import EVENTS_SQL, ORDERS_SQL, PURCHASES_SQL, events, orders, purchases, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function under its name, with its SQL."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def _day(text: str):
    return F.to_date(F.lit(text))


# ---------------------------------------------------------------- as-of, intervals, bitemporal


@query(f"""WITH {ORDERS_SQL} SELECT o_custkey, o_orderkey, order_day, price FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY order_day DESC, o_orderkey DESC) nr FROM od WHERE order_day <= DATE '1998-06-30') WHERE nr = 1""")
def asof_latest_order(spark, sf):
    """The newest order of each customer at or before one date."""
    return P.as_of_constant(orders(spark, sf), ["o_custkey"], "order_day", _day("1998-06-30"), F.col("o_orderkey").desc()).select("o_custkey", "o_orderkey", "order_day", "price")


@query(f"""WITH {ORDERS_SQL}, line AS (SELECT l_orderkey, l_linenumber, l_partkey, CAST(l_shipdate AS DATE) AS ship_day, o_custkey FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
 mark AS (SELECT o_custkey, order_day, max(o_orderkey) AS k FROM od GROUP BY 1, 2)
 SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, l.ship_day, m.k AS asof_orderkey FROM line l ASOF LEFT JOIN mark m ON m.o_custkey = l.o_custkey AND l.ship_day >= m.order_day""")
def asof_column_date(spark, sf):
    """For each line the newest order of its customer at its own shipping date."""
    o = orders(spark, sf)
    lines = table(spark, sf, "lineitem").join(o.select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey"), "l_orderkey").withColumn("ship_day", F.to_date("l_shipdate")).select("l_orderkey", "l_linenumber", "l_partkey", "ship_day", "o_custkey")
    marks = o.select("o_custkey", "order_day", F.col("o_orderkey").alias("asof_orderkey"), F.col("o_orderkey").alias("tie"))
    return P.as_of_join(lines, marks, ["o_custkey"], "ship_day", "order_day", ["asof_orderkey"], "tie").select("l_orderkey", "l_linenumber", "l_partkey", "ship_day", "asof_orderkey")


@query(f"""WITH {ORDERS_SQL} SELECT o_custkey, o_orderkey, order_day AS valid_from,
  CAST(lead(order_day) OVER (PARTITION BY o_custkey ORDER BY order_day, o_orderkey) - 1 AS DATE) AS valid_to FROM od""")
def scd2_intervals(spark, sf):
    """Orders as effective-dated versions."""
    return P.intervals(orders(spark, sf).select("o_custkey", "o_orderkey", "order_day"), ["o_custkey"], "order_day", "o_orderkey").select("o_custkey", "o_orderkey", "valid_from", "valid_to")


@query(f"""WITH {ORDERS_SQL}, v AS (SELECT o_custkey, o_orderkey, order_day AS f, order_day + 200 AS t FROM od),
 d AS (SELECT c_custkey, CAST(DATE '1997-01-01' + CAST(c_custkey % 365 AS INTEGER) AS DATE) AS day FROM customer),
 h AS (SELECT c_custkey, count(DISTINCT o_orderkey) n, min(o_orderkey) k FROM d JOIN v ON o_custkey = c_custkey AND f <= day AND t >= day GROUP BY 1)
 SELECT d.c_custkey, d.day, CASE WHEN h.n = 1 THEN h.k END AS the_order FROM d LEFT JOIN h USING (c_custkey)""")
def interval_lookup_unique(spark, sf):
    """The only order whose interval holds on a customer's day; null for none or several."""
    v = orders(spark, sf).select("o_custkey", "o_orderkey", F.col("order_day").alias("f"), F.date_add("order_day", 200).alias("t")).withColumnRenamed("o_custkey", "cust")
    d = table(spark, sf, "customer").select("c_custkey", F.col("c_custkey").alias("cust"), F.date_add(_day("1997-01-01"), (F.col("c_custkey") % 365).cast("int")).alias("day"))
    return P.lookup_unique(d, v, ["cust"], "c_custkey", "day", "f", "t", "o_orderkey", "the_order").select("c_custkey", "day", "the_order")


@query(f"""WITH {ORDERS_SQL}, v AS (SELECT o_custkey, o_orderkey, order_day AS f, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE CAST(order_day + 20 AS DATE) END AS t FROM od)
 SELECT a.o_custkey, a.o_orderkey AS id_a, b.o_orderkey AS id_b, greatest(a.f, b.f) AS overlap_from, least(coalesce(a.t, DATE '9999-12-31'), coalesce(b.t, DATE '9999-12-31')) AS overlap_to
 FROM v a JOIN v b ON a.o_custkey = b.o_custkey AND a.o_orderkey < b.o_orderkey AND a.f <= coalesce(b.t, DATE '9999-12-31') AND b.f <= coalesce(a.t, DATE '9999-12-31')""")
def overlap_collisions(spark, sf):
    """Overlapping intervals of one customer; open ones reach to the end of time."""
    v = orders(spark, sf).withColumn("t", F.when(F.col("o_orderstatus") != "P", F.date_add("order_day", 20)))
    return P.overlaps(v, ["o_custkey"], "o_orderkey", "order_day", "t")


@query(f"""WITH {EVENTS_SQL} SELECT event_type, count(*) AS n, CAST(sum(amount) AS DECIMAL(18,2)) AS total FROM ev
 WHERE event_day <= DATE '2024-01-15' AND knowable_day <= DATE '2024-01-17' GROUP BY 1""")
def bitemporal_known_as_of(spark, sf):
    """What had happened by one day, as known on another."""
    e = events(spark, sf).where((F.col("event_day") <= _day("2024-01-15")) & P.known_as_of(F.col("knowable_day"), _day("2024-01-17")))
    return e.groupBy("event_type").agg(F.count("*").alias("n"), F.sum("amount").cast("decimal(18,2)").alias("total"))


@query(f"""WITH {PURCHASES_SQL}, snap AS (SELECT DISTINCT CAST(date_trunc('week', event_day) AS DATE) AS as_of FROM ev),
 mem AS (SELECT DISTINCT CAST(date_trunc('week', event_day) AS DATE) AS as_of, entity FROM ev WHERE event_type = 'click' AND entity IS NOT NULL AND user_id % 3 = 0),
 p AS (SELECT event_id, entity, event_day, (SELECT max(as_of) FROM snap WHERE as_of <= event_day AND as_of + 2 <= event_day) AS best FROM pu)
 SELECT event_id, entity, event_day, CASE WHEN best IS NULL OR event_day - best > 8 THEN NULL ELSE EXISTS (SELECT 1 FROM mem m WHERE m.as_of = p.best AND m.entity = p.entity) END AS is_member FROM p""")
def membership_3valued(spark, sf):
    """Membership by the newest snapshot knowable on the day; null where there is none or it is stale."""
    e = events(spark, sf)
    week = F.to_date(F.date_trunc("week", "event_day"))
    snaps = e.select(week.alias("as_of")).distinct().withColumn("knowable_at", F.date_add("as_of", 2))
    members = e.where("event_type = 'click' and entity is not null and user_id % 3 = 0").select(week.alias("as_of"), "entity").distinct()
    return P.membership(purchases(spark, sf).select("event_id", "entity", "event_day"), snaps, members, "entity", "event_day", 8).select("event_id", "entity", "event_day", "is_member")


@query(f"""WITH {EVENTS_SQL}, c AS (SELECT user_id, event_id, ts FROM ev WHERE event_type = 'click'), p AS (SELECT user_id, event_id, ts FROM ev WHERE event_type = 'purchase'),
 x AS (SELECT p.event_id, c.event_id AS click_id, abs(epoch_us(p.ts) - epoch_us(c.ts)) AS gap_us, row_number() OVER (PARTITION BY p.event_id ORDER BY abs(epoch_us(p.ts) - epoch_us(c.ts)), c.event_id) nr FROM p JOIN c USING (user_id))
 SELECT p.event_id, x.click_id, x.gap_us FROM p LEFT JOIN x ON x.event_id = p.event_id AND nr = 1""")
def nearest_event(spark, sf):
    """The nearest click of each purchase's user."""
    e = events(spark, sf).select("user_id", "event_id", "ts", "event_type")
    clicks = e.where("event_type = 'click'").withColumnRenamed("event_id", "click_id")
    return P.nearest_join(e.where("event_type = 'purchase'"), clicks, ["user_id"], "event_id", "ts", "click_id", "ts")


@query(f"""WITH {EVENTS_SQL} SELECT a.event_id AS alert_id, b.event_id AS doc_id FROM ev a JOIN ev b ON a.user_id = b.user_id AND a.event_type = 'signup' AND b.event_type = 'purchase'
 AND epoch_us(b.ts) - epoch_us(a.ts) BETWEEN -1800 * 1000000::BIGINT AND 64800 * 1000000::BIGINT""")
def alert_pairing(spark, sf):
    """Pairs of one user from half an hour before to eighteen hours after."""
    e = events(spark, sf)
    a = e.where("event_type = 'signup'").select("user_id", F.col("event_id").alias("alert_id"), F.col("ts").alias("alert_at"))
    b = e.where("event_type = 'purchase'").select("user_id", F.col("event_id").alias("doc_id"), F.col("ts").alias("doc_at"))
    return P.window_pairs(a, b, ["user_id"], "alert_at", "doc_at", D.EARLY_S, D.LATE_S).select("alert_id", "doc_id")


@query("""SELECT event_id, CAST((ts AT TIME ZONE 'UTC') AT TIME ZONE 'Australia/Sydney' AS DATE) AS market_day FROM events""")
def market_date(spark, sf):
    """The market's calendar day of each event."""
    return table(spark, sf, "events").select("event_id", P.market_date(F.col("ts")).alias("market_day"))


@query(f"""WITH {ORDERS_SQL}, m AS (SELECT o_custkey, price, o_orderpriority = '1-URGENT' AS legal FROM od WHERE order_day BETWEEN DATE '1998-01-01' AND DATE '1998-12-31')
 SELECT o_custkey, CASE WHEN count(*) FILTER (WHERE legal) = 1 THEN max(price) FILTER (WHERE legal) WHEN count(*) = 1 THEN max(price) END AS the_price FROM m GROUP BY 1""")
def single_or_blank(spark, sf):
    """The urgent order's price if there is one of them, else the only order's, else nothing."""
    m = orders(spark, sf).where(F.col("order_day").between(_day("1998-01-01"), _day("1998-12-31")))
    return P.single_or_blank(m, ["o_custkey"], "price", F.col("o_orderpriority") == "1-URGENT", "the_price")


# ---------------------------------------------------------------- folds


def _share_log(spark, sf):
    """lineitem as a share log: the first line of a part is its anchor, first lines of orders are ratios, others deltas."""
    l = table(spark, sf, "lineitem").select("l_partkey", F.to_date("l_shipdate").alias("event_date"), (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("event_id"), "l_linenumber", "l_orderkey", "l_returnflag", F.col("l_quantity").cast("decimal(38,10)").alias("q"))
    ratio = F.col("l_linenumber") == 1
    l = l.withColumn("kind", F.when(F.col("l_returnflag") == "R", "issue_proposed").when(ratio, "split").otherwise("issue"))
    l = l.withColumn("ratio_num", F.when(ratio, F.lit(5).cast("decimal(38,10)"))).withColumn("ratio_den", F.when(ratio, F.lit(4).cast("decimal(38,10)"))).withColumn("qty_delta", F.when(~ratio, F.col("q")))
    events_ = l.withColumn("knowable_at", F.date_add("event_date", (F.col("l_orderkey") % 10).cast("int")))
    first = Window.partitionBy("l_partkey").orderBy("event_date", "event_id")
    anchors = l.withColumn("nr", F.row_number().over(first)).where("nr = 1 and l_partkey % 7 != 3").select("l_partkey", F.col("event_date").alias("anchor_date"), (F.col("q") * 100).cast("decimal(38,10)").alias("anchor_qty"), F.col("event_date").alias("knowable_at"))
    return anchors, events_


_SHARES = """l AS (SELECT l_partkey, CAST(l_shipdate AS DATE) AS event_date, l_orderkey * 8 + l_linenumber AS event_id, l_linenumber, l_orderkey, l_returnflag, CAST(l_quantity AS DECIMAL(38,10)) AS q FROM lineitem),
 a AS (SELECT l_partkey, event_date AS anchor_date, CAST(q * 100 AS DECIMAL(38,10)) AS anchor_qty FROM (SELECT *, row_number() OVER (PARTITION BY l_partkey ORDER BY event_date, event_id) nr FROM l) WHERE nr = 1 AND l_partkey % 7 <> 3 {anchor_cut}),
 s AS (SELECT l.l_partkey, l_linenumber = 1 AS ratio, q, row_number() OVER (PARTITION BY l.l_partkey ORDER BY event_date, event_id) AS i FROM l JOIN a USING (l_partkey) WHERE l_returnflag <> 'R' AND event_date > anchor_date {event_cut}),
 f AS (SELECT l_partkey, anchor_qty AS qty, CAST(0 AS BIGINT) AS i FROM a UNION ALL
   SELECT f.l_partkey, CASE WHEN s.ratio THEN CAST(CAST(f.qty AS DECIMAL(28,10)) * 5 / 4 AS DECIMAL(38,10)) ELSE CAST(f.qty + s.q AS DECIMAL(38,10)) END, s.i FROM f JOIN s ON s.l_partkey = f.l_partkey AND s.i = f.i + 1)
 SELECT p.l_partkey, a.anchor_date, coalesce(g.n, 0) AS n_events, CAST(round(CAST(g.qty AS DOUBLE), 2) AS DOUBLE) AS quantity FROM (SELECT DISTINCT l_partkey FROM l) p LEFT JOIN a USING (l_partkey) LEFT JOIN (SELECT l_partkey, max(i) AS n, arg_max(qty, i) AS qty FROM f GROUP BY 1) g USING (l_partkey)"""


@query("WITH RECURSIVE " + _SHARES.format(anchor_cut="", event_cut=""))
def share_replay(spark, sf):
    """Quantities from an anchor through ratios and deltas in order."""
    a, e = _share_log(spark, sf)
    return E.replay(a, e, ["l_partkey"]).withColumn("quantity", F.round(F.col("quantity").cast("double"), 2))


@query("WITH RECURSIVE " + _SHARES.format(anchor_cut="AND event_date <= DATE '1998-06-30'", event_cut="AND event_date <= DATE '1998-12-31' AND event_date + CAST(l_orderkey % 10 AS INTEGER) <= DATE '1998-06-30'"))
def share_replay_known(spark, sf):
    """The same as of one day, with what was known on an earlier one."""
    a, e = _share_log(spark, sf)
    return E.replay(a, e, ["l_partkey"], _day("1998-12-31"), _day("1998-06-30")).withColumn("quantity", F.round(F.col("quantity").cast("double"), 2))


@query("""WITH r AS (SELECT l_partkey, CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS replayed FROM lineitem WHERE l_returnflag <> 'R' GROUP BY 1),
 x AS (SELECT l_partkey, CASE WHEN l_partkey % 11 = 0 THEN NULL WHEN l_partkey % 13 = 0 THEN CAST(0 AS DECIMAL(18,2)) ELSE CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) FILTER (WHERE l_returnflag <> 'R') + (l_partkey % 5) AS DECIMAL(18,2)) END AS ext FROM lineitem GROUP BY l_partkey),
 j AS (SELECT p_partkey, replayed, ext FROM part LEFT JOIN r ON r.l_partkey = p_partkey LEFT JOIN x ON x.l_partkey = p_partkey),
 k AS (SELECT *, CASE WHEN replayed IS NULL OR ext IS NULL THEN NULL WHEN ext = 0 THEN replayed = 0 ELSE abs(CAST(replayed AS DOUBLE) - CAST(ext AS DOUBLE)) / abs(CAST(ext AS DOUBLE)) <= 0.005 END AS within_tolerance FROM j)
 SELECT p_partkey, within_tolerance, replayed IS NULL OR coalesce(NOT within_tolerance, false) AS needs_review FROM k""")
def reconcile_tolerance(spark, sf):
    """Replayed against external figures: half a per cent, zero only equals zero, missing is no verdict."""
    l = table(spark, sf, "lineitem").withColumn("q", F.when(F.col("l_returnflag") != "R", F.col("l_quantity").cast("decimal(18,2)")))
    r = l.groupBy(F.col("l_partkey").alias("p_partkey")).agg(F.sum("q").cast("decimal(18,2)").alias("replayed"))
    ext = F.when(F.col("p_partkey") % 11 == 0, None).when(F.col("p_partkey") % 13 == 0, F.lit(0)).otherwise(F.col("replayed") + F.col("p_partkey") % 5).cast("decimal(18,2)")
    known = table(spark, sf, "part").select("p_partkey").join(r.withColumn("ext", ext), "p_partkey", "left")
    return Q.reconcile(known.withColumn("replayed", F.col("replayed").cast("double")).withColumn("ext", F.col("ext").cast("double")), "replayed", "ext").select("p_partkey", "within_tolerance", "needs_review")


_CLUSTERS = PURCHASES_SQL + """, d AS (SELECT DISTINCT entity, event_day FROM pu),
 w AS (SELECT d.entity, d.event_day AS s, max(p.event_day) AS e, count(DISTINCT p.user_id) AS n FROM d JOIN pu p ON p.entity = d.entity AND p.event_day BETWEEN d.event_day AND d.event_day + 3 GROUP BY 1, 2 HAVING count(DISTINCT p.user_id) >= 2),
 g AS (SELECT entity, min(s) AS s FROM w GROUP BY 1 UNION ALL SELECT g.entity, (SELECT min(w.s) FROM w WHERE w.entity = g.entity AND w.s > g.s + 3) FROM g WHERE g.s IS NOT NULL),
 c AS (SELECT w.entity, w.s AS window_start, w.e AS window_end, w.n AS n_persons FROM g JOIN w ON w.entity = g.entity AND w.s = g.s)"""


@query("WITH RECURSIVE " + _CLUSTERS + """ SELECT c.entity, window_start, window_end, n_persons, count(*) AS n_rows, CAST(sum(amount) AS DECIMAL(18,2)) AS total_amount, max(knowable_day) AS knowable_at,
 string_agg(CAST(event_id AS VARCHAR), ',' ORDER BY event_id) AS member_ids FROM c JOIN pu ON pu.entity = c.entity AND event_day BETWEEN window_start AND window_end GROUP BY 1, 2, 3, 4""")
def cluster_buys(spark, sf):
    """Greedy windows in which at least two persons bought in one entity."""
    c = E.clusters(purchases(spark, sf), "entity", "event_day", "user_id", "event_id", "amount", "knowable_day", 3, 2)
    ids = F.array_join(F.transform("member_ids", lambda x: x.cast("string")), ",")
    return c.select("entity", "window_start", "window_end", F.col("n_persons").cast("long").alias("n_persons"), F.size("member_ids").cast("long").alias("n_rows"), F.col("total_amount").cast("decimal(18,2)").alias("total_amount"), "knowable_at", ids.alias("member_ids"))


@query("WITH RECURSIVE " + _CLUSTERS + """, m AS (SELECT c.*, event_id, user_id, amount, CASE WHEN event_id % 5 = 0 THEN NULL ELSE event_id % 9 + 1 END AS shares FROM c JOIN pu ON pu.entity = c.entity AND event_day BETWEEN window_start AND window_end)
 SELECT entity, window_start, count(*) AS n_trades, count(shares) AS n_priced, CAST(sum(shares) AS BIGINT) AS total_shares, round(CAST(sum(amount) FILTER (WHERE shares IS NOT NULL) AS DOUBLE) / CAST(sum(shares) AS DOUBLE) + 1e-9, 4) AS avg_price,
 string_agg(DISTINCT CAST(user_id AS VARCHAR), '; ' ORDER BY CAST(user_id AS VARCHAR)) AS people, count(shares) < count(*) AS partial_price_coverage FROM m GROUP BY 1, 2""")
def cluster_avg_price(spark, sf):
    """The screen of clusters: who, how many shares, and the size-weighted price over what is priced."""
    p = purchases(spark, sf).withColumn("shares", F.when(F.col("event_id") % 5 != 0, F.col("event_id") % 9 + 1)).withColumn("person", F.col("user_id").cast("string"))
    c = E.clusters(p, "entity", "event_day", "user_id", "event_id", "amount", "knowable_day", 3, 2).withColumn("cluster", F.struct("entity", "window_start"))
    out = C.screen(c, p.select("event_id", "shares", "person", F.col("amount").cast("double").alias("amount")), "cluster", "member_ids", "event_id", "shares", "amount", "person")
    price = F.when(F.col("total_shares") != 0, F.round(F.col("priced_amount").cast("decimal(18,2)").cast("double") / F.col("total_shares").cast("double") + 1e-9, 4))
    return out.select("entity", "window_start", "n_trades", "n_priced", "total_shares", price.alias("avg_price"), "people", "partial_price_coverage")


@query(f"""WITH {PURCHASES_SQL}, h AS (SELECT *, sum(amount) OVER (PARTITION BY entity, user_id ORDER BY event_day, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS held FROM pu)
 SELECT event_id, entity, user_id, round(CAST(amount AS DOUBLE) / CAST(held AS DOUBLE), 6) AS stake_increase,
 'size_ceiling_proxy' || CASE WHEN entity % 4 = 0 THEN '|membership_unknown' ELSE '' END || CASE WHEN event_id % 3 = 0 OR amount < 20 THEN '|small_absolute_spend' ELSE '' END || CASE WHEN event_id % 3 = 0 THEN '|consideration_not_stated' ELSE '' END AS flags
 FROM h WHERE held > 0 AND amount > 0 AND CAST(amount AS DOUBLE) / CAST(held AS DOUBLE) >= 0.25 AND NOT coalesce(CASE WHEN entity % 4 = 0 THEN NULL ELSE entity % 4 = 1 END, false)""")
def conviction_buys(spark, sf):
    """Buys that raise what a person holds by a quarter, in entities that aren't members."""
    before = Window.partitionBy("entity", "user_id").orderBy("event_day", "event_id").rowsBetween(Window.unboundedPreceding, -1)
    p = purchases(spark, sf).withColumn("held", F.sum("amount").over(before).cast("double")).withColumn("qty", F.col("amount").cast("double"))
    p = p.withColumn("member", F.when(F.col("entity") % 4 != 0, F.col("entity") % 4 == 1)).withColumn("spent", F.when(F.col("event_id") % 3 != 0, F.col("amount")))
    return C.conviction(p, "qty", "held", "spent", "member", small=20).select("event_id", "entity", "user_id", F.round("stake_increase", 6).alias("stake_increase"), F.array_join("coverage_flags", "|").alias("flags"))


@query(f"""WITH {EVENTS_SQL}, g AS (SELECT *, event_id % 40 AS doc FROM ev WHERE event_type IN ('purchase', 'click')),
 d AS (SELECT entity, user_id, event_day, event_type, doc, max(knowable_day) AS k FROM g GROUP BY ALL),
 r AS (SELECT *, row_number() OVER w AS nr, lead(doc) OVER w AS nxt FROM d WINDOW w AS (PARTITION BY entity, user_id, event_day, event_type ORDER BY k DESC, doc DESC))
 SELECT g.event_id, r.nr > 1 AS superseded, CASE WHEN r.nr = 1 THEN r.nxt END AS supersedes_doc FROM g JOIN r ON r.entity IS NOT DISTINCT FROM g.entity AND r.user_id IS NOT DISTINCT FROM g.user_id AND r.event_day = g.event_day AND r.event_type = g.event_type AND r.doc = g.doc""")
def supersede_latest(spark, sf):
    """The latest document of a group wins; its rows point at the runner-up."""
    g = events(spark, sf).where("event_type in ('purchase', 'click')").withColumn("doc", F.col("event_id") % 40)
    return E.supersede(g, ["entity", "user_id", "event_day", "event_type"], "doc", "knowable_day").select("event_id", "superseded", "supersedes_doc")


@query(f"""WITH {EVENTS_SQL}, o AS (SELECT event_id, entity, event_day AS d, amount FROM ev WHERE event_type = 'purchase'), i AS (SELECT event_id + 1000000000 AS event_id, entity, event_day AS d, amount FROM ev WHERE event_type = 'refund')
 SELECT entity, count(*) AS n, CAST(sum(amount) AS DECIMAL(18,2)) AS total FROM (SELECT * FROM o WHERE NOT EXISTS (SELECT 1 FROM i WHERE i.entity = o.entity) UNION ALL SELECT * FROM i) GROUP BY 1""")
def replace_documents(spark, sf):
    """Delete-then-insert by document: an incoming document replaces all its stored rows."""
    e = events(spark, sf).select("event_id", "entity", "event_type", "amount")
    out = E.replace_documents(e.where("event_type = 'purchase'").drop("event_type"), e.where("event_type = 'refund'").drop("event_type"), "entity")
    return out.groupBy("entity").agg(F.count("*").alias("n"), F.sum("amount").cast("decimal(18,2)").alias("total"))


# ---------------------------------------------------------------- classification and prices

_PHRASES = [
    "On market purchase for cash", "On-market trade", "off market transfer to spouse", "Margin call sale by lender", "Participation in buy-back", "Exercise of unlisted options", "Dividend reinvestment plan", "Share purchase plan (SPP)",
    "Placement approved at meeting", "Pro rata entitlement offer", "Vesting of performance rights", "On market, nil consideration", "based on market price, on market terms", "Conversion of notes",
    "1. Conversion of rights\n2. On market trades", "Gift", "", "Director fees paid in shares", "On market at $1.20 per share", "renounceable rights issue", "Employee share scheme", "Forced sale", "investment for divestment", "Issue under DRP", "LTIP allocation",
]


def _phrased(spark, sf):
    said = F.element_at(F.array(*(F.lit(p) for p in _PHRASES)), (F.col("event_id") % len(_PHRASES) + 1).cast("int"))
    e = events(spark, sf).withColumn("said", said)
    e = e.withColumn("got", F.when(F.col("event_type").isin("purchase", "click"), F.col("amount"))).withColumn("lost", F.when(F.col("event_type").isin("refund", "click", "error"), F.col("amount")))
    return e.withColumn("aud", F.when(F.col("user_id") % 2 == 0, F.col("amount")))


def _duck(pattern: str) -> str:
    return "regexp_matches(s, '(?i)" + pattern.replace("'", "''") + "')"


_CLASSIFY = f"""WITH {EVENTS_SQL}, t AS (SELECT event_id, trim([{", ".join("'" + p.replace("'", "''") + "'" for p in _PHRASES)}][CAST(event_id % {len(_PHRASES)} + 1 AS INTEGER)]) AS s,
 CASE WHEN event_type IN ('purchase','click') THEN amount END AS got, CASE WHEN event_type IN ('refund','click','error') THEN amount END AS lost, CASE WHEN user_id % 2 = 0 THEN amount END AS aud FROM ev)
 SELECT event_id, CASE WHEN len(regexp_extract_all(s, '(?im)^\\s*(?:\\d{{1,2}}[.)]|[ivx]{{1,4}}[.)]|[a-h][.)])\\s+')) >= 2 THEN 'unknown' {" ".join(f"WHEN {_duck(p)} THEN '{n}'" for n, p in C.CLASS_PATTERNS)}
 WHEN {_duck(C.ON_MARKET)} THEN CASE WHEN {_duck(C.NOT_A_TRADE)} OR {_duck(C.NIL)} THEN 'unknown' WHEN coalesce(got > 0, false) AND NOT coalesce(lost > 0, false) THEN CASE WHEN {_duck(C.CASH)} OR coalesce(aud > 0, false) THEN 'onmkt_buy_cash' ELSE 'unknown' END
 WHEN coalesce(lost > 0, false) AND NOT coalesce(got > 0, false) THEN 'onmkt_sell' ELSE 'unknown' END ELSE 'unknown' END AS classification FROM t"""


@query(_CLASSIFY)
def trade_classify(spark, sf):
    """Each wording's class; the first rule that matches decides, ambiguity is unknown."""
    e = _phrased(spark, sf)
    return e.select("event_id", C.classify(F.col("said"), F.col("got"), F.col("lost"), F.col("aud")).alias("classification"))


@query(_CLASSIFY.replace("SELECT event_id, CASE WHEN len", "SELECT classification, count(*) AS n FROM (SELECT event_id, CASE WHEN len") + ") GROUP BY 1")
def class_counts(spark, sf):
    """How many of each class."""
    return trade_classify(spark, sf).groupBy("classification").agg(F.count("*").alias("n"))


@query("""SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_linenumber % 3 <> 0 AND NOT (l_linenumber % 3 = 1 AND l_returnflag = 'A') THEN round(l_extendedprice / l_quantity + 1e-9, 6) END AS unit_price FROM lineitem""")
def unit_price(spark, sf):
    """Price for one where exactly one side moved and money was paid."""
    l = table(spark, sf, "lineitem")
    got = F.when(F.col("l_linenumber") % 3 == 1, F.col("l_quantity"))
    lost = F.when((F.col("l_linenumber") % 3 == 2) | ((F.col("l_linenumber") % 3 == 1) & (F.col("l_returnflag") == "A")), F.col("l_quantity"))
    return l.select("l_orderkey", "l_linenumber", "l_partkey", F.round(C.unit_price(F.col("l_extendedprice"), got, lost) + 1e-9, 6).alias("unit_price"))


_TITLES = [
    "Change of Director's Interest Notice", "Final Director's Interest Notice", "Appendix 3B", "Application for quotation of securities", "Release from escrow", "Becoming a substantial holder", "Change in substantial holding",
    "Ceasing to be a substantial holder", "Quarterly Activities Report", "Half Year Financial Report", "Annual Report to shareholders", "Consolidation of capital", "Notice of Annual General Meeting", "Cleansing Notice", "Prospectus",
    "Change of Officer's Interest Notice", "Trading update", "",
]


@query(f"""WITH t AS (SELECT event_id, [{", ".join("'" + x.replace("'", "''") + "'" for x in _TITLES)}][CAST(event_id % {len(_TITLES)} + 1 AS INTEGER)] AS s FROM events),
 c AS (SELECT event_id, s, CASE {" ".join(f"WHEN {_duck(p)} THEN '{n}'" for n, p in D.TITLE_CLASSES)} END AS c FROM t)
 SELECT event_id, coalesce(c, 'other') AS doc_class, CASE WHEN c IS NOT NULL THEN 'rules' WHEN {_duck(D.INTEREST)} THEN 'ambiguous' ELSE 'default' END AS method FROM c""")
def title_classify(spark, sf):
    """Title classes; what looks like an interest but isn't a known form is ambiguous."""
    said = F.element_at(F.array(*(F.lit(t) for t in _TITLES)), (F.col("event_id") % len(_TITLES) + 1).cast("int"))
    return table(spark, sf, "events").select("event_id", D.title_class(said).alias("c")).select("event_id", "c.doc_class", "c.method")


# ---------------------------------------------------------------- snapshots and universe

_CUSTOMER_CAP = "cap AS (SELECT c_custkey, c_mktsegment, CASE WHEN c_acctbal < 0 THEN NULL ELSE CAST(c_acctbal AS DECIMAL(18,2)) END AS cap FROM customer)"


def _caps(spark, sf):
    return table(spark, sf, "customer").select("c_custkey", "c_mktsegment", F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal").cast("decimal(18,2)")).alias("cap"))


@query(f"WITH {_CUSTOMER_CAP} SELECT c_custkey, cap, CASE WHEN cap IS NOT NULL THEN rank() OVER (PARTITION BY c_mktsegment ORDER BY cap DESC NULLS LAST) END AS cap_rank FROM cap")
def universe_rank(spark, sf):
    """Rank by capitalisation within a segment; unknown ones have none."""
    rank = F.rank().over(Window.partitionBy("c_mktsegment").orderBy(F.col("cap").desc_nulls_last()))
    return _caps(spark, sf).select("c_custkey", "cap", F.when(F.col("cap").isNotNull(), rank).alias("cap_rank"))


@query(f"""WITH {_CUSTOMER_CAP}, r AS (SELECT *, rank() OVER (PARTITION BY c_mktsegment ORDER BY cap DESC NULLS LAST) AS k FROM cap)
 SELECT c_mktsegment, CASE WHEN cap IS NULL THEN 'unknown' WHEN cap > 9000 OR k <= 10 THEN 'too_large' ELSE 'kept' END AS label, count(*) AS n FROM r GROUP BY ALL""")
def size_filter_accounting(spark, sf):
    """How many are kept, too large, or of unknown size."""
    rank = F.rank().over(Window.partitionBy("c_mktsegment").orderBy(F.col("cap").desc_nulls_last()))
    return _caps(spark, sf).withColumn("label", S.size_label(F.col("cap"), rank, 9000, 10)).groupBy("c_mktsegment", "label").agg(F.count("*").alias("n"))


def _months(spark, sf):
    o = orders(spark, sf)
    of = lambda a, b: o.where(F.col("order_day").between(_day(a), _day(b))).groupBy("o_custkey").agg(F.max("o_orderpriority").alias("priority"))
    return of("1998-01-01", "1998-06-30"), of("1998-07-01", "1998-12-31")


@query(f"""WITH {ORDERS_SQL}, a AS (SELECT o_custkey, max(o_orderpriority) p FROM od WHERE order_day BETWEEN DATE '1998-01-01' AND DATE '1998-06-30' GROUP BY 1), b AS (SELECT o_custkey, max(o_orderpriority) p FROM od WHERE order_day BETWEEN DATE '1998-07-01' AND DATE '1998-12-31' GROUP BY 1)
 SELECT coalesce(a.o_custkey, b.o_custkey) AS o_custkey, CASE WHEN a.o_custkey IS NULL THEN 'opened' WHEN b.o_custkey IS NULL THEN 'closed' WHEN a.p <> b.p THEN 'changed' ELSE 'kept' END AS change FROM a FULL JOIN b ON a.o_custkey = b.o_custkey""")
def snapshot_diff(spark, sf):
    """What opened, closed, changed and stayed between two snapshots."""
    return S.diff(*_months(spark, sf), ["o_custkey"], ["priority"])


@query(f"""WITH {ORDERS_SQL}, a AS (SELECT DISTINCT o_custkey FROM od WHERE order_day BETWEEN DATE '1998-01-01' AND DATE '1998-06-30'), b AS (SELECT DISTINCT o_custkey FROM od WHERE order_day BETWEEN DATE '1998-07-01' AND DATE '1998-08-31'),
 n AS (SELECT (SELECT count(*) FROM a) AS n_open, (SELECT count(*) FROM b) AS n_snapshot) SELECT n_open, n_snapshot, n_open - n_snapshot AS implied_closed, n_snapshot < 20 OR (n_open > 0 AND n_open - n_snapshot > greatest(n_open * 0.10, 25)) AS refuse FROM n""")
def snapshot_gate(spark, sf):
    """Whether a snapshot would close too much to be believed."""
    o = orders(spark, sf)
    of = lambda a, b: o.where(F.col("order_day").between(_day(a), _day(b))).select("o_custkey").distinct()
    return S.gate(of("1998-01-01", "1998-06-30"), of("1998-07-01", "1998-08-31"), least_rows=20)


@query(f"""WITH {ORDERS_SQL}, h AS (SELECT o_custkey % 50 AS entity, 'C' || CAST(o_custkey AS VARCHAR) AS code, min(order_day) AS valid_from, CASE WHEN o_custkey % 5 = 0 THEN max(order_day) END AS valid_to FROM od WHERE order_day < DATE '1998-01-01' GROUP BY o_custkey),
 s AS (SELECT (o_custkey + CASE WHEN o_custkey % 17 = 0 THEN 1 ELSE 0 END) % 50 AS entity, 'C' || CAST(o_custkey AS VARCHAR) AS code, min(order_day) AS listed FROM od WHERE order_day >= DATE '1998-01-01' AND o_custkey % 50 <> 7 GROUP BY o_custkey),
 old AS (SELECT h.entity, h.code, h.valid_from, CASE WHEN h.valid_to IS NULL AND (coalesce(s.entity <> h.entity, false) OR h.entity NOT IN (SELECT entity FROM s)) THEN DATE '2002-01-01' - 1 ELSE h.valid_to END::DATE AS valid_to FROM h LEFT JOIN s ON s.code = h.code),
 lst AS (SELECT code, max(coalesce(valid_to, valid_from)) AS l FROM old GROUP BY 1)
 SELECT * FROM old UNION ALL SELECT s.entity, s.code, least(CASE WHEN l.l IS NOT NULL THEN greatest(s.listed, CAST(l.l + 1 AS DATE)) ELSE s.listed END, DATE '2002-01-01') AS valid_from, NULL::DATE AS valid_to FROM s LEFT JOIN lst l USING (code) WHERE NOT EXISTS (SELECT 1 FROM old o WHERE o.entity = s.entity AND o.code = s.code AND o.valid_to IS NULL)""")
def snapshot_apply(spark, sf):
    """Listing history after a snapshot: moved and absent codes close, new ones open."""
    o = orders(spark, sf).withColumn("code", F.concat(F.lit("C"), F.col("o_custkey").cast("string")))
    h = o.where(F.col("order_day") < _day("1998-01-01")).groupBy("o_custkey", "code").agg(F.min("order_day").alias("valid_from"), F.max("order_day").alias("last"))
    h = h.select((F.col("o_custkey") % 50).alias("entity"), "code", "valid_from", F.when(F.col("o_custkey") % 5 == 0, F.col("last")).alias("valid_to"))
    moved = F.when(F.col("o_custkey") % 17 == 0, 1).otherwise(0)
    s = o.where((F.col("order_day") >= _day("1998-01-01")) & (F.col("o_custkey") % 50 != 7)).groupBy("o_custkey", "code").agg(F.min("order_day").alias("listed")).select(((F.col("o_custkey") + moved) % 50).alias("entity"), "code", "listed")
    return S.apply_snapshot(h, s, "entity", "code", _day("2002-01-01")).select("entity", "code", "valid_from", "valid_to")


@query(f"""WITH {ORDERS_SQL}, r AS (SELECT o_custkey, 'N' || CAST(o_orderkey AS VARCHAR) AS name, row_number() OVER (PARTITION BY o_custkey ORDER BY order_day DESC, o_orderkey DESC) = 1 AS cur, CASE WHEN o_custkey % 4 = 0 THEN NULL ELSE min(order_day) OVER (PARTITION BY o_custkey) END AS reg, CASE WHEN o_custkey % 3 = 0 THEN NULL ELSE max(order_day) OVER (PARTITION BY o_custkey) END AS chg FROM od),
 t AS (SELECT *, CASE WHEN bool_or(NOT cur) OVER (PARTITION BY o_custkey) THEN chg END AS tr FROM r),
 i AS (SELECT o_custkey, name, CASE WHEN cur THEN 'legal' ELSE 'former' END AS name_kind, CASE WHEN cur THEN coalesce(tr, reg, DATE '1900-01-01') ELSE coalesce(reg, DATE '1900-01-01') END AS valid_from, CASE WHEN NOT cur THEN CAST(tr - 1 AS DATE) END AS e FROM t)
 SELECT o_custkey, name, name_kind, valid_from, CASE WHEN e < valid_from THEN valid_from ELSE e END AS valid_to FROM i""")
def name_history(spark, sf):
    """Registered names as honest intervals."""
    o, whole = orders(spark, sf), Window.partitionBy("o_custkey")
    latest = F.row_number().over(whole.orderBy(F.col("order_day").desc(), F.col("o_orderkey").desc())) == 1
    r = o.select("o_custkey", F.concat(F.lit("N"), F.col("o_orderkey").cast("string")).alias("name"), F.lit("x").alias("name_norm"), latest.alias("is_current_name"), F.when(F.col("o_custkey") % 4 != 0, F.min("order_day").over(whole)).alias("registration_date"), F.when(F.col("o_custkey") % 3 != 0, F.max("order_day").over(whole)).alias("current_name_start_date"))
    return S.name_history(r, "o_custkey").drop("name_norm")


@query("""WITH s AS (SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN c_mktsegment END AS segment, CAST(c_acctbal AS DECIMAL(18,2)) AS bal FROM customer WHERE c_custkey % 3 <> 0),
 n AS (SELECT c_custkey, c_mktsegment || '!' AS segment, CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE CAST(c_acctbal + 1 AS DECIMAL(18,2)) END AS bal FROM customer WHERE c_custkey % 4 <> 0)
 SELECT coalesce(n.c_custkey, s.c_custkey) AS c_custkey, coalesce(n.segment, s.segment) AS segment, coalesce(n.bal, s.bal) AS bal FROM s FULL JOIN n ON s.c_custkey = n.c_custkey""")
def registry_upsert(spark, sf):
    """New rows replace stored ones; what they don't say stays."""
    c = table(spark, sf, "customer")
    s = c.where("c_custkey % 3 != 0").select("c_custkey", F.when(F.col("c_custkey") % 2 == 0, F.col("c_mktsegment")).alias("segment"), F.col("c_acctbal").cast("decimal(18,2)").alias("bal"))
    n = c.where("c_custkey % 4 != 0").select("c_custkey", F.concat("c_mktsegment", F.lit("!")).alias("segment"), F.when(F.col("c_custkey") % 5 != 0, F.col("c_acctbal") + 1).cast("decimal(18,2)").alias("bal"))
    return S.upsert(s, n, ["c_custkey"])


@query(f"""WITH {ORDERS_SQL} SELECT c_custkey, EXISTS (SELECT 1 FROM od WHERE o_custkey = c_custkey AND order_day BETWEEN DATE '1998-01-01' AND DATE '1998-12-31') AS seen FROM customer""")
def semi_anti_seen(spark, sf):
    """Customers with and without an order in a year: semi and anti join."""
    c = table(spark, sf, "customer").select("c_custkey")
    o = orders(spark, sf).where(F.col("order_day").between(_day("1998-01-01"), _day("1998-12-31"))).select(F.col("o_custkey").alias("c_custkey"))
    return c.join(o, "c_custkey", "left_semi").withColumn("seen", F.lit(True)).unionByName(c.join(o, "c_custkey", "left_anti").withColumn("seen", F.lit(False)))


# ---------------------------------------------------------------- identity

_NAME = "p_name || CASE CAST(p_partkey % 4 AS INTEGER) WHEN 0 THEN ' Holdings Pty. Ltd' WHEN 1 THEN ' LIMITED' WHEN 2 THEN ' & Co., Inc.' ELSE '' END"
_NORM = "regexp_replace(trim(regexp_replace(regexp_replace(upper({n}), '[^A-Z0-9_ ]', ' ', 'g'), '\\s+', ' ', 'g')), '(\\s(LIMITED|LTD|PTY|PROPRIETARY|NL|INC|HOLDINGS))+$', '')"


def _names(spark, sf):
    tail = F.element_at(F.array(F.lit(" Holdings Pty. Ltd"), F.lit(" LIMITED"), F.lit(" & Co., Inc."), F.lit("")), (F.col("p_partkey") % 4 + 1).cast("int"))
    return table(spark, sf, "part").withColumn("raw", F.concat("p_name", tail))


@query(f"SELECT p_partkey, {_NORM.format(n='(' + _NAME + ')')} AS name_norm FROM part")
def name_norm(spark, sf):
    """Names without punctuation and trailing company words."""
    return _names(spark, sf).select("p_partkey", T.company_norm(F.col("raw"), unicode=False).alias("name_norm"))


@query(f"""WITH p AS (SELECT DISTINCT p_partkey, upper(p_name || ' ' || CAST(p_size AS VARCHAR) || ' ' || p_brand) AS k FROM part), pool AS (SELECT k, p_partkey AS e FROM p WHERE p_partkey % 3 <> 0), n AS (SELECT DISTINCT k FROM p)
 SELECT n.k, count(DISTINCT e) AS holders, CASE WHEN count(DISTINCT e) = 1 THEN min(e) END AS entity FROM n LEFT JOIN pool ON pool.k = n.k GROUP BY 1""")
def name_resolve_exact(spark, sf):
    """Unique, colliding and unknown names."""
    p = table(spark, sf, "part").select("p_partkey", F.upper(F.concat_ws(" ", "p_name", F.col("p_size").cast("string"), "p_brand")).alias("k"))
    pool = p.where("p_partkey % 3 != 0").withColumnRenamed("p_partkey", "e")
    out = I.unique_match(p.select("k").distinct(), pool, "k", "e", "entity")
    return out.join(pool.groupBy("k").agg(F.count_distinct("e").alias("n")), "k", "left").select("k", F.coalesce("n", F.lit(0)).alias("holders"), "entity")


@query("""WITH r AS (SELECT p_name AS norm, p_partkey AS number, ['APUB','FNOS','CCIV','APTY'][CAST(p_partkey % 4 + 1 AS INTEGER)] AS t, p_size > 44 AS cur, CASE WHEN p_partkey % 7 = 0 THEN NULL ELSE DATE '2000-01-01' END AS dereg FROM (SELECT p_partkey, p_name || ' ' || p_type AS p_name, p_size FROM part)),
 g AS (SELECT norm, bool_or(cur) AS held, CASE WHEN count(DISTINCT number) FILTER (WHERE cur) = 1 THEN min(number) FILTER (WHERE cur) END AS c, CASE WHEN count(DISTINCT number) FILTER (WHERE cur AND dereg IS NULL) = 1 THEN min(number) FILTER (WHERE cur AND dereg IS NULL) END AS l, CASE WHEN count(DISTINCT number) = 1 THEN min(number) END AS f FROM r WHERE t <> 'APTY' GROUP BY 1)
 SELECT n.norm, CASE WHEN c IS NOT NULL THEN c WHEN held AND l IS NOT NULL THEN l WHEN NOT held THEN f END AS number, CASE WHEN c IS NOT NULL THEN 'current_name' WHEN held AND l IS NOT NULL THEN 'current_name_live' WHEN NOT held AND f IS NOT NULL THEN 'former_name' ELSE 'none' END AS basis FROM (SELECT DISTINCT norm FROM r) n LEFT JOIN g USING (norm)""")
def registry_rank(spark, sf):
    """Which registration a name means: current, live, former, or none."""
    p = table(spark, sf, "part")
    r = p.select(F.concat_ws(" ", "p_name", "p_type").alias("norm"), F.col("p_partkey").alias("number"), F.element_at(F.array(*map(F.lit, ("APUB", "FNOS", "CCIV", "APTY"))), (F.col("p_partkey") % 4 + 1).cast("int")).alias("company_type"), (F.col("p_size") > 44).alias("is_current_name"), F.when(F.col("p_partkey") % 7 != 0, _day("2000-01-01")).alias("deregistration_date"))
    return I.rank_registrations(r, r, "norm").select("norm", "number", "basis")


@query(r"""SELECT doc_id, trim(regexp_replace(regexp_replace(upper(replace(strip_accents(text), 'ß', 'SS')), '[^\p{L}\p{N}_\s]', ' ', 'g'), '\s+', ' ', 'g')) AS folded FROM documents""")
def name_fold_unicode(spark, sf):
    """Accents folded off the whole text of each document."""
    return table(spark, sf, "documents").select("doc_id", T.fold(F.col("text")).alias("folded"))


@query()
def fuzzy_resolve(spark, sf):
    """Names with a changed letter or swapped words against the pool."""
    s = table(spark, sf, "supplier").select("s_suppkey", T.fold(F.concat(F.col("s_name"), F.lit(" OF NATION "), F.col("s_nationkey").cast("string")), unicode=False).alias("norm"))
    asked = s.select(F.when(F.col("s_suppkey") % 3 == 0, F.concat(F.lit("NATION "), F.col("norm"))).when(F.col("s_suppkey") % 3 == 1, F.regexp_replace("norm", "SUPPLIER", "SUPLIER")).otherwise(F.col("norm")).alias("norm"))
    aliases = s.limit(0).select("norm", "s_suppkey")
    return I.resolve(asked, s, aliases, "norm", "s_suppkey")


@query("""WITH e AS (SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN 'X' || CAST(c_custkey AS VARCHAR) END AS num FROM customer), x AS (SELECT c_custkey, 'X' || CAST(c_custkey - c_custkey % 2 AS VARCHAR) AS num FROM customer WHERE c_custkey % 5 <> 0)
 SELECT c_custkey, coalesce(e.num, x.num) AS num, CASE WHEN x.num IS NULL THEN 'absent' WHEN e.num IS NULL THEN 'updated' WHEN e.num = x.num THEN 'same' ELSE 'conflict' END AS outcome FROM e LEFT JOIN x USING (c_custkey)""")
def attach_numbers(spark, sf):
    """Numbers of an extract for known entities; none is overwritten."""
    c = table(spark, sf, "customer").select("c_custkey")
    num = lambda k: F.concat(F.lit("X"), k.cast("string"))
    e = c.withColumn("num", F.when(F.col("c_custkey") % 3 == 0, num(F.col("c_custkey"))))
    x = c.where("c_custkey % 5 != 0").withColumn("num", num(F.col("c_custkey") - F.col("c_custkey") % 2))
    return I.attach_numbers(e, x, "c_custkey", "num")


# ---------------------------------------------------------------- documents, raw zone, versions


@query("""SELECT sha256(text) AS sha256, min(doc_id) AS first_doc, count(*) AS copies, substr(sha256(text), 1, 2) || '/' || substr(sha256(text), 3, 2) || '/' || sha256(text) AS path FROM documents GROUP BY ALL""")
def dedupe_sha256(spark, sf):
    """Documents by the digest of their bytes."""
    d = table(spark, sf, "documents").withColumn("sha256", D.digest(F.col("text")))
    return d.groupBy("sha256").agg(F.min("doc_id").alias("first_doc"), F.count("*").alias("copies")).withColumn("path", D.raw_path(F.col("sha256")))


@query("""WITH s AS (SELECT DISTINCT sha256(text) AS h FROM documents WHERE doc_id % 2 = 0) SELECT min(doc_id) AS doc_id, sha256(text) AS sha256 FROM documents WHERE doc_id % 2 = 1 AND sha256(text) NOT IN (SELECT h FROM s) GROUP BY 2""")
def raw_ingest(spark, sf):
    """New bytes only, one row of each."""
    d = table(spark, sf, "documents").select("doc_id", "text")
    return D.ingest(d.where("doc_id % 2 = 0").withColumn("sha256", D.digest(F.col("text"))), d.where("doc_id % 2 = 1"), "text", "doc_id").select("doc_id", "sha256")


@query("""SELECT CASE WHEN doc_id % 5 = 0 THEN CASE WHEN doc_id % 2 = 0 THEN 'text' ELSE 'error' END ELSE 'bytes' END AS read_from, count(*) AS n FROM documents GROUP BY 1""")
def verified_read(spark, sf):
    """Bytes that hash right, else the text layer that does, else an error."""
    d = table(spark, sf, "documents")
    bad = F.col("doc_id") % 5 == 0
    r = d.select(F.when(bad, F.concat("text", F.lit("!"))).otherwise(F.col("text")).alias("content"), "text", D.digest(F.col("text")).alias("sha"), F.when(bad & (F.col("doc_id") % 2 == 1), F.lit("0")).otherwise(D.digest(F.col("text"))).alias("text_sha"))
    return D.verified(r, "content", "text", "sha", "text_sha").groupBy("read_from").agg(F.count("*").alias("n"))


@query("""SELECT conv_id, max(turn) AS turn, arg_max(role, turn) AS role, CAST(length(arg_max(text, turn)) AS BIGINT) AS n_chars FROM conversations GROUP BY 1""")
def latest_version(spark, sf):
    """The newest version of each record."""
    return R.latest_versions(table(spark, sf, "conversations"), ["conv_id"], "turn").select("conv_id", "turn", "role", F.char_length("text").cast("long").alias("n_chars"))


@query("""SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, json_extract_string(props, '$.none') AS missing FROM events""")
def json_unnest(spark, sf):
    """Fields out of a JSON payload; what isn't there is null."""
    p = F.from_json("props", "k bigint, none string")
    return table(spark, sf, "events").select("event_id", p["k"].alias("k"), p["none"].alias("missing"))


@query("""WITH a AS (SELECT p_partkey, upper(p_name) AS n, CAST(p_size AS VARCHAR) AS s FROM part), b AS (SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN p_name || 'x' ELSE lower(p_name) END AS n, CASE WHEN p_partkey % 4 = 0 THEN NULL ELSE '0' || CAST(p_size AS VARCHAR) END AS s FROM part)
 SELECT p_partkey, '$.name' AS path, a.n AS value_a, b.n AS value_b FROM a JOIN b USING (p_partkey) WHERE lower(a.n) <> lower(b.n) UNION ALL SELECT p_partkey, '$.size', a.s, b.s FROM a JOIN b USING (p_partkey) WHERE b.s IS NULL""")
def payload_diff(spark, sf):
    """Where two payloads differ, numbers as numbers and words without case."""
    p = table(spark, sf, "part")
    a = p.select("p_partkey", F.to_json(F.struct(F.upper("p_name").alias("name"), F.col("p_size").cast("string").alias("size"))).alias("payload"))
    other = F.when(F.col("p_partkey") % 3 == 0, F.concat("p_name", F.lit("x"))).otherwise(F.lower("p_name"))
    b = p.select("p_partkey", F.to_json(F.struct(other.alias("name"), F.when(F.col("p_partkey") % 4 != 0, F.concat(F.lit("0"), F.col("p_size").cast("string"))).alias("size"))).alias("payload"))
    return R.payload_diff(a, b, ["p_partkey"], "payload")


@query("""WITH s AS (SELECT d.doc_id, CASE WHEN quality = 0 THEN 1 ELSE 0 END AS e, CASE WHEN toxic = 1 THEN 1 ELSE 0 END AS g, CAST(d.doc_id % 4 AS INTEGER) AS w, quality IS NULL AS x FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id),
 c AS (SELECT *, CASE WHEN e > 0 THEN 0 ELSE greatest((CASE WHEN g > 0 THEN 5 ELSE 10 END) - w, 0) END AS tenths FROM s)
 SELECT doc_id, tenths / 10.0 AS confidence, CASE WHEN e = 0 AND g = 0 AND NOT x AND tenths >= 9 THEN 'validated' ELSE 'review' END AS status FROM c""")
def score_route(spark, sf):
    """Confidence and routing of readings."""
    d = table(spark, sf, "documents").select("doc_id").join(table(spark, sf, "labels"), "doc_id", "left")
    e, g, w = F.when(F.col("quality") == 0, 1).otherwise(0), F.when(F.col("toxic") == 1, 1).otherwise(0), (F.col("doc_id") % 4).cast("int")
    c = R.score(e, g, w)
    return d.select("doc_id", c.cast("double").alias("confidence"), R.route(e, g, c, F.col("quality").isNull(), F.lit(False)).alias("status"))


# ---------------------------------------------------------------- monitors and reports

_NOW = "2024-01-25 00:00:00"


@query(f"""WITH {EVENTS_SQL}, s AS (SELECT * FROM (VALUES ('purchase', 2, 5), ('click', 3, 100000), ('refund', 1, 1), ('nothing', 7, 1)) v(event_type, window_days, least)),
 j AS (SELECT s.event_type, window_days, least, count(ts) FILTER (WHERE ts >= TIMESTAMP '{_NOW}' - to_days(CAST(window_days AS INTEGER))) AS n FROM s LEFT JOIN (SELECT * FROM ev WHERE ts <= TIMESTAMP '{_NOW}') e ON e.event_type = s.event_type GROUP BY 1, 2, 3)
 SELECT event_type, n, CASE WHEN n = 0 THEN 'zero' WHEN n < least THEN 'below_baseline' END AS volume_alarm FROM j""")
def monitor_volume(spark, sf):
    """Volume of every expected feed; one without rows is there, with an alarm."""
    slos = spark.createDataFrame([("purchase", 2, 5, 48), ("click", 3, 100000, 48), ("refund", 1, 1, 48), ("nothing", 7, 1, 48)], "event_type string, window_days int, least int, stale_hours int")
    now = F.lit(_NOW).cast("timestamp_ntz")
    e = table(spark, sf, "events").where(F.col("ts") <= now)
    return Q.feed_volume(slos, e, "event_type", "ts", now).select("event_type", "n", "volume_alarm")


@query(f"""WITH {EVENTS_SQL}, p AS (SELECT entity % 10 AS grp, count(*) FILTER (WHERE event_day >= DATE '2024-01-20') AS rn, count(*) FILTER (WHERE event_day >= DATE '2024-01-20' AND event_type = 'purchase') AS rh, count(*) FILTER (WHERE event_day < DATE '2024-01-20' AND event_day >= DATE '2024-01-05') AS pn, count(*) FILTER (WHERE event_day < DATE '2024-01-20' AND event_day >= DATE '2024-01-05' AND event_type = 'purchase') AS ph FROM ev GROUP BY 1)
 SELECT grp, rn AS recent_n, rh AS recent_hit, pn AS prior_n, ph AS prior_hit, CASE WHEN rn < 30 OR pn < 100 THEN NULL WHEN rh / rn > greatest(ph / pn * 2, ph / pn + 0.1) THEN 'rose' WHEN ph / pn > 0.02 AND rh / rn < ph / pn / 2 THEN 'fell' END AS drift FROM p""")
def monitor_base_rate(spark, sf):
    """Share of a class now against before, on enough rows."""
    e = events(spark, sf).withColumn("grp", F.col("entity") % 10)
    p = Q.two_periods(e, "event_day", _day("2024-01-25"), 5, 15, F.col("event_type") == "purchase", ["grp"])
    return p.withColumn("drift", Q.base_rate_drift(F.col("recent_n"), F.col("recent_hit"), F.col("prior_n"), F.col("prior_hit")))


@query(f"""WITH p AS (SELECT count(*) FILTER (WHERE ts >= TIMESTAMP '{_NOW}' - INTERVAL 14 DAY) AS detected, count(*) FILTER (WHERE ts >= TIMESTAMP '{_NOW}' - INTERVAL 14 DAY AND event_type <> 'error') AS captured FROM events)
 SELECT detected, captured, round(captured / detected, 9) AS rate, detected >= 20 AND captured / detected < 0.9 AS alarm FROM p""")
def monitor_capture_rate(spark, sf):
    """Captured share of the trailing fortnight, with a floor."""
    now = F.lit(_NOW).cast("timestamp_ntz")
    return Q.capture_rate(table(spark, sf, "events"), F.col("event_type") != "error", "ts", now).withColumn("rate", F.round("rate", 9))


@query(f"""SELECT event_type, count(*) AS n_open, CAST(min(ts) AS DATE) AS oldest, CASE WHEN min(ts) < TIMESTAMP '{_NOW}' - INTERVAL 14 DAY THEN 'halted' WHEN min(ts) < TIMESTAMP '{_NOW}' - INTERVAL 7 DAY THEN 'late' END AS alarm FROM events GROUP BY 1""")
def review_sla(spark, sf):
    """Open items by age."""
    items = table(spark, sf, "events").withColumn("resolved_at", F.lit(None).cast("timestamp_ntz"))
    return Q.review_sla(items, "ts", F.lit(_NOW).cast("timestamp_ntz"), ["event_type"]).withColumn("oldest", F.to_date("oldest"))


@query("""SELECT CASE WHEN regexp_matches(p_name, '\\b(ring|widget)\\b') THEN 'shaped' WHEN regexp_matches(p_name, '\\b(red|blue)\\b') THEN 'coloured' ELSE 'other' END AS label, count(*) AS n, array_to_string(list_sort(list(p_partkey))[1:5], ',') AS examples FROM part GROUP BY 1""")
def coverage_triage(spark, sf):
    """Labels by hint words with counts and first examples."""
    label = F.when(F.col("p_name").rlike(r"\b(ring|widget)\b"), "shaped").when(F.col("p_name").rlike(r"\b(red|blue)\b"), "coloured").otherwise("other")
    out = Q.examples(table(spark, sf, "part"), label, "p_partkey")
    return out.withColumn("examples", F.array_join(F.transform("examples", lambda x: x.cast("string")), ","))


@query("""SELECT coalesce(CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE o_orderpriority END, '(unclassified)') AS class, o_orderstatus AS status, count(*) AS n FROM orders GROUP BY ALL""")
def ops_counts(spark, sf):
    """Counts by class and status; the unclassified are named."""
    c = F.coalesce(F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority")), F.lit("(unclassified)"))
    return table(spark, sf, "orders").groupBy(c.alias("class"), F.col("o_orderstatus").alias("status")).agg(F.count("*").alias("n"))


@query(f"""WITH {PURCHASES_SQL} SELECT entity, string_agg(DISTINCT CAST(user_id AS VARCHAR), '; ' ORDER BY CAST(user_id AS VARCHAR)) AS people, count(DISTINCT user_id) AS n FROM pu GROUP BY 1""")
def listagg_people(spark, sf):
    """Ordered distinct lists."""
    return purchases(spark, sf).groupBy("entity").agg(F.array_join(F.array_sort(F.collect_set(F.col("user_id").cast("string"))), "; ").alias("people"), F.count_distinct("user_id").alias("n"))


@query(f"""WITH {ORDERS_SQL} SELECT o_orderkey, order_day AS day, CAST(CASE WHEN o_orderkey % 2 = 0 THEN price END AS DECIMAL(18,2)) AS total, o_orderkey + 1000 AS qty FROM od""")
def dates_and_money_in_text(spark, sf):
    """Dates, totals and quantities out of sentences; a price for one isn't a total."""
    o = orders(spark, sf)
    grouped = F.format_number(F.col("price"), 2)
    said = F.concat(F.lit("Sold "), F.format_number(F.col("o_orderkey") + 1000, 0), F.lit(" units on "), F.date_format("order_day", "d/M/yyyy"), F.lit(" for $"), F.when(F.col("o_orderkey") % 2 == 0, grouped).otherwise(F.concat(grouped, F.lit(" per share"))))
    o = o.withColumn("said", said)
    return o.select("o_orderkey", F.element_at(T.dates_stated(F.col("said")), 1).alias("day"), T.money(F.col("said")).alias("total"), T.quantity(F.col("said")).alias("qty"))


@query(f"""WITH {_CUSTOMER_CAP} SELECT c_custkey, cap FROM cap ORDER BY cap DESC NULLS LAST, c_custkey LIMIT 25""")
def worklist_topk(spark, sf):
    """The top of a list, unknown values last."""
    return _caps(spark, sf).select("c_custkey", "cap").orderBy(F.col("cap").desc_nulls_last(), "c_custkey").limit(25)


@query("""WITH v AS (SELECT o_orderkey, 'total not positive' AS rule FROM orders WHERE NOT (o_totalprice > 50000) UNION ALL SELECT o_orderkey, 'status unknown' FROM orders WHERE o_orderstatus NOT IN ('O', 'F')) SELECT * FROM v""")
def constraint_violations(spark, sf):
    """A table's constraints as a query."""
    rules = {"total not positive": F.col("o_totalprice") > 50000, "status unknown": F.col("o_orderstatus").isin("O", "F")}
    return Q.violations(table(spark, sf, "orders"), rules, "o_orderkey")


@query("""SELECT s_nationkey, count(*) AS n FROM supplier WHERE s_acctbal > 0 GROUP BY 1 HAVING count(*) > 1""")
def duplicate_keys(spark, sf):
    """A partial unique index as a query."""
    return Q.duplicates(table(spark, sf, "supplier"), ["s_nationkey"], F.col("s_acctbal") > 0)


_KEY = "sha256('e|' || CAST(user_id AS VARCHAR) || '|' || event_type)"


@query(f"""SELECT {_KEY} AS key, min(event_id) AS first_event, count(*) AS seen FROM events GROUP BY 1""")
def detection_keys(spark, sf):
    """Idempotent detections by their key."""
    e = table(spark, sf, "events").withColumn("key", D.detection_key(F.lit(None).cast("string"), F.lit("e"), F.concat_ws("|", F.col("user_id").cast("string"), "event_type")))
    return e.groupBy("key").agg(F.min("event_id").alias("first_event"), F.count("*").alias("seen"))


@query("""SELECT c_custkey AS doc_id, 0 AS form_nr, 'app_3y' AS form, c_name AS entity_name, 'Jo ' || c_mktsegment AS director_name, CAST(DATE '2024-06-01' + CAST(c_custkey % 28 AS INTEGER) AS DATE) AS date_of_change, 'stated' AS date_basis, 'direct' AS interest_nature, NULL::VARCHAR AS indirect_detail,
 'Ordinary shares' AS security_class, 5000::BIGINT AS qty_acquired, NULL::BIGINT AS qty_disposed, 'On market trade' AS consideration_text, abs(c_acctbal) AS consideration_aud, c_custkey + 100000 AS held_before, c_custkey + 105000 AS held_after, false AS scrambled FROM customer""")
def form_extract(spark, sf):
    """Notices read from forms composed out of customers and their balances."""
    c = table(spark, sf, "customer")
    held = F.format_number(F.col("c_custkey") + 100000, 0)
    after = F.format_number(F.col("c_custkey") + 105000, 0)
    text = F.concat(
        F.lit("Appendix 3Y Change of Director's Interest Notice Name of entity "), F.col("c_name"), F.lit(" ABN 12 345 678 901 Name of Director Jo "), F.col("c_mktsegment"),
        F.lit(" Date of last notice 1 May 2024 Part 1 - Change of director's relevant interests in securities Direct or indirect interest Direct Date of change "), F.date_format(F.date_add(_day("2024-06-01"), (F.col("c_custkey") % 28).cast("int")), "d MMMM yyyy"),
        F.lit(" No. of securities held prior to change "), held, F.lit(" ordinary shares Class Ordinary shares Number acquired 5,000 Number disposed Nil Value/Consideration Note: If consideration is non-cash, provide details and estimated valuation $"), F.format_number(F.abs("c_acctbal"), 2),
        F.lit(" No. of securities held after change "), after, F.lit(" ordinary shares Nature of change On market trade Part 2 - Change of director's interests in contracts"),
    )
    return extract_notices(c.select(F.col("c_custkey").alias("doc_id"), text.alias("text"))).drop("dates_stated")


# ---------------------------------------------------------------- more lookups, loads and reviews


@query(f"""WITH {ORDERS_SQL}, a AS (SELECT o_custkey, order_day, price, row_number() OVER (PARTITION BY o_custkey ORDER BY order_day, o_orderkey) AS nr FROM od),
 s AS (SELECT o_custkey, price FROM a WHERE nr = 1), i AS (SELECT o_custkey, CASE WHEN o_custkey % 4 = 0 THEN CAST(price + 1 AS DECIMAL(18,2)) ELSE price END AS price FROM a WHERE nr = 1 AND o_custkey % 2 = 0 UNION ALL SELECT o_custkey + 1000000, price FROM a WHERE nr = 2)
 SELECT i.o_custkey, CASE WHEN s.o_custkey IS NULL THEN 'insert' WHEN s.price = i.price THEN 'same' ELSE 'conflict' END AS outcome FROM i LEFT JOIN s USING (o_custkey)""")
def record_anchor(spark, sf):
    """New anchors: insert, same again, or in conflict with a stored figure."""
    nr = F.row_number().over(Window.partitionBy("o_custkey").orderBy("order_day", "o_orderkey"))
    a = orders(spark, sf).withColumn("nr", nr)
    stored = a.where("nr = 1").select("o_custkey", "price")
    first = a.where("nr = 1 and o_custkey % 2 = 0").select("o_custkey", F.when(F.col("o_custkey") % 4 == 0, F.col("price") + 1).otherwise(F.col("price")).cast("decimal(18,2)").alias("price"))
    new = first.unionByName(a.where("nr = 2").select((F.col("o_custkey") + 1000000).alias("o_custkey"), "price"))
    return E.record_anchor(stored, new, ["o_custkey"], "price").select("o_custkey", "outcome")


@query(f"""WITH {ORDERS_SQL}, d AS (SELECT DISTINCT date_trunc('month', order_day) AS m, o_custkey FROM od), p AS (SELECT c_custkey, CAST(DATE '1998-01-15' + CAST(c_custkey % 300 AS INTEGER) AS DATE) AS day FROM customer)
 SELECT p.c_custkey, p.day, CAST((SELECT max(m) FROM d WHERE d.o_custkey = p.c_custkey AND m <= p.day) AS DATE) AS newest FROM p""")
def asof_membership(spark, sf):
    """The newest month of each customer that began at or before its day."""
    m = orders(spark, sf).select(F.col("o_custkey").alias("c_custkey"), F.to_date(F.date_trunc("month", "order_day")).alias("newest")).distinct().withColumn("begun", F.col("newest"))
    p = table(spark, sf, "customer").select("c_custkey", F.date_add(_day("1998-01-15"), (F.col("c_custkey") % 300).cast("int")).alias("day"))
    return P.as_of_join(p, m.withColumn("tie", F.col("newest")), ["c_custkey"], "day", "begun", ["newest"], "tie")


@query(f"""WITH {ORDERS_SQL}, t AS (SELECT CASE WHEN c_custkey % 3 = 0 THEN c_custkey - 1 ELSE c_custkey END AS ticker, c_custkey AS entity FROM customer), h AS (SELECT DISTINCT s_suppkey % 120 AS ticker FROM supplier UNION SELECT n_nationkey * 3 FROM nation),
 u AS (SELECT ticker, CASE WHEN count(DISTINCT entity) = 1 THEN min(entity) END AS entity FROM t GROUP BY 1) SELECT h.ticker, u.entity, u.entity IS NULL AS unresolved FROM h LEFT JOIN u ON u.ticker = h.ticker""")
def index_load(spark, sf):
    """Tickers of an index with their entity; unresolved ones are kept and reported."""
    t = table(spark, sf, "customer").select(F.when(F.col("c_custkey") % 3 == 0, F.col("c_custkey") - 1).otherwise(F.col("c_custkey")).alias("ticker"), F.col("c_custkey").alias("entity"))
    h = table(spark, sf, "supplier").select((F.col("s_suppkey") % 120).alias("ticker")).union(table(spark, sf, "nation").select((F.col("n_nationkey") * 3).cast("long"))).distinct()
    return I.unique_match(h, t, "ticker", "entity", "found").select("ticker", F.col("found").alias("entity"), F.col("found").isNull().alias("unresolved"))


@query(f"""WITH {ORDERS_SQL}, {_CUSTOMER_CAP}, l AS (SELECT o_custkey AS entity, 'C' || CAST(o_custkey AS VARCHAR) AS code FROM od GROUP BY 1 HAVING min(order_day) <= DATE '1998-06-30' AND max(order_day) >= DATE '1998-06-30'),
 n AS (SELECT o_custkey AS entity, CASE WHEN count(*) FILTER (WHERE o_orderpriority = '1-URGENT') = 1 THEN max(o_orderpriority) FILTER (WHERE o_orderpriority = '1-URGENT') || CAST(max(o_orderkey) FILTER (WHERE o_orderpriority = '1-URGENT') AS VARCHAR) WHEN count(*) = 1 THEN max(o_orderpriority || CAST(o_orderkey AS VARCHAR)) END AS name FROM od WHERE order_day <= DATE '1998-06-30' AND order_day + 300 >= DATE '1998-06-30' GROUP BY 1),
 j AS (SELECT l.entity, l.code, n.name, cap.cap AS market_cap, CASE WHEN l.entity % 3 = 0 AND l.entity % 2 = 0 THEN 'in_review' ELSE 'resolved' END AS identity FROM l LEFT JOIN n USING (entity) LEFT JOIN cap ON c_custkey = l.entity)
 SELECT entity, code, name, market_cap, identity, CASE WHEN market_cap IS NOT NULL THEN rank() OVER (ORDER BY market_cap DESC NULLS LAST) END AS cap_rank FROM j""")
def universe_export(spark, sf):
    """The universe on a day: code, name (single or blank), capitalisation and its rank, identity."""
    o = orders(spark, sf)
    listings = o.groupBy(F.col("o_custkey").alias("entity")).agg(F.min("order_day").alias("valid_from"), F.max("order_day").alias("valid_to")).withColumn("code", F.concat(F.lit("C"), F.col("entity").cast("string")))
    names = o.select(F.col("o_custkey").alias("entity"), F.concat("o_orderpriority", F.col("o_orderkey").cast("string")).alias("name"), F.when(F.col("o_orderpriority") == "1-URGENT", "legal").otherwise("other").alias("name_kind"), F.col("order_day").alias("valid_from"), F.date_add("order_day", 300).alias("valid_to"))
    figures = _caps(spark, sf).select(F.col("c_custkey").alias("entity"), F.concat(F.lit("C"), F.col("c_custkey").cast("string")).alias("code"), F.col("cap").alias("market_cap"), F.lit("s").alias("sector"), _day("1998-01-01").alias("as_at"))
    entities = table(spark, sf, "customer").select(F.col("c_custkey").alias("entity"), F.when(F.col("c_custkey") % 3 != 0, "a").alias("acn"), F.when(F.col("c_custkey") % 2 != 0, "b").alias("arbn"))
    return S.universe(listings, names, figures, entities, "entity", "code", _day("1998-06-30")).select("entity", "code", "name", "market_cap", "identity", "cap_rank")


@query(f"""WITH {EVENTS_SQL}, d AS (SELECT event_id, CASE WHEN event_id % 10 = 0 THEN 'N' || CAST(event_id AS VARCHAR) END AS ann, 'k' || CAST(event_id AS VARCHAR) AS key, user_id AS ticker, ts, entity * 1000 + event_id % 3 AS ent FROM ev WHERE event_type = 'signup'),
 c AS (SELECT event_id, CASE WHEN event_id % 4 = 0 THEN 'N' || CAST(event_id - 1 AS VARCHAR) END AS ann, CASE WHEN event_id % 5 = 0 THEN 'k' || CAST(event_id - 2 AS VARCHAR) END AS key, user_id AS ticker, CASE WHEN event_id % 2 = 0 THEN ts END AS ts, entity * 1000 + event_id % 3 AS ent FROM ev WHERE event_type = 'purchase'),
 ua AS (SELECT ann, min(event_id) AS i FROM d WHERE ann IS NOT NULL GROUP BY 1 HAVING count(*) = 1), uk AS (SELECT key, min(event_id) AS i FROM d GROUP BY 1 HAVING count(*) = 1), ut AS (SELECT ticker, min(event_id) AS i FROM d GROUP BY 1 HAVING count(*) = 1), ue AS (SELECT ent, min(event_id) AS i FROM d WHERE ent IS NOT NULL GROUP BY 1 HAVING count(*) = 1),
 nd AS (SELECT c.event_id, d.event_id AS i, row_number() OVER (PARTITION BY c.event_id ORDER BY abs(epoch_us(c.ts) - epoch_us(d.ts)), d.event_id) AS nr FROM c JOIN d ON d.ticker = c.ticker AND CAST(c.ts AS DATE) = CAST(d.ts AS DATE)),
 x AS (SELECT c.event_id AS capture_id, ua.i AS a, uk.i AS k, CASE WHEN c.ts IS NULL THEN ut.i END AS t, nd.i AS n, ue.i AS e FROM c LEFT JOIN ua ON ua.ann = c.ann LEFT JOIN uk ON uk.key = c.key LEFT JOIN ut ON ut.ticker = c.ticker LEFT JOIN ue ON ue.ent = c.ent LEFT JOIN nd ON nd.event_id = c.event_id AND nd.nr = 1)
 SELECT capture_id, coalesce(a, k, t, n, e) AS detection_id, CASE WHEN a IS NOT NULL THEN 'announcement' WHEN k IS NOT NULL THEN 'key' WHEN t IS NOT NULL THEN 'ticker' WHEN n IS NOT NULL THEN 'ticker_day' WHEN e IS NOT NULL THEN 'content' ELSE 'standalone' END AS how FROM x""")
def capture_matching(spark, sf):
    """Files and their detections: number, key, only ticker, nearest of the day, content, or none."""
    e = events(spark, sf).withColumn("ticker", F.col("user_id")).withColumn("entity_id", F.col("entity") * 1000 + F.col("event_id") % 3)
    named = lambda p, k: F.concat(F.lit(p), (F.col("event_id") - k).cast("string"))
    d = e.where("event_type = 'signup'").select(F.col("event_id").alias("detection_id"), F.when(F.col("event_id") % 10 == 0, named("N", 0)).alias("announcement"), named("k", 0).alias("key"), "ticker", F.col("ts").alias("lodged_at"), "entity_id")
    c = e.where("event_type = 'purchase'").select(F.col("event_id").alias("capture_id"), F.when(F.col("event_id") % 4 == 0, named("N", 1)).alias("announcement"), F.when(F.col("event_id") % 5 == 0, named("k", 2)).alias("key"), "ticker", F.when(F.col("event_id") % 2 == 0, F.col("ts")).alias("lodged_at"), "entity_id")
    return D.match_captures(c, d)


@query("""SELECT event_id, CASE WHEN event_id % 3 = 0 THEN 'alert' WHEN event_id % 5 <> 0 THEN 'file' END AS source, CASE WHEN event_id % 3 = 0 AND event_id % 5 <> 0 AND event_id % 26 - 1 BETWEEN 0 AND 17 THEN 'file' END AS corroborated_by FROM events""")
def lodgement_dating(spark, sf):
    """When a document became public, and which source says so."""
    e = table(spark, sf, "events")
    at = F.col("ts").cast("timestamp")
    alert = F.when(F.col("event_id") % 3 == 0, at)
    made = F.when(F.col("event_id") % 5 != 0, F.timestamp_seconds(F.unix_timestamp(at) - (F.col("event_id") % 26 - 1) * 3600))
    return e.select("event_id", D.lodgement(alert, made).alias("l")).select("event_id", "l.source", "l.corroborated_by")


_NOTICE = "array<struct<qty_acquired:int,qty_disposed:int,held_before:int,held_after:int>>"


@query("""WITH n AS (SELECT event_id, event_id % 7 AS a, event_id % 4 AS m FROM events)
 SELECT event_id, CASE WHEN m = 1 THEN 1 ELSE 0 END + CASE WHEN event_id % 11 = 0 THEN 1 ELSE 0 END + CASE WHEN event_id % 13 = 0 THEN 1 ELSE 0 END AS n_errors, CASE WHEN m = 2 THEN 1 ELSE 0 END + CASE WHEN event_id % 13 <> 0 AND event_id % 3 = 0 THEN 1 ELSE 0 END AS n_warnings,
 CASE WHEN m = 1 OR event_id % 11 = 0 OR event_id % 13 = 0 THEN 'review' WHEN m = 2 THEN 'review' ELSE 'validated' END AS status FROM n""")
def notice_validation(spark, sf):
    """Notices whose sums, names and dates are checked, scored and routed."""
    k = F.col("event_id")
    got, before = (k % 7).cast("int"), F.lit(100)
    after = F.when(k % 4 == 1, before + got + 1).when(k % 4 == 2, None).otherwise(before + got).cast("int")
    sec = F.array(F.struct(got.alias("qty_acquired"), F.lit(None).cast("int").alias("qty_disposed"), before.alias("held_before"), after.alias("held_after")))
    day = F.when(k % 13 == 0, None).when(k % 3 == 0, "2024-01-01").otherwise("2024-01-18")
    e = table(spark, sf, "events").select("event_id", F.when(k % 11 != 0, "Jo").alias("director_name"), day.alias("date_of_change"), F.lit(False).alias("is_final"), sec.alias("securities"), _day("2024-01-20").alias("lodged"))
    out = R.evaluate(R.validate_notices(e, "lodged"))
    return out.select("event_id", F.size("errors").cast("int").alias("n_errors"), F.size("warnings").cast("int").alias("n_warnings"), "status")


@query("""WITH r AS (SELECT event_id AS doc_id, event_id % 3 + 1 AS v FROM events)
 SELECT doc_id, v AS version, 'P' || CAST(k AS VARCHAR) AS person, CAST(doc_id + k AS BIGINT) AS qty_acquired, CASE WHEN v = 1 THEN 'contradicted' ELSE 'unverified' END AS corroboration, CASE WHEN v = 1 THEN 'arithmetic: x' WHEN v = 2 THEN 'late' ELSE 'routed to review with no validator finding recorded' END AS because
 FROM r, (SELECT unnest([0, 1]) AS k) WHERE doc_id % 5 <> 0 AND NOT (k = 1 AND doc_id % 2 = 0)""")
def uncorroborated(spark, sf):
    """Readings under review: the newest version, through notices and securities, with the reasons."""
    e = table(spark, sf, "events").withColumn("v", F.col("event_id") % 3 + 1)
    sec = lambda k: F.struct(F.when((F.lit(k) == 1) & (F.col("event_id") % 2 == 0), "n/a").otherwise((F.col("event_id") + k).cast("string")).alias("qty_acquired"))
    notice = lambda k: F.struct(F.lit(f"P{k}").alias("director_name"), F.lit("2024-01-05").alias("date_of_change"), F.array(sec(k)).alias("securities"))
    full = F.to_json(F.struct(F.array(notice(0), notice(1)).alias("notices")))
    empty = F.array().cast("array<string>")
    said = F.when(F.col("v") == 1, F.array(F.lit("arithmetic: x"))).otherwise(empty)
    warned = F.when(F.col("v") == 2, F.array(F.lit("late"))).otherwise(empty)
    newest = e.select(F.col("event_id").alias("doc_id"), F.lit("p").alias("parser"), F.col("v").alias("version"), full.alias("payload"), said.alias("errors"), warned.alias("warnings"), empty.alias("disagreements"), F.lit(0.5).alias("confidence"))
    older = newest.where("version > 1").withColumn("version", F.col("version") - 1).withColumn("payload", F.lit("{}"))
    docs = e.select(F.col("event_id").alias("doc_id"), F.when(F.col("event_id") % 5 == 0, "validated").otherwise("review").alias("parse_status"), F.lit(1).alias("entity_id"), F.col("ts").alias("lodged_at"))
    out = R.uncorroborated(newest.unionByName(older), docs)
    return out.select("doc_id", "version", "person", F.col("qty_acquired").cast("long").alias("qty_acquired"), "corroboration", F.array_join("because", "; ").alias("because"))


@query(f"""WITH i AS (SELECT event_id, CASE WHEN event_id % 4 <> 0 THEN 'p' || CAST(user_id % 5 AS VARCHAR) END AS parser, ts FROM events), p AS (SELECT DISTINCT 'p' || CAST(user_id % 7 AS VARCHAR) AS parser FROM events)
 SELECT p.parser, coalesce(bool_or(i.ts < TIMESTAMP '{_NOW}' - INTERVAL 14 DAY AND i.event_id % 3 <> 0), false) AS halted FROM p LEFT JOIN i USING (parser) GROUP BY 1""")
def halted_parsers(spark, sf):
    """Parsers that an old open item stops."""
    e = table(spark, sf, "events")
    items = e.select(F.when(F.col("event_id") % 4 != 0, F.concat(F.lit("p"), (F.col("user_id") % 5).cast("string"))).alias("parser"), F.col("ts").alias("created_at"), F.when((F.col("event_id") % 3 == 0) | (F.col("event_id") % 4 == 0), F.col("ts")).alias("resolved_at"), F.lit("extraction").alias("kind"), F.col("event_id").alias("doc_id"))
    parsers = e.select(F.concat(F.lit("p"), (F.col("user_id") % 7).cast("string")).alias("parser")).distinct()
    return R.halted(items, parsers, F.lit(_NOW).cast("timestamp_ntz"))


@query("""WITH r AS (SELECT conv_id, turn, role FROM conversations), n AS (SELECT conv_id, max(turn) AS v FROM r GROUP BY 1), h AS (SELECT DISTINCT conv_id FROM r WHERE role = 'system')
 SELECT conv_id, v FROM n WHERE v < 5 AND conv_id NOT IN (SELECT conv_id FROM h)""")
def reprocess_plan(spark, sf):
    """What a new parser version would read again; what a human settled stays."""
    c = table(spark, sf, "conversations")
    r = c.select("conv_id", F.lit("p").alias("parser"), F.col("turn").alias("version"))
    return R.reprocess_plan(r, 5, c.where("role = 'system'"), "conv_id").select("conv_id", F.col("version").alias("v"))


@query(f"""WITH s AS (SELECT user_id, event_id, event_type, ts FROM events), f AS (SELECT user_id, event_type = 'error' AS terminal, row_number() OVER (PARTITION BY user_id ORDER BY event_type = 'error' DESC, ts DESC, event_id DESC) AS nr, event_type FROM s)
 SELECT user_id, CASE WHEN event_type = 'error' THEN 'rejected' ELSE event_type END AS status FROM f WHERE nr = 1""")
def lifecycle_status(spark, sf):
    """The present status out of a log; a terminal one stays."""
    e = table(spark, sf, "events").withColumn("status", F.when(F.col("event_type") == "error", "rejected").otherwise(F.col("event_type"))).withColumn("at", F.struct("ts", "event_id"))
    return R.lifecycle(e, "user_id", "at", "status")


@query(f"""WITH p AS (SELECT event_type, count(*) FILTER (WHERE ts >= TIMESTAMP '{_NOW}' - INTERVAL 8 DAY) AS rn, count(*) FILTER (WHERE ts >= TIMESTAMP '{_NOW}' - INTERVAL 8 DAY AND value < 30) AS rh, count(*) FILTER (WHERE ts < TIMESTAMP '{_NOW}' - INTERVAL 8 DAY AND ts >= TIMESTAMP '{_NOW}' - INTERVAL 16 DAY) AS pn, count(*) FILTER (WHERE ts < TIMESTAMP '{_NOW}' - INTERVAL 8 DAY AND ts >= TIMESTAMP '{_NOW}' - INTERVAL 16 DAY AND value < 30 AND event_id % 3 = 0) AS ph_, 0 AS z FROM events GROUP BY 1),
 q AS (SELECT event_type, rn, rh, pn, (SELECT count(*) FROM events e WHERE e.event_type = p.event_type AND ts < TIMESTAMP '{_NOW}' - INTERVAL 8 DAY AND ts >= TIMESTAMP '{_NOW}' - INTERVAL 16 DAY AND value < 30) AS ph FROM p)
 SELECT event_type, rn AS recent_n, rh AS recent_hit, pn AS prior_n, ph AS prior_hit, CASE WHEN rn < 10 OR pn < 10 THEN NULL WHEN rh / rn > 2 * (ph / pn) AND rh / rn > 0.1 THEN 'rose' WHEN ph / pn > 0.05 AND rh / rn < ph / pn / 3 THEN 'fell' END AS drift FROM q""")
def monitor_routing_drift(spark, sf):
    """Share of routed records of each parser now against the period before."""
    p = Q.two_periods(table(spark, sf, "events"), "ts", F.lit(_NOW).cast("timestamp_ntz"), 8, 8, F.col("value") < 30, ["event_type"])
    return p.withColumn("drift", Q.routing_drift(F.col("recent_n"), F.col("recent_hit"), F.col("prior_n"), F.col("prior_hit")))


@query(f"""SELECT count(*) FILTER (WHERE event_type = 'signup' AND ts < TIMESTAMP '{_NOW}' - INTERVAL 24 HOUR) AS n, CAST(min(ts) FILTER (WHERE event_type = 'signup' AND ts < TIMESTAMP '{_NOW}' - INTERVAL 24 HOUR) AS DATE) AS oldest, count(*) FILTER (WHERE event_type = 'signup' AND ts < TIMESTAMP '{_NOW}' - INTERVAL 24 HOUR) > 0 AS alarm FROM events""")
def monitor_stuck(spark, sf):
    """How many wait longer than a day."""
    return Q.stuck(table(spark, sf, "events"), "event_type", "ts", F.lit(_NOW).cast("timestamp_ntz"), "signup").withColumn("oldest", F.to_date("oldest"))


@query(f"""WITH {ORDERS_SQL}, l AS (SELECT DISTINCT o_custkey FROM od WHERE order_day >= DATE '1998-06-01'), e AS (SELECT c_custkey, c_custkey % 20 = 0 AS missing, c_custkey % 100 = 0 AS fgn FROM customer WHERE c_custkey IN (SELECT o_custkey FROM l))
 SELECT count(*) AS total, count(*) FILTER (WHERE missing AND NOT fgn) AS unidentified, round(count(*) FILTER (WHERE missing AND NOT fgn) / count(*), 9) AS rate, coalesce(count(*) FILTER (WHERE missing AND NOT fgn) / count(*) > 0.06, false) AS alarm FROM e""")
def monitor_identity(spark, sf):
    """Share of listed entities without a number."""
    e = table(spark, sf, "customer").select(F.col("c_custkey").alias("entity"), F.when(F.col("c_custkey") % 20 != 0, "a").alias("acn"), F.lit(None).cast("string").alias("arbn"), F.when(F.col("c_custkey") % 100 == 0, "foreign").otherwise("company").alias("entity_kind"))
    l = orders(spark, sf).where(F.col("order_day") >= _day("1998-06-01")).select(F.col("o_custkey").alias("entity"), F.lit(None).cast("date").alias("valid_to"))
    return Q.identity_rate(e, l, "entity").withColumn("rate", F.round("rate", 9))


@query("""WITH p AS (SELECT event_id // 2 AS load_id, event_id AS part_no, sha256(event_type || CAST(user_id % 3 AS VARCHAR)) AS h FROM events), l AS (SELECT load_id, list(h ORDER BY part_no) AS d, load_id % 2 AS source FROM p GROUP BY load_id)
 SELECT load_id, source, first_value(load_id) OVER (PARTITION BY source, d ORDER BY load_id) <> load_id AS is_repeat FROM l""")
def load_repeats(spark, sf):
    """Loads of content that was loaded before."""
    from ..sources.state import load_state

    parts = table(spark, sf, "events").select(F.expr("event_id div 2").alias("load_id"), F.col("event_id").alias("part_no"), F.sha2(F.concat("event_type", (F.col("user_id") % 3).cast("string")).cast("binary"), 256).alias("sha256"))
    loads = parts.select("load_id").distinct().withColumn("source", F.col("load_id") % 2)
    return load_state(loads, parts).select("load_id", "source", "is_repeat")


# ---------------------------------------------------------------- registers, escrow, chains


@query("""WITH h AS (SELECT l_partkey, l_suppkey, CAST(sum(l_quantity) AS BIGINT) AS q FROM lineitem GROUP BY 1, 2), r AS (SELECT *, row_number() OVER (PARTITION BY l_partkey ORDER BY q DESC, l_suppkey) AS nr, sum(q) OVER (PARTITION BY l_partkey) AS t FROM h)
 SELECT l_partkey, count(*) AS n_holders, round(sum(q) FILTER (WHERE nr <= 5) / max(t), 9) AS top_5_share, round(sum(q) FILTER (WHERE nr <= 20) / max(t), 9) AS top_20_share FROM r GROUP BY 1""")
def register_concentration(spark, sf):
    """What the five and the twenty largest holders have."""
    h = table(spark, sf, "lineitem").groupBy("l_partkey", "l_suppkey").agg(F.sum("l_quantity").cast("long").alias("q"))
    h = h.withColumn("t", F.sum("q").over(Window.partitionBy("l_partkey")))
    return G.concentration(h, ["l_partkey"], "l_suppkey", "q", "t").withColumn("top_5_share", F.round("top_5_share", 9)).withColumn("top_20_share", F.round("top_20_share", 9))


@query("""WITH a AS (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem WHERE l_shipdate < DATE '1998-01-01'), b AS (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem WHERE l_shipdate >= DATE '1998-01-01')
 SELECT coalesce(a.l_partkey, b.l_partkey) AS l_partkey, count(*) FILTER (WHERE a.l_partkey IS NULL) AS entered, count(*) FILTER (WHERE b.l_partkey IS NULL) AS left, count(*) FILTER (WHERE a.l_partkey IS NOT NULL AND b.l_partkey IS NOT NULL) AS stayed FROM a FULL JOIN b ON a.l_partkey = b.l_partkey AND a.l_suppkey = b.l_suppkey GROUP BY 1""")
def register_churn(spark, sf):
    """Holders that came, went and stayed."""
    l = table(spark, sf, "lineitem")
    cut = F.lit("1998-01-01").cast("timestamp_ntz")
    return G.churn(l.where(F.col("l_shipdate") < cut), l.where(F.col("l_shipdate") >= cut), ["l_partkey"], "l_suppkey")


@query("""WITH s AS (SELECT l_partkey, DATE '1998-06-30' AS as_of, CAST(sum(l_quantity) AS BIGINT) AS outstanding FROM lineitem GROUP BY 1), k AS (SELECT l_partkey, CAST(l_quantity AS BIGINT) AS q, CAST(l_shipdate AS DATE) AS f, CASE WHEN l_linenumber = 7 THEN NULL ELSE CAST(l_shipdate AS DATE) + 180 END AS r FROM lineitem WHERE l_returnflag = 'A'),
 h AS (SELECT s.l_partkey, sum(q) AS locked FROM s JOIN k USING (l_partkey) WHERE f <= as_of AND (r IS NULL OR r > as_of) GROUP BY 1)
 SELECT s.l_partkey, s.as_of, outstanding, CAST(coalesce(locked, 0) AS BIGINT) AS locked, CAST(outstanding - coalesce(locked, 0) AS BIGINT) AS float_shares, CASE WHEN s.l_partkey IN (SELECT l_partkey FROM k) THEN '' ELSE 'no_escrow_data' END AS flags FROM s LEFT JOIN h USING (l_partkey)""")
def escrow_float(spark, sf):
    """Free float: shares less what is locked on the day."""
    l = table(spark, sf, "lineitem").withColumn("f", F.to_date("l_shipdate"))
    shares = l.groupBy("l_partkey").agg(F.sum("l_quantity").cast("long").alias("outstanding")).withColumn("as_of", _day("1998-06-30"))
    locked = l.where("l_returnflag = 'A'").select("l_partkey", F.col("l_quantity").cast("long").alias("quantity"), F.col("f").alias("locked_from"), F.when(F.col("l_linenumber") != 7, F.date_add("f", 180)).alias("release_date"))
    return G.float_series(shares, locked, ["l_partkey"]).select("l_partkey", "as_of", "outstanding", "locked", "float_shares", F.array_join("coverage_flags", "|").alias("flags"))


@query("""WITH RECURSIVE e AS (SELECT p_partkey AS c, p_partkey // 3 AS p FROM part WHERE p_partkey > 0), t AS (SELECT c AS child, p AS ancestor, 1 AS depth FROM e UNION ALL SELECT t.child, e.p, depth + 1 FROM t JOIN e ON e.c = t.ancestor) SELECT child, ancestor, depth FROM t""")
def owner_chains(spark, sf):
    """All owners above each entity, with how far above."""
    e = table(spark, sf, "part").where("p_partkey > 0").select(F.col("p_partkey").alias("c"), F.floor(F.col("p_partkey") / 3).alias("p"))
    return G.owners(e, "c", "p")


@query("""SELECT s_nationkey, s_suppkey % 4 AS kind, round(sum(s_acctbal * CASE s_suppkey % 3 WHEN 0 THEN 1 WHEN 1 THEN 1000 END) FILTER (WHERE s_suppkey % 4 IN (0, 1) AND s_suppkey % 3 <> 2), 4) AS total, count(*) FILTER (WHERE s_suppkey % 4 IN (0, 1) AND s_suppkey % 3 <> 2) AS n_used, count(*) FILTER (WHERE NOT (s_suppkey % 4 IN (0, 1) AND s_suppkey % 3 <> 2)) AS n_left_out FROM supplier GROUP BY 1, 2""")
def category_sums(spark, sf):
    """Sums of allowed categories and known units; the rest is counted."""
    s = table(spark, sf, "supplier").withColumn("kind", F.col("s_suppkey") % 4).withColumn("unit", F.element_at(F.array(F.lit("kg"), F.lit("t"), F.lit("oz?")), (F.col("s_suppkey") % 3 + 1).cast("int")))
    return G.category_sums(s, ["s_nationkey"], "kind", "s_acctbal", "unit", {"kg": 1.0, "t": 1000.0}, [0, 1]).withColumn("total", F.round("total", 4))


@query("""SELECT o_orderkey FROM orders WHERE o_orderpriority <> '5-LOW' AND o_orderkey % 7 <> 0 AND o_orderstatus IN ('O', 'F')""")
def accepted_trades(spark, sf):
    """Cash buys that are neither superseded nor waiting for review."""
    o = table(spark, sf, "orders").withColumn("classification", F.when(F.col("o_orderpriority") == "5-LOW", "unknown").otherwise(C.CASH_BUY))
    status = F.when(F.col("o_orderstatus") == "O", "auto").when(F.col("o_orderstatus") == "F", "human_corrected").otherwise("review")
    o = o.withColumn("superseded", F.col("o_orderkey") % 7 == 0).withColumn("review_status", status)
    return o.where(C.accepted()).select("o_orderkey")


@query("""WITH d AS (SELECT doc_id, CASE WHEN doc_id % 3 <> 0 THEN text END AS text, CASE WHEN doc_id % 4 <> 0 THEN TIMESTAMP '2024-01-01' END AS lodged,
  doc_id % 5 <> 0 AS found, CASE WHEN doc_id % 2 = 0 THEN text END AS new_text, CASE WHEN doc_id % 8 <> 0 THEN TIMESTAMP '2024-02-02' END AS new_at FROM documents)
 SELECT doc_id, CASE WHEN text IS NOT NULL AND lodged IS NOT NULL THEN 'complete' WHEN NOT found THEN 'missing'
  WHEN text IS NULL AND new_text IS NOT NULL AND lodged IS NULL AND new_at IS NOT NULL THEN 'both' WHEN text IS NULL AND new_text IS NOT NULL THEN 'text' WHEN lodged IS NULL AND new_at IS NOT NULL THEN 'date' ELSE 'unreadable' END AS outcome,
  length(coalesce(text, CASE WHEN found THEN new_text END)) AS chars, CAST(coalesce(lodged, CASE WHEN found THEN new_at END) AS DATE) AS day FROM d""")
def backfill_documents(spark, sf):
    """Documents that lack a text or a date take them from what was found."""
    at = lambda when, day: F.when(when, F.lit(day).cast("timestamp_ntz"))
    i = F.col("doc_id")
    docs = table(spark, sf, "documents").select("doc_id", "text")
    lacking = docs.select("doc_id", F.when(i % 3 != 0, F.col("text")).alias("text"), at(i % 4 != 0, "2024-01-01").alias("lodged_at"))
    found = docs.where(i % 5 != 0).select("doc_id", F.when(i % 2 == 0, F.col("text")).alias("text"), at(i % 8 != 0, "2024-02-02").alias("made_at"))
    return D.backfill(lacking, found, "doc_id").select("doc_id", "outcome", F.char_length("text").alias("chars"), F.to_date("lodged_at").alias("day"))


@query("""SELECT o_custkey, o_orderkey, lag(o_orderstatus) OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS prior_payload FROM orders""")
def prior_version(spark, sf):
    """Each version with what the version before it said."""
    return R.prior_version(table(spark, sf, "orders"), ["o_custkey"], "o_orderkey", "o_orderstatus").select("o_custkey", "o_orderkey", "prior_payload")


@query("""WITH n AS (SELECT c_custkey, CASE c_custkey % 3 WHEN 0 THEN c_name || ' (The)' WHEN 1 THEN ' ' || c_name || ' (THE) ' ELSE c_name END AS name FROM customer)
 SELECT c_custkey, name AS variant FROM n UNION ALL SELECT c_custkey, 'THE ' || trim(left(trim(name), length(trim(name)) - 5)) FROM n WHERE upper(trim(name)) LIKE '%(THE)'""")
def name_variants(spark, sf):
    """A listed name, and the one with its article in front."""
    name = F.when(F.col("c_custkey") % 3 == 0, F.concat("c_name", F.lit(" (The)"))).when(F.col("c_custkey") % 3 == 1, F.concat(F.lit(" "), "c_name", F.lit(" (THE) "))).otherwise(F.col("c_name"))
    return table(spark, sf, "customer").select("c_custkey", F.explode(T.listed_variants(name)).alias("variant"))


@query("""WITH d AS (SELECT s_suppkey AS id, CASE WHEN s_suppkey % 4 = 0 THEN 'h' || s_suppkey END AS sha, CASE WHEN s_suppkey % 3 = 0 THEN 'other' ELSE 'app_3y' END AS kind FROM supplier),
 c AS (SELECT id, 'h' || (id - id % 5) AS got FROM d WHERE id % 2 = 1), t AS (SELECT sha AS got FROM d WHERE sha IS NOT NULL)
 SELECT id AS detection_id, CASE WHEN c.got IS NULL THEN 'detected' WHEN t.got IS NOT NULL THEN 'not_applicable' WHEN kind = 'app_3y' THEN 'unparsed' ELSE 'not_applicable' END AS parse_status,
  coalesce(sha, CASE WHEN t.got IS NULL THEN c.got END) AS sha256 FROM d LEFT JOIN c USING (id) LEFT JOIN t ON t.got = c.got""")
def attach_files(spark, sf):
    """Detections take the digest of their file; a file that is another's already closes them."""
    i = F.col("s_suppkey")
    d = table(spark, sf, "supplier").select(i.alias("detection_id"), F.when(i % 4 == 0, F.concat(F.lit("h"), i)).alias("sha256"), F.when(i % 3 == 0, "other").otherwise("app_3y").alias("doc_class"), F.lit("detected").alias("parse_status"))
    files = d.where("detection_id % 2 = 1").select("detection_id", F.concat(F.lit("h"), F.expr("detection_id - detection_id % 5")).alias("sha256"))
    return D.attach(d, files).select("detection_id", "parse_status", "sha256")


@query("""SELECT o_orderkey AS item_id, CASE WHEN o_orderkey % 3 = 0 THEN NULL WHEN o_orderstatus = 'O' THEN 'apply' WHEN o_orderstatus = 'F' THEN CASE WHEN o_orderkey % 2 = 0 THEN 'retract' END ELSE 'apply' END AS follow_up FROM orders""")
def resolve_reviews(spark, sf):
    """What follows from a human's decisions."""
    o = table(spark, sf, "orders").withColumnRenamed("o_orderkey", "item_id")
    items = o.select("item_id", F.when(F.col("item_id") % 2 == 0, "extraction").otherwise("resolution").alias("kind"))
    said = F.when(F.col("o_orderstatus") == "O", "accepted").when(F.col("o_orderstatus") == "F", "rejected").otherwise("corrected")
    return R.resolve_items(items, o.where("item_id % 3 != 0").select("item_id", said.alias("decision"))).select("item_id", "follow_up")


@query("""WITH n AS (SELECT 'CLERK ' || (c_custkey % 500) AS norm, ' clerk ' || (c_custkey % 500) || ' ' || c_mktsegment AS raw FROM customer),
 s AS (SELECT DISTINCT 'CLERK ' || (c_custkey % 500) AS norm, 'stored ' || (c_custkey % 500) AS raw FROM customer WHERE (c_custkey % 500) % 2 = 0)
 SELECT norm AS name_norm, raw AS display_name FROM s UNION ALL SELECT norm, min(trim(raw)) FROM n WHERE norm NOT IN (SELECT norm FROM s) GROUP BY 1""")
def persons_register(spark, sf):
    """One person for each normalised name; those on record keep their row."""
    k = F.col("c_custkey") % 500
    named = table(spark, sf, "customer").select(k.alias("k"), F.concat(F.lit("CLERK "), k).alias("norm"), F.concat(F.lit(" clerk "), k, F.lit(" "), "c_mktsegment").alias("raw"))
    stored = named.where("k % 2 = 0").select("k", "norm").distinct().select(F.col("k").alias("person_id"), F.col("norm").alias("name_norm"), F.concat(F.lit("stored "), "k").alias("display_name"), F.lit(None).cast("long").alias("merged_into"))
    return C.persons(named, F.col("norm"), "raw", stored).select("name_norm", "display_name")


@query("""SELECT count(*) AS total, count(*) FILTER (WHERE s_suppkey % 5 <> 0) AS with_number, count(*) FILTER (WHERE s_suppkey % 5 = 0 AND s_nationkey < 10) AS flagged_foreign, count(*) FILTER (WHERE s_suppkey % 5 = 0 AND s_nationkey >= 10) AS unresolved,
  round(count(*) FILTER (WHERE s_suppkey % 5 <> 0 OR s_nationkey < 10) / count(*), 9) AS rate, count(*) FILTER (WHERE s_suppkey % 5 <> 0 OR s_nationkey < 10) >= 0.99 * count(*) AS meets FROM supplier WHERE s_acctbal > 0""")
def number_coverage(spark, sf):
    """The share of listed entities with a number or known to be foreign, against its bar."""
    s = table(spark, sf, "supplier")
    entities = s.select(F.col("s_suppkey").alias("e"), F.when(F.col("s_suppkey") % 5 != 0, "1").alias("acn"), F.when(F.col("s_nationkey") < 10, "foreign").otherwise("company").alias("entity_kind"))
    return Q.number_coverage(entities, s.where("s_acctbal > 0").select(F.col("s_suppkey").alias("e")), "e").withColumn("rate", F.round("rate", 9))
