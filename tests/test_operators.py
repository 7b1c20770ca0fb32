import datetime as dt

import pytest
from pyspark.sql import functions as F

from pitlake.functions import text as T
from pitlake.functions.scoring import lcs_length, token_set_ratio
from pitlake.operators import documents as D
from pitlake.operators import events as E
from pitlake.operators import identity as I
from pitlake.operators import quality as Q
from pitlake.operators import review as R
from pitlake.operators import snapshots as S
from pitlake.operators import temporal as P
from pitlake.operators import trades as C

day = dt.date


def one(spark, column, **values):
    return spark.range(1).select(*(F.lit(v).alias(k) for k, v in values.items())).select(column).first()[0]


def test_valid_on_is_inclusive_and_open(spark):
    df = spark.createDataFrame([(day(2024, 1, 1), day(2024, 1, 31)), (day(2024, 1, 31), None), (day(2024, 2, 1), None)], "a date, b date")
    assert [r[0] for r in df.select(P.valid_on(F.to_date(F.lit("2024-01-31")), F.col("a"), F.col("b"))).collect()] == [True, True, False]


def test_as_of_join_without_a_match_is_null(spark):
    left = spark.createDataFrame([(1, 5), (1, 9), (2, 5), (None, 5)], "k int, t int")
    right = spark.createDataFrame([(1, 6, "a", 1), (1, 6, "b", 2), (1, 9, "c", 3)], "k int, t int, v string, id int")
    out = {tuple(r) for r in P.as_of_join(left, right, ["k"], "t", "t", ["v"], "id").collect()}
    assert out == {(1, 5, None), (1, 9, "c"), (2, 5, None), (None, 5, None)}
    strict = {tuple(r) for r in P.as_of_join(left, right, ["k"], "t", "t", ["v"], "id", strict=True).collect()}
    assert (1, 9, "b") in strict


def test_membership_is_three_valued(spark):
    snaps = spark.createDataFrame([(day(2024, 1, 1), day(2024, 1, 3)), (day(2024, 1, 8), day(2024, 1, 20))], "as_of date, knowable_at date")
    members = spark.createDataFrame([(day(2024, 1, 1), 1)], "as_of date, e int")
    probes = spark.createDataFrame([(1, day(2024, 1, 2)), (1, day(2024, 1, 4)), (2, day(2024, 1, 4)), (1, day(2024, 1, 18)), (1, day(2024, 1, 21))], "e int, d date")
    out = {(r["e"], r["d"].day): r["is_member"] for r in P.membership(probes, snaps, members, "e", "d", 14).collect()}
    assert out == {(1, 2): None, (1, 4): True, (2, 4): False, (1, 18): None, (1, 21): False}


def test_replay_ratio_and_delta_are_not_exchangeable(spark):
    anchors = spark.createDataFrame([("a", day(2024, 1, 1), 100, day(2024, 1, 1)), ("b", day(2024, 1, 1), 100, day(2024, 1, 1))], "k string, anchor_date date, anchor_qty int, knowable_at date")
    log = [("a", day(2024, 1, 2), 1, "split", 2, 1, None), ("a", day(2024, 1, 3), 2, "issue", None, None, 10), ("b", day(2024, 1, 2), 3, "issue", None, None, 10), ("b", day(2024, 1, 3), 4, "split", 2, 1, None), ("a", day(2024, 1, 1), 5, "issue", None, None, 999), ("a", day(2024, 1, 4), 6, "issue_proposed", None, None, 999), ("c", day(2024, 1, 4), 7, "issue", None, None, 1)]
    events = spark.createDataFrame([(*r, r[1]) for r in log], "k string, event_date date, event_id int, kind string, ratio_num int, ratio_den int, qty_delta int, knowable_at date")
    out = {r["k"]: r["quantity"] for r in E.replay(anchors, events, ["k"]).collect()}
    assert out == {"a": 210, "b": 220, "c": None}


def test_greedy_windows_skip_what_they_took(spark):
    rows = [(1, day(2024, 1, d), p) for d, p in ((1, 1), (2, 1), (3, 2), (5, 3), (6, 4), (20, 5))] + [(2, day(2024, 1, 1), None), (2, day(2024, 1, 2), 9)]
    df = spark.createDataFrame(rows, "e int, d date, p int")
    out = [tuple(r) for r in E.greedy_windows(df, "e", "d", "p", 3, 2).orderBy("window_start").collect()]
    assert out == [(1, day(2024, 1, 1), day(2024, 1, 3)), (1, day(2024, 1, 5), day(2024, 1, 6))]


def test_supersede_keeps_null_groups_and_all_rows_of_the_winner(spark):
    df = spark.createDataFrame([(1, None, 10, 1), (1, None, 10, 1), (1, None, 11, 2), (2, 5, 12, 1)], "e int, p int, doc int, k int")
    out = sorted((r["doc"], r["superseded"], r["supersedes_doc"]) for r in E.supersede(df, ["e", "p"], "doc", "k").collect())
    assert out == [(10, True, None), (10, True, None), (11, False, 10), (12, False, None)]


@pytest.mark.parametrize(
    ("said", "got", "lost", "paid", "label"),
    [
        ("On market purchase", 5, None, 10.0, "onmkt_buy_cash"), ("On market purchase", 5, None, None, "unknown"), ("on-market sale", None, 5, None, "onmkt_sell"), ("On market trade", 5, 5, 10.0, "unknown"),
        ("Off-market transfer", 5, None, 10.0, "offmkt_transfer"), ("investment", 5, None, 10.0, "unknown"), ("1. Vesting\n2. On market trades", 5, 5, None, "unknown"), (None, 5, None, 10.0, "unknown"), ("On market, nil consideration", 5, None, 1.0, "unknown"),
    ],
)
def test_classify(spark, said, got, lost, paid, label):
    df = spark.createDataFrame([(said, got, lost, paid)], "s string, g int, l int, p double")
    assert df.select(C.classify(F.col("s"), F.col("g"), F.col("l"), F.col("p"))).first()[0] == label


def test_screen_counts_only_priced_trades(spark):
    clusters = spark.createDataFrame([(1, [1, 2])], "c int, ids array<int>")
    trades = spark.createDataFrame([(1, 10, 20.0, "b"), (2, None, 5.0, "a")], "id int, shares int, amount double, who string")
    row = C.screen(clusters, trades, "c", "ids", "id", "shares", "amount", "who").first()
    assert (row["n_trades"], row["n_priced"], row["avg_price"], row["people"], row["partial_price_coverage"]) == (2, 1, 2.0, "a; b", True)


def test_names(spark):
    df = spark.createDataFrame([("Café Holdings Pty. Ltd",), ("LIMITED",), ("A.B.C. Ltd",), ("",), (None,)], "n string")
    assert [r[0] for r in df.select(T.company_norm(F.col("n"))).collect()] == ["CAFE", "LIMITED", "A B C", "", None]
    assert df.select(T.listed_variants(F.lit("Ring (The)"))).first()[0] == ["Ring (The)", "THE Ring"]


def test_times_and_dates(spark):
    at = lambda s: str(one(spark, T.written_at(F.col("x")), x=s))
    assert at("D:20260819171523+10'00'") == "2026-08-19 07:15:23" and at("D:20260819171523Z") == "2026-08-19 17:15:23" and at("D:20260819171523") == "None"
    assert str(one(spark, P.market_date(F.col("x").cast("timestamp")), x="2026-08-18 23:30:00")) == "2026-08-19"
    assert [str(one(spark, T.any_date(F.col("x")), x=s)) for s in ("1/2/2020", "2020-02-01", "01022020", "31/31/2020", "")] == ["2020-02-01", "2020-02-01", "2020-02-01", "None", "None"]


def test_similarity():
    assert token_set_ratio("A B C", "C B A") == 100 and token_set_ratio("A B", "A B C") == 100 and token_set_ratio("", "A") == 0
    assert lcs_length("abcde", "ace") == 3 and token_set_ratio("ACME MINING", "ACME MINNING") > 90


def test_resolver_tiers(spark):
    pool = spark.createDataFrame([("ACME MINING", 1), ("BETA GOLD", 2), ("BETA GOLD", 3), ("GAMMA ENERGY GROUP", 4)], "n string, e int")
    aliases = spark.createDataFrame([("ACM", 1), ("BG", 2), ("BG", 3)], "n string, e int")
    asked = spark.createDataFrame([("ACME MINING",), ("BETA GOLD",), ("ACM",), ("BG",), ("GAMMA ENERGY GROUPS",), ("NOBODY",), ("",)], "n string")
    out = {r["n"]: (r["e"], r["method"]) for r in I.resolve(asked, pool, aliases, "n", "e").collect()}
    assert out == {"ACME MINING": (1, "exact"), "BETA GOLD": (None, "review"), "ACM": (1, "alias"), "BG": (None, "review"), "GAMMA ENERGY GROUPS": (4, "fuzzy"), "NOBODY": (None, "review"), "": (None, "review")}


def test_snapshot_gate_and_apply(spark):
    history = spark.createDataFrame([(1, "A", day(2020, 1, 1), None), (2, "B", day(2020, 1, 1), None), (3, "C", day(2020, 1, 1), None)], "e int, c string, valid_from date, valid_to date")
    snap = spark.createDataFrame([(1, "A", None), (4, "B", day(2019, 1, 1)), (5, "D", day(2021, 6, 1))], "e int, c string, listed date")
    out = {(r["e"], r["c"]): (r["valid_from"], r["valid_to"]) for r in S.apply_snapshot(history, snap, "e", "c", F.to_date(F.lit("2022-01-01"))).collect()}
    closed = day(2021, 12, 31)
    assert out == {(1, "A"): (day(2020, 1, 1), None), (2, "B"): (day(2020, 1, 1), closed), (3, "C"): (day(2020, 1, 1), closed), (4, "B"): (day(2022, 1, 1), None), (5, "D"): (day(2021, 6, 1), None)}
    with pytest.raises(S.ImplausibleSnapshot):
        S.check_gate(history, snap)
    S.check_gate(history, snap, allow_shrink=True)


def test_score_at_the_bar(spark):
    df = spark.createDataFrame([(0, 0, 1), (0, 0, 2), (0, 1, 0), (1, 0, 0), (0, 0, 30)], "e int, g int, w int")
    c = R.score(F.col("e"), F.col("g"), F.col("w"))
    out = [(float(r[0]), r[1]) for r in df.select(c, R.route(F.col("e"), F.col("g"), c, F.lit(False), F.lit(False))).collect()]
    assert out == [(0.9, "validated"), (0.8, "review"), (0.5, "review"), (0.0, "review"), (0.0, "review")]


def test_notice_validation(spark):
    sec = "array<struct<qty_acquired:int,qty_disposed:int,held_before:int,held_after:int>>"
    df = spark.createDataFrame(
        [(1, "Jo", "2024-01-05", False, [(5, None, 10, 15)], day(2024, 1, 8)), (2, "", "2024-02-05", False, [(5, None, 10, 16)], day(2024, 1, 8)), (3, "Jo", None, True, [(None, None, None, 7)], day(2024, 1, 8)), (4, "Jo", "2024-01-05", False, [(5, None, None, 15)], None), (5, "Jo", "x", False, None, day(2024, 1, 8))],
        f"id int, director_name string, date_of_change string, is_final boolean, securities {sec}, lodged date",
    )
    out = {r["id"]: (len(r["errors"]), len(r["warnings"]), r["status"]) for r in R.evaluate(R.validate_notices(df, "lodged")).collect()}
    assert out == {1: (0, 0, "validated"), 2: (3, 0, "review"), 3: (0, 0, "validated"), 4: (1, 1, "review"), 5: (2, 0, "review")}


def test_payload_diff_stops_at_unequal_arrays(spark):
    a = spark.createDataFrame([(1, '{"a": [1, 2], "b": "1,000", "c": {"d": "X"}}')], "k int, p string")
    b = spark.createDataFrame([(1, '{"a": [1], "b": "1000", "c": {"d": "y"}}')], "k int, p string")
    assert sorted((r["path"], r["value_a"], r["value_b"]) for r in R.payload_diff(a, b, ["k"], "p").collect()) == [("$.a[]", "2", "1"), ("$.c.d", "X", "y")]


def test_uncorroborated(spark):
    payload = '{"notices": [{"director_name": "Jo", "date_of_change": "2024-01-05", "securities": [{"qty_acquired": "5", "qty_disposed": "x"}, {"qty_acquired": "n/a"}]}]}'
    records = spark.createDataFrame([(1, "p", 1, "{}", [], [], [], 0.5), (1, "p", 2, payload, ["arithmetic: 1 != 2"], [], [], 0.0)], "doc_id int, parser string, version int, payload string, errors array<string>, warnings array<string>, disagreements array<string>, confidence double")
    docs = spark.createDataFrame([(1, "review", 7, dt.datetime(2024, 1, 6))], "doc_id int, parse_status string, entity_id int, lodged_at timestamp")
    found = R.uncorroborated(records, docs).collect()
    assert [(r["corroboration"], int(r["qty_acquired"]), r["qty_disposed"]) for r in found] == [("contradicted", 5, None)]


def test_silence_is_an_alarm_and_every_run_leaves_a_row(spark):
    slos = spark.createDataFrame([("a", 2, 1, 24), ("b", 2, 1, 24)], "feed string, window_days int, least int, stale_hours int")
    rows = spark.createDataFrame([("a", dt.datetime(2024, 1, 9))], "feed string, at timestamp")
    now = F.lit("2024-01-10").cast("timestamp")
    volume = Q.feed_volume(slos, rows, "feed", "at", now)
    found = Q.alarms(("volume", volume, F.col("volume_alarm").isNotNull()))
    beat = Q.heartbeat(found, now).first()
    assert not beat["ok"] and len(beat["alarms"]) == 1 and '"feed":"b"' in beat["alarms"][0]["detail"]
    assert Q.heartbeat(found.limit(0), now).first()["ok"]


def test_captures_cascade(spark):
    at = dt.datetime(2024, 1, 5, 10)
    detections = spark.createDataFrame([(1, "N1", "k1", "AAA", at, 7), (2, None, "k2", "BBB", at, 8), (3, None, "k3", "BBB", at.replace(hour=15), 8), (4, None, "k4", "CCC", None, 9)], "detection_id int, announcement string, key string, ticker string, lodged_at timestamp, entity_id int")
    captures = spark.createDataFrame([(1, "N1", None, None, None, None), (2, None, "k2", "CCC", None, None), (3, None, None, "BBB", at.replace(hour=14), None), (4, None, None, "BBB", None, None), (5, None, None, "CCC", None, None), (6, None, None, None, None, 9)], "capture_id int, announcement string, key string, ticker string, lodged_at timestamp, entity_id int")
    out = {r["capture_id"]: (r["detection_id"], r["how"]) for r in D.match_captures(captures, detections).collect()}
    assert out == {1: (1, "announcement"), 2: (2, "key"), 3: (3, "ticker_day"), 4: (None, "standalone"), 5: (4, "ticker"), 6: (4, "content")}


def test_lodgement_prefers_the_alert(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 10), dt.datetime(2024, 1, 1, 9, 54)), (None, dt.datetime(2024, 1, 1)), (None, None), (dt.datetime(2024, 1, 9), dt.datetime(2024, 1, 1))], "a timestamp, m timestamp")
    out = [(x["source"], x["corroborated_by"]) if x else None for (x,) in df.select(D.lodgement(F.col("a"), F.col("m"))).collect()]
    assert out == [("alert", "file"), ("file", None), None, ("alert", None)]


def test_document_facts(spark):
    df = spark.createDataFrame([("Appendix 3Y\nName of entity\tRing Ltd  ABN 12 345 678 901 and ABN 651 349 638",)], "t string")
    f = df.select(D.facts(F.col("t")).alias("f")).first()["f"]
    assert (f["abns"], f["acns"], f["doc_class"], f["entity_name"]) == (["12345678901"], ["651349638"], "app_3y", "Ring Ltd")


def test_name_fold_covers_the_whole_text(spark, tmp_path):
    import re
    import unicodedata

    from pitlake.plans.catalog import QUERIES

    texts = ["one two three four Zoë Ångström", "a  b\u00a0c\td e\nfünf, ﬁve (É)!", "e\u0301 " * 300 + "end naïve", "plain", "", None, " x-y_z "]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")

    def brute(text):
        plain = "".join(c for c in unicodedata.normalize("NFKD", text) if not unicodedata.category(c).startswith("M")).upper()
        return " ".join(re.sub(r"[^\w\s]", " ", plain).split())

    out = {r["doc_id"]: r["folded"] for r in QUERIES["name_fold_unicode"](spark, str(tmp_path)).collect()}
    assert out == {i: None if t is None else brute(t) for i, t in enumerate(texts)}


def test_fuzzy_scores_of_hot_tokens(spark):
    names = [f"GLOBAL RESOURCES AUSTRALIA {w}" for w in ("MINING", "ENERGY", "COPPER", "COAL", "TIN", "GAS", "OIL")] + ["MINNING WORKS"]
    pool = spark.createDataFrame(list(enumerate(names)), "entity long, norm string")
    asked = spark.createDataFrame([("GLOBAL RESOURCES AUSTRALIA MINNING",)], "norm string")
    out = {r["entity"]: r["score"] for r in I.fuzzy_scores(asked, pool, "norm", "entity", hot=2).collect()}
    assert out == {i: token_set_ratio("GLOBAL RESOURCES AUSTRALIA MINNING", n) for i, n in enumerate(names)}
    assert max(out, key=out.get) == 0 and out[0] > 93


def test_fuzzy_scores_lose_no_pair(spark):
    """Against all pairs by brute force, at the bar of the runner-up and at that of a model's candidates."""
    import random

    from pitlake.functions.scoring import token_set_ratio

    r = random.Random(5)
    words = ["BANK", "GROUP", "WOODSIDE", "RESOURCES", "AUSTRALIA", "MINING", "OF", "A", "NORTH", "STAR", "GOLD", "HOLDING"] + ["".join(r.choice("ABCDE") for _ in range(r.randint(2, 7))) for _ in range(20)]

    def changed(name):
        name = list(name)
        for _ in range(r.randint(1, 3)):
            at = r.randrange(len(name))
            name[at : at + 1] = r.choice([[], [name[at], r.choice("ABXS ")], [r.choice("AEZ")]])
        return " ".join("".join(name).split()) or "X"

    pool = sorted({" ".join(r.choice(words) for _ in range(r.randint(1, 4))) for _ in range(150)} | {"WOODSIDE", "BANK"})
    names = sorted({changed(r.choice(pool)) for _ in range(120)} | {"WOODSIDES", "BANK FOO", "WOOD SIDE", "A"})
    asked = spark.createDataFrame([(n,) for n in names], "norm string")
    known = spark.createDataFrame([(n, i) for i, n in enumerate(pool)], "norm string, entity long")
    for least in (90.0, 60.0):
        out = {(x["norm"], x["entity"]): x["score"] for x in I.fuzzy_scores(asked, known, "norm", "entity", hot=7, least=least).collect()}
        assert out == {(n, i): x for n in names for i, p in enumerate(pool) if (x := token_set_ratio(n, p)) >= least}
    said = {x["norm"]: (x["entity"], x["method"]) for x in I.resolve(asked, known, known.limit(0), "norm", "entity").collect()}
    for n in names:
        best = sorted(((token_set_ratio(n, p), -i) for i, p in enumerate(pool)), reverse=True)
        if n not in pool:
            sure = best[0][0] >= 93 and best[0][0] - best[1][0] >= 3
            assert said[n] == ((-best[0][1], "fuzzy") if sure else (None, "review")), n


def test_best_match_leaves_pairs_out_that_do_not_matter(spark):
    import random

    r = random.Random(8)
    pool = [(f"SUPPLIER {i:09d} OF NATION {i % 25}", i) for i in range(300)] + [(f"{'ABCDEFGH'[i % 8] * 3} {i} MINING AND RESOURCES OF THE NORTH", 1000 + i) for i in range(60)]
    pool += [(n, i + 5000) for n, i in pool[:20]] + [("A", 9000), ("B C", 9001), ("AB CD", 9002)]

    def changed(name):
        for _ in range(r.randint(0, 3)):
            at = r.randrange(len(name))
            name = name[:at] + r.choice(["", name[at] * 2, "7", "X", " "]) + name[at + 1 :]
        return " ".join(name.split()) or "A"

    names = sorted({changed(r.choice(pool)[0]) for _ in range(150)} | {f"NATION {pool[k][0]}" for k in (3, 5, 200)} | {f"SUPLIER {k:09d} OF NATION {k % 25}" for k in range(0, 300, 9)})
    asked = spark.createDataFrame([(n,) for n in names], "norm string")
    known = spark.createDataFrame(pool, "norm string, entity long")
    for hot in (5, 10_000):
        out = {x["norm"]: x for x in I.fuzzy_best(asked, known, "norm", "entity", hot=hot).collect()}
        assert sorted(out) == names
        for n in names:
            best = sorted(((token_set_ratio(n, p), -i) for p, i in pool), reverse=True)
            sure = best[0][0] >= 93 and best[0][0] - best[1][0] >= 3
            x = out[n]
            assert ((x["__score"] or 0) >= 93 and x["__score"] - x["__second"] >= 3) == sure, (n, x, best[:2])
            assert not sure or (x["__best"], x["__score"]) == (-best[0][1], best[0][0])


def test_chains_and_payloads_of_any_depth(spark):
    from pitlake.operators import registers as G

    edges = spark.createDataFrame([(k, k + 1) for k in range(100)] + [(200, 201), (201, 200), (None, 3), (3, None)], "c long, p long")
    out = [(r["child"], r["ancestor"], r["depth"]) for r in G.owners(edges, "c", "p").collect()]
    assert sorted(out) == sorted([(a, b, b - a) for a in range(100) for b in range(a + 1, 101)] + [(200, 201, 1), (201, 200, 1)])

    def deep(k, value):
        return ('{"a":[' * k) + f'"{value}"' + ("]}" * k)

    rows = lambda v: spark.createDataFrame([(1, deep(6, v)), (2, None), (3, "{}"), (4, "5")], "k long, p string")
    diff = R.payload_diff(rows("x"), rows("y"), ["k"], "p").collect()
    assert [(r["k"], r["path"], r["value_a"], r["value_b"]) for r in diff] == [(1, "$" + ".a[0]" * 6, "x", "y")]


def test_ranks_of_ties_nulls_and_values_that_are_not_positive(spark):
    from pitlake.operators.snapshots import rank_down

    values = [5.0, 5.0, 4.99, 1e9, None, 0.0, -3.0, -3.0, -7.0, 1e-9, None, 5.01]
    out = rank_down(spark.createDataFrame([(v,) for v in values], "v double"), "v", "r").collect()
    known = [v for v in values if v is not None]
    assert len(out) == len(values) and all(r["r"] == (None if r["v"] is None else 1 + sum(k > r["v"] for k in known)) for r in out)
