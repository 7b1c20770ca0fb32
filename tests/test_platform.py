import datetime as dt

import pytest
from pyspark.sql import functions as F

from pitlake.__main__ import arguments
from pitlake.plans.platform import BacktestUnavailable, Platform
from pitlake.plans.schema import COLUMNS, KEYS, schema

REGISTRY = """Company Name|ACN|Type|Current Name Indicator|Date of Registration|Current Name Start Date
RING WIDGETS LIMITED|1|APUB|Y|01/02/1999|
OLD RING NL|1|APUB||01/02/1999|01/01/2005
BETA GOLD LIMITED|2|APUB|Y|01/02/2001|
"""
LISTINGS = "Listed companies\n\nCode,Company name,GICS industry group,Listing date,Market Cap\nRNG,RING WIDGETS LIMITED,Toys,1/3/2000,1000\nBTG,BETA GOLD LIMITED,Gold,1/3/2002,--\nTRU,SOME TRUST,Funds,,500\n"


def form(director, before, bought, paid, day, company="Ring Widgets Limited"):
    return (
        f"Appendix 3Y Change of Director's Interest Notice Name of entity {company} ABN 12 345 678 901 Name of Director {director} Date of last notice 1 May 2024 "
        f"Direct or indirect interest Direct Date of change {day} No. of securities held prior to change {before:,} ordinary shares Class Ordinary shares Number acquired {bought:,} Number disposed Nil "
        f"Value/Consideration ${paid:,.2f} No. of securities held after change {before + bought:,} ordinary shares Nature of change On market trade for cash Part 2"
    )


@pytest.fixture(scope="module")
def platform(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("platform")
    (root / "registry.csv").write_text(REGISTRY)
    (root / "listings.csv").write_text(LISTINGS)
    drop = root / "drop"
    drop.mkdir()
    for name, text, ticker, at in (
        ("a", form("Jo Smith", 100_000, 50_000, 60_000, "3 June 2024"), "RNG", "2024-06-05T09:30:00"),
        ("b", form("Al Green", 200_000, 20_000, 24_000, "10 June 2024"), "RNG", "2024-06-12T09:30:00"),
        ("c", form("Al Green", 200_000, 20_000, 24_000, "11 June 2024").replace("220,000", "221,000"), "RNG", "2024-06-13T09:30:00"),
        ("d", "Trading update", "BTG", "2024-06-13T09:30:00"),
    ):
        (drop / f"{name}.txt").write_text(text)
        (drop / f"{name}.txt.meta.json").write_text(f'{{"ticker": "{ticker}", "title": "Notice", "lodged_at": "{at}"}}')
    p = Platform(spark, str(root / "tables"))
    assert set(p.migrate()) == set(COLUMNS) and p.migrate() == []
    assert p.load_registry(str(root / "registry.csv")) == 3
    p.load_listings(str(root / "listings.csv"), dt.date(2024, 1, 1), least_rows=1)
    return p, root


def test_schema(spark):
    assert set(KEYS) == set(COLUMNS) and all(set(KEYS[t]) <= set(schema(t).names) for t in COLUMNS)


def test_reference(platform):
    p, root = platform
    names = {(r["name_norm"], r["name_kind"], str(r["valid_to"])) for r in p.table("entity_names").collect()}
    assert ("RING WIDGETS", "legal", "None") in names and ("OLD RING", "former", "2004-12-31") in names
    u = {r["code"]: (r["cap_rank"], r["identity"], r["label"]) for r in p.universe(dt.date(2024, 6, 1), top=1).collect()}
    assert u == {"RNG": (1, "resolved", "too_large"), "BTG": (None, "resolved", "unknown"), "TRU": (2, "in_review", "kept")}
    assert p.collisions().count() == 0 and [r["label"] for r in p.coverage().collect()] == ["scheme or trust"]
    before = sorted(map(tuple, p.table("listings").collect()), key=str)
    p.load_listings(str(root / "listings.csv"), dt.date(2024, 1, 1), least_rows=1)  # again: nothing changes
    assert sorted(map(tuple, p.table("listings").collect()), key=str) == before


def test_documents_to_signals(platform, spark):
    p, root = platform
    assert p.ingest(str(root / "drop")) == 4 and p.ingest(str(root / "drop")) == 0
    counts = {r["status"]: r["count"] for r in p.parse().collect()}
    assert counts == {"validated": 2, "review": 1}
    trades = p.table("trades").collect()
    assert {(t["person"], t["classification"], t["price_per_unit"] and round(float(t["price_per_unit"]), 2)) for t in trades} == {("Jo Smith", "onmkt_buy_cash", 1.2), ("Al Green", "onmkt_buy_cash", 1.2)}
    p.build_signals()
    cluster = p.signals("cluster").collect()
    assert len(cluster) == 1 and cluster[0]["ticker"] == "RNG" and cluster[0]["directors"] == "Al Green; Jo Smith" and "membership_unknown" in cluster[0]["coverage_flags"] and float(cluster[0]["avg_price"]) == 1.2
    assert [r["person"] for r in p.signals("conviction").collect()] == ["Jo Smith"]
    assert p.uncorroborated().first()["corroboration"] == "contradicted"
    item = p.review_list().where("kind = 'extraction'").first()
    assert p.review_show(item["item_id"]).count() == 1
    p.review_resolve(item["item_id"], "accepted")
    assert p.table("trades").count() == 3 and p.table("documents").where("parse_status = 'validated'").count() == 3
    assert p.reprocess().count() == 0
    assert p.check().count() == 0
    p.build_signals()
    assert p.signals("cluster").count() == 1


def test_index_membership_drops_members(platform, tmp_path):
    p, _ = platform
    (tmp_path / "h.csv").write_text("Holdings\nTicker,Name\nRNG AU,Ring\nZZZ AU,None\n")
    missing = p.load_index(str(tmp_path / "h.csv"), dt.date(2024, 6, 10))
    assert [r["ticker"] for r in missing.collect()] == ["ZZZ"]
    p.build_signals()
    assert p.signals("cluster").count() == 0


def test_monitor_and_report(platform, spark):
    p, _ = platform
    p.put("feed_slos", spark.createDataFrame([("app_3y", 2, 1, 24)], "feed string, window_days int, least int, stale_hours int"))
    found = {r["check"] for r in p.monitor(dt.datetime(2030, 1, 1)).collect()}
    assert "volume" in found and p.table("monitor_runs").count() == 1 and not p.table("monitor_runs").first()["ok"]
    assert any(line.startswith("PARSE STATUS") for line in p.ops_report(dt.datetime(2030, 1, 1)))


def test_shares_and_backtest(platform, spark):
    p, _ = platform
    day = dt.date
    at = dt.datetime(2024, 1, 1)
    p.put("share_anchors", spark.createDataFrame([(1, "ORD", day(2024, 1, 1), 100, at, "note")], "entity_id long, class_code string, anchor_date date, anchor_qty int, knowable_at timestamp, source_note string"))
    p.put("share_events", spark.createDataFrame([(1, 1, "ORD", day(2024, 2, 1), at, "split", 2, 1, None), (2, 1, "ORD", day(2024, 3, 1), at, "issue", None, None, 10)], "event_id long, entity_id long, class_code string, event_date date, knowable_at timestamp, kind string, ratio_num int, ratio_den int, qty_delta int"))
    assert [float(r["quantity"]) for r in p.shares_outstanding().collect()] == [210.0] and [float(r["quantity"]) for r in p.shares_outstanding(day(2024, 2, 15)).collect()] == [200.0]
    p.put("manual_share_counts", spark.createDataFrame([(1, "ORD", day(2024, 2, 15), 201), (1, "ORD", day(2024, 4, 1), 300)], "entity_id long, class_code string, as_at date, quantity int"))
    assert sorted(r["within_tolerance"] for r in p.reconcile().collect()) == [False, True]
    with pytest.raises(BacktestUnavailable):
        p.backtest()


def test_snapshot_round_trip(platform, spark, tmp_path):
    p, _ = platform
    p.snapshot(str(tmp_path / "s"))
    q = Platform(spark, str(tmp_path / "tables"))
    q.restore(str(tmp_path / "s"))
    for name in ("trades", "entity_names", "documents", "signal_cluster_buys", "review_items"):
        a, b = (x.table(name).select([F.col(c).cast("string") for c in x.table(name).columns]) for x in (p, q))
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0, name


def test_command_line():
    a = arguments(["--root", "x", "universe", "--as-of", "2024-01-01", "--exclude-top", "300"])
    assert (a.command, a.as_of, a.exclude_top) == ("universe", dt.date(2024, 1, 1), 300)


def test_shares_at_a_day(platform):
    p, _ = platform
    day = dt.date
    got = {str(d): [(float(r["replayed"]), r["external"] and float(r["external"]), r["within_tolerance"]) for r in p.reconciled_at(d).collect()] for d in (day(2024, 2, 10), day(2024, 3, 5))}
    assert got == {"2024-02-10": [(200.0, None, None)], "2024-03-05": [(210.0, 201.0, False)]}


def test_number_coverage(platform):
    p, _ = platform
    r = p.number_coverage().first()
    assert (r["total"], r["with_number"], r["flagged_foreign"], r["unresolved"], r["meets"]) == (3, 2, 0, 1, False)


def test_loads_are_applied_once(platform, spark, tmp_path):
    p = Platform(spark, str(tmp_path / "tables"))
    (tmp_path / "a.csv").write_text(REGISTRY)
    (tmp_path / "b.csv").write_text(REGISTRY.splitlines()[0] + "\nGAMMA LIMITED|3|APUB|Y|01/02/2001|\n")
    done = []
    load = lambda *names, force=False: p.load("registry", dt.date(2024, 1, 1), [str(tmp_path / n) for n in names], lambda: done.append(names), force)
    assert [load("a.csv"), load("a.csv"), load("a.csv", "b.csv"), load("a.csv", "b.csv"), load("a.csv", "b.csv", force=True)] == ["new", "unchanged", "changed", "unchanged", "forced"]
    assert done == [("a.csv",), ("a.csv", "b.csv"), ("a.csv", "b.csv")]
    with pytest.raises(ValueError):
        load("a.csv", "a.csv")


def test_parsers_by_class(spark, tmp_path):
    from pitlake.plans.parsers import InterestNotices, Registry

    class Other(InterestNotices):
        name, doc_classes = "other_reader", ("trading_update",)

    both = Registry([InterestNotices(), Other()])
    assert both.doc_classes() == {"app_3y", "app_3z", "trading_update"} and both["other_reader"].version == 1
    for bad in (InterestNotices(), object()):
        with pytest.raises((TypeError, ValueError)):
            both.register(bad)
    p = Platform(spark, str(tmp_path / "tables"), parsers=[])
    assert p.parse().count() == 0


def test_screens_as_files_and_backfill(platform, spark, tmp_path, monkeypatch):
    p, root = platform
    import pitlake.session
    from pitlake.__main__ import main

    monkeypatch.setattr(pitlake.session, "session", lambda *a, **k: spark)
    assert main(["--root", p.root, "universe", "--as-of", "2024-06-01", "--out", str(tmp_path / "u")]) == 0
    assert [r["code"] for r in spark.read.csv(str(tmp_path / "u"), header=True).collect()] == ["BTG", "RNG", "TRU"]
    assert main(["--root", p.root, "signals", "--out", str(tmp_path / "s")]) == 0
    assert main(["--root", p.root, "backfill", str(root / "drop")]) == 0
