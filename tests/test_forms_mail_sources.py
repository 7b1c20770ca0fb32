import datetime as dt
import gzip
import json
import re

import pytest

from pitlake.functions import forms as FM
from pitlake.functions import mail as M
from pitlake.sources import files as SF
from pitlake.sources import state as ST

FORM = """Appendix 3Y  Change of Director's Interest Notice
Name of entity  Ring Widgets Limited   ABN 12 345 678 901
Name of Director\tJo Smith  Date of last notice 1 May 2024
Part 1 - Change of director's relevant interests in securities
Direct or indirect interest  Direct  Date of change 12-14 August 2026
No. of securities held prior to change Direct 1,205,155 ordinary shares Indirect 27,765,832 ordinary shares
Class Ordinary sha res  Number acquired 5,000  Number disposed Nil
Value/Consider ation Note: If consideration is non-cash, provide details and estimated valuation $6,410.50
No. of securities held after change Direct 1,210,155 ordinary shares Indirect 27,765,832 ordinary shares
Nature of change On market trade Part 2 - Change of director's interests in contracts"""


def test_form():
    n = FM.notice(FM.read_forms(FORM)[0])
    assert n["form"] == "app_3y" and n["director_name"] == "Jo Smith" and n["consideration_aud"] == 6410.5 and n["qty_acquired"] == 5000 and n["qty_disposed"] is None
    assert (n["held_before"], n["held_after"]) == (1205155, 1210155)
    assert (n["date_of_change"], n["date_basis"], len(n["dates_stated"])) == (dt.date(2026, 8, 13), "range_midpoint", 2)


def test_several_forms_and_one_out_of_order():
    forms = FM.read_forms("covering letter " + FORM + " " + FORM.replace("Jo Smith", "Al Green"))
    assert [FM.notice(f)["director_name"] for f in forms] == ["Jo Smith", "Al Green"]
    bad = FM.read_forms("Name of entity X Name of Director Date of change Class Direct or indirect interest Jo 1 May 2024 Ordinary")[0]
    assert bad.scrambled and FM.notice(bad) is None
    assert FM.read_forms(None)[0].cells == {} and FM.read_forms("")[0].kind is None


@pytest.mark.parametrize(
    ("cell", "expected"),
    [("17 August 2026 and 13 August 2026", (dt.date(2026, 8, 15), "enumeration_midpoint")), ("12 March 2026 14 August 2026", (None, "stated")), ("4.8.2026", (dt.date(2026, 8, 4), "stated")), ("13th August 2026", (dt.date(2026, 8, 13), "stated")), ("", (None, "stated")), ("31/31/2026", (None, "stated"))],
)
def test_change_day(cell, expected):
    assert FM.change_day(cell)[:2] == expected


def test_cells():
    assert FM.quantity("2,885,833 Fully paid") == 2885833 and FM.quantity("Nil") is None and FM.quantity("850") == 850
    assert FM.money("$1.215 per share") is None and FM.money("$1.215 per share, $40,000.00 total") == 40000.0
    assert FM.of_ordinary("(a) Ordinary Shares (b) Performance Rights", "(a) 150,000 (b) 250,000", "B. 53,571")[1] == ["150,000", None]
    assert FM.holdings("300,000,770 ordinary shares as follows: 100,000 200,770", "5,000,000 ordinary shares")[0] == 300000770
    assert FM.security("share rights") is None or FM.security("share rights") == "other"


MAIL = b"""From: Alerts <noreply@provider.example>
Subject: ASX:RNG - Sensitive Ann: Change of Director's Interest Notice
Message-ID: <1@provider.example>
Date: Tue, 18 Aug 2026 07:40:00 +0000
Content-Type: text/plain; charset=utf-8

| Ring Widgets Ltd (RNG)
Published: 18/08/26, 05:37pm (AEST)
<https://www.provider.example/asx/rng/announcements/change-
-2A1690463> https://ring.example/files/notice.pdf https://ring.example/unsubscribe.pdf http://ring.example/x.pdf
"""


def test_mail():
    sender = M.Sender("provider_alert", "provider", re.compile(r"^ASX:(?P<ticker>[A-Z0-9]{2,6})\s*-\s*(?P<kind>Announcement|Sensitive Ann)\s*:\s*(?P<title>.+)$"), ("provider.example",))
    for raw in (MAIL, gzip.compress(MAIL)):
        d = M.detection(raw, (sender,))
        assert (d["ticker"], d["price_sensitive"], d["announcement"], d["company"]) == ("RNG", True, "2A1690463", "Ring Widgets Ltd")
        assert d["document_urls"] == ["https://ring.example/files/notice.pdf"] and d["lodged_at"] == dt.datetime(2026, 8, 18, 7, 37, tzinfo=dt.timezone.utc)
    unknown = M.detection(MAIL.replace(b"ASX:RNG - Sensitive Ann: Change", b"New ASX announcement for you: change"), ())
    assert unknown["ticker"] is None and unknown["price_sensitive"] is None


def test_mail_folder_to_detections(spark, tmp_path):
    (tmp_path / "a.eml").write_bytes(MAIL)
    (tmp_path / "b.eml.gz").write_bytes(gzip.compress(MAIL))
    (tmp_path / "README.txt").write_text("no mail")
    out = M.detections(SF.read_mail_folder(spark, str(tmp_path))).collect()
    assert len(out) == 2 and {r["announcement"] for r in out} == {"2A1690463"}
    empty = tmp_path / "other"
    empty.mkdir()
    (empty / "x.bin").write_bytes(b"1")
    with pytest.raises(ValueError):
        SF.read_mail_folder(spark, str(empty))


def test_registry(spark, tmp_path):
    lines = ["Company Name|ACN|Type|Current Name Indicator|Date of Registration", "Ring Ltd|4 1|APUB|Y|01/02/1999", "Old Ring NL|41|APUB||", "|5|APUB|Y|", "No Number||APUB|Y|"]
    for part in ("a", "b"):
        (tmp_path / f"{part}.csv").write_text("\n".join(lines if part == "a" else [lines[0], "Beta Pty Ltd|77|APTY|Y|19990201"]) + "\n")
    rows = sorted((r["number"], r["name_norm"], r["is_current_name"], str(r["registration_date"])) for r in SF.read_registry(spark, str(tmp_path / "a.csv"), str(tmp_path / "b.csv")).collect())
    assert rows == [("000000041", "OLD RING", False, "None"), ("000000041", "RING", True, "1999-02-01"), ("000000077", "BETA", True, "1999-02-01")]
    (tmp_path / "c.csv").write_text("x,y\n1,2\n")
    with pytest.raises(SF.HeaderError):
        SF.read_registry(spark, str(tmp_path / "c.csv"))


def test_preambles(spark, tmp_path):
    (tmp_path / "l.csv").write_text('Listed companies\n"as at 1 Jan"\n\nCode,Company name,GICS industry group,Listing date,Market Cap\nrng,"Ring, Ltd",Toys,1/2/2020,"1,000"\nabc,Abc,Toys,,--\n')
    rows = sorted((r["ticker"], r["name"], str(r["listing_date"]), r["market_cap"] and int(r["market_cap"])) for r in SF.read_listings(spark, str(tmp_path / "l.csv")).collect())
    assert rows == [("ABC", "Abc", "None", None), ("RNG", "Ring, Ltd", "2020-02-01", 1000)]
    (tmp_path / "h.csv").write_text("Fund holdings\nTicker,Name,Weight\nBHP AU,Bhp,1\nBHP AU,Bhp,1\nCASH,,2\n")
    assert sorted(r["ticker"] for r in SF.read_holdings(spark, str(tmp_path / "h.csv")).collect()) == ["BHP", "CASH"]


def test_xml_and_file_drop(spark, tmp_path):
    (tmp_path / "x.xml").write_text("<T><ABR><ABN>12345678901</ABN><ASICNumber>41</ASICNumber></ABR><ABR><ABN>123</ABN></ABR></T>")
    assert [tuple(r) for r in SF.read_business_numbers(spark, str(tmp_path / "x.xml"), "ABR", ["ABN"], ["ASICNumber"]).collect()] == [("12345678901", "000000041")]
    drop = tmp_path / "drop" / "deep"
    drop.mkdir(parents=True)
    (drop / "n.txt").write_text("notice")
    (drop / "n.txt.meta.json").write_text(json.dumps({"ticker": "RNG", "lodged_at": "2026-08-19T09:30:00"}))
    (drop / "m.txt").write_text("other")
    rows = {r["path"].rsplit("/", 1)[1]: (r["ticker"], str(r["lodged_at"])) for r in SF.read_file_drop(spark, str(tmp_path / "drop")).collect()}
    assert rows == {"n.txt": ("RNG", "2026-08-18 23:30:00"), "m.txt": (None, "None")}


def test_state_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(2, "b"), (1, None)], "id int, v string")
    counts = ST.export({"t": (df, ["id"])}, str(tmp_path / "s")).collect()
    back = ST.restore(spark, str(tmp_path / "s"), {"t": df.schema})["t"]
    assert counts[0]["n_rows"] == 2 and sorted(map(tuple, back.collect())) == [(1, None), (2, "b")] and ST.next_id(back, "id") == 3
    SF.write_raw(df.select("v").where("v is not null"), str(tmp_path / "raw"), "v")
    SF.write_raw(df.select("v").where("v is not null"), str(tmp_path / "raw"), "v")
    assert spark.read.parquet(str(tmp_path / "raw")).count() == 1
    SF.write_csv(df, str(tmp_path / "csv"), ["id"])
    assert spark.read.csv(str(tmp_path / "csv"), header=True).count() == 2


def test_pluggable_source(spark):
    from pitlake.sources import announcements as A

    A.register(spark)
    rows = spark.read.format("announcements").option("source", "pitlake.sources.announcements:example").option("parts", 3).load()
    assert rows.count() == 6 and rows.where("lodged_at is null and ticker = 'RNG'").count() == 6


CLUTTERED = """Rule 3.19A.2 Appendix 3Y Change of +Director's Interest Notice Introduced 30/09/01 Amended 01/01/11
Information or documents not available now must be given to ASX as soon as available. Information and documents given to ASX become ASX's property and may be made public.
0BName of entity  Ring Widgets Limited   1BABN 12 345 678 901
We (the entity) give ASX the following information under listing rule 3.19A.2 and as agent for the director for the purposes of section 205G of the Corporations Act.
2BName of Director Rowena Smith  Date of last notice 1 May 2024
In the case of a company, interests which come within paragraph (ii) of the definition of "notifiable interest of a director" should be disclosed in this part.
Direct or indirect interest  Direct  Date of change 12 August 2026
No. of securities held prior to change 1,205,155 ordinary shares 3461-0342-1486, v. 1 + See chapter 19 for defined terms. 01/01/2011 Appendix 3Y Page 1
Class Ordinary shares Number acquired 5,000 Number disposed Nil Value/Consideration $6,410.50 For personal use only
No. of securities held after change 1,210,155 ordinary shares Nature of change On market trade Part 2"""


def test_printed_clutter_is_no_answer():
    form = FM.read_forms(CLUTTERED)[0]
    n = FM.notice(form)
    assert n["entity_name"] == "Ring Widgets Limited" and n["director_name"] == "Rowena Smith" and n["consideration_aud"] == 6410.5
    assert (n["held_before"], n["held_after"], n["date_of_change"]) == (1205155, 1210155, dt.date(2026, 8, 12))
    assert form.cells["identifier"] == "12 345 678 901" and form.cells["interest_nature"] == "Direct" and form.cells["held_before"] == "1,205,155 ordinary shares"
    both = FM.read_forms(CLUTTERED + " " + CLUTTERED.replace("Rowena Smith", "Al Green"))
    assert [FM.notice(f)["director_name"] for f in both] == ["Rowena Smith", "Al Green"]
    assert FM.without_clutter("costs $10billion of 1234-5678 units") == "costs $10billion of 1234-5678 units"


PROVIDER = b"""From: Market Index <alerts@marketindex.com.au>
Subject: ASX:RNG - Announcement: Appendix 3Y
Message-ID: <2@marketindex.com.au>
Date: Tue, 18 Aug 2026 07:40:00 +0000
Content-Type: text/plain; charset=utf-8

https://www.marketindex.com.au/asx/rng/announcements/appendix-3y-2A1690463?utm=1 https://www.marketindex.com.au/manage/alerts.pdf https://ring.example/notice.pdf
"""


def test_known_senders():
    d = M.detection(PROVIDER)
    assert (d["source"], d["ticker"], d["title"], d["price_sensitive"], d["announcement"], d["format_recognised"]) == ("market_index_alert", "RNG", "Appendix 3Y", False, "2A1690463", True)
    assert d["manual_open_urls"] == ["https://www.marketindex.com.au/asx/rng/announcements/appendix-3y-2A1690463"] and d["document_urls"] == ["https://ring.example/notice.pdf"]
    other = M.detection(PROVIDER.replace(b"ASX:RNG - Announcement: Appendix 3Y", b"Your RNG alerts"))
    assert other["ticker"] is None and not other["format_recognised"]
    listed = M.detection(PROVIDER.replace(b"marketindex", b"listcorp").replace(b"ASX:RNG - Announcement:", b"RNG -"))
    assert (listed["source"], listed["ticker"], listed["title"], listed["manual_open_urls"]) == ("listcorp_alert", "RNG", "Appendix 3Y", [])


def test_loads_on_record(spark):
    loads = spark.createDataFrame([(4, "r", dt.date(2024, 1, 1), True), (5, "s", dt.date(2024, 1, 1), True)], "load_id long, source string, as_at date, applied boolean")
    parts = spark.createDataFrame([(4, 1, "a"), (4, 2, "b"), (5, 1, "a")], "load_id long, part_no int, sha256 string")
    day = dt.date(2024, 2, 1)
    offer = lambda *rows: spark.createDataFrame([(s, day, n, h) for s, n, h in rows], "source string, as_at date, part_no int, sha256 string")
    after, lists, outcome = ST.register_loads(loads, parts, offer(("r", 1, "a"), ("r", 2, "c"), ("s", 1, "a"), ("t", 1, "a"), ("t", 2, "z")))
    assert sorted(map(tuple, outcome.collect())) == [("r", 4, "changed"), ("s", 5, "unchanged"), ("t", 6, "new")]
    assert sorted((r["load_id"], r["applied"]) for r in after.collect()) == [(4, False), (5, True), (6, False)]
    assert sorted(map(tuple, lists.collect())) == [(4, 1, "a"), (4, 2, "c"), (5, 1, "a"), (6, 1, "a"), (6, 2, "z")]
    with pytest.raises(ValueError):
        ST.register_loads(loads, parts, offer(("r", 1, "a"), ("r", 2, "a")))
    assert ST.register_loads(loads.limit(0), parts.limit(0), offer(("r", 1, "q")))[2].first()["load_id"] == 1


def test_numbers_in_order(spark):
    df = spark.range(1000).selectExpr("(id * 7919) % 1000 AS v").repartition(7)
    assert sorted((r["n"], r["v"]) for r in ST.numbered(df, "n", 5, "v").collect()) == [(i + 5, i) for i in range(1000)]
    assert ST.numbered(df.limit(0), "n", 1, "v").count() == 0


def test_forms_of_one_file_are_read_on_all_cores(spark):
    text = "Appendix 3Y Change of Director's Interest Notice Name of entity A{0} Ltd Name of Director Jo Part 2"
    docs = spark.createDataFrame([(i, text.format(i)) for i in range(200)], "doc_id long, text string").coalesce(1)
    out = FM.extract_notices(docs)
    assert out.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
    assert {(r["doc_id"], r["entity_name"]) for r in out.collect()} == {(i, f"A{i} Ltd") for i in range(200)}


def test_clutter_and_labels_in_spaced_letters_and_other_cases():
    raw = "A P P E N D I X 3Y change of director's interest Na me of entıty X NİL Name o f Dİrector Jo Kay For perſonal use only No te: If consideration is non-cash, provide details and estimated valuation Page 3 of 4 Da te of change 1/2/2024"
    form = FM.read_forms(raw)[0]
    assert form.cells == {"entity_name": "X NİL", "director_name": "Jo Kay No te", "date_of_change": "1/2/2024"}
    assert FM.without_clutter("x Note : Page 3 of 4 Rule 3.19A.2 30/9/2001 Appendix 3X y 1234-5678-9012, v. 3 For personal use only z") == "x Note : y z"
