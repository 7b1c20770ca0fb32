"""Documents: title classes, detections, capture matching, dating, and the raw zone."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .temporal import nearest_join

# The classes of titles, in the order in which they are tried.
TITLE_CLASSES = [
    ("app_3z", r"appendix\s*3z|final\s+director'?s?\s+interest"),
    ("app_3y", r"appendix\s*3y|change\s+(of|in|to)\s+director'?s?\s+interest|director'?s?\s+interest\s+notice"),
    ("app_3b", r"appendix\s*3b|proposed\s+issue\s+of\s+securities"),
    ("app_2a", r"appendix\s*2a|application\s+for\s+quotation"),
    ("lr_3_10a_notice", r"3\.?10a|release\s+(of|from)\s+escrow|escrow\s+release|restricted\s+securities.{0,40}(releas|cess?at|cease|end)|(releas\w*|cessation)\s+(of\s+)?restricted\s+securities"),
    ("substantial_603", r"form\s*603|becoming\s+a\s+substantial\s+(share)?holder"),
    ("substantial_604", r"form\s*604|change\s+in\s+substantial\s+(share)?holding"),
    ("substantial_605", r"form\s*605|ceasing\s+to\s+be\s+a\s+substantial\s+(share)?holder"),
    ("quarterly_4c_5b", r"appendix\s*4c|appendix\s*5b|quarterly\s+(activities|cash\s*flow)\s+report"),
    ("half_year", r"appendix\s*4d|half[\s-]?year(ly)?\s+(financial\s+)?report|interim\s+financial\s+report"),
    ("annual_report", r"annual\s+report"),
    ("capital_reorg", r"(share|capital|securities)\s+consolidation|consolidation\s+of\s+(capital|securities|shares)|reorgani[sz]ation\s+of\s+capital|share\s+split"),
    ("notice_of_meeting", r"notice\s+of\s+(annual\s+general\s+|general\s+|extraordinary\s+general\s+)?meeting"),
    ("cleansing_notice", r"cleansing\s+(notice|statement)"),
    ("prospectus", r"\bprospectus\b"),
]
INTEREST = r"interest\s+notice|notice\s+of\s+interest|change\s+(of|in|to)\s+.{0,30}\binterest\b"
PARSEABLE = ("app_3y", "app_3z")

# How long before and after a file was made its alert may come.
EARLY_S, LATE_S = 30 * 60, 18 * 3600
PAIR_WORDS = r"\b(limited|ltd|nl|pty|the|group|holdings?)\b"


def title_class(title: Column, code: Column | None = None, codes: dict[str, str] | None = None, model: Column | None = None) -> Column:
    """struct(doc_class, method): by code, by the first wording, by a model's answer, else other (ambiguous if an interest is named)."""
    said = F.coalesce(title, F.lit(""))
    pair = lambda c, m: F.struct(F.lit(c).alias("doc_class") if isinstance(c, str) else c.alias("doc_class"), F.lit(m).alias("method"))
    names = [n for n, _ in TITLE_CLASSES] + ["annual_report", "other"]
    out = None
    chain = []
    if code is not None and codes:
        chain += [(code == k, pair(v, "code")) for k, v in codes.items()]
    chain += [(said.rlike(f"(?i){p}"), pair(n, "rules")) for n, p in TITLE_CLASSES]
    if model is not None:
        chain.append((model.isin(*names), pair(model, "model")))
    chain.append((said.rlike(f"(?i){INTEREST}"), pair("other", "ambiguous")))
    for when, then in chain:
        out = F.when(when, then) if out is None else out.when(when, then)
    return out.otherwise(pair("other", "default"))


def detection_key(announcement: Column, source: Column, ref: Column) -> Column:
    """The digest of the announcement's own number, else of where it was seen."""
    return F.sha2(F.coalesce(F.concat(F.lit("announcement|"), announcement), F.concat_ws("|", source, ref)).cast("binary"), 256)


def record_detections(stored: DataFrame, incoming: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Detections after ``incoming`` (first of each key wins), and the review items it raises.

    Both: key, ticker, title, entity_id, doc_class, method, format_recognised, detected_at.
    """
    first = incoming.withColumn("__nr", F.row_number().over(Window.partitionBy("key").orderBy("detected_at", "title"))).where("__nr = 1").drop("__nr")
    new = first.join(stored.select("key"), "key", "left_anti")
    old = stored.select("key", F.col("ticker").alias("__ticker"), F.col("title").alias("__title"))
    clash = incoming.join(old.unionByName(first.select("key", F.col("ticker").alias("__ticker"), F.col("title").alias("__title")).join(stored.select("key"), "key", "left_anti")), "key").where("not (ticker <=> __ticker) or not (title <=> __title)")
    item = lambda df, why: df.select("key", F.lit(why).alias("reason"))
    reviews = item(clash, "one key, two announcements")
    for where, why in ((~F.col("format_recognised"), "format not recognised"), (F.col("ticker").isNull(), "no ticker"), (F.col("ticker").isNotNull() & F.col("entity_id").isNull(), "ticker not resolved"), (F.col("method") == "ambiguous", "class ambiguous")):
        reviews = reviews.unionByName(item(new.where(where), why))
    return stored.unionByName(new.select(*stored.columns)), reviews.distinct()


def match_captures(captures: DataFrame, detections: DataFrame) -> DataFrame:
    """capture_id, detection_id, how: each file's open detection, by the first rule that finds one.

    Announcement number, then key, then a ticker with one open detection, then the nearest in
    time of that ticker's day, then printed identifiers with one open detection; else null.
    ``captures``: capture_id, announcement, key, ticker, lodged_at, entity_id;
    ``detections``: detection_id, announcement, key, ticker, lodged_at, entity_id.
    """
    def unique(column: str) -> DataFrame:
        one = detections.where(F.col(column).isNotNull()).groupBy(column).agg(F.min("detection_id").alias("__id"), F.count(F.lit(1)).alias("__n")).where("__n = 1")
        return one.select(F.col(column), F.col("__id").alias(f"by_{column}"))

    out = captures
    for column in ("announcement", "key", "entity_id"):
        out = out.join(unique(column), column, "left")
    out = out.join(unique("ticker").withColumnRenamed("by_ticker", "__only"), "ticker", "left")
    out = out.withColumn("by_ticker", F.when(F.col("lodged_at").isNull(), F.col("__only"))).drop("__only")
    dated = captures.where("lodged_at is not null").withColumn("__day", F.to_date("lodged_at")).select("capture_id", "ticker", "__day", "lodged_at")
    near = nearest_join(dated, detections.withColumn("__day", F.to_date("lodged_at")).where("lodged_at is not null"), ["ticker", "__day"], "capture_id", "lodged_at", "detection_id", "lodged_at")
    out = out.join(near.select("capture_id", F.col("detection_id").alias("by_day")), "capture_id", "left")
    rules = [("by_announcement", "announcement"), ("by_key", "key"), ("by_ticker", "ticker"), ("by_day", "ticker_day"), ("by_entity_id", "content")]
    how = None
    for column, name in rules:
        how = F.when(F.col(column).isNotNull(), name) if how is None else how.when(F.col(column).isNotNull(), name)
    return out.select("capture_id", F.coalesce(*(c for c, _ in rules)).alias("detection_id"), how.otherwise("standalone").alias("how"))


def pair_name(name: Column) -> Column:
    """A name for pairing alerts with files: letters and digits without company words."""
    plain = F.regexp_replace(F.lower(name), r"[^a-z0-9 ]", " ")
    return F.trim(F.regexp_replace(F.regexp_replace(plain, PAIR_WORDS, " "), r"\s+", " "))


def alert_fits(alert_at: Column, made_at: Column) -> Column:
    """Whether an alert's time is near enough to when the file was made."""
    gap = F.unix_micros(alert_at) - F.unix_micros(made_at)
    return gap.between(-EARLY_S * 1_000_000, LATE_S * 1_000_000)


def lodgement(alert_at: Column, made_at: Column) -> Column:
    """struct(at, source, corroborated_by): the alert's time, else the file's own."""
    kind = "struct<at:timestamp,source:string,corroborated_by:string>"
    alert = F.struct(alert_at.cast("timestamp").alias("at"), F.lit("alert").alias("source"), F.when(F.coalesce(alert_fits(alert_at.cast("timestamp"), made_at.cast("timestamp")), F.lit(False)), "file").alias("corroborated_by"))
    made = F.struct(made_at.cast("timestamp").alias("at"), F.lit("file").alias("source"), F.lit(None).cast("string").alias("corroborated_by"))
    return F.when(alert_at.isNotNull(), alert.cast(kind)).when(made_at.isNotNull(), made.cast(kind))


def facts(text: Column) -> Column:
    """What a form says about itself: its eleven- and nine-digit numbers, class and entity name."""
    tight = lambda a: F.transform(a, lambda x: F.regexp_replace(x, r"\s+", ""))
    every = lambda p: F.regexp_extract_all(text, F.lit(p), 1)
    labelled = every(r"(?i)\bABN\s*:?\s*(\d{2}\s*\d{3}\s*\d{3}\s*\d{3})\b")
    bare = every(r"\b(\d{2}\s?\d{3}\s?\d{3}\s?\d{3})\b")
    nine = F.concat(every(r"(?i)\bACN\s*:?\s*(\d{3}\s*\d{3}\s*\d{3})\b"), every(r"(?i)\bABN\s*:?\s*(\d{3}\s*\d{3}\s*\d{3})(?!\s*\d)"))
    kind = F.when(text.rlike(r"(?i)appendix\s*3z|final\s+director"), "app_3z").when(text.rlike(r"(?i)appendix\s*3y|change\s+of\s+director"), "app_3y")
    name = F.regexp_extract(text, r"(?is)Name\s+of\s+(?:the\s+)?entity\s*:?\s*(.{3,80}?)(?=\s{2,}|\s*\b(?:ABN|ACN|ARBN)\b|\n)", 1)
    return F.struct(F.when(F.size(labelled) > 0, tight(labelled)).otherwise(tight(bare)).alias("abns"), F.array_distinct(tight(nine)).alias("acns"), kind.alias("doc_class"), F.nullif(F.trim(F.regexp_replace(name, r"\s+", " ")), F.lit("")).alias("entity_name"))


# ---------------------------------------------------------------- raw zone


def digest(content: Column) -> Column:
    return F.sha2(content.cast("binary"), 256)


def raw_path(sha: Column) -> Column:
    """Where the bytes of a digest are: aa/bb/digest."""
    return F.concat_ws("/", F.substring(sha, 1, 2), F.substring(sha, 3, 2), sha)


def ingest(stored: DataFrame, incoming: DataFrame, content: str, *order: str) -> DataFrame:
    """Incoming rows with a new digest, one of each; bytes already stored come again without a trace."""
    hashed = incoming.withColumn("sha256", digest(F.col(content)))
    first = F.row_number().over(Window.partitionBy("sha256").orderBy(*(order or (content,))))
    return hashed.withColumn("__nr", first).where("__nr = 1").drop("__nr").join(stored.select("sha256"), "sha256", "left_anti")


def verified(rows: DataFrame, content: str, text: str, sha: str, text_sha: str) -> DataFrame:
    """Each row with what may be read: its bytes if they hash right, else its text if that does, else an error."""
    good, good_text = digest(F.col(content)) == F.col(sha), digest(F.col(text)) == F.col(text_sha)
    source = F.when(F.coalesce(good, F.lit(False)), "bytes").when(F.coalesce(good_text, F.lit(False)), "text").otherwise("error")
    readable = F.when(source == "bytes", F.col(content).cast("binary")).when(source == "text", F.col(text).cast("binary"))
    return rows.withColumn("read_from", source).withColumn("readable", readable)


def backfill(rows: DataFrame, found: DataFrame, sha: str) -> DataFrame:
    """Rows lacking text or date filled from ``found`` (sha, text, made_at), with the outcome of each."""
    new = found.select(F.col(sha), F.col("text").alias("__text"), F.col("made_at").alias("__made")).dropDuplicates([sha])
    out = rows.join(new.withColumn("__hit", F.lit(True)), sha, "left")
    lacks = F.col("text").isNull() | F.col("lodged_at").isNull()
    fills_text, fills_date = F.col("text").isNull() & F.col("__text").isNotNull(), F.col("lodged_at").isNull() & F.col("__made").isNotNull()
    what = F.when(~lacks, "complete").when(F.col("__hit").isNull(), "missing").when(fills_text & fills_date, "both").when(fills_text, "text").when(fills_date, "date").otherwise("unreadable")
    return out.withColumn("outcome", what).withColumn("text", F.coalesce("text", "__text")).withColumn("lodged_at", F.coalesce("lodged_at", "__made")).drop("__text", "__made", "__hit")


def attach(detections: DataFrame, captures: DataFrame, classes: Sequence[str] = PARSEABLE) -> DataFrame:
    """Detections with the digest of their file; a file that another document has closes the detection."""
    taken = detections.where("sha256 is not null").select("sha256").withColumn("__taken", F.lit(True)).distinct()
    got = captures.select("detection_id", F.col("sha256").alias("__sha")).dropDuplicates(["detection_id"]).join(taken.withColumnRenamed("sha256", "__sha"), "__sha", "left")
    out = detections.join(got, "detection_id", "left")
    status = F.when(F.col("__sha").isNull(), F.col("parse_status")).when(F.col("__taken"), "not_applicable").when(F.col("doc_class").isin(*classes), "unparsed").otherwise("not_applicable")
    return out.withColumn("parse_status", status).withColumn("sha256", F.coalesce("sha256", F.when(F.col("__taken").isNull(), F.col("__sha")))).drop("__sha", "__taken")


def worklist(detections: DataFrame, most: int, classes: Sequence[str] = PARSEABLE) -> DataFrame:
    """Open detections worth capturing: sensitive first, newest first, unknown times last."""
    return detections.where((F.col("parse_status") == "detected") & F.col("doc_class").isin(*classes)).orderBy(F.col("price_sensitive").desc_nulls_last(), F.col("lodged_at").desc_nulls_last(), "detection_id").limit(most)


def spot_check(rows: DataFrame, most: int, seed: int = 0) -> DataFrame:
    """A sample for a human to check, the same for the same seed."""
    return rows.orderBy(F.rand(seed)).limit(most)
