"""The platform over a folder of Parquet tables: load, read, decide, derive, watch.

Each operation reads whole tables, computes the next state as one plan and replaces the
tables it changes.  A table's new state is written beside the old one and a pointer file
names the current version, so a reader sees one or the other and a failed job leaves the
old one in place.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import mail
from ..functions import text as T
from ..operators import documents as D
from ..operators import events as E
from ..operators import identity as I
from ..operators import quality as Q
from ..operators import review as R
from ..operators import snapshots as S
from ..operators import temporal as P
from ..operators import trades as C
from ..sources import files, state
from .parsers import InterestNotices, Parser, Registry
from .schema import COLUMNS, KEYS, constraints, schema

SIGNAL_VERSION = 2
WINDOW_DAYS, LEAST_PERSONS, STALE_DAYS = 30, 2, 14


class BacktestUnavailable(RuntimeError):
    """There is no price source, and a backtest without prices is refused."""


class Platform:
    def __init__(self, spark: SparkSession, root: str, index_code: str = "INDEX", parsers: Sequence[Parser] | None = None):
        self.spark, self.root, self.index_code = spark, root.rstrip("/"), index_code
        self.parsers = Registry([InterestNotices()] if parsers is None else parsers)

    # ------------------------------------------------------------ tables

    def _fs(self, path: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()), p

    def _version(self, name: str) -> int:
        fs, p = self._fs(f"{self.root}/{name}")
        if not fs.exists(p):
            return 0
        return max((int(s.getPath().getName()[6:]) for s in fs.listStatus(p) if s.getPath().getName().startswith("ready=")), default=0)

    def table(self, name: str) -> DataFrame:
        version = self._version(name)
        if not version:
            return self.spark.createDataFrame([], schema(name))
        return self.spark.read.schema(schema(name)).parquet(f"{self.root}/{name}/v={version}")

    def put(self, name: str, df: DataFrame) -> None:
        """Replace a table; columns that ``df`` lacks are null."""
        version = self._version(name) + 1
        kind = schema(name)
        rows = df.select(*(F.col(f.name).cast(f.dataType).alias(f.name) if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in kind.fields))
        rows.write.mode("overwrite").parquet(f"{self.root}/{name}/v={version}")
        fs, ready = self._fs(f"{self.root}/{name}/ready={version}")
        fs.create(ready, True).close()

    def upsert(self, name: str, df: DataFrame) -> None:
        """Rows of ``df`` replace those of their key; columns it lacks keep what is stored."""
        kind = schema(name)
        full = df.select(*(F.col(f.name).cast(f.dataType).alias(f.name) if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in kind.fields))
        old = self.table(name)
        nulls = [k for k in KEYS[name]]
        self.put(name, S.upsert(old, full, nulls))

    def migrate(self) -> list[str]:
        """Create what is missing; the tables made."""
        made = [n for n in COLUMNS if not self._version(n)]
        for name in made:
            self.put(name, self.spark.createDataFrame([], schema(name)))
        return made

    def check(self) -> DataFrame:
        """Rows that break a constraint: table, row, rule."""
        out = None
        for name, rules in constraints().items():
            key = F.concat_ws("|", *(F.col(k).cast("string") for k in KEYS[name]))
            found = Q.violations(self.table(name).withColumn("row", key), rules, "row").select(F.lit(name).alias("table"), "row", "rule")
            out = found if out is None else out.unionByName(found)
        return out

    def _next(self, name: str, key: str) -> int:
        return state.next_id(self.table(name), key)

    def _numbered(self, df: DataFrame, name: str, key: str, *order) -> DataFrame:
        return state.numbered(df, key, self._next(name, key), *order)

    # ------------------------------------------------------------ reference data

    def load(self, source: str, as_at: dt.date, paths: Sequence[str], apply: Callable[[], object], force: bool = False) -> str:
        """Put an extract's parts on record and apply it, unless just these parts are applied already: new, changed, unchanged or forced."""
        files_ = self.spark.createDataFrame([(i, self._qualified(p)) for i, p in enumerate(paths, 1)], "part_no int, path string")
        digests = self.spark.read.format("binaryFile").load(list(dict.fromkeys(paths))).select("path", D.digest(F.col("content")).alias("sha256"))
        offered = files_.join(digests, "path").select(F.lit(source).alias("source"), F.lit(as_at).alias("as_at"), "part_no", "sha256")
        from ..session import cut

        loads, parts, outcomes = state.register_loads(self.table("reference_loads"), self.table("reference_load_parts"), cut(offered))
        now = outcomes.first()
        loads, parts = cut(loads), cut(parts)
        self.put("reference_loads", loads)
        self.put("reference_load_parts", parts)
        mine = F.col("load_id") == now["load_id"]
        if now["outcome"] == "unchanged" and not loads.where(mine & F.col("applied")).isEmpty():
            if not force:
                return "unchanged"
            now = {"outcome": "forced", "load_id": now["load_id"]}
        apply()
        self.put("reference_loads", self.table("reference_loads").withColumn("applied", F.col("applied") | mine))
        return now["outcome"]

    def _qualified(self, path: str) -> str:
        fs, p = self._fs(path)
        return fs.getFileStatus(p).getPath().toString()

    def load_registry(self, *paths: str) -> int:
        new = files.read_registry(self.spark, *paths)
        order = F.struct((~F.col("is_current_name")).cast("int"), F.coalesce("registration_date", F.to_date(F.lit("9999-12-31"))), "name")
        self.put("registry", S.upsert(self.table("registry"), new.select(*schema("registry").names), KEYS["registry"], order))
        return self.table("registry").count()

    def load_index(self, path: str, as_of: dt.date, knowable_at: dt.date | None = None) -> DataFrame:
        """An index's members on a date; tickers without an entity are kept and returned."""
        held = files.read_holdings(self.spark, path).select("ticker").withColumn("__day", F.lit(as_of))
        found = P.lookup_unique(held, self.table("listings"), ["ticker"], "ticker", "__day", "valid_from", "valid_to", "entity_id", "entity_id")
        rows = found.select(F.lit(self.index_code).alias("index_code"), "ticker", "entity_id", F.lit(as_of).alias("as_of"), F.lit(knowable_at or as_of).alias("knowable_at"))
        self.upsert("index_membership", rows)
        return rows.where("entity_id is null").select("ticker")

    def load_listings(self, path: str, as_at: dt.date, allow_shrink: bool = False, **limits) -> None:
        """A listings file as a snapshot: entities, names, listings, membership and figures after it."""
        day = F.lit(as_at)
        snap = files.read_listings(self.spark, path).dropDuplicates(["ticker"])
        S.check_gate(self.table("universe_membership").where("listed_to is null"), snap, allow_shrink, **limits)
        snap = snap.withColumn("name_norm", T.company_norm(F.col("name")))
        snap = I.rank_registrations(snap.select("name_norm").distinct(), self.table("registry"), "name_norm").join(snap, "name_norm", "right")
        entities = self.table("entities")
        by_number = entities.select(F.coalesce("acn", "arbn").alias("number"), F.col("entity_id").alias("by_number")).where("number is not null")
        current = self.table("entity_names").where("valid_to is null")
        snap = snap.join(by_number, "number", "left")
        snap = I.unique_match(snap, current, "name_norm", "entity_id", "by_name").withColumn("entity_id", F.coalesce("by_number", "by_name"))
        listings, names = self.table("listings"), self.table("entity_names")
        split = S.fused(listings, names, snap.where("entity_id is not null"), "entity_id", "ticker", "name_norm").select("ticker", F.lit(True).alias("split"))
        snap = snap.join(split, "ticker", "left").withColumn("entity_id", F.when(F.col("split").isNull(), F.col("entity_id"))).withColumn("number", F.when(F.col("split").isNull(), F.col("number")))
        fresh = snap.where("entity_id is null").withColumn("__same", F.coalesce("number", "name_norm")).groupBy("__same").agg(F.min("ticker").alias("__t"))
        fresh = self._numbered(fresh, "entities", "entity_id", "__t").select("__same", F.col("entity_id").alias("__new"))
        snap = snap.withColumn("__same", F.when(F.col("entity_id").isNull(), F.coalesce("number", "name_norm"))).join(fresh, "__same", "left").withColumn("entity_id", F.coalesce("entity_id", "__new"))
        from ..session import cut

        snap = cut(snap.select("ticker", "name", "name_norm", "sector", "listing_date", "market_cap", "number", "is_foreign", "entity_id", F.col("split").isNotNull().alias("split"), F.col("__new").isNotNull().alias("created")))
        new = snap.where("created").groupBy("entity_id").agg(F.max(F.when(~F.coalesce("is_foreign", F.lit(False)), F.col("number"))).alias("acn"), F.max(F.when(F.col("is_foreign"), F.col("number"))).alias("arbn"), F.when(F.max(F.col("is_foreign").cast("int")) == 1, "foreign").otherwise("company").alias("entity_kind"))
        moved = listings.where("valid_to is null").join(snap.select("ticker", F.col("entity_id").alias("__e")), "ticker").where("entity_id != __e")
        reasons = moved.select(F.concat(F.lit("ticker "), "ticker", F.lit(" moved")).alias("reason")).unionByName(snap.where("split").select(F.concat(F.lit("ticker "), "ticker", F.lit(" would join two companies")).alias("reason"))).unionByName(snap.where("created and number is null").select(F.concat(F.lit("no number for "), "name").alias("reason")))
        self._review(reasons.select(F.lit("resolution").alias("kind"), F.lit(None).cast("long").alias("doc_id"), F.lit(None).cast("string").alias("parser"), "reason"))
        self.put("entities", entities.unionByName(new, allowMissingColumns=True))
        seeded = S.name_history(self.table("registry").withColumnRenamed("number", "__n"), "__n").join(new.select("entity_id", F.coalesce("acn", "arbn").alias("__n")), "__n").drop("__n")
        history = names.unionByName(seeded.select(*names.columns)).dropDuplicates(KEYS["entity_names"])
        self.put("entity_names", S.close_names(history, snap, "entity_id", "name_norm", day))
        after = S.apply_snapshot(listings.select("entity_id", "ticker", "valid_from", "valid_to"), snap.select("entity_id", "ticker", F.col("listing_date").alias("listed")), "entity_id", "ticker", day)
        self.put("listings", after.withColumn("exchange", F.lit("MAIN")).withColumn("security_class", F.lit("ORD")).withColumn("source", F.lit("file")))
        members = self.table("universe_membership")
        seen = snap.select("entity_id").distinct()
        gone = members.where("listed_to is null").join(seen, "entity_id", "left_anti").select("entity_id", "listed_from", F.date_sub(day, 1).alias("listed_to"), F.coalesce("delist_reason", F.lit("absent_from_file")).alias("delist_reason"))
        begun = snap.groupBy("entity_id").agg(F.least(F.coalesce(F.min("listing_date"), day), day).alias("listed_from")).join(members.where("listed_to is null").select("entity_id"), "entity_id", "left_anti")
        self.upsert("universe_membership", gone.unionByName(begun, allowMissingColumns=True))
        self.upsert("listing_snapshots", snap.select("entity_id", day.alias("as_at"), "ticker", "market_cap", "sector", "listing_date"))

    def load_business_numbers(self, path: str, row_tag: str = "ABR", number: Sequence[str] = ("ABN",), company: Sequence[str] = ("ASICNumber",)) -> DataFrame:
        """ABNs for known companies; outcomes counted, conflicts to review."""
        extract = files.read_business_numbers(self.spark, path, row_tag, number, company).select(F.col("company").alias("acn"), F.col("number").alias("abn"))
        out = I.attach_numbers(self.table("entities"), extract, "acn", "abn")
        self._review(out.where("outcome = 'conflict'").select(F.lit("resolution").alias("kind"), F.lit(None).cast("long").alias("doc_id"), F.lit(None).cast("string").alias("parser"), F.concat(F.lit("two ABNs for "), "acn").alias("reason")))
        counts = out.groupBy("outcome").count().collect()
        self.put("entities", out)
        return self.spark.createDataFrame(counts, "outcome string, n long")

    # ------------------------------------------------------------ documents

    def _review(self, items: DataFrame) -> None:
        """New review items; one that is open already isn't repeated."""
        old = self.table("review_items")
        same = ["kind", "doc_id", "reason"]
        open_ = old.where("resolved_at is null").select(*(F.col(c).alias(f"__{c}") for c in same))
        new = items.distinct().join(open_, [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in same], "left_anti")
        new = self._numbered(new, "review_items", "item_id", "kind", "doc_id", "reason").withColumn("created_at", F.current_timestamp())
        self.put("review_items", old.unionByName(new, allowMissingColumns=True))

    def _entity(self, rows: DataFrame, key: str, ticker: str, at: str) -> DataFrame:
        dated = rows.withColumn("__day", P.market_date(F.coalesce(F.col(at), F.current_timestamp())))
        lists = self.table("listings").select(F.col("ticker").alias(ticker), "valid_from", "valid_to", F.col("entity_id").alias("__e"))
        return P.lookup_unique(dated, lists, [ticker], key, "__day", "valid_from", "valid_to", "__e", "entity_id").drop("__day")

    def detect(self, folder: str, senders: tuple[mail.Sender, ...] = mail.SENDERS) -> int:
        """Messages of a folder as detections; reading a folder again changes nothing."""
        found = mail.detections(files.read_mail_folder(self.spark, folder), senders)
        found = found.withColumn("key", D.detection_key(F.col("announcement"), F.col("source"), F.col("source_ref")))
        found = self._entity(found, "path", "ticker", "lodged_at").withColumn("__c", D.title_class(F.col("title"))).withColumn("doc_class", F.col("__c.doc_class")).withColumn("method", F.col("__c.method"))
        docs = self.table("documents")
        stored = docs.where("detection_key is not null").select(F.col("detection_key").alias("key"), F.col("ticker_as_lodged").alias("ticker"), "title", "entity_id", "doc_class", F.lit("rules").alias("method"), F.lit(True).alias("format_recognised"), "detected_at")
        _, reviews = D.record_detections(stored, found)
        first = found.withColumn("__nr", F.row_number().over(Window.partitionBy("key").orderBy("detected_at", "title"))).where("__nr = 1").join(stored.select("key"), "key", "left_anti")
        new = first.select(F.col("key").alias("detection_key"), "entity_id", F.col("ticker").alias("ticker_as_lodged"), "doc_class", "title", "lodged_at", F.when(F.col("lodged_at").isNotNull(), "alert").alias("lodged_at_source"), "detected_at", F.col("source").alias("detection_source"), F.col("announcement").alias("announcement_id"), "price_sensitive", "manual_open_urls", "document_urls", F.lit("detected").alias("parse_status"))
        from ..session import cut

        new, reviews = cut(self._numbered(new, "documents", "doc_id", "detection_key")), cut(reviews)
        n = new.count()
        self.put("documents", docs.unionByName(new, allowMissingColumns=True))
        self._review(reviews.select(F.lit("detection").alias("kind"), F.lit(None).cast("long").alias("doc_id"), F.lit(None).cast("string").alias("parser"), F.concat("reason", F.lit(": "), "key").alias("reason")))
        return n

    def ingest(self, folder: str) -> int:
        """Files of a folder as documents, each content once; those that answer a detection complete it."""
        drop = files.read_file_drop(self.spark, folder).withColumn("text", files.text_of(F.col("content")))
        docs = self.table("documents")
        new = D.ingest(docs.where("sha256 is not null").select("sha256"), drop, "content", "path").withColumn("__f", D.facts(F.coalesce("text", F.lit(""))))
        new = self._entity(new.withColumn("capture_id", F.xxhash64("sha256")), "capture_id", "ticker", "lodged_at")
        by_number = self.table("entities").select(F.explode(F.array_compact(F.array("acn", "arbn", "abn"))).alias("__n"), F.col("entity_id").alias("__by"))
        said = new.select("capture_id", F.explode(F.concat("__f.acns", "__f.abns")).alias("__n")).join(by_number, "__n").groupBy("capture_id").agg(F.min("__by").alias("__low"), F.max("__by").alias("__high"))
        new = new.join(said, "capture_id", "left").withColumn("entity_id", F.coalesce("entity_id", F.when(F.col("__low") == F.col("__high"), F.col("__low"))))
        new = new.withColumn("__t", D.title_class(F.col("title"))).withColumn("doc_class", F.coalesce("__f.doc_class", F.when(F.col("__t.method") == "rules", F.col("__t.doc_class")), F.lit("other")))
        open_ = docs.where("parse_status = 'detected'").select(F.col("doc_id").alias("detection_id"), F.col("announcement_id").alias("announcement"), F.col("detection_key").alias("key"), F.col("ticker_as_lodged").alias("ticker"), "lodged_at", "entity_id")
        captures = new.select("capture_id", "announcement", F.lit(None).cast("string").alias("key"), "ticker", "lodged_at", "entity_id")
        from ..session import cut

        matched = D.match_captures(captures, open_)
        # two files of one detection: the first stays with it
        once = Window.partitionBy("detection_id").orderBy("capture_id")
        matched = matched.withColumn("detection_id", F.when(F.row_number().over(once) == 1, F.col("detection_id")))
        new = cut(new.join(matched, "capture_id"))
        status = F.when(F.col("doc_class").isin(*self.parsers.doc_classes()), "unparsed").otherwise("not_applicable")
        fields = ["sha256", D.raw_path(F.col("sha256")).alias("storage_path"), F.col("text").alias("document_text"), F.when(F.col("text").isNotNull(), D.digest(F.col("text"))).alias("text_sha256"), F.current_timestamp().alias("fetched_at"), "doc_class", "entity_id", F.col("ticker").alias("ticker_as_lodged"), "title", "lodged_at", F.when(F.col("lodged_at").isNotNull(), "manual").alias("lodged_at_source"), F.col("announcement").alias("announcement_id"), status.alias("parse_status")]
        alone = self._numbered(new.where("detection_id is null").select(*fields), "documents", "doc_id", "sha256")
        answers = new.where("detection_id is not null").select(F.col("detection_id").alias("doc_id"), "sha256", D.raw_path(F.col("sha256")).alias("storage_path"), F.col("text").alias("document_text"), F.when(F.col("text").isNotNull(), D.digest(F.col("text"))).alias("text_sha256"), F.current_timestamp().alias("fetched_at"), "doc_class", "entity_id", status.alias("parse_status"))
        both = cut(alone.unionByName(answers, allowMissingColumns=True))
        self.upsert("documents", both)
        return both.count()

    capture = ingest

    def set_doc_url(self, doc_id: int, url: str) -> None:
        docs = self.table("documents")
        self.put("documents", docs.withColumn("document_urls", F.when(F.col("doc_id") == doc_id, F.array_union(F.coalesce("document_urls", F.array().cast("array<string>")), F.array(F.lit(url)))).otherwise(F.col("document_urls"))))

    def backfill(self, found: DataFrame) -> DataFrame:
        """Texts and dates of documents that lack them, from (sha256, text, made_at); outcomes counted."""
        docs = self.table("documents")
        out = D.backfill(docs.withColumnRenamed("document_text", "text"), found, "sha256")
        from ..session import cut

        out = cut(out.withColumn("text_sha256", F.coalesce("text_sha256", F.when(F.col("text").isNotNull(), D.digest(F.col("text"))))).withColumn("lodged_at_source", F.coalesce("lodged_at_source", F.when(F.col("lodged_at").isNotNull(), "file"))).withColumnRenamed("text", "document_text"))
        self.put("documents", out)
        return out.groupBy("outcome").count()

    def backfill_from(self, *folders: str) -> DataFrame:
        """``backfill`` with the texts and stated times of the files below some folders."""
        found = None
        for folder in folders:
            some = files.read_file_drop(self.spark, folder).select("sha256", files.text_of(F.col("content")).alias("text"), F.col("lodged_at").alias("made_at"))
            found = some if found is None else found.unionByName(some)
        return self.backfill(found)

    def worklist(self, most: int = 50) -> DataFrame:
        return D.worklist(self.table("documents").withColumnRenamed("doc_id", "detection_id"), most, sorted(self.parsers.doc_classes()))

    def spot_check(self, most: int = 10, seed: int = 0) -> DataFrame:
        return D.spot_check(self.table("trades").where("not superseded"), most, seed)

    # ------------------------------------------------------------ parse

    def _named_entities(self, docs: DataFrame) -> DataFrame:
        """Documents whose entity isn't known get it from the name they print."""
        name = T.company_norm(F.coalesce(D.facts(F.coalesce("document_text", F.lit("")))["entity_name"], F.lit("")))
        open_ = docs.where("entity_id is null").withColumn("name_norm", name)
        found = I.resolve(open_.select("name_norm").distinct(), self.table("entity_names").select("name_norm", "entity_id"), self.table("entity_aliases").select(F.col("alias_norm").alias("name_norm"), "entity_id"), "name_norm", "entity_id")
        named = open_.drop("entity_id").join(found.select("name_norm", "entity_id"), "name_norm", "left").select(*docs.columns)
        learned = I.learned_aliases(found, "name_norm", "entity_id").withColumnRenamed("name_norm", "alias_norm")
        self.upsert("entity_aliases", learned)
        return docs.where("entity_id is not null").unionByName(named)

    def parse(self, docs: DataFrame | None = None, apply: bool = True) -> DataFrame:
        """Each parser reads the waiting documents of its classes: readings, then accepted ones to trades and the others to review.  Counts by status."""
        statuses = [self._parse(parser, docs, apply) for parser in self.parsers]
        every = self.spark.createDataFrame([], "status string")
        for some in statuses:
            every = every.unionByName(some)
        return every.groupBy("status").count()

    def _parse(self, parser: Parser, docs: DataFrame | None, apply: bool) -> DataFrame:
        from ..session import cut

        every = self.table("documents")
        docs = every.where("parse_status = 'unparsed'") if docs is None else docs
        docs = cut(self._named_entities(docs.where(F.col("doc_class").isin(*parser.doc_classes))))
        read = parser.read(docs)
        stored = self.table("parsed_records").where((F.col("parser") == parser.name) & (F.col("version") == parser.version)).select("doc_id", F.col("payload").alias("__old"))
        read = read.join(stored, "doc_id", "left").withColumn("conflict", F.coalesce(F.col("__old") != F.col("payload"), F.lit(False)))
        stop = R.halted(self.table("review_items"), self.spark.createDataFrame([(parser.name,)], "parser string"), F.current_timestamp()).first()["halted"]
        done = cut(R.evaluate(read, F.col("conflict"), F.lit(stop)))
        records = self.table("parsed_records")
        new = done.where("__old is null").select("doc_id", F.lit(parser.name).alias("parser"), F.lit(parser.version).alias("version"), "payload", "errors", "warnings", "disagreements", "confidence", F.current_timestamp().alias("created_at"))
        self.put("parsed_records", records.unionByName(new))
        if apply:
            self._route(parser, done, docs)
        return done.select("status")

    def _route(self, parser: Parser, done: DataFrame, docs: DataFrame) -> None:
        from ..session import cut

        accepted = done.where("status = 'validated'").select("doc_id", "entity_id", "payload")
        rows = cut(parser.rows(accepted, docs, "auto"))
        kept = E.retract(self.table("trades"), done, "doc_id")
        self._put_trades(kept, rows)
        items = R.review_items(done, self.table("review_items").where("kind = 'extraction'"), "doc_id")
        self._review(items.select("kind", "doc_id", F.lit(parser.name).alias("parser"), "reason"))
        now = done.select("doc_id", F.col("status").alias("parse_status"), "entity_id")
        self.upsert("documents", now)

    def _put_trades(self, kept: DataFrame, new: DataFrame) -> None:
        """Trades after new rows, with persons, ids and supersession recomputed over all of them."""
        from ..session import cut

        people = cut(C.persons(new.select("person", "name_norm"), F.col("name_norm"), "person", self.table("persons")))
        self.upsert("persons", people)
        new = new.join(people.select("person_id", "name_norm"), "name_norm", "left").drop("name_norm")
        new = self._numbered(new, "trades", "trade_id", "doc_id", "person", "event_date", "security_class", "qty_acquired", "qty_disposed")
        every = kept.drop("superseded", "supersedes_doc").unionByName(new.select(*[c for c in kept.columns if c not in ("superseded", "supersedes_doc")]), allowMissingColumns=True)
        self.put("trades", E.supersede(every, ["entity_id", "person_id", "event_date", "security_class"], "doc_id", "knowable_at"))

    def reprocess(self, apply: bool = False) -> DataFrame:
        """Documents read again by the present parser, but for those a human settled; without ``apply`` readings only."""
        settled = self.table("review_items").where("resolution in ('accepted', 'corrected', 'rejected')").select("doc_id")
        old = self.spark.createDataFrame([], "doc_id long")
        for parser in self.parsers:
            records = self.table("parsed_records").where(F.col("parser") == parser.name)
            old = old.unionByName(R.reprocess_plan(records, parser.version, settled.where("doc_id is not null")).select("doc_id"))
        return self.parse(self.table("documents").join(old, "doc_id", "left_semi"), apply)

    def review_list(self, most: int = 50) -> DataFrame:
        return self.table("review_items").where("resolved_at is null").orderBy("created_at", "item_id").limit(most)

    def review_show(self, item_id: int) -> DataFrame:
        item = self.table("review_items").where(F.col("item_id") == item_id)
        return item.join(R.latest_versions(self.table("parsed_records"), ["doc_id", "parser"], "version").select("doc_id", "payload", "errors", "warnings"), "doc_id", "left")

    def review_resolve(self, item_id: int, decision: str, payload: str | None = None) -> None:
        """Settle an item: accepted and corrected readings go to trades, a rejected extraction is retracted."""
        if decision not in ("accepted", "corrected", "rejected"):
            raise ValueError(decision)
        from ..session import cut

        items = self.table("review_items")
        found = cut(R.resolve_items(items.where(F.col("item_id") == item_id), self.spark.createDataFrame([(item_id, decision)], "item_id long, decision string")))
        docs = self.table("documents").join(found.select("doc_id"), "doc_id", "left_semi")
        item = found.first()
        follow = item["follow_up"] if item else None
        parser = self.parsers[item["parser"]] if item and item["parser"] in self.parsers.parsers else next(iter(self.parsers))
        if follow == "apply" and not docs.isEmpty():
            records = R.latest_versions(self.table("parsed_records"), ["doc_id", "parser"], "version").select("doc_id", "payload")
            reading = docs.select("doc_id", "entity_id").join(records, "doc_id").withColumn("payload", F.lit(payload) if payload else F.col("payload"))
            rows = cut(parser.rows(reading, docs, f"human_{decision}"))
            self._put_trades(E.retract(self.table("trades"), docs, "doc_id"), rows)
            self.upsert("documents", docs.select("doc_id", F.lit("validated").alias("parse_status")))
        elif follow == "retract" and not docs.isEmpty():
            self._put_trades(E.retract(self.table("trades"), docs, "doc_id"), parser.rows(docs.select("doc_id", "entity_id", F.lit('{"notices":[]}').alias("payload")), docs, "auto"))
            self.upsert("documents", docs.select("doc_id", F.lit("rejected").alias("parse_status")))
        hit = F.col("item_id") == item_id
        self.put("review_items", items.withColumn("resolved_at", F.when(hit, F.current_timestamp()).otherwise(F.col("resolved_at"))).withColumn("resolution", F.when(hit, F.lit(decision)).otherwise(F.col("resolution"))))

    def uncorroborated(self) -> DataFrame:
        return R.uncorroborated(self.table("parsed_records"), self.table("documents"))

    # ------------------------------------------------------------ shares

    def shares_outstanding(self, as_of: dt.date | None = None, known: dt.datetime | None = None) -> DataFrame:
        anchors = self.table("share_anchors")
        return E.replay(anchors, self.table("share_events"), ["entity_id", "class_code"], F.lit(as_of) if as_of else None, F.lit(known) if known else None)

    def _replayed(self, asked: DataFrame) -> DataFrame:
        """entity_id, class_code, as_at, replayed: the replay of each class on each day that is asked of it, in one plan."""
        keys = ["entity_id", "class_code", "as_at"]
        asked = asked.select(*keys).distinct()
        anchors = self.table("share_anchors").join(asked, keys[:2]).where("anchor_date <= as_at")
        events = self.table("share_events").join(asked, keys[:2]).where("event_date <= as_at")
        return E.replay(anchors, events, keys).select(*keys, F.col("quantity").alias("replayed"))

    def reconciled_at(self, as_of: dt.date) -> DataFrame:
        """The replay on a day against the newest manual count by then; within_tolerance is null, not true, without one."""
        day = F.lit(as_of)
        classes = self.table("share_anchors").select("entity_id", "class_code").unionByName(self.table("share_events").select("entity_id", "class_code")).distinct()
        replayed = self._replayed(classes.withColumn("as_at", day)).drop("as_at")
        manual = P.as_of_constant(self.table("manual_share_counts"), ["entity_id", "class_code"], "as_at", day)
        manual = manual.select("entity_id", "class_code", F.col("as_at").alias("counted_at"), F.col("quantity").alias("external"))
        return Q.reconcile(classes.join(replayed, ["entity_id", "class_code"], "left").join(manual, ["entity_id", "class_code"], "left"), "replayed", "external")

    def reconcile(self) -> DataFrame:
        """Replayed against manual counts; verdicts are stored, the doubtful go to review."""
        from ..session import cut

        counts = self.table("manual_share_counts")
        out = counts.join(self._replayed(counts.select("entity_id", "class_code", "as_at")), ["entity_id", "class_code", "as_at"], "left")
        done = cut(Q.reconcile(out.withColumn("external", F.col("quantity")), "replayed", "external").withColumn("checked_at", F.current_timestamp()))
        self.upsert("share_reconciliations", done)
        self._review(done.where("needs_review").select(F.lit("reconciliation").alias("kind"), F.lit(None).cast("long").alias("doc_id"), F.lit(None).cast("string").alias("parser"), F.format_string("shares of %s %s at %s", F.col("entity_id"), F.col("class_code"), F.col("as_at").cast("string")).alias("reason")))
        return done

    # ------------------------------------------------------------ signals and reports

    def _members(self, rows: DataFrame, day: str) -> DataFrame:
        index = self.table("index_membership").where(F.col("index_code") == self.index_code)
        snaps = index.select("as_of", "knowable_at").distinct()
        return P.membership(rows, snaps, index.where("entity_id is not null").select("as_of", "entity_id").distinct(), "entity_id", day, STALE_DAYS)

    def build_signals(self) -> None:
        """Clusters and conviction buys of the present version, from accepted trades, rebuilt."""
        trades = self.table("trades").where(C.accepted())
        base = f"size_ceiling_proxy:{self.index_code}"
        found = E.clusters(trades, "entity_id", "event_date", "person_id", "trade_id", "consideration_aud", "knowable_at", WINDOW_DAYS, LEAST_PERSONS).withColumn("__day", F.to_date("knowable_at"))
        found = self._members(found, "__day").where("not coalesce(is_member, false)").withColumn("coverage_flags", C.coverage_flags(base, F.col("is_member"))).withColumn("signal_version", F.lit(SIGNAL_VERSION))
        self._rebuild("signal_cluster_buys", found)
        buys = self._members(trades.withColumn("__day", F.to_date("knowable_at")), "__day")
        self._rebuild("signal_conviction_buys", C.conviction(buys, "qty_acquired", "held_before", "consideration_aud", "is_member", base=base).withColumn("signal_version", F.lit(SIGNAL_VERSION)))

    def _rebuild(self, name: str, rows: DataFrame) -> None:
        old = self.table(name).where(F.col("signal_version") != SIGNAL_VERSION)
        self.put(name, old.unionByName(rows.select(*old.columns)))

    def signals(self, kind: str = "cluster") -> DataFrame:
        """A screen: who bought what and when it could be known."""
        codes = self.table("listings").where("valid_to is null").select("entity_id", "ticker")
        names = self.table("entity_names").where("valid_to is null").select("entity_id", F.col("name").alias("entity"))
        if kind == "conviction":
            rows = self.table("signal_conviction_buys").join(self.table("trades").select("trade_id", "price_per_unit"), "trade_id", "left")
            out = rows.join(codes, "entity_id", "left").join(names, "entity_id", "left").withColumn("stake_increase_pct", F.round(F.col("stake_increase") * 100, 1))
            return out.select("ticker", "entity", "person", "event_date", F.to_date("knowable_at").alias("actionable_from"), "consideration_aud", F.round("price_per_unit", 4).alias("price_paid"), "qty_acquired", "held_before", "stake_increase_pct", F.array_join("coverage_flags", "|").alias("coverage_flags"), "signal_version").orderBy(F.col("stake_increase_pct").desc(), "ticker")
        rows = self.table("signal_cluster_buys").withColumn("__key", F.struct("signal_version", "entity_id", "window_start"))
        out = C.screen(rows, self.table("trades").select("trade_id", "qty_acquired", "consideration_aud", "person"), "__key", "member_ids", "trade_id", "qty_acquired", "consideration_aud", "person").join(codes, "entity_id", "left").join(names, "entity_id", "left")
        flags = F.concat("coverage_flags", F.when(F.col("partial_price_coverage"), F.array(F.lit("partial_price_coverage"))).otherwise(F.array().cast("array<string>")))
        return out.select("ticker", "entity", F.col("people").alias("directors"), "n_persons", F.col("window_start").alias("first_buy"), F.col("window_end").alias("last_buy"), F.to_date("knowable_at").alias("actionable_from"), "total_amount", "total_shares", "avg_price", F.array_join(flags, "|").alias("coverage_flags"), "signal_version").orderBy(F.col("actionable_from").desc(), F.col("total_amount").desc())

    def universe(self, as_of: dt.date, most: float | None = None, top: int | None = None) -> DataFrame:
        out = S.universe(self.table("listings").withColumnRenamed("ticker", "code"), self.table("entity_names"), self.table("listing_snapshots").withColumnRenamed("ticker", "code"), self.table("entities"), "entity_id", "code", F.lit(as_of))
        return out.withColumn("label", S.size_label(F.col("market_cap"), F.col("cap_rank"), most, top)).orderBy("code")

    def coverage(self) -> DataFrame:
        """Listed entities without a number by hint in their names, with examples."""
        listed = self.table("entities").where("acn is null and arbn is null").join(self.table("listings").where("valid_to is null").select("entity_id", "ticker"), "entity_id").join(self.table("entity_names").where("valid_to is null").select("entity_id", "name"), "entity_id", "left")
        hint = F.when(F.col("name").rlike(r"(?i)\b(trust|fund|reit)\b"), "scheme or trust").when(F.col("name").rlike(r"(?i)\b(plc|inc|corp|sa|nv)\b"), "foreign form").otherwise("other")
        return Q.examples(listed, hint, "ticker")

    def number_coverage(self) -> DataFrame:
        """The share of listed entities with a company number or known to be foreign, and whether it suffices."""
        return Q.number_coverage(self.table("entities"), self.table("listings"), "entity_id")

    def collisions(self) -> DataFrame:
        """Codes that two entities hold at one time; there must be none."""
        return P.overlaps(self.table("listings"), ["exchange", "ticker", "security_class"], "entity_id", "valid_from", "valid_to")

    def monitor(self, now: dt.datetime | None = None) -> DataFrame:
        """All checks; leaves a row in monitor_runs whether or not there are alarms."""
        at = F.lit(now) if now else F.current_timestamp()
        docs, items, trades = self.table("documents"), self.table("review_items"), self.table("trades")
        parseable = docs.where(F.col("doc_class").isin(*self.parsers.doc_classes()))
        feeds = Q.feed_volume(self.table("feed_slos"), docs.withColumn("feed", F.col("doc_class")), "feed", "detected_at", at, "lodged_at")
        # identity items without a document never resolve; another check counts them
        queue = items.where(~((F.col("kind") == "resolution") & F.col("doc_id").isNull()))
        routed = (F.col("confidence") < R.ACCEPT) | (F.size("disagreements") > 0)
        drift = Q.two_periods(self.table("parsed_records"), "created_at", at, 30, 30, routed, ["parser"])
        drift = drift.withColumn("drift", Q.routing_drift(*(F.col(c) for c in ("recent_n", "recent_hit", "prior_n", "prior_hit"))))
        rates = Q.two_periods(trades.where("not superseded"), "knowable_at", at, 30, 180, F.col("classification") == C.CASH_BUY)
        rates = rates.withColumn("drift", Q.base_rate_drift(*(F.col(c) for c in ("recent_n", "recent_hit", "prior_n", "prior_hit"))))
        found = Q.alarms(
            ("volume", feeds, F.col("volume_alarm").isNotNull()),
            ("freshness", feeds, F.col("stale_alarm")),
            ("stuck_documents", Q.stuck(docs, "parse_status", "fetched_at", at), F.col("alarm")),
            ("capture_gap", Q.stuck(parseable, "parse_status", "detected_at", at, "detected", Q.CAPTURE_HOURS), F.col("alarm")),
            ("capture_rate", Q.capture_rate(parseable, F.col("parse_status") != "detected", "detected_at", at), F.col("alarm")),
            ("review_sla", Q.review_sla(queue, "created_at", at), F.col("alarm").isNotNull()),
            ("entity_identity", Q.identity_rate(self.table("entities"), self.table("listings"), "entity_id"), F.col("alarm")),
            ("parser_drift", drift, F.col("drift").isNotNull()),
            ("classification_base_rate", rates, F.col("drift").isNotNull()),
        )
        from ..session import cut

        found = cut(found)
        self.put("monitor_runs", self.table("monitor_runs").unionByName(Q.heartbeat(found, at)))
        return found

    def ops_report(self, now: dt.datetime | None = None) -> list[str]:
        """One page: alarms, documents of the week, status, queue, accept rates, reconciliations."""
        now = now or dt.datetime.now(dt.timezone.utc)
        week = F.lit(now - dt.timedelta(days=7))
        alarms = self.monitor(now).collect()
        docs = self.table("documents")
        lines = [f"operations report {now.date()}", f"ALARMS: {len(alarms)}", *(f"  [{a['check']}] {a['detail']}" for a in alarms)]
        for title, rows in (
            ("DOCUMENTS THIS WEEK", docs.where(F.col("fetched_at") >= week).groupBy(F.coalesce("doc_class", F.lit("(unclassified)")).alias("k")).agg(F.count("*").alias("n")).orderBy(F.col("n").desc(), "k")),
            ("PARSE STATUS", docs.groupBy(F.col("parse_status").alias("k")).agg(F.count("*").alias("n")).orderBy("k")),
            ("REVIEW QUEUE", self.table("review_items").where("resolved_at is null").agg(F.coalesce(F.min("created_at").cast("string"), F.lit("-")).alias("k"), F.count("*").alias("n"))),
            ("AUTO-ACCEPT", self.table("parsed_records").where(F.col("created_at") >= week).groupBy("parser").agg(F.count("*").alias("all"), F.count(F.when((F.col("confidence") >= R.ACCEPT) & (F.size("disagreements") == 0), 1)).alias("n")).select(F.concat("parser", F.lit(" of "), F.col("all").cast("string")).alias("k"), "n")),
            ("RECONCILIATIONS", self.table("share_reconciliations").where(F.col("checked_at") >= week).agg(F.count("*").cast("string").alias("k"), F.count(F.when(~F.col("within_tolerance"), 1)).alias("n"))),
        ):
            lines.append(f"{title}:")
            lines += [f"  {r['k']}  {r['n']}" for r in rows.collect()]
        return lines

    def backtest(self, prices: Callable | None = None) -> None:
        if prices is None:
            raise BacktestUnavailable("no price source")
        raise NotImplementedError

    def snapshot(self, path: str, form: str = "csv") -> DataFrame:
        """Every table with scalar columns as files, in the order of its key."""
        scalar = lambda df: df.select(*(F.to_json(c).alias(c) if t.startswith(("array", "struct")) else F.col(c).cast("string").alias(c) for c, t in df.dtypes))
        return state.export({n: (scalar(self.table(n)), KEYS[n]) for n in COLUMNS}, path, form)

    def restore(self, path: str, form: str = "csv") -> None:
        for name in COLUMNS:
            kind = schema(name)
            text = ", ".join(f"{f} string" for f in kind.names)
            from pyspark.sql.types import StructType

            rows = state.restore(self.spark, path, {name: StructType.fromDDL(text)}, form)[name]
            self.put(name, rows.select(*(F.from_json(f.name, f.dataType.simpleString()).alias(f.name) if f.dataType.simpleString().startswith(("array", "struct")) else F.col(f.name).cast(f.dataType).alias(f.name) for f in kind.fields)))
