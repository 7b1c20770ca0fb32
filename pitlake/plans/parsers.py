"""Parsers: what reads documents of some classes, and which classes count as parseable.

A class is parseable only if a registered parser reads it; anything else would leave documents
waiting for good and keep the alarm for stuck documents ringing.
"""

from __future__ import annotations

from collections.abc import Iterable
from typing import Protocol, runtime_checkable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import forms
from ..functions import text as T
from ..operators import documents as D
from ..operators import review as R
from ..operators import temporal as P
from ..operators import trades as C


@runtime_checkable
class Parser(Protocol):
    """One reader of documents; its version goes up when its readings change."""

    name: str
    version: int
    doc_classes: tuple[str, ...]

    def read(self, docs: DataFrame) -> DataFrame:
        """doc_id, entity_id, doc_class, payload (JSON), errors, warnings, disagreements: a row for each document."""
        ...

    def rows(self, accepted: DataFrame, docs: DataFrame, status: str) -> DataFrame:
        """The trades of accepted readings (doc_id, entity_id, payload); none is a table without rows."""
        ...


class Registry:
    """Parsers by name; no two read one class."""

    def __init__(self, parsers: Iterable[Parser] = ()):
        self.parsers: dict[str, Parser] = {}
        for parser in parsers:
            self.register(parser)

    def register(self, parser: Parser) -> None:
        if not isinstance(parser, Parser):
            raise TypeError(f"{parser!r} isn't a parser")
        if parser.name in self.parsers:
            raise ValueError(f"two parsers are named {parser.name}")
        if taken := self.doc_classes() & set(parser.doc_classes):
            raise ValueError(f"{sorted(taken)} have a parser already")
        self.parsers[parser.name] = parser

    def doc_classes(self) -> set[str]:
        return {c for p in self.parsers.values() for c in p.doc_classes}

    def __iter__(self):
        return iter(self.parsers.values())

    def __getitem__(self, name: str) -> Parser:
        return self.parsers[name]


class InterestNotices:
    """Notices of directors' interests."""

    name, version, doc_classes = "interest_notice", 1, D.PARSEABLE

    def read(self, docs: DataFrame) -> DataFrame:
        """One row for each document: payload, findings, confidence."""
        notices = forms.extract_notices(docs.select("doc_id", F.col("document_text").alias("text"))).where("not scrambled")
        sec = F.struct("security_class", "qty_acquired", "qty_disposed", "consideration_text", "consideration_aud", "held_before", "held_after")
        rows = notices.join(docs.select("doc_id", "doc_class", "lodged_at"), "doc_id").withColumn("is_final", F.col("doc_class") == "app_3z").withColumn("securities", F.array(sec)).withColumn("date_of_change", F.col("date_of_change").cast("string")).withColumn("lodged", P.market_date(F.col("lodged_at")))
        checked = R.validate_notices(rows, "lodged")
        notice = F.struct("form_nr", "director_name", "date_of_change", "date_basis", "dates_stated", "interest_nature", "indirect_detail", "securities")
        flat = lambda c: F.flatten(F.collect_list(c))
        per = checked.groupBy("doc_id").agg(F.to_json(F.struct(F.max("entity_name").alias("company_name"), F.sort_array(F.collect_list(notice)).alias("notices"))).alias("payload"), flat("errors").alias("errors"), flat("warnings").alias("warnings"), flat("disagreements").alias("disagreements"))
        out = docs.select("doc_id", "entity_id", "doc_class").join(per, "doc_id", "left")
        none = F.array().cast("array<string>")
        errors = F.concat(F.coalesce("errors", F.array(F.lit("no notices"))), F.when(F.col("entity_id").isNull(), F.array(F.lit("entity not resolved"))).otherwise(none))
        return out.withColumn("errors", errors).withColumn("warnings", F.coalesce("warnings", none)).withColumn("disagreements", F.coalesce("disagreements", none)).withColumn("payload", F.coalesce("payload", F.lit('{"notices":[]}')))

    def rows(self, accepted: DataFrame, docs: DataFrame, status: str) -> DataFrame:
        sec = "struct<security_class:string,qty_acquired:decimal(38,6),qty_disposed:decimal(38,6),consideration_text:string,consideration_aud:decimal(38,6),held_before:decimal(38,6),held_after:decimal(38,6)>"
        kind = f"struct<notices:array<struct<director_name:string,date_of_change:date,date_basis:string,dates_stated:array<date>,interest_nature:string,securities:array<{sec}>>>>"
        rows = accepted.withColumn("n", F.explode(F.from_json("payload", kind)["notices"])).withColumn("s", F.explode("n.securities")).join(docs.select("doc_id", F.col("lodged_at").alias("knowable_at")), "doc_id")
        rows = rows.select("doc_id", "entity_id", "knowable_at", F.col("n.director_name").alias("person"), F.col("n.date_of_change").alias("event_date"), F.coalesce("n.date_basis", F.lit("stated")).alias("event_date_basis"), F.col("n.dates_stated").alias("event_dates_stated"), F.col("n.interest_nature").alias("interest_nature"), "s.*")
        rows = rows.where("event_date is not null").withColumn("classification", C.classify(F.col("consideration_text"), F.col("qty_acquired"), F.col("qty_disposed"), F.col("consideration_aud"))).withColumn("price_per_unit", C.unit_price(F.col("consideration_aud"), F.col("qty_acquired"), F.col("qty_disposed")).cast("decimal(38,6)"))
        return rows.withColumn("name_norm", T.person_norm(F.col("person"))).withColumn("review_status", F.lit(status))
