"""Readings: validation, scores, routing, versions, differences and the uncorroborated view."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut

# Fixed values.
ACCEPT = 0.9
LATE_DAYS = 8
UNVERIFIABLE = "arithmetic unverifiable:"


def score(n_errors: Column, n_disagreements: Column, n_warnings: Column) -> Column:
    """0 with errors; else 1, at most 0.5 with a disagreement, less 0.1 a warning, at least 0.  Decimal, so 0.9 is 0.9."""
    top = F.when(n_disagreements > 0, F.lit("0.5").cast("decimal(12,1)")).otherwise(F.lit("1.0").cast("decimal(12,1)"))
    left = (top - n_warnings.cast("decimal(10,0)") * F.lit("0.1").cast("decimal(2,1)")).cast("decimal(12,1)")
    return F.when(n_errors > 0, F.lit("0.0").cast("decimal(12,1)")).otherwise(F.greatest(left, F.lit("0.0").cast("decimal(12,1)")))


def route(n_errors: Column, n_disagreements: Column, confidence: Column, conflict: Column, halted: Column) -> Column:
    """validated or review."""
    return F.when((n_errors == 0) & (n_disagreements == 0) & ~conflict & ~halted & (confidence >= F.lit(str(ACCEPT)).cast("decimal(12,1)")), "validated").otherwise("review")


def halted(items: DataFrame, parsers: DataFrame, now: Column, days: int = 14) -> DataFrame:
    """parser, halted: whether an open item older than the limit names the parser or none; identity items without a document don't count."""
    old = items.where(F.col("resolved_at").isNull() & (F.col("created_at") < now - F.make_interval(days=F.lit(days))) & ~((F.col("kind") == "resolution") & F.col("doc_id").isNull()))
    flags = old.agg(F.max(F.col("parser").isNull().cast("int")).alias("__any"))  # one row
    mine = old.where("parser is not null").select("parser").distinct().withColumn("__mine", F.lit(True))
    return parsers.join(mine, "parser", "left").crossJoin(F.broadcast(flags)).select("parser", (F.coalesce("__mine", F.lit(False)) | (F.coalesce(F.col("__any"), F.lit(0)) == 1)).alias("halted"))


def validate_notices(rows: DataFrame, lodged_day: str, late_days: int = LATE_DAYS) -> DataFrame:
    """Findings of notices (director_name, date_of_change, is_final, securities array, lodged day): errors, warnings."""
    day = F.col("date_of_change")
    said = F.when(day.rlike(r"^\d{4}-\d{2}-\d{2}$"), F.to_date(F.try_to_timestamp(day, F.lit("yyyy-MM-dd"))))
    lodged = F.col(lodged_day)
    zero = F.lit(0).cast("decimal(38,6)")
    num = lambda x: x.cast("decimal(38,6)")
    sums = lambda s: num(s["held_before"]) + F.coalesce(num(s["qty_acquired"]), zero) - F.coalesce(num(s["qty_disposed"]), zero)
    both = lambda s: s["held_before"].isNotNull() & s["held_after"].isNotNull()
    sec = F.coalesce(F.col("securities"), F.array().cast(rows.schema["securities"].dataType))
    per = lambda f: F.array_compact(F.transform(sec, f))
    errors = F.concat(
        F.array_compact(F.array(
            F.when(F.coalesce(F.col("director_name"), F.lit("")) == "", "director_name missing"),
            F.when(F.size(sec) == 0, "no securities"),
            F.when(day.isNotNull() & said.isNull(), "date_of_change unparseable"),
            F.when(day.isNull() & ~F.col("is_final"), "date_of_change missing"),
            F.when(lodged.isNull(), "no lodgement time"),
            F.when(said > lodged, "date_of_change after lodgement"),
        )),
        per(lambda s: F.when((num(s["qty_acquired"]) < 0) | (num(s["qty_disposed"]) < 0), F.lit("negative quantity"))),
        per(lambda s: F.when(~F.col("is_final") & both(s) & (sums(s) != num(s["held_after"])), F.concat(F.lit("arithmetic: "), sums(s).cast("string"), F.lit(" != "), num(s["held_after"]).cast("string")))),
    )
    warnings = F.concat(
        F.array_compact(F.array(F.when((F.datediff(lodged, said) > late_days), "lodged late"))),
        per(lambda s: F.when(~F.col("is_final") & ~both(s), F.lit(f"{UNVERIFIABLE} held before/after missing"))),
    )
    out = rows.withColumn("errors", errors).withColumn("warnings", warnings)
    return out.withColumn("disagreements", F.filter("warnings", lambda w: w.startswith(UNVERIFIABLE)))


def evaluate(rows: DataFrame, conflict: Column | None = None, halt: Column | None = None) -> DataFrame:
    """Validated rows with confidence and status."""
    no = F.lit(False)
    out = rows.withColumn("confidence", score(F.size("errors"), F.size("disagreements"), F.size("warnings")))
    return out.withColumn("status", route(F.size("errors"), F.size("disagreements"), F.col("confidence"), conflict if conflict is not None else no, halt if halt is not None else no))


def review_items(evaluated: DataFrame, open_items: DataFrame, doc: str) -> DataFrame:
    """One new item for each document that goes to review and has no open one."""
    reasons = F.concat(F.col("errors"), F.transform("disagreements", lambda d: F.concat(F.lit("disagree:"), d)))
    said = F.when(F.size(reasons) > 0, F.substring(F.array_join(reasons, "; "), 1, 2000)).otherwise("below the bar or halted")
    return evaluated.where("status = 'review'").join(open_items.where("resolved_at is null").select(doc).distinct(), doc, "left_anti").select(doc, F.lit("extraction").alias("kind"), said.alias("reason"))


def latest_versions(records: DataFrame, keys: Sequence[str], version: str) -> DataFrame:
    nr = F.row_number().over(Window.partitionBy(*keys).orderBy(F.col(version).desc()))
    return records.withColumn("__nr", nr).where("__nr = 1").drop("__nr")


def prior_version(records: DataFrame, keys: Sequence[str], version: str, payload: str) -> DataFrame:
    """Each record with the payload of the version before it."""
    return records.withColumn("prior_payload", F.lag(payload).over(Window.partitionBy(*keys).orderBy(version)))


def leaves(rows: DataFrame, keys: Sequence[str], payload: str) -> DataFrame:
    """keys, path, value of every scalar in a JSON payload, through objects and arrays of any depth; array lengths are leaves too.

    The payload is parsed once; a level is read from what the level above left nested.
    """
    base = cut(rows.select(*keys, F.lit("$").alias("path"), F.parse_json(F.col(payload)).alias("v")))
    kind = F.schema_of_variant("v")
    nested = F.coalesce(kind.startswith("OBJECT") | kind.startswith("ARRAY"), F.lit(False))
    out = None
    while True:
        here = base.where(~nested).select(*keys, "path", F.col("v").cast("string").alias("value"))
        sized = base.where(kind.startswith("ARRAY")).select(*keys, F.concat("path", F.lit("[]")).alias("path"), F.size(F.col("v").cast("array<variant>")).cast("string").alias("value"))
        found = here.unionByName(sized)
        out = found if out is None else out.unionByName(found)
        inner = base.where(nested)
        if inner.isEmpty():
            return out
        base = cut(inner.lateralJoin(rows.sparkSession.tvf.variant_explode(F.col("v").outer())).select(*keys, F.concat(F.col("path"), F.coalesce(F.concat(F.lit("."), F.col("key")), F.concat(F.lit("["), F.col("pos").cast("string"), F.lit("]")))).alias("path"), F.col("value").alias("v")))


def same_scalar(a: Column, b: Column) -> Column:
    """Equal as numbers where both are ('1,000' is 1000), else without regard to case and outer space."""
    num = lambda x: F.regexp_replace(x, ",", "").try_cast("decimal(38,6)")
    text = lambda x: F.lower(F.trim(x))
    return F.coalesce(num(a) == num(b), text(a) == text(b), a.isNull() & b.isNull())


def payload_diff(a: DataFrame, b: DataFrame, keys: Sequence[str], payload: str) -> DataFrame:
    """keys, path and both values wherever two payloads differ; arrays of unequal length are one difference."""
    left = leaves(a, keys, payload).withColumnRenamed("value", "value_a").withColumn("__a", F.lit(1))
    right = leaves(b, keys, payload).withColumnRenamed("value", "value_b").withColumn("__b", F.lit(1))
    both = left.join(right, [*keys, "path"], "full_outer").where(~F.coalesce(same_scalar(F.col("value_a"), F.col("value_b")), F.lit(False)))
    sized = both.where(F.col("path").endswith("[]")).select(*keys, F.expr("left(path, length(path) - 2)").alias("__stop"))
    inside = both.where(~F.col("path").endswith("[]")).join(sized, list(keys), "left").withColumn("__in", F.coalesce(F.col("path").startswith(F.concat(F.col("__stop"), F.lit("["))), F.lit(False)))
    rest = inside.groupBy(*keys, "path", "value_a", "value_b").agg(F.max("__in").alias("__in")).where("not __in").drop("__in")
    return rest.unionByName(both.where(F.col("path").endswith("[]")).select(*keys, "path", "value_a", "value_b"))


def uncorroborated(records: DataFrame, documents: DataFrame) -> DataFrame:
    """Readings under review that say enough to look at: one row for each notice and security, with why.

    ``records``: doc_id, parser, version, payload (JSON with notices and securities), errors,
    warnings, disagreements, confidence; the newest version of each counts.
    """
    notice = "struct<director_name:string,date_of_change:string,interest_nature:string,indirect_detail:string,securities:array<struct<security_class:string,qty_acquired:string,qty_disposed:string,consideration_text:string,consideration_aud:string>>>"
    newest = latest_versions(records, ["doc_id", "parser"], "version")
    findings = F.array_sort(F.array_union(F.array_union("errors", "warnings"), "disagreements"))
    rows = newest.withColumn("__n", F.explode(F.from_json("payload", f"struct<notices:array<{notice}>>")["notices"])).withColumn("__s", F.explode("__n.securities")).withColumn("__f", findings)
    rows = rows.join(documents.where("parse_status = 'review' and entity_id is not null and lodged_at is not null").select("doc_id", "entity_id", "lodged_at"), "doc_id")
    shape = r"^-?[0-9]+(\.[0-9]+)?$"
    rows = rows.where(F.col("__n.date_of_change").rlike(r"^\d{4}-\d{2}-\d{2}$") & (F.coalesce(F.col("__s.qty_acquired").rlike(shape), F.lit(False)) | F.coalesce(F.col("__s.qty_disposed").rlike(shape), F.lit(False))))
    num = lambda c: F.when(F.col(c).rlike(shape), F.col(c).try_cast("decimal(38,6)"))
    return rows.select(
        "doc_id", "entity_id", "parser", "version", F.col("__n.director_name").alias("person"), F.to_date(F.try_to_timestamp(F.col("__n.date_of_change"), F.lit("yyyy-MM-dd"))).alias("event_date"), F.col("lodged_at").alias("knowable_at"),
        F.col("__s.security_class").alias("security_class"), num("__s.qty_acquired").alias("qty_acquired"), num("__s.qty_disposed").alias("qty_disposed"), num("__s.consideration_aud").alias("amount"),
        F.when(F.exists("__f", lambda f: f.contains("arithmetic: ")), "contradicted").otherwise("unverified").alias("corroboration"),
        F.when(F.size("__f") > 0, F.col("__f")).otherwise(F.array(F.lit("routed to review with no validator finding recorded"))).alias("because"),
    )


def lifecycle(events: DataFrame, doc: str, at: str, status: str) -> DataFrame:
    """The present status of each document from its log; a terminal status stays."""
    order = Window.partitionBy(doc).orderBy(F.col(status).isin("rejected", "not_applicable").desc(), F.col(at).desc())
    return events.withColumn("__nr", F.row_number().over(order)).where("__nr = 1").select(doc, status)


def reprocess_plan(records: DataFrame, current: int, resolved: DataFrame, doc: str = "doc_id") -> DataFrame:
    """Newest stored version of each document below the current one, unless a human has settled it."""
    newest = latest_versions(records, [doc, "parser"], "version").where(F.col("version") < current)
    return newest.join(resolved.select(doc).distinct(), doc, "left_anti")


def resolve_items(items: DataFrame, decisions: DataFrame, item: str = "item_id") -> DataFrame:
    """Items with decisions (accepted, corrected, rejected) and what follows: apply, or retract extractions."""
    out = items.join(decisions, item, "left")
    follows = F.when(F.col("decision").isin("accepted", "corrected"), "apply").when((F.col("decision") == "rejected") & (F.col("kind") == "extraction"), "retract")
    return out.withColumn("follow_up", follows)
