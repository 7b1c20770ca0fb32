"""The platform's tables: schemas, keys and constraints."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

_Q, _M = "decimal(38,10)", "decimal(38,6)"

#: Table -> columns.
COLUMNS: dict[str, str] = {
    "entities": "entity_id long, acn string, abn string, entity_kind string, arbn string",
    "documents": "doc_id long, entity_id long, ticker_as_lodged string, doc_class string, title string, lodged_at timestamp, lodged_at_source string, fetched_at timestamp, detected_at timestamp, sha256 string, storage_path string, document_text string, text_sha256 string, detection_source string, detection_key string, announcement_id string, price_sensitive boolean, manual_open_urls array<string>, document_urls array<string>, parse_status string",
    "entity_names": "entity_id long, name string, name_norm string, name_kind string, valid_from date, valid_to date",
    "listings": "entity_id long, exchange string, ticker string, security_class string, valid_from date, valid_to date, source string",
    "universe_membership": "entity_id long, listed_from date, listed_to date, delist_reason string",
    "security_classes": "entity_id long, class_code string, valid_from date, valid_to date",
    "share_anchors": f"entity_id long, class_code string, anchor_date date, anchor_qty {_Q}, knowable_at timestamp, source_doc_id long, source_note string",
    "share_events": f"event_id long, entity_id long, class_code string, event_date date, knowable_at timestamp, kind string, ratio_num {_Q}, ratio_den {_Q}, qty_delta {_Q}, source_doc_id long",
    "share_reconciliations": f"entity_id long, class_code string, as_at date, replayed {_Q}, external {_Q}, rel_diff double, within_tolerance boolean, checked_at timestamp",
    "parsed_records": "doc_id long, parser string, version int, payload string, errors array<string>, warnings array<string>, disagreements array<string>, confidence decimal(12,1), created_at timestamp",
    "entity_aliases": "alias_norm string, entity_id long, method string, confidence double",
    "review_items": "item_id long, kind string, doc_id long, parser string, reason string, created_at timestamp, resolved_at timestamp, resolution string",
    "persons": "person_id long, name_norm string, display_name string, merged_into long",
    "trades": f"trade_id long, entity_id long, person_id long, person string, doc_id long, event_date date, event_date_basis string, event_dates_stated array<date>, knowable_at timestamp, security_class string, interest_nature string, qty_acquired {_M}, qty_disposed {_M}, consideration_text string, consideration_aud {_M}, price_per_unit {_M}, held_before {_M}, held_after {_M}, classification string, review_status string, superseded boolean, supersedes_doc long",
    "escrow_parcels": f"entity_id long, class_code string, quantity {_Q}, locked_from date, release_date date, knowable_at timestamp, source_doc_id long",
    "holder_snapshots": f"entity_id long, as_of date, rank int, holder string, quantity {_Q}, share double",
    "substantial_holdings": f"entity_id long, holder string, event_date date, knowable_at timestamp, quantity {_Q}, share double",
    "float_series": f"entity_id long, as_of date, float_shares {_Q}, coverage_flags array<string>",
    "signal_cluster_buys": f"signal_version int, entity_id long, window_start date, window_end date, n_persons long, total_amount {_M}, knowable_at timestamp, member_ids array<long>, coverage_flags array<string>",
    "signal_conviction_buys": f"signal_version int, entity_id long, trade_id long, person string, event_date date, knowable_at timestamp, consideration_aud {_M}, qty_acquired {_M}, held_before {_M}, stake_increase double, coverage_flags array<string>",
    "feed_slos": "feed string, window_days int, least int, stale_hours int",
    "monitor_runs": "ran_at timestamp, ok boolean, alarms array<struct<check:string,detail:string>>",
    "hypothesis_log": "id long, stated_at timestamp, hypothesis string, outcome string",
    "index_membership": "index_code string, ticker string, entity_id long, as_of date, knowable_at date",
    "manual_share_counts": f"entity_id long, class_code string, as_at date, quantity {_Q}, source_note string",
    "reference_loads": "load_id long, source string, as_at date, applied boolean",
    "reference_load_parts": "load_id long, part_no int, sha256 string",
    "registry": "number string, name string, name_norm string, is_current_name boolean, current_name_start_date date, status string, company_type string, company_class string, registration_date date, deregistration_date date, abn string",
    "listing_snapshots": "entity_id long, as_at date, ticker string, market_cap decimal(20,2), sector string, listing_date date",
}

#: Table -> key; an upsert replaces rows of the same key.
KEYS: dict[str, list[str]] = {
    "entities": ["entity_id"], "documents": ["doc_id"], "entity_names": ["entity_id", "name_norm", "valid_from"], "listings": ["entity_id", "exchange", "ticker", "security_class", "valid_from"], "universe_membership": ["entity_id", "listed_from"],
    "security_classes": ["entity_id", "class_code", "valid_from"], "share_anchors": ["entity_id", "class_code", "anchor_date"], "share_events": ["event_id"], "share_reconciliations": ["entity_id", "class_code", "as_at", "checked_at"], "parsed_records": ["doc_id", "parser", "version"],
    "entity_aliases": ["alias_norm", "entity_id"], "review_items": ["item_id"], "persons": ["person_id"], "trades": ["trade_id"], "escrow_parcels": ["entity_id", "class_code", "locked_from", "release_date"], "holder_snapshots": ["entity_id", "as_of", "holder"],
    "substantial_holdings": ["entity_id", "holder", "event_date"], "float_series": ["entity_id", "as_of"], "signal_cluster_buys": ["signal_version", "entity_id", "window_start"], "signal_conviction_buys": ["signal_version", "trade_id"], "feed_slos": ["feed"], "monitor_runs": ["ran_at"],
    "hypothesis_log": ["id"], "index_membership": ["index_code", "ticker", "as_of"], "manual_share_counts": ["entity_id", "class_code", "as_at"], "reference_loads": ["load_id"], "reference_load_parts": ["load_id", "part_no"], "registry": ["number", "name_norm"], "listing_snapshots": ["entity_id", "as_at", "ticker"],
}

STATUSES = ("detected", "unparsed", "validated", "review", "rejected", "not_applicable")
EVENT_KINDS = ("issue", "issue_proposed", "split", "consolidation", "bonus_issue", "buyback", "cancellation")
DATE_BASES = ("stated", "range_midpoint", "enumeration_midpoint")


def _same_null(a: str, b: str) -> Column:
    return F.col(a).isNull() == F.col(b).isNull()


def constraints() -> dict[str, dict[str, Column]]:
    """Table -> rule -> what must hold (null counts as broken where the rule says so)."""
    c = F.col
    return {
        "entities": {"one register at most": c("acn").isNull() | c("arbn").isNull()},
        "documents": {
            "status known": c("parse_status").isin(*STATUSES),
            "time and source together": _same_null("lodged_at", "lodged_at_source"),
            "text and checksum together": _same_null("document_text", "text_sha256"),
            "possession needs bytes or text": c("parse_status").isin("detected", "not_applicable") | c("sha256").isNotNull() | c("document_text").isNotNull(),
        },
        "share_anchors": {"provenance": c("source_doc_id").isNotNull() | (F.coalesce(c("source_note"), F.lit("")) != "")},
        "share_events": {
            "kind known": c("kind").isin(*EVENT_KINDS),
            "ratio or quantity": (c("ratio_num").isNotNull() & c("ratio_den").isNotNull()) != c("qty_delta").isNotNull(),
        },
        "trades": {
            "date basis known": c("event_date_basis").isin(*DATE_BASES),
            "an estimate has several dates": (c("event_date_basis") == "stated") | (F.size("event_dates_stated") > 1),
        },
    }


def schema(table: str) -> StructType:
    return StructType.fromDDL(COLUMNS[table])
