"""What this subpackage registers in ``__spark_entry__``."""

from __future__ import annotations

from . import chat_format, decontamination, html_extract, near_dedup, oracles, packing, quality_rules, secrets, suffix_dedup, token_output, toxicity

#: Name -> query over (spark, sf_dir).
QUERIES = {
    "op1_packing": packing.op1_packing,
    "op2_chat_format": chat_format.op2_chat_format,
    "op3_near_dedup": near_dedup.op3_near_dedup,
    "op4_secret_scan": secrets.op4_secret_scan,
    "op5_quality_rules": quality_rules.op5_quality_rules,
    "op6_token_output": token_output.op6_token_output,
    "op7_toxicity": toxicity.op7_toxicity,
    "op8_html_extract": html_extract.op8_html_extract,
    "op9_decontamination": decontamination.op9_decontamination,
    "op10_suffix_dedup": suffix_dedup.op10_suffix_dedup,
}

#: Name -> DuckDB SQL, where SQL can express the operator on whole tables.
ORACLES: dict[str, str] = dict(oracles.ORACLES)


def queries() -> dict:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
