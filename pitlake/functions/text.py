"""Names, dates and amounts in text, as Spark columns where Spark has the means."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import StringType

# Company suffixes that a normalised name loses at its end.
SUFFIXES = ("LIMITED", "LTD", "PTY", "PROPRIETARY", "NL", "INC", "HOLDINGS")

_MARKS = r"[\p{M}]"


@pandas_udf(StringType())
def _decomposed(names: pd.Series) -> pd.Series:
    return names.map(lambda s: None if s is None else unicodedata.normalize("NFKD", s))


def fold(name: Column, unicode: bool = True) -> Column:
    """Upper case without accents; punctuation and runs of space are one space.

    Spark has no compatibility decomposition, so names that aren't ASCII pass through Arrow;
    ``unicode=False`` leaves that out for names known to be ASCII.  Apply it to distinct names.
    """
    plain = F.regexp_replace(_decomposed(name), _MARKS, "") if unicode else name
    return F.trim(F.regexp_replace(F.regexp_replace(F.upper(plain), r"(?U)[^\w\s]", " "), r"(?U)\s+", " "))


def company_norm(name: Column, unicode: bool = True) -> Column:
    """``fold`` without trailing company suffixes; a name never becomes empty by that."""
    return F.regexp_replace(fold(name, unicode), rf"(?<=\S)(?:\s(?:{'|'.join(SUFFIXES)}))+$", "")


def person_norm(name: Column, unicode: bool = True) -> Column:
    return fold(name, unicode)


def listed_variants(name: Column) -> Column:
    """The name, and with a trailing '(THE)' moved to the front."""
    trimmed = F.trim(name)
    moved = F.concat(F.lit("THE "), F.trim(F.regexp_replace(trimmed, r"(?i)\(the\)$", "")))
    return F.when(F.upper(trimmed).endswith("(THE)"), F.array(name, moved)).otherwise(F.array(name))


def digits(text: Column) -> Column:
    return F.regexp_replace(text, r"\D", "")


def company_number(text: Column) -> Column:
    """Nine digits, filled with zeros; null if there are none or more than nine."""
    d = digits(text)
    return F.when(F.length(d).between(1, 9), F.lpad(d, 9, "0"))


def any_date(text: Column, formats: tuple[str, ...] = ("d/M/yyyy", "d-M-yyyy", "yyyy-MM-dd", "ddMMyyyy", "yyyyMMdd")) -> Column:
    """The date by the first format that reads it; null if none does."""
    said = F.trim(text)
    shape = {"d/M/yyyy": r"^\d{1,2}/\d{1,2}/\d{4}$", "d-M-yyyy": r"^\d{1,2}-\d{1,2}-\d{4}$", "yyyy-MM-dd": r"^\d{4}-\d{2}-\d{2}$", "ddMMyyyy": r"^\d{8}$", "yyyyMMdd": r"^\d{8}$"}
    return F.coalesce(*(F.when(said.rlike(shape[f]), F.to_date(F.try_to_timestamp(said, F.lit(f)))) if f in shape else F.to_date(F.try_to_timestamp(said, F.lit(f))) for f in formats))


def number(text: Column, kind: str = "decimal(38,6)") -> Column:
    """A number only where the text is one and nothing else."""
    return F.when(text.rlike(r"^-?[0-9]+(\.[0-9]+)?$"), text.try_cast(kind))


def money(text: Column) -> Column:
    """The first dollar amount that isn't a price for one share; null without one."""
    return F.regexp_replace(F.regexp_extract(text, r"(?i)\$\s*(\d{1,3}(?:,\d{3})+(?:\.\d+)?|\d+(?:\.\d+)?)(?![\d,]|\.\d)(?!\s*(?:per|/)\s*(?:share|security|unit))", 1), ",", "").try_cast("decimal(18,2)")


def quantity(text: Column) -> Column:
    """The first plain quantity: grouped digits or at least four, else a lone short number."""
    grouped = F.regexp_extract(text, r"\b(\d{1,3}(?:,\d{3})+|\d{4,})\b", 1)
    short = F.regexp_extract(text, r"(?<![\d,.])(\d{1,3})(?![\d,.])", 1)
    return F.coalesce(F.regexp_replace(grouped, ",", "").try_cast("long"), short.try_cast("long"))


def dates_stated(text: Column) -> Column:
    """All distinct dates written d/m/yyyy or with a month's name, ascending."""
    slashed = F.transform(F.regexp_extract_all(text, F.lit(r"\b(\d{1,2}/\d{1,2}/\d{4})\b"), 1), lambda d: F.to_date(F.try_to_timestamp(d, F.lit("d/M/yyyy"))))
    named = F.transform(F.regexp_extract_all(text, F.lit(r"\b(\d{1,2} (?:Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Oct|Nov|Dec)[a-z]* \d{4})\b"), 1), lambda d: F.to_date(F.try_to_timestamp(F.regexp_replace(d, r" ([A-Z][a-z]{2})[a-z]* ", " $1 "), F.lit("d MMM yyyy"))))
    return F.array_sort(F.array_distinct(F.array_compact(F.concat(slashed, named))))


def midpoint(first: Column, last: Column) -> Column:
    return F.date_add(first, F.floor(F.datediff(last, first) / 2).cast("int"))


def url_host(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, r"(?i)^https?://([^/:?#]+)", 1))


def written_at(text: Column, zone: str = "Australia/Sydney") -> Column:
    """A file's own time stamp 'D:yyyyMMddHHmmss+hh'mm'' in UTC; without an offset null, as ten hours are a day."""
    m = r"^D:(\d{14})(?:Z(?:00'?00'?)?|([+-])(\d{2})'?(\d{2})'?)"
    stamp = F.try_to_timestamp(F.regexp_extract(text, m, 1), F.lit("yyyyMMddHHmmss"))
    sign = F.when(F.regexp_extract(text, m, 2) == "-", -1).otherwise(1)
    part = lambda k: F.coalesce(F.regexp_extract(text, m, k).try_cast("int"), F.lit(0))
    return F.when(text.rlike(m), F.timestamp_seconds(F.unix_timestamp(stamp) - sign * (part(3) * 3600 + part(4) * 60)))
