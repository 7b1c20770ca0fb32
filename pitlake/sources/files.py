"""File sources: delimiter-sniffed and preamble CSV, XML, file drops with sidecars, mail folders; CSV sinks."""

from __future__ import annotations

import csv
import io
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import any_date, company_number, company_norm, digits

# Accepted spellings of each column.
REGISTRY_COLUMNS: dict[str, tuple[str, ...]] = {
    "number": ("acn", "company acn", "acn/arbn", "abn/acn"),
    "name": ("company name", "name", "entity name"),
    "current_name_indicator": ("current name indicator", "current name ind", "current_name_indicator"),
    "current_name_start_date": ("current name start date", "name start date", "date of name change"),
    "status": ("status", "company status"),
    "company_type": ("type", "company type"),
    "company_class": ("class", "company class"),
    "registration_date": ("date of registration", "registration date", "date registered"),
    "deregistration_date": ("date of deregistration", "deregistration date"),
    "abn": ("abn",),
}
LISTING_COLUMNS: dict[str, tuple[str, ...]] = {
    "ticker": ("asx code", "code", "ticker", "security code"),
    "name": ("company name", "name", "issuer name", "entity name"),
    "sector": ("gics industry group", "sector", "gics sector", "industry group"),
    "listing_date": ("listing date", "date of listing", "listed date"),
    "market_cap": ("market cap", "market capitalisation", "market capitalization"),
}
HOLDING_COLUMNS: dict[str, tuple[str, ...]] = {"ticker": ("ticker", "code", "asx code", "security code"), "name": ("name", "security name", "company")}


class HeaderError(ValueError):
    """A file without the columns it must have."""


def _head(spark: SparkSession, paths: Sequence[str], lines: int) -> list[str]:
    """The first lines of the first file; a bounded look that settles the format."""
    return [r[0].lstrip("﻿") for r in spark.read.text(paths[0]).limit(lines).collect()]


def sniff(line: str) -> str:
    """The delimiter that the line has most of."""
    return max(("|", "\t", ","), key=line.count)


def find_columns(names: Sequence[str], spellings: dict[str, tuple[str, ...]], required: Sequence[str]) -> dict[str, int] | None:
    low = [n.strip().strip('"').lower() for n in names]
    found = {field: next((low.index(s) for s in some if s in low), None) for field, some in spellings.items()}
    return None if any(found.get(r) is None for r in required) else {k: v for k, v in found.items() if v is not None}


def _cells(spark: SparkSession, paths: Sequence[str], sep: str, width: int, skip: int = 0) -> DataFrame:
    """Rows as c0, c1, ... of all parts as one DataFrame; the header line of every part goes by its content."""
    schema = ", ".join(f"c{i} string" for i in range(width))
    return spark.read.schema(schema).csv(list(paths), sep=sep, header=False, multiLine=False, mode="PERMISSIVE", ignoreLeadingWhiteSpace=True, ignoreTrailingWhiteSpace=True)


def _take(cells: DataFrame, columns: dict[str, int], header: Sequence[str], spellings: dict[str, tuple[str, ...]]) -> DataFrame:
    blank = lambda c: F.when(F.trim(c) != "", F.trim(c))
    first = min(columns.values())
    rows = cells.where(~F.lower(F.trim(F.coalesce(F.col(f"c{first}"), F.lit("")))).eqNullSafe(header[first].strip().strip('"').lower()))
    return rows.select(*((blank(F.col(f"c{columns[f]}")) if f in columns else F.lit(None).cast("string")).alias(f) for f in spellings))


def read_registry(spark: SparkSession, *paths: str) -> DataFrame:
    """A company register in one or more parts; columns by name, rows without number or name left out.

    A blank indicator is a former name.
    """
    header = _head(spark, paths, 1)
    if not header:
        raise HeaderError("empty file")
    sep = sniff(header[0])
    names = next(csv.reader(io.StringIO(header[0]), delimiter=sep))
    columns = find_columns(names, REGISTRY_COLUMNS, ("number", "name"))
    if columns is None:
        raise HeaderError(f"no number and name column among {names}")
    rows = _take(_cells(spark, paths, sep, len(names)), columns, names, REGISTRY_COLUMNS)
    out = rows.withColumn("number", company_number(F.col("number"))).where("number is not null and name is not null")
    for c in ("current_name_start_date", "registration_date", "deregistration_date"):
        out = out.withColumn(c, any_date(F.col(c)))
    return out.withColumn("is_current_name", F.upper(F.coalesce("current_name_indicator", F.lit(""))) == "Y").drop("current_name_indicator").withColumn("abn", F.nullif(F.regexp_replace("abn", " ", ""), F.lit(""))).withColumn("name_norm", company_norm(F.col("name")))


def _after_preamble(spark: SparkSession, path: str, spellings: dict, required: Sequence[str], look: int = 100) -> DataFrame:
    for line in _head(spark, [path], look):
        names = next(csv.reader(io.StringIO(line)), [])
        columns = find_columns(names, spellings, required)
        if columns:
            cells = _cells(spark, [path], ",", len(names))
            table = cells.where(F.size(F.array_compact(F.array(*cells.columns))) > 1)  # preamble lines have one cell
            rows = _take(table, columns, names, spellings)
            return rows.where(" and ".join(f"{c} is not null" for c in required))
    raise HeaderError(f"no line with the columns {list(required)} among the first {look}")


def read_listings(spark: SparkSession, path: str) -> DataFrame:
    """A listed-companies file after its preamble; '--' for a capitalisation is null, not zero."""
    rows = _after_preamble(spark, path, LISTING_COLUMNS, ("ticker", "name"))
    cap = F.regexp_replace("market_cap", "[,$]", "").try_cast("decimal(20,2)")
    return rows.withColumn("ticker", F.upper("ticker")).withColumn("listing_date", any_date(F.col("listing_date"), ("d/M/yyyy", "yyyy-MM-dd", "d-M-yyyy"))).withColumn("market_cap", cap)


def read_holdings(spark: SparkSession, path: str) -> DataFrame:
    """A fund's holdings after its preamble: the leading code of the ticker cell."""
    rows = _after_preamble(spark, path, HOLDING_COLUMNS, ("ticker",))
    return rows.withColumn("ticker", F.regexp_extract(F.upper("ticker"), r"^\s*([A-Z0-9]{2,6})\b", 1)).where("ticker != ''").dropDuplicates(["ticker"])


def read_business_numbers(spark: SparkSession, path: str, row_tag: str, number: Sequence[str], company: Sequence[str]) -> DataFrame:
    """A bulk XML extract as (number, company): the first path that has each; eleven digits only."""
    rows = spark.read.format("xml").option("rowTag", row_tag).option("inferSchema", "false").load(path)

    def first(paths: Sequence[str]) -> Column:
        have = [F.col(p).cast("string") for p in paths if _has(rows, p)]
        return F.coalesce(*have) if have else F.lit(None).cast("string")

    return rows.select(digits(first(number)).alias("number"), company_number(first(company)).alias("company")).where("length(number) = 11")


def _has(df: DataFrame, path: str) -> bool:
    kind = df.schema
    for name in path.split("."):
        names = getattr(kind, "names", None)
        if not names or name not in names:
            return False
        kind = kind[name].dataType
    return True


def read_file_drop(spark: SparkSession, path: str, zone: str = "Australia/Sydney") -> DataFrame:
    """Files below a folder with what their optional '<name>.meta.json' says; a time without a zone is the market's."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).where(~F.col("path").endswith(".meta.json"))
    meta = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.meta.json").load(path)
    said = meta.select(F.regexp_replace("path", r"\.meta\.json$", "").alias("path"), F.from_json(F.col("content").cast("string"), "ticker string, title string, lodged_at string, announcement string").alias("m"))
    at = F.col("m.lodged_at")
    when = F.when(at.rlike(r"(Z|[+-]\d{2}:?\d{2})$"), at.try_cast("timestamp")).otherwise(F.to_utc_timestamp(at.try_cast("timestamp"), zone))
    return files.join(said, "path", "left").select("path", "content", F.sha2("content", 256).alias("sha256"), "m.ticker", "m.title", when.alias("lodged_at"), "m.announcement")


def read_mail_folder(spark: SparkSession, path: str) -> DataFrame:
    """Saved messages (path, content).  A folder with files but no message is an error, not an empty result."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).where(~F.upper(F.element_at(F.split("path", "/"), -1)).startswith("README"))
    mail = files.where(F.col("path").rlike(r"(?i)\.(eml|txt|msg)(\.gz)?$"))
    if mail.isEmpty() and not files.isEmpty():
        raise ValueError(f"files but no messages in {path}")
    return mail.select("path", "content")


def text_of(content: Column) -> Column:
    """The text of a file that isn't a PDF, undecodable bytes replaced; null for a PDF."""
    return F.when(F.substring(content, 1, 5) == F.lit(b"%PDF-"), None).otherwise(F.decode(content, "UTF-8"))


def write_csv(df: DataFrame, path: str, order: Sequence[str] = (), single: bool = True) -> None:
    """A report as CSV: ordered (as it comes without ``order``), with a header, null as nothing.  ``single`` is for reports; large tables keep their parts."""
    rows = df.orderBy(*order) if order else df
    (rows.coalesce(1) if single else rows).write.mode("overwrite").csv(path, header=True, nullValue="", emptyValue="")


def write_raw(df: DataFrame, path: str, content: str) -> None:
    """Bytes by their digest, below its first characters; what is there already isn't written again."""
    rows = df.withColumn("sha256", F.sha2(F.col(content), 256)).withColumn("prefix", F.substring("sha256", 1, 2)).dropDuplicates(["sha256"])
    try:
        have = df.sparkSession.read.parquet(path).select("sha256")
        rows = rows.join(have, "sha256", "left_anti")
    except Exception as e:  # nothing stored yet
        if "PATH_NOT_FOUND" not in str(e) and "UNABLE_TO_INFER_SCHEMA" not in str(e):
            raise
    rows.write.mode("append").partitionBy("prefix").parquet(path)
