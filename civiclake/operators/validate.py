"""Row validation with quarantine: a rule is a name, a condition that must hold, and a message."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civiclake.functions.scalars import safe_float


@dataclass(frozen=True)
class Rule:
    name: str
    holds: Column
    message: Column


def _required(name: str, *columns: str, have: set[str] | None = None) -> Rule:
    """One of ``columns`` is there and not blank; of those that ``have`` lacks none is."""
    given = [F.nullif(F.trim(F.col(c).cast("string")), F.lit("")) for c in columns if have is None or c in have]
    held = F.coalesce(F.lit(None).cast("string"), *given).isNotNull()
    return Rule(name, held, F.lit(f"missing {' or '.join(columns)}"))


def _numeric(column: str, least: float | None = None) -> list[Rule]:
    given, value = F.col(column).isNotNull(), safe_float(F.col(column))
    out = [Rule(f"{column}_numeric", ~given | value.isNotNull(), F.concat(F.lit(f"{column} is not a number: "), F.col(column).cast("string")))]
    if least is not None:
        out.append(Rule(f"{column}_range", ~given | value.isNull() | (value >= least), F.lit(f"{column} is below {least:g}")))
    return out


def within(column: str, low: Column | float, high: Column | float) -> Rule:
    value = safe_float(F.col(column))
    return Rule(f"{column}_between", F.col(column).isNull() | F.coalesce(value.between(low, high), F.lit(False)), F.lit(f"{column} is out of range"))


def rules_for(source: str, columns: list[str] | None = None, as_of: dt.date | None = None) -> list[Rule]:
    """The rule set of a source over its raw field names.

    With ``columns``, the fields that a table has, rules on others fall away and required fields among them are
    missing. ``as_of`` bounds building years to the next year.
    """
    have = None if columns is None else set(columns)
    there = lambda *cs: have is None or set(cs) <= have
    required = lambda name, *cs: _required(name, *cs, have=have)
    numeric = lambda c, least=None: _numeric(c, least) if there(c) else []
    within_ = lambda c, lo, hi: [within(c, lo, hi)] if there(c) else []
    fiscal = within_("FISCALYEAR", 1900, 2100)
    place = [*within_("LATITUDE", -90, 90), *within_("LONGITUDE", -180, 180)]
    next_year = F.lit(as_of.year + 1) if as_of else F.year(F.current_date()) + 1
    field = lambda c: F.col(c) if there(c) else F.lit(None).cast("string")
    sets = {
        "contracts": lambda: [required("agency", "AGENCY_NAME", "AGENCY"), *numeric("CONTRACTAMOUNT"), *fiscal],
        "payments": lambda: [*numeric("PAYMENTAMOUNT"), *fiscal],
        "purchase_orders": lambda: [required("agency", "AGENCY_NAME"), *numeric("POTOTAL"), *fiscal],
        "appraisals": lambda: [required("id", "SSL", "OBJECTID"), *(r for c in ("BATHRM", "BEDRM", "ROOMS", "STORIES", "GBA", "PRICE") for r in numeric(c, 0)), *within_("AYB", 1600, next_year)],
        "assessments": lambda: [required("id", "SSL", "OBJECTID"), *(r for c in ("ASSESSMENT", "LANDAREA", "NEWTOTAL", "NEWLAND", "NEWIMPR") for r in numeric(c, 0))],
        "sales": lambda: [required("id", "SSL", "OBJECTID"), *numeric("SALEPRICE", 0)],
        "lots": lambda: [required("id", "SSL", "OBJECTID"), *(r for c in ("RECORD_AREA", "COMPUTED_AREA", "SHAPEAREA") for r in numeric(c, 0))],
        "wards": lambda: [required("id", "OBJECTID", "NAME"), *within_("WARD", 1, 8)],
        "businesses": lambda: [required("id", "OBJECTID", "GIS_ID", "LICENSE_NUMBER", "SOLICITATION_NUMBER")],
        "housing": lambda: [required("id", "OBJECTID", "SSL", "PROJECT_NAME"), *numeric("UNITS", 0)],
        "locations": lambda: [Rule("place", field("SSL").isNotNull() | (field("LATITUDE").isNotNull() & field("LONGITUDE").isNotNull()), F.lit("missing SSL or coordinates")), *place],
        "market": lambda: [required("region", "region_name", "zip_code"), required("metric", "metric_name"), required("value", "metric_value"), *numeric("metric_value")],
        "demographics": lambda: [*(required(c, c) for c in ("region_name", "metric_name", "category", "metric_value")), *numeric("metric_value")],
        "listings": lambda: [required("id", "listing_id", "address"), *numeric("price", 0), *place],
        "rentals": lambda: [required("unit", "unit_number"), *numeric("price", 0), *within_("bedrooms", 0, 20)],
        "attachments": lambda: [required("contract", "contract_id"), Rule("text", F.coalesce(F.length(F.trim(field("text"))) >= 10, F.lit(False)), F.lit("too little text"))],
    }
    return sets[source]()


def validated(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """``df`` with validation_errors (all messages in rule order) and is_valid."""
    errors = F.array_compact(F.array(*(F.when(~r.holds, r.message) for r in rules)))
    return df.withColumn("validation_errors", errors).withColumn("is_valid", F.size("validation_errors") == 0)


def quarantined(rows: DataFrame, columns: list[str], source: str, error_type: str, message: Column) -> DataFrame:
    """Quarantine rows: an id (the hash of source and original, so equal originals share it), source, the original as JSON, kind and message of the error."""
    original = F.to_json(F.struct(*columns))
    return rows.select(F.lit(source).alias("source"), original.alias("original"), F.lit(error_type).alias("error_type"), message.alias("error_message")).withColumn(
        "quarantine_id", F.substring(F.sha2(F.concat_ws("|", "source", "original"), 256), 1, 32)
    )


def route(df: DataFrame, rules: list[Rule], source: str) -> tuple[DataFrame, DataFrame]:
    """Valid rows, and the quarantine rows of the others (the original as JSON)."""
    marked = validated(df, rules)
    bad = quarantined(marked.where("NOT is_valid"), df.columns, source, "validation_error", F.array_join("validation_errors", "; "))
    return marked.where("is_valid").drop("validation_errors", "is_valid"), bad


def quarantine_summary(quarantine: DataFrame) -> DataFrame:
    return quarantine.groupBy("source", F.coalesce("error_type", F.lit("unknown")).alias("error_type")).agg(F.count(F.lit(1)).alias("n"))


def requeue(quarantine: DataFrame, ids: DataFrame, schema: str) -> DataFrame:
    """The originals of chosen quarantine ids (column quarantine_id), as rows of ``schema``; equal originals come as often as they were quarantined."""
    return quarantine.join(ids.select("quarantine_id").distinct(), "quarantine_id", "left_semi").select(F.from_json("original", schema).alias("o")).select("o.*")


def pending(quarantine: DataFrame, requeued: DataFrame) -> DataFrame:
    """Quarantine rows whose ids were not requeued."""
    return quarantine.join(requeued.select("quarantine_id").distinct(), "quarantine_id", "left_anti")
