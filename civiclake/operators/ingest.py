"""Raw API rows to canonical records: alias mapping, casts, derived values, lineage. Sources are named; adding one is adding an entry."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from civiclake.functions.scalars import (
    bathrooms, clean_phone, clean_zip, code_list, composite_id, entity_id, extras, fiscal_year_text, is_local_zip, lot_address, lot_area, price_reduced, record_hash, safe_bool, safe_date, safe_decimal, safe_float, safe_int, safe_string, state_of_zip, structure_type, use_code_type, ward, zip_plus_four,
)
from civiclake.operators.validate import quarantined, route, rules_for
from civiclake.sources.io import dealt

CAST = {"string": safe_string, "int": safe_int, "float": safe_float, "money": safe_decimal, "date": safe_date, "zip": clean_zip, "phone": clean_phone, "bool": safe_bool, "codes": code_list, "fiscal": fiscal_year_text, "ward": ward}
SCHEMA_VERSION, PARSER_VERSION = "1", "1"
Raw = Callable[[str], Column]


@dataclass(frozen=True)
class Source:
    """A canonical schema: target -> (kind, raw aliases); values derived from raw fields (null where absent); the id; rules; fields without which a row is no record."""

    name: str
    fields: dict[str, tuple]
    derived: dict[str, Callable[[Raw], Column]] = field(default_factory=dict)
    id: tuple = ()
    rules: str | None = None
    needed: tuple[str, ...] = ()


def normalize(df: DataFrame, source: Source, run_id: str = "batch", url: str | None = None, scraped_at=None) -> DataFrame:
    """One select: each target is its first alias that is there, cast; the other raw fields stay in a map.

    ``source_record_id`` is the id fields' text joined by ``_``, ``record_id`` its hash; without an id the record's own
    hash takes its place. Raw fields that the table lacks are null.
    """
    have = set(df.columns)
    raw = lambda c: (F.col(c) if c in have else F.lit(None)).cast("string")
    out, used = [], {c for c in source.id if isinstance(c, str)}
    for target, (kind, *aliases) in source.fields.items():
        found = [a for a in aliases if a in have]
        used.update(found)
        out.append(CAST[kind](F.coalesce(*map(raw, found)) if found else F.lit(None).cast("string")).alias(target))
    rest = sorted(have - used)
    digest = record_hash(*sorted(have))
    plain = composite_id(*(c(raw) if callable(c) else raw(c) for c in source.id)) if source.id else F.lit(None).cast("string")
    lineage = {"source": F.lit(source.name), "url": F.lit(url).cast("string"), "scraped_at": F.lit(scraped_at).cast("timestamp"), "run_id": F.lit(run_id), "raw_hash": digest, "schema_version": F.lit(SCHEMA_VERSION), "parser_version": F.lit(PARSER_VERSION)}
    return df.select(
        entity_id(plain, digest).alias("record_id"), plain.alias("source_record_id"), *out, *(f(raw).alias(n) for n, f in source.derived.items()),
        (extras(*rest) if rest else F.lit(None).cast("map<string,string>")).alias("extra"), *(c.alias(f"lineage_{n}") for n, c in lineage.items()), F.to_date(F.lit(scraped_at).cast("timestamp")).alias("partition_date"),
    )


def ingest(df: DataFrame, source: Source, transform: Callable[[DataFrame], DataFrame] | None = None, as_of: dt.date | None = None, **lineage) -> tuple[DataFrame, DataFrame]:
    """Canonical records and quarantined rows of raw rows, by the source's rules; ``transform`` is a user's own step on the records.

    A row that holds the rules but lacks a needed field once it is cast is quarantined as a normalization error.
    ``as_of`` is the day of rules that depend on one. Rows are dealt out before the rules are checked: no filter moves
    below the generator.
    """
    df = dealt(df).select(F.inline(F.array(F.struct(*(F.col(f"`{c}`") for c in df.columns)))))
    good, bad = route(df, rules_for(source.rules or source.name, df.columns, as_of), source.name)
    if source.needed:
        have = set(df.columns)
        lacks = F.array_compact(F.array(*(F.when(_cast(source, n, have).isNull(), F.lit(n)) for n in source.needed)))
        message = F.concat(F.lit("no value for "), F.array_join(lacks, ", "))
        bad = bad.unionByName(quarantined(good.where(F.size(lacks) > 0), df.columns, source.name, "normalization_error", message))
        good = good.where(F.size(lacks) == 0)
    records = normalize(good, source, **lineage)
    return (records.transform(transform) if transform else records), bad


def _cast(source: Source, target: str, have: set[str]) -> Column:
    """A canonical field of a raw row."""
    raw = lambda c: (F.col(c) if c in have else F.lit(None)).cast("string")
    if target in source.derived:
        return source.derived[target](raw)
    kind, *aliases = source.fields[target]
    return CAST[kind](F.coalesce(F.lit(None).cast("string"), *(raw(a) for a in aliases if a in have)))


def month_of(raw: Raw, c: str) -> Column:
    return F.substring(raw(c), 1, 7)


#: Property types by use code, and by tax class where the code tells none.
USE_CODES = {
    "11": "townhouse", "12": "single_family", "13": "townhouse", "14": "condo", "15": "condo", "16": "multi_family", "17": "multi_family", "19": "multi_family",
    "21": "commercial", "22": "commercial", "23": "commercial", "24": "commercial", "25": "commercial", "26": "commercial", "29": "commercial",
    "31": "other", "32": "other", "33": "other", "34": "other", "35": "other", "91": "land", "92": "land", "93": "land",
}
TAX_CLASSES = {"001": "single_family", "002": "commercial", "003": "land", "004": "other"}
#: Regions of interest by name and by the beginning of the zip.
METRO_NAMES = ("Washington", "Arlington", "Alexandria", "Baltimore")
METRO_ZIPS = ("200", "201", "202", "207", "208", "209", "220", "221", "222", "223")
#: Metrics of a rental market object and their names in rows.
RENT_METRICS = {"averageRent": "average_rent", "medianRent": "median_rent", "minRent": "min_rent", "maxRent": "max_rent", "averageRentPerSqft": "average_rent_per_sqft", "occupancyRate": "occupancy_rate", "daysOnMarket": "days_on_market", "totalListings": "total_listings"}


def sources() -> dict[str, Source]:
    """The sources by name."""
    place = {"latitude": ("float", "LATITUDE", "latitude"), "longitude": ("float", "LONGITUDE", "longitude")}
    series = {"region_name": ("string", "region_name", "zip_code"), "metric_name": ("string", "metric_name"), "metric_date": ("date", "metric_date"), "metric_value": ("float", "metric_value")}
    full_price = lambda raw: F.concat(F.lit("$"), F.format_number(safe_decimal(raw("POTOTAL")), 2))
    made = [
        Source(
            "contracts",
            {
                "contract_number": ("string", "CONTRACT_NUMBER", "CONTRACTNUMBER"),
                "title": ("string", "TITLE", "CONTRACT_TITLE"),
                "description": ("string", "DESCRIPTION"),
                "agency_name": ("string", "AGENCY_NAME", "AGENCY"),
                "agency_code": ("string", "AGENCY_ACRONYM"),
                "supplier_name": ("string", "SUPPLIER", "SUPPLIERNAME"),
                "contract_amount": ("money", "CONTRACTAMOUNT"),
                "contract_status": ("string", "CONTRACTSTATUS"),
                "contract_type": ("string", "MARKETTYPE", "CONTRACTTYPEDESCRIPTION"),
                "procurement_method": ("string", "PROCUREMENTMETHODDESCRIPTION"),
                "fiscal_year": ("fiscal", "FISCALYEAR"),
                "start_date": ("date", "STARTDATE"),
                "end_date": ("date", "ENDDATE"),
                "contract_url": ("string", "CONTRACT_DETAILS_LINK"),
                "nigp_codes": ("codes", "NIGP_CODES", "COMMODITYCODE"),
                "naics_codes": ("codes", "NAICS_CODES"),
                **place,
            },
            id=("CONTRACT_NUMBER",),
        ),
        Source("payments", {"supplier_name": ("string", "SUPPLIERNAME", "SUPPLIER"), "agency_name": ("string", "AGENCY_NAME", "AGENCY"), "payment_amount": ("money", "PAYMENTAMOUNT"), "payment_date": ("date", "PAYMENTDATE"), "fiscal_year": ("fiscal", "FISCALYEAR"), "contract_number": ("string", "CONTRACT_NUMBER")}, id=("PAYMENTID",)),
        Source("purchase_orders", {"agency_name": ("string", "AGENCY_NAME"), "supplier_name": ("string", "SUPPLIER"), "amount_min": ("money", "POTOTAL"), "amount_max": ("money", "POTOTAL"), "order_date": ("date", "ORDERDATE"), "fiscal_year": ("fiscal", "FISCALYEAR")}, {"amount_label": full_price}, ("PONUMBER",)),
        Source(
            "appraisals",
            {
                "ssl": ("string", "SSL"),
                "bedrooms": ("int", "BEDRM"),
                "half_bathrooms": ("float", "HF_BATHRM"),
                "rooms": ("int", "ROOMS"),
                "stories": ("float", "STORIES"),
                "price": ("money", "PRICE"),
                "sale_date": ("date", "SALEDATE"),
                "sale_number": ("int", "SALE_NUM"),
                "year_built": ("int", "AYB"),
                "effective_year_built": ("int", "EYB"),
                "year_remodeled": ("int", "YR_RMDL"),
                "sqft": ("float", "GBA"),
                "lot_sqft": ("float", "LANDAREA"),
                "num_units": ("int", "NUM_UNITS"),
                "kitchens": ("int", "KITCHENS"),
                "fireplaces": ("int", "FIREPLACES"),
                "heating_type": ("string", "HEAT_D"),
                "has_ac": ("string", "AC"),
                "style": ("string", "STYLE_D"),
                "structure": ("string", "STRUCT_D"),
                "grade": ("string", "GRADE_D"),
                "condition": ("string", "CNDTN_D"),
                "exterior_wall": ("string", "EXTWALL_D"),
                "roof_type": ("string", "ROOF_D"),
                "interior_wall": ("string", "INTWALL_D"),
                "use_code": ("int", "USECODE"),
            },
            {
                "bathrooms": lambda raw: bathrooms(safe_float(raw("BATHRM")), safe_float(raw("HF_BATHRM"))),
                "property_type": lambda raw: structure_type(F.coalesce(raw("STRUCT_D"), F.lit(""))),
                "qualified": lambda raw: F.coalesce(F.upper(raw("QUALIFIED")).isin("Q", "Y", "QUALIFIED"), F.lit(False)),
                "price_per_sqft": lambda raw: F.round(F.try_divide(F.nullif(safe_decimal(raw("PRICE")), F.lit(0)), F.nullif(safe_decimal(raw("GBA")), F.lit(0))), 2).cast("double"),
            },
            ("SSL",),
        ),
        Source("assessments", {"ssl": ("string", "SSL"), "ward": ("ward", "WARD", "ASSESSWARD"), "property_tax": ("money", "ASSESSMENT", "NEWTOTAL"), "land_area": ("float", "LANDAREA"), "address": ("string", "PREMISEADD")}, {"property_type": lambda raw: use_code_type(raw("USECODE"), raw("TAXCLASS"), USE_CODES, TAX_CLASSES)}, ("SSL",)),
        Source("sales", {"ssl": ("string", "SSL"), "price": ("money", "SALEPRICE", "PRICE"), "sale_date": ("date", "SALEDATE")}, {"qualified": lambda raw: F.coalesce(F.upper(raw("QUALIFIED")).isin("Q", "Y", "QUALIFIED"), F.lit(False))}, ("SSL", "SALEDATE")),
        Source("lots", {"ssl": ("string", "SSL"), "zip": ("zip", "ZIP", "ZIPCODE")}, {"lot_area": lambda raw: lot_area(safe_float(raw("RECORD_AREA")), safe_float(raw("COMPUTED_AREA"))), "address": lambda raw: lot_address(raw("ADDRNUM"), raw("STNAME"), raw("QUADRANT")), "zip_plus_four": lambda raw: zip_plus_four(F.coalesce(raw("ZIP"), raw("ZIPCODE")), raw("ZIP4"))}, ("SSL",)),
        Source("wards", {"region_name": ("string", "NAME"), "ward": ("ward", "WARD"), "metric_value": ("float", "POP100")}, id=("WARD",)),
        Source("businesses", {"business_name": ("string", "BUSINESS_NAME", "ENTITY_NAME"), "license": ("string", "LICENSE_NUMBER"), "solicitation": ("string", "SOLICITATION_NUMBER"), "categories": ("codes", "CERTIFICATION_CATEGORIES"), "phone": ("phone", "PHONE"), "ward": ("ward", "WARD"), **place}, id=("LICENSE_NUMBER", "SOLICITATION_NUMBER")),
        Source(
            "housing",
            {
                "project_name": ("string", "PROJECT_NAME", "SITENAME"),
                "address": ("string", "FULLADDRESS", "ADDRESS"),
                "units": ("int", "TOTAL_AFFORDABLE_UNITS", "UNITS"),
                "units_0_30_ami": ("int", "AFFORDABLE_UNITS_AT_0_30_AMI"),
                "units_31_50_ami": ("int", "AFFORDABLE_UNITS_AT_31_50_AMI"),
                "units_51_60_ami": ("int", "AFFORDABLE_UNITS_AT_51_60_AMI"),
                "units_61_80_ami": ("int", "AFFORDABLE_UNITS_AT_61_80_AMI"),
                "units_81_ami": ("int", "AFFORDABLE_UNITS_AT_81_AMI"),
                "ward": ("ward", "MAR_WARD", "WARD"),
                "status": ("string", "STATUS_PUBLIC"),
                "agency": ("string", "AGENCY_CALCULATED", "AGENCY"),
                "ownership_type": ("string", "OWNERSHIP_TYPE"),
                "building_use": ("string", "BUILDING_USE"),
                "owner_name": ("string", "OWNERNAME"),
                "zoning": ("string", "ZONING"),
                "anc": ("string", "ANC"),
                "mar_id": ("string", "MAR_ID"),
                **place,
            },
            {"property_type": lambda raw: F.lit("multi_family"), "listing_type": lambda raw: F.lit("for_rent")},
            ("OBJECTID",),
        ),
        Source("market", series, id=("region_name", "zip_code", "metric_name", lambda raw: month_of(raw, "metric_date"))),
        Source("rent_metrics", {"region_name": ("string", "zip_code", "region_name"), **{k: v for k, v in series.items() if k != "region_name"}}, {"state": lambda raw: state_of_zip(raw("zip_code"))}, ("zip_code", "property_type", "metric_name", lambda raw: month_of(raw, "metric_date")), "market"),
        Source("listings", {"listing_id": ("string", "listing_id"), "address": ("string", "address"), "price": ("money", "price"), "sqft": ("float", "sqft"), "zip": ("zip", "zip_code"), **place}, {"price_per_sqft": lambda raw: F.round(F.try_divide(safe_decimal(raw("price")), safe_decimal(raw("sqft"))), 2).cast("double"), "state": lambda raw: state_of_zip(raw("zip_code")), "price_reduced": lambda raw: price_reduced(safe_float(raw("price")), safe_float(raw("list_price")))}, ("listing_id",)),
        Source("rentals", {"property_name": ("string", "property_name"), "unit_number": ("string", "unit_number"), "floor": ("int", "floor"), "floor_plan_name": ("string", "floor_plan_name"), "rent_price": ("money", "price"), "bedrooms": ("int", "bedrooms"), "bathrooms": ("float", "bathrooms"), "sqft": ("int", "sqft"), "status": ("string", "status"), "city": ("string", "city"), "state": ("string", "state"), "available_date": ("date", "available_date")}, id=("unit_number",)),
        Source("demographics", {"region_name": ("string", "region_name"), "metric_name": ("string", "metric_name"), "category": ("string", "category"), "metric_value": ("float", "metric_value")}, id=("region_name", "metric_name", "category")),
        Source("locations", {"ssl": ("string", "SSL"), "address": ("string", "FULLADDRESS"), "ward": ("ward", "WARD"), "zip": ("zip", "ZIPCODE"), **place}, {"is_local": lambda raw: is_local_zip(clean_zip(raw("ZIPCODE")))}, ("SSL",)),
        Source("highlights", {"historic_district": ("string", "historic_district"), "historic_landmark": ("string", "historic_landmark"), "zoning": ("string", "zoning"), "ward": ("string", "ward"), "anc": ("string", "anc"), "flood_plain": ("string", "flood_plain"), **place}, {f"{flag}": (lambda raw, c=c: safe_string(raw(c)).isNotNull()) for flag, c in (("in_historic_district", "historic_district"), ("is_historic_landmark", "historic_landmark"), ("in_flood_plain", "flood_plain"))}, ("latitude", "longitude"), "locations"),
    ]
    return {s.name: s for s in made}


def in_regions(df: DataFrame, name: str, zip_code: str, names: tuple[str, ...] = METRO_NAMES, prefixes: tuple[str, ...] = METRO_ZIPS) -> DataFrame:
    """Rows whose region name holds one of ``names``, or whose zip, padded to five, begins with one of ``prefixes``."""
    held = reduce(lambda a, b: a | b, (F.contains(F.lower(F.col(name)), F.lit(n.lower())) for n in names))
    return df.where(F.coalesce(held, F.lit(False)) | F.coalesce(F.substring(F.lpad(F.col(zip_code).cast("string"), 5, "0"), 1, 3).isin(*prefixes), F.lit(False)))


def metric_rows(df: DataFrame, keys: list[str], stats: dict[str, Column]) -> DataFrame:
    """One row per metric of a stats object that has a value: keys, metric_name, metric_value."""
    pairs = F.array(*(F.struct(F.lit(n).alias("metric_name"), c.cast("double").alias("metric_value")) for n, c in stats.items()))
    return df.select(*keys, F.inline(F.filter(pairs, lambda p: p["metric_value"].isNotNull())))


#: Fields of a listing with their types and the paths that replies give them under, the first that is there.
LISTING = {
    "property_id": ("string", "property_id", "listing_id"), "status": ("string", "status"), "list_price": ("double", "list_price", "price.list"), "sold_price": ("double", "sold_price", "price.sold"),
    "line": ("string", "location.address.line", "address.line"), "city": ("string", "location.address.city", "address.city"), "state_code": ("string", "location.address.state_code", "address.state_code", "address.state"),
    "postal_code": ("string", "location.address.postal_code", "address.postal_code"), "county": ("string", "location.address.county", "address.county"), "neighborhood": ("string", "location.address.neighborhood", "address.neighborhood_name"),
    "lat": ("double", "location.address.coordinate.lat", "address.lat"), "lon": ("double", "location.address.coordinate.lon", "address.lon"),
    "beds": ("int", "description.beds", "beds"), "baths": ("double", "description.baths", "baths"), "sqft": ("double", "description.sqft", "building_size.size"), "lot_sqft": ("double", "description.lot_sqft", "lot_size.size"),
    "year_built": ("int", "description.year_built", "year_built"), "stories": ("int", "description.stories"), "garage": ("int", "description.garage"), "type": ("string", "description.type", "prop_type"),
    "price_per_sqft": ("double", "price_per_sqft"), "original_price": ("double", "original_price"), "list_date": ("string", "list_date"), "sold_date": ("string", "sold_date"), "last_update": ("string", "last_update"),
    "photo_count": ("int", "photo_count"), "days_on_market": ("int", "days_on_market"),
}
#: Where a reply holds its listings; the last is a reply that is a list itself.
LISTINGS = ("home_search.results", "data.home_search.results", "data.results", "results", "properties", "")


def listing_rows(payloads: DataFrame, column: str, fields: dict[str, tuple] = LISTING, arrays: tuple[str, ...] = LISTINGS) -> DataFrame:
    """The listings of JSON replies, flattened: the other columns of ``payloads`` and one column a field.

    A reply is parsed once, into a variant. Its listings are those of the first of ``arrays`` that holds an array, and
    each field is the value of the first of its paths that is there and of its type. Replies that are no JSON give none.
    """
    at = lambda v, path, kind: F.try_variant_get(v, f"$.{path}" if path else "$", kind)
    kept = [c for c in payloads.columns if c != column]
    rows = payloads.select(*kept, F.try_parse_json(column).alias("_reply"))
    rows = rows.select(*kept, F.explode(F.coalesce(*(at(F.col("_reply"), p, "array<variant>") for p in arrays))).alias("_listing"))
    return rows.select(*kept, *(F.coalesce(*(at(F.col("_listing"), p, kind) for p in paths)).alias(n) for n, (kind, *paths) in fields.items()))


def latest_metric(df: DataFrame, entity: str, metric: str, date: str, *tie: str) -> DataFrame:
    """The newest row of each metric of each entity."""
    newest = Window.partitionBy(entity, metric).orderBy(F.desc_nulls_last(date), *tie)
    return df.withColumn("place", F.row_number().over(newest)).where("place = 1").drop("place")
