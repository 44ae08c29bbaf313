"""Scalar functions as Columns: coercion, names, money, dates, places. All null-safe under ANSI mode."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Words that stand for a missing value.
NULL_WORDS = ("", "nan", "null", "none", "n/a", "-")
#: Suffixes the analytics tables strip, in order, each once.
GOLD_SUFFIXES = (" llc", " inc", " corp", " ltd", " co", " company")
#: Suffixes the supplier dimension strips, the first that fits.
SUPPLIER_SUFFIXES = (
    ", LLC", " LLC", ", L.L.C.", " L.L.C.", ", INC", " INC", ", INC.", " INC.", ", CORP", " CORP",
    ", CORP.", " CORP.", ", INCORPORATED", " INCORPORATED", ", COMPANY", " COMPANY", ", CO", " CO", ", CO.", " CO.",
)
#: Amount ranges of purchase orders.
AMOUNT_RANGES = ((0, 10000), (10001, 100000), (100001, 250000), (250001, 500000), (500001, 1000000), (1000001, 5000000), (5000001, 10000000))
OPEN_RANGE = (10000001, 50000000)
DATE_FORMATS = ("yyyy-MM-dd", "yyyy-MM", "MM/dd/yyyy", "dd/MM/yyyy", "MMMM d, yyyy", "MMM d, yyyy", "yyyy/MM/dd", "yyyyMMdd")
#: Milliseconds that count as a time: above 1e10, up to the end of the year 9999.
EPOCH_FROM, EPOCH_TO = 10_000_000_000, 253_402_300_799_999
NAMESPACE_DNS = "6ba7b8109dad11d180b400c04fd430c8"


def _bare(c: Column) -> Column:
    """Trimmed text without currency signs; without a pattern, as every number of a raw row passes here."""
    return F.trim(F.translate(c.cast("string"), "$,", ""))


def _text(c: Column) -> Column:
    """Trimmed text without currency signs; a null word becomes null. Null words are no numbers, so casts need only ``_bare``."""
    t = _bare(c)
    return F.when(~F.lower(t).isin(*NULL_WORDS), t)


def safe_float(c: Column) -> Column:
    v = _bare(c).try_cast("double")
    return F.when(~F.isnan(v) & (F.abs(v) != F.lit(float("inf"))), v)


def safe_int(c: Column) -> Column:
    """Toward zero; whole numbers keep all their digits."""
    return F.coalesce(_bare(c).try_cast("bigint"), safe_float(c).try_cast("bigint"))


def safe_decimal(c: Column) -> Column:
    return _bare(c).try_cast("decimal(18,2)")


def safe_timestamp(c: Column) -> Column:
    """Milliseconds above 1e10, else the first format that fits."""
    t = _text(c)
    # The sign strip above removes commas, which month-name formats need.
    raw = F.trim(c.cast("string"))
    ms = F.regexp_extract(t, r"^(\d{11,15})(\.0)?$", 1).try_cast("bigint")
    parsed = [F.to_timestamp_ntz(F.lit(None).cast("string"))] + [F.try_to_timestamp(raw, F.lit(f)).cast("timestamp_ntz") for f in ("yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd HH:mm:ss", *DATE_FORMATS)]
    return F.coalesce(F.when(ms.between(EPOCH_FROM + 1, EPOCH_TO), F.timestamp_millis(ms).cast("timestamp_ntz")), *parsed[1:])


def safe_date(c: Column) -> Column:
    return safe_timestamp(c).cast("date")


def safe_bool(c: Column) -> Column:
    t = F.lower(F.trim(c.cast("string")))
    return F.when(t.isin("true", "yes", "y", "1", "on"), True).when(t.isin("false", "no", "n", "0", "off"), False)


def safe_string(c: Column, longest: int | None = None) -> Column:
    t = F.trim(c.cast("string"))
    return F.nullif(F.substring(t, 1, longest) if longest else t, F.lit(""))


def clean_phone(c: Column) -> Column:
    t = F.regexp_replace(c.cast("string"), r"[^0-9+]", "")
    return F.when(F.length(t) >= 7, t)


def clean_zip(c: Column) -> Column:
    t = F.regexp_replace(c.cast("string"), r"[^0-9-]", "")
    return F.nullif(F.when(t.rlike(r"^\d{1,4}$"), F.lpad(t, 5, "0")).otherwise(t), F.lit(""))


def epoch_date(c: Column) -> Column:
    """ISO date of epoch milliseconds; small values, and those beyond the year 9999, are no dates."""
    ms = F.when(c.cast("double").between(EPOCH_FROM + 1, EPOCH_TO), c.try_cast("bigint"))
    return F.date_format(F.timestamp_millis(ms), "yyyy-MM-dd")


#: Fields that differ between runs over one record.
VOLATILE = ("scraped_at", "run_id", "record_id", "_timestamp")


def record_hash(*columns: str) -> Column:
    """SHA-256 of the named columns as JSON, in name order, nulls included, fields of one run left out."""
    return F.sha2(F.to_json(F.struct(*sorted(c for c in columns if c not in VOLATILE)), {"ignoreNullFields": "false"}), 256)


def content_signature(kind: Column, url: Column, digest: Column) -> Column:
    return F.sha2(F.concat_ws("|", kind, url, digest), 256)


def entity_id(*keys: Column) -> Column:
    """First 16 hex digits of the MD5 of the first key that is there."""
    return F.substring(F.md5(F.coalesce(*keys)), 1, 16)


def uuid5(name: Column, namespace: str = NAMESPACE_DNS) -> Column:
    h = F.sha1(F.concat(F.unhex(F.lit(namespace)), F.encode(name, "UTF-8")))
    variant = F.lower(F.hex(F.conv(F.substring(h, 17, 1), 16, 10).cast("int").bitwiseAND(3).bitwiseOR(8)))
    part = lambda a, n: F.substring(h, a, n)
    return F.concat_ws("-", part(1, 8), part(9, 4), F.concat(F.lit("5"), part(14, 3)), F.concat(variant, part(18, 3)), part(21, 12))


def vendor_key(c: Column) -> Column:
    """Lower case without the suffixes of GOLD_SUFFIXES, each stripped once in their order."""
    n = F.trim(F.lower(c))
    for s in GOLD_SUFFIXES:
        n = F.regexp_replace(n, rf"{s}\z", "")
    return F.trim(n)


def supplier_key(c: Column) -> Column:
    """Upper case without the first suffix of SUPPLIER_SUFFIXES that fits (forms with a comma start further left)."""
    ends = "|".join(s.replace(".", r"\.") for s in SUPPLIER_SUFFIXES)
    return F.nullif(F.trim(F.regexp_replace(F.trim(F.upper(c)), rf"(?:{ends})\z", "")), F.lit(""))


def amount_range(c: Column) -> Column:
    """(lo, hi) of a range text: a known bucket, else its first one or two numbers, else zeros."""
    t = F.regexp_replace(c, r"[$,]", "")
    pair = lambda a, b: F.struct(F.lit(float(a)).alias("lo"), F.lit(float(b)).alias("hi"))
    out = F.when(t.rlike(rf">\s*{OPEN_RANGE[0]}"), pair(*OPEN_RANGE))
    for lo, hi in AMOUNT_RANGES:
        out = out.when(t.rlike(rf"(?<!\d){lo}\s*[-–]\s*{hi}(?!\d)"), pair(lo, hi))
    n = F.transform(F.regexp_extract_all(t, F.lit(r"\d+"), F.lit(0)), lambda x: x.cast("double"))
    first = F.coalesce(F.try_element_at(n, F.lit(1)), F.lit(0.0))
    return out.otherwise(F.struct(first.alias("lo"), F.coalesce(F.try_element_at(n, F.lit(2)), first).alias("hi")))


def po_amount(lo: Column, hi: Column) -> Column:
    half = F.lit("0.5").cast("decimal(2,1)")
    return F.coalesce((lo + hi) * half, lo, hi, F.lit(0))


def fiscal_year(d: Column) -> Column:
    return F.year(F.add_months(d, 3))


def fiscal_quarter(d: Column) -> Column:
    return F.quarter(F.add_months(d, 3))


def fiscal_month(d: Column) -> Column:
    return F.month(F.add_months(d, 3))


def fiscal_year_text(c: Column) -> Column:
    return F.trim(F.replace(F.upper(c), F.lit("FY"), F.lit(""))).try_cast("int")


def ward(c: Column, extra_json: Column | None = None) -> Column:
    """Ward 1..8 from a column, else from an extras map in JSON."""
    names = ("WARD", "ward", "Ward", "WARD_ID")
    raw = F.coalesce(c.cast("string"), *([F.get_json_object(extra_json, f"$.{n}") for n in names] if extra_json is not None else []))
    n = F.trim(F.regexp_replace(raw, r"(?i)^\s*ward\s*", "")).try_cast("int")
    return F.when(n.between(1, 8), n)


def ward_label(c: Column) -> Column:
    return F.when(c.cast("string").rlike(r"^\d+$"), F.concat(F.lit("Ward "), c.cast("string"))).otherwise(c.cast("string"))


def code_list(c: Column) -> Column:
    parts = F.when(F.contains(c, F.lit(";")), F.split(c, ";")).otherwise(F.split(c, ","))
    return F.filter(F.transform(parts, lambda x: F.trim(x)), lambda x: x != "")


def property_type_flags(c: Column) -> dict[str, Column]:
    t = F.lower(c)
    return {"is_single_family": (t.contains("single") | t.contains("sfr")).cast("int"), "is_condo": t.contains("condo").cast("int"), "is_townhouse": t.contains("town").cast("int")}


def structure_type(c: Column) -> Column:
    t = F.lower(c)
    return F.when(t.contains("row"), "townhouse").when(t.contains("semi"), "semi_detached").when(t.contains("attach"), "attached").when(t.contains("condo"), "condo").otherwise("single_family")


def bathrooms(full: Column, half: Column) -> Column:
    return F.coalesce(full, F.lit(0)) + F.coalesce(half, F.lit(0)) * 0.5


def state_of_zip(c: Column) -> Column:
    p = F.substring(c, 1, 3)
    return F.when(p.isin("200", "201"), "DC").when(p.isin("222", "223"), "VA").when(p.isin("208", "209"), "MD")


def trend_direction(change: Column) -> Column:
    return F.when(change > 2, "up").when(change < -2, "down").otherwise("stable")


def spend_tier(spend: Column) -> Column:
    return F.when(spend >= 10_000_000, "Enterprise").when(spend >= 1_000_000, "Large").when(spend >= 100_000, "Medium").otherwise("Small")


def log_or_null(c: Column) -> Column:
    return F.when(c > 0, F.ln(c))


def filled_fields(*columns: str) -> Column:
    return sum((F.col(c).isNotNull().cast("int") for c in columns[1:]), F.col(columns[0]).isNotNull().cast("int"))


def word_count(c: Column) -> Column:
    return F.size(F.filter(F.split(c, r"\s+"), lambda x: x != ""))


def first_of(*columns: str) -> Column:
    """Alias mapping: the first raw field that is not null."""
    return F.coalesce(*(F.col(c) for c in columns))


def extras(*columns: str) -> Column:
    """The other raw fields, as a map without nulls."""
    pairs = [x for c in columns for x in (F.lit(c), F.col(c).cast("string"))]
    return F.map_filter(F.create_map(*pairs), lambda _, v: v.isNotNull())


def is_local_zip(c: Column) -> Column:
    """Five characters that begin with 20."""
    return F.coalesce((F.length(c) == 5) & c.startswith("20"), F.lit(False))


def assessed_value(tax: Column, extra_json: Column, price: Column) -> Column:
    """The first that is there, 0 included: property tax, an assessment of the extra fields, the price."""
    extra = [F.get_json_object(extra_json, f"$.{n}") for n in ("ASSESSMENT", "assessment", "assessed_value")]
    return F.coalesce(*(safe_decimal(c) for c in (tax, *extra, price)))


def use_code_type(code: Column, tax_class: Column, kinds: dict[str, str], classes: dict[str, str]) -> Column:
    """Property type of a use code by the table ``kinds``, else of the tax class by ``classes``, else other."""
    table = lambda d, c: F.try_element_at(F.create_map(*(F.lit(x) for kv in d.items() for x in kv)), F.trim(c.cast("string"))) if d else F.lit(None).cast("string")
    return F.coalesce(table(kinds, code), table(classes, tax_class), F.lit("other"))


def price_reduced(price: Column, listed: Column) -> Column:
    return F.coalesce(price < listed, F.lit(False))


def composite_id(*parts: Column) -> Column:
    """The parts that are there, joined by an underscore."""
    return F.nullif(F.concat_ws("_", *(F.nullif(p.cast("string"), F.lit("")) for p in parts)), F.lit(""))


def lot_address(number: Column, street: Column, quadrant: Column) -> Column:
    return F.nullif(F.concat_ws(" ", *(safe_string(c) for c in (number, street, quadrant))), F.lit(""))


def zip_plus_four(zip_code: Column, four: Column) -> Column:
    z = clean_zip(zip_code)
    f = safe_string(four)
    return F.when(f.isNotNull(), F.concat_ws("-", z, F.lpad(f, 4, "0"))).otherwise(z)


def lot_area(record: Column, computed: Column) -> Column:
    """The recorded area, else the computed one; 0 counts as missing."""
    return F.coalesce(F.nullif(record, F.lit(0.0)), computed)


def metric_category(name: Column) -> Column:
    n = F.lower(name)
    return F.when(n.contains("rent") | n.contains("zori"), "rent").when(n.contains("inventory"), "inventory").otherwise("sale")


def spend_size(spend: Column) -> Column:
    """The other label set of ``spend_tier``."""
    return F.when(spend >= 10_000_000, "$10M+").when(spend >= 1_000_000, "$1M-$10M").when(spend >= 100_000, "$100K-$1M").otherwise("Under $100K")


def iso_day(c: Column) -> Column:
    """The date part of a time stamp's text."""
    return F.split_part(c, F.lit("T"), F.lit(1))


def label(c: Column, longest: int) -> Column:
    return F.left(c, F.lit(longest))


def millions(c: Column) -> Column:
    return F.round(c.cast("double") / 1e6, 2)


def json_map(c: Column) -> Column:
    """A JSON object as a map of texts; null where it is none."""
    return F.from_json(c, "map<string,string>")
