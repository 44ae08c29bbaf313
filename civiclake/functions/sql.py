"""Functions that SQL text can call: fiscal parts, vendor names, safe casts, and tables of days and fiscal years. Plain SQL bodies, which Catalyst inlines."""

from __future__ import annotations

from pyspark.sql import SparkSession

from .scalars import GOLD_SUFFIXES, NULL_WORDS

_TEXT = "nullif(regexp_replace(trim(regexp_replace(v, '[$,]', '')), '(?i)^(" + "|".join(NULL_WORDS) + ")$', ''), '')"


def _vendor() -> str:
    out = "trim(lower(v))"
    for s in GOLD_SUFFIXES:
        out = f"regexp_replace({out}, '{s}$', '')"
    return f"trim({out})"


FUNCTIONS = {
    "fiscal_year": ("v DATE", "INT", "year(add_months(v, 3))"),
    "fiscal_quarter": ("v DATE", "INT", "quarter(add_months(v, 3))"),
    "fiscal_month": ("v DATE", "INT", "month(add_months(v, 3))"),
    "date_key": ("v DATE", "INT", "CAST(date_format(v, 'yyyyMMdd') AS INT)"),
    "vendor_key": ("v STRING", "STRING", _vendor()),
    "safe_double": ("v STRING", "DOUBLE", f"try_cast({_TEXT} AS DOUBLE)"),
    "safe_bigint": ("v STRING", "BIGINT", f"try_cast(try_cast({_TEXT} AS DOUBLE) AS BIGINT)"),
    "safe_money": ("v STRING", "DECIMAL(18,2)", f"try_cast({_TEXT} AS DECIMAL(18,2))"),
}


#: Table functions: arguments, columns, body.
TABLES = {
    "dim_date": (
        "first_day DATE, last_day DATE",
        "date_key INT, full_date DATE, year INT, quarter INT, month INT, month_name STRING, week INT, day INT, day_of_week INT, day_name STRING, is_weekend BOOLEAN, fiscal_year INT, fiscal_quarter INT, fiscal_month INT",
        """SELECT CAST(date_format(d, 'yyyyMMdd') AS INT), d, year(d), quarter(d), month(d), date_format(d, 'MMMM'), weekofyear(d), day(d), weekday(d) + 1, date_format(d, 'EEEE'), weekday(d) >= 5,
          year(add_months(d, 3)), quarter(add_months(d, 3)), month(add_months(d, 3)) FROM (SELECT explode(sequence(first_day, last_day)) AS d WHERE first_day <= last_day)""",
    ),
    "fiscal_years": (
        "first_year INT, last_year INT",
        "fiscal_year INT, first_day DATE, last_day DATE, days INT",
        """SELECT y, make_date(y - 1, 10, 1), make_date(y, 9, 30), datediff(make_date(y, 9, 30), make_date(y - 1, 10, 1)) + 1 FROM (SELECT explode(sequence(first_year, last_year)) AS y WHERE first_year <= last_year)""",
    ),
}


def register(spark: SparkSession) -> None:
    """Create or replace the functions in the session. Without a day between its bounds a table function gives no rows."""
    for name, (args, kind, body) in FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({args}) RETURNS {kind} RETURN {body}")
    for name, (args, columns, body) in TABLES.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({args}) RETURNS TABLE({columns}) RETURN {body}")
