import uuid

import pytest
from pyspark.sql import functions as F

from civiclake.functions import scalars as S


def one(spark, fn, *values):
    df = spark.createDataFrame([tuple(values)], ", ".join(f"c{i} string" for i in range(len(values))))
    return df.select(fn(*(F.col(f"c{i}") for i in range(len(values)))).alias("x")).first().x


@pytest.mark.parametrize("value, want", [(None, None), ("", None), ("nan", None), ("N/A", None), ("-", None), ("   ", None), ("42.7", 42), ("  42  ", 42), ("$1,234", 1234), ("-100", -100)])
def test_safe_int(spark, value, want):
    assert one(spark, S.safe_int, value) == want


def test_money_and_dates(spark):
    assert float(one(spark, S.safe_decimal, "$1,234.56")) == 1234.56
    for text in ("2024-01-15", "01/15/2024", "January 15, 2024", "1705276800000"):
        assert str(one(spark, S.safe_date, text)) == "2024-01-15", text
    assert one(spark, S.safe_date, "N/A") is None


@pytest.mark.parametrize("value, want", [("Test LLC", "test"), ("  Test Vendor  ", "test vendor"), ("", ""), ("Acme Inc LLC", "acme"), ("Acme LLC Inc", "acme llc"), ("COMPUTER AID, INC", "computer aid,"), ("OST, INC.", "ost, inc.")])
def test_vendor_key(spark, value, want):
    assert one(spark, S.vendor_key, value) == want


def test_supplier_key_and_uuid(spark):
    assert one(spark, S.supplier_key, "Ost, Inc.") == "OST"
    assert one(spark, S.supplier_key, "Acme LLC") == "ACME"
    assert one(spark, S.uuid5, "dc_payments:7") == str(uuid.uuid5(uuid.NAMESPACE_DNS, "dc_payments:7"))


def test_ranges_wards_zip(spark):
    assert tuple(one(spark, S.amount_range, "$10,001 - $100,000")) == (10001.0, 100000.0)
    assert tuple(one(spark, S.amount_range, "about 500")) == (500.0, 500.0)
    assert tuple(one(spark, S.amount_range, "none")) == (0.0, 0.0)
    assert one(spark, S.ward, "Ward 3") == 3 and one(spark, S.ward, "9") is None
    assert one(spark, S.clean_zip, "501") == "00501" and one(spark, S.clean_phone, "12-34") is None
