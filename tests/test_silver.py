import datetime as dt
from decimal import Decimal

from finmart.functions.metadata import with_ingestion_metadata
from finmart.plans import silver
from finmart.sources.schemas import source_schema


def _bronze(spark, name, rows):
    df = spark.createDataFrame(rows, source_schema(name))
    return with_ingestion_metadata(df, "TEST", "b1", "2024-01-01 00:00:00")


def _line(key=1, line=1, qty="1", price="10.00", disc="0.05", tax="0.02"):
    d = dt.date(1995, 1, 1)
    return (key, 1, 1, line, None if qty is None else Decimal(qty),
            None if price is None else Decimal(price), None if disc is None else Decimal(disc),
            None if tax is None else Decimal(tax), " N ", "O", d, d, d, " X ", "AIR", None)


def test_lineitem_hygiene_filter(spark):
    rows = [_line(line=1), _line(line=2, qty="0"), _line(line=3, price="0"),
            _line(line=4, disc="1.0000", tax="0"), _line(line=5, tax=None),
            _line(key=None, line=6)]
    out = silver.silver_lineitem(_bronze(spark, "lineitem", rows)).collect()
    assert sorted(r["line_number"] for r in out) == [1, 4]  # discount 1 is inside [0, 1]
    first = [r for r in out if r["line_number"] == 1][0]
    assert first["return_flag"] == "N" and first["ship_instruction"] == "X"
    assert first["net_revenue"] == Decimal("9.50") and first["discount_amount"] == Decimal("0.50")
    assert list(out[0].asDict())[-3:] == ["discount_amount", "net_revenue", "tax_amount"]


def test_discount_above_one_dropped(spark):
    from pyspark.sql import functions as F
    b = _bronze(spark, "lineitem", [_line()]).withColumn("l_discount", F.lit(1.2))
    assert silver.silver_lineitem(b).count() == 0


def test_orders_null_keys_dropped(spark):
    d = dt.date(1995, 1, 1)
    rows = [(1, 1, "F", Decimal("1.00"), d, " 1-URGENT ", None, None, None),
            (2, None, "F", Decimal("1.00"), d, "2-HIGH", None, None, None),
            (3, 1, "F", Decimal("1.00"), None, "2-HIGH", None, None, None)]
    out = silver.silver_orders(_bronze(spark, "orders", rows)).collect()
    assert [r["order_id"] for r in out] == [1]
    assert out[0]["order_priority"] == "1-URGENT" and out[0]["order_quarter"] == 1


def test_partsupp_cost_rules(spark):
    rows = [(1, 1, None, Decimal("-1.00"), None), (1, 2, None, None, None),
            (1, 3, None, Decimal("0.00"), None)]
    out = silver.silver_partsupp(_bronze(spark, "partsupp", rows)).collect()
    assert [r["supplier_id"] for r in out] == [3]


def test_part_trim_and_upper_brand(spark):
    rows = [(1, "  bolt ", None, " brand#12 ", "T", 1, None, Decimal("5.00"), None)]
    r = silver.silver_part(_bronze(spark, "part", rows)).first()
    assert r["part_name"] == "bolt" and r["brand"] == "BRAND#12"
