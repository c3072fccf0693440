"""Small typed DataFrames from keyword rows; columns left out are NULL."""

from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal

from pyspark.sql import types as T

from retailloom.schemas import raw_table


def _fit(value, data_type):
    if value is None:
        return None
    if isinstance(data_type, T.DecimalType):
        return Decimal(str(value))
    if isinstance(data_type, T.DateType) and isinstance(value, str):
        return date.fromisoformat(value)
    if isinstance(data_type, T.TimestampNTZType) and isinstance(value, str):
        return datetime.fromisoformat(value)
    return value


def raw(spark, entity, *rows):
    schema = raw_table(entity).schema
    unknown = {k for r in rows for k in r} - set(schema.names)
    assert not unknown, unknown
    return spark.createDataFrame([tuple(_fit(r.get(f.name), f.dataType) for f in schema) for r in rows], schema)


SALE = dict(sale_id="S1", sale_date="2024-01-01", customer_id="C1", product_id="P1", product_name="Item", quantity=1,
            unit_price=10, total_amount=10, channel="online", store_id="ST1", country="France", created_at="2024-01-01 08:00:00")
RETURN = dict(return_id="R1", sale_id="S1", customer_id="C1", product_id="P1", return_date="2024-01-05", reason="torn",
              condition="worn", refund_amount=4, refund_method="cash", processed_by="STAFF1", status="Approved")
CUSTOMER = dict(customer_id="C1", first_name="Ada", last_name="Byron", segment="VIP", preferred_channel="desk",
                marketing_consent=True, lifetime_value=100, last_purchase_date="2023-05-01", date_of_birth="2000-12-31")
EVENT = dict(event_id="ev1", sale_id="S1", event_ts="2025-03-02 10:00:00", sale_date="2025-03-02", customer_id="C1", product_id="P1",
             product_name="Oak stool", quantity=2, unit_price=10, total_amount=20, channel="kiosk", store_id="ST1", country="France",
             kafka_partition=1, kafka_offset=810, ingested_at="2025-03-02 10:00:01.500")


def sale(**changes):
    return {**SALE, **changes}


def returned(**changes):
    return {**RETURN, **changes}


def customer(**changes):
    return {**CUSTOMER, **changes}


def event(**changes):
    return {**EVENT, **changes}


def plan_of(df):
    """The physical plan with all details."""
    spark = df.sparkSession
    return spark._jvm.org.apache.spark.sql.api.python.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
