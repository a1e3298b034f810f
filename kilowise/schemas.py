"""Schemas of dump files and stream records.

In the DataFrames the reading time is called ``reading_ts``; ``timestamp`` stays
the name inside stream messages.
"""

from __future__ import annotations

from pyspark.sql import types as T

S, I, L, D, TS, B = (
    T.StringType(),
    T.IntegerType(),
    T.LongType(),
    T.DateType(),
    T.TimestampType(),
    T.BooleanType(),
)


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


def dec(precision: int, scale: int) -> T.DecimalType:
    return T.DecimalType(precision, scale)


# Columns of two tables that are read from dumps, of a message body and of a topic.
DIM_TARIFF = _struct(
    tariff_code=S, tariff_name=S, description=S, peak_rate_per_kwh=dec(8, 4),
    offpeak_rate_per_kwh=dec(8, 4), daily_fixed_charge=dec(8, 2), applicable_from=D,
    applicable_to=D, is_current=B,
)

BRIDGE_CUSTOMER_ADDRESS = _struct(
    address_id=I, customer_id=S, address=S, start_date=D, end_date=D, is_current=B, region=S
)

# JSON body of a stream message. Voltage is read as double because producers
# send 230.0, which an integer field would turn into NULL; parse_json casts it.
STREAM_RECORD = _struct(
    meter_id=S, timestamp=TS, kwh_usage=T.DoubleType(), voltage=I, customer_id=S, region=S
)

# Other names producers use for the same field.
STREAM_ALIASES = {"kwh_usage": ["energy_consumption", "consumption"]}

# Row shape of a Kafka source.
TOPIC_RECORD = _struct(
    key=T.BinaryType(), value=T.BinaryType(), topic=S, partition=I, offset=L, timestamp=TS,
    timestampType=I,
)
