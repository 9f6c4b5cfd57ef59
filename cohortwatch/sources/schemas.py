"""Payload and envelope schemas of the known topics. Timestamps are ISO-8601 UTC strings on the wire."""

from __future__ import annotations

from pyspark.sql.types import BinaryType, BooleanType, DataType, DoubleType, IntegerType, LongType, StringType, StructField, StructType, TimestampType

TEXT, INT, DOUBLE, BOOL = StringType(), IntegerType(), DoubleType(), BooleanType()


def struct(**fields: DataType) -> StructType:
    """A struct of nullable fields in the given order."""
    return StructType([StructField(name, kind) for name, kind in fields.items()])


USERS = struct(user_id=TEXT, username=TEXT, email=TEXT, first_name=TEXT, last_name=TEXT, age=INT, country=TEXT, city=TEXT, phone=TEXT, created_at=TEXT, is_active=BOOL)
TRANSACTIONS = struct(transaction_id=TEXT, user_id=TEXT, amount=DOUBLE, currency=TEXT, merchant=TEXT, category=TEXT, status=TEXT, timestamp=TEXT, description=TEXT, location=struct(latitude=DOUBLE, longitude=DOUBLE))
IOT_SENSORS = struct(device_id=TEXT, sensor_type=TEXT, value=DOUBLE, unit=TEXT, timestamp=TEXT, location=struct(building=TEXT, floor=INT, room=TEXT), battery_level=INT, signal_strength=INT)
WEARABLES = struct(device_id=TEXT, user_id=TEXT, heart_rate_bpm=INT, steps_count=INT, calories_burned=DOUBLE, timestamp=TEXT)
CLICKSTREAM = struct(session_id=TEXT, user_id=TEXT, action=TEXT, page=TEXT, timestamp=TEXT, user_agent=TEXT, ip_address=TEXT, referrer=TEXT, duration_ms=INT, browser=TEXT, device_type=TEXT, coordinates=struct(x=INT, y=INT))
LOGS = struct(timestamp=TEXT, level=TEXT, service=TEXT, message=TEXT, correlation_id=TEXT, user_id=TEXT, duration_ms=INT, status_code=INT, request_id=TEXT)

#: Schema by topic.
TOPICS = {
    "user-events": USERS,
    "transaction-events": TRANSACTIONS,
    "iot-sensor-data": IOT_SENSORS,
    "wearable-device-data": WEARABLES,
    "web-clickstream": CLICKSTREAM,
    "application-logs": LOGS,
}

#: What Spark's Kafka source yields.
ENVELOPE = struct(key=BinaryType(), value=BinaryType(), topic=TEXT, partition=INT, offset=LongType(), timestamp=TimestampType(), timestampType=INT)
