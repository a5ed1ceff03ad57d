"""Order lines as they arrive, and the calendar units that tables are kept in."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DecimalType, IntegerType, LongType, StringType, StructField, StructType, TimestampNTZType,
)

ORDERS_SCHEMA = StructType([
    StructField("order_id", LongType()),
    StructField("customer_id", LongType()),
    StructField("product_id", LongType()),
    StructField("quantity", IntegerType()),
    StructField("unit_price", DecimalType(12, 2)),
    StructField("discount_pct", DecimalType(5, 2)),
    StructField("order_date", TimestampNTZType()),
    StructField("status", StringType()),
])

UNITS = {"day": "yyyy-MM-dd", "month": "yyyy-MM"}
UNDATED = "undated"  # unit of the lines without a date


def unit_of(c, unit: str):
    return F.coalesce(F.date_format(c, UNITS[unit]), F.lit(UNDATED))


def order_stream(spark: SparkSession, location: str, files_per_trigger: int | None = 1) -> DataFrame:
    """Order-line files arriving in ``location`` as a stream; with None a batch takes
    all that has arrived."""
    reader = spark.readStream.schema(ORDERS_SCHEMA)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(location)
