"""Refreshing the hourly metrics: full, by differences, as a windowed stream, on demand."""

from mercato.streaming.refresh import (  # noqa: F401
    ORDERS_SCHEMA, IncrementalHourlyRefresh, order_stream, read_hourly, refresh_full,
)
