"""Sources and sinks: base-table bindings, external tables, writers."""

from mercato.sources.bindings import (  # noqa: F401
    RAW_TABLES, read_raw, customers_from, products_from, orders_from,
    orders_dense_from, run_steps_from, base_tables, load_base_tables,
)
