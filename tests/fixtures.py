"""Hand-built base tables (FIXTURES.md section 3), built in memory."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

AS_OF = "2024-06-30 12:00:00"
AS_OF_TS = dt.datetime(2024, 6, 30, 12, 0, 0)

CUSTOMERS_SCHEMA = ("customer_id long, first_name string, last_name string, email string, "
                    "segment string, region string, created_at timestamp_ntz")
PRODUCTS_SCHEMA = ("product_id long, product_name string, category string, subcategory string, "
                   "cost_price decimal(12,2), list_price decimal(12,2)")
ORDERS_SCHEMA = ("order_id long, customer_id long, product_id long, quantity int, "
                 "unit_price decimal(12,2), discount_pct decimal(5,2), order_date timestamp_ntz, "
                 "status string")


def customer(cid, created=dt.datetime(2024, 1, 1)):
    return (cid, f"First{cid}", f"Last{cid}", f"c{cid}@example.com", "SMB", "EUROPE", created)


def product(pid, category="Audio", subcategory="Headphones", cost="10.00", price="20.00"):
    return (pid, f"Product {pid}", category, subcategory, Decimal(cost), Decimal(price))


def order(oid, cid, pid=1, qty=1, price="100.00", disc="0.00", when=dt.datetime(2024, 6, 1),
          status="COMPLETED"):
    return (oid, cid, pid, qty, Decimal(price), None if disc is None else Decimal(disc), when,
            status)


def frames(spark, customers, products, orders):
    return (spark.createDataFrame(customers, CUSTOMERS_SCHEMA),
            spark.createDataFrame(products, PRODUCTS_SCHEMA),
            spark.createDataFrame(orders, ORDERS_SCHEMA))
