"""The three base tables, bound to the star-schema test tables.

``customers``, ``products`` and ``orders`` are the logical sources every
query reads.  In production they are external tables (see ``catalog``);
for the bundled test data they are derived from the TPC-H-like tables by
the bindings below (FIXTURES.md section 2).  Every binding is a lazy
DataFrame, so Catalyst prunes columns and pushes filters into the scans.

Orders are one row per order line: ``lineitem`` joined to ``orders`` (order
header: customer, date, status) and ``part`` (list price).  That is a join
of the two largest tables; a pipeline that runs several queries should
``stage_orders`` once (``sources.catalog``) and read the staged table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mercato.functions.money import MONEY, PCT

RAW_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels",
    "conversations",
)

# Fixed values of the test-data binding (FIXTURES.md section 2).
CREATED_AT_ORIGIN = "1992-01-01 00:00:00"   # customers.created_at = origin + (custkey*13) % 1000 days
CREATED_AT_STRIDE = 13
CREATED_AT_SPAN_DAYS = 1000
ORDER_SECOND_STRIDE = 37                     # order_date = o_orderdate + (orderkey*37) % 86400 s
DENSE_ORIGIN = "2001-07-01 00:00:00"         # orders_dense: origin + (orderkey*7919) % 48 hours
DENSE_STRIDE = 7919
DENSE_SPAN_HOURS = 48
COST_RATIO = 0.6                             # cost_price = list price * 0.6
LINE_SPLIT = "spark.mercato.lineSplit"
TEST_AS_OF = "2001-08-02 00:00:00"           # one day after the newest order date
RUN_STEPS_AS_OF = "2024-01-31 00:00:00"      # run-step window starts 2024-01-30 00:00:00


def read_raw(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def customers_from(customer: DataFrame, nation: DataFrame, region: DataFrame) -> DataFrame:
    """customers(customer_id, first_name, last_name, email, segment, region, created_at)."""
    # nation (25 rows) and region (5 rows) are fixed-size code tables.
    geo = F.broadcast(
        nation.join(F.broadcast(region), nation.n_regionkey == region.r_regionkey)
        .select("n_nationkey", "r_name")
    )
    origin = F.to_timestamp_ntz(F.lit(CREATED_AT_ORIGIN))
    return (
        customer.join(geo, customer.c_nationkey == geo.n_nationkey)
        .select(
            F.col("c_custkey").alias("customer_id"),
            F.split_part("c_name", F.lit("#"), F.lit(1)).alias("first_name"),
            F.split_part("c_name", F.lit("#"), F.lit(2)).alias("last_name"),
            F.concat(F.lower("c_name"), F.lit("@example.com")).alias("email"),
            F.col("c_mktsegment").alias("segment"),
            F.col("r_name").alias("region"),
            F.timestamp_add(
                "DAY",
                ((F.col("c_custkey") * CREATED_AT_STRIDE) % CREATED_AT_SPAN_DAYS).cast("int"),
                origin,
            ).alias("created_at"),
        )
    )


def products_from(part: DataFrame) -> DataFrame:
    """products(product_id, product_name, category, subcategory, cost_price, list_price)."""
    return part.select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        *_product_columns(_cost_price()),
        F.col("p_retailprice").cast(MONEY).alias("list_price"),
    )


def _status(orderstatus: str = "o_orderstatus", linestatus: str = "l_linestatus"):
    return (
        F.when(F.col(orderstatus) == "F", F.lit("COMPLETED"))
        .when(F.col(orderstatus) == "P", F.lit("PENDING"))
        .when((F.col(orderstatus) == "O") & (F.col(linestatus) == "F"), F.lit("SHIPPED"))
        .when(F.col(orderstatus) == "O", F.lit("PROCESSING"))
    )


def _order_lines(lineitem: DataFrame, orders: DataFrame, part: DataFrame, order_date) -> DataFrame:
    # dates are made once per order and decimals once per product, not per line
    return (
        lineitem.select("l_orderkey", "l_partkey", "l_quantity", "l_discount", "l_linestatus")
        .join(orders.select("o_orderkey", "o_custkey", order_date.alias("order_date"), "o_orderstatus"),
              F.col("l_orderkey") == F.col("o_orderkey"))
        .join(part.select("p_partkey", "p_type", "p_brand", F.col("p_retailprice").cast(MONEY).alias("p_price"),
                          _cost_price().alias("p_cost")),
              F.col("l_partkey") == F.col("p_partkey"))
    )


def _order_columns():
    return [
        F.col("l_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_quantity").cast("int").alias("quantity"),
        F.col("p_price").alias("unit_price"),
        (F.col("l_discount") * F.lit(100)).cast(PCT).alias("discount_pct"),
        F.col("order_date"),
        _status().alias("status"),
    ]


def _cost_price():
    return (F.col("p_retailprice") * F.lit(COST_RATIO)).cast(MONEY)


def _product_columns(cost):
    return [F.col("p_type").alias("category"), F.col("p_brand").alias("subcategory"), cost.alias("cost_price")]


def _order_date():
    return F.timestamp_add(
        "SECOND", ((F.col("o_orderkey") * ORDER_SECOND_STRIDE) % 86400).cast("int"),
        F.col("o_orderdate"))


def orders_from(lineitem: DataFrame, orders: DataFrame, part: DataFrame) -> DataFrame:
    """orders(order_id, customer_id, product_id, quantity, unit_price,
    discount_pct, order_date, status), one row per order line."""
    return _order_lines(lineitem, orders, part, _order_date()).select(*_order_columns())


def sales_lines_from(lineitem: DataFrame, orders: DataFrame, part: DataFrame) -> DataFrame:
    """Order lines with their product's category, subcategory and cost_price: ``orders``
    joined to ``products``, at the price of one join of ``part`` instead of two."""
    return _order_lines(lineitem, orders, part, _order_date()).select(*_order_columns(), *_product_columns(F.col("p_cost")))


def orders_dense_from(lineitem: DataFrame, orders: DataFrame, part: DataFrame) -> DataFrame:
    """Same rows, dates packed into 48 hours: hourly groups with many lines."""
    order_date = F.timestamp_add(
        "HOUR", ((F.col("o_orderkey") * DENSE_STRIDE) % DENSE_SPAN_HOURS).cast("int"),
        F.to_timestamp_ntz(F.lit(DENSE_ORIGIN)))
    return _order_lines(lineitem, orders, part, order_date).select(*_order_columns())


def run_steps_from(events: DataFrame) -> DataFrame:
    """Run-step records (run_id, name, started_at, completed_at) from events."""
    return events.select(
        F.col("event_id").cast("string").alias("run_id"),
        F.col("event_type").alias("name"),
        F.col("ts").alias("started_at"),
        F.timestamp_add("SECOND", F.floor("value").cast("int"), F.col("ts")).alias("completed_at"),
    )


def base_tables(raw: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """{customers, products, orders, sold_orders, sales_lines, sold_lines} from a dict of
    raw DataFrames; the last two carry the product columns."""
    # lines that can be COMPLETED or SHIPPED: the predicate reaches the scan, which
    # the status, an expression over two tables, does not
    sold = raw["orders"].where(F.col("o_orderstatus").isin("F", "O"))
    return {
        "customers": customers_from(raw["customer"], raw["nation"], raw["region"]),
        "products": products_from(raw["part"]),
        "orders": orders_from(raw["lineitem"], raw["orders"], raw["part"]),
        "sold_orders": orders_from(raw["lineitem"], sold, raw["part"]),
        "sales_lines": sales_lines_from(raw["lineitem"], raw["orders"], raw["part"]),
        "sold_lines": sales_lines_from(raw["lineitem"], sold, raw["part"]),
    }


def load_base_tables(spark: SparkSession, sf_dir: str,
                     register_views: bool = False) -> dict[str, DataFrame]:
    """Read the raw test tables of ``sf_dir`` and bind the base tables.

    With ``register_views`` the three are also temp views, so SQL users can
    write ``FROM orders`` (note: that name shadows nothing in the catalog;
    raw tables are not registered).

    ``lineitem`` stored as few large row groups is read by as few tasks.  Where that is
    fewer than the cluster runs, the session setting LINE_SPLIT deals its rows to that many
    partitions by order before they are joined; large tables need none.
    """
    raw = {name: read_raw(spark, sf_dir, name)
           for name in ("region", "nation", "customer", "part", "orders", "lineitem")}
    split = spark.conf.get(LINE_SPLIT, None)
    if split:
        raw["lineitem"] = raw["lineitem"].repartition(int(split), "l_orderkey")
    tables = base_tables(raw)
    if register_views:
        for name in ("customers", "products", "orders"):
            tables[name].createOrReplaceTempView(name)
    return tables


__all__ = [
    "RAW_TABLES", "TEST_AS_OF", "RUN_STEPS_AS_OF", "read_raw", "customers_from",
    "products_from", "orders_from", "sales_lines_from", "LINE_SPLIT", "orders_dense_from", "run_steps_from",
    "base_tables", "load_base_tables",
]
