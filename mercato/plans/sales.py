"""Hourly sales metrics and the reports on top of them, plus base probes.

Scale notes
* ``hourly_sales_metrics`` has two exact distinct counts.  Planned in one group-by with
  the sums, each line becomes three rows that carry the buffers of all of them.  So the keys are made
  distinct apart, as narrow rows (group, order_id / customer_id), and their counts join
  the lines in the one group-by of the sums.  Even an hour holding a third of all lines is
  spread over many tasks before the final per-group merge.
* The hour bucket is built from NTZ fields (no session-zone dependence).
* The daily summary and margin report read the (exact, decimal) hourly
  table, so re-aggregating it is exact and cheap.
* Top-k reports are ``orderBy + limit`` -> TakeOrderedAndProject: each
  partition keeps k rows, no global sort.
"""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.functions.money import exact_sum, halves, minor_units, ratio, round_to
from mercato.functions.timefn import hour_floor
from mercato.operators.arrow_groups import ROWS, added_up, grouped_parts
from mercato.session import task_slots
from mercato.sources import files

STATUSES = ("COMPLETED", "PENDING", "PROCESSING", "SHIPPED")

HOURLY_COLUMNS = (
    "sales_hour", "category", "subcategory", "total_orders", "unique_customers",
    "units_sold", "gross_revenue", "net_revenue", "total_discounts", "avg_order_value",
    "avg_units_per_order", "total_cost", "gross_profit", "completed_orders",
    "pending_orders", "processing_orders", "shipped_orders",
)


GROUP = ["sales_hour", "category", "subcategory"]
TASK_BYTES = 8 << 20  # of the input's files; some half a million lines
SALTS = 8
ARROW_LINES = ROWS // 2


def line_measures() -> dict:
    """Name -> (expression, type): what a joined line adds to its group, in whole minor
    units, so that sums are exact."""
    q, price = F.col("quantity").cast("long"), minor_units("unit_price")
    gross, pct = q * price, minor_units("discount_pct")
    return {
        "m_units": (q, "long"), "m_gross": (gross, "long"), "m_net": (gross * (F.lit(10000) - pct), "long"),
        "m_discount": (gross * pct, "long"), "m_cost": (q * minor_units("cost_price"), "long"),
    } | {f"m_{x.lower()}": (F.when(F.col("status") == x, F.lit(1)), "long") for x in STATUSES}


def hourly_metrics_of(lines: DataFrame, group: list[str], orders, customers, measured: bool = False) -> DataFrame:
    """The metrics of joined lines per ``group``; ``orders`` and ``customers`` are the
    aggregates of the distinct counts.  ``measured``: the lines carry their measures already."""
    m = {c: F.col(c) if measured else e for c, (e, _) in line_measures().items()}
    gross, net, cost = exact_sum(m["m_gross"], 2), exact_sum(m["m_net"], 6), exact_sum(m["m_cost"], 2)
    return lines.groupBy(*group).agg(
        orders.alias("total_orders"),
        customers.alias("unique_customers"),
        F.sum(m["m_units"]).alias("units_sold"),
        gross.alias("gross_revenue"),
        net.alias("net_revenue"),
        exact_sum(m["m_discount"], 6).alias("total_discounts"),
        ratio(gross, F.count(m["m_gross"])).alias("avg_order_value"),
        ratio(F.sum(m["m_units"]), F.count(m["m_units"])).alias("avg_units_per_order"),
        cost.alias("total_cost"),
        (net - cost).alias("gross_profit"),
        *[F.count(m[f"m_{x.lower()}"]).alias(f"{x.lower()}_orders") for x in STATUSES],
    )


def with_products(orders: DataFrame, products: DataFrame) -> DataFrame:
    """Order lines with category, subcategory and cost_price; lines of unknown products drop out."""
    return orders.join(products.select("product_id", "category", "subcategory", "cost_price"), "product_id")


def hourly_of_lines(lines: DataFrame, tasks: int | None = None) -> DataFrame:
    """Hourly metrics of lines that carry their product's columns.

    ``tasks``: how many partitions the lines are dealt to, by default one per TASK_BYTES of the
    files behind them.  The hash tables of a task grow with its lines, and a count of
    partitions that doesn't grow with the table would let them grow as well.
    """
    return hourly_of_timed(lines.withColumn("sales_hour", hour_floor("order_date")), tasks or input_tasks(lines))


def hourly_of_timed(timed: DataFrame, tasks: int | None = None) -> DataFrame:
    """``hourly_of_lines`` of lines that carry their hour."""
    measures = line_measures()
    counts = distinct_counts(timed, tasks)
    # a group's lines meet in a few tasks, so that the largest group is no single task's work
    dealt = timed.repartition(tasks, *GROUP, F.pmod(F.xxhash64("order_id"), F.lit(SALTS))) if tasks else timed
    every = dealt.select(*GROUP, *[F.lit(None).cast("long").alias(c) for c in counts.columns if c not in GROUP],
                         *[e.cast(t).alias(c) for c, (e, t) in measures.items()])
    both = every.unionByName(counts.withColumns({c: F.lit(None).cast(t) for c, (_, t) in measures.items()}))
    return hourly_metrics_of(both, GROUP, F.coalesce(F.sum("orders_once"), F.lit(0)).cast("long"),
                             F.coalesce(F.sum("customers_once"), F.lit(0)).cast("long"), measured=True)


def hourly_by_arrow(timed: DataFrame, tasks: int) -> DataFrame:
    """``hourly_of_timed`` with one shuffle of the lines, dealt to ``tasks`` tasks by group; best with
    ARROW_LINES lines a task."""
    measures = line_measures()
    keys, sums, counts = ["order_id", "customer_id"], [c for c in measures if c[2:].upper() not in STATUSES], \
        [c for c in measures if c[2:].upper() in STATUSES]
    lines = timed.select(*GROUP, *keys, *[e.cast(t).alias(c) for c, (e, t) in measures.items()])
    s = added_up(grouped_parts(lines, GROUP, keys, sums, counts, tasks), GROUP, keys)
    scales = {"m_units": 0, "m_gross": 2, "m_net": 6, "m_discount": 6, "m_cost": 2}
    total = {c: halves(F.col(f"{c}_hi"), F.col(f"{c}_lo"), scales[c]) for c in sums}
    units = total["m_units"].cast("long")
    return s.select(
        *GROUP, F.col("order_id").alias("total_orders"), F.col("customer_id").alias("unique_customers"),
        units.alias("units_sold"), total["m_gross"].alias("gross_revenue"), total["m_net"].alias("net_revenue"),
        total["m_discount"].alias("total_discounts"), ratio(total["m_gross"], F.col("m_gross_n")).alias("avg_order_value"),
        ratio(units, F.col("m_units_n")).alias("avg_units_per_order"), total["m_cost"].alias("total_cost"),
        (total["m_net"] - total["m_cost"]).alias("gross_profit"),
        *[F.coalesce(f"m_{x.lower()}_n", F.lit(0)).cast("long").alias(f"{x.lower()}_orders") for x in STATUSES])


def distinct_counts(lines: DataFrame, tasks: int | None = None) -> DataFrame:
    """(group, orders_once, customers_once): exact distinct counts, from narrow rows."""
    # unpivot is an Expand: no array of structs for each line
    keys = (lines.unpivot(GROUP, ["order_id", "customer_id"], "kind", "key").where("key IS NOT NULL")
            .select(*GROUP, (F.col("kind") == "order_id").alias("is_order"), "key"))
    if tasks:
        keys = keys.repartition(tasks, *GROUP, "is_order", "key")
    return keys.distinct().groupBy(*GROUP).agg(F.count_if("is_order").alias("orders_once"),
                                               F.count_if(~F.col("is_order")).alias("customers_once"))


def input_tasks(df: DataFrame, task_bytes: int = TASK_BYTES) -> int | None:
    """Partitions for the rows of ``df`` by the size of the files behind it; None without files."""
    size = sum(files.size(df.sparkSession, unquote(f)) for f in df.inputFiles())
    return max(task_slots(df.sparkSession), -(-size // task_bytes)) if size else None


def hourly_sales_metrics(orders: DataFrame, products: DataFrame) -> DataFrame:
    """Per (sales_hour, category, subcategory), all statuses.

    Money columns are exact decimals; averages are per order *line*.
    """
    return hourly_of_lines(with_products(orders, products))


def hourly_margin_top(hourly: DataFrame, n: int = 20) -> DataFrame:
    """Latest hours first, then by revenue; margin = profit / net revenue."""
    return (
        hourly.select(
            "sales_hour", "category", "subcategory", "total_orders", "unique_customers",
            "gross_revenue", "gross_profit",
            round_to(ratio("gross_profit", "net_revenue") * F.lit(100.0), 2)
            .alias("profit_margin_pct"),
        )
        .orderBy(F.col("sales_hour").desc_nulls_last(),
                 F.col("gross_revenue").desc_nulls_last(), "category", "subcategory")
        .limit(n)
    )


def daily_sales_summary(hourly: DataFrame) -> DataFrame:
    """Hours rolled up to days.  ``daily_customers`` sums per-hour distinct
    customers (a customer buying in two hours counts twice), as in the
    source report.  ``sales_date`` is the day's midnight as TIMESTAMP_NTZ,
    the one time type every output of this library carries."""
    day = F.to_date("sales_hour").cast("timestamp_ntz")
    return (
        hourly.groupBy(day.alias("sales_date"))
        .agg(
            F.sum("total_orders").cast("long").alias("daily_orders"),
            F.sum("unique_customers").cast("long").alias("daily_customers"),
            F.sum("gross_revenue").alias("daily_revenue"),
            F.sum("gross_profit").alias("daily_profit"),
        )
        .orderBy(F.col("sales_date").desc_nulls_last())
    )


def base_row_counts(customers: DataFrame, products: DataFrame, orders: DataFrame) -> DataFrame:
    """One row per base table with its row count (UNION ALL of counts)."""
    def count_of(name: str, df: DataFrame) -> DataFrame:
        return df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count")
    return (count_of("EXT_CUSTOMERS", customers)
            .unionByName(count_of("EXT_PRODUCTS", products))
            .unionByName(count_of("EXT_ORDERS", orders)))


def _latest_first(df: DataFrame) -> DataFrame:
    # order_id / product_id / quantity etc. make the order total: an order
    # line is not unique on (order_id, product_id) alone in the test data.
    return df.orderBy(F.col("order_date").desc_nulls_last(), "order_id", "product_id",
                      "quantity", "unit_price", "discount_pct", "status", "customer_id")


def recent_orders(orders: DataFrame, n: int = 5) -> DataFrame:
    return _latest_first(orders).limit(n)


def preview_orders(orders: DataFrame, n: int = 5) -> DataFrame:
    """Row preview: any ``n`` rows (order the table first if they must repeat)."""
    return orders.limit(n)


def recent_order_details(orders: DataFrame, customers: DataFrame, products: DataFrame,
                         n: int = 10) -> DataFrame:
    """Latest order lines with customer and product attributes.

    Inner joins drop lines whose customer or product is unknown, so the
    lines are first semi-joined to the dimension *keys* (key-only joins,
    no row multiplication), then the top-k is taken, and only k rows are
    joined to the full dimension rows.
    """
    known = (orders
             .join(customers.select("customer_id"), "customer_id", "left_semi")
             .join(products.select("product_id"), "product_id", "left_semi"))
    top = _latest_first(known).limit(n)
    return (
        top.join(customers, "customer_id").join(products, "product_id")
        .select(
            F.concat(F.col("first_name"), F.lit(" "), F.col("last_name")).alias("customer_name"),
            "segment", "product_name", "category", "quantity", "unit_price", "order_date",
            "order_id", "product_id",
        )
        .orderBy(F.col("order_date").desc_nulls_last(), "order_id", "product_id",
                 "quantity", "unit_price")
    )
