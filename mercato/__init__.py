"""mercato: retail order analytics expressed as Spark DataFrame plans.

Three base tables (customers, products, orders) feed three outputs:
hourly sales metrics (batch or incremental refresh), a customer lifetime
value table with recency/frequency/monetary scores, and a ranked product
category analysis, plus reports, data-quality checks and a run log.

Every query is a pure function ``DataFrames -> DataFrame``; the reference
time ``as_of`` is always a parameter.
"""

__all__ = ["session", "sources", "functions", "operators", "plans", "streaming"]
