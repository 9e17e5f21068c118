"""The sales clean-up and report over the star tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textlake.operators import cleaning
from textlake.plans.views import table
from textlake.session import work_path
from textlake.sources.writers import write_parquet


def raw_sales(spark, folder) -> DataFrame:
    """One sale per order line, with the flaws a raw export has.

    An order number and a line number together are not unique, so some sales
    come several times.
    """
    lines = table(spark, folder, "lineitem")
    orders = table(spark, folder, "orders")
    customers = table(spark, folder, "customer")
    nations = table(spark, folder, "nation")
    regions = table(spark, folder, "region")
    parts = table(spark, folder, "part")
    return (
        lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(parts, F.col("l_partkey") == F.col("p_partkey"))
        .join(customers, F.col("o_custkey") == F.col("c_custkey"))
        .join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(regions, F.col("n_regionkey") == F.col("r_regionkey"))
        .selectExpr(
            """CASE WHEN l_tax <> 0.08 OR l_discount <> 0.1
               THEN l_orderkey * 10 + l_linenumber END AS order_id""",
            """CASE WHEN l_discount = 0.09 THEN '2026-02-30'
               ELSE cast(cast(o_orderdate AS date) AS string) END AS order_date""",
            "c_name AS customer",
            """CASE WHEN l_returnflag = 'A' THEN concat('  ', r_name, ' ')
               ELSE r_name END AS region""",
            """CASE WHEN l_returnflag = 'R' THEN concat(lower(p_type), ' ')
               ELSE p_type END AS category""",
            """CASE WHEN l_tax = 0.01 THEN 'Completed'
               WHEN o_orderstatus = 'F' THEN 'completed'
               WHEN o_orderstatus = 'P' AND l_tax <> 0.02 THEN ' pending'
               WHEN o_orderstatus = 'O' THEN 'cancelled' END AS status""",
            """CASE WHEN l_tax = 0.07 THEN NULL WHEN l_discount = 0.0 THEN -p_retailprice
               ELSE p_retailprice END AS amount""",
            "cast(l_quantity AS int) AS quantity",
        )
    )


def sales_clean(spark, folder):
    return cleaning.clean_sales(raw_sales(spark, folder)).withColumn(
        "order_date", F.col("order_date").cast("string")
    )


def sales_by_category_region(spark, folder):
    return cleaning.sales_report(cleaning.clean_sales(raw_sales(spark, folder)))


def clean_metrics(spark, folder):
    """Rows before and after the clean-up, counted while it is written."""
    raw, seen_raw = cleaning.count_rows(raw_sales(spark, folder), "raw")
    cleaned, seen_cleaned = cleaning.count_rows(cleaning.clean_sales(raw), "cleaned")
    write_parquet(cleaned, work_path(spark, "sales"))
    return spark.createDataFrame(
        [(seen_raw.get["rows"], seen_cleaned.get["rows"])], "raw_rows bigint, cleaned_rows bigint"
    )


SALES_SQL = """
WITH raw_sales AS (
  SELECT CASE WHEN l_tax <> 0.08 OR l_discount <> 0.1
           THEN l_orderkey * 10 + l_linenumber END AS order_id,
    CASE WHEN l_discount = 0.09 THEN '2026-02-30'
         ELSE CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS order_date,
    c_name AS customer,
    CASE WHEN l_returnflag = 'A' THEN '  ' || r_name || ' ' ELSE r_name END AS region,
    CASE WHEN l_returnflag = 'R' THEN lower(p_type) || ' ' ELSE p_type END AS category,
    CASE WHEN l_tax = 0.01 THEN 'Completed'
         WHEN o_orderstatus = 'F' THEN 'completed'
         WHEN o_orderstatus = 'P' AND l_tax <> 0.02 THEN ' pending'
         WHEN o_orderstatus = 'O' THEN 'cancelled' END AS status,
    CASE WHEN l_tax = 0.07 THEN NULL WHEN l_discount = 0.0 THEN -p_retailprice
         ELSE p_retailprice END AS amount,
    CAST(l_quantity AS INTEGER) AS quantity
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  JOIN part ON l_partkey = p_partkey JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
tidy AS (
  SELECT order_id, TRY_CAST(order_date AS DATE) AS order_date, trim(customer) AS customer,
    trim(region) AS region, lower(trim(category)) AS category, trim(status) AS status,
    amount, quantity FROM raw_sales),
first AS (
  SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY order_date, customer NULLS FIRST,
    region NULLS FIRST, category NULLS FIRST, status NULLS FIRST, amount, quantity) AS place
  FROM tidy WHERE order_id IS NOT NULL AND order_date IS NOT NULL
    AND amount IS NOT NULL AND quantity IS NOT NULL),
cleaned AS (
  SELECT order_id, CAST(order_date AS VARCHAR) AS order_date, customer, region, category, status,
    amount, quantity, round(amount * quantity, 2) AS revenue
  FROM first WHERE place = 1 AND status IN ('completed', 'pending') AND amount > 0)
"""

QUERIES = {
    "sales_by_category_region": sales_by_category_region,
    "sales_clean": sales_clean,
    "clean_metrics": clean_metrics,
}

ORACLES = {
    "sales_by_category_region": SALES_SQL
    + """SELECT category, region, count(*) AS order_count,
           CAST(sum(CAST(revenue AS DECIMAL(18, 2))) AS DOUBLE) AS total_revenue,
           CAST((CAST(200 * sum(CAST(amount AS DECIMAL(18, 2))) AS HUGEINT) + count(*))
             // (2 * count(*)) AS DOUBLE) / 100 AS avg_amount,
           CAST(sum(quantity) AS BIGINT) AS total_quantity
         FROM cleaned GROUP BY category, region""",
    "sales_clean": SALES_SQL + "SELECT * FROM cleaned",
    "clean_metrics": SALES_SQL
    + """SELECT (SELECT count(*) FROM raw_sales) AS raw_rows,
                (SELECT count(*) FROM cleaned) AS cleaned_rows""",
}
