"""Projection, filter, group and window queries over customers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textlake.operators import cleaning
from textlake.plans.views import table
from textlake.sources.readers import integers


def people(spark, folder) -> DataFrame:
    """Customers as ``id, name, age, city``, all text, some ages and cities missing."""
    segment = F.col("c_mktsegment")
    return (
        table(spark, folder, "customer")
        .join(table(spark, folder, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            F.col("c_custkey").cast("string").alias("id"),
            F.col("c_name").alias("name"),
            F.when(segment == "MACHINERY", F.lit(None))
            .when(segment == "FURNITURE", "unknown")
            .when(segment == "HOUSEHOLD", (F.col("c_acctbal").cast("decimal(12,2)") / 100).cast("string"))
            .otherwise(F.floor(F.col("c_acctbal") / 100).cast("string"))
            .alias("age"),
            F.when(segment != "BUILDING", F.col("n_name")).alias("city"),
        )
    )


PEOPLE_SQL = """
WITH people AS (
  SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS name,
    CASE WHEN c_mktsegment = 'MACHINERY' THEN NULL
         WHEN c_mktsegment = 'FURNITURE' THEN 'unknown'
         WHEN c_mktsegment = 'HOUSEHOLD'
           THEN CAST(CAST(CAST(c_acctbal AS DECIMAL(12, 2)) / 100 AS DECIMAL(18, 6)) AS VARCHAR)
         ELSE CAST(CAST(floor(c_acctbal / 100) AS BIGINT) AS VARCHAR) END AS age,
    CASE WHEN c_mktsegment <> 'BUILDING' THEN n_name END AS city
  FROM customer JOIN nation ON c_nationkey = n_nationkey)
"""


def sql_view_query(spark, folder):
    people(spark, folder).createOrReplaceTempView("people")
    return spark.sql(
        """SELECT name, age FROM people WHERE city = 'NATION_3'
           ORDER BY try_cast(age AS INT) DESC, name"""
    )


def range_source(spark, folder):
    """All order numbers up to the largest, with the number of lines of each."""
    last = table(spark, folder, "orders").agg(F.max("o_orderkey").alias("last")).first()["last"]
    lines = (
        table(spark, folder, "lineitem")
        .groupBy(F.col("l_orderkey").alias("id"))
        .agg(F.count("*").alias("n"))
    )
    return (
        integers(spark, 0, last + 1)
        .join(lines, "id", "left")
        .select("id", F.coalesce("n", F.lit(0)).cast("bigint").alias("n_lines"))
    )


QUERIES = {
    "select_filter": lambda s, d: cleaning.older_than(people(s, d), 28),
    "people_clean": lambda s, d: cleaning.clean_people(people(s, d)),
    "group_count_ordered": lambda s, d: cleaning.count_per_group(people(s, d), "city"),
    "topn_per_group": lambda s, d: cleaning.oldest_per_city(people(s, d), 2),
    "sql_view_query": sql_view_query,
    "range_source": range_source,
}

ORACLES = {
    "select_filter": PEOPLE_SQL
    + "SELECT name, age FROM people WHERE trunc(TRY_CAST(age AS DOUBLE)) > 28",
    "people_clean": PEOPLE_SQL
    + """SELECT id, name, age, coalesce(city, 'Unknown') AS city
         FROM people WHERE trunc(TRY_CAST(age AS DOUBLE)) >= 0""",
    "group_count_ordered": PEOPLE_SQL
    + 'SELECT city, count(*) AS "count" FROM people GROUP BY city',
    "topn_per_group": PEOPLE_SQL
    + """SELECT * FROM (
           SELECT id, name, age, city, CAST(row_number() OVER (PARTITION BY city
             ORDER BY trunc(TRY_CAST(age AS DOUBLE)) DESC NULLS LAST, CAST(id AS BIGINT))
             AS INTEGER) AS rank
           FROM people) WHERE rank <= 2""",
    "sql_view_query": PEOPLE_SQL + "SELECT name, age FROM people WHERE city = 'NATION_3'",
    "range_source": """
        SELECT r.id, count(l.l_orderkey) AS n_lines
        FROM (SELECT unnest(range(0, (SELECT max(o_orderkey) + 1 FROM orders))) AS id) r
        LEFT JOIN lineitem l ON l.l_orderkey = r.id GROUP BY r.id""",
}
