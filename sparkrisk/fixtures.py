"""Test inputs derived from the driver's tables (see FIXTURES.md).

The two statements are plain SQL that runs unchanged in Spark SQL and DuckDB, so every
query and its oracle start from the same rows. In Spark they are ordinary lazy views over
the parquet scans: Catalyst prunes the columns each query needs and pushes filters down.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

FX_INSPECTIONS_SQL = """
SELECT CAST(l.l_orderkey * 10 + l.l_linenumber AS BIGINT) AS _id,
       CASE WHEN o.o_custkey % 97 = 0 THEN NULL ELSE CAST(o.o_custkey AS STRING) END AS property_id,
       o.o_orderdate AS resultdttm,
       date_trunc('year', o.o_orderdate) AS issdttm,
       CASE WHEN o.o_orderkey % 41 = 0 THEN 'not-a-date' ELSE CAST(o.o_orderdate AS STRING) END AS resultdttm_raw,
       r.r_name AS state, c.c_name AS location,
       substr(c.c_mktsegment, 1, 2) AS licensecat, o.o_orderpriority AS descript,
       CASE WHEN c.c_custkey % 11 = 0 THEN NULL WHEN c.c_custkey % 13 = 0 THEN 'Downtown/Financial'
            WHEN c.c_custkey % 7 = 0 THEN 'New  Town' ELSE n.n_name END AS city,
       CASE WHEN c.c_custkey % 9 = 0 THEN NULL ELSE lpad(CAST(c.c_nationkey AS STRING), 5, '0') END AS zip,
       CASE o.o_orderstatus WHEN 'F' THEN 'HE_Fail' WHEN 'P' THEN 'HE_Pass' ELSE 'HE_Filed' END AS result,
       CASE WHEN l.l_linenumber = 7 THEN NULL WHEN l.l_returnflag = 'A' THEN 'Fail'
            WHEN l.l_returnflag = 'R' THEN 'Pass' ELSE ' ' END AS violstatus,
       CASE WHEN l.l_quantity = 50 THEN '1919' WHEN l.l_quantity = 49 THEN NULL
            WHEN l.l_linestatus = 'F' THEN '***' ELSE '*' END AS viollevel
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey
JOIN region r ON n.n_regionkey = r.r_regionkey
"""

FX_ESTABLISHMENTS_SQL = """
SELECT CAST(c.c_custkey AS INT) AS _id, CAST(c.c_custkey AS STRING) AS Property_ID,
       c.c_name AS BusinessName, r.r_name AS State, substr(c.c_mktsegment, 1, 2) AS LICENSECAT,
       c.c_mktsegment AS DESCRIPT,
       CASE WHEN c.c_custkey % 11 = 0 THEN '' WHEN c.c_custkey % 13 = 0 THEN 'Downtown/Financial'
            WHEN c.c_custkey % 17 = 0 THEN ' ' WHEN c.c_custkey % 7 = 0 THEN 'New  Town' ELSE n.n_name END AS CITY,
       CASE WHEN c.c_custkey % 9 = 0 THEN NULL ELSE lpad(CAST(c.c_nationkey AS STRING), 5, '0') END AS ZIP
FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey
"""

# The as-of date used for scoring, after the last order date.
AS_OF = "2001-09-01"

# CTE heads for DuckDB oracles.
CTE_INSPECTIONS = f"fx_inspections AS ({FX_INSPECTIONS_SQL})"
CTE_ESTABLISHMENTS = f"fx_establishments AS ({FX_ESTABLISHMENTS_SQL})"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{str(sf_dir).rstrip('/')}/{name}.parquet")


def register(spark: SparkSession, sf_dir: str, names=TABLES) -> None:
    """Register the driver tables as temp views under their own names."""
    for n in names:
        table(spark, sf_dir, n).createOrReplaceTempView(n)


def fx_inspections(spark: SparkSession, sf_dir: str) -> DataFrame:
    register(spark, sf_dir, ("lineitem", "orders", "customer", "nation", "region"))
    # date_trunc gives a session-zoned timestamp; keep wall-clock time like the source.
    return spark.sql(FX_INSPECTIONS_SQL).withColumn("issdttm", F.col("issdttm").cast("timestamp_ntz"))


def fx_establishments(spark: SparkSession, sf_dir: str) -> DataFrame:
    register(spark, sf_dir, ("customer", "nation", "region"))
    return spark.sql(FX_ESTABLISHMENTS_SQL)
