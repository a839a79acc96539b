"""Warehouse inputs derived from the driver's TPC-H-like tables.

The catalogs the operators expect are built by Spark from `part` and
`lineitem`, so every checked query grows with the tables:

* fresh catalog: one dataset per part; the title carries the hidden-table
  mark for some parts; the frequency label comes from the part size.
* stored catalog: parts that had a large line (quantity >= 49), stamped with
  their latest ship date, some with no date (never ingested properly).
* "now" is fixed so results are reproducible.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

AS_OF = "2001-09-01 00:00:00"

# Frequency label of a part: p_size % 9 indexes this list ('Irregular' is
# deliberately not a known label and falls to the default interval).
FREQUENCY_BY_SIZE = ["Daily", "Weekly", "Bi-weekly", "Monthly", "Quarterly",
                     "Semi-annual", "Annual", "Occasional", "Irregular"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fresh_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    idx = F.col("p_size") % 9
    freq = None
    for i, label in enumerate(FREQUENCY_BY_SIZE):
        freq = F.when(idx == i, F.lit(label)) if freq is None else freq.when(idx == i, F.lit(label))
    hidden = F.when(F.col("p_partkey") % 11 == 0, F.lit(" INVISIBLE")).otherwise(F.lit(""))
    return p.select(
        F.col("p_partkey").alias("product_id"),
        F.concat(F.col("p_name"), F.lit(" / "), F.col("p_type"), hidden).alias("title"),
        F.col("p_brand").alias("subject"),
        freq.alias("frequency"),
        F.col("p_partkey").alias("ordinal"),
    )


def stored_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").where(F.col("l_quantity") >= 49)
    last = li.groupBy("l_partkey").agg(F.max("l_shipdate").alias("d"))
    return last.select(
        F.col("l_partkey").alias("product_id"),
        F.when(F.col("l_partkey") % 7 == 0, F.lit(None)).otherwise(F.col("d")).alias("last_ingestion_date"),
    )


FRESH_SQL = """
select p_partkey as product_id,
       concat(p_name, ' / ', p_type, case when p_partkey % 11 = 0 then ' INVISIBLE' else '' end) as title,
       p_brand as subject,
       case p_size % 9 when 0 then 'Daily' when 1 then 'Weekly' when 2 then 'Bi-weekly'
            when 3 then 'Monthly' when 4 then 'Quarterly' when 5 then 'Semi-annual'
            when 6 then 'Annual' when 7 then 'Occasional' else 'Irregular' end as frequency,
       p_partkey as ordinal
from part
"""

STORED_SQL = """
select l_partkey as product_id,
       case when l_partkey % 7 = 0 then null else max(l_shipdate) end as last_ingestion_date
from lineitem where l_quantity >= 49 group by l_partkey
"""

DAYS_SQL = """case {f} when 'Daily' then 1 when 'Weekly' then 7 when 'Bi-weekly' then 14
  when 'Monthly' then 30 when 'Quarterly' then 90 when 'Semi-annual' then 180
  when 'Annual' then 365 when 'Occasional' then 180 else 180 end"""

CTES = f"with fresh as ({FRESH_SQL}), stored as ({STORED_SQL})"
