"""Inventories: dataset folders in the warehouse and registered tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.names import folder_product_id
from ..schemas import FOLDERS
from . import fs


def folder_inventory(spark: SparkSession, data_root: str) -> DataFrame:
    """Every immediate sub-folder of the data root (non-dataset folders
    such as `catalog` included), with its listing position."""
    names = fs.list_dirs(spark, data_root)
    return spark.createDataFrame([(n, i) for i, n in enumerate(names)], FOLDERS)


def existing_ids(folders: DataFrame, folder: str = "folder", key: str = "productId") -> DataFrame:
    """Distinct product ids parsed from well-formed folder names."""
    return (folders.select(folder_product_id(F.col(folder)).alias(key))
            .where(F.col(key).isNotNull()).distinct())


def table_inventory(spark: SparkSession, db: str) -> DataFrame:
    """Names of all tables in a database; session views are none."""
    shown = spark.sql(f"SHOW TABLES IN `{db}`").where(~F.col("isTemporary"))
    return shown.select(F.col("tableName").alias("table_name"))
