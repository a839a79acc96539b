"""Table registration: which dataset folders still need a table, and the
DDL plan that keeps the database in step with the folders."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.names import folder_slug, loose_folder_id, table_product_id, target_path

CATALOG_TABLE, GONE = "catalog", "gone_columns"


def literal(path: str) -> str:
    """A path as it stands between quotes in a statement."""
    return path.replace("\\", "\\\\").replace("'", "\\'")


def columns_ddl(columns) -> str:
    """Declared columns, all STRING; nothing for unknown ones."""
    return " (" + ", ".join("`" + c.replace("`", "``") + "` STRING" for c in columns) + ")" if columns else ""


def table_name_for(folder) -> F.Column:
    """The table a dataset folder is registered as: '-' becomes '_'. Names
    with other characters than the catalog takes have those replaced by '_'
    and a checksum of the folder added, so two folders never share a table."""
    name = F.translate(F.col(folder) if isinstance(folder, str) else folder, "-", "_")
    plain = F.regexp_replace(name, "[^A-Za-z0-9_]", "_")
    mark = F.lower(F.lpad(F.hex(F.crc32(F.encode(name, "UTF-8"))), 8, "0"))
    return F.when(plain == name, name).otherwise(F.concat(plain, F.lit("_x"), mark))


def new_folders(folders: DataFrame, tables: DataFrame, folder: str = "folder",
                table: str = "table_name") -> DataFrame:
    """Folders whose product id has no table yet. Folders without an integer
    id prefix are dropped; matching is by id only."""
    f = folders.withColumn("_id", loose_folder_id(F.col(folder))).where(F.col("_id").isNotNull())
    t = tables.select(table_product_id(F.col(table)).alias("_id")).where(F.col("_id").isNotNull()).distinct()
    return f.join(t, "_id", "left_anti").drop("_id")


def current_folders(folders: DataFrame, catalog: DataFrame, folder: str = "folder", key: str = "productId",
                    title: str = "title") -> DataFrame:
    """`folders` without those that a retitled dataset has left behind: where
    an id has the folder of its title in `catalog`, its other folders go."""
    now = catalog.select(folder_slug(key, title).alias("_now")).distinct()
    f = folders.select(F.col(folder), loose_folder_id(F.col(folder)).alias("_id")).join(now, F.col(folder) == F.col("_now"), "left")
    settled = f.where(F.col("_now").isNotNull() & F.col("_id").isNotNull()).select(F.col("_id").alias("_settled")).distinct()
    return (f.join(settled, F.col("_id") == F.col("_settled"), "left")
            .where(F.col("_now").isNotNull() | F.col("_settled").isNull()).select(folder))


def register_plan(folders: DataFrame, tables: DataFrame, prefix: str, catalog_path: str,
                  folder: str = "folder", table: str = "table_name",
                  refreshed: DataFrame | None = None, refreshed_key: str = "productId") -> DataFrame:
    """One action per dataset id plus the catalog:

    * create     - folder without a table
    * keep       - table named after the folder
    * update     - same, but the dataset was re-published in this run
                   (`refreshed` ids): its columns may have changed
    * relocated  - table exists for the id but under another folder's name
                   (the title, hence the slug, changed)
    * deprecate  - table whose folder is gone, or that another table of the
                   id has replaced (never dropped)
    * refresh    - the catalog table, always

    Folders and tables are matched by id and name. Only folders without such
    a table then look for any other table of their id (the first by name),
    so neither join emits pairs.
    """
    f = (folders.select(loose_folder_id(F.col(folder)).alias("product_id"), F.col(folder).alias("folder"))
         .where(F.col("product_id").isNotNull()).distinct())
    t = (tables.select(table_product_id(F.col(table)).alias("product_id"), F.col(table).alias("table_name"))
         .where(F.col("product_id").isNotNull()).distinct())
    f = f.withColumn("_name", table_name_for("folder"))
    both = f.join(t, (f.product_id == t.product_id) & (F.lower(f["_name"]) == F.lower(t.table_name)), "full_outer").select(
        F.coalesce(f.product_id, t.product_id).alias("product_id"), "folder", "table_name")
    # of the tables of an id: the first stale one, else the first of all
    unused = F.when(F.col("folder").isNull(), F.col("table_name"))
    stale = both.groupBy("product_id").agg(F.coalesce(F.min(unused), F.min("table_name")).alias("_stale"))
    open_ids = both.where(F.col("table_name").isNull()).select(F.col("product_id").alias("_open")).distinct()
    # a folder without its table takes over the first stale table of its id; that one is named in its row, not in one of its own
    j = both.join(stale, "product_id", "left").join(open_ids, F.col("product_id") == F.col("_open"), "left")
    taken = F.col("_open").isNotNull() & (F.col("table_name") == F.col("_stale"))
    j = j.where(~(F.col("folder").isNull() & F.coalesce(taken, F.lit(False))))
    j = j.select("product_id", "folder", F.when(F.col("table_name").isNull(), F.col("_stale")).otherwise(F.col("table_name")).alias("table_name"))
    if refreshed is not None:
        r = (refreshed.select(F.col(refreshed_key).cast("bigint").alias("product_id"))
             .where(F.col("product_id").isNotNull()).distinct().withColumn("_refreshed", F.lit(True)))
        j = j.join(r, "product_id", "left")
    else:
        j = j.withColumn("_refreshed", F.lit(None).cast("boolean"))
    same = F.lower("table_name") == F.lower(table_name_for("folder"))
    action = (F.when(F.col("table_name").isNull(), F.lit("create"))
              .when(F.col("folder").isNull(), F.lit("deprecate"))
              .when(same & F.coalesce(F.col("_refreshed"), F.lit(False)), F.lit("update"))
              .when(same, F.lit("keep"))
              .otherwise(F.lit("relocated")))
    plan = j.select("product_id", "folder", "table_name", action.alias("action"),
                    F.when(F.col("folder").isNotNull(), target_path(prefix, F.col("folder"))).alias("path"))
    spark = folders.sparkSession
    catalog_row = spark.createDataFrame([(None, CATALOG_TABLE, CATALOG_TABLE, "refresh", catalog_path)],
                                        plan.schema)
    return plan.unionByName(catalog_row)


def update_table(spark: SparkSession, name: str, path: str, columns: list[str] | None = None, fmt: str = "parquet") -> dict:
    """Bring a table in step with its re-published folder, in place: at no
    moment is there no table. New columns are added behind the others. Columns
    that the data no longer has stay, read as null, and are named in the
    property `gone_columns` (a vanished thing is flagged, never dropped).
    `columns`: the data's, if known (all STRING); else they are inferred.
    Returns {'added': [...], 'gone': [...]}."""
    if columns is None:
        found = spark.read.format(fmt).option("recursiveFileLookup", "true").load(path).schema
        columns, types = found.names, {f.name: f.dataType.simpleString() for f in found}
    else:
        types = dict.fromkeys(columns, "STRING")
    have = spark.table(name).columns
    known, now = {c.lower() for c in have}, {c.lower() for c in columns}
    added, gone = [c for c in columns if c.lower() not in known], [c for c in have if c.lower() not in now]
    if added:
        listed = ", ".join("`" + c.replace("`", "``") + "` " + types[c] for c in added)
        spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({listed})")
    if gone:
        spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('{GONE}' = '{literal(json.dumps(gone))}')")
    else:
        spark.sql(f"ALTER TABLE {name} UNSET TBLPROPERTIES IF EXISTS ('{GONE}')")
    spark.sql(f"REFRESH TABLE {name}")
    return {"added": added, "gone": gone}


def apply_register_plan(spark: SparkSession, plan: DataFrame, db: str, fmt: str = "parquet",
                        workers: int = 8, db_location: str | None = None,
                        schemas: dict | None = None) -> dict:
    """Issue the catalog DDL for every action except `keep`.

    Only changed datasets reach the driver (DDL is a driver-side call
    anyway); statements for different tables go out from a small pool.
    `schemas` (product id -> output columns) lets a table be declared
    directly; without it a statement lists the folder and reads parquet
    footers to infer the schema. Returns counts per action.
    """
    schemas = schemas or {}

    def declared(pid) -> str:
        """Columns of a dataset converted in this run: the table is then
        created without listing its folder or reading parquet footers. Other
        folders have their schema inferred."""
        return columns_ddl(schemas.get(pid))

    from concurrent.futures import ThreadPoolExecutor

    where = f" LOCATION '{literal(db_location)}'" if db_location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{db}`{where}")
    kept = plan.where(F.col("action").isin("keep", "update")).select(F.col("table_name").alias("kept_table")).distinct()
    todo = (plan.where(F.col("action") != "keep").join(kept, F.col("table_name") == F.col("kept_table"), "left")
            .select("kept_table", "product_id", "folder", "table_name", "action", "path", table_name_for("folder").alias("new_table")).collect())
    counts: dict[str, int] = {}

    def one(r) -> None:
        if r.action in ("create", "relocated"):
            # a dataset folder holds `<id>.parquet/` part-file folders
            spark.sql(f"CREATE TABLE IF NOT EXISTS `{db}`.`{r.new_table}`{declared(r.product_id)} USING {fmt} "
                      f"OPTIONS (recursiveFileLookup 'true') LOCATION '{literal(r.path)}'")
            if r.action == "relocated" and r.kept_table is None:
                spark.sql(f"ALTER TABLE `{db}`.`{r.table_name}` SET TBLPROPERTIES ('deprecated' = 'true')")
        elif r.action == "update":
            update_table(spark, f"`{db}`.`{r.table_name}`", r.path, schemas.get(r.product_id), fmt)
        elif r.action == "deprecate":
            spark.sql(f"ALTER TABLE `{db}`.`{r.table_name}` SET TBLPROPERTIES ('deprecated' = 'true')")
        elif r.action == "refresh":
            loc = literal(r.path.rstrip("/"))
            if spark.catalog.tableExists(f"`{db}`.`{r.table_name}`"):
                spark.sql(f"ALTER TABLE `{db}`.`{r.table_name}` SET LOCATION '{loc}'")
            else:
                spark.sql(f"CREATE TABLE `{db}`.`{r.table_name}` USING {fmt} LOCATION '{loc}'")
            spark.sql(f"REFRESH TABLE `{db}`.`{r.table_name}`")

    def isolated(r) -> str | None:
        try:
            one(r)
        except Exception as e:  # noqa: BLE001 - one bad table must not stop the others
            return f"{r.action} {r.folder or r.table_name}: {type(e).__name__}: {e}"
        return None

    with ThreadPoolExecutor(max_workers=max(1, workers)) as pool:
        failed = list(pool.map(isolated, todo))
    for r, problem in zip(todo, failed):
        what = "failed" if problem else r.action
        counts[what] = counts.get(what, 0) + 1
    if any(failed):
        counts["errors"] = [x for x in failed if x]
    return counts
