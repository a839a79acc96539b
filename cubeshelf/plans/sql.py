"""Ad-hoc SQL over the warehouse, answered as strings.

Every value is returned as text, null as ''. The page size is the feature of
`render` (only the first page is fetched, as a chat tool shows it); the
DataFrame from `sql_strings` itself is whole.
"""

from __future__ import annotations

import re

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.names import table_product_id
from ..operators.register import CATALOG_TABLE, columns_ddl, literal, table_name_for
from ..sources import catalog_store, fs, schema_history


def as_strings(df: DataFrame) -> DataFrame:
    """Every column as text. Columns go by position, so repeated names and
    names with backticks are no matter."""
    flat = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    return flat.select([F.coalesce(F.col(f"c{i}").cast("string"), F.lit("")) for i in range(len(df.columns))]).toDF(*df.columns)


def sql_strings(spark: SparkSession, sql: str, db: str | None = None, **frames: DataFrame) -> DataFrame:
    """Run `sql` (in database `db` when given; DataFrames may be passed as
    `{name}` parameters) and return the result as strings."""
    if db:
        spark.catalog.setCurrentDatabase(db)
    return as_strings(spark.sql(sql, **frames) if frames else spark.sql(sql))


def _missing_relation(err: AnalysisException) -> tuple[str | None, str] | None:
    """(database, table) of the relation that a statement names and the session doesn't know."""
    if err.getCondition() != "TABLE_OR_VIEW_NOT_FOUND":
        return None
    parts = [p.replace("``", "`") for p in _PART.findall(err.getMessageParameters().get("relationName", ""))]
    return (parts[-2] if len(parts) > 1 else None, parts[-1]) if parts else None


_PART = re.compile(r"`((?:[^`]|``)*)`")


def register_relation(spark: SparkSession, root: str, db: str, table: str) -> bool:
    """Declare one table of the warehouse at `root`; False if it has no such table.

    One DDL statement. A dataset's columns and folder come from the schema
    history (a filter on its id), so no folder is listed and no footer read;
    only a dataset of before the history is looked up among the folders and
    has its schema inferred."""
    root = root.rstrip("/")
    name = f"`{db}`.`{table.replace('`', '``')}`"
    if table.lower() == CATALOG_TABLE:
        path = catalog_store.snapshot_path(spark, f"{root}/catalog", catalog_store.latest_commit(spark, f"{root}/catalog"))
        if path is None:
            return False
        spark.sql(f"CREATE TABLE {name} USING parquet LOCATION '{literal(path)}'")
        return True
    key = spark.range(1).select(table_product_id(F.lit(table))).first()[0]
    if key is None:
        return False
    history = f"{root}/{schema_history.FOLDER}"
    mine = schema_history.read(spark, history).where((F.col("productId") == key) & (F.lower(table_name_for("folder")) == table.lower()))
    row = schema_history.latest(mine, ["folder"]).first()
    if row is None:
        folders = [(f,) for f in fs.list_dirs(spark, f"{root}/data") if f.startswith(f"{key}-") or f == str(key)]
        found = spark.createDataFrame(folders, "folder string").where(F.lower(table_name_for("folder")) == table.lower()).first()
        if found is None:
            return False
    folder, columns = (row.folder, row.columns) if row else (found.folder, None)
    spark.sql(f"CREATE TABLE {name}{columns_ddl(columns)} USING parquet OPTIONS (recursiveFileLookup 'true') "
              f"LOCATION '{literal(f'{root}/data/{folder}')}'")
    return True


def warehouse_sql(spark: SparkSession, sql: str, root: str, db: str, **frames: DataFrame) -> DataFrame:
    """Run `sql` over the warehouse at `root`, as strings. Only the relations
    that it names are declared, when Spark's analysis first misses them; the
    size of the warehouse is no matter. A name that the warehouse doesn't have
    fails as in Spark. `SHOW TABLES` lists what has been declared (see
    `sync_tables` for all)."""
    known = {d.name for d in spark.catalog.listDatabases(db)}
    if db not in known:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{db}` LOCATION '{literal(root.rstrip('/') + '/_db')}'")
    tried: set[str] = set()
    while True:
        try:
            return sql_strings(spark, sql, db=db, **frames)
        except AnalysisException as e:
            missing = _missing_relation(e)
            if missing is None or (missing[0] or db).lower() != db.lower() or missing[1].lower() in tried:
                raise
            tried.add(missing[1].lower())
            if not register_relation(spark, root, db, missing[1]):
                raise


def render(df: DataFrame, max_rows: int = 1000) -> dict:
    """{'columns': [...], 'data': [[...], ...], 'truncated': bool} for the
    first `max_rows` rows; `truncated` tells that there are more. Whole
    results are written with Spark (`sql_strings(...).write`)."""
    rows = df.limit(max_rows + 1).collect()
    return {"columns": list(df.columns), "data": [list(r) for r in rows[:max_rows]], "truncated": len(rows) > max_rows}
