"""Checked queries over whole runs: resumed, concurrent, and read back lazily.

Same contract as `checks`: each query has its SQL twin over the same tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import names as nm
from ..operators import convert as conv
from ..schemas import STORED_CATALOG
from ..session import materialize, staging_dir
from ..sources import catalog_store, fs, inventory, schema_history
from . import landing_build
from . import testbed as tb
from .checks import _SLUG_SQL, _SYMBOLS_SQL, register
from .refresh import STEPS, RefreshConfig, RunStopped, run_refresh
from .sql import warehouse_sql
from .testbed import AS_OF


class Died(RuntimeError):
    """Stands for a driver that is lost at this point."""


def _dies_before_mark(step: str):
    def hook(now: str) -> None:
        if now == step:
            raise Died(step)

    return hook


def _found(spark: SparkSession, root: str, db: str) -> DataFrame:
    """(part, productId, value): rows of every dataset, its catalog entry and its table."""
    held = spark.read.option("recursiveFileLookup", "true").parquet(f"{root}/data")
    in_path = F.regexp_extract(F.col("_metadata.file_path"), r"/(\d+)\.parquet/", 1).cast("bigint")
    rows = held.groupBy(in_path.alias("productId")).agg(F.count(F.lit(1)).cast("string").alias("value"))
    stored = catalog_store.read_catalog(spark, f"{root}/catalog", STORED_CATALOG)
    entry = F.concat_ws(" | ", "title", F.date_format("last_ingestion_date", "yyyy-MM-dd HH:mm:ss"), F.col("available").cast("string"))
    tables = inventory.table_inventory(spark, db)
    part = lambda name: F.lit(name).alias("part")
    return (rows.select(part("rows"), "productId", "value")
            .unionByName(stored.select(part("catalog"), "productId", entry.alias("value")))
            .unionByName(tables.select(part("table"), nm.table_product_id(F.col("table_name")).alias("productId"), F.col("table_name").alias("value"))))


_PER_DATASET_SQL = f"""n as (
  select n_nationkey, n_name, cast({landing_build.ID_BASE} + n_nationkey as bigint) as productId, count(*) as customers
  from nation join customer on n_nationkey = c_nationkey group by all)"""


@register("resumed_refresh", f"""
with {_PER_DATASET_SQL}
select 'rows' as part, productId, cast(customers as varchar) as value from n
union all select 'catalog', productId, concat('Customers in ', n_name, ' | {AS_OF} | true') from n
union all select 'table', productId, replace({_SLUG_SQL}, '-', '_') from n
union all select 'table', null, 'catalog'
union all select 'deaths', null, '{len(STEPS)}'
union all select 'commits', null, '1'
union all select 'runs', null, '1'""")
def q_resumed_refresh(spark: SparkSession, d: str) -> DataFrame:
    """One run that dies in every step, when its work is done and not yet
    marked, and is taken up again each time: what it leaves is what an
    undisturbed run leaves, with one run folder and one catalog commit."""
    stage = staging_dir(spark, "resumed")
    landing_build.build_landing(spark, d, f"{stage}/landing")
    db, root = "wr_" + stage.rsplit("-", 1)[-1][:12], f"{stage}/wh"
    try:
        run_refresh(spark, RefreshConfig(landing=f"{stage}/landing", root=root, db=db, as_of=AS_OF), before_mark=_dies_before_mark(STEPS[0]))
    except Died:
        deaths = 1
    run = f"{root}/runs/" + _only(inventory.folder_inventory(spark, f"{root}/runs"))
    for step in STEPS[1:]:
        try:
            run_refresh(spark, resume=run, before_mark=_dies_before_mark(step))
        except Died:
            deaths += 1
    run_refresh(spark, resume=run)
    facts = {"deaths": deaths, "commits": len(catalog_store.commits(spark, f"{root}/catalog")),
             "runs": inventory.folder_inventory(spark, f"{root}/runs").count()}
    facts = spark.createDataFrame([(k, None, str(v)) for k, v in facts.items()], "part string, productId long, value string")
    return _found(spark, root, db).unionByName(facts)


def _only(folders: DataFrame) -> str:
    names = [r.folder for r in folders.limit(2).collect()]
    if len(names) != 1:
        raise ValueError(f"one run expected, found {names}")
    return names[0]


@register("csv_quoted_newlines", f"""
select cast(doc_id as varchar) as Doc_Id, case when lang in ({_SYMBOLS_SQL}) then null else lang end as Lang,
       case when text in ({_SYMBOLS_SQL}) then null else text end as Text, true as many_tasks
from documents""")
def q_csv_quoted_newlines(spark: SparkSession, d: str) -> DataFrame:
    """Documents exported as CSV, their line breaks and quotes inside quoted
    values, cut at records into stretches of about 64 KB and converted."""
    stage = staging_dir(spark, "quoted-newlines")
    docs = tb.table(spark, d, "documents").select(F.col("doc_id").alias("Doc Id"), F.col("lang").alias("Lang"), F.col("text").alias("Text"))
    keep = {"quoteAll": "true", "escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    docs.write.options(header="true", **keep).csv(f"{stage}/csv")
    info = conv.convert_csv(spark, f"{stage}/csv", f"{stage}/parquet", range_bytes=1 << 16)
    tasks = len(fs.list_files(spark, f"{stage}/parquet")) - 1  # without _SUCCESS
    return spark.read.parquet(f"{stage}/parquet").withColumn("many_tasks", F.lit(info["multiline"] and tasks > 1))


_LATER = "2001-09-01 06:00:00"


@register("concurrent_refreshes", f"""
with {_PER_DATASET_SQL}
select productId, concat('Customers in ', n_name) as title,
       case when n_nationkey % 2 = 0 then '{AS_OF}' else '{_LATER}' end as stamp, true as available, cast(2 as bigint) as commits
from n""")
def q_concurrent_refreshes(spark: SparkSession, d: str) -> DataFrame:
    """Two refreshes planned on the same catalog, each with its own half of
    the datasets. The second one commits first, so the first one finds its
    commit number taken and merges anew: both are in the catalog."""
    stage = staging_dir(spark, "concurrent")
    landing_build.build_landing(spark, d, f"{stage}/landing")
    root = f"{stage}/wh"
    ids = landing_build.customer_cubes(spark, d, F.col("n_name")).select("productId", F.lit("new").alias("reason"))
    cfg = lambda half, as_of: RefreshConfig(
        landing=f"{stage}/landing", root=root, db=f"wc{half}_" + stage.rsplit("-", 1)[-1][:12], as_of=as_of, worklist=f"{stage}/half-{half}")
    for half in (0, 1):
        ids.where((F.col("productId") - landing_build.ID_BASE) % 2 == half).write.parquet(f"{stage}/half-{half}")
    try:
        run_refresh(spark, cfg(0, AS_OF), until="publish")
    except RunStopped as stopped:
        first = stopped.run
    run_refresh(spark, cfg(1, _LATER))
    run_refresh(spark, resume=first)
    stored = catalog_store.read_catalog(spark, f"{root}/catalog", STORED_CATALOG)
    n = len(catalog_store.commits(spark, f"{root}/catalog"))
    return stored.select("productId", "title", F.date_format("last_ingestion_date", "yyyy-MM-dd HH:mm:ss").alias("stamp"), "available",
                         F.lit(n).cast("long").alias("commits"))


@register("lazy_tables", f"""
with two as (select n_nationkey from nation join customer on n_nationkey = c_nationkey group by n_nationkey order by n_nationkey limit 2)
select cast(c_custkey as varchar) as "Customer_Key", c_name as "Name",
       coalesce(case when c_mktsegment in ({_SYMBOLS_SQL}) then null else c_mktsegment end, '') as "Segment",
       concat('Customers in ', n_name) as title, cast(3 as bigint) as n_tables
from customer join two on c_nationkey = two.n_nationkey join nation on c_nationkey = nation.n_nationkey""")
def q_lazy_tables(spark: SparkSession, d: str) -> DataFrame:
    """SQL over two datasets and the catalog, in a session that knows no table
    of the warehouse: just these three are declared."""
    stage = staging_dir(spark, "lazy")
    landing_build.build_landing(spark, d, f"{stage}/landing")
    root, mark = f"{stage}/wh", stage.rsplit("-", 1)[-1][:12]
    run_refresh(spark, RefreshConfig(landing=f"{stage}/landing", root=root, db=f"wl_{mark}", as_of=AS_OF))
    ids = tb.table(spark, d, "customer").select("c_nationkey").distinct().orderBy("c_nationkey").limit(2)
    names = inventory.table_inventory(spark, f"wl_{mark}").withColumn("id", nm.table_product_id(F.col("table_name")))
    names = names.join(ids, F.col("id") == landing_build.dataset_id(F.col("c_nationkey"))).orderBy("id").limit(2).collect()
    both = " union all ".join(f"select {r.id} as id, * from `{r.table_name}`" for r in names)
    sql = f"""select d.Customer_Key, d.Name, d.Segment, c.title from ({both}) d join catalog c on c.productId = d.id"""
    fresh = f"wz_{mark}"
    got = materialize(warehouse_sql(spark, sql, root, fresh), "lazy-rows")
    spark.catalog.setCurrentDatabase("default")
    return got.withColumn("n_tables", F.lit(inventory.table_inventory(spark, fresh).count()).cast("long"))


@register("schema_changes", f"""
with n as (select distinct cast({landing_build.ID_BASE} + c_nationkey as bigint) as productId from customer)
select productId, x.change, x."column", x.was from n, (values
  ('renamed', 'Full_Name', 'Name'), ('gone', 'Nation_Key', null), ('moved', 'Segment', '3'), ('added', 'Key_2', null)) x(change, "column", was)""")
def q_schema_changes(spark: SparkSession, d: str) -> DataFrame:
    """Every dataset delivered a month later with other columns: what has
    changed, by the history that the two runs have written."""
    stage = staging_dir(spark, "changed")
    db, root = "ws_" + stage.rsplit("-", 1)[-1][:12], f"{stage}/wh"
    later = {"Customer Key": "c_custkey", "Full Name": "c_name", "Segment": "c_mktsegment", "Key/2": "c_custkey"}
    for month, columns in (("2001-09-01", None), ("2001-10-15", later)):
        landing = f"{stage}/landing-{month}"
        landing_build.build_landing(spark, d, landing, columns=columns)
        run_refresh(spark, RefreshConfig(landing=landing, root=root, db=db, as_of=f"{month} 00:00:00"))
    return schema_history.changes(schema_history.read(spark, f"{root}/{schema_history.FOLDER}")).select("productId", "change", "column", "was")
