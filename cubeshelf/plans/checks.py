"""The checked query set: each operator run over the driver's tables.

`QUERIES[name](spark, sf_dir)` returns a DataFrame; `ORACLE_SQL[name]` is the
same result written in plain SQL (DuckDB dialect) over the same tables.
Column names and types agree between the two.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import names as nm
from ..functions.nulls import NULL_SYMBOLS, map_null_symbols
from ..functions.typed import typed_view
from ..operators import catalog as cat_ops
from ..operators import convert as conv
from ..operators import ordering, planning
from ..operators import publish as pub
from ..operators import register as reg
from ..schemas import INGEST_REPORT, MANIFEST, STORED_CATALOG
from ..session import staging_dir
from ..sources import archives as arc
from ..sources import catalog_store, fs, inventory, listing
from ..streaming.listing_watch import watch_listings
from . import landing_build
from . import testbed as tb
from .refresh import RefreshConfig, read_manifest, run_refresh
from .sql import sql_strings
from .testbed import AS_OF, CTES, DAYS_SQL

QUERIES: dict = {}
ORACLE_SQL: dict = {}


def register(name: str, sql: str | None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE_SQL[name] = sql
        return fn
    return deco


KEY = dict(key="product_id", order="ordinal")


# --- update planning -------------------------------------------------------

def _identify(spark, d):
    return planning.classify(tb.fresh_catalog(spark, d), tb.stored_catalog(spark, d), AS_OF, **KEY)


IDENTIFY_SQL = f"""{CTES},
classified as (
  select f.product_id, f.title, f.frequency, f.ordinal,
         case when s.product_id is null or s.last_ingestion_date is null then 'new'
              when date_sub('day', s.last_ingestion_date, timestamp '{AS_OF}') >= {DAYS_SQL.format(f='f.frequency')}
              then 'update_due' end as reason
  from fresh f left join stored s on f.product_id = s.product_id)
"""


@register("identify_due", IDENTIFY_SQL + "select product_id, title, frequency, reason from classified where reason is not null")
def q_identify_due(spark: SparkSession, d: str) -> DataFrame:
    return _identify(spark, d).drop("ordinal")


@register("due_predicate", f"""{CTES}
select f.product_id, f.frequency, s.last_ingestion_date,
       date_sub('day', s.last_ingestion_date, timestamp '{AS_OF}') as elapsed_days,
       {DAYS_SQL.format(f='f.frequency')} as interval_days,
       date_sub('day', s.last_ingestion_date, timestamp '{AS_OF}') >= {DAYS_SQL.format(f='f.frequency')} as due
from fresh f join stored s on f.product_id = s.product_id
where s.last_ingestion_date is not null""")
def q_due_predicate(spark, d):
    return planning.due_pairs(tb.fresh_catalog(spark, d), tb.stored_catalog(spark, d), AS_OF, **KEY)


@register("frequency_days", f"""{CTES}
select product_id, frequency, {DAYS_SQL.format(f='frequency')} as interval_days from fresh""")
def q_frequency_days(spark, d):
    from ..functions.cadence import frequency_days
    f = tb.fresh_catalog(spark, d)
    return f.select("product_id", "frequency", frequency_days("frequency").alias("interval_days"))


@register("limit_new", IDENTIFY_SQL + """
select product_id, title, frequency, reason from (
  select *, row_number() over (partition by reason order by ordinal) as rn
  from classified where reason is not null)
where reason = 'update_due' or rn <= 20""")
def q_limit_new(spark, d):
    return planning.limit_new(_identify(spark, d), 20).drop("ordinal")


@register("reason_counts", IDENTIFY_SQL + """
select reason, count(*) as n from classified where reason is not null group by reason""")
def q_reason_counts(spark, d):
    return planning.reason_counts(_identify(spark, d))


LINEITEM_COLS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
                 "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]
_FIRST_ORDER = [c for c in LINEITEM_COLS if c != "l_partkey"]


@register("first_per_key", f"""
select {', '.join(LINEITEM_COLS)} from (
  select *, row_number() over (partition by l_partkey order by {', '.join(_FIRST_ORDER)}) as rn from lineitem)
where rn = 1""")
def q_first_per_key(spark, d):
    return ordering.first_per_key(tb.table(spark, d, "lineitem"), "l_partkey", _FIRST_ORDER)


SIZE_CAP_MB = 600000.0


def _items_by_size(spark, d):
    """Parts as items to ingest; size = total quantity shipped (0 if none)."""
    q = tb.table(spark, d, "lineitem").groupBy("l_partkey").agg(F.sum("l_quantity").alias("q"))
    p = tb.table(spark, d, "part").select("p_partkey")
    return (p.join(q, p.p_partkey == q.l_partkey, "left")
            .select(F.col("p_partkey").alias("product_id"),
                    F.coalesce(F.col("q"), F.lit(0.0)).alias("size_mb")))


@register("size_budget", f"""
select product_id, size_mb, mb_before, mb_before < {SIZE_CAP_MB} as started from (
  select product_id, size_mb,
         coalesce(sum(size_mb) over (order by product_id rows between unbounded preceding and 1 preceding), 0.0) as mb_before
  from (select p_partkey as product_id, coalesce(q, 0.0) as size_mb
        from part left join (select l_partkey, sum(l_quantity) as q from lineitem group by l_partkey) on p_partkey = l_partkey))""")
def q_size_budget(spark, d):
    return ordering.within_budget(_items_by_size(spark, d), "size_mb", "product_id", SIZE_CAP_MB)


@register("legacy_filter", f"""{CTES}
select * from fresh f
where not exists (select 1 from stored s where s.product_id = f.product_id)
  and title not like '%INVISIBLE%'
order by ordinal limit 50""")
def q_legacy_filter(spark, d):
    return planning.legacy_filter(tb.fresh_catalog(spark, d), tb.stored_catalog(spark, d), limit=50,
                                  key="product_id", order="ordinal")


@register("worklist_join", IDENTIFY_SQL + """
select f.*, c.reason from fresh f join classified c on f.product_id = c.product_id
where c.reason is not null""")
def q_worklist_join(spark, d):
    return planning.worklist_join(tb.fresh_catalog(spark, d), _identify(spark, d), key="product_id")


@register("id_set_ops", f"""{CTES}
select product_id, 'left_only' as side from (select product_id from fresh except select product_id from stored)
union all
select product_id, 'both' as side from (select product_id from fresh intersect select product_id from stored)
union all
select product_id, 'right_only' as side from (select product_id from stored except select product_id from fresh)""")
def q_id_set_ops(spark, d):
    return planning.id_membership(tb.fresh_catalog(spark, d), tb.stored_catalog(spark, d), key="product_id")


# --- catalog refresh -------------------------------------------------------


@register("merge_catalog", f"""{CTES}
select f.*, s.last_ingestion_date from fresh f left join stored s on f.product_id = s.product_id""")
def q_merge_catalog(spark, d):
    return cat_ops.merge_metadata(tb.fresh_catalog(spark, d), tb.stored_catalog(spark, d), key="product_id")


@register("merge_first_run", f"""{CTES}
select f.*, cast(null as timestamp) as last_ingestion_date from fresh f""")
def q_merge_first_run(spark, d):
    """First run: no stored catalog exists yet, so the read falls back to an
    empty frame and every date is null."""
    stored_schema = tb.stored_catalog(spark, d).schema
    missing = catalog_store.read_catalog(spark, staging_dir(spark, "no-catalog-yet"), stored_schema)
    return cat_ops.merge_metadata(tb.fresh_catalog(spark, d), missing, key="product_id")


_STAMPED_SQL = f"""{CTES}
select f.*, case when exists (select 1 from lineitem l where l.l_partkey = f.product_id
                              and l.l_returnflag = 'R' and l.l_quantity = 50)
                 then timestamp '{AS_OF}' else s.last_ingestion_date end as last_ingestion_date
from fresh f left join stored s on f.product_id = s.product_id"""


def _returned_full_lines(spark, d):
    li = tb.table(spark, d, "lineitem")
    return li.where((F.col("l_returnflag") == "R") & (F.col("l_quantity") == 50)).select("l_partkey")


@register("stamp_dates", _STAMPED_SQL)
def q_stamp_dates(spark, d):
    merged = cat_ops.merge_metadata(tb.fresh_catalog(spark, d), tb.stored_catalog(spark, d), key="product_id")
    return cat_ops.stamp_dates(merged, _returned_full_lines(spark, d), AS_OF, key="product_id", id_col="l_partkey")


@register("availability", f"""{CTES}
select f.*, exists (select 1 from stored s where s.product_id = f.product_id) as available from fresh f""")
def q_availability(spark, d):
    return cat_ops.mark_available(tb.fresh_catalog(spark, d), tb.stored_catalog(spark, d), key="product_id")


@register("availability_summary", f"""{CTES}
select count(*) filter (where exists (select 1 from stored s where s.product_id = f.product_id)) as n_available,
       count(*) as n_total
from fresh f""")
def q_availability_summary(spark, d):
    flagged = cat_ops.mark_available(tb.fresh_catalog(spark, d), tb.stored_catalog(spark, d), key="product_id")
    return cat_ops.availability_summary(flagged)


# --- listing flatten ------------------------------------------------------

def _orders_as_cubes(spark, d):
    """One JSON cube object per order; null fields are left out of the JSON
    text, so some objects lack the title or the dimension list."""
    o = tb.table(spark, d, "orders")
    cube = F.struct(
        F.col("o_orderkey").alias("productId"),
        F.when(F.col("o_orderstatus") != "P", F.concat(F.lit("Orders of customer "), F.col("o_custkey").cast("string")))
         .alias("cubeTitleEn"),
        F.col("o_orderpriority").alias("subjectEn"),
        F.col("o_orderstatus").alias("frequencyCode"),
        F.date_format(F.col("o_orderdate"), "yyyy-MM-dd").alias("releaseTime"),
        F.when(F.col("o_orderstatus") != "F", F.split(F.col("o_orderpriority"), "[- ]")).alias("dimensions"),
        (F.col("o_custkey") * 10).alias("nbDatapointsCube"),
    )
    return o.select(F.to_json(cube).alias("json"), F.col("o_orderkey").alias("pos"))


@register("catalog_flatten", """
select o_orderkey as productId,
       case when o_orderstatus <> 'P' then concat('Orders of customer ', o_custkey) end as title,
       o_orderpriority as subject, o_orderstatus as frequency, strftime(o_orderdate, '%Y-%m-%d') as releaseTime,
       cast(case when o_orderstatus <> 'F' then len(string_split_regex(o_orderpriority, '[- ]')) else 0 end as integer)
         as dimensions,
       o_custkey * 10 as nbDatapoints, o_orderkey as ordinal
from orders""")
def q_catalog_flatten(spark, d):
    return listing.flatten_cubes(_orders_as_cubes(spark, d), "json", "pos")


# --- names and symbols ----------------------------------------------------


_SYMBOLS_SQL = ", ".join("'" + s.replace("'", "''") + "'" for s in NULL_SYMBOLS)


@register("null_symbols", f"""
select l_orderkey, l_linenumber,
       case when l_returnflag in ({_SYMBOLS_SQL}) then null else l_returnflag end as l_returnflag,
       case when l_linestatus in ({_SYMBOLS_SQL}) then null else l_linestatus end as l_linestatus
from lineitem""")
def q_null_symbols(spark, d):
    li = tb.table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus")
    return map_null_symbols(li, ["l_returnflag", "l_linestatus"])


@register("sanitize_names", f"""{CTES}
select product_id, translate(title, ' /-', '___') as clean_name from fresh""")
def q_sanitize_names(spark, d):
    f = tb.fresh_catalog(spark, d)
    return f.select("product_id", nm.sanitize_col("title").alias("clean_name"))


_SLUG_SQL = ("concat({i}, '-', regexp_replace(trim(lower(regexp_replace(coalesce({t}, ''), "
             "'[^\\p{{L}}\\p{{N}} \\-]', '', 'g'))), ' +', '-', 'g'))")


@register("folder_slug", f"""{CTES}
select product_id, {_SLUG_SQL.format(i='product_id', t='title')} as folder from fresh""")
def q_folder_slug(spark, d):
    f = tb.fresh_catalog(spark, d)
    return f.select("product_id", nm.folder_slug("product_id", "title").alias("folder"))


@register("folder_slug_text", f"""
select doc_id, {_SLUG_SQL.format(i='doc_id', t='text')} as folder from documents""")
def q_folder_slug_text(spark, d):
    docs = tb.table(spark, d, "documents")
    return docs.select("doc_id", nm.folder_slug("doc_id", "text").alias("folder"))


# --- folders, tables, registration -----------------------------------------


def _slugs(spark, d):
    f = tb.fresh_catalog(spark, d)
    return f.select("product_id", "ordinal", nm.folder_slug("product_id", "title").alias("slug"))


@register("folder_ids", f"""{CTES},
named as (
  select product_id, case p_size % 10 when 0 then concat(lower(p_type), '-', p_partkey)
                                      when 1 then cast(p_partkey as varchar)
                                      when 2 then 'catalog'
                                      else {_SLUG_SQL.format(i='product_id', t='title')} end as folder
  from fresh join part on p_partkey = product_id)
select folder, case when regexp_matches(folder, '^[0-9]+-') then try_cast(split_part(folder, '-', 1) as bigint) end
       as product_id
from named""")
def q_folder_ids(spark, d):
    s = _slugs(spark, d).join(tb.table(spark, d, "part"), F.col("product_id") == F.col("p_partkey"))
    k = F.col("p_size") % 10
    folder = (F.when(k == 0, F.concat(F.lower("p_type"), F.lit("-"), F.col("p_partkey").cast("string")))
              .when(k == 1, F.col("p_partkey").cast("string"))
              .when(k == 2, F.lit("catalog")).otherwise(F.col("slug")))
    return s.select(folder.alias("folder")).select("folder", nm.folder_product_id("folder").alias("product_id"))


@register("existing_ids", f"""{CTES},
named as (
  select case p_size % 10 when 0 then concat(lower(p_type), '-', p_partkey)
                          when 1 then cast(p_partkey as varchar)
                          when 2 then 'catalog'
                          else {_SLUG_SQL.format(i='product_id', t='title')} end as folder
  from fresh join part on p_partkey = product_id)
select distinct try_cast(split_part(folder, '-', 1) as bigint) as productId
from named where regexp_matches(folder, '^[0-9]+-')""")
def q_existing_ids(spark, d):
    from ..sources.inventory import existing_ids
    return existing_ids(q_folder_ids(spark, d).select("folder"))


@register("table_ids", f"""{CTES},
named as (
  select case p_size % 10 when 0 then 'catalog'
                          when 1 then concat(p_partkey, 'x')
                          when 2 then concat(replace(lower(p_type), ' ', '_'), '_', p_partkey)
                          else translate({_SLUG_SQL.format(i='product_id', t='title')}, '-', '_') end as table_name
  from fresh join part on p_partkey = product_id)
select table_name, case when table_name <> 'catalog' and contains(table_name, '_')
                        then try_cast(split_part(table_name, '_', 1) as bigint) end as product_id
from named""")
def q_table_ids(spark, d):
    s = _slugs(spark, d).join(tb.table(spark, d, "part"), F.col("product_id") == F.col("p_partkey"))
    k = F.col("p_size") % 10
    name = (F.when(k == 0, F.lit("catalog"))
            .when(k == 1, F.concat(F.col("p_partkey").cast("string"), F.lit("x")))
            .when(k == 2, F.concat(F.replace(F.lower("p_type"), F.lit(" "), F.lit("_")), F.lit("_"),
                                   F.col("p_partkey").cast("string")))
            .otherwise(F.translate("slug", "-", "_")))
    return s.select(name.alias("table_name")).select("table_name", nm.table_product_id("table_name").alias("product_id"))


def _landed_folders(spark, d):
    """Dataset folders: parts with an open line, named by their title slug."""
    open_parts = (tb.table(spark, d, "lineitem").where(F.col("l_linestatus") == "O")
                  .select(F.col("l_partkey").alias("product_id")).distinct())
    return _slugs(spark, d).join(open_parts, "product_id").select(F.col("slug").alias("folder"), "ordinal")


def _registered_tables(spark, d):
    """Tables of the stored datasets; parts whose size is a multiple of 3 were
    registered under an older title (their name only)."""
    p = tb.table(spark, d, "part")
    f = tb.fresh_catalog(spark, d)
    s = tb.stored_catalog(spark, d).select("product_id")
    j = s.join(f, "product_id").join(p, F.col("product_id") == F.col("p_partkey"))
    old = F.col("p_size") % 3 == 0
    slug = F.when(old, nm.folder_slug("product_id", "p_name")).otherwise(nm.folder_slug("product_id", "title"))
    return j.select(F.translate(slug, "-", "_").alias("table_name"))


_FOLDERS_SQL = f"""
landed as (select {_SLUG_SQL.format(i='f.product_id', t='f.title')} as folder, f.ordinal, f.product_id
           from fresh f where f.product_id in (select l_partkey from lineitem where l_linestatus = 'O')),
tables as (select translate(case when p.p_size % 3 = 0 then {_SLUG_SQL.format(i='s.product_id', t='p.p_name')}
                                 else {_SLUG_SQL.format(i='s.product_id', t='f.title')} end, '-', '_') as table_name,
                  s.product_id
           from stored s join fresh f on s.product_id = f.product_id join part p on p.p_partkey = s.product_id)"""


@register("new_folders", f"""{CTES}, {_FOLDERS_SQL}
select folder, ordinal from landed l
where not exists (select 1 from tables t where t.product_id = l.product_id)""")
def q_new_folders(spark, d):
    return reg.new_folders(_landed_folders(spark, d), _registered_tables(spark, d))


DATA_PREFIX = "warehouse/data/"
CATALOG_LOCATION = "warehouse/catalog/"


@register("register_plan", f"""{CTES}, {_FOLDERS_SQL}
select coalesce(l.product_id, t.product_id) as product_id, l.folder, t.table_name,
       case when t.table_name is null then 'create' when l.folder is null then 'deprecate'
            when t.table_name = translate(l.folder, '-', '_') then 'keep' else 'relocated' end as action,
       case when l.folder is not null then concat('{DATA_PREFIX}', l.folder, '/') end as path
from landed l full join tables t on l.product_id = t.product_id
union all
select null, 'catalog', 'catalog', 'refresh', '{CATALOG_LOCATION}'""")
def q_register_plan(spark, d):
    return reg.register_plan(_landed_folders(spark, d), _registered_tables(spark, d), DATA_PREFIX, CATALOG_LOCATION)


# --- manifest and publishing ----------------------------------------------


@register("manifest_status", f"""
select c_mktsegment as segment, n_rows, message is null as is_valid, message from (
  select c_mktsegment, count(*) filter (where c_acctbal > 9900) as n_rows,
         case when count(*) filter (where c_acctbal < -990) = 0 then '{pub.MSG_NOT_FOUND}'
              when count(*) filter (where c_acctbal > 9900) = 0 then '{pub.MSG_EMPTY}' end as message
  from customer group by c_mktsegment)""")
def q_manifest_status(spark, d):
    """Each market segment stands for one run's manifest: it exists when the
    segment has a deeply negative balance, its rows are the top balances."""
    c = tb.table(spark, d, "customer")
    per = c.groupBy(F.col("c_mktsegment").alias("segment")).agg(
        F.count_if(F.col("c_acctbal") > 9900).alias("n_rows"),
        (F.count_if(F.col("c_acctbal") < -990) > 0).alias("exists"))
    valid, message = pub.manifest_check(F.col("exists"), F.lit(None).cast("string"), F.col("n_rows"))
    return per.select("segment", "n_rows", valid.alias("is_valid"), message.alias("message"))


PUBLISH_PREFIX = "warehouse/data/"


@register("publish_plan", f"""
select o_orderkey as productId, concat('Orders of customer ', o_custkey) as title,
       o_totalprice as size_mb, concat(o_orderkey, '-orders/', o_orderkey, '.parquet') as file_path,
       case when exists (select 1 from lineitem where l_orderkey = o_orderkey) then 'publish' else 'skip_missing' end
         as action,
       concat('{PUBLISH_PREFIX}', o_orderkey, '-orders/', o_orderkey, '.parquet') as target
from orders""")
def q_publish_plan(spark, d):
    """Manifest = one converted dataset per order; landed = the datasets of
    orders that have lines."""
    o = tb.table(spark, d, "orders")
    fp = F.concat(F.col("o_orderkey").cast("string"), F.lit("-orders/"), F.col("o_orderkey").cast("string"),
                  F.lit(".parquet"))
    manifest = o.select(F.col("o_orderkey").alias("productId"),
                        F.concat(F.lit("Orders of customer "), F.col("o_custkey").cast("string")).alias("title"),
                        F.col("o_totalprice").alias("size_mb"), fp.alias("file_path"))
    # one landed folder per order with lines (a listing has one row per folder)
    li = tb.table(spark, d, "lineitem").select("l_orderkey").distinct()
    landed = li.select(F.concat(F.col("l_orderkey").cast("string"), F.lit("-orders/"),
                                F.col("l_orderkey").cast("string"), F.lit(".parquet")).alias("rel_dir"))
    return pub.publish_plan(manifest, landed, PUBLISH_PREFIX)


# --- archives ---------------------------------------------------------------


_MEMBER_LISTS = {
    0: "{k}_MetaData.csv|{k}.csv",
    1: "{k}.csv|{k}_MetaData.csv",
    2: "{k}_MetaData.csv",
    3: "{k}_metadata.csv|{k}.txt",
    4: "tables/{k}.CSV|readme.txt",
    5: "{k}.txt|notes.md",
}


def _members_expr_spark():
    k = F.col("p_partkey").cast("string")
    expr = None
    for i, pattern in _MEMBER_LISTS.items():
        parts = pattern.split("{k}")
        text = F.concat(*[x for j, part in enumerate(parts) for x in ([k] if j else []) + [F.lit(part)]])
        cond = F.col("p_size") % 6 == i
        expr = F.when(cond, text) if expr is None else expr.when(cond, text)
    return F.when(F.col("p_size") == 50, F.array().cast("array<string>")).otherwise(F.split(expr, r"\|"))


def _members_expr_sql():
    def concat_sql(pattern):
        pieces = []
        for j, part in enumerate(pattern.split("{k}")):
            if j:
                pieces.append("p_partkey")
            pieces.append(f"'{part}'")
        return "concat(" + ", ".join(pieces) + ")"
    cases = " ".join(f"when {i} then {concat_sql(p)}" for i, p in _MEMBER_LISTS.items())
    return f"case when p_size = 50 then []::varchar[] else string_split(case p_size % 6 {cases} end, '|') end"


@register("archive_member", f"""
select p_partkey as product_id, array_to_string(names, '|') as member_list,
  case when len(names) > 0 then coalesce(list_filter(list_filter(names, lambda x: lower(x) like '%.csv'),
                                                 lambda x: not contains(x, 'MetaData'))[1],
                                     list_filter(names, lambda x: lower(x) like '%.csv')[1]) end as member,
  case when len(names) = 0 then 'ZIP archive is empty'
       when len(list_filter(names, lambda x: lower(x) like '%.csv')) = 0
       then concat('No CSV file found in ZIP. Files: [', array_to_string(list_transform(names, lambda x: concat('''', x, '''')), ', '), ']')
  end as error
from (select p_partkey, {_members_expr_sql()} as names from part)""")
def q_archive_member(spark, d):
    p = tb.table(spark, d, "part").select("p_partkey", _members_expr_spark().alias("names"))
    member, error = arc.choose_member(F.col("names"))
    return p.select(F.col("p_partkey").alias("product_id"), F.array_join("names", "|").alias("member_list"),
                    member.alias("member"), error.alias("error"))


def _page_bytes_spark():
    html = F.encode(F.col("html"), "UTF-8")
    return (F.when(F.col("url").startswith("https://m."), F.lit(b"", ).cast("binary"))
            .when(F.col("url").startswith("https"), F.concat(F.unhex(F.lit("504B0304")), html))
            .when(F.col("url").contains(".org"), F.substring(html, 1, 3))
            .otherwise(html))


@register("archive_signature", """
select page_id, magic = '504b0304' as valid, magic,
       case when magic <> '504b0304' then concat('no ZIP archive: the first bytes are ', magic,
            '; the provider probably answered with a web page') end as reason
from (select page_id,
        case when url like 'https://m.%' then 'empty'
             when url like 'https%' then '504b0304'
             when url like '%.org%' then lower(hex(encode(left(html, 3))))
             else lower(hex(encode(left(html, 4)))) end as magic
      from pages)""")
def q_archive_signature(spark, d):
    """Downloads from the pages table: some are real archives (signature
    first), some short, empty, or an HTML error page."""
    pg = tb.table(spark, d, "pages").select("page_id", _page_bytes_spark().alias("content"))
    m = pg.select("page_id", arc.magic_hex(F.col("content")).alias("magic"))
    valid, reason = arc.signature_check(F.col("magic"))
    return m.select("page_id", valid.alias("valid"), "magic", reason.alias("reason"))


# --- conversion report --------------------------------------------------------


def _report_from_parts(spark, d):
    p = tb.table(spark, d, "part")
    failed = F.col("p_type") == "PROMO"
    return p.select(
        F.col("p_partkey").alias("productId"), F.col("p_name").alias("title"),
        F.when(failed, F.lit("failed")).otherwise(F.lit("ok")).alias("status"),
        F.when(~failed, F.col("p_size") * F.lit(1.5)).alias("size_mb"),
        F.when(~failed, F.concat(F.col("p_partkey").cast("string"), F.lit("/"), F.col("p_partkey").cast("string"),
                                 F.lit(".parquet"))).alias("file_path"),
        F.when(failed, F.lit("ValueError")).alias("error_class"),
        F.when(failed, F.concat(F.lit("conversion of "), F.col("p_name"), F.lit(" failed in brand "),
                                F.col("p_brand"))).alias("error_message"),
        F.lit(None).cast("string").alias("notes"),
        F.lit(None).cast("string").alias("columns"),
    ).select([F.col(f.name).cast(f.dataType) for f in INGEST_REPORT.fields])


@register("ingest_summary", """
select count(*) filter (where p_type <> 'PROMO') as n_ok, count(*) filter (where p_type = 'PROMO') as n_failed,
       coalesce(sum(p_size * cast(1.5 as double)) filter (where p_type <> 'PROMO'), cast(0 as double)) as total_mb,
       coalesce(sum(p_size * cast(1.5 as double)) filter (where p_type <> 'PROMO'), cast(0 as double))
         / cast(1000 as double) as total_gb
from part""")
def q_ingest_summary(spark, d):
    return conv.ingest_summary(_report_from_parts(spark, d))


@register("error_labels", """
select p_partkey as productId, status,
       case when length(msg) > 50 then 'ValueError' else msg end as error_label
from (select p_partkey, case when p_type = 'PROMO' then 'failed' else 'ok' end as status,
             case when p_type = 'PROMO' then concat('conversion of ', p_name, ' failed in brand ', p_brand) end as msg
      from part)""")
def q_error_labels(spark, d):
    return conv.with_error_labels(_report_from_parts(spark, d)).select("productId", "status", "error_label")


@register("display_title", """
select doc_id, concat('[', doc_id, '] ', case when length(text) > 50 then concat(left(text, 50), '...') else text end)
       as display
from documents""")
def q_display_title(spark, d):
    docs = tb.table(spark, d, "documents")
    return docs.select("doc_id", nm.display_title("doc_id", "text").alias("display"))


@register("error_label", """
select doc_id, case when length(text) > 50 then concat(upper(lang), 'Error') else text end as label
from documents""")
def q_error_label(spark, d):
    docs = tb.table(spark, d, "documents")
    return docs.select("doc_id", nm.error_label(F.concat(F.upper("lang"), F.lit("Error")), "text").alias("label"))


# --- query-time typing and ad-hoc SQL ---------------------------------------


@register("typed_view", """
select event_id, try_cast(json_extract_string(props, '$.k') as bigint) as k,
       try_cast(props as double) as props_number, try_cast(event_type as double) as type_number
from events""")
def q_typed_view(spark, d):
    ev = tb.table(spark, d, "events").select(
        "event_id", F.get_json_object("props", "$.k").alias("k"),
        F.col("props").alias("props_number"), F.col("event_type").alias("type_number"))
    return typed_view(ev, {"k": "bigint", "props_number": "double", "type_number": "double"})


_NATION_SQL = """
select n.n_nationkey, n.n_name, r.r_name,
       case when n.n_nationkey % 5 = 0 then null else n.n_regionkey end as region_key,
       count(distinct c.c_custkey) as customers, count(o.o_orderkey) as orders
from {nation} n join {region} r on n.n_regionkey = r.r_regionkey
     left join {customer} c on c.c_nationkey = n.n_nationkey
     left join {orders} o on o.o_custkey = c.c_custkey
group by n.n_nationkey, n.n_name, r.r_name, n.n_regionkey"""


@register("sql_strings", """
select cast(n_nationkey as varchar) as n_nationkey, n_name, r_name, coalesce(cast(region_key as varchar), '') as region_key,
       cast(customers as varchar) as customers, cast(orders as varchar) as orders
from (""" + _NATION_SQL.replace("{nation}", "nation").replace("{region}", "region")
      .replace("{customer}", "customer").replace("{orders}", "orders") + ")")
def q_sql_strings(spark, d):
    return sql_strings(spark, _NATION_SQL, nation=tb.table(spark, d, "nation"), region=tb.table(spark, d, "region"),
                       customer=tb.table(spark, d, "customer"), orders=tb.table(spark, d, "orders"))


# --- CSV conversion ----------------------------------------------------------

@register("csv_to_strings", f"""
select cast(o_orderkey as varchar) as Order_Key, cast(o_custkey as varchar) as Cust_Key,
       case when o_orderstatus in ({_SYMBOLS_SQL}) then null else o_orderstatus end as Order_Status,
       cast(cast(o_orderdate as date) as varchar) as Order_Date, o_orderpriority as Priority,
       concat(o_orderkey, ' / ', o_orderpriority) as Order_Key_2
from orders""")
def q_csv_to_strings(spark, d):
    """Orders exported as a CSV dataset with awkward headers ('Order Key',
    'Cust/Key', 'Order-Status', and 'Order/Key' which collides with the first
    after cleaning), converted, and read back."""
    stage = staging_dir(spark, "csv-dataset")
    o = tb.table(spark, d, "orders")
    o.select(F.col("o_orderkey").alias("Order Key"), F.col("o_custkey").alias("Cust/Key"),
             F.col("o_orderstatus").alias("Order-Status"), F.to_date("o_orderdate").alias("Order Date"),
             F.col("o_orderpriority").alias("Priority"),
             F.concat(F.col("o_orderkey").cast("string"), F.lit(" / "), F.col("o_orderpriority")).alias("Order/Key"),
             ).write.option("header", "true").option("escape", '"').csv(f"{stage}/csv")
    conv.convert_csv(spark, f"{stage}/csv", f"{stage}/parquet")
    return spark.read.parquet(f"{stage}/parquet")


# --- landing archives and the whole refresh ----------------------------------


@register("archive_expand", f"""
select cast({landing_build.ID_BASE} + c_nationkey as bigint) as productId, concat({landing_build.ID_BASE} + c_nationkey, '.csv') as member,
       cast(null as varchar) as error, true as extracted
from (select distinct c_nationkey from customer)""")
def q_archive_expand(spark, d):
    stage = staging_dir(spark, "archives")
    made = landing_build.build_landing(spark, d, f"{stage}/landing")
    plan = arc.plan_extraction(arc.inspect_archives(made))
    out = arc.extract_members(plan, f"{stage}/extracted")
    return out.select("productId", "member", "error", F.col("csv_path").isNotNull().alias("extracted"))


@register("warehouse_refresh", f"""
select cast(c_custkey as varchar) as Customer_Key, c_name as Name, cast(c_nationkey as varchar) as Nation_Key,
       case when c_mktsegment in ({_SYMBOLS_SQL}) then null else c_mktsegment end as Segment
from customer""")
def q_warehouse_refresh(spark, d):
    """Landing folder from the customer table -> full refresh -> every
    ingested dataset read back from the warehouse."""
    stage = staging_dir(spark, "warehouse")
    landing_build.build_landing(spark, d, f"{stage}/landing")
    db = "wh_" + stage.rsplit("-", 1)[-1][:12]
    run_refresh(spark, RefreshConfig(landing=f"{stage}/landing", root=f"{stage}/wh", db=db, as_of=AS_OF))
    return spark.read.option("recursiveFileLookup", "true").parquet(f"{stage}/wh/data")


# folder names drop every character but letters, digits, blanks and hyphens
_SLUG_SQL = (f"concat({landing_build.ID_BASE} + n_nationkey, '-customers-in-', "
             "lower(replace(regexp_replace(n_name, '[^A-Za-z0-9 -]', '', 'g'), ' ', '-')))")


@register("refresh_outputs", f"""
with n as (select distinct n_nationkey, n_name, cast({landing_build.ID_BASE} + n_nationkey as bigint) as productId
           from nation join customer on n_nationkey = c_nationkey)
select 'catalog' as part, productId, concat('Customers in ', n_name, ' | {AS_OF} | true') as value from n
union all select 'manifest', productId, concat({_SLUG_SQL}, '/', productId, '.parquet') from n
union all select 'size', productId, 'true' from n
union all select 'planned', productId, 'new' from n
union all select 'folder', productId, {_SLUG_SQL} from n
union all select 'table', productId, replace({_SLUG_SQL}, '-', '_') from n
union all select 'table', null, 'catalog'
union all select 'second run', 0, '0 planned, catalog kept'""")
def q_refresh_outputs(spark, d):
    """What a refresh leaves behind, read back from where it was put: the
    catalog snapshot, the manifest (with its sizes), the planned list, the
    folders and the tables; then a second run, with nothing due."""
    stage = staging_dir(spark, "outputs")
    landing_build.build_landing(spark, d, f"{stage}/landing")
    db, root = "wo_" + stage.rsplit("-", 1)[-1][:12], f"{stage}/wh"
    cfg = RefreshConfig(landing=f"{stage}/landing", root=root, db=db, as_of=AS_OF)
    run = run_refresh(spark, cfg)
    cols = lambda df, part, key, value: df.select(F.lit(part).alias("part"), key.cast("bigint").alias("productId"),
                                                  value.cast("string").alias("value"))
    stored = catalog_store.read_catalog(spark, f"{root}/catalog", STORED_CATALOG)
    stamp = F.date_format("last_ingestion_date", "yyyy-MM-dd HH:mm:ss")
    facts = F.concat_ws(" | ", "title", stamp, F.col("available").cast("string"))
    manifest = read_manifest(spark, run["run"])
    planned = spark.read.parquet(f"{run['run']}/classified").where(F.col("reason").isNotNull())
    folders = inventory.folder_inventory(spark, f"{root}/data")
    tables = inventory.table_inventory(spark, db)
    again = run_refresh(spark, cfg)
    kept = spark.read.parquet(again["catalog_path"]).exceptAll(spark.read.parquet(run["catalog_path"])).isEmpty()
    n = again["report"].count()
    second = spark.range(1).select(F.lit("second run").alias("part"), F.col("id").alias("productId"),
                                   F.lit(f"{n} planned, catalog {'kept' if kept else 'changed'}").alias("value"))
    return (cols(stored, "catalog", F.col("productId"), facts)
            .unionByName(cols(manifest, "manifest", F.col("productId"), F.col("file_path")))
            .unionByName(cols(manifest, "size", F.col("productId"), F.col("size_mb") > 0))
            .unionByName(cols(planned, "planned", F.col("productId"), F.col("reason")))
            .unionByName(cols(folders, "folder", nm.folder_product_id(F.col("folder")), F.col("folder")))
            .unionByName(cols(tables, "table", nm.table_product_id(F.col("table_name")), F.col("table_name")))
            .unionByName(second))


@register("ingest_report_cases", f"""
with n as (select n_nationkey % 7 as fault, cast({landing_build.ID_BASE} + n_nationkey as bigint) as productId, count(*) as customers
           from nation join customer on n_nationkey = c_nationkey group by n_nationkey)
select productId, case when fault in (0, 6) then 'ok' else 'failed' end as status,
       case fault when 1 then '3c68746d' when 2 then 'empty' when 3 then '{arc.MSG_NO_CSV}[''readme.txt'']'
                  when 4 then 'conversion' when 5 then 'FileNotFoundError' end as reason,
       case when fault in (0, 6) then customers + fault // 6 end as n_rows,
       fault in (0, 6) as stamped, fault in (0, 6) as registered, fault not in (0, 6) as planned_again
from n""")
def q_ingest_report_cases(spark, d):
    """A refresh over a bad delivery (`faults`): the outcome of every dataset,
    its rows in the warehouse, its stamp in the catalog, its table, and
    whether a second run plans it again."""
    stage = staging_dir(spark, "bad-delivery")
    landing = f"{stage}/lan ding é"
    landing_build.build_landing(spark, d, landing, faults=True)
    db, root = "wf_" + stage.rsplit("-", 1)[-1][:12], f"{stage}/ware house"
    cfg = RefreshConfig(landing=landing, root=root, db=db, as_of=AS_OF)
    run = run_refresh(spark, cfg)
    msg = F.col("error_message")
    reason = (F.when(F.col("status") == "ok", F.lit(None).cast("string")).when(F.col("error_class") != "ArchiveError", "conversion")
              .when(msg.startswith("no ZIP"), F.regexp_extract(msg, "bytes are ([0-9a-z]+)", 1))
              .when(msg.startswith(arc.MSG_NO_CSV), msg).otherwise(F.regexp_extract(msg, "^[A-Za-z]+", 0)))
    report = run["report"].select("productId", "status", reason.alias("reason"))
    held = spark.read.option("recursiveFileLookup", "true").parquet(f"{root}/data")
    in_path = F.regexp_extract(F.col("_metadata.file_path"), r"/(\d+)\.parquet/", 1).cast("bigint")
    rows = held.groupBy(in_path.alias("held_id")).agg(F.count(F.lit(1)).alias("n_rows"))
    stored = catalog_store.read_catalog(spark, f"{root}/catalog", STORED_CATALOG)
    dated = stored.where(F.col("last_ingestion_date").isNotNull()).select(F.col("productId").alias("dated_id")).distinct()
    names = inventory.table_inventory(spark, db)
    named = names.select(nm.table_product_id(F.col("table_name")).alias("table_id")).distinct()
    again = run_refresh(spark, cfg)["report"].select(F.col("productId").alias("again_id"))
    on = lambda c: F.col("productId") == F.col(c)
    return (report.join(rows, on("held_id"), "left").join(dated, on("dated_id"), "left").join(named, on("table_id"), "left")
            .join(again, on("again_id"), "left")
            .select("productId", "status", "reason", "n_rows", F.col("dated_id").isNotNull().alias("stamped"),
                    F.col("table_id").isNotNull().alias("registered"), F.col("again_id").isNotNull().alias("planned_again")))


_NEW_SLUG_SQL = _SLUG_SQL.replace("-customers-in-", "-clients-of-")


@register("registered_tables", f"""
with n as (select distinct n_nationkey, n_name, n_nationkey % 2 = 0 as retitled from nation join customer on n_nationkey = c_nationkey)
select replace({_SLUG_SQL}, '-', '_') as table_name, {_SLUG_SQL} as folder, retitled as deprecated from n
union all select replace({_NEW_SLUG_SQL}, '-', '_'), {_NEW_SLUG_SQL}, false from n where retitled
union all select 'catalog', null, false""")
def q_registered_tables(spark, d):
    """The tables after a first run, new titles for half of the datasets, and
    a second run a month later: name, folder below the data root, and whether
    the table is flagged as left behind."""
    stage = staging_dir(spark, "retitled")
    landing = f"{stage}/landing"
    landing_build.build_landing(spark, d, landing)
    db = "wt_" + stage.rsplit("-", 1)[-1][:12]
    cfg = RefreshConfig(landing=landing, root=f"{stage}/wh", db=db, as_of=AS_OF)
    run_refresh(spark, cfg)
    fs.delete(spark, f"{landing}/listing.json")
    title = F.concat(F.when(F.col("n_nationkey") % 2 == 0, "Clients of ").otherwise("Customers in "), "n_name")
    listing.write_listing(landing_build.customer_cubes(spark, d, title), f"{landing}/listing.json")
    run_refresh(spark, replace(cfg, as_of="2001-10-15 00:00:00"))
    shown = spark.sql(f"SHOW TABLE EXTENDED IN `{db}` LIKE '*'").where(~F.col("isTemporary"))
    folder = F.regexp_extract("information", r"Location: [^\n]*/wh/data/([^/\n]+)", 1)
    return shown.select(F.col("tableName").alias("table_name"), F.when(folder != "", folder).alias("folder"),
                        F.col("information").contains("deprecated=true").alias("deprecated"))


# --- incremental planning on Structured Streaming ------------------------------


@register("incremental_plan", IDENTIFY_SQL + """
select product_id as productId, title, frequency, reason from classified where reason is not null""")
def q_incremental_plan(spark, d):
    """The fresh catalog lands as listing documents; a file stream
    (availableNow) classifies what landed against a stored snapshot."""
    stage = staging_dir(spark, "listing-stream")
    fresh = tb.fresh_catalog(spark, d)
    cubes = fresh.select(F.col("product_id").alias("productId"), F.col("title").alias("cubeTitleEn"),
                         F.col("subject").alias("subjectEn"), F.col("frequency").alias("frequencyCode"),
                         F.lit(None).cast("string").alias("releaseTime"),
                         F.lit(None).cast("array<string>").alias("dimensions"),
                         F.lit(None).cast("bigint").alias("nbDatapointsCube"))
    listing.write_listing(cubes, f"{stage}/listings")
    stored = tb.stored_catalog(spark, d).withColumnRenamed("product_id", "productId")
    snapshot = stored.select([F.col(f.name).cast(f.dataType) if f.name in stored.columns
                              else F.lit(None).cast(f.dataType).alias(f.name) for f in STORED_CATALOG.fields])
    catalog_store.write_catalog(snapshot, f"{stage}/catalog")
    watch_listings(spark, f"{stage}/listings", f"{stage}/catalog", f"{stage}/out", f"{stage}/checkpoint", as_of=AS_OF)
    return spark.read.parquet(f"{stage}/out").select("productId", "title", "frequency", "reason")


# --- manifests on disk ---------------------------------------------------------

@register("manifest_files", f"""
select c_mktsegment as segment, count(*) filter (where c_acctbal > 9900) as n_rows,
       count(*) filter (where c_acctbal > 9900) > 0 as is_valid,
       case when count(*) filter (where c_acctbal > 9900) = 0 then '{pub.MSG_NOT_FOUND}' end as message
from customer group by c_mktsegment""")
def q_manifest_files(spark, d):
    """One manifest per market segment (its top-balance customers), written
    by a partitioned CSV write: a segment without rows gets no file. Each
    manifest is then checked and read from disk (one check per segment)."""
    stage = staging_dir(spark, "manifests")
    c = tb.table(spark, d, "customer")
    rows = c.where(F.col("c_acctbal") > 9900).select(
        F.col("c_custkey").alias("productId"), F.col("c_name").alias("title"), F.col("c_acctbal").alias("size_mb"),
        F.concat(F.col("c_custkey").cast("string"), F.lit("-"), F.lower("c_mktsegment"), F.lit("/"),
                 F.col("c_custkey").cast("string"), F.lit(".parquet")).alias("file_path"),
        F.col("c_mktsegment").alias("segment"))
    rows.write.partitionBy("segment").option("header", "true").csv(stage)
    # one scan over all manifests on disk, counted by the folder that each row came from
    held = spark.read.schema(MANIFEST).option("header", "true").option("recursiveFileLookup", "true").csv(stage)
    segment = F.url_decode(F.regexp_extract(F.col("_metadata.file_path"), "/segment=([^/]*)/", 1))
    counts = held.groupBy(segment.alias("held")).agg(F.count(F.lit(1)).alias("n"))
    wanted = c.select(F.col("c_mktsegment").alias("segment")).distinct()
    both = wanted.join(counts, F.col("segment") == F.col("held"), "left").withColumn("n_rows", F.coalesce("n", F.lit(0)).cast("long"))
    valid, message = pub.manifest_check(F.col("n").isNotNull(), F.lit(None).cast("string"), F.col("n_rows"))
    return both.select("segment", "n_rows", valid.alias("is_valid"), message.alias("message"))
