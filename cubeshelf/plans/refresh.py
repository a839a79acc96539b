"""The warehouse refresh, step by step, as Spark jobs.

    listing -> plan (new / due) -> archives -> CSV -> parquet -> publish
            -> catalog snapshot -> table registration

Hand-offs between steps are tables in the run folder, written once and read
back, which also cuts the lineage: a lost executor never re-runs an extraction
or a conversion, and a run that died is taken up by another process at its
first step without a mark (`journal.Journal`).
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.names import folder_slug
from ..functions.sizes import mb
from ..operators import catalog as cat_ops
from ..operators import convert, planning, publish, register
from ..operators.ordering import first_per_key, within_budget
from ..schemas import INGEST_REPORT, MANIFEST, STORED_CATALOG
from ..sources import archives, catalog_store, fs, inventory, listing, schema_history
from .journal import Journal, RunStopped


@dataclass
class RefreshConfig:
    landing: str                      # listing.json + archives/<productId>.zip
    root: str                         # warehouse: data/, catalog/, runs/
    db: str = "warehouse"
    as_of: str | None = None          # "now"; UTC wall clock when None
    limit: int | None = None          # new datasets per run (updates always run)
    max_total_gb: float | None = None  # archive bytes started per run; the others are reported as deferred
    timeout_s: float | None = None    # per conversion job
    allow_empty_listing: bool = False  # let a listing without datasets empty the catalog
    workers: int = 4                  # datasets converted at the same time
    worklist: str | None = None       # a planned work list (productId, reason) to take instead of planning
    legacy: bool = False              # no update planning: everything not yet landed
    skip_invisible: bool = True       # legacy mode drops hidden tables, as in the original workflow
    skip_invisible_planned: bool = False  # also drop them from the planned work list (off: parity)
    strict_parity: bool = False       # stamp every manifest row, even if not published
    keep_staging: bool = False        # keep extracted CSVs and converted copies of the run
    quarantine: bool = False          # ragged rows go aside instead of failing the dataset
    frequency_mapping: dict = field(default_factory=dict)


def plan_run(fresh: DataFrame, stored: DataFrame, as_of, limit: int | None = None,
             mapping: dict | None = None, write_to: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Work list (fixed schema, empty when nothing is due) and its summary.
    With `write_to`, the classification is written once there and both the
    limited list and the summary read it back (no second classification)."""
    work = planning.classify(fresh, stored, as_of, mapping=mapping)
    if write_to:
        work = _materialize(work, write_to)
    limited = planning.limit_new(work, limit)
    return limited, planning.plan_summary(work, limited)


def choose_work(fresh: DataFrame, work: DataFrame | None, existing: DataFrame | None,
                limit: int | None = None, skip_invisible: bool = True,
                skip_invisible_planned: bool = False) -> DataFrame:
    """Catalog rows to ingest: the planned work list when there is one,
    otherwise everything not yet in the warehouse (legacy mode). Hidden
    tables are dropped in legacy mode; in planned mode only on request
    (the original workflow keeps them there)."""
    if work is not None:
        todo = planning.worklist_join(fresh, work)
        if skip_invisible_planned:
            todo = todo.where(~F.coalesce(F.col("title").contains(planning.INVISIBLE_MARK), F.lit(False)))
        return todo
    legacy = planning.legacy_filter(fresh, existing, skip_invisible=skip_invisible, limit=limit)
    return legacy.withColumn("reason", F.lit(planning.REASON_NEW))


def refresh_catalog(fresh: DataFrame, stored: DataFrame, stamped_ids: DataFrame, folder_ids: DataFrame,
                    as_of) -> DataFrame:
    """Fresh metadata + carried-over dates, stamped for this run's datasets,
    availability from the folders present; columns in STORED_CATALOG order."""
    merged = cat_ops.merge_metadata(fresh, stored)
    stamped = cat_ops.stamp_dates(merged, stamped_ids, as_of)
    flagged = cat_ops.mark_available(stamped, folder_ids)
    return flagged.select([F.col(f.name).cast(f.dataType) for f in STORED_CATALOG.fields])


def sync_tables(spark: SparkSession, data_root: str, catalog_path: str, db: str,
                refreshed: DataFrame | None = None, schemas: dict | None = None,
                catalog: DataFrame | None = None) -> dict:
    """Register folders that have no table yet, re-register re-published
    ones (their schema may have changed), flag vanished ones and, with
    `catalog` (ids and titles), those of earlier titles, and point the
    catalog table at the newest snapshot. The database folder lives beside
    the data (`<root>/_db`), in the warehouse's own storage."""
    db_location = data_root.rstrip("/").rsplit("/", 1)[0] + "/_db"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{db}` LOCATION '{register.literal(db_location)}'")
    folders = inventory.folder_inventory(spark, data_root)
    if catalog is not None:
        folders = register.current_folders(folders, catalog)
    tables = inventory.table_inventory(spark, db)
    plan = register.register_plan(folders, tables, data_root.rstrip("/") + "/", catalog_path,
                                  refreshed=refreshed)
    return register.apply_register_plan(spark, plan, db, db_location=db_location, schemas=schemas)


def _now(as_of) -> str:
    if as_of:
        return str(as_of)
    return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None).isoformat(sep=" ", timespec="seconds")


def _materialize(df: DataFrame, path: str) -> DataFrame:
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.parquet(path)


def check_listing(fresh: DataFrame, stored: DataFrame, allow_empty: bool = False) -> None:
    """Refuse a listing with unreadable ids, and one without datasets where
    the catalog has some: both are signs of a bad response, not of news."""
    n, ids = fresh.agg(F.count(F.lit(1)), F.count("productId")).first()
    if ids < n:
        raise ValueError(f"{n - ids} of {n} datasets in the listing have no integer id")
    if not n and not allow_empty and not stored.isEmpty():
        raise ValueError("the listing has no datasets, but the catalog has; allow_empty_listing empties it")


# The steps of a run, in order. Each reads what the ones before it have written.
STEPS = ("plan", "inspect", "extract", "convert", "publish_plan", "publish", "catalog", "register", "clean")


def new_run(spark: SparkSession, cfg: RefreshConfig) -> Journal:
    """A run folder with its settings; "now" is fixed here, for all its steps."""
    name = f"{dt.datetime.now(dt.timezone.utc):%Y%m%dT%H%M%S}-{uuid.uuid4().hex[:8]}"
    journal = Journal(spark, f"{cfg.root.rstrip('/')}/runs/{name}")
    journal.save_settings(replace(cfg, as_of=_now(cfg.as_of)))
    return journal


def run_refresh(spark: SparkSession, cfg: RefreshConfig | None = None, resume: str | None = None, until: str | None = None,
                before_mark: Callable[[str], None] | None = None) -> dict:
    """One complete refresh. Returns the run summary and the report frame.

    `resume` takes up an earlier run at its first step without a mark, with
    the settings of that run (`cfg` isn't needed). `until` ends after a step
    with `RunStopped`, which names the run. `before_mark` is called when a
    step's work is done and its mark isn't written yet (for tests: whatever it
    raises is a run that died there)."""
    if until is not None and until not in STEPS:
        raise ValueError(f"until: one of {', '.join(STEPS)}")
    journal = Journal(spark, resume) if resume else new_run(spark, cfg)
    run = _Run(spark, RefreshConfig(**journal.settings()), journal)
    for name in STEPS:
        def work(name=name):
            facts = getattr(run, name)()
            if before_mark is not None:
                before_mark(name)
            return facts

        journal.step(name, work)
        if name == until:
            raise RunStopped(journal.run, name)
    return run.outcome()


class _Run:
    """The work of each step. Steps pass on written hand-offs, never objects."""

    def __init__(self, spark: SparkSession, cfg: RefreshConfig, journal: Journal):
        self.spark, self.cfg, self.journal, self.as_of = spark, cfg, journal, cfg.as_of
        root = cfg.root.rstrip("/")
        self.data_root, self.catalog_dir, self.landing = f"{root}/data", f"{root}/catalog", cfg.landing.rstrip("/")
        self.schemas_dir = f"{root}/{schema_history.FOLDER}"

    def _items(self) -> DataFrame:
        return self.journal.read("items")

    def _report(self) -> DataFrame:
        return self.spark.read.schema(INGEST_REPORT).parquet(self.journal.path("report"))

    def _published(self) -> DataFrame:
        """Ids of the datasets that this run has published."""
        ok = self.journal.read("published").where(F.col("status") == "published").select("file_path")
        return read_manifest(self.spark, self.journal.run).join(ok, "file_path").select("productId")

    def plan(self) -> dict:
        spark, cfg, journal = self.spark, self.cfg, self.journal
        # what an interrupted attempt has planned may be older than the stored catalog
        journal.forget("catalog.parquet", "classified", "items")
        # parsed once: planning, the work list and the catalog read the same rows, hours later as well
        fresh = journal.table("catalog.parquet", lambda: listing.read_listing(spark, f"{self.landing}/listing.json"))
        base = catalog_store.latest_commit(spark, self.catalog_dir)
        stored = catalog_store.read_commit(spark, self.catalog_dir, base, STORED_CATALOG)
        check_listing(fresh, stored, cfg.allow_empty_listing)
        summary = None
        if cfg.worklist:
            todo = choose_work(fresh, spark.read.parquet(cfg.worklist).select("productId", "reason"), None,
                               skip_invisible_planned=cfg.skip_invisible_planned)
        elif cfg.legacy:
            existing = inventory.existing_ids(inventory.folder_inventory(spark, self.data_root))
            todo = choose_work(fresh, None, existing, cfg.limit, cfg.skip_invisible)
        else:
            work, summary_df = plan_run(fresh, stored, self.as_of, cfg.limit, cfg.frequency_mapping,
                                        write_to=journal.path("classified"))
            summary = summary_df.first().asDict()
            todo = choose_work(fresh, work, None, skip_invisible_planned=cfg.skip_invisible_planned)
        # a listing may name an id twice: its first row is the work item
        todo = first_per_key(todo.where(F.col("productId").isNotNull()), "productId", ["ordinal"])
        journal.table("items", lambda: todo.select(
            "productId", "title", "ordinal", "reason", folder_slug("productId", "title").alias("folder"),
            F.concat(F.lit(f"{self.landing}/archives/"), F.col("productId").cast("string"), F.lit(".zip")).alias("archive_path")))
        return {"base": base, "summary": summary}

    def inspect(self) -> None:
        # one archive per task slot: inspection, extraction and copies use the whole cluster
        items = self._items().repartition(self.spark.sparkContext.defaultParallelism)
        facts = self.journal.table("archives", lambda: archives.inspect_archives(items))
        if self.cfg.max_total_gb is not None:
            # only archives that can be converted use the budget up
            sized = archives.plan_extraction(facts).withColumn(
                "archive_mb", F.when(F.col("error").isNull(), mb(F.coalesce(F.col("length"), F.lit(0)))).otherwise(F.lit(0.0)))
            self.journal.table("budget", lambda: within_budget(sized, "archive_mb", "ordinal", self.cfg.max_total_gb * 1000.0))

    def _deferred(self) -> DataFrame:
        if self.cfg.max_total_gb is None:
            return self.spark.createDataFrame([], "productId long, title string")
        return self.journal.read("budget").where(~F.col("started")).select("productId", "title")

    def extract(self) -> None:
        checked = archives.plan_extraction(self.journal.read("archives"))
        if self.cfg.max_total_gb is not None:
            checked = self.journal.read("budget").where("started").drop("archive_mb", "mb_before", "started")
        self.journal.table("extracted_index", lambda: archives.extract_members(checked, self.journal.path("extracted")))

    def convert(self) -> None:
        cfg, journal = self.cfg, self.journal

        def report():
            journal.forget("data", "data-groups")
            done = convert.convert_batch(self.spark, journal.read("extracted_index"), journal.path("data"), workers=cfg.workers,
                                         size_bytes="csv_bytes", quarantine=cfg.quarantine, timeout_s=cfg.timeout_s)
            deferred = self._deferred()
            late = deferred.select(*[F.col(f.name) if f.name in deferred.columns
                                     else F.lit("deferred" if f.name == "status" else None).cast(f.dataType).alias(f.name)
                                     for f in INGEST_REPORT.fields])
            return done.unionByName(late)

        written = journal.table("report", report)
        journal.table("manifest", lambda: convert.manifest_of(written), fmt="csv", header="true")

    def publish_plan(self) -> None:
        # written before any folder moves: a repeated task or step must not look for what has moved
        data = self.journal.path("data")
        landed = fs.landed_files(self.spark, data) if fs.exists(self.spark, data) else \
            self.spark.createDataFrame([], "rel_path string, rel_dir string, length long")
        manifest = read_manifest(self.spark, self.journal.run)
        self.journal.table("publish_plan", lambda: publish.publish_plan(manifest, landed, self.data_root + "/"))

    def publish(self) -> None:
        plan = self.journal.read("publish_plan")
        self.journal.table("published", lambda: publish.execute_publish(plan, self.journal.path("data"), move=not self.cfg.keep_staging))

    def catalog(self) -> dict:
        spark = self.spark
        stamped = read_manifest(spark, self.journal.run).select("productId") if self.cfg.strict_parity else self._published()
        fresh = self.journal.read("catalog.parquet")
        # a step that died behind its commit finds it again: it is not committed twice
        base = self.journal.facts("plan")["base"]
        mine = catalog_store.commit_of(spark, self.catalog_dir, self.journal.run, since=base)
        if mine is None:
            folder_ids = inventory.existing_ids(inventory.folder_inventory(spark, self.data_root))

            def build(stored: DataFrame, planned_on: DataFrame | None) -> DataFrame:
                rows = fresh if planned_on is None else catalog_store.with_news(fresh, stored, planned_on)
                return refresh_catalog(rows, stored, stamped, folder_ids, self.as_of)

            mine = catalog_store.commit(spark, self.catalog_dir, build, STORED_CATALOG, base, note=self.journal.run)
        return {"path": mine}

    def register(self) -> dict:
        spark = self.spark
        # output columns of this run's datasets: tables are declared with them
        # instead of inferring schemas from the files, also by later sessions
        held = self._report().where(F.col("status") == "ok").join(self._published(), "productId", "left_semi")
        schema_history.record(held, self._items(), self.schemas_dir, self.journal.run, self.as_of)
        schemas = {r.productId: list(r.columns) for r in schema_history.of_run(spark, self.schemas_dir, self.journal.run).collect()}
        path = self.journal.facts("catalog")["path"]
        # another run may have committed since
        newest = catalog_store.snapshot_path(spark, self.catalog_dir, catalog_store.latest_commit(spark, self.catalog_dir)) or path
        return sync_tables(spark, self.data_root, newest, self.cfg.db, refreshed=self._published(), schemas=schemas,
                           catalog=self.journal.read("catalog.parquet"))

    def clean(self) -> dict:
        counts = convert.ingest_summary(self._report().where(F.col("status") != "deferred")).first().asDict()
        counts["n_deferred"] = self._deferred().count()
        if not self.cfg.keep_staging:
            # published and registered: the bulky copies of this run are no longer
            # needed (work list, report, manifest and publish result stay for audit)
            self.journal.forget("extracted", "data", "data-groups")
        return counts

    def outcome(self) -> dict:
        facts = self.journal.facts
        return {"run": self.journal.run, "as_of": self.as_of, "plan": facts("plan")["summary"], "ingest": facts("clean"),
                "registered": facts("register"), "catalog_path": facts("catalog")["path"], "report": self._report()}


def read_manifest(spark: SparkSession, run: str) -> DataFrame:
    """The manifest of a run (fixed schema; zero rows is a normal outcome)."""
    return spark.read.schema(MANIFEST).option("header", "true").csv(f"{run}/manifest")
