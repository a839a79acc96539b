"""Plan refreshes as new listing snapshots land.

A folder receives one listing snapshot per discovery run: a document, or a
sub-folder (or a set of `part-*` files) holding the parts of one. A file
stream picks up only documents not seen before (the checkpoint remembers
them); all that landed since the last call is one micro-batch, and the newest
snapshot of it is classified once against the stored catalog, like a batch
run. Older snapshots of the batch are out of date and are not planned.

Output is written per epoch with overwrite, so a replayed micro-batch after
a failure rewrites its own folder instead of appending twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.refresh import _now, plan_run
from ..schemas import STORED_CATALOG
from ..session import shared_root
from ..sources import catalog_store, listing


def newest_snapshot(docs: DataFrame, listings_dir: str) -> DataFrame:
    """The documents of the newest snapshot in `docs` (_doc, _at, value): by
    modification time, then name."""
    folder = F.regexp_extract("_doc", r"^(.*)/[^/]*$", 1)
    name = F.regexp_extract("_doc", r"([^/]*)$", 1)
    top = F.lit(listings_dir.rstrip("/").rsplit("/", 1)[-1])
    alone = (F.url_decode(F.regexp_extract(folder, r"([^/]*)$", 1)) == top) & ~name.startswith("part-")
    marked = docs.withColumn("_snapshot", F.when(alone, F.col("_doc")).otherwise(folder))
    last = marked.agg(F.max(F.struct("_at", "_doc", "_snapshot")).alias("m")).first().m
    return marked.where(F.col("_snapshot") == F.lit(last["_snapshot"] if last else None)).select("_doc", "value")


def watch_listings(spark: SparkSession, listings_dir: str, catalog_dir: str, out_dir: str,
                   checkpoint: str | None = None, as_of: str | None = None, limit: int | None = None,
                   available_now: bool = True, processing_time: str = "10 minutes",
                   mapping: dict | None = None):
    """Start the stream; returns the StreamingQuery (already finished when
    `available_now`)."""
    checkpoint = checkpoint or f"{shared_root(spark)}/cubeshelf-streams/listing-watch"
    docs = (spark.readStream.format("text").option("wholetext", "true").option("recursiveFileLookup", "true")
            .load(listings_dir)
            .select(F.col("_metadata.file_path").alias("_doc"), F.col("_metadata.file_modification_time").alias("_at"), "value"))

    def plan_batch(batch: DataFrame, epoch: int) -> None:
        newest = newest_snapshot(batch, listings_dir)
        fresh = listing.flatten_documents(newest)
        stored = catalog_store.read_catalog(batch.sparkSession, catalog_dir, STORED_CATALOG)
        work, _ = plan_run(fresh, stored, _now(as_of), limit, mapping)
        work.withColumn("epoch", F.lit(epoch)).write.mode("overwrite").parquet(f"{out_dir}/epoch={epoch}")

    writer = docs.writeStream.foreachBatch(plan_batch).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=processing_time)
    q = writer.start()
    if available_now:
        q.awaitTermination()
    return q
