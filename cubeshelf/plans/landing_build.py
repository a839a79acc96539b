"""A landing folder derived from the test tables, for end-to-end runs.

One dataset per nation that has customers: its CSV holds that nation's
customers (awkward headers included), zipped with a metadata member; the
listing describes every dataset. The CSV rows are written by Spark's
partitioned writer (every task writes its own slice of every nation); only
the final zipping handles one archive per task, streaming file by file.

With `faults`, the archives are what a provider delivers on a bad day, by
nation key modulo 7: 1 an error page, 2 no bytes, 3 no CSV member, 4 a row
too long, 5 no file, 6 a value with a line break in a member with a hard
name; and the datasets of remainder 0 have a hard title and stand twice in
the listing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import fs, listing
from . import testbed as tb

ID_BASE = 10000


def dataset_id(nationkey):
    return F.lit(ID_BASE) + nationkey.cast("bigint")


def customer_cubes(spark: SparkSession, sf_dir: str, title: Column) -> DataFrame:
    """The listing: one dataset per nation with customers; `title` over n_nationkey and n_name."""
    nation = tb.table(spark, sf_dir, "nation")
    region = tb.table(spark, sf_dir, "region")
    counts = tb.table(spark, sf_dir, "customer").groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("n"))
    return (nation.join(region, nation.n_regionkey == region.r_regionkey)
            .join(counts, nation.n_nationkey == counts.c_nationkey)
            .select(dataset_id(F.col("n_nationkey")).alias("productId"), title.alias("cubeTitleEn"),
                    F.col("r_name").alias("subjectEn"), F.lit("Monthly").alias("frequencyCode"),
                    F.lit("2001-08-01T08:30").alias("releaseTime"),
                    F.array(F.lit("GEO"), F.lit("Segment")).alias("dimensions"),
                    (F.col("n") * 4).alias("nbDatapointsCube")))


# Header -> column of `customer`, in order.
COLUMNS = {"Customer Key": "c_custkey", "Name": "c_name", "Nation Key": "c_nationkey", "Segment": "c_mktsegment"}


def build_landing(spark: SparkSession, sf_dir: str, landing: str, n_tasks: int = 8, faults: bool = False,
                  columns: dict[str, str] | None = None) -> DataFrame:
    landing = landing.rstrip("/")
    from ..session import materialize, ship_package
    ship_package(spark)
    cust = tb.table(spark, sf_dir, "customer")
    csv_dir = f"{landing}/_csv"
    (cust.select(F.col("c_nationkey").alias("ds"), *[F.col(c).alias(h) for h, c in (columns or COLUMNS).items()])
     .write.partitionBy("ds").option("header", "true").option("escape", '"').csv(csv_dir))

    files = fs.landed_files(spark, csv_dir).where(F.col("rel_path").endswith(".csv"))
    per_ds = (files.groupBy("rel_dir").agg(F.sort_array(F.collect_list("rel_path")).alias("files"))
              .select(F.regexp_extract("rel_dir", r"ds=(\d+)", 1).cast("bigint").alias("nation"), "files"))

    def zip_datasets(batches):
        import zipfile
        import pandas as pd
        from cubeshelf.sources.paths import open_fs
        for pdf in batches:
            out = []
            for nation, names in zip(pdf["nation"], pdf["files"]):
                pid = ID_BASE + int(nation)
                local, base = open_fs(csv_dir)
                dst_fs, dst = open_fs(f"{landing}/archives/{pid}.zip")
                dst_fs.create_dir(dst.rsplit("/", 1)[0], recursive=True)
                out.append((pid, f"{landing}/archives/{pid}.zip"))
                fault = int(nation) % 7 if faults else 0
                if fault == 5:
                    continue
                if fault in (1, 2):
                    with dst_fs.open_output_stream(dst) as raw:
                        raw.write(b"<html>try later</html>" if fault == 1 else b"")
                    continue
                with dst_fs.open_output_stream(dst) as raw, zipfile.ZipFile(raw, "w", zipfile.ZIP_DEFLATED) as z:
                    if fault == 3:
                        z.writestr("readme.txt", "no data today")
                        continue
                    z.writestr(f"{pid}_MetaData.csv", f'"Cube Title","Product Id"\n"Customers","{pid}"\n')
                    with z.open(f"Données {pid} #1.csv" if fault == 6 else f"{pid}.csv", "w", force_zip64=True) as member:
                        for i, name in enumerate(names):
                            with local.open_input_stream(f"{base}/{name}") as src:
                                # every part file starts with the header line:
                                # keep it once, then stream the rest in chunks
                                head = b""
                                while b"\n" not in head:
                                    chunk = src.read(1 << 16)
                                    if not chunk:
                                        break
                                    head += chunk
                                header, _, rest = head.partition(b"\n")
                                if i == 0:
                                    member.write(header + b"\n")
                                member.write(rest)
                                while True:
                                    chunk = src.read(1 << 20)
                                    if not chunk:
                                        break
                                    member.write(chunk)
                        if fault == 4:
                            member.write(b"1,2,3,4,5\n")
                        if fault == 6:
                            member.write(b'-1,"two\nlines",-1,last\n')
            yield pd.DataFrame(out, columns=["productId", "archive_path"])

    made = per_ds.repartition(n_tasks).mapInPandas(zip_datasets, "productId long, archive_path string")
    made = materialize(made, "landing-archives")  # a lost executor must not zip again

    plain = F.concat(F.lit("Customers in "), F.col("n_name"))
    hard = F.col("n_nationkey") % 7 == 0
    cubes = customer_cubes(spark, sf_dir, F.when(hard & F.lit(faults), F.concat(F.lit("Prix Montréal 50% #1 "), "n_name")).otherwise(plain))
    if faults:
        again = customer_cubes(spark, sf_dir, plain).where((F.col("productId") - ID_BASE) % 7 == 0)
        cubes = cubes.union(again)
    listing.write_listing(cubes, f"{landing}/listing.json", parts=n_tasks)
    return made
