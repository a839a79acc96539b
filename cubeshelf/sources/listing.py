"""The dataset listing (JSON) flattened into the fresh catalog.

The listing is a JSON array of cube objects. Each element becomes one catalog
row; missing keys give null, a missing `dimensions` list counts 0, and the
element position is kept as `ordinal` (listing order decides "first").
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import CUBE

# Ids arrive as numbers or as text: they are read as text and cast.
_CUBE = T.StructType([T.StructField(f.name, T.StringType()) if f.name == "productId" else f for f in CUBE.fields])
_LISTING = T.ArrayType(_CUBE)


def _project(cube: Column, ordinal: Column) -> list[Column]:
    dims = cube.getField("dimensions")
    return [
        # numbers and numbers as text are ids alike; anything else is null and refused by the refresh
        cube.getField("productId").try_cast("bigint").alias("productId"),
        cube.getField("cubeTitleEn").alias("title"),
        cube.getField("subjectEn").alias("subject"),
        cube.getField("frequencyCode").alias("frequency"),
        cube.getField("releaseTime").alias("releaseTime"),
        # size(null) is null under ANSI, so a missing list is made empty first.
        F.size(F.coalesce(dims, F.array().cast("array<string>"))).alias("dimensions"),
        cube.getField("nbDatapointsCube").alias("nbDatapoints"),
        ordinal.cast("bigint").alias("ordinal"),
    ]


def flatten_listing(docs: DataFrame, text: str = "value") -> DataFrame:
    """Rows holding whole JSON array documents -> one row per element.
    `ordinal` is the position inside its document."""
    parsed = docs.select(F.posexplode(F.from_json(F.col(text), _LISTING)).alias("pos", "cube"))
    return parsed.select(_project(F.col("cube"), F.col("pos")))


def flatten_cubes(rows: DataFrame, text: str, ordinal: str) -> DataFrame:
    """Rows holding one JSON cube object each (JSON-lines form, splittable)
    -> catalog rows; `ordinal` is taken from the given column."""
    parsed = rows.select(F.from_json(F.col(text), _CUBE).alias("cube"), F.col(ordinal).alias("_ord"))
    return parsed.select(_project(F.col("cube"), F.col("_ord")))


def flatten_documents(docs: DataFrame, doc: str = "_doc", text: str = "value") -> DataFrame:
    """Rows of (document name, JSON array text) -> catalog rows with a global
    `ordinal`: position inside the document plus the number of elements in
    all documents whose name sorts earlier (an offset table with one row per
    document, broadcast back)."""
    bad = F.raise_error(F.concat(F.lit("not a JSON array of datasets: "), F.col(doc)))
    exploded = docs.select(F.col(doc).alias("_doc"),
                           F.posexplode(F.coalesce(F.from_json(F.col(text), _LISTING), bad)).alias("pos", "cube"))
    sizes = exploded.groupBy("_doc").agg(F.count(F.lit(1)).alias("_n"))
    # one row per listing document: a single-partition window is fine here
    offsets = sizes.select("_doc", F.coalesce(
        F.sum("_n").over(Window.orderBy("_doc").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_off"))
    placed = exploded.join(offsets, "_doc")
    return placed.select(_project(F.col("cube"), F.col("_off") + F.col("pos")))


def read_listing(spark: SparkSession, path: str) -> DataFrame:
    """Listing file(s) -> fresh catalog.

    `path` is one JSON array document or a folder of them (a large listing
    split into parts, in file-name order). Each document is parsed by one
    task; `ordinal` is the global position across documents."""
    docs = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("_doc"), "value")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return flatten_documents(docs).repartition(n, "productId")


#: Rows of a written listing document.
ROWS_PER_DOCUMENT = 10_000


def write_listing(cubes: DataFrame, path: str, order: str = "productId", parts: int = 8) -> None:
    """Write cube rows (CUBE fields) as JSON array documents: rows are
    range-partitioned on `order`, and each task writes its own slice as one
    array, so file-name order is listing order. There are `parts` slices, or
    more so that none has much over ROWS_PER_DOCUMENT rows."""
    from ..session import ship_package
    ship_package(cubes.sparkSession)
    parts = max(parts, -(-cubes.count() // ROWS_PER_DOCUMENT))
    ranged = cubes.repartitionByRange(parts, order).sortWithinPartitions(order)

    def as_array(batches):
        import json
        import pandas as pd
        rows = []
        for pdf in batches:
            rows.extend(pdf.to_dict("records"))
        if rows:
            clean = [{k: (v.tolist() if hasattr(v, "tolist") else v) for k, v in r.items()
                      if v is not None and not (isinstance(v, float) and v != v)} for r in rows]
            yield pd.DataFrame({"value": [json.dumps(clean)]})

    ranged.mapInPandas(as_array, "value string").write.text(path)
