"""Fixed schemas of the warehouse tables (see README, data model)."""

from __future__ import annotations

from pyspark.sql import types as T

# One element of the dataset listing (a JSON array of these objects).
CUBE = T.StructType([
    T.StructField("productId", T.LongType()),
    T.StructField("cubeTitleEn", T.StringType()),
    T.StructField("subjectEn", T.StringType()),
    T.StructField("frequencyCode", T.StringType()),
    T.StructField("releaseTime", T.StringType()),
    T.StructField("dimensions", T.ArrayType(T.StringType())),
    T.StructField("nbDatapointsCube", T.LongType()),
])
LISTING = T.ArrayType(CUBE)

# Flattened listing ("fresh catalog"); `ordinal` keeps listing order.
FRESH_CATALOG = T.StructType([
    T.StructField("productId", T.LongType()),
    T.StructField("title", T.StringType()),
    T.StructField("subject", T.StringType()),
    T.StructField("frequency", T.StringType()),
    T.StructField("releaseTime", T.StringType()),
    T.StructField("dimensions", T.IntegerType()),
    T.StructField("nbDatapoints", T.LongType()),
    T.StructField("ordinal", T.LongType()),
])

# Stored catalog = fresh catalog + ingestion date + availability flag.
STORED_CATALOG = T.StructType(FRESH_CATALOG.fields + [
    T.StructField("last_ingestion_date", T.TimestampType()),
    T.StructField("available", T.BooleanType()),
])

# Work list handed from planning to ingestion.
WORK_LIST = T.StructType([
    T.StructField("productId", T.LongType()),
    T.StructField("title", T.StringType()),
    T.StructField("frequency", T.StringType()),
    T.StructField("reason", T.StringType()),
    T.StructField("ordinal", T.LongType()),
])

# Manifest of successfully converted datasets.
MANIFEST = T.StructType([
    T.StructField("productId", T.LongType()),
    T.StructField("title", T.StringType()),
    T.StructField("size_mb", T.DoubleType()),
    T.StructField("file_path", T.StringType()),
])

# Outcome of one dataset conversion; the manifest is its `status = 'ok'` part.
INGEST_REPORT = T.StructType([
    T.StructField("productId", T.LongType()),
    T.StructField("title", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("size_mb", T.DoubleType()),
    T.StructField("file_path", T.StringType()),
    T.StructField("error_class", T.StringType()),
    T.StructField("error_message", T.StringType()),
    T.StructField("notes", T.StringType()),          # e.g. columns renamed to stay unique
    T.StructField("columns", T.StringType()),        # JSON list of output column names (all STRING)
])

# The output columns (all STRING) of a dataset after a run; the run is the folder.
SCHEMA_HISTORY = T.StructType([
    T.StructField("productId", T.LongType()),
    T.StructField("folder", T.StringType()),
    T.StructField("as_of", T.TimestampType()),
    T.StructField("columns", T.ArrayType(T.StringType())),
])

FOLDERS = T.StructType([
    T.StructField("folder", T.StringType()),
    T.StructField("ordinal", T.LongType()),
])


def all_string(names: list[str]) -> T.StructType:
    """Every column a nullable STRING; an empty list gives an empty schema."""
    return T.StructType([T.StructField(n, T.StringType(), True) for n in names])
