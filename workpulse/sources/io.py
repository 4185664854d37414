"""Sources and sinks: delimited extracts with lineage, layered table
publication, lineage cuts, temp views, catalog inventory and serving copies.

Paths are URIs handed to Spark as-is (``file:``, ``s3a:``, ``abfss:`` ...);
gzip-compressed extracts are decompressed by the reader.  Nothing here
collects data to the driver except the per-table row counts of
``catalog_inventory`` (one number per table).
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DoubleType, FloatType, TimestampType

from workpulse.session import ensure_checkpoint_dir

# Source extract dialect.
EXTRACT_OPTIONS = {
    "header": "true", "sep": "|", "quote": '"', "escape": '"', "nullValue": "[NULL]",
    "mode": "PERMISSIVE", "multiLine": "false", "inferSchema": "false",
}


# --------------------------------------------------------------------------- sources

def read_extract(spark: SparkSession, paths: str | Sequence[str], sep: str = "|",
                 null_token: str = "[NULL]", schema=None, **options) -> DataFrame:
    """Delimited extract(s) -> all-string DataFrame.  ``paths`` may be a file,
    a directory, a glob (``timesheet_*.csv``) or a list of them."""
    opts = dict(EXTRACT_OPTIONS, sep=sep, nullValue=null_token, **options)
    reader = spark.read.options(**opts)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.csv(list(paths) if not isinstance(paths, str) else paths)


def new_batch_id(now: dt.datetime | None = None) -> str:
    return (now or dt.datetime.now()).strftime("%Y%m%d_%H%M%S")


def with_lineage(df: DataFrame, batch_id: str | None = None, source_col: str = "_source_file",
                 ingested_col: str = "_ingested_at", batch_col: str = "_batch_id") -> DataFrame:
    """Source file (from the file source's hidden ``_metadata``), ingest time and
    one batch id for the whole run."""
    return df.withColumns({
        source_col: F.col("_metadata.file_path"),
        ingested_col: F.current_timestamp(),
        batch_col: F.lit(batch_id or new_batch_id()),
    })


def table_path(root: str, layer: str, name: str) -> str:
    return f"{root.rstrip('/')}/{layer}/{name}"


def load(spark: SparkSession, root: str | None, layer: str, name: str,
         fmt: str = "parquet") -> DataFrame:
    """Read a published table: from ``root/layer/name`` (its current version, where
    it has versions) or, with ``root=None``, from the catalog as ``layer.name``."""
    if root is None:
        return spark.table(f"{layer}.{name}")
    from workpulse.sources import versions
    if versions.manifests(spark, root, layer, name):
        return versions.load_version(spark, root, layer, name)
    return spark.read.format(fmt).load(table_path(root, layer, name))


def date_spine_between(spark: SparkSession, start: dt.date | str, end: dt.date | str,
                       col: str = "calendar_date") -> DataFrame:
    """Literal date spine (one row per day, both ends included)."""
    return spark.range(1).select(F.explode(F.sequence(
        F.lit(str(start)).cast("date"), F.lit(str(end)).cast("date"),
        F.expr("INTERVAL 1 DAY"))).alias(col))


def frame_from_records(spark: SparkSession, records: Iterable, schema) -> DataFrame:
    """Small driver-side records (metadata, reports) with an explicit schema."""
    return spark.createDataFrame(list(records), schema)


# --------------------------------------------------------------------------- sinks

def publish(df: DataFrame, root: str | None, layer: str, name: str, fmt: str = "parquet",
            mode: str = "overwrite", partition_by: Sequence[str] | None = None,
            max_records_per_file: int | None = None, bucket_by: tuple[int, Sequence[str]] | None = None) -> str:
    """Overwrite a layer table.  With ``root`` the table is a directory
    ``root/layer/name``; with ``root=None`` it is a managed table ``layer.name``
    (schema created if missing, schema replaced on overwrite).  ``bucket_by`` (number,
    keys) clusters a managed table: lookups and joins by the keys do not shuffle it."""
    w = df.write.mode(mode).format(fmt)
    if bucket_by:
        if root is not None:
            raise ValueError("bucketing needs a managed table (root=None)")
        w = w.bucketBy(bucket_by[0], *bucket_by[1]).sortBy(*bucket_by[1])
    if partition_by:
        w = w.partitionBy(*partition_by)
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", max_records_per_file)
    if root is None:
        spark = df.sparkSession
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {layer}")
        w.option("overwriteSchema", "true").saveAsTable(f"{layer}.{name}")
        return f"{layer}.{name}"
    path = table_path(root, layer, name)
    w.save(path)
    return path


def scratch_path(spark: SparkSession, label: str = "scratch") -> str:
    """A fresh folder under the session's checkpoint directory (the shared
    folder the cluster names), never a machine-local temp folder."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/workpulse-{label}/{uuid.uuid4().hex}"


def materialize(df: DataFrame, eager: bool = True) -> DataFrame:
    """Cut the lineage: reliable checkpoint into ``spark.checkpoint.dir``
    (survives executor loss, unlike a local checkpoint)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=eager)


def write_extract(df: DataFrame, path: str, sep: str = "|", null_token: str = "[NULL]",
                  compression: str | None = None) -> str:
    """Write a delimited extract in the source dialect (tests, exports)."""
    w = df.write.mode("overwrite").option("header", "true").option("sep", sep) \
        .option("quote", '"').option("escape", '"').option("nullValue", null_token) \
        .option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false")
    if compression:
        w = w.option("compression", compression)
    w.csv(path)
    return path


def register_views(frames: Mapping[str, DataFrame]) -> list[str]:
    for name, df in frames.items():
        df.createOrReplaceTempView(name)
    return list(frames)


def catalog_inventory(spark: SparkSession, names: Sequence[str]) -> DataFrame:
    """(table_name, row_count, column_count, exists) for each name; missing
    tables are reported, not raised.  Counts are lazy aggregates."""
    parts = []
    for n in names:
        if spark.catalog.tableExists(n):
            t = spark.table(n)
            parts.append(t.agg(F.count(F.lit(1)).alias("row_count")).select(
                F.lit(n).alias("table_name"), "row_count",
                F.lit(len(t.columns)).alias("column_count"), F.lit(True).alias("exists")))
        else:
            parts.append(spark.range(1).select(
                F.lit(n).alias("table_name"), F.lit(None).cast("long").alias("row_count"),
                F.lit(None).cast("int").alias("column_count"), F.lit(False).alias("exists")))
    out = parts[0]
    for p in parts[1:]:
        out = out.union(p)      # identical (table_name, row_count, column_count, exists) parts
    return out


def serving_projection(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Allow-listed columns only (lineage and personal fields fall away),
    timestamps named ``*_date`` coerced to dates, NaN -> NULL."""
    out = df.select(*[c for c in columns if c in df.columns])
    casts = {}
    for f in out.schema.fields:
        if isinstance(f.dataType, (DoubleType, FloatType)):
            casts[f.name] = F.when(~F.isnan(f.name), F.col(f.name))
        elif isinstance(f.dataType, TimestampType) and f.name.endswith("_date"):
            casts[f.name] = F.col(f.name).cast(DateType())
    return out.withColumns(casts) if casts else out


def publish_serving(df: DataFrame, columns: Sequence[str], root: str | None, name: str,
                    layer: str = "serving") -> str:
    """Wipe-and-reload serving copy of a table."""
    return publish(serving_projection(df, columns), root, layer, name)
