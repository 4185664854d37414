"""Tables that are replaced in one step.

A version of a table is a folder of its own; a small manifest names the folder, its
schema and what was counted while it was written.  The manifest is the last thing
written and appears by a rename, so a reader sees the old version or the new one,
never a mixture; a failed write leaves nothing but an unnamed folder.  Frames read
from an older version keep working until ``drop_old`` removes it, also when the
new version has another schema.

Counts come from the write itself (``DataFrame.observe`` directly under the
writer, whose tasks each count once), so nobody has to scan a layer to count it.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from workpulse.sources.io import table_path

MANIFESTS = "_versions"


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def manifests(spark: SparkSession, root: str, layer: str, name: str) -> list[str]:
    """The names of a table's manifests, oldest first."""
    fs, path = _fs(spark, f"{table_path(root, layer, name)}/{MANIFESTS}")
    if not fs.exists(path):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(path) if s.getPath().getName().endswith(".json"))


def manifest(spark: SparkSession, root: str, layer: str, name: str, which: int = -1) -> dict | None:
    """A table's current manifest (or an older one), None where it has none."""
    found = manifests(spark, root, layer, name)
    if not found:
        return None
    path = f"{table_path(root, layer, name)}/{MANIFESTS}/{found[which]}"
    return json.loads("\n".join(r.value for r in spark.read.text(path, wholetext=True).collect()))


def observed(df: DataFrame, metrics: Mapping[str, Column] | None = None) -> tuple[DataFrame, Observation]:
    """``df`` and what counts its rows, and sums ``metrics``, in the action that
    consumes it."""
    seen = Observation(f"rows-{uuid.uuid4().hex}")
    return df.observe(seen, F.count(F.lit(1)).alias("rows"),
                      *[F.coalesce(F.sum(c.cast("long")), F.lit(0)).alias(k)
                        for k, c in (metrics or {}).items()]), seen


def publish_version(df: DataFrame, root: str, layer: str, name: str, fmt: str = "parquet",
                    partition_by: Sequence[str] | None = None,
                    metrics: Mapping[str, Column] | None = None,
                    cluster_by: Sequence[str] | None = None) -> dict:
    """Write ``df`` as the next version of ``root/layer/name``; returns its manifest.
    ``cluster_by`` writes ranges of these columns, sorted, so that a reader's filter
    on them skips files and row groups by their statistics."""
    if cluster_by:
        df = df.repartitionByRange(*cluster_by).sortWithinPartitions(*cluster_by)
    spark, base = df.sparkSession, table_path(root, layer, name)
    number = 1 + max((int(m.split("-")[0]) for m in manifests(spark, root, layer, name)), default=0)
    folder = f"v{number:06d}-{uuid.uuid4().hex[:12]}"
    counted, seen = observed(df, metrics)
    writer = counted.write.format(fmt)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(f"{base}/{folder}")
    last = [f for f in df.schema.fields if f.name in (partition_by or ())]
    schema = StructType([f for f in df.schema.fields if f not in last] + last)
    entry = {"folder": folder, "format": fmt, "metrics": dict(seen.get), "schema": schema.jsonValue()}
    fs, temp = _fs(spark, f"{base}/{MANIFESTS}/.{uuid.uuid4().hex}")
    out = fs.create(temp, True)
    out.write(bytearray(json.dumps(entry).encode()))
    out.close()
    done = spark._jvm.org.apache.hadoop.fs.Path(f"{base}/{MANIFESTS}/{number:012d}-{uuid.uuid4().hex[:12]}.json")
    if not fs.rename(temp, done):
        raise OSError(f"the manifest of {base} could not be put in place")
    return entry


def load_version(spark: SparkSession, root: str, layer: str, name: str, which: int = -1) -> DataFrame:
    """The current version of a table (or an older one: -2 is the one before)."""
    entry = manifest(spark, root, layer, name, which)
    if entry is None:
        raise FileNotFoundError(f"{table_path(root, layer, name)} has no version")
    return spark.read.format(entry["format"]).schema(StructType.fromJson(entry["schema"])).load(
        f"{table_path(root, layer, name)}/{entry['folder']}")


def drop_old(spark: SparkSession, root: str, layer: str, name: str, keep: int = 2) -> int:
    """Delete all but the ``keep`` latest versions, manifest first; returns how many."""
    base, old = table_path(root, layer, name), manifests(spark, root, layer, name)[:-keep]
    for k, m in enumerate(old):
        folder = manifest(spark, root, layer, name, 0)["folder"]
        for path in (f"{base}/{MANIFESTS}/{m}", f"{base}/{folder}"):
            fs, p = _fs(spark, path)
            fs.delete(p, True)
    return len(old)
