"""Intermediate tables in the folder all executors share.

A stored table cuts lineage like ``checkpoint()`` does, but as Parquet, so a
later read takes only the columns it needs.  The folder is the one that the
session names in ``spark.checkpoint.dir``; a temporary folder is made only for
a local master that names none.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_written: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    sc = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not folder:
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="workpulse-llm-"))
        folder = sc.getCheckpointDir()
    return folder.rstrip("/")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a new shared folder and return it as read from there."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/llm-{uuid.uuid4().hex}/{name}"
    df.write.parquet(path)
    _written.append(path)
    return spark.read.schema(df.schema).parquet(path)


def mark() -> int:
    """The place in the list of stored tables, for ``release``."""
    return len(_written)


def drop(spark: SparkSession, table: DataFrame) -> None:
    """Delete one table that ``stored`` returned; nothing may read it any more."""
    for file in table.inputFiles()[:1]:
        for at, path in enumerate(_written):
            if f"/{path.rsplit('/', 2)[1]}/" in file:  # its own folder
                fs_path = spark._jvm.org.apache.hadoop.fs.Path(path).getParent()
                fs_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(fs_path, True)
                del _written[at]
                return


def release(spark: SparkSession, since: int = 0, keep: int = 0) -> int:
    """Delete the tables that ``stored`` has written after ``since`` (a ``mark``), but
    for the last ``keep``; results that still read them must have been written
    first.  Returns how many were deleted."""
    jvm, conf = spark._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    done, gone = 0, _written[since:len(_written) - keep]
    del _written[since:len(_written) - keep]
    for path in gone:
        folder = jvm.org.apache.hadoop.fs.Path(path).getParent()
        done += bool(folder.getFileSystem(conf).delete(folder, True))
    return done
