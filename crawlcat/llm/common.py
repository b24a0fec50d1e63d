"""Reading tables and cutting lineage through the shared folder."""

from __future__ import annotations

import ctypes
import functools
import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """A new folder name under ``spark.checkpoint.dir``.

    Where that is unset, a temporary folder stands in for it in local mode,
    whose executors are this process; on a cluster it is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        root = tempfile.mkdtemp(prefix="crawlcat-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/crawlcat-{uuid.uuid4().hex}"


#: Rows of a narrow table in one file, at least, where their number is known.
FILE_ROWS = 50_000


def written(df: DataFrame, name: str, rows: int | None = None, under: str | None = None) -> DataFrame:
    """``df`` as a Parquet table in the shared folder; survives the loss of any executor.

    ``rows`` is a bound on its rows where one is known: a small table then
    comes in few files, however many partitions it is made in.  ``under`` is a
    folder from ``shared_dir`` that the caller removes when it is used up.
    """
    path = f"{under or shared_dir(df.sparkSession)}/{name}"
    (df if rows is None else df.coalesce(max(1, -(-rows // FILE_ROWS)))).write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def removed(spark: SparkSession, folder: str) -> None:
    """Remove a folder of tables that nothing reads any more."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def unused(name: str, columns: list[str]) -> str:
    """``name`` with underscores before it until no column is called so, whatever the case."""
    taken = {c.lower() for c in columns}
    while (name := f"_{name}").lower() in taken:
        pass
    return name


def released(stage):
    """An Arrow stage that gives its memory back at its end: Spark keeps the Python worker for stages to come."""

    @functools.wraps(stage)
    def run(batches):
        try:
            yield from stage(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
            if trim:
                trim(0)

    return run
