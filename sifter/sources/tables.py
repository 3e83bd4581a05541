"""Reading a Parquet table that may be missing or broken."""
from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession

MISSING = "PATH_NOT_FOUND"
# What Spark raises for files that are no Parquet, or for a folder without any.
CORRUPT = ("CANNOT_READ_FILE_FOOTER", "UNABLE_TO_INFER_SCHEMA", "is not a Parquet file", "FAILED_READ_FILE")


def read_table(spark: SparkSession, path: str, corrupt_as_none: bool = True) -> DataFrame | None:
    """The table at ``path``; None if there is none, or (unless told otherwise)
    if its files are not readable as Parquet. Other errors, such as a refused
    permission or a failed connection, are raised."""
    try:
        df = spark.read.parquet(path)
        df.schema  # noqa: B018 - resolved now, so a missing or broken table shows here
        return df
    except (PySparkException, Py4JJavaError) as exc:
        if MISSING in str(exc):
            return None
        if corrupt_as_none and any(c in str(exc) for c in CORRUPT):
            return None
        raise


def empty_files(spark: SparkSession, paths: list[str]) -> list[str]:
    """Files of zero bytes under ``paths`` (files, folders or patterns), from the
    listing alone; readers have no row for them. Hidden files do not count."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    found = []
    for p in paths:
        path = jvm.org.apache.hadoop.fs.Path(p)
        fs = path.getFileSystem(conf)
        for status in fs.globStatus(path) or []:
            for f in fs.listStatus(status.getPath()) if status.isDirectory() else [status]:
                name = f.getPath().getName()
                if f.getLen() == 0 and not f.isDirectory() and name[:1] not in "_.":
                    found.append(f.getPath().toString())
    return found
