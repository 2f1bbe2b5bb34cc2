"""Numbered versions of saved tables: a version is complete or not there.

A version is a folder ``<path>/v<number>``; it counts once its table ``last`` was committed (``_SUCCESS``),
so a writer puts that table last.  A killed writer leaves the version before in force and writes
the same number again.  One writer at a time.
"""

from __future__ import annotations

from pyspark.sql import SparkSession


def children(spark: SparkSession, path: str) -> list[str]:
    """Names of the files and folders in ``path``; none if it does not exist."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = place.getFileSystem(spark._jsc.hadoopConfiguration())
    return [f.getPath().getName() for f in system.listStatus(place)] if system.exists(place) else []


def complete(spark: SparkSession, path: str, last: str = "") -> list[int]:
    """The numbers of the complete versions below ``path``, ascending."""
    numbers = sorted(int(n[1:]) for n in children(spark, path) if n[:1] == "v" and n[1:].isdigit())
    return [v for v in numbers if "_SUCCESS" in children(spark, f"{path}/v{v}/{last}".rstrip("/"))]
