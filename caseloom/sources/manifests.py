"""Numbered manifests: a state of a stored table shows at once or not at all.

A manifest is a small Parquet table in folder/<number>; it is complete once its
_SUCCESS file is there.  Readers take the highest complete number.  Writing a
number that exists fails, so of two writers one has to read again.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession


def exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place)


def numbers(spark: SparkSession, folder: str) -> list[int]:
    """Numbers of the complete manifests, least first."""
    if not exists(spark, folder):
        return []
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    listed = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(place)
    names = [s.getPath().getName() for s in listed]
    return sorted(int(n) for n in names if re.fullmatch(r"[0-9]+", n) and exists(spark, f"{folder}/{n}/_SUCCESS"))


def publish(spark: SparkSession, folder: str, rows: list[tuple], schema: str) -> int:
    """Write the next manifest; rows are as many as the parts of a table, not as its rows."""
    number = max(numbers(spark, folder), default=0) + 1
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{folder}/{number:010d}")
    return number


def read(spark: SparkSession, folder: str, number: int | None = None) -> DataFrame | None:
    """The newest manifest or that of a number; None where there is none."""
    known = numbers(spark, folder)
    return spark.read.parquet(f"{folder}/{(number or known[-1]):010d}") if known else None
