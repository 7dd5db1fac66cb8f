"""What the operators of this subpackage share.

Conventions of all of them: a column of the input that has the name of a result column is
replaced by it; other extra columns are passed on. Names starting with ``_tw_`` are internal.
"""

from __future__ import annotations

import re

import pyarrow.fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewharf.session import materialize, work_path
from tradewharf.sources.paths import delete_path

#: White space between words where a contract asks for `[^\x20\x09-\x0D]+`.
SPACE = "[ \\t-\\r]+"
SPACE_CHARS = " \t\n\x0b\f\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def space_words(text: Column) -> Column:
    """Words between white space; a null text has none."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACE_CHARS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE))


def row_key(*columns: Column) -> Column:
    """64-bit hash of a whole row's content; used beside an id, never alone."""
    return F.xxhash64(*columns)


def file_system(folder: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """The file system of a folder's URI (file, hdfs, s3, ...) as tasks see it, and the path in it."""
    return pyarrow.fs.FileSystem.from_uri(re.sub("^file:/+", "file:///", folder))


class Scratch:
    """Lineage cuts of one job: written tables in the shared work folder, dropped when done.

    What is not dropped goes with the folder of the application.
    """

    def __init__(self, spark: SparkSession, job: str) -> None:
        self.spark, self.job, self._paths = spark, job, {}

    def cut(self, df: DataFrame, label: str) -> DataFrame:
        self._paths[label] = work_path(self.spark, f"{self.job}-{label}")
        return materialize(df, label, self._paths[label])

    def folder(self, label: str) -> str:
        """A new folder, with the scheme and authority that Spark resolves its path to."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(work_path(self.spark, f"{self.job}-{label}"))
        fs = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
        self._paths[label] = fs.makeQualified(path).toString()
        return self._paths[label]

    def drop(self, *labels: str) -> None:
        for label in labels:
            delete_path(self.spark, self._paths.pop(label))
