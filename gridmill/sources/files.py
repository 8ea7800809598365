"""Files: CSV in several dialects, the newest file, exports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

DIALECTS = (("UTF-8", ","), ("UTF-8", ";"), ("ISO-8859-1", ","), ("ISO-8859-1", ";"))


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None, encoding: str = "UTF-8", separator: str = ",", exclude: Sequence[str] = ()) -> DataFrame:
    reader = spark.read.option("header", True).option("encoding", encoding).option("sep", separator)
    return (reader.schema(schema) if schema else reader).csv(path).drop(*exclude)


def is_utf8(spark: SparkSession, path: str) -> bool:
    """Whether all lines are valid UTF-8. The CSV reader replaces bytes that are not."""
    return spark.read.text(path).where(~F.is_valid_utf8("value")).isEmpty()


def read_csv_any(spark: SparkSession, path: str, expected: Sequence[str]) -> DataFrame:
    """The first dialect that the bytes allow and under which the header has the expected
    columns."""
    utf8 = is_utf8(spark, path)
    for encoding, separator in DIALECTS:
        if encoding == "UTF-8" and not utf8:
            continue
        df = read_csv(spark, path, encoding=encoding, separator=separator)
        if set(expected) <= set(df.columns):
            return df
    raise ValueError(f"no known dialect gives {path} the columns {list(expected)}")


def newest_file(spark: SparkSession, folder: str, pattern: str = "*") -> str | None:
    """The latest modified file of a folder. Only file listings are read, no contents."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder).select("path", "modificationTime")
    row = files.agg(F.max(F.struct("modificationTime", "path")).alias("m")).first()
    return row["m"]["path"] if row["m"] else None


def write_csv(df: DataFrame, path: str) -> None:
    df.write.option("header", True).mode("overwrite").csv(path)
