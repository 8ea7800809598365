"""Exports to numbered files of a fixed number of rows.

Rows are numbered without gathering them: they are stored once, each stored file's rows
are counted, a running sum over the files (a row a file) tells how many come before each,
and the position of a row in its file does the rest. Rows of one part then meet in one
task, which may write many parts.

The writer is a data source of its own, with Spark's commit: tasks write files under names
of their own in a staging folder; what the driver commits is one attempt's files of each
task, moved to ``batch_<n>.parquet``. An attempt that fails leaves nothing under such a name.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from gridmill.sources.tables import EXPORT_ROWS, scratch_folder

_PART, _NUMBER, _STAGING = "_part", "_number", "_staging"


def _open(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path)


@dataclass
class Parts(WriterCommitMessage):
    """Part number, staged name and rows of each file that a task wrote."""

    files: list


class NumberedWriter(DataSourceArrowWriter):
    def __init__(self, path: str, rows: int):
        self.path, self.rows = path.rstrip("/"), rows

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Parts:
        files: list = []
        sink = fs = root = None
        try:
            for batch in iterator:
                if fs is None:
                    fs, root = _open(self.path)
                    fs.create_dir(f"{root}/{_STAGING}", recursive=True)
                parts = batch.column(_PART).to_pylist()
                data = batch.drop_columns([_PART, _NUMBER])
                at = 0
                while at < len(parts):
                    end = at
                    while end < len(parts) and parts[end] == parts[at]:
                        end += 1
                    if not files or files[-1][0] != parts[at]:
                        if sink is not None:
                            sink.close()
                        files.append([parts[at], f"{uuid.uuid4().hex}.parquet", 0])
                        sink = pq.ParquetWriter(f"{root}/{_STAGING}/{files[-1][1]}", data.schema, compression="snappy", filesystem=fs)
                    sink.write_batch(data.slice(at, end - at))
                    files[-1][2] += end - at
                    at = end
        finally:
            if sink is not None:
                sink.close()
        return Parts(files)

    def commit(self, messages: list) -> None:
        fs, root = _open(self.path)
        parts = sorted(f for m in messages if m is not None for f in m.files)
        if [p for p, _, _ in parts] != list(range(1, len(parts) + 1)) or any(n != self.rows for _, _, n in parts[:-1]):
            raise ValueError(f"parts are missing or of wrong size: {[(p, n) for p, _, n in parts][:20]}")
        fs.create_dir(root, recursive=True)
        for old in fs.get_file_info(pafs.FileSelector(root)):
            if old.base_name.startswith("batch_") and old.extension == "parquet":
                fs.delete_file(old.path)
        for part, name, _ in parts:
            fs.move(f"{root}/{_STAGING}/{name}", f"{root}/batch_{part}.parquet")
        self._clear(fs, root)

    def abort(self, messages: list) -> None:
        self._clear(*_open(self.path))

    @staticmethod
    def _clear(fs: pafs.FileSystem, root: str) -> None:
        if fs.get_file_info(f"{root}/{_STAGING}").type == pafs.FileType.Directory:
            fs.delete_dir(f"{root}/{_STAGING}")


class NumberedParquet(DataSource):
    @classmethod
    def name(cls) -> str:
        return "numbered_parquet"

    def schema(self) -> str:
        raise NotImplementedError("only written; read the files as parquet")

    def writer(self, schema, overwrite: bool) -> NumberedWriter:
        return NumberedWriter(self.options["path"], int(self.options["rows"]))


def numbered(df: DataFrame, rows: int = EXPORT_ROWS, order: Sequence[str] = ()) -> DataFrame:
    """``df`` with the number of each row (from 0) and its part (from 1): in ``order``, or as
    the rows come. They are stored meanwhile, so that numbers hold when a task is repeated."""
    spark = df.sparkSession
    path = scratch_folder(spark, "numbered")
    (df.orderBy(*order) if order else df).write.parquet(path)
    held = spark.read.schema(df.schema).parquet(path).select("*", F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_at"))
    before = Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)  # a row a file; files are named in the order of their tasks
    starts = held.groupBy("_file").agg(F.count("*").alias("_n")).select("_file", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    number = F.col("_before") + F.col("_at")
    return held.join(starts, "_file").select(*df.columns, number.alias(_NUMBER), (F.floor(number / rows) + 1).alias(_PART))


def export_numbered(df: DataFrame, path: str, rows: int = EXPORT_ROWS, order: Sequence[str] = ()) -> None:
    """Exactly ceil(n / rows) files ``batch_1.parquet`` and on, all full but the last."""
    spark: SparkSession = df.sparkSession
    spark.dataSource.register(NumberedParquet)
    parts = numbered(df, rows, order).repartition(_PART).sortWithinPartitions(_PART, _NUMBER)
    parts.write.format("numbered_parquet").option("path", path).option("rows", rows).mode("append").save()
