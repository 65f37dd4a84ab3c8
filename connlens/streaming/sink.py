"""A streaming sink of Parquet files with a commit protocol, as a Python data source.

Tasks write their rows to files of unique names below <path>/data and report the names.  Only when all tasks of a
micro-batch are done does the driver write <path>/commits/<batch>.json with those names, moved into place whole; a
failed batch's files are deleted.  ``committed`` reads the rows of listed files alone, so nothing of a failed or
unfinished batch is ever seen, and a batch that runs again after a restart replaces its own list.

    spark.dataSource.register(CommittedParquet)
    df.writeStream.format("committed_parquet").option("path", path).option("checkpointLocation", ...)

``path`` is any URI that pyarrow's file systems reach from the driver and the executors.  Columns keep their types;
an empty micro-batch commits an empty list; null values and repeated rows are written as they are.
"""

from __future__ import annotations

import contextlib
import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import pyarrow.fs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamArrowWriter, WriterCommitMessage
from pyspark.sql.types import StructType


@dataclass
class Written(WriterCommitMessage):
    files: list[str] = field(default_factory=list)


class CommittedParquet(DataSource):
    @classmethod
    def name(cls) -> str:
        return "committed_parquet"

    def schema(self) -> str:
        raise NotImplementedError("a sink only: read it with committed()")

    def streamWriter(self, schema: StructType, overwrite: bool) -> CommittedParquetWriter:
        return CommittedParquetWriter(self.options["path"])


def _store(path: str) -> tuple[pyarrow.fs.FileSystem, str]:
    return pyarrow.fs.FileSystem.from_uri(path)


class CommittedParquetWriter(DataSourceStreamArrowWriter):
    def __init__(self, path: str):
        self.path = path.rstrip("/")

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        fs, root = _store(self.path)
        name, writer = f"part-{uuid.uuid4().hex}.parquet", None
        try:
            for batch in iterator:
                if batch.num_rows:
                    if writer is None:
                        fs.create_dir(f"{root}/data", recursive=True)
                        writer = pq.ParquetWriter(f"{root}/data/{name}", batch.schema, filesystem=fs)
                    writer.write_batch(batch)
        except BaseException:
            if writer is not None:
                writer.close()
                with contextlib.suppress(OSError):
                    fs.delete_file(f"{root}/data/{name}")
            raise
        if writer is None:
            return Written([])
        writer.close()
        return Written([name])

    def commit(self, messages: list[Written | None], batchId: int) -> None:
        fs, root = _store(self.path)
        fs.create_dir(f"{root}/commits", recursive=True)
        files = [f for m in messages if m is not None for f in m.files]
        staged = f"{root}/commits/.{batchId}-{uuid.uuid4().hex}"
        with fs.open_output_stream(staged) as out:
            out.write((json.dumps({"batch": batchId, "files": files}) + "\n").encode())
        fs.move(staged, f"{root}/commits/{batchId}.json")

    def abort(self, messages: list[Written | None], batchId: int) -> None:
        fs, root = _store(self.path)
        for name in (f for m in messages if m is not None for f in m.files):
            with contextlib.suppress(OSError):
                fs.delete_file(f"{root}/data/{name}")


def committed(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The rows of committed batches, with their ``batch``."""
    from connlens.streaming.jobs import read_if_exists

    if read_if_exists(spark, f"{path}/data") is None or read_if_exists(spark, f"{path}/commits", "json") is None:
        return spark.createDataFrame([], schema).withColumn("batch", F.lit(None).cast("long"))
    lists = spark.read.schema("batch long, files array<string>").json(f"{path}/commits").select("batch", F.explode("files").alias("__file"))
    rows = spark.read.schema(schema).parquet(f"{path}/data").withColumn("__file", F.col("_metadata.file_name"))
    return rows.join(lists, "__file").drop("__file")
