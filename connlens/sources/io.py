"""Scans and sinks.

Every scan takes an explicit schema (no inference).  Sinks write under a folder the
caller names -- on a cluster a shared location such as ``spark.checkpoint.dir``,
never a machine-local temp dir.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from connlens.session import checkpoint_dir

TS_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"
JSON_TS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder under the cluster's shared checkpoint location."""
    return os.path.join(checkpoint_dir(spark), "io", f"{name}-{uuid.uuid4().hex[:12]}")


def read_csv_headerless(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Headerless CSV with an assigned schema; any malformed row fails the job."""
    return (spark.read.schema(schema).option("header", "false").option("mode", "FAILFAST")
            .option("timestampNTZFormat", TS_FORMAT).option("timestampFormat", TS_FORMAT).csv(path))


def write_csv(df: DataFrame, path: str, header: bool = False) -> None:
    (df.write.mode("overwrite").option("header", str(header).lower()).option("timestampNTZFormat", TS_FORMAT)
     .option("timestampFormat", TS_FORMAT).csv(path))


def read_report_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).option("header", "true").option("mode", "FAILFAST").csv(path)


def read_json_records(spark: SparkSession, path: str, schema: T.StructType, required: list[str]) -> DataFrame:
    """JSON lines with a required-field contract: adds ``valid`` (all required fields
    present and the line parsed) and keeps malformed lines in ``_corrupt``."""
    return json_records(spark.read.text(path), schema, required)


def json_records(lines: DataFrame, schema: T.StructType, required: list[str]) -> DataFrame:
    """The same for a table or stream of lines in column ``value``."""
    full = T.StructType([*schema.fields, T.StructField("_corrupt", T.StringType())])
    parsed = F.from_json("value", full, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"})
    df = lines.where("trim(value) <> ''").select(parsed.alias("r")).select("r.*")
    ok = F.col("_corrupt").isNull()
    for c in required:
        ok = ok & F.col(c).isNotNull()
    return df.withColumn("valid", ok)


def write_partitioned(df: DataFrame, path: str, by: str) -> None:
    df.write.mode("overwrite").partitionBy(by).parquet(path)


def fixed6(c: str | Column) -> Column:
    """'%.6f' text of a double (the metric CSV format)."""
    return F.format_string("%.6f", F.col(c) if isinstance(c, str) else c)


def write_json_manifest(row: DataFrame, path: str) -> None:
    """One JSON document per manifest row (``to_json(struct(*))``)."""
    opts = {"timestampNTZFormat": JSON_TS_FORMAT, "timestampFormat": JSON_TS_FORMAT}
    row.select(F.to_json(F.struct(*row.columns), opts).alias("value")).coalesce(1).write.mode("overwrite").text(path)
