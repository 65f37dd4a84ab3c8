"""The committing sink: failures, restarts and repeated commits leave each row once."""

import os

import pytest
from pyspark.sql import functions as F

from connlens.session import ship_package
from connlens.streaming import sink


def start(spark, source, root, fail=False):
    ship_package(spark)
    spark.dataSource.register(sink.CommittedParquet)
    rows = spark.readStream.schema("id long, name string").option("maxFilesPerTrigger", 1).parquet(source)
    if fail:  # one task of the batch that holds row 25 fails after others have written
        rows = rows.withColumn("name", F.when(F.col("id") == 25, F.raise_error(F.lit("broken"))).otherwise(F.col("name")))
    q = (rows.repartition(3).writeStream.format("committed_parquet").option("path", f"file://{root}/sink")
         .option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start())
    q.awaitTermination()


def test_a_failed_batch_leaves_nothing_and_a_restart_gives_each_row_once(spark, tmp_path):
    source, root, schema = str(tmp_path / "in"), str(tmp_path / "run"), "id long, name string"
    for k in range(4):
        spark.range(10 * k, 10 * k + 10).select("id", F.when(F.col("id") % 4 > 0, F.concat(F.lit("n"), "id")).alias("name")).coalesce(1).write.mode("append").parquet(source)
    with pytest.raises(Exception, match="broken"):
        start(spark, source, root, fail=True)
    seen = sorted(r.id for r in sink.committed(spark, f"file://{root}/sink", spark.createDataFrame([], schema).schema).collect())
    assert len(seen) == len(set(seen)) and 25 not in seen and len(seen) % 10 == 0 and len(seen) < 40
    start(spark, source, root)
    start(spark, source, root)  # nothing new
    rows = sink.committed(spark, f"file://{root}/sink", spark.createDataFrame([], schema).schema).collect()
    assert sorted((r.id, r.name) for r in rows) == [(k, f"n{k}" if k % 4 else None) for k in range(40)]
    assert {r.batch for r in rows} == {0, 1, 2, 3}


def test_a_batch_that_is_committed_again_replaces_its_rows(spark, tmp_path):
    import pyarrow as pa

    path = f"file://{tmp_path}/sink"
    schema = spark.createDataFrame([], "id long").schema
    assert sink.committed(spark, path, schema).count() == 0
    writer = sink.CommittedParquetWriter(path)
    first = writer.write(iter([pa.record_batch({"id": [1, 2]})]))
    assert sink.committed(spark, path, schema).count() == 0  # written, not committed
    writer.commit([first, None, writer.write(iter([]))], 0)
    assert sorted(r.id for r in sink.committed(spark, path, schema).collect()) == [1, 2]
    writer.commit([writer.write(iter([pa.record_batch({"id": [1, 3]})]))], 0)
    assert sorted(r.id for r in sink.committed(spark, path, schema).collect()) == [1, 3]
    lost = writer.write(iter([pa.record_batch({"id": [9]})]))
    writer.abort([lost, None], 1)
    assert sorted(r.id for r in sink.committed(spark, path, schema).collect()) == [1, 3]
    assert lost.files[0] not in os.listdir(tmp_path / "sink" / "data")

    def broken():
        yield pa.record_batch({"id": [5]})
        raise ValueError("broken")

    before = os.listdir(tmp_path / "sink" / "data")
    with pytest.raises(ValueError):
        writer.write(broken())
    assert os.listdir(tmp_path / "sink" / "data") == before
