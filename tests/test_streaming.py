"""Counts of a stream equal those of the same rows in a batch."""

from datetime import datetime, timedelta

from screenlake.operators import counts
from screenlake.streaming import counts as streaming


def test_running_cells_and_windows(spark, tmp_path):
    start = datetime(2024, 1, 1)
    rows = [("A" if k % 3 else None, f"id{k % 5}", f"s{k % 2}", start + timedelta(minutes=k)) for k in range(60)]
    schema = "lib_id string, id string, sample string, ts timestamp"
    spark.createDataFrame(rows[:30], schema).write.parquet(str(tmp_path / "in"))
    spark.createDataFrame(rows[30:], schema).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 2).parquet(str(tmp_path / "in"))
    for name, df, mode in (("cells", streaming.running_cells(stream), "complete"), ("windows", streaming.windowed(stream, "ts", "sample"), "append")):
        sink = df.writeStream.format("memory").queryName(name).outputMode(mode).option("checkpointLocation", str(tmp_path / name)).trigger(availableNow=True).start()
        sink.awaitTermination()
    batch = counts.cells(spark.createDataFrame(rows, schema))
    assert sorted(map(tuple, spark.table("cells").collect())) == sorted(map(tuple, batch.collect()))
    closed = spark.table("windows").collect()
    assert closed and all(r["n"] == 5 for r in closed)  # ten minutes of two samples in turn
