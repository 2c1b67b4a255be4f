"""A micro-batch costs the dedupe state a call per lane at most, however many keys arrive."""

from pyspark.sql import functions as F

from eventloom.streaming import seen


def test_state_is_kept_by_lane(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(seen, "LANES", 4)
    rows = spark.range(300).select(
        F.col("id").cast("string").cast("binary").alias("value"), F.timestamp_seconds(F.col("id")).alias("arrival"),
        F.concat(F.lit("k"), (F.col("id") % 100).cast("string")).alias("glob_key"))
    rows.write.parquet(f"{tmp_path}/in")
    kept, stream = [], spark.readStream.schema(rows.schema).parquet(f"{tmp_path}/in")
    writer = seen.dedupe_stream(stream, 600).writeStream.foreachBatch(lambda df, i: kept.extend(r.glob_key for r in df.collect()))
    query = writer.option("checkpointLocation", f"{tmp_path}/c").trigger(availableNow=True).start()
    query.awaitTermination()
    assert sorted(kept) == sorted(f"k{i}" for i in range(100))
    plan = query._jsq.explainInternal(False) if hasattr(query._jsq, "explainInternal") else ""
    assert "lane" in plan
