"""The grouped aggregates are plain DataFrame plans, so they also run on a
streaming DataFrame."""

from quarry.operators import stats
from quarry.session import scratch_path


def test_mean_count_on_a_file_stream(spark, tsv):
    path = tsv([f"{g}\t{v}" for g, v in [("a", 1.0), ("a", 3.0), ("b", 10.0)]])
    stream = (spark.readStream.schema("g string, v double")
              .option("sep", "\t").csv(path))
    agg = stats.mean_count(stream, "v", by="g")
    query = (agg.writeStream.format("memory").queryName("quarry_stream_mean")
             .outputMode("complete")
             .option("checkpointLocation", scratch_path(spark, "stream-ckpt"))
             .trigger(availableNow=True).start())
    query.awaitTermination(120)
    rows = {r["g"]: (r["mean"], r["count"])
            for r in spark.table("quarry_stream_mean").collect()}
    assert rows == {"a": (2.0, 2), "b": (10.0, 1)}
    batch = stats.mean_count(spark.read.schema("g string, v double").option("sep", "\t")
                             .csv(path), "v", by="g")
    assert {r["g"]: (r["mean"], r["count"]) for r in batch.collect()} == rows
