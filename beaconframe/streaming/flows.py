"""The flow aggregation over a stream of events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from beaconframe.session import scratch


def flow_stream(events: DataFrame, key: str, ts: str, size: str, kind: str, kinds: list[str], bucket: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """L1: per key and tumbling window the counts and sums of the batch form; events later than `late` are left out.

    The gaps between events need their order and are of the batch form alone. State is one
    row for each key and open window.
    """
    timed = events.withColumn("__at", F.col(ts).cast("timestamp")).withWatermark("__at", late)
    counted = timed.groupBy(key, F.window("__at", bucket).alias("w")).agg(F.count(F.lit(1)).alias("packet_count"), F.sum(size).alias("bytes_sum"), F.avg(size).alias("bytes_mean"), *[F.count_if(F.col(kind) == k).alias(f"{k}_count") for k in kinds])
    return counted.select(key, F.col("w.start").cast("timestamp_ntz").alias("bucket"), *[c for c in counted.columns if c not in (key, "w")])


def drain(spark: SparkSession, stream: DataFrame, complete: bool = True) -> DataFrame:
    """All that is there now, run through the stream once; its rows as they stand at the end, or all that it gave."""
    folder = scratch(spark, "stream")
    write = lambda rows, number: rows.write.mode("overwrite" if complete else "append").parquet(f"{folder}/rows")
    query = stream.writeStream.outputMode("complete" if complete else "append").option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).foreachBatch(write).start()
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{folder}/rows")


def undelivered_stream(messages: DataFrame, time: str, late: str = "1 hour") -> DataFrame:
    """L4: messages of a stream, each (consumer, message_id) once as long as repeats come within `late`."""
    return messages.withWatermark(time, late).dropDuplicatesWithinWatermark(["consumer", "message_id"])
