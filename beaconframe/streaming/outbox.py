"""Publishing of an outbox's messages as a stream: each once, also after a lost driver or a repeated batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from beaconframe.operators import lineage


def publish(spark: SparkSession, messages: DataFrame, sent: str, state: str, every: str | None = None):
    """L3, L4: the stream's messages whose time has come, appended to `sent` by batch; the running query.

    messages: a stream of rows with consumer and message_id. A batch takes what comes new, and
    leaves what earlier batches sent. A batch that is repeated writes over its own rows, so
    none is sent twice. With `every` (such as "5 seconds") the source is polled for ever;
    without it all that is there is taken once. Shuffled are keys of the batch and of what was
    sent; keep `sent` to the time within which repeats come.
    """
    schema = messages.schema

    def batch(rows: DataFrame, number: int) -> None:
        before = rows.sparkSession.read.schema(f"consumer {schema['consumer'].dataType.simpleString()}, message_id {schema['message_id'].dataType.simpleString()}, batch bigint").parquet(sent).where(F.col("batch") < number) if number else None
        new = rows.dropDuplicates(["consumer", "message_id"]) if before is None else lineage.undelivered(rows, before)
        new.write.mode("overwrite").parquet(f"{sent}/batch={number}")

    timed = {"processingTime": every} if every else {"availableNow": True}
    return messages.writeStream.option("checkpointLocation", state).trigger(**timed).foreachBatch(batch).start()
