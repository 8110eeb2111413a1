"""Incremental daily cash flows as a Structured Streaming job.

The same flow rule as the batch bridge (purchase = +4 x value, other =
-value) applied to a stream of events: a one-day event-time window per
account with a watermark, so late events within the allowed lateness still
update their day and state for closed days is dropped once they are written.  The stateless
Column cleaners of ``ledgerlake.functions`` work unchanged on such streams.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.sources import bridge as B

EVENTS_SCHEMA = ("event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, "
                 "props string")


def daily_flows(events: DataFrame, lateness: str = "2 days") -> DataFrame:
    """Streaming (or batch) aggregation: account x day -> net flow."""
    ts = F.col("ts").cast("timestamp")
    return (events.withColumn("ts", ts).withWatermark("ts", lateness)
            .groupBy(F.col("user_id").alias("CuentaID"), F.window("ts", "1 day").alias("w"))
            .agg(F.sum(F.expr(B.FLOW)).cast("double").alias("FlujoNetoDiario"))
            .select("CuentaID", F.to_date(F.col("w.start")).alias("Fecha"), "FlujoNetoDiario"))


def run_available(spark: SparkSession, source: str, sink: str, lateness: str = "2 days") -> DataFrame:
    """Process everything available in ``source`` (a parquet path or glob) once
    into the parquet files of ``sink`` and return them.

    Append mode: a day is written once, when the watermark has passed its end, and
    its state is dropped then; days that may still change wait for later events.
    Progress is checkpointed beside the sink, so a restarted job resumes."""
    stream = spark.readStream.schema(EVENTS_SCHEMA).parquet(source)
    flows = daily_flows(stream, lateness)
    q = (flows.writeStream.outputMode("append").format("parquet").option("path", sink)
         .option("checkpointLocation", f"{sink.rstrip('/')}-checkpoint").trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.schema(flows.schema).parquet(sink)
