import tempfile

from pyspark.sql import functions as F

from conftest import SF001
from ledgerlake.sources import bridge as B
from ledgerlake.streaming.cash_flows import run_available


def test_stream_appends_closed_days(spark):
    """Days that the watermark has passed equal the batch result; a second run on
    new files adds the rest and repeats nothing."""
    src, sink = tempfile.mkdtemp(prefix="ll-stream-src-"), tempfile.mkdtemp(prefix="ll-stream-out-") + "/flows"
    events = spark.read.parquet(f"{SF001}/events.parquet")
    last = events.agg(F.to_date(F.max("ts"))).first()[0]
    events.repartition(3).write.mode("overwrite").parquet(src)
    rounded = lambda df: df.select("CuentaID", "Fecha", F.round("FlujoNetoDiario", 2).alias("f"))
    batch = B.flujos(spark, SF001, per_user=True)
    closed = batch.filter(F.col("Fecha") < F.date_sub(F.lit(last), 2))
    got = run_available(spark, src, sink)
    assert rounded(got).exceptAll(rounded(batch)).count() == 0
    assert rounded(closed).exceptAll(rounded(got)).count() == 0
    # an event far ahead closes every day; no day is written twice
    events.limit(1).withColumn("ts", F.expr("ts + interval 3650 days")).write.mode("append").parquet(src)
    got = run_available(spark, src, sink)
    assert got.groupBy("CuentaID", "Fecha").count().filter("count > 1").count() == 0
    assert rounded(batch).exceptAll(rounded(got)).count() == 0
